"""Near duplicates by bottom-k sketches of one hash function.

A document's set is its distinct 5-word shingles as 64-bit hashes; its sketch the 128 least of
them. Equal sets are one node. Retained values make inverted lists, of which only the part is
kept that can generate an overlap: with values ordered from rare to frequent, two sketches with
the overlap that is needed share a value among the first few of both, so frequent values (a
passage that many documents share) seldom form lists. A list that still holds many unlike
documents after a first comparison (variants of one text, too far apart to be linked) gives way to
lists of the values of their whole sets, in which a value's place tells which pairs can still be
similar. Pairs from the lists are filtered by the
sketch of the union, and confirmed on the full sets, which are read again from the texts.

The needed overlap is exact for sets whose similar sets all fit into the sketch. For larger ones
it is six standard deviations below what is expected at a similarity of 0.75, for a sample without
replacement of the largest union possible; fewer than that has a chance below 1e-8 at 0.75
exactly, and less above. The filter on the union's sketch uses the same bounds.

Nulls, ties and odd input: null, empty and wordless texts have an empty set and no links; a text
of fewer than five words is one shingle; rows with one doc_id are one document; an empty table
gives an empty result. Very long texts are read whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrowmap import map_arrow
from .linking import link_by_keys
from .scratch import Scratch
from .textarrays import U64, byte_chunks, long_lists, mix, shingle_sets, words

SIZE = 5
SKETCH = 128
PERCENT = 75
#: Standard deviations of slack in the overlap of two sketches.
SLACK = 6


def sketches(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """(doc_id, n_shingles, p0, p1, sketch): set size, fingerprint of the set, least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in byte_chunks(batch.column(1)):
                sets = shingle_sets(words(data, offsets), SIZE)
                prints = [(x.sum(dtype=U64), mix(x ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)) for x in sets]
                p = np.array(prints, U64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(p[:, 0].copy()),
                        pa.array(p[:, 1].copy()),
                        long_lists([x[:k] for x in sets]),
                    ],
                    ["doc_id", "n_shingles", "p0", "p1", "sketch"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_arrow(texts, run, "doc_id long, n_shingles long, p0 long, p1 long, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(node, members): the whole set of each document, sorted, as packed 64-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in byte_chunks(batch.column(1)):
                sets = shingle_sets(words(data, offsets), SIZE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), pa.array([x.tobytes() for x in sets], pa.binary())],
                    ["node", "members"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_arrow(texts, run, "node long, members binary")


def needed_overlap(n: str) -> Column:
    """Values that a sketch of a set of this size must share with that of a similar set."""
    size, share = F.col(n), PERCENT / 100
    union = size / share
    spread = F.sqrt(SKETCH * share * (1 - share) * (union - SKETCH) / (union - 1))
    sampled = F.floor(F.least(size * share, SKETCH * share - SLACK * spread))
    return F.when(size <= SKETCH * share, F.ceil(size * PERCENT / 100)).otherwise(sampled).cast("int")


def prefix_members(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, node): retained values by which a document can meet a similar one."""
    values = nodes.select("node", "n_shingles", F.explode("sketch").alias("key"))
    frequency = values.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    shared = scratch.put(values.join(frequency, "key"), "near-shared")
    # Values that nobody else has come first in the order; they need no rows to be counted.
    kept = F.least(F.col("n_shingles"), F.lit(SKETCH))
    n_shared = F.count("*").over(Window.partitionBy("node"))
    rarest = Window.partitionBy("node").orderBy("df", "key")
    place = F.row_number().over(rarest) + kept - n_shared
    first = shared.withColumn("place", place).where(F.col("place") <= kept - needed_overlap("n_shingles") + 1)
    out = scratch.put(first.select("key", "node"), "near-prefix")
    several = out.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return scratch.put(out.join(several, "key", "left_semi"), "near-members")


def set_values(sets: DataFrame) -> DataFrame:
    """(key, node, n) of every value of the sets (node, members); ``n`` is the size of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                # Inverted, as keys of retained values may be left beside these.
                members = ~np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                n = len(members)
                node, size = pa.repeat(batch.column(0)[i], n), pa.repeat(pa.scalar(n, pa.int64()), n)
                yield pa.RecordBatch.from_arrays([pa.array(members), node, size], ["key", "node", "n"])

    return map_arrow(sets, run, "key long, node long, n long")


def finer_keys(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, node, n, rest): values of whole sets from rare to frequent, as far as they can be the first in common.

    ``rest`` is the number of values of the set from this one on. The first value that two similar sets
    have in common leaves at least their overlap in both, so pairs with less under a key cannot be similar
    by that key (see ``link_by_keys``). No pair is lost.
    """
    values = scratch.put(set_values(sets), "near-values")
    frequency = values.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    shared = values.join(frequency, "key")
    n_shared = F.count("*").over(Window.partitionBy("node"))
    # Values that no other set here has come first in the order.
    after = n_shared - F.row_number().over(Window.partitionBy("node").orderBy("df", "key")) + 1
    return shared.withColumn("rest", after.cast("long")).where(F.col("rest") * 100 >= F.col("n") * PERCENT).select(
        "key", "node", "n", "rest"
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            x = np.frombuffer(left[i].as_buffer(), U64)
            y = np.frombuffer(right[i].as_buffer(), U64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep[i] = common > 0 and 100 * common >= PERCENT * (len(both) - common)
        yield batch.select([0, 1]).filter(pa.array(keep))


def similar_pairs(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar: size bound, union's sketch, then in full."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(a, "a").join(b, "b").where(
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT
    )
    # Of the k least values of the union, those in both sketches. The order of the sketch is that
    # of unsigned values.
    flip = F.lit(-(2**63))
    both = F.array_sort(F.transform(F.array_union("sa", "sb"), lambda v: v.bitwiseXOR(flip)))
    least = F.transform(F.slice(both, 1, SKETCH), lambda v: v.bitwiseXOR(flip))
    need = F.greatest(needed_overlap("na"), needed_overlap("nb"))
    shared = F.array_intersect("sa", "sb")
    # What both sketches share bounds the overlap from above, and is cheaper to have.
    likely = sized.where(F.size(shared) >= need).where(F.size(F.array_intersect(least, shared)) >= need).select("a", "b")
    sa = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    sb = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    joined = likely.join(sa, "a").join(sb, "b").select("a", "b", "ma", "mb")
    return map_arrow(joined, _compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept."""
    with Scratch(docs.sparkSession) as scratch:
        prints = scratch.put(sketches(docs), "near-sketches")
        # Documents with equal sets are one node, named by the least of their ids. Of the rows of
        # a node any sketch serves, as all are equal.
        classes = prints.where("n_shingles > 0").groupBy("p0", "p1").agg(F.min("doc_id").alias("node"))
        named = prints.select("doc_id", "n_shingles", "p0", "p1").join(classes, ["p0", "p1"], "left")
        member_of = scratch.put(named.select("doc_id", "n_shingles", "node"), "near-classes")
        own = prints.where("n_shingles > 0").select(F.col("doc_id").alias("node"), "n_shingles", "p0", "p1", "sketch")
        nodes = own.join(classes, ["node", "p0", "p1"], "left_semi").dropDuplicates(["node", "p0", "p1"])
        members = prefix_members(nodes, scratch)
        wanted = members.select("node").distinct()
        few = scratch.put(nodes.join(wanted, "node", "left_semi").select("node", "n_shingles", "sketch"), "near-nodes")
        scratch.drop(prints)
        texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("node"), "left_semi")
        sets = scratch.put(full_sets(texts), "near-sets")

        def confirm(pairs: DataFrame) -> DataFrame:
            return similar_pairs(pairs, few, sets)

        def finer(live: DataFrame) -> DataFrame:
            return finer_keys(sets.join(live, "node", "left_semi"), scratch)

        roots = link_by_keys(members, confirm, scratch, "near", finer)
        out = (
            member_of.join(roots, "node", "left")
            .withColumn("component_id", F.coalesce("root", "node", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", (F.col("component_id") == F.col("doc_id")).alias("kept"))
        )
        return scratch.keep(out, "near-result")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: of each group the document with the least id."""
    found = near_duplicates(docs)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
