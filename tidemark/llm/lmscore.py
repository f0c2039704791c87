"""Log probabilities of documents under a word-pair model whose counts are kept in a Bloom filter.

Tokens are the lower-cased words of a text and one end. A word is predicted from the token before it
(the end of a text stands before the first word of any): with c exact counts of single tokens, ĉ the
count of a pair as the filter gives it, N training tokens and V distinct ones,

    p(w) = (c(w) + 1) / (N + V + 1)                       the base
    p(w | h) = weight * min(ĉ(h w), c(h)) / c(h) + (1 - weight) * p(w),   or p(w) where c(h) = 0.

Dataflow. Documents are packed into slices of a bounded number of bytes: their tokens as numbers into
the slice's distinct words. A slice sends each of its distinct words and pairs once, with its count
in training documents, to the bucket of its hash; a bucket adds up the counts. So a word or pair that
stands in every document is one number per slice, and no bucket holds more than its share of distinct
keys; the number of buckets grows with the input. Counts of words come back to the slices as numbers.
Counts of pairs become, bucket by bucket, blocks of a log-frequency filter (see ``countfilter``), and
scores come from probing it, once per distinct pair of a slice:

* The filter takes at most ``bits`` bits for each training token, as no pair is entered more often than
  it occurs. Where this proven bound is within ``broadcast_bytes``, the blocks are broadcast and
  probed in the tasks that score the slices.
* Beyond it no broadcast is safe. Every block is then probed in the task that makes it, for the pairs
  that slices have sent there, and the steps found travel back. Blocks, probes and scores are the same.

Nulls, ties and odd input: a null text counts as empty, that is as one end; a null doc_id stays null;
repeated rows are separate documents; an empty table gives an empty result; without training documents
every probability is 1 / 1; extra columns are not carried. Texts are handled whole: one longer than a slice is
a slice of its own. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow, ship_package
from .countfilter import CountFilter, middles, scale, steps_of
from .packing import pack, pack_sorted, unpack, unpack_sorted
from .scratch import Scratch
from .textarrays import U64, byte_chunks, mix, words

#: Share of the pair's estimate in a prediction, ratio of neighbouring steps of counts, space and probes of an entry.
WEIGHT, BASE, BITS, PROBES = 0.8, 1.25, 12.0, 8
#: Bytes of text in a slice, and for each bucket; largest filter that is broadcast.
SLICE_BYTES, BUCKET_BYTES, BROADCAST_BYTES = 8 << 20, 8 << 20, 48 << 20
#: The hash of the token that ends each text.
END = U64(0x9D39247E33776D41)
_AFTER, _BEFORE = U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)

_SLICES = "slice long, ids binary, nulls binary, trained binary, ends binary, tokens binary, words binary"
_REQUESTS = "bucket int, slice long, keys binary, counts binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names)


def _slice_row(number: int, parts: list[tuple]) -> tuple:
    ids, trained, lengths, tokens = zip(*parts, strict=True)
    ids = pa.concat_arrays(ids)
    distinct, place = np.unique(np.concatenate(tokens), return_inverse=True)
    return (
        number,
        ids.fill_null(0).to_numpy().tobytes(),
        np.asarray(ids.is_null()).tobytes(),
        np.concatenate(trained).tobytes(),
        np.cumsum(np.concatenate(lengths)).tobytes(),
        pack(place, np.uint32),
        pack_sorted(distinct),
    )


def slices(docs: DataFrame, training: Column, slice_bytes: int) -> DataFrame:
    """Documents packed into slices: ids, which of them train, where each ends, tokens, distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        parts, size = [], 0
        for batch in batches:
            for at, data, offsets in byte_chunks(batch.column(2), min(slice_bytes, 1 << 20)):
                found = words(data, offsets)
                rows = batch.slice(at, len(offsets) - 1)
                trained = rows.column(1).to_numpy(zero_copy_only=False)
                tokens = np.insert(found.hashes, found.rows[1:], END)
                parts.append((rows.column(0), trained, np.diff(found.rows) + 1, tokens))
                size += len(data) + len(trained)
                if size >= slice_bytes:
                    yield _batch([_slice_row(number, parts)], _SLICES)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield _batch([_slice_row(number, parts)], _SLICES)

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(training, F.lit(False)).alias("training"),
        F.col("text").cast("string"),
    )
    return map_arrow(rows, run, _SLICES)


class _Slice:
    """A packed slice, read."""

    def __init__(self, ids, nulls, trained, ends, tokens, packed) -> None:
        self.ids = pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(nulls, bool))
        self.trained = np.frombuffer(trained, bool)
        self.ends = np.frombuffer(ends, np.int64)
        self.tokens = unpack(tokens, np.uint32).astype(np.int64)
        self.words = unpack_sorted(packed)

    def training_tokens(self) -> np.ndarray:
        return np.repeat(self.trained, np.diff(self.ends, prepend=0)).astype(np.float64)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens, self.training_tokens(), len(self.words)).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs: first and second word, the key, and for each token the number of its pair."""
        n = len(self.words)
        end = int(np.searchsorted(self.words, END))
        before = np.concatenate([[end], self.tokens[:-1]])
        codes, number = np.unique(before * n + self.tokens, return_inverse=True)
        first, second = np.divmod(codes, n)
        return first, second, mix(self.words[first] * _AFTER + self.words[second] * _BEFORE), number


def _read_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Slice]]:
    for batch in batches:
        for i in range(batch.num_rows):
            number, *packed = (c[i].as_py() for c in batch.columns)
            yield number, _Slice(*packed)


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each bucket that gets any: which of the keys, in ascending order."""
    order = np.argsort(keys, kind="stable")
    own = ((keys[order] >> U64(32)) % U64(buckets)).astype(np.int64)
    order = order[np.argsort(own, kind="stable")]
    edges = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=buckets))])
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, order[edges[b] : edges[b + 1]]


def _requests(keys: np.ndarray, counts: np.ndarray, number: int, buckets: int) -> pa.RecordBatch:
    rows = [(b, number, pack_sorted(keys[at]), pack(counts[at], np.uint32)) for b, at in _dealt(keys, buckets)]
    return _batch(rows, _REQUESTS)


def _totals(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's requests: slices, where each one's keys end, distinct keys, their sums, and whose key is which."""
    keys = [unpack_sorted(k.as_py()) for k in table["keys"]]
    counts = np.concatenate([unpack(c.as_py(), np.uint32) for c in table["counts"]])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, counts, len(distinct)).astype(np.int64)
    return table["slice"].to_pylist(), np.cumsum([len(k) for k in keys])[:-1], distinct, total, place


def word_totals(packed: DataFrame, buckets: int) -> DataFrame:
    """Counts of each slice's words in all training documents; a bucket's first row has its sums."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, s in _read_slices(batches):
            yield _requests(s.words, s.word_counts(), number, buckets)

    schema = "slice long, bucket int, found binary, n long, v long"

    def answer(table: pa.Table) -> pa.Table:
        numbers, edges, _, total, place = _totals(table)
        found = np.split(total[place], edges)
        sums = [(int(total.sum()), int(np.count_nonzero(total)))] + [(0, 0)] * (len(numbers) - 1)
        bucket = table["bucket"][0].as_py()
        rows = [(k, bucket, pack(f, np.int64), *s) for k, f, s in zip(numbers, found, sums, strict=True)]
        return pa.Table.from_batches([_batch(rows, schema)])

    return map_arrow(packed, ask, _REQUESTS).groupBy("bucket").applyInArrow(answer, schema)


def pair_filter(packed: DataFrame, buckets: int, steps: np.ndarray, bits: float, probes: int, probed: bool) -> DataFrame:
    """Blocks of the filter, one a bucket, or if ``probed`` the steps that they give for each slice's pairs."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, s in _read_slices(batches):
            _, _, keys, of_token = s.pairs()
            counts = np.bincount(of_token, s.training_tokens(), len(keys)).astype(np.int64)
            wanted = slice(None) if probed else counts > 0
            yield _requests(keys[wanted], counts[wanted], number, buckets)

    schema = "slice long, bucket int, found binary"

    def answer(table: pa.Table) -> pa.Table:
        numbers, edges, distinct, total, place = _totals(table)
        bucket, quanta = table["bucket"][0].as_py(), steps_of(total, steps)
        block = CountFilter.build(distinct[quanta > 0], quanta[quanta > 0], bits, probes)
        if not probed:
            rows = [(None, bucket, block.data.tobytes())]
        else:
            found = np.split(block.quanta(distinct, len(steps))[place], edges)
            rows = [(k, bucket, f.tobytes()) for k, f in zip(numbers, found, strict=True)]
        return pa.Table.from_batches([_batch(rows, schema)])

    return map_arrow(packed, ask, _REQUESTS).groupBy("bucket").applyInArrow(answer, schema)


def score_documents(
    docs: DataFrame,
    training: Column,
    weight: float = WEIGHT,
    base: float = BASE,
    bits: float = BITS,
    probes: int = PROBES,
    broadcast_bytes: int = BROADCAST_BYTES,
    slice_bytes: int = SLICE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Per document row: doc_id, trained, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from the rows for which ``training`` is true.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    steps = scale(base)
    value = middles(steps)
    with Scratch(spark) as scratch:
        packed = scratch.put(slices(docs, training, slice_bytes), "lm-slices")
        counted = scratch.put(word_totals(packed, buckets), "lm-words")
        n_train, n_distinct = (x or 0 for x in counted.agg(F.sum("n"), F.sum("v")).first())
        # No pair has more entries than occurrences, and a block's size is rounded up to 64 bits.
        bound = n_train * bits / 8 + 8 * buckets
        probed = bound > broadcast_bytes
        found = scratch.put(pair_filter(packed, buckets, steps, bits, probes, probed), "lm-pairs")
        blocks = None if probed else spark.sparkContext.broadcast({b: bytes(f) for _, b, f in found.collect()})

        def score(table: pa.Table) -> pa.Table:
            kind = np.array(table["kind"].to_pylist())
            pick = lambda k, *names: zip(*(table[c].filter(pa.array(kind == k)).to_pylist() for c in names), strict=True)
            (own,) = pick(0, *(c.split()[0] for c in _SLICES.split(", ")[1:]))
            s = _Slice(*own)
            count = np.zeros(len(s.words), np.int64)
            by_bucket = dict(_dealt(s.words, buckets))
            for b, data in pick(1, "bucket", "words"):
                count[by_bucket[b]] = unpack(data, np.int64)
            first, second, keys, of_token = s.pairs()
            quanta = np.zeros(len(keys), np.uint8)
            by_bucket = dict(_dealt(keys, buckets))
            if blocks is None:
                for b, data in pick(2, "bucket", "words"):
                    quanta[by_bucket[b]] = np.frombuffer(data, np.uint8)
            else:
                for b, at in by_bucket.items():
                    if b in blocks.value:
                        quanta[at] = CountFilter(blocks.value[b], probes).quanta(keys[at], len(steps))
            plain = (count + 1) / (n_train + n_distinct + 1)
            before = count[first]
            share = np.minimum(value[quanta], before) / np.maximum(before, 1)
            chance = np.where(before > 0, weight * share + (1 - weight) * plain[second], plain[second])
            starts = np.concatenate([[0], s.ends[:-1]])
            lengths = s.ends - starts
            return pa.table(
                [
                    s.ids,
                    pa.array(s.trained),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((count > 0)[s.tokens].astype(np.int64), starts)),
                    pa.array(np.full(len(lengths), n_train, np.int64)),
                    pa.array(np.add.reduceat(np.log10(plain)[s.tokens], starts)),
                    pa.array(np.add.reduceat(np.log10(chance)[of_token], starts)),
                ],
                ["doc_id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

        def part(df: DataFrame, kind: int) -> DataFrame:
            return df.select("slice", F.lit(kind).alias("kind"), "bucket", F.col("found").alias("words"))

        rows = packed.withColumns({"kind": F.lit(0), "bucket": F.lit(None).cast("int")})
        rows = rows.unionByName(part(counted, 1), allowMissingColumns=True)
        if probed:
            rows = rows.unionByName(part(found, 2), allowMissingColumns=True)
        out = rows.groupBy("slice").applyInArrow(
            score,
            "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
        return scratch.keep(out, "lm-scores")
