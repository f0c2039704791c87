"""Mix sources to target weights by weighted fair queueing, with built-in functions only.

Every source is a queue of its documents in shuffled order, passed through up to
``max_repeats`` times. A document's virtual finish time is the words that its source has
queued up to its end, divided by the source's target. Served by finish time, all sources
advance at the rates of their targets; the mix ends when the word budget is used up. Documents
are served whole, but for the one at which a source reaches its target: that one is served in
packets of 64 words.

Nulls, ties and odd input: a null source is a source of its own and comes last; a null text
has no words; documents without words are in no queue and take 0; rows with one id stay
separate rows, next to each other in the queue; an empty table gives an empty result. Only
the key, text and source columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one slice of a running total aims at; slices are cut by hash or time, not by key.
SLICE_ROWS = 5_000
#: Words that a document is served at a time where a source reaches its target.
PACKET = 64


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, doc_id, source, size): a number for every row, and its words. To be stored before use."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """One row per source: its size and its target, at most ``max_repeats`` times its size.

    The budget is the size of all documents. A common level is raised until the targets
    min(cap, level * weight) use the budget up: sources in the order of cap / weight stay at
    their cap as long as filling everyone to that ratio fits the budget; the rest share what
    is left by weight. Integers until the last division, so reruns and partial sums agree.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    # One row per source from here on; the windows below see sources, never documents.
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everyone = Window.partitionBy(F.lit(1))
    so_far = fill.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int")
    )
    levels = (
        per_source.withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("budget", F.sum("source_size").over(everyone))
        .withColumn("all_weights", F.sum("weight").over(everyone))
        .withColumn("caps", F.sum("cap").over(so_far))
        .withColumn("capped_weights", F.sum("weight").over(so_far))
        .withColumn(
            "capped",
            F.col("cap") * (F.col("all_weights") - F.col("capped_weights"))
            <= (F.col("budget") - F.col("caps")) * F.col("weight"),
        )
    )
    spent = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everyone), F.lit(0))
    used = F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(everyone), F.lit(0))
    level = (F.col("budget") - spent).cast("double") / (F.col("all_weights") - used)
    return levels.withColumn(
        "target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    ).select("source", "source_size", "n", "target", "budget", F.sum("n").over(everyone).alias("all_n"))


def running_total(df: DataFrame, slices: list[str], order: list[Column], value: str, out: str, within: list[str]) -> DataFrame:
    """``out``: sum of ``value`` over the row and all rows before it, per ``within``.

    ``slices`` name a column that rises with ``order``. Positions are summed within a slice and
    the totals of earlier slices are added, so no task has to hold a whole source.
    """
    slice_key = [*within, *slices]
    totals = df.groupBy(*slice_key).agg(F.sum(value).alias("slice_total"))
    before = Window.partitionBy(*within).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*slice_key, F.coalesce(F.sum("slice_total").over(before), F.lit(0)).alias("slice_start"))
    inside = Window.partitionBy(*slice_key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = df.withColumn("in_slice", F.sum(value).over(inside))
    match = [placed[c].eqNullSafe(offsets[c]) for c in slice_key]
    return placed.join(offsets, match).select(
        *(placed[c] for c in df.columns), (F.col("slice_start") + placed["in_slice"]).alias(out)
    )


def queue_times(sized: DataFrame, targets: DataFrame, max_repeats: int = 3) -> DataFrame:
    """One row per document, pass and packet: words, virtual finish time, and a slice of time."""
    t = targets.select(F.col("source").alias("t_source"), "source_size", "n", "target", "budget", "all_n")
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15)
    queued = (
        sized.where("size > 0")
        .join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .drop("t_source")
        # The shuffle order: leading bits of a digest of the id, which also cut the queue evenly.
        .withColumn("draw", F.conv(digits, 16, 10).cast("bigint"))
        .withColumn("slice", F.floor(F.col("draw") / 2.0**60 * F.ceil(F.col("n") / SLICE_ROWS)))
    )
    order = [F.col(c) for c in ("draw", "doc_id", "size", "row")]
    placed = running_total(queued, ["slice"], order, "size", "queued", ["source"])
    passes = placed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))).withColumn(
        "ahead", F.col("turn") * F.col("source_size") + F.col("queued") - F.col("size")
    )
    # The budget runs out when every source has had its target. The document that a source is at
    # by then is served in packets, so that it is not all or nothing.
    cut = (F.col("ahead") < F.col("target")) & (F.col("ahead") + F.col("size") > F.col("target"))
    packets = F.when(cut, F.ceil(F.col("size") / PACKET).cast("int")).otherwise(F.lit(1))
    words = F.when(F.col("packets") > 1, F.least(F.lit(PACKET), F.col("size") - F.col("packet") * PACKET))
    return (
        passes.withColumn("packets", packets)
        .withColumn("packet", F.explode(F.sequence(F.lit(0), F.col("packets") - 1)))
        .withColumn("words", F.coalesce(words, F.col("size")).cast("bigint"))
        .withColumn(
            "finish", (F.col("ahead") + F.col("packet") * PACKET + F.col("words")).cast("double") / F.col("target")
        )
        # All queues together are served at a constant rate, so equal steps of time hold about
        # equal numbers of rows.
        .withColumn("slice", F.floor(F.col("finish") * F.ceil(F.col("all_n") / SLICE_ROWS)))
        .drop("queued", "ahead", "packets", "n", "all_n")
    )


def serve(times: DataFrame) -> DataFrame:
    """Range-sort all passes by finish time and cut at the budget.

    Adds ``served``, the running total of words over the whole mix, and ``taken``, the words
    the mix takes: all up to the budget, of the document that crosses it what is left, then 0.
    """
    order = [F.col("finish"), F.col("source").asc_nulls_last()]
    order += [F.col(c) for c in ("turn", "draw", "doc_id", "size", "row", "packet")]
    served = running_total(times, ["slice"], order, "words", "served", [])
    left = F.col("budget") - (F.col("served") - F.col("words"))
    return served.withColumn("taken", F.greatest(F.least("words", left), F.lit(0)))


def fair_mix(sized: DataFrame, targets: DataFrame, max_repeats: int = 3) -> DataFrame:
    """The mix in its order: (doc_id, source, turn, packet, finish, served, taken) of all it takes."""
    return (
        serve(queue_times(sized, targets, max_repeats))
        .where("taken > 0")
        .select("doc_id", "source", "turn", "packet", "finish", "served", "taken")
        .orderBy("served")
    )


def mix_to_targets(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """Per document row: doc_id, source, size, source_size, target and the words the mix takes."""
    with Scratch(docs.sparkSession) as scratch:
        # The texts are read once; all that follows works on a few narrow columns.
        sized = scratch.keep(sizes(docs), "mix-sizes")
        targets = scratch.keep(source_targets(sized, weights, max_repeats), "mix-targets")
        times = scratch.keep(queue_times(sized, targets, max_repeats), "mix-times")
    return _shares(sized, targets, times).drop("row")


def _shares(sized: DataFrame, targets: DataFrame, times: DataFrame) -> DataFrame:
    kept = ["row", "doc_id", "source", "size", "source_size", "target"]
    in_queue = serve(times).groupBy(*kept).agg(F.sum("taken").alias("taken"))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    wordless = (
        sized.where("size = 0")
        .join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .select(*kept, F.lit(0).cast("bigint").alias("taken"))
    )
    return in_queue.unionByName(wordless)


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """The documents the mix takes words of: all their columns, then mix_size, mix_target, mix_taken.

    Joined by doc_id and source: rows that agree in both are one document of the mix, as if their
    texts stood one after another, and carry its figures.
    """
    with Scratch(docs.sparkSession) as scratch:
        summed = sizes(docs).groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
        sized = scratch.keep(summed.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
        targets = scratch.keep(source_targets(sized, weights, max_repeats), "mix-targets")
        times = scratch.keep(queue_times(sized, targets, max_repeats), "mix-times")
        taken = scratch.keep(_shares(sized, targets, times).where("taken > 0"), "mix-taken")
    figures = taken.select(
        F.col("doc_id").alias("_mix_doc"),
        F.col("source").alias("_mix_source"),
        F.col("size").alias("_size"),
        F.col("target").alias("_target"),
        F.col("taken").alias("_taken"),
    )
    same = docs["doc_id"].eqNullSafe(figures["_mix_doc"]) & docs["source"].eqNullSafe(figures["_mix_source"])
    # Columns of an earlier mix give way to these.
    own = [docs[f"`{c}`"] for c in docs.columns if c not in ("mix_size", "mix_target", "mix_taken")]
    return docs.join(figures, same).select(
        *own,
        figures["_size"].alias("mix_size"),
        figures["_target"].alias("mix_target"),
        figures["_taken"].alias("mix_taken"),
    )
