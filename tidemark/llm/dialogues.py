"""Conversations checked and repaired to a legal order of turns at the least cost.

Rows of a conversation are taken by turn (nulls first; rows of one turn by role, then by a checksum
of the text). A row's first fault counts: blank (nothing but white space), duplicate (role and text
stood before), truncated (its last character that is no white space ends no sentence). Edits are Keep,
Rerole, Delete and Insert; ``repairgrammar`` has their costs and the parser that finds the cheapest.

Dataflow. All rows are range-partitioned by conversation and turn and written once with their place in
this order. What follows is narrow: per row a checksum and a symbol of two characters (initial, fault).
Duplicates are found by the least place of each (conversation, checksum), an aggregate with map-side
combine. The part of a conversation that lies in one partition is a segment; its cells are parsed where
its symbols are gathered, and cells of a conversation's segments are combined by their neighbourhood.
So a conversation with a third of all rows is spread over as many segments as its partitions, and only
its symbols and audit meet; texts come back by place.

Nulls, ties and odd input: a null conv_id is a conversation of its own; null roles and texts count as
empty; an initial other than s, u or a has no legal place and is reroled or deleted; rows that are equal
in everything are duplicates of the first; an empty table gives empty results; extra columns are not
carried. Texts are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow
from .repairgrammar import best, edits, join_spans, span_cells
from .scratch import Scratch

#: White space as the word rules of this package have it.
_SPACE = r"\x20\x09-\x0D"
_ROLES = {"u": "user", "a": "assistant"}


class Repair(NamedTuple):
    """``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row per conversation.
    ``rows``: conv_id, place, part, role, text, edit, the repaired rows in order of (place, part)."""

    report: DataFrame
    rows: DataFrame


def _placed(rows: DataFrame) -> DataFrame:
    """Rows in order, with a place that grows along it; its upper bits number the partition."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "checksum", "salt"]
    keyed = rows.select("conv_id", F.col("turn").cast("long"), role.alias("role"), text.alias("text")).withColumns(
        # The salt lets even equal rows of one turn be dealt to several partitions.
        {"checksum": F.md5(F.col("text").cast("binary")), "salt": F.monotonically_increasing_id()}
    )
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.drop("salt").withColumn("place", F.monotonically_increasing_id())


def _symbols(placed: DataFrame) -> DataFrame:
    """(conv_id, place, symbol): the initial of the role and the first fault, a character each."""
    initial = F.substring("role", 1, 1)
    rows = placed.select(
        "conv_id",
        "place",
        F.md5(F.concat("role", F.lit("\x00"), "checksum").cast("binary")).alias("content"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")).alias("truncated"),
    )
    first = rows.groupBy("conv_id", "content").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("truncated"), "t").otherwise(".")
    return rows.join(first, "place", "left").select("conv_id", "place", F.concat("initial", fault).alias("symbol"))


def _segments(symbols: DataFrame) -> DataFrame:
    """(conv_id, place, symbols) for the part of each conversation in one partition; place is its first row's."""
    rows = F.array_sort(F.collect_list(F.struct("place", "symbol")))
    joined = F.array_join(F.transform(rows, lambda r: r["symbol"]), "")
    parts = symbols.groupBy("conv_id", F.shiftright("place", 33).alias("partition"))
    return parts.agg(F.min("place").alias("place"), joined.alias("symbols")).drop("partition")


_CELLS = "array<struct<p:int,q:int,cost:long,audit:string>>"
_CELL_TYPE = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PLAN = "array<struct<place:long,before:string,edit:string,turn:string,after:string>>"
_PLAN_TYPE = pa.list_(
    pa.struct([("place", pa.int64()), *((c, pa.string()) for c in ("before", "edit", "turn", "after"))])
)
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _parse_segments(segments: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (span_cells(s) for s in batch.column("symbols").to_pylist())
            cells = [[{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in x.items()] for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, _CELL_TYPE)], [*batch.schema.names, "cells"])

    conv_id = segments.schema["conv_id"].dataType.simpleString()
    return map_arrow(segments, run, f"conv_id {conv_id}, place long, symbols string, cells {_CELLS}")


def _finish(segments: list[dict]) -> tuple:
    """Counts, audit and plan of a conversation from its segments in order."""
    cells = [{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in segments]
    cost, audit = best(join_spans(cells))
    symbols = "".join(s["symbols"] for s in segments)
    places = [s["place"] + i for s in segments for i in range(len(s["symbols"]) // 2)]
    initials, faults = symbols[::2], symbols[1::2]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    names = ("place", "before", "edit", "turn", "after")
    plan = [dict(zip(names, (at, *e), strict=True)) for at, e in zip(places, edits(symbols, audit), strict=True)]
    return (*(faults.count(f) for f in "bdt"), illegal, cost, audit, plan)


def _join_segments(parsed: DataFrame) -> DataFrame:
    own = F.array_sort(F.collect_list(F.struct("place", "symbols", "cells")))
    gathered = parsed.groupBy("conv_id").agg(own.alias("segments"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*(pa.int64() for _ in _COUNTS), pa.string(), _PLAN_TYPE]
        for batch in batches:
            done = zip(*(_finish(s) for s in batch.column(1).to_pylist()), strict=True) if batch.num_rows else [[]] * 7
            columns = [pa.array(x, kind) for x, kind in zip(done, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["conv_id", *_COUNTS, "audit", "plan"])

    conv_id = parsed.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return map_arrow(gathered, run, f"conv_id {conv_id}, {counts}, audit string, plan {_PLAN}")


def _gaps(placed: DataFrame) -> DataFrame:
    """Turns missing between a conversation's first and last; repeated turns are combined before they meet."""
    turns = placed.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy(F.col("conv_id").alias("own")).agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))


def _inserted(initials: Column) -> Column:
    letters = F.filter(F.split(initials, ""), lambda c: c != "")
    role = F.create_map(*(F.lit(x) for kv in _ROLES.items() for x in kv))
    return F.transform(letters, lambda c: F.struct(role[c].alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit")))


def _repaired(placed: DataFrame, plan: DataFrame) -> DataFrame:
    role = F.when(F.col("turn") == "u", "user").when(F.col("turn") == "a", "assistant").otherwise(F.col("role"))
    own = F.array(F.struct(role.alias("role"), F.col("text"), F.col("edit")))
    kept = F.filter(own, lambda r: r["edit"] != "D")
    rows = placed.select("conv_id", "place", "role", "text").join(plan, "place")
    parts = F.concat(_inserted(F.col("before")), kept, _inserted(F.col("after")))
    return rows.select("conv_id", "place", F.posexplode(parts).alias("part", "row")).select("conv_id", "place", "part", "row.*")


def repair_conversations(rows: DataFrame) -> Repair:
    """Repair rows of conv_id, turn, role and text."""
    with Scratch(rows.sparkSession) as scratch:
        placed = scratch.keep(_placed(rows), "dialogue-rows")
        finished = scratch.keep(_join_segments(_parse_segments(_segments(_symbols(placed)))), "dialogue-repairs")
    plan = finished.select(F.explode("plan").alias("p")).select("p.*")
    gaps = _gaps(placed)
    report = finished.join(gaps, F.col("conv_id").eqNullSafe(F.col("own"))).select("conv_id", "gaps", *_COUNTS, "audit")
    return Repair(report, _repaired(placed, plan))
