"""Remove bytes of repeated 200-byte strings with a distributed merge sort of suffixes.

Not every suffix is sorted. Of each 200-byte window the 100-byte string with the least hash is
its anchor, so equal windows have their anchor at the same place, and only suffixes that start
at an anchor whose 100 bytes occur more than once (counted over all documents) can tell equal
windows. These suffixes, 200 bytes each and with the 100 bytes before them, are sorted in runs by
the map tasks, front-coded (common prefix with the suffix before, and the rest), and exchanged by
the first 100 bytes. A loser tree merges the runs of a bucket: heads carry the length of the
prefix they share with the last suffix put out, suffixes that share more of it come first without
a look at their bytes, and equal ones are compared from there on only.

In the merged order, suffixes that share n bytes or more stand together. A window that begins d
bytes before an anchor is repeated if another suffix shares 200 - d bytes on the right and d on
the left. The bytes before the suffixes are sorted too, nearest first, and common prefixes of
neighbours number the groups that share d of them; so both sides are compared byte by byte.
Windows of one anchor overlap, so the first and last of them give what it covers.

Equal surroundings within a run are settled there and sent on once, so a passage that stands in
a third of all documents is sent once per run. Buckets hold about 20,000 suffixes.

Nulls, ties and odd input: a null text counts as empty; texts under 200 bytes lose nothing;
repeated rows are separate documents and repeat each other; rows that agree in doc_id and text
get the same result; an empty table gives an empty result. Long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow, ship_package
from .scratch import Scratch
from .textarrays import U64, RangeHash, byte_chunks

WIDTH, CONTEXT = 200, 100
BUCKET_SUFFIXES = 20_000
RUN_SUFFIXES = 100_000
_PLACE_BITS = 24
#: Longer stretches are searched for anchors piece by piece.
_PIECE = 1 << 22


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a run of rows of all anchors, and the hashes of the 100 bytes there."""
    if len(data) > _PIECE + WIDTH:
        spots, hashes = [], []
        for lo in range(0, len(data) - WIDTH + 1, _PIECE):
            hi = min(len(data), lo + _PIECE + WIDTH - 1)
            cut = np.unique(np.clip(offsets, lo, hi)) - lo
            at, h = anchors(data[lo:hi], cut)
            spots.append(at + lo)
            hashes.append(h)
        at, first = np.unique(np.concatenate(spots), return_index=True)
        return at, np.concatenate(hashes)[first]
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    starts = np.arange(len(data) - CONTEXT + 1)
    hashes = RangeHash(data)(starts, starts + CONTEXT)
    keyed = (hashes & ~U64((1 << _PLACE_BITS) - 1)) | starts.astype(U64)
    # Least of every 101 neighbours: of each block's tail and the next block's head.
    span = WIDTH - CONTEXT + 1
    padded = np.full(-(-len(keyed) // span) * span, np.iinfo(U64).max, U64)
    padded[: len(keyed)] = keyed
    blocks = padded.reshape(-1, span)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:n], head[span - 1 : span - 1 + n])
    inside = np.ones(n, bool)
    for edge in offsets[1:-1].tolist():
        inside[max(0, edge - WIDTH + 1) : edge] = False
    chosen = np.zeros(len(data), bool)
    chosen[(least[inside] & U64((1 << _PLACE_BITS) - 1)).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    return at, hashes[at]


def document_anchors(keyed: DataFrame) -> DataFrame:
    """(doc_id, print, place, key): anchors of every document. ``keyed``: (doc_id, print, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in byte_chunks(batch.column(2), 1 << 18):
                at, hashes = anchors(data, offsets)
                own = np.searchsorted(offsets, at, "right") - 1
                rows = pa.array(own + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array((at - offsets[own]).astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                    ],
                    ["doc_id", "print", "place", "key"],
                )

    return map_arrow(keyed, run, "doc_id long, print long, place int, key long")


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that agree in their first ``known`` bytes."""
    most = min(len(a), len(b))
    while known < most:
        upto = min(known + 32, most)
        x = int.from_bytes(a[known:upto]) ^ int.from_bytes(b[known:upto])
        if x:
            return upto - 1 - (x.bit_length() - 1) // 8
        known = upto
    return most


class LoserTree:
    """Merge sorted runs of byte strings; each run is (strings, prefixes shared with the string before)."""

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]) -> None:
        self.runs = runs
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.at = [0] * len(runs)
        #: Of each run's head, the prefix shared with the last string put out.
        self.shared = [0] * len(runs)
        self.losers = [-1] * self.size
        self.winner = self._build(1) if runs else -1

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; keeps the loser's prefix in terms of the winner."""
        if a < 0 or b < 0:
            return b < 0
        if self.at[a] >= len(self.runs[a][0]):
            return False
        if self.at[b] >= len(self.runs[b][0]):
            return True
        if self.shared[a] != self.shared[b]:
            return self.shared[a] > self.shared[b]
        x, y = self.runs[a][0][self.at[a]], self.runs[b][0][self.at[b]]
        n = common_prefix(x, y, self.shared[a])
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        self.shared[b if first else a] = n
        return first

    def _build(self, node: int) -> int:
        if node >= self.size:
            run = node - self.size
            return run if run < len(self.runs) else -1
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if self._beats(a, b):
            self.losers[node] = b
            return a
        self.losers[node] = a
        return b

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, place in the run, prefix shared with the string put out before) in sorted order."""
        while self.winner >= 0 and self.at[self.winner] < len(self.runs[self.winner][0]):
            run = self.winner
            yield run, self.at[run], self.shared[run]
            self.at[run] += 1
            if self.at[run] < len(self.runs[run][0]):
                self.shared[run] = self.runs[run][1][self.at[run]]
            node = (run + self.size) // 2
            while node:
                other = self.losers[node]
                if not self._beats(run, other):
                    self.losers[node], run = run, other
                node //= 2
            self.winner = run


_RUN_FIELDS = ["shared", "rest", "lengths", "before", "before_lengths", "settled", "doc_ids", "prints", "places"]
_SPANS = "doc_id long, print long, start int, stop int"
_NO_ID = -(1 << 63)


def _front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    shared, rest, last = [], [], b""
    for s in strings:
        n = common_prefix(last, s, 0)
        shared.append(n)
        rest.append(s[n:])
        last = s
    return shared, rest


def _runs(suffixes: list[tuple[bytes, bytes, int, int, int]], buckets: int):
    """Front-coded runs by bucket, and spans of suffixes whose surroundings are repeated in the run."""
    groups: dict[tuple[bytes, bytes], list[tuple[int, int, int]]] = {}
    for right, left, doc_id, mark, place in suffixes:
        groups.setdefault((right, left), []).append((doc_id, mark, place))
    spans, dealt = [], {}
    for (right, left), owners in groups.items():
        if len(owners) > 1 and len(left) + len(right) >= WIDTH:
            spans += [(d, m, p - len(left), p + len(right)) for d, m, p in owners]
        dealt.setdefault(crc32(right[:CONTEXT]) % buckets, []).append((right, left, len(owners) > 1, *owners[0]))
    rows = []
    for bucket, own in dealt.items():
        own.sort(key=lambda x: x[0])
        shared, rest = _front_code([x[0] for x in own])
        rows.append(
            {
                "bucket": bucket,
                "shared": bytes(shared),
                "rest": b"".join(rest),
                "lengths": bytes(len(x[0]) for x in own),
                "before": b"".join(x[1] for x in own),
                "before_lengths": bytes(len(x[1]) for x in own),
                "settled": bytes(x[2] for x in own),
                "doc_ids": np.array([x[3] for x in own], np.int64).tobytes(),
                "prints": np.array([x[4] for x in own], np.int64).tobytes(),
                "places": np.array([x[5] for x in own], np.int32).tobytes(),
            }
        )
    return rows, spans


def suffix_runs(held: DataFrame, buckets: int) -> DataFrame:
    """Sorted front-coded runs by bucket; rows with bucket -1 carry spans that are settled already.

    ``held``: (doc_id, print, text, places) of the documents with repeated anchors.
    """
    fields = [pa.field("bucket", pa.int32())] + [pa.field(f, pa.binary()) for f in _RUN_FIELDS]
    schema = pa.schema(fields)

    def batch_of(rows: list[dict], spans: list[tuple]) -> pa.RecordBatch:
        if spans:
            d, m, a, b = (np.array(x) for x in zip(*spans, strict=True))
            rows.append(
                dict.fromkeys(_RUN_FIELDS, b"")
                | {
                    "bucket": -1,
                    "doc_ids": d.astype(np.int64).tobytes(),
                    "prints": m.astype(np.int64).tobytes(),
                    "places": a.astype(np.int32).tobytes(),
                    "rest": b.astype(np.int32).tobytes(),
                }
            )
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py().encode()
                doc_id = batch.column(0)[i].as_py()
                doc_id = _NO_ID if doc_id is None else doc_id
                mark = batch.column(1)[i].as_py()
                for p in batch.column(3)[i].as_py():
                    suffixes.append((raw[p : p + WIDTH], raw[max(0, p - CONTEXT) : p], doc_id, mark, p))
                    if len(suffixes) >= RUN_SUFFIXES:
                        yield batch_of(*_runs(suffixes, buckets))
                        suffixes = []
        if suffixes:
            yield batch_of(*_runs(suffixes, buckets))

    schema_text = "bucket int, " + ", ".join(f"{f} binary" for f in _RUN_FIELDS)
    return map_arrow(held, run, schema_text)


def _sorted_back(back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows of bytes, and how many bytes each shares with the row before it."""
    m, width = back.shape
    padded = np.zeros((m, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = back
    order = np.lexsort(padded.view(">u8").T[::-1])
    agree = np.zeros(m, np.int64)
    for lo in range(1, m, _PIECE // width):
        rows = order[lo - 1 : lo + _PIECE // width]
        differ = back[rows[1:]] != back[rows[:-1]]
        agree[lo : lo + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, agree


def _covered(shared: np.ndarray, right: np.ndarray, left: list[bytes], settled: np.ndarray):
    """First and last repeated window of each merged suffix, as bytes before it (-1: none)."""
    m = len(shared)
    lengths = np.array([len(x) for x in left])
    # Bytes before the suffix, nearest first.
    back = np.zeros((m, CONTEXT), np.uint8)
    for i, x in enumerate(left):
        back[i, : len(x)] = np.frombuffer(x, np.uint8)[::-1]
    nearest, farthest = np.full(m, -1), np.full(m, -1)
    alone = shared < CONTEXT
    group = np.cumsum(alone)
    open_ = ~settled
    by_left, agree = _sorted_back(back)
    same_left = np.empty(m, np.int64)

    def test(d: int, use: np.ndarray) -> None:
        fit = use[(lengths[use] >= d) & (right[use] >= WIDTH - d)]
        if len(fit) < 2:
            return
        # Groups that share all bytes from d before the anchor on: those of the right side, divided by the left.
        same_left[by_left] = np.cumsum(agree < d)
        key = np.cumsum(shared < WIDTH - d)[fit] * (m + 1) + same_left[fit]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = fit[counts[inverse] > 1]
        nearest[twice] = np.where(nearest[twice] < 0, d, np.minimum(nearest[twice], d))
        farthest[twice] = np.maximum(farthest[twice], d)

    everyone = np.arange(m)
    test(0, everyone)
    test(CONTEXT, everyone)
    # Between the ends only what they leave open is looked at, with all that could match it.
    open_ &= (nearest != 0) | (farthest != CONTEXT)
    wanted = np.zeros(group[-1] + 1, bool)
    wanted[group[open_]] = True
    use = np.flatnonzero(wanted[group])
    for d in range(1, CONTEXT):
        test(d, use)
    return nearest, farthest


def _merge(table: pa.Table) -> pa.Table:
    """Spans covered by repeated windows, from the runs of one bucket."""
    schema = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
    column = {f: table[f].to_pylist() for f in _RUN_FIELDS}
    runs, owners, lefts, settled = [], [], [], []
    for r in range(table.num_rows):
        strings, last, at = [], b"", 0
        for n, length in zip(column["shared"][r], column["lengths"][r], strict=True):
            last = last[:n] + column["rest"][r][at : at + length - n]
            at += length - n
            strings.append(last)
        runs.append((strings, list(column["shared"][r])))
        ends = np.cumsum(np.frombuffer(column["before_lengths"][r], np.uint8), dtype=np.int64).tolist()
        before = column["before"][r]
        lefts.append([before[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)])
        settled.append(column["settled"][r])
        owners.append([np.frombuffer(column[f][r], k) for f, k in (("doc_ids", np.int64), ("prints", np.int64), ("places", np.int32))])
    order = list(LoserTree(runs))
    if not order:
        return schema.empty_table()
    shared = np.array([n for _, _, n in order])
    right = np.array([len(runs[r][0][i]) for r, i, _ in order])
    nearest, farthest = _covered(
        shared, right, [lefts[r][i] for r, i, _ in order], np.array([settled[r][i] for r, i, _ in order], bool)
    )
    ids, prints, places = (np.array([owners[r][k][i] for r, i, _ in order]) for k in range(3))
    hit = nearest >= 0
    return pa.table(
        [
            pa.array(ids[hit], pa.int64()),
            pa.array(prints[hit], pa.int64()),
            pa.array((places - farthest)[hit].astype(np.int32)),
            pa.array((places - nearest)[hit].astype(np.int32) + WIDTH, pa.int32()),
        ],
        schema=schema,
    )


def repeated_spans(keyed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(spans, held): covered byte ranges by document, and the documents that have any candidates."""
    ship_package(keyed.sparkSession)
    found = scratch.put(document_anchors(keyed), "suffix-anchors")
    repeated = scratch.put(
        found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "suffix-keys"
    )
    places = scratch.put(
        found.join(repeated, "key", "left_semi").select("doc_id", "print", "place").distinct(), "suffix-places"
    )
    scratch.drop(found)
    per_doc = places.groupBy("doc_id", "print").agg(F.sort_array(F.collect_list("place")).alias("places"))
    a, b = keyed, per_doc
    same = (a["print"] == b["print"]) & a["doc_id"].eqNullSafe(b["doc_id"])
    held = scratch.put(a.join(b, same).select(a["doc_id"], a["print"], "text", "places"), "suffix-held")
    buckets = max(1, -(-places.count() // BUCKET_SUFFIXES))
    runs = scratch.put(suffix_runs(held, buckets), "suffix-runs")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], np.int64)),
                        pa.array(np.frombuffer(row["prints"], np.int64)),
                        pa.array(np.frombuffer(row["places"], np.int32)),
                        pa.array(np.frombuffer(row["rest"], np.int32)),
                    ],
                    ["doc_id", "print", "start", "stop"],
                )

    settled = map_arrow(runs.where("bucket = -1").select("doc_ids", "prints", "places", "rest"), unpack, _SPANS)
    merged = runs.where("bucket >= 0").groupBy("bucket").applyInArrow(_merge, _SPANS)
    spans = settled.union(merged).groupBy("doc_id", "print").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")
    )
    return scratch.put(spans, "suffix-spans"), held


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            raw = (text.as_py() or "").encode()
            parts, at, runs = [], 0, 0
            for start, stop in sorted((x["start"], x["stop"]) for x in spans.as_py() or []):
                if start > at or not runs:
                    parts.append(raw[at:start])
                    runs += 1
                at = max(at, stop)
            parts.append(raw[at:])
            kept = b"".join(parts)
            out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
        n, removed, runs, digest = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeated(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        spans, held = repeated_spans(keyed, scratch)
        s = spans.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
        same = (held["print"] == s["print"]) & held["doc_id"].eqNullSafe(s["doc_id"])
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        cut = map_arrow(held.join(s, same).select(held["doc_id"], "text", "spans"), _remove, schema)
        marked = scratch.keep(s.select("doc_id", "print").distinct(), "suffix-marked")
        cut = scratch.keep(cut, "suffix-cut")
    same = (keyed["print"] == marked["print"]) & keyed["doc_id"].eqNullSafe(marked["doc_id"])
    # Whole documents need no text beside their own digest, which is taken before the join.
    n_bytes = F.octet_length("text").cast("bigint")
    digests = keyed.select("doc_id", "print", n_bytes.alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    same = (digests["print"] == marked["print"]) & digests["doc_id"].eqNullSafe(marked["doc_id"])
    whole = digests.join(marked, same, "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"), "kept_sha256"
    )
    return cut.unionByName(whole)
