"""Find benchmark passages in documents with the Wu-Manber multi-pattern search, over words.

The symbols of the search are words (runs of ASCII letters and digits and of all characters
beyond ASCII, lower-cased). Patterns are the windows of 10 words of the benchmark items; an
item with fewer words is one window. Windows of one length form one search: a shift table over
blocks of two words says how far the search may move, a zero shift leads to the windows whose
last block hashes to the same bucket, and these are compared word by word with the document.

The windows are dealt to blocks of bounded size; each block is broadcast and searched for in one
pass, and passes follow one another without a shuffle. No document leaves its task.

Nulls, ties and odd input: a null text has no words; items without words have no windows; a null
item_id marks words but is neither counted nor named; repeated items and repeated documents give
the same result as single ones, row by row; empty tables give no hits or no rows. Very long
texts are searched whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowmap import map_arrow
from .scratch import Scratch, rows_of, with_row
from .textarrays import ALNUM, LOWER, U64, Words, byte_chunks, sequence_hashes, words

WINDOW = 10
#: Patterns of one broadcast block: at most this many windows, of about 100 bytes each.
BLOCK_WINDOWS = 200_000
SHIFT_BITS = 20

WINDOWS_SCHEMA = "item_id long, n int, pattern binary"
#: What a search adds to a document: numbers of the words hit, items found, number of words.
HITS, ITEMS, N_WORDS = "_window_hits", "_window_items", "_window_words"


def _word_bytes(data: bytes, w: Words, lo: int, hi: int) -> bytes:
    return b" ".join(data[s:e] for s, e in zip(w.starts[lo:hi].tolist(), w.ends[lo:hi].tolist(), strict=True))


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, n, pattern): the distinct windows of every item, words joined by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for first, data, offsets in byte_chunks(batch.column(1)):
                data = LOWER[data]
                w, raw = words(data, offsets, ALNUM), data.tobytes()
                for r, (lo, hi) in enumerate(zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True)):
                    n = min(size, hi - lo)
                    if n:
                        out += {(ids[first + r], n, _word_bytes(raw, w, i, i + n)) for i in range(lo, hi - n + 1)}
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
                ["item_id", "n", "pattern"],
            )

    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return map_arrow(items, cut, WINDOWS_SCHEMA).distinct()


class _Search:
    """Wu-Manber tables for the windows of one length."""

    def __init__(self, size: int, patterns: list[bytes], items: list[list[int]]) -> None:
        self.size, self.block = size, min(2, size)
        joined = pa.array(patterns, pa.binary())
        ((_, data, offsets),) = byte_chunks(joined, 1 << 62)
        hashes = words(data, offsets, ALNUM, lower=False).hashes.reshape(len(patterns), size)
        reach = size - self.block + 1
        self.shift = np.full(1 << SHIFT_BITS, reach, np.uint8)
        for j in range(reach):
            # A block that ends j words before the end of some window allows a shift of j at most.
            at = size - self.block - j
            slots = self.slots(sum_blocks(hashes[:, at : at + self.block]))
            self.shift[slots] = np.minimum(self.shift[slots], j)
        self.buckets: dict[int, list[tuple[bytes, list[int]]]] = {}
        last = sum_blocks(hashes[:, size - self.block :])
        for key, pattern, found in zip(last.tolist(), patterns, items, strict=True):
            self.buckets.setdefault(key, []).append((pattern, found))

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        return (keys >> U64(64 - SHIFT_BITS)).astype(np.int64)

    def matches(self, raw: bytes, w: Words) -> Iterator[tuple[int, int, list[int]]]:
        """(row, first word, items) of every occurrence in a run of rows."""
        keys = sequence_hashes(w.hashes, self.block)
        shifts = self.shift[self.slots(keys)].tobytes()
        head, tail = self.size - self.block, self.size
        for r, (lo, hi) in enumerate(zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True)):
            at, end = lo + head, hi - self.block
            while at <= end:
                step = shifts[at]
                if step:
                    at += step
                    continue
                bucket = self.buckets.get(int(keys[at]))
                if bucket:
                    text = _word_bytes(raw, w, at - head, at - head + tail)
                    for pattern, items in bucket:
                        if pattern == text:
                            yield r, at - head, items
                at += 1


def sum_blocks(hashes: np.ndarray) -> np.ndarray:
    """Hash of each row of a matrix of word hashes, as ``sequence_hashes`` gives it."""
    size = hashes.shape[1]
    return sequence_hashes(hashes.reshape(-1), size)[::size]


def _pass(windows: list[tuple[int, bytes, list[int]]], text_column: str, first: bool, returned: list[str]):
    """One pass over documents: adds what the windows of one block hit to what is there."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = []
        for n in sorted({n for n, _, _ in windows}):
            own = [(p, i) for m, p, i in windows if m == n]
            searches.append(_Search(n, [p for p, _ in own], [i for _, i in own]))
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            if first:
                hits: list[set] = [set() for _ in range(batch.num_rows)]
                items: list[set] = [set() for _ in range(batch.num_rows)]
                n_words = np.zeros(batch.num_rows, np.int64)
            else:
                hits, items = ([set(x) for x in column[c].to_pylist()] for c in (HITS, ITEMS))
                n_words = column[N_WORDS].to_numpy()
            for row, data, offsets in byte_chunks(column[text_column]):
                data = LOWER[data]
                w, raw = words(data, offsets, ALNUM, lower=False), data.tobytes()
                if first:
                    n_words[row : row + len(offsets) - 1] = np.diff(w.rows)
                for s in searches:
                    for r, at, found in s.matches(raw, w):
                        at -= int(w.rows[r])
                        hits[row + r].update(range(at, at + s.size))
                        items[row + r].update(found)
            column[HITS] = pa.array([sorted(x) for x in hits], pa.list_(pa.int32()))
            column[ITEMS] = pa.array([sorted(x) for x in items], pa.list_(pa.int64()))
            column[N_WORDS] = pa.array(n_words, pa.int64())
            yield pa.RecordBatch.from_arrays([column[c] for c in returned], returned)

    return search


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    returned: list[str] | None = None,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Columns of ``docs`` (all, or those in ``returned``) plus HITS (word numbers), ITEMS, N_WORDS."""
    with Scratch(docs.sparkSession) as scratch:
        # One row per distinct window with the items it stands in.
        windows = item_windows(benchmark, size).groupBy("n", "pattern").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        stored = scratch.put(windows, "windows")
        blocks = max(1, -(-stored.count() // block_windows))
        block = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
        found = T.StructType(
            [
                T.StructField(HITS, T.ArrayType(T.IntegerType())),
                T.StructField(ITEMS, T.ArrayType(T.LongType())),
                T.StructField(N_WORDS, T.LongType()),
            ]
        )
        out = docs
        for b in range(blocks):
            part = [(r["n"], bytes(r["pattern"]), list(r["items"])) for r in stored.where(block == b).toLocalIterator()]
            names = returned if returned is not None and b == blocks - 1 else docs.columns
            schema = T.StructType([docs.schema[c] for c in names] + found.fields)
            out = map_arrow(out, _pass(part, "text", b == 0, schema.names), schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    names = F.array_join(F.array_sort(F.transform(ITEMS, lambda i: i.cast("string"))), ",")
    n_hit = F.size(HITS).cast("bigint")
    return find_windows(texts, benchmark, size, ["doc_id"]).select(
        "doc_id",
        F.col(N_WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ITEMS).cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window, with their columns as they were."""
    found = find_windows(with_row(docs), benchmark, size)
    return rows_of(found.where(F.size(HITS) == 0), docs.columns)
