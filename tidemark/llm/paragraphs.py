"""Substring dedup: paragraph MinHash banding with exact confirmation and components, and repeated runs.

A paragraph is a line of a document. Lines of more than 20 words are cut further, before words
whose hash (with the next word) is the least among six words on either side. Such cuts depend
on nearby words only, so a passage quoted in the middle of a longer line is cut as it is
elsewhere, and its inner pieces are paragraphs of their own. Repeated passages do not keep to lines or
pieces: every window of 14 words, line breaks or not, that stands somewhere before is repeated, and so a
passage is covered from its first word to its last. Phrases are left alone: what goes is a run of
repeated paragraphs and windows that follow on one another, of 14 words or more together and with one
of 7 words or more among them. Of a long line with a few words changed these words stay.

Sets are the distinct 5-word shingles of a paragraph. With shingles from rare to frequent, sets
of n at a similarity of 0.75 share one of the first n - ceil(0.75 n) + 1 of either; up to 63 shingles
these are the keys, and no pair is lost. Larger sets have 16 bands of two MinHash values (0.999998 at
0.75). Keys under which many unlike paragraphs meet are divided by finer ones. Colliding
paragraphs are compared on their sets (32-bit hashes; Jaccard 0.75), linked
ones form components, and of each component the first paragraph in the order of (doc_id,
position) stays. Equal paragraphs are one node throughout, so a line that stands in a third of
all documents is one node and one count.

Of the 7-word sequences of a window the one with the least hash is its seed. Windows are written out
only around seeds that occur twice, and of equal windows the first in the order of (doc_id, position)
stays; one that overlaps it does not count as repeated.

Texts are held in blocks of about 4 MB. What has to meet (paragraphs, keys, seeds, windows) is sent as
packed values from each block to buckets by range of its hash, distinct values of a block once, and a bucket
answers every block in which a value occurs that occurs elsewhere too. So Spark shuffles a row for each block and
bucket, not for each value, and a line that stands everywhere takes one place for each block.

Nulls, ties and odd input: a null text stays null and has no paragraphs; documents without
removals keep their text byte for byte; rows equal in doc_id and text are one document and are
cut alike; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowmap import map_arrow
from .linking import link_by_keys
from .scratch import Scratch
from .textarrays import U64, Words, byte_chunks, mix, sequence_hashes, words

SIZE = 5
LONG_LINE, REACH, LEAST_WORDS, LEAST_RUN = 20, 6, 7, 14
PERCENT = 75
#: Sets of up to so many shingles have their first shingles as keys. Sets of 48 or more, which may be
#: similar to larger ones, have bands.
FIRST_UPTO, BANDED_FROM, BANDS, ROWS = 63, 48, 16, 2
#: Bands of the finer keys of larger sets. Neighbouring sizes overlap, as similar sets differ in size.
FINER_BANDS, FINER_ROWS = 128, 8
#: How many frequent shingles are known by their number, and shingles that are counted at a time.
COMMON, RUN_OF_SHINGLES = 500_000, 1 << 20
#: Bits of a position that are the number of a word in its text. A text has fewer words than that (2 GiB at most).
WORD_BITS = 30
#: Words of a seed, and how many seeds a window of LEAST_RUN words has to choose from.
SEED = 7
CHOICE = LEAST_RUN - SEED + 1
#: Bytes of text in a block, and bytes of text for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
_FINER = np.random.default_rng(29).integers(1, 1 << 62, (FINER_BANDS * FINER_ROWS, 1), dtype=U64) * U64(2) + U64(1)
_SEEDS = np.random.default_rng(11).integers(1, 1 << 62, BANDS * ROWS, dtype=U64) * U64(2) + U64(1)


def _cuts(hashes: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Marks words before which a line is cut, if the line is a long one."""
    g = np.full(len(hashes), np.iinfo(U64).max, U64)
    g[:-1] = sequence_hashes(hashes, 2)
    least = np.ones(len(g), bool)
    for j in range(1, REACH + 1):
        same = line[j:] == line[:-j]
        least[j:] &= ~same | (g[j:] < g[:-j])
        least[:-j] &= ~same | (g[:-j] <= g[j:])
    return least


def split(data: np.ndarray, offsets: np.ndarray):
    """Paragraphs of a run of rows: row, first word, the word after the last, and words."""
    w = words(data, offsets)
    row = w.row_of()
    feeds = np.flatnonzero(data == 10)
    line = np.searchsorted(feeds, w.starts) + row  # rises with lines and with rows
    if not len(row):
        none = np.zeros(0, np.int64)
        return none, none, none, w
    new_line = np.ones(len(line), bool)
    new_line[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
    firsts = np.flatnonzero(new_line)
    length = np.diff(np.append(firsts, len(line)))
    number = np.cumsum(new_line) - 1
    begins = new_line | (_cuts(w.hashes, number) & (length > LONG_LINE)[number])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(line))
    return row[first], first, last, w


def _stops(w: Words, data: np.ndarray, offsets: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the bytes of words up to ``last`` end: at the next word of the line, or at the line's end."""
    feeds = np.flatnonzero(data == 10)
    row = w.row_of()
    line = np.searchsorted(feeds, w.starts) + row
    before = last - 1
    feed = np.append(feeds, len(data))[np.searchsorted(feeds, w.ends[before])]
    line_end = np.minimum(feed, offsets[1:][row[before]])
    after = np.minimum(last, len(line) - 1)
    goes_on = (after == last) & (line[after] == line[before]) & (row[after] == row[before])
    return np.where(goes_on, w.starts[after], line_end)


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, row, ord): documents that differ in doc_id or text, numbered in the order of (doc_id, row)."""
    ranged = docs.select("doc_id", "row").distinct().repartitionByRange("doc_id", "row")
    return ranged.sortWithinPartitions("doc_id", "row").select("doc_id", "row", F.monotonically_increasing_id().alias("ord"))


def dense(ids: DataFrame) -> DataFrame:
    """``ids``, a stored table of ``numbered``, with numbers that leave no gaps between its slices."""
    cut = F.shiftright("ord", 33)
    sizes = ids.groupBy(cut.alias("slice")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("slice", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.col("ord").bitwiseAND(F.lit((1 << 33) - 1))
    return ids.join(starts, cut == F.col("slice")).select("doc_id", "row", (inside + F.col("before")).alias("ord"))


def _positions(ord_: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Numbers of words in the order of all texts."""
    return (ord_.astype(np.int64) << WORD_BITS) | word.astype(np.int64)


def blocks(texts: DataFrame) -> DataFrame:
    """``texts`` (ord, text) in runs of about ``BLOCK_BYTES``: (block, size, ords, offsets, data), the last three packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ords = batch.column(0).to_numpy().astype(np.int64)
            for base, data, offsets in byte_chunks(batch.column(1), BLOCK_BYTES):
                own = ords[base : base + len(offsets) - 1]
                row = [[number], [len(data)], [own.tobytes()], [offsets.astype(np.int64).tobytes()], [data.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["block", "size", "ords", "offsets", "data"])
                number += 1

    return map_arrow(texts, run, "block long, size long, ords binary, offsets binary, data binary")


def _texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, pa.Array]]:
    """(row, block, ords, texts) of each row of ``blocks``."""
    for i in range(batch.num_rows):
        ords, offsets = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("ords", "offsets"))
        buffers = [None, pa.py_buffer(offsets), batch.column("data")[i].as_buffer()]
        yield i, batch.column("block")[i].as_py(), ords, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ords), buffers)


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Values packed as one binary for each range between ``edges``."""
    offs = pa.py_buffer((np.asarray(edges) * values.itemsize).astype(np.int32).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, offs, pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _one(values: np.ndarray) -> pa.Array:
    return _binary(values, np.array([0, len(values)]))


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts ``values``; in it, where each distinct one begins, and which of these each is."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _least(values: np.ndarray, at: np.ndarray, most: bool = False) -> np.ndarray:
    if not len(at):
        return values[:0]
    return (np.maximum if most else np.minimum).reduceat(values, at)


def _edges(ranked: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that sorted values fall into, and where these begin and end."""
    of = ((ranked >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
    edges = np.searchsorted(of, np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(edges))
    return some, np.append(edges[some], len(ranked))


_DEALT = "bucket int, block long, value binary, mark binary, several binary, pos binary, lo binary"
_MET = "block long, lo binary, first binary, pos binary, later_lo binary"


def _dealt(block: int, values: np.ndarray, marks: np.ndarray, buckets: int, pos: np.ndarray | None = None, lo: np.ndarray | None = None):
    """Rows of ``_DEALT``: the distinct values of a block with their least marks, and whether they have several.

    With ``pos``, a row of (``pos``, ``lo``) more, which the block gets back with the answers.
    """
    order, at, group = _groups(values)
    ranked, marks = values[order], marks[order]
    least = _least(marks, at)
    several = np.zeros(len(at), np.uint8)
    several[group[marks != least[group]]] = 1
    some, edges = _edges(ranked[at], buckets)
    n = len(some)
    nothing = pa.nulls(n, pa.binary())
    columns = [
        pa.array(some.astype(np.int32)), pa.array(np.full(n, block, np.int64)),
        _binary(ranked[at], edges), _binary(least, edges), _binary(several, edges), nothing, nothing,
    ]
    names = [c.split()[0] for c in _DEALT.split(", ")]
    yield pa.RecordBatch.from_arrays(columns, names)
    if pos is not None and len(pos):
        none = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([(block + (block >> 32)) % buckets], pa.int32()), pa.array([block]), none, none, none, _one(pos), _one(lo)], names
        )


def _later(values: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of all but the least of each value, and that least one."""
    order, at, group = _groups(values)
    marks = marks[order]
    least = _least(marks, at)[group]
    return marks[marks != least], least[marks != least]


def _packed(column: pa.Array | pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed ones, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column, b"").cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    if held.ctypes.data % np.dtype(dtype).itemsize:
        held = held.copy()
    return held.view(dtype), np.diff(offs) // np.dtype(dtype).itemsize


def met(dealt: DataFrame) -> DataFrame:
    """Rows of ``_MET``: for each block the values with several marks in all, as their least mark in it (lo) and of all."""

    def run(table: pa.Table) -> pa.Table:
        values, n = _packed(table["value"], U64)
        marks, several = _packed(table["mark"], np.int64)[0], _packed(table["several"], np.uint8)[0]
        order, at, group = _groups(values)
        first = _least(marks[order], at)
        more = (first < _least(marks[order], at, most=True)) | (_least(several[order], at, most=True) > 0)
        wanted, least = np.zeros(len(values), bool), np.zeros_like(marks)
        wanted[order], least[order] = more[group], first[group]
        row = np.repeat(np.arange(len(n)), n)
        edges = np.append(0, np.cumsum(np.bincount(row[wanted], minlength=len(n))))
        columns = [table["block"], _binary(marks[wanted], edges), _binary(least[wanted], edges), table["pos"], table["lo"]]
        out = pa.table(columns, names=[c.split()[0] for c in _MET.split(", ")])
        return out.filter(pc.or_(pa.array(np.diff(edges) > 0), pc.is_valid(table["pos"])))

    return dealt.groupBy("bucket").applyInArrow(run, _MET)


def paragraphs(texts: DataFrame) -> DataFrame:
    """The distinct paragraphs of each block of ``texts``, packed: unit, lo, n_words, size, shingles; and pos, later_lo.

    ``unit`` is a hash of the words, ``lo`` the position of the first copy in the block, ``size`` and ``shingles``
    the set as 32-bit values; ``pos`` are the positions of further copies, ``later_lo`` those of their first ones.
    """

    def of_texts(data: np.ndarray, offsets: np.ndarray, ords: np.ndarray) -> tuple[np.ndarray, ...]:
        row, first, last, w = split(data, offsets)
        shingles = sequence_hashes(w.hashes, SIZE)
        # The hash of a paragraph: a sum over its words and places. Paragraphs follow on one another.
        place = np.arange(len(w.hashes)) - np.repeat(first, last - first)
        unit = np.zeros(len(first), U64)
        if len(first):
            unit = mix(np.add.reduceat(mix(w.hashes + place.astype(U64) * U64(0x9E3779B97F4A7C15)), first))
        # A paragraph of fewer words than a shingle is one shingle.
        short = last - first < SIZE
        own = np.repeat(np.arange(len(first)), np.where(short, 1, last - first - SIZE + 1))
        value = np.zeros(len(own), U64)
        value[short[own]] = unit[short] >> U64(32)
        value[~short[own]] = shingles[np.flatnonzero(place + SIZE <= np.repeat(last - first, last - first))] >> U64(32)
        sets = np.sort(own.astype(U64) << U64(32) | value)
        new = np.ones(len(sets), bool)
        new[1:] = sets[1:] != sets[:-1]
        sets = sets[new]
        size = np.diff(np.searchsorted(sets >> U64(32), np.arange(len(first) + 1).astype(U64)))
        pos = _positions(ords[row], first - w.rows[row])
        return unit, pos, (last - first).astype(np.int32), size.astype(np.int32), (sets & U64(0xFFFFFFFF)).astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block, ords, column in _texts_of(batch):
                parts = [of_texts(data, offsets, ords[base:]) for base, data, offsets in byte_chunks(column)]
                unit, pos, n_words, size, sets = (np.concatenate(x) for x in zip(*parts, strict=True))
                order, at, _ = _groups(unit)
                one = order[at]
                begin = (np.cumsum(size) - size)[one]
                inside = np.arange(size[one].sum()) - np.repeat(np.cumsum(size[one]) - size[one], size[one])
                packed = unit[one], _least(pos[order], at), n_words[one], size[one], sets[np.repeat(begin, size[one]) + inside]
                columns = [pa.array([block]), *(_one(x) for x in (*packed, *_later(unit, pos)))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _UNITS.split(", ")])

    return map_arrow(texts, run, _UNITS)


_UNITS = "block long, unit binary, lo binary, n_words binary, size binary, shingles binary, pos binary, later_lo binary"


def _first(n: np.ndarray | int, share: int = 1) -> np.ndarray | int:
    """Of so many shingles in order, how many hold the first ``share`` that are in any similar set."""
    return n + (-n * PERCENT) // 100 + share


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed sets, and the size of each set."""
    return _packed(column, np.uint32)


def common_shingles(units: DataFrame, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur often, sorted, and how often.

    What a run of about a million shingles holds twice or more (``every``: or once) is added up; of the sums the
    ``COMMON`` largest come to the driver, at most 12 bytes each. They settle only the order of shingles, any
    of which is right.
    """
    least = 1 if every else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(values[n >= least].astype(np.int64)), pa.array(n[n >= least].astype(np.int64))], ["value", "n"]
            )

        for batch in batches:
            if batch.num_rows:
                held.append(_flat(batch.column(0))[0])
                if sum(map(len, held)) >= RUN_OF_SHINGLES:
                    yield counted()
        if held:
            yield counted()

    counts = map_arrow(units.select("shingles"), run, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")).where("n > 1")
    most = counts.orderBy(F.desc("n"), "value").limit(COMMON).toArrow()
    values, n = most["value"].to_numpy().astype(np.uint32), most["n"].to_numpy()
    order = np.argsort(values)
    return values[order], n[order]


def _rarest_first(values: np.ndarray, n: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The values of each set in the order of how often they occur, then of their hashes."""
    if not len(common[0]) or not len(values):
        return values
    at = np.minimum(np.searchsorted(common[0], values), len(common[0]) - 1)
    by_rank = np.lexsort(common)
    rank = np.empty(len(by_rank), U64)
    rank[by_rank] = np.arange(len(by_rank), dtype=U64)
    # The set, whether the value is a common one, and its rank or else the value, in one number.
    code = np.where(common[0][at] == values, rank[at] | U64(1 << 32), values.astype(U64))
    code = np.sort(code | np.repeat(np.arange(len(n)), n).astype(U64) << U64(33))
    low = code & U64(0xFFFFFFFF)
    ranked = (code & U64(1 << 32)) > 0
    return np.where(ranked, common[0][by_rank][np.where(ranked, low, U64(0))], low).astype(np.uint32)


def _first_keys(values: np.ndarray, n: np.ndarray, units: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys, units, sizes, and how many values are left from the key on, for the first values of sets in order."""
    at = np.cumsum(n) - n
    # Any order that all sets share will do; the rarest first have the fewest in common by chance.
    small = np.flatnonzero(n <= FIRST_UPTO)
    many = _first(n[small])
    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    size = np.repeat(n[small], many)
    first = mix(values[np.repeat(at[small], many) + place].astype(U64) + U64(1))
    return first, np.repeat(units[small], many), size, size - place


_KEYS = "key long, {} long, n int, rest int"


def _key_rows(name: str, key: np.ndarray, unit: np.ndarray, n: np.ndarray | None = None, rest: np.ndarray | None = None):
    of_sets = [pa.nulls(len(key), pa.int32()) if x is None else pa.array(x.astype(np.int32)) for x in (n, rest)]
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(unit), *of_sets], ["key", name, "n", "rest"])


def set_keys(units: DataFrame, common: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(key, unit, n, rest): the keys under which every paragraph meets those similar to it.

    ``common``: shingles that come last in the order, and how often they occur. ``n`` and ``rest`` are the size
    of the set and the number of its shingles from the key on, null for bands.
    """
    nothing = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    shared = units.sparkSession.sparkContext.broadcast(nothing if common is None else common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for rows in _set_keys(*_flat(batch.column(1)), batch.column(0).to_numpy(), shared.value):
                    yield _key_rows("unit", *rows)

    return map_arrow(units.select("unit", "shingles"), run, _KEYS.format("unit"))


def _set_keys(values: np.ndarray, n: np.ndarray, units: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple]:
    """Keys, units and, but for bands, sizes and what is left."""
    values = _rarest_first(values, n, common).astype(U64)
    yield _first_keys(values, n, units)
    large = n >= BANDED_FROM
    if not large.any():
        return
    held = values[np.repeat(large, n)]
    at = np.cumsum(n[large]) - n[large]
    least = [np.minimum.reduceat(mix(held * s + s), at) for s in _SEEDS]
    for band in range(BANDS):
        key = sum(least[band * ROWS + r] * _SEEDS[r] for r in range(ROWS)) + U64(band)
        yield mix(key), units[large]


def open_members(units: DataFrame, common: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(key, node, n, rest, block): the keys that unlike paragraphs share, once for each block (``units`` of ``paragraphs``)."""
    shared = units.sparkSession.sparkContext.broadcast(common)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                unit, sets = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("unit", np.int64), ("shingles", np.uint32)))
                sizes = np.frombuffer(batch.column("size")[i].as_buffer(), np.int32).astype(np.int64)
                rows = []
                for key, node, *of_sets in _set_keys(sets, sizes, unit, shared.value):
                    # None has more than FIRST_UPTO; zero stands for not known.
                    n, rest = of_sets or (np.zeros(len(key), np.uint8),) * 2
                    rows.append((key, node, n.astype(np.uint8), rest.astype(np.uint8)))
                key, node, n, rest = (np.concatenate(x) for x in zip(*rows, strict=True))
                order = np.argsort(key)
                some, edges = _edges(key[order], buckets)
                columns = [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), batch.column("block")[i].as_py(), np.int64))]
                columns += [_binary(x[order], edges) for x in (key, node, n, rest)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "key", "node", "n", "rest"])

    def meet(table: pa.Table) -> pa.Table:
        key, many = _packed(table["key"], U64)
        node = _packed(table["node"], np.int64)[0]
        order, at, group = _groups(key)
        ranked = node[order]
        mine = order[(_least(ranked, at) < _least(ranked, at, most=True))[group]]
        of_sets = [_packed(table[c], np.uint8)[0][mine].astype(np.int32) for c in ("n", "rest")]
        block = table["block"].to_numpy()[np.repeat(np.arange(len(many)), many)[mine]]
        known = [pa.array(x, mask=of_sets[0] == 0) for x in of_sets]
        return pa.table([pa.array(key[mine].view(np.int64)), pa.array(node[mine]), *known, pa.array(block)], names=["key", "node", "n", "rest", "block"])

    dealt = map_arrow(units.select("block", "unit", "size", "shingles"), deal, "bucket int, block long, key binary, node binary, n binary, rest binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "key long, node long, n int, rest int, block long")


def held_units(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(block, unit, lo, shingles) of the ``nodes`` (block, nodes) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                unit, lo = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("unit", "lo"))
                size = np.frombuffer(batch.column("size")[i].as_buffer(), np.int32).astype(np.int64)
                sets = np.frombuffer(batch.column("shingles")[i].as_buffer(), np.uint32)
                mine = np.isin(unit, batch.column("nodes")[i].values.to_numpy())
                edges = np.append(0, np.cumsum(size[mine]))
                block = np.full(mine.sum(), batch.column("block")[i].as_py(), np.int64)
                columns = [pa.array(block), pa.array(unit[mine]), pa.array(lo[mine]), _binary(sets[np.repeat(mine, size)], edges)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "unit", "lo", "shingles"])

    joined = units.join(nodes, "block").select("block", "unit", "lo", "size", "shingles", "nodes")
    return map_arrow(joined, run, "block long, unit long, lo long, shingles binary")


def finer_keys(sets: DataFrame) -> DataFrame:
    """(key, node, n, rest) that unlike paragraphs seldom share.

    The shingles of these sets alone are counted, so that their rarest are the keys; what only one of them
    has takes its place in the order and meets nothing. Sets are no longer than for ``set_keys``, and no pair is
    lost. Sets of more than 63 shingles have 128 bands of 8 values (0.999998 at 0.75).
    """
    shared = sets.sparkSession.sparkContext.broadcast(common_shingles(sets, every=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, n = _flat(batch.column(1))
            values = _rarest_first(values, n, shared.value)
            nodes = batch.column(0).to_numpy()
            key, *rest = _first_keys(values, n, nodes)
            # Inverted, as keys of all sets may be left beside these.
            yield _key_rows("node", ~key, *rest)
            at = np.cumsum(n) - n
            for i in np.flatnonzero(n >= BANDED_FROM).tolist():
                members = mix(values[at[i] : at[i] + n[i]].astype(U64) + U64(1))
                least = mix(members * _FINER + _FINER).min(1).reshape(FINER_BANDS, FINER_ROWS)
                key = np.unique(mix((least * _FINER[:FINER_ROWS, 0]).sum(1, dtype=U64) + np.arange(FINER_BANDS).astype(U64)))
                yield _key_rows("node", key, np.full(len(key), nodes[i], np.int64))

    return map_arrow(sets.select("unit", "shingles"), run, _KEYS.format("node"))


def _seeds(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows of LEAST_RUN words, the first words of their seeds, and hashes of all seeds there may be."""
    n = len(hashes) - LEAST_RUN + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    keys = sequence_hashes(hashes, SEED)
    # The place in the window takes the bits that CHOICE needs.
    high = keys & ~U64(CHOICE - 1)
    best = high[:n].copy()
    for j in range(1, CHOICE):
        np.minimum(best, high[j : j + n] | U64(j), out=best)
    inside = np.ones(n, bool)
    for edge in rows[1:-1].tolist():
        inside[max(0, edge - LEAST_RUN + 1) : edge] = False
    windows = np.flatnonzero(inside)
    return windows, windows + (best[windows] & U64(CHOICE - 1)).astype(np.int64), keys


def repeated_seeds(texts: DataFrame, buckets: int) -> DataFrame:
    """(block, seeds): of each block the seeds that occur twice or more, packed, in a row or more."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block, _, column in _texts_of(batch):
                found = []
                for _, data, offsets in byte_chunks(column):
                    w = words(data, offsets)
                    _, at, keys = _seeds(w.hashes, w.rows)
                    found.append(keys[np.unique(at)])
                ranked = np.sort(np.concatenate(found))
                new = np.ones(len(ranked), bool)
                new[1:] = ranked[1:] != ranked[:-1]
                several = np.zeros(len(ranked), bool)
                several[:-1] = ~new[1:]
                some, edges = _edges(ranked[new], buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array(np.full(len(some), block, np.int64)),
                        _binary(ranked[new], edges),
                        _binary(several[new].view(np.uint8), edges),
                    ],
                    ["bucket", "block", "value", "several"],
                )

    def meet(table: pa.Table) -> pa.Table:
        values, n = _packed(table["value"], U64)
        order, at, group = _groups(values)
        several = _least(_packed(table["several"], np.uint8)[0][order], at, most=True) > 0
        wanted = np.zeros(len(values), bool)
        wanted[order] = (several | (np.diff(np.append(at, len(values))) > 1))[group]
        edges = np.append(0, np.cumsum(np.bincount(np.repeat(np.arange(len(n)), n)[wanted], minlength=len(n))))
        out = pa.table([table["block"], _binary(values[wanted], edges)], names=["block", "seeds"])
        return out.filter(pa.array(np.diff(edges) > 0))

    dealt = map_arrow(texts, deal, "bucket int, block long, value binary, several binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "block long, seeds binary")


def windows(held: DataFrame, buckets: int) -> DataFrame:
    """The windows of each block of texts around ``seeds`` (a list of packed ones), dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block, ords, column in _texts_of(batch):
                wanted = np.sort(_packed(batch.column("seeds")[i].values, U64)[0])
                found, pos = [], []
                for base, data, offsets in byte_chunks(column):
                    w = words(data, offsets)
                    first, seed, keys = _seeds(w.hashes, w.rows)
                    at = np.unique(seed)
                    mine = np.zeros(len(w.hashes) + 1, bool)
                    mine[at] = wanted[np.minimum(np.searchsorted(wanted, keys[at]), len(wanted) - 1)] == keys[at]
                    first = first[mine[seed]]
                    own = np.searchsorted(w.rows, first, "right") - 1
                    found.append(sequence_hashes(w.hashes, LEAST_RUN)[first])
                    pos.append(_positions(ords[own + base], first - w.rows[own]))
                values, marks = np.concatenate(found), np.concatenate(pos)
                yield from _dealt(block, values, marks, buckets, *_later(values, marks))

    return map_arrow(held, run, _DEALT)


def repeated_windows(texts: DataFrame, scratch: Scratch, buckets: int) -> DataFrame:
    """(block, lo, first, pos, later_lo) of windows that stand elsewhere as well. ``texts``: a stored table of ``blocks``, which goes."""
    found = scratch.put(repeated_seeds(texts, buckets), "par-seeds")
    wanted = found.groupBy("block").agg(F.collect_list("seeds").alias("seeds"))
    # In a table of their own, so that the texts, and what was shuffled of them, are gone when windows meet.
    dealt = scratch.put(windows(texts.join(wanted, "block"), buckets), "par-dealt")
    scratch.drop(found)
    scratch.drop(texts)
    out = scratch.put(met(dealt), "par-windows")
    scratch.drop(dealt)
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep[i] = common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common)
        yield batch.select([0, 1]).filter(pa.array(keep))


def duplicate_spans(texts: DataFrame, scratch: Scratch, buckets: int) -> DataFrame:
    """(block, pos, first, n_words), packed, of every paragraph that repeats an earlier one.

    ``texts``: a stored table of ``blocks``. ``first`` is the position of the earliest copy.
    """
    units = scratch.put(paragraphs(texts), "par-units")
    found = scratch.put(open_members(units, common_shingles(units), buckets), "par-open")
    members = scratch.put(found.select("key", "node", "n", "rest").distinct(), "par-members")
    held = scratch.put(held_units(units, found.groupBy("block").agg(F.collect_set("node").alias("nodes"))), "par-held")
    scratch.drop(found)
    sets = scratch.put(held.groupBy("unit").agg(F.any_value("shingles").alias("shingles"), F.min("lo").alias("lo")), "par-sets")

    def confirm(found: DataFrame) -> DataFrame:
        sa = sets.select(F.col("unit").alias("a"), F.col("shingles").alias("xa"))
        sb = sets.select(F.col("unit").alias("b"), F.col("shingles").alias("xb"))
        joined = found.join(sa, "a").join(sb, "b").select("a", "b", "xa", "xb")
        return map_arrow(joined, _compare, "a long, b long")

    def finer(nodes: DataFrame) -> DataFrame:
        return finer_keys(sets.join(nodes, sets["unit"] == nodes["node"], "left_semi"))

    roots = link_by_keys(members, confirm, scratch, "par", finer)
    # The first copies of linked paragraphs are those of their components.
    placed = roots.join(sets.select(F.col("unit").alias("node"), "lo"), "node")
    firsts = placed.groupBy("root").agg(F.min("lo").alias("first"))
    linked = roots.join(firsts, "root").select(F.col("node").alias("unit"), "first")
    linked = held.select("block", "unit", "lo").join(linked, "unit")
    linked = linked.groupBy("block").agg(F.collect_list(F.struct("lo", "first")).alias("linked"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = {c: np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("unit", U64), ("lo", np.int64), ("later_lo", np.int64))}
                values = np.concatenate([own["unit"], own["unit"][_at(own["lo"], own["later_lo"])]])
                further = np.frombuffer(batch.column("pos")[i].as_buffer(), np.int64)
                yield from _dealt(batch.column("block")[i].as_py(), values, np.concatenate([own["lo"], further]), buckets)

    dealt = map_arrow(units.select("block", "unit", "lo", "pos", "later_lo"), deal, _DEALT)
    answers = met(dealt).groupBy("block").agg(F.collect_list(F.struct("lo", "first")).alias("answers"))
    joined = units.select("block", "lo", "n_words", "pos", "later_lo").join(answers, "block", "left").join(linked, "block", "left")
    out = scratch.put(map_arrow(joined, _copies, "block long, pos binary, first binary, n_words binary"), "par-copies")
    for table in (units, members, held, sets):
        scratch.drop(table)
    return out


def _at(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where ``values``, distinct ones in any order, hold those that are wanted."""
    order = np.argsort(values)
    return order[np.searchsorted(values[order], wanted)]


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paragraphs of each block that stand after the first copy; what is linked goes before what is equal."""
    for batch in batches:
        for i in range(batch.num_rows):
            lo, pos, later_lo = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("lo", "pos", "later_lo"))
            n_words = np.frombuffer(batch.column("n_words")[i].as_buffer(), np.int32)
            first = lo.copy()
            answers, linked = batch.column("answers")[i].values, batch.column("linked")[i].values
            if answers is not None:
                own, least = (_packed(pc.struct_field(answers, c), np.int64)[0] for c in ("lo", "first"))
                first[_at(lo, own)] = least
            if linked is not None:
                first[_at(lo, pc.struct_field(linked, "lo").to_numpy())] = pc.struct_field(linked, "first").to_numpy()
            of = np.concatenate([np.arange(len(lo)), _at(lo, later_lo)])
            pos, first, n_words = np.concatenate([lo, pos]), first[of], n_words[of]
            over = pos > first
            columns = [batch.column("block").slice(i, 1), *(_one(x[over]) for x in (pos, first, n_words))]
            yield pa.RecordBatch.from_arrays(columns, ["block", "pos", "first", "n_words"])


def runs_of(copies: DataFrame, repeats: DataFrame) -> DataFrame:
    """(ord, place, n_words, most, first_ord): runs of paragraphs and windows, one for each of their first documents.

    ``copies`` of ``duplicate_spans``, ``repeats`` of ``repeated_windows``.
    """

    def run(table: pa.Table) -> pa.Table:
        own = table.filter(pc.is_valid(table["n_words"]))
        pos, first = (_packed(own[c], np.int64)[0] for c in ("lo", "first"))
        n_words = _packed(own["n_words"], np.int32)[0]
        own = table.filter(pc.is_null(table["n_words"]))
        lo, least, further, later_lo = (_packed(own[c], np.int64)[0] for c in ("lo", "first", "pos", "later_lo"))
        places, least = np.concatenate([lo, further]), np.concatenate([least, least[_at(lo, later_lo)]])
        # A copy that overlaps the first does not count. Positions of different texts are further apart.
        apart = places >= least + LEAST_RUN
        n_words = np.concatenate([n_words, np.full(apart.sum(), LEAST_RUN, np.int32)])
        pos, first = np.concatenate([pos, places[apart]]), np.concatenate([first, least[apart]])
        order = np.argsort(pos, kind="stable")
        spans = pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (pos, n_words, first)], ["pos", "n_words", "first"])
        return pa.Table.from_batches(list(_runs(iter([spans]))))

    none = F.lit(None).cast("binary")
    of_copies = copies.select("block", F.col("pos").alias("lo"), "first", none.alias("pos"), none.alias("later_lo"), "n_words")
    of_windows = repeats.select("block", "lo", "first", "pos", "later_lo", none.alias("n_words"))
    schema = "ord long, place int, n_words int, most int, first_ord long"
    return of_copies.union(of_windows).groupBy("block").applyInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (pos, n_words, first) in order that overlap or follow on one another, as one for each first document."""
    names = ["ord", "place", "n_words", "most", "first_ord"]
    open_ = np.zeros((4, 0), np.int64)  # the last run, which may go on: pos, end, longest span, first_ord

    def rows(pos: np.ndarray, end: np.ndarray, most: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        small = [pa.array(x.astype(np.int32)) for x in (pos & ((1 << WORD_BITS) - 1), end - pos, most)]
        return pa.RecordBatch.from_arrays([pa.array(pos >> WORD_BITS), *small, pa.array(first)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        pos, n, first = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
        pos, end, most, first = np.concatenate([open_, [pos, pos + n, n, first >> WORD_BITS]], axis=1)
        new = np.ones(len(pos), bool)
        new[1:] = (pos[1:] > np.maximum.accumulate(end)[:-1]) | (pos[1:] >> WORD_BITS != pos[:-1] >> WORD_BITS)
        at, run = np.flatnonzero(new), np.cumsum(new) - 1
        end, most = np.maximum.reduceat(end, at), np.maximum.reduceat(most, at)
        order = np.lexsort((first, run))
        run, first = run[order], first[order]
        other = np.ones(len(run), bool)
        other[1:] = (run[1:] != run[:-1]) | (first[1:] != first[:-1])
        run, first = run[other], first[other]
        out = np.stack([pos[at][run], end[run], most[run], first])
        over = run < len(at) - 1
        yield rows(*out[:, over])
        open_ = out[:, ~over]
    yield rows(*open_)


def spans_by_document(runs: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, doc_id, _spans) of documents with ``runs`` of ``runs_of``.

    ``ids``: (doc_id, row, ord), a stored table.
    """
    runs = scratch.put(runs, "par-runs")
    first = ids.select(F.col("ord").alias("first_ord"), F.col("doc_id").alias("first_doc"))
    named = runs.join(first, "first_ord").select("ord", F.struct("place", "n_words", "most", "first_doc").alias("span"))
    return named.join(ids, "ord").groupBy("row", "doc_id").agg(F.collect_list("span").alias("_spans"))


def _without(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, spans: tuple[np.ndarray, ...]):
    """What is left of a run of texts: bytes, removed bytes and runs of each text, and the spans that went.

    ``row``: the text of each span; ``spans``: their first words, numbers of words, and longest spans.
    """
    n = len(offsets) - 1
    w = words(data, offsets)
    place, n_words, most = spans
    # The words of all texts in one count, with a number left out between texts.
    begin = w.rows[row] + row + place
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], (begin + n_words)[order]
    new = np.ones(len(begin), bool)
    # Spans overlap or follow on one another directly, or with the end of a line between.
    new[1:] = begin[1:] > np.maximum.accumulate(end)[:-1]
    at = np.flatnonzero(new)
    ends, own = np.maximum.reduceat(end, at), row[order][at]
    long = (np.maximum.reduceat(most[order], at) >= LEAST_WORDS) & (ends - begin[at] >= LEAST_RUN)
    went = np.zeros(len(row), bool)
    went[order] = long[np.cumsum(new) - 1]
    own, start = own[long], w.starts[(begin[at] - own)[long]]
    stop = _stops(w, data, offsets, (ends[long] - own)) if len(own) else start
    feed = np.append(data, 0) == 10
    stop = stop + (((start == offsets[own]) | feed[start - 1]) & (stop < offsets[own + 1]) & feed[stop])
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[stop] -= 1
    left = data[np.cumsum(edge[:-1], dtype=np.int8) == 0]
    removed = np.zeros(n, np.int64)
    np.add.at(removed, own, stop - start)
    return left, removed, np.bincount(own, minlength=n), went


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [c for c in batch.schema.names if c != "_spans"]
        text, spans = batch.column("_text"), batch.column("_spans")
        many = pc.fill_null(pc.list_value_length(spans), 0).to_numpy().astype(np.int64)
        at = np.append(0, np.cumsum(many))
        flat = spans.flatten()
        place, n_words, most = (pc.struct_field(flat, c).to_numpy().astype(np.int64) for c in ("place", "n_words", "most"))
        first_doc = pc.struct_field(flat, "first_doc")
        parts, sizes = [], np.zeros(batch.num_rows, np.int64)
        removed, runs = np.zeros_like(sizes), np.zeros_like(sizes)
        went = np.zeros(len(flat), bool)
        for base, data, offsets in byte_chunks(text):
            end = base + len(offsets) - 1
            mine = slice(at[base], at[end])
            if mine.start < mine.stop:
                row = np.repeat(np.arange(end - base), many[base:end])
                own = place[mine], n_words[mine], most[mine]
                data, removed[base:end], runs[base:end], went[mine] = _without(data, offsets, row, own)
            parts.append(data)
            sizes[base:end] = np.diff(offsets) - removed[base:end]
        ends = pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int32).tobytes())
        joined = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        left = pa.StringArray.from_buffers(batch.num_rows, ends, pa.py_buffer(joined.tobytes()))
        column = {c: batch.column(c) for c in names}
        column["_text"] = pc.if_else(pc.is_valid(text), left, pa.scalar(None, pa.string()))
        added = [pa.array(removed), pa.array(runs), _first_docs(first_doc, np.repeat(np.arange(batch.num_rows), many), went, batch.num_rows)]
        yield pa.RecordBatch.from_arrays([*(column[c] for c in names), *added], [*names, REMOVED, SPANS, FIRST_DOCS])


def _first_docs(first_doc: pa.Array, row: np.ndarray, went: np.ndarray, n: int) -> pa.Array:
    """Per row the distinct documents, sorted, that hold the first copies of the spans that went."""
    known = went & first_doc.is_valid().to_numpy(zero_copy_only=False)
    row, doc = row[known], pc.fill_null(first_doc, 0).to_numpy()[known]
    order = np.lexsort((doc, row))
    row, doc = row[order], doc[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (doc[1:] != doc[:-1])
    offsets = np.append(0, np.cumsum(np.bincount(row[new], minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(doc[new]))


#: What the cut adds to a document: bytes and spans removed, and where the first copies are.
REMOVED, SPANS, FIRST_DOCS = "_removed", "_runs", "_first_docs"


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(_rest: all columns but the text, _text without repeats, REMOVED, SPANS, FIRST_DOCS)."""
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("bigint")
    with Scratch(docs.sparkSession) as scratch:
        keyed = docs.select(F.xxhash64(text).alias("row"), doc_id.alias("doc_id"), text.alias("text"))
        ids = scratch.put(dense(scratch.put(numbered(keyed), "par-numbers")), "par-ids")
        own = (keyed["row"] == ids["row"]) & keyed["doc_id"].eqNullSafe(ids["doc_id"])
        texts = scratch.put(blocks(keyed.join(ids, own).select("ord", "text")), "par-texts")
        buckets = -(-(texts.agg(F.sum("size")).first()[0] or 1) // BUCKET_BYTES)
        copies = duplicate_spans(texts, scratch, buckets)
        runs = runs_of(copies, repeated_windows(texts, scratch, buckets))
        found = scratch.keep(spans_by_document(runs, ids, scratch), "par-spans")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    whole = docs.select(
        F.xxhash64(text).alias("_row"), doc_id.alias("_id"), F.struct(*rest).alias("_rest"), text.alias("_text")
    )
    same = (whole["_row"] == found["row"]) & whole["_id"].eqNullSafe(found["doc_id"])
    joined = whole.join(found, same, "left").select("_rest", "_text", "_spans")
    schema = T.StructType(
        [
            joined.schema["_rest"],
            joined.schema["_text"],
            T.StructField(REMOVED, T.LongType()),
            T.StructField(SPANS, T.LongType()),
            T.StructField(FIRST_DOCS, T.ArrayType(T.LongType())),
        ]
    )
    return map_arrow(joined, _cut, schema)


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, first_docs, text (what is left)."""
    return cut_repeats(docs.select("doc_id", "text")).select(
        F.col("_rest.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length("_text"), F.lit(0)) + F.col(REMOVED)).cast("bigint").alias("n_bytes"),
        F.col(REMOVED).alias("n_removed"),
        F.col(SPANS).alias("n_spans"),
        F.col(FIRST_DOCS).alias("first_docs"),
        F.col("_text").alias("text"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeats cut from the text; documents of which no word is left go."""
    cut = cut_repeats(docs)
    columns = [F.col("_text").alias(c) if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns]
    gone = (F.col(REMOVED) > 0) & ~F.col("_text").rlike(r"[^\x20\x09-\x0D]")
    return cut.where(~gone).select(*columns)
