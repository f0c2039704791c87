"""Licence scans: stretches of text compared to licence wordings by Dice over word bigrams.

Texts are normalised to lower-case words. A template is held against stretches of a document as
long as itself. Templates longer than the document allows are pruned by their size, and for the
rest a running count of the words that begin a bigram of the template bounds the coefficient of
every stretch from above; the few stretches that the bound leaves are compared in full. A notice or tag
line must hold the licence's name and version word for word as well, without another number behind, as
these few words are what tells one notice from another. Where matches overlap, the one with the higher
coefficient, then the longer one, stands.

Nulls, ties and odd input: null and empty texts and texts of one word have no match; of equal
matches the earlier template in the list stands; repeated rows stay; an empty table gives an empty
result. Whole texts are scanned, in memory bounded by one text.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow
from .licensetexts import templates
from .textarrays import ALNUM, LOWER, U64, byte_chunks, sequence_hashes, words

LEAST_DICE = 0.8
TABLE_BITS = 18


def _word_hashes(text: str) -> np.ndarray:
    ((_, data, offsets),) = byte_chunks(pa.array([text]))
    return words(LOWER[data], offsets, ALNUM, lower=False).hashes


def _first_word(match: tuple[float, int, int, int]) -> int:
    return match[2]


def _exactly(name: str) -> tuple[np.ndarray, frozenset]:
    """Bigrams of a name of two words or more, and those of its last word and a further part of a version."""
    name_words = _word_hashes(name)
    last = name.replace("-", " ").replace(".", " ").split()[-1]
    more = [f"{last} {n}" for n in range(1, 10)] if last.isdigit() else []
    behind = frozenset(int(sequence_hashes(_word_hashes(x), 2)[0]) for x in more)
    return sequence_hashes(name_words, 2), behind


def _stretches(bigrams: np.ndarray, starts: list[int], span: int, own: frozenset) -> Iterator[tuple[int, int, int]]:
    """(start, distinct bigrams, those of the template) of stretches in order, each from the one before."""
    counts: Counter = Counter()
    common, end = 0, 0
    at = 0
    for lo in starts:
        if lo >= end:
            counts, common, at, end = Counter(), 0, lo, lo
        for x in bigrams[at:lo].tolist():
            counts[x] -= 1
            if not counts[x]:
                del counts[x]
                common -= x in own
        for x in bigrams[end : lo + span].tolist():
            common += not counts[x] and x in own
            counts[x] += 1
        at, end = lo, lo + span
        yield lo, len(counts), common


class Scanner:
    """Templates as bigram sets, and a table from hashed bigrams to the templates that hold them."""

    def __init__(self, wordings: list[tuple[str, ...]], least: float = LEAST_DICE) -> None:
        self.least = least
        self.names, self.sets, self.lengths = [], [], []
        #: Bigrams that must stand in a match one after another, and what must not stand behind them.
        self.held: list[tuple[np.ndarray, frozenset] | None] = []
        for name, wording, *held in wordings:
            hashes = _word_hashes(wording)
            if len(hashes) > 1:
                self.names.append(name)
                self.sets.append(frozenset(sequence_hashes(hashes, 2).tolist()))
                self.lengths.append(len(hashes))
                self.held.append(_exactly(held[0]) if held else None)
        self.planes = [np.zeros(1 << TABLE_BITS, U64) for _ in range(-(-len(self.names) // 64))]
        for t, own in enumerate(self.sets):
            slots = np.array(sorted(own), U64) >> U64(64 - TABLE_BITS)
            self.planes[t // 64][slots.astype(np.int64)] |= U64(1) << U64(t % 64)

    def _holds(self, t: int, bigrams: np.ndarray, lo: int, span: int) -> bool:
        """Whether a stretch has the template's name as it is."""
        if self.held[t] is None:
            return True
        name, behind = self.held[t]
        last = lo + span - len(name)
        for at in (np.flatnonzero(bigrams[lo : max(lo, last + 1)] == name[0]) + lo).tolist():
            end = at + len(name)
            if (bigrams[at:end] == name).all() and (end >= len(bigrams) or int(bigrams[end]) not in behind):
                return True
        return False

    def row_matches(self, bigrams: np.ndarray) -> list[tuple[float, int, int, int]]:
        """(dice, template, first word, words) of one document, overlaps resolved."""
        slots = (bigrams >> U64(64 - TABLE_BITS)).astype(np.int64)
        found: list[tuple[float, int, int, int]] = []
        for p, plane in enumerate(self.planes):
            marks = plane[slots]
            at = np.flatnonzero(marks)
            if not len(at):
                continue
            held = marks[at]
            present = int(np.bitwise_or.reduce(held))
            for t in range(64 * p, min(64 * p + 64, len(self.names))):
                if not present >> (t % 64) & 1:
                    continue
                own, span = self.sets[t], self.lengths[t] - 1
                # A stretch of a template's length has `span` bigrams, repeats counted.
                span = min(span, len(bigrams))
                need = self.least * len(own) / (2 - self.least)
                if span < need:
                    continue
                hits = at[(held >> U64(t % 64)) & U64(1) != 0]
                if len(hits) < need:
                    continue
                # Bound: of the hits from each one on, those within a stretch.
                inside = np.searchsorted(hits, hits + span) - np.arange(len(hits))
                # A hit stands first in its stretch, or one or two places in, if words were changed.
                starts = np.unique(np.minimum(hits[inside >= need], len(bigrams) - span))
                for lo, distinct, common in _stretches(bigrams, starts.tolist(), span, own):
                    dice = 2 * common / (distinct + len(own))
                    if dice >= self.least and self._holds(t, bigrams, lo, span):
                        found.append((dice, t, lo, span + 1))
        found.sort(key=lambda m: (-m[0], -m[3], m[1], m[2]))
        # Kept matches do not overlap, so one that is new can only meet its neighbours.
        kept: list[tuple[float, int, int, int]] = []
        for m in found:
            i = bisect(kept, m[2], key=_first_word)
            if (i == 0 or kept[i - 1][2] + kept[i - 1][3] <= m[2]) and (i == len(kept) or m[2] + m[3] <= kept[i][2]):
                insort(kept, m, key=_first_word)
        return kept


def find_licenses(docs: DataFrame, wordings: list[tuple[str, ...]] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """Per document row: doc_id, n_words, matches (license, first_word, n_words, dice)."""
    wordings = templates() if wordings is None else wordings
    match = pa.struct(
        [("license", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("dice", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(wordings, least)
        for batch in batches:
            for row, data, offsets in byte_chunks(batch.column(1)):
                w = words(LOWER[data], offsets, ALNUM, lower=False)
                bigrams = sequence_hashes(w.hashes, 2)
                out = []
                for lo, hi in zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True):
                    own = scanner.row_matches(bigrams[lo : max(lo, hi - 1)])
                    out.append([{"license": scanner.names[t], "first_word": i, "n_words": n, "dice": d} for d, t, i, n in own])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(out)),
                        pa.array(np.diff(w.rows).astype(np.int64)),
                        pa.array(out, pa.list_(match)),
                    ],
                    ["doc_id", "n_words", "matches"],
                )

    texts = docs.select("doc_id", F.col("text").cast("string"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, matches array<struct<license string, first_word int, n_words int, dice double>>"
    return map_arrow(texts, run, schema)


def license_report(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_matches, licenses (distinct, sorted), best_dice, matches."""
    return find_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))).alias("licenses"),
        F.array_max(F.transform("matches", lambda m: m["dice"])).alias("best_dice"),
        "matches",
    )
