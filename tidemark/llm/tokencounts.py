"""Token counts of documents under a BPE tokenizer, without making ids.

Each document becomes the frequencies of its distinct pre-tokens. Slices of up to 512 documents
are packed, so that a pre-token is written once per slice, and dealt to buckets by a checksum of
the pre-token. So every pre-token of the corpus meets one task, which asks the tokenizer once for
its number of pieces, joins that number to the frequencies, and sums per document; the sums of
all buckets are added up by slice. A pre-token that stands in every document is one small number
per document in its bucket. There is a bucket for every few megabytes of text, a task takes its
buckets one after the other, and keeps the pieces of no more than one of them.

Pre-tokens are cut by the tokenizer's own pattern. The regex package and the tokenizer agree on
all characters below U+0530; texts with others are cut by the tokenizer itself.

Nulls, ties and odd input: a null text counts as empty; special tokens inside a text count one
each, as the library has it by default; repeated rows stay separate rows; an empty table gives an
empty result. Very long texts are counted whole.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow

#: Separates pre-tokens in a packed string.
_SEPARATOR = "\x00"
SLICE_DOCS, SLICE_CHARS, COUNTED_ROWS = 512, 1 << 21, 32
#: Bytes of text for each bucket; pre-tokens that are given to the tokenizer at once.
BUCKET_BYTES, ENCODED = 4 << 20, 2048
_NO_ID = -(1 << 63)


def _tokenizer(path: str):
    # Tasks run side by side already; threads of its own cost the library memory for each.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _pieces(tok, pretokens: list[str]) -> list[int]:
    counts: list[int] = []
    for lo in range(0, len(pretokens), ENCODED):
        counts += [len(e) for e in tok.encode_batch_fast(pretokens[lo : lo + ENCODED], add_special_tokens=False)]
    return counts


class _Cutter:
    """Frequencies of the pre-tokens of a text, and the number of special tokens in it."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.tok = _tokenizer(path)
        self.cut = regex.compile(pattern).findall
        special = sorted((t.content for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.unusual = regex.compile("[^\x00-ԯ]").search

    def __call__(self, text: str) -> tuple[Counter, int]:
        parts = self.special.split(text) if self.special else [text]
        found: Counter = Counter()
        for part in parts:
            if self.unusual(part):
                found.update(part[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(part))
            else:
                found.update(self.cut(part))
        return found, len(parts) - 1


def _planes(values: np.ndarray, kind: type) -> bytes:
    """Whole numbers as all their first bytes, then all their second bytes: mostly zeros, so compressible."""
    raw = np.asarray(values, kind)
    return raw.view(np.uint8).reshape(len(raw), -1).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Runs of (ids, texts), of a bounded number of documents and of characters beyond the last text."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(_NO_ID if doc_id is None else doc_id)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if len(ids) == SLICE_DOCS or size >= SLICE_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def pretoken_frequencies(docs: DataFrame, path: str, pattern: str, buckets: int) -> DataFrame:
    """Frequencies of slices of documents, by bucket: (slice, bucket, pretokens, docs, places, counts).

    ``pretokens`` are the distinct ones of the slice in this bucket; the others say, entry by entry,
    which document holds which of them how often. One row per slice has ``pretokens`` null and
    carries the documents' ids, bytes, and tokens that need no tokenizer.
    """
    names = ["slice", "bucket", "pretokens", "docs", "places", "counts"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(path, pattern)
        # Unique within the job, and the same again when a lost task is repeated.
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for ids, texts in _slices(batch):
                index: dict[str, int] = {}
                owner, place, count = [], [], []
                ready = np.zeros(len(ids), np.int64)
                for i, text in enumerate(texts):
                    found, ready[i] = cutter(text)
                    owner.append(np.full(len(found), i, np.uint16))
                    place.append(np.array([index.setdefault(p, len(index)) for p in found], np.int64))
                    count.append(np.array(list(found.values()), np.int64))
                owners, places, counts = map(np.concatenate, (owner, place, count))
                pretokens = list(index)
                bucket_of = np.array([crc32(p.encode()) % buckets for p in pretokens], np.int64)
                for j, p in enumerate(pretokens):
                    if _SEPARATOR in p:
                        # It cannot be packed: counted here, and in no bucket.
                        own = places == j
                        np.add.at(ready, owners[own], counts[own] * _pieces(cutter.tok, [p])[0])
                        bucket_of[j] = -1
                by_bucket = np.argsort(bucket_of, kind="stable")
                within = np.empty(len(pretokens), np.int64)
                starts = np.searchsorted(bucket_of[by_bucket], np.arange(-1, buckets + 1))
                within[by_bucket] = np.arange(len(by_bucket)) - starts[bucket_of[by_bucket] + 1]
                entry = np.argsort(bucket_of[places], kind="stable")
                edges = np.searchsorted(bucket_of[places][entry], np.arange(buckets + 1))
                n_bytes = np.array([len(t.encode()) for t in texts], np.int64)
                rows = [(number, number % buckets, None, np.array(ids, np.int64).tobytes(), n_bytes.tobytes(), ready.tobytes())]
                for b in np.unique(bucket_of[bucket_of >= 0]).tolist():
                    own = entry[edges[b] : edges[b + 1]]
                    packed = _SEPARATOR.join([pretokens[j] for j in by_bucket[starts[b + 1] : starts[b + 2]]])
                    rows.append(
                        (
                            number,
                            b,
                            packed,
                            _planes(owners[own], np.uint16),
                            _planes(within[places[own]], np.uint32),
                            _planes(counts[own], np.uint32),
                        )
                    )
                number += 1
                # Freed buffers go back, as the other tasks of the executor need them.
                pa.default_memory_pool().release_unused()
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    schema = "slice long, bucket int, pretokens string, docs binary, places binary, counts binary"
    return map_arrow(texts, run, schema)


def count_pieces(frequencies: DataFrame, path: str) -> DataFrame:
    """(slice, sums, docs, n_bytes, ready): tokens of the slice's documents from one bucket, in ``sums``.

    Each pre-token of a bucket is sent to the tokenizer once, if the rows of a task come by bucket. Rows
    that carry documents pass through, with ``sums`` null.
    """
    names = ["slice", "sums", "docs", "n_bytes", "ready"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        pieces: dict[str, int] = {}
        current = None
        # A few packed rows at a time: a batch of them holds many documents.
        for batch in (b.slice(lo, COUNTED_ROWS) for b in batches for lo in range(0, b.num_rows, COUNTED_ROWS)):
            out: list[tuple] = []
            for number, bucket, packed, docs, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    current = bucket
                    pieces.clear()
                if packed is None:
                    out.append((number, None, docs, places, counts))
                    continue
                own = packed.split(_SEPARATOR)
                new = [p for p in own if p not in pieces]
                if new:
                    pieces.update(zip(new, _pieces(tok, new), strict=True))
                each = np.array([pieces[p] for p in own], np.int64)
                tokens = each[_from_planes(places, np.uint32)] * _from_planes(counts, np.uint32)
                sums = np.bincount(_from_planes(docs, np.uint16), tokens).astype(np.int64)
                out.append((number, _planes(sums, np.int64), None, None, None))
            pa.default_memory_pool().release_unused()
            columns = zip(*out, strict=True)
            kinds = [pa.int64()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return map_arrow(frequencies, run, "slice long, sums binary, docs binary, n_bytes binary, ready binary")


def _add_up(table: pa.Table) -> pa.Table:
    """Documents of one slice with all their tokens; a slice has one row per bucket."""
    total = np.zeros(SLICE_DOCS, np.int64)
    docs = n_bytes = ready = np.zeros(0, np.int64)
    for sums, *head in zip(*(table[c].to_pylist() for c in ("sums", "docs", "n_bytes", "ready")), strict=True):
        if sums is None:
            docs, n_bytes, ready = (np.frombuffer(x, np.int64) for x in head)
        else:
            x = _from_planes(sums, np.int64)
            total[: len(x)] += x
    ids = pa.array(docs, pa.int64(), mask=docs == _NO_ID)
    return pa.table([ids, pa.array(n_bytes), pa.array(total[: len(docs)] + ready)], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_tokens, over_limit.

    ``path`` is the tokenizer file as executors see it, ``pattern`` the pattern it cuts texts by.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # With a number, so that the planner does not merge tasks.
    dealt = pretoken_frequencies(docs, path, pattern, buckets).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    counted = count_pieces(dealt, path).groupBy("slice").applyInArrow(_add_up, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
