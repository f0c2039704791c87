"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased characters, hashed to 65,536 places. Document
frequencies are counted over all training documents. The weights are trained with
follow-the-regularised-leader (one learning rate per weight, L1 and L2 penalties, so most weights
are zero) on a bounded sample: up to ``per_label`` documents of each language, chosen by a hash of
the id, moved as feature counts to one task. A fifth of the sample is left out of the training and
sets the temperature by which scores are calibrated.

A feature's value is its share of the document's n-grams times its inverse document frequency, so
a document's logits are a mean over its n-grams, read from one table of weights.

Documents whose crc32 of the id leaves 2 when divided by 4 are held out of everything that is
learned. Nulls, ties and odd input: documents without an id or a language are not learned from;
null texts and texts without a letter are ``und`` with score 0; with no training document at all
every document is ``und``; equal logits go to the first language in code point order; an empty
table gives an empty result. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowmap import map_arrow, ship_package
from .scratch import Scratch, rows_of, with_row
from .textarrays import U64, mix

BITS, ORDERS = 16, (1, 2, 3)
PLACES = 1 << BITS
UNKNOWN = "und"
#: Documents of each language that are trained on at most, in expectation.
PER_LABEL = 2_000
_FACTORS = np.random.default_rng(5).integers(1, 1 << 62, 3, dtype=U64) * U64(2) + U64(1)
CHUNK_CHARS = 1 << 18
#: Brings feature values to the order of one.
SCALE = 20.0


def char_features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order the hashed n-grams at each character, and offsets of the texts in characters.

    The last n - 1 places of a text have no n-gram of order n: they hold ``PLACES``.
    """
    raw = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) // 4 for r in raw], out=offsets[1:])
    chars = np.frombuffer(b"".join(raw), np.uint32).astype(U64) + U64(1)
    out = []
    for order in ORDERS:
        n = len(chars) - order + 1
        places = np.full(len(chars), PLACES, np.int32)
        if n > 0:
            total = np.full(n, U64(order))
            for j in range(order):
                total = total + chars[j : j + n] * _FACTORS[j]
            places[:n] = (mix(total) >> U64(64 - BITS)).astype(np.int32)
            for back in range(1, order):
                inside = offsets[1:] - back
                places[inside[inside >= offsets[:-1]]] = PLACES
        out.append(places)
    return out, offsets


def _text_chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    texts: list[str] = []
    first = size = 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield first, texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield first, texts


def training_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang) of the documents that may be learned from."""
    usable = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )


def document_frequencies(train: DataFrame) -> DataFrame:
    """(place, df) over all training documents, and their number at place -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(PLACES + 1, np.int64)
        seen = np.zeros(PLACES + 1, np.uint8)
        n = 0
        for batch in batches:
            n += batch.num_rows
            for _, texts in _text_chunks(batch.column(0)):
                orders, offsets = char_features(texts)
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    seen[:] = 0
                    for places in orders:
                        seen[places[a:b]] = 1
                    df += seen
        used = np.flatnonzero(df[:PLACES])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(df[used], n))], ["place", "df"]
        )

    return map_arrow(train.select("text"), run, "place long, df long").groupBy("place").agg(F.sum("df").alias("df"))


def _sample_features(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for _, texts in _text_chunks(batch.column(2)):
                orders, offsets = char_features(texts)
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    every = np.concatenate([p[a:b] for p in orders])
                    u, c = np.unique(every[every < PLACES], return_counts=True)
                    ids.append(u.astype(np.int32).tobytes())
                    counts.append(c.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "label", "places", "counts"],
            )

    return map_arrow(sample.select("doc_id", "label", "text"), run, "doc_id string, label int, places binary, counts binary")


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    labels: int,
    alpha: float = 0.3,
    beta: float = 0.1,
    l1: float = 0.002,
    l2: float = 0.001,
    passes: int = 3,
) -> np.ndarray:
    """Weights (places + 1 x labels, the last row the intercept) by follow-the-regularised-leader."""
    z = np.zeros((PLACES + 1, labels))
    n = np.zeros((PLACES + 1, labels))

    def weights(at):
        zz, nn = z[at], n[at]
        shrunk = np.sign(zz) * np.maximum(np.abs(zz) - l1, 0)
        return -shrunk / ((beta + np.sqrt(nn)) / alpha + l2)

    order = np.random.default_rng(1)
    for _ in range(passes):
        for r in order.permutation(len(rows)):
            label, places, values = rows[r]
            at, x = np.append(places, PLACES), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1
            g = np.outer(x, error)
            nn = n[at] + g * g
            z[at] += g - (np.sqrt(nn) - np.sqrt(n[at])) / alpha * w
            n[at] = nn
    return weights(np.arange(PLACES + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by interval halving on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    lo, hi = -4.0, 4.0
    for _ in range(60):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        if loss(a) <= loss(b):
            hi = b
        else:
            lo = a
    return float(np.exp((lo + hi) / 2))


@dataclass
class LanguageModel:
    """Labels, n-gram weights with the inverse document frequency in them, intercepts, temperature."""

    labels: list[str]
    table: np.ndarray
    intercept: np.ndarray
    temperature: float

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the best label, its calibrated probability) of each text."""
        orders, offsets = char_features(texts)
        sums = np.zeros((len(texts), len(self.labels)))
        counts = np.zeros(len(texts))
        full = offsets[1:] > offsets[:-1]
        at = offsets[:-1][full]
        for places in orders:
            if len(at):
                sums[full] += np.add.reduceat(self.table[places], at, axis=0, dtype=np.float64)
                counts[full] += np.add.reduceat((places < PLACES).astype(np.int64), at)
        logits = sums / np.maximum(counts, 1)[:, None] + self.intercept
        best = logits.argmax(1)
        return best, _softmax(logits / self.temperature)[np.arange(len(best)), best]


def fit(docs: DataFrame, per_label: int = PER_LABEL) -> LanguageModel | None:
    """Learn from ``docs``; None if there is nothing to learn from.

    What reaches the driver: one row per language, one per hash place, one per trained model.
    """
    ship_package(docs.sparkSession)
    train = training_rows(docs)
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = sorted(sizes)
    if not labels:
        return None
    df = np.zeros(PLACES)
    total = 0
    for r in document_frequencies(train).collect():
        if r["place"] < 0:
            total = r["df"]
        else:
            df[r["place"]] = r["df"]
    idf = np.log((1 + total) / (1 + df)) + 1

    number = F.create_map(*(x for i, name in enumerate(labels) for x in (F.lit(name), F.lit(i))))
    rate = F.create_map(*(x for name in labels for x in (F.lit(name), F.lit(per_label / sizes[name]))))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = train.where(draw < rate[F.col("lang")]).withColumn("label", number[F.col("lang")])

    def learn(table: pa.Table) -> pa.Table:
        kept = sorted(zip(*(table[c].to_pylist() for c in ("doc_id", "label", "places", "counts")), strict=True))
        rows = []
        for _, label, places, counts in kept:
            at, c = np.frombuffer(places, np.int32), np.frombuffer(counts, np.int32)
            rows.append((label, at, SCALE * c / max(1, c.sum()) * idf[at]))
        check = rows[::5] if len(rows) >= 50 else rows
        w = train_ftrl([r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows, len(labels))
        logits = np.array([x @ w[at] + w[PLACES] for _, at, x in check])
        t = fit_temperature(logits, np.array([r[0] for r in check]))
        return pa.table({"weights": pa.array([w.tobytes()], pa.binary()), "temperature": pa.array([t])})

    with Scratch(docs.sparkSession) as scratch:
        features = scratch.put(_sample_features(sample), "lang-sample")
        # The sample is bounded, so one task may hold it.
        together = features.withColumn("model", F.lit("all")).groupBy("model")
        trained = together.applyInArrow(learn, "weights binary, temperature double").collect()
    if not trained:
        return None
    model = trained[0]
    w = np.frombuffer(bytes(model["weights"])).reshape(PLACES + 1, len(labels))
    table = np.zeros((PLACES + 1, len(labels)), np.float32)
    table[:PLACES] = SCALE * idf[:, None] * w[:PLACES]
    return LanguageModel(labels, table, w[PLACES], model["temperature"])


#: What a prediction adds to a document.
PREDICTED, SCORE = "_lang_pred", "_lang_score"


def predict(docs: DataFrame, model: LanguageModel | None, returned: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (all, or those in ``returned``) plus PREDICTED and SCORE."""
    names = docs.columns if returned is None else returned

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            found, scores = [], []
            for _, texts in _text_chunks(column["text"]):
                has_letter = [any(map(str.isalpha, t)) for t in texts]
                if model is None:
                    best, p, has_letter = [0] * len(texts), [0.0] * len(texts), [False] * len(texts)
                else:
                    best, p = model.scores(texts)
                for ok, b, s in zip(has_letter, best, p, strict=True):
                    found.append(model.labels[b] if ok else UNKNOWN)
                    scores.append(float(s) if ok else 0.0)
            column[PREDICTED], column[SCORE] = pa.array(found, pa.string()), pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays([column[c] for c in out.names], out.names)

    out = T.StructType(
        [docs.schema[c] for c in names] + [T.StructField(PREDICTED, T.StringType()), T.StructField(SCORE, T.DoubleType())]
    )
    return map_arrow(docs, run, out)


def identify(docs: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score."""
    model = fit(docs, per_label)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4).eqNullSafe(F.lit(2).cast("bigint"))
    return predict(texts, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), F.col(PREDICTED).alias("lang_pred"), F.col(SCORE).alias("score")
    )


def keep_identified(docs: DataFrame, least_score: float = 0.5, per_label: int = PER_LABEL) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``."""
    found = predict(with_row(docs), fit(docs, per_label))
    return rows_of(found.where((F.col(PREDICTED) != UNKNOWN) & (F.col(SCORE) >= least_score)), docs.columns)
