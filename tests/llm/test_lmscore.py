from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_cases import frame, no_documents, odd_documents, odd_texts, prose
from tidemark.llm import countfilter, lmscore, packing


def training():
    return F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 2


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(rows, weight=lmscore.WEIGHT, base=lmscore.BASE):
    """The model with exact counts of words, and of pairs on the scale of steps."""
    steps = countfilter.scale(base)
    value = countfilter.middles(steps)
    single, pair = Counter(), Counter()
    for i, text in rows:
        if (i or 0) % 3 != 2:
            t = tokens(text)
            single.update(t)
            pair.update(zip([None, *t[:-1]], t, strict=True))
    n, v = sum(single.values()), len(single)
    out = []
    for i, text in rows:
        t = tokens(text)
        plain = [(single[w] + 1) / (n + v + 1) for w in t]
        full = []
        for h, w, p in zip([None, *t[:-1]], t, plain, strict=True):
            c = single[h]
            estimate = min(value[np.searchsorted(steps, pair[h, w], "right")], c)
            full.append(weight * estimate / c + (1 - weight) * p if c else p)
        known = sum(single[w] > 0 for w in t)
        out.append((i, (i or 0) % 3 != 2, len(t), known, n, math.fsum(map(math.log10, plain)), math.fsum(map(math.log10, full))))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: repr(r[:5]))


def corpus():
    rng = np.random.default_rng(5)
    common = prose(60, 40).split()
    texts = [*odd_texts(), *(" ".join(rng.choice(common, 50)) for _ in range(60)), "alpha beta " * 3_000]
    return [*enumerate(texts), (None, "no id at all"), (4, texts[4])]


@pytest.mark.parametrize("broadcast_bytes", [0, lmscore.BROADCAST_BYTES])
def test_scores_match_exact_counts(spark, broadcast_bytes):
    rows = corpus()
    # With so much space for each entry no probe hits by chance.
    got = rows_of(
        lmscore.score_documents(
            frame(spark, [(i, t, "s") for i, t in rows]).repartition(3),
            training(),
            bits=200.0,
            broadcast_bytes=broadcast_bytes,
            slice_bytes=20_000,
            bucket_bytes=50_000,
        )
    )
    want = sorted(brute(rows), key=lambda r: repr(r[:5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:], rel=1e-9) for w in want]


def test_both_ways_give_the_same_scores_and_errors_are_few(spark):
    rows = corpus()
    docs = frame(spark, [(i, t, "s") for i, t in rows])
    broadcast = rows_of(lmscore.score_documents(docs, training(), slice_bytes=30_000, bucket_bytes=40_000))
    blocks = rows_of(lmscore.score_documents(docs, training(), slice_bytes=30_000, bucket_bytes=40_000, broadcast_bytes=0))
    assert broadcast == blocks
    exact = sorted(brute(rows), key=lambda r: repr(r[:5]))
    assert all(abs(b[6] - e[6]) <= 0.02 * abs(e[6]) + 3 for b, e in zip(broadcast, exact, strict=True))


def test_steps_of_rare_counts_are_exact():
    steps = countfilter.scale(1.25)
    assert steps[:8].tolist() == [1, 2, 3, 4, 5, 7, 9, 12]
    value = countfilter.middles(steps)
    assert value[countfilter.steps_of(np.arange(9), steps)].tolist() == [0, 1, 2, 3, 4, 5.5, 5.5, 7.5, 7.5]


def test_filter_never_understates_and_rarely_overstates():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)
    quanta = rng.integers(1, 6, len(keys))
    made = countfilter.CountFilter.build(keys, quanta, 12.0, 8)
    found = made.quanta(keys, 30)
    assert (found >= quanta).all()
    assert (found > quanta).mean() < 0.01
    others = rng.integers(1 << 63, 1 << 64, 200_000, dtype=np.uint64)
    assert (made.quanta(others, 30) > 0).mean() < 0.01
    again = countfilter.CountFilter(made.data.tobytes(), 8)
    assert (again.quanta(keys, 30) == found).all()


def test_empty_filter():
    empty = countfilter.CountFilter.build(np.zeros(0, np.uint64), np.zeros(0, np.int64), 12.0, 8)
    assert empty.quanta(np.arange(10, dtype=np.uint64), 30).tolist() == [0] * 10


def test_packing_round_trips():
    x = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (packing.unpack_sorted(packing.pack_sorted(x)) == x).all()
    assert len(packing.unpack_sorted(packing.pack_sorted(x[:0]))) == 0
    assert packing.unpack(packing.pack(np.arange(5), np.uint32), np.uint32).tolist() == [0, 1, 2, 3, 4]


def test_odd_tables(spark):
    assert lmscore.score_documents(no_documents(spark), training()).count() == 0
    docs = odd_documents(spark)
    untrained = lmscore.score_documents(docs, F.lit(False)).collect()
    assert len(untrained) == docs.count()
    assert all(r.base_score == r.score == r.train_tokens == r.n_known == 0 for r in untrained)
    only_null = frame(spark, [(None, None, "s")])
    (row,) = lmscore.score_documents(only_null, F.lit(True)).collect()
    assert (row.doc_id, row.n_tokens, row.n_known, row.train_tokens) == (None, 1, 1, 1)
