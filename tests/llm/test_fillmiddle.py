from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_cases import frame, no_documents, odd_documents, odd_texts
from tidemark.llm import boundaries, fillmiddle


def brute(doc_id, text, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in markers) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(
    ("offsets", "kinds"),
    [
        (np.arange(70_000), ["run", "run"]),
        (np.arange(0, 9_000, 3), ["array"]),
        (np.sort(np.random.default_rng(1).choice(65_536, 20_000, replace=False)), ["bitmap"]),
        (np.array([5]), ["array"]),
        (np.concatenate([np.arange(0, 60_000, 2), np.arange(70_000, 71_000), np.arange(200_000, 210_000, 7)]), ["bitmap", "run", "array"]),
    ],
)
def test_every_container_selects_its_members(offsets, kinds):
    found = boundaries.BoundarySet(offsets)
    assert [c.kind for c in found.containers] == kinds
    assert [found.select(k) for k in range(len(found))] == offsets.tolist()
    with pytest.raises(IndexError):
        found.select(len(offsets))


def test_boundaries_of_an_empty_set_and_text():
    assert len(boundaries.BoundarySet(np.zeros(0, np.int64))) == 0
    assert boundaries.BoundarySet.of_text(np.zeros(0, np.uint8)).select(0) == 0


def test_outputs_and_restored_texts_match_brute_force(spark):
    texts = [*odd_texts(), "a<P>b", "<", "P><S", "日本語🙂" * 30_000, "ab日" * 70_000, ("x" * 50 + "é") * 9_000]
    rows = [(i, t, "s") for i, t in enumerate(texts * 4)] + [(None, "no id", "s"), (7, "same id", "s")]
    made = fillmiddle.fill_in_middle(frame(spark, rows)).withColumn("back", fillmiddle.restore(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in made.drop("prefix_bytes", "middle_bytes").collect()), key=repr)
    want = sorted(((i, *brute(i, t), t or "") for i, t, _ in rows), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    cut = made.where("form <> 'plain'").select("back", "prefix_chars", "prefix_bytes", "middle_chars", "middle_bytes")
    for text, chars, size, more, more_size in cut.collect():
        assert len(text[:chars].encode()) == size
        assert len(text[chars : chars + more].encode()) == more_size


def test_odd_tables(spark):
    assert fillmiddle.fill_in_middle(no_documents(spark)).count() == 0
    docs = odd_documents(spark)
    assert fillmiddle.fill_in_middle(docs).count() == docs.count()


@pytest.mark.parametrize("markers", [("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "bc", "x"), ("aa", "b", "c"), ("abc", "b", "x")])
def test_markers_that_can_run_into_each_other_are_refused(spark, markers):
    with pytest.raises(ValueError, match="overlap"):
        fillmiddle.fill_in_middle(no_documents(spark), markers=markers)
