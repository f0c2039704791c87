from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES
from tools.check_oracles import rows_of

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, oracle, name):
    df = contract.queries()[name](spark, str(SF))
    want = oracle.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    got, expected = rows_of(df.columns, df.collect()), rows_of(want.columns, want.fetchall())
    assert got - expected == Counter() and expected - got == Counter()
    assert sum(got.values()) > 0


def test_pipeline_stages_keep_columns_and_drop_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    out = corpus_pipeline.run(spark, str(SF))
    assert out.columns[: len(columns)] == columns
    n = out.count()
    assert 0 < n < docs.count()
    assert out.select("doc_id").distinct().count() == n


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id")
    right = got.where("lang_pred = lang").count() / got.count()
    assert right > 0.97


@pytest.mark.parametrize("stage", range(5))
def test_stages_leave_foreign_columns_alone(spark, stage):
    names = ["_lang_pred", "_lang_score", "_window_hits", "_window_items", "_gone", "_taken", "_size", "row", "a.b", "x y", "kept"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    odd = docs.selectExpr("*", *[f"concat('{i}', doc_id) AS `{n}`" for i, n in enumerate(names)])
    out = corpus_pipeline.STAGES[stage][1](spark, odd, str(SF))
    assert out.columns[: len(odd.columns)] == odd.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got
    for r in got.values():
        assert all(r[n] == f"{i}{r.doc_id}" for i, n in enumerate(names))


@pytest.mark.parametrize("stage", range(5))
def test_stages_run_on_empty_tables(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, str(SF)).count() == 0
