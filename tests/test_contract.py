from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.queries import ORACLES, QUERIES
from tools.check_oracles import rows_of

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "view_share_pct" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, oracle, name):
    df = contract.queries()[name](spark, str(SF))
    want = oracle.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    got, expected = rows_of(df.columns, df.collect()), rows_of(want.columns, want.fetchall())
    assert got - expected == Counter() and expected - got == Counter()
    assert sum(got.values()) > 0
