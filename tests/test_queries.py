"""Every registered query equals its DuckDB oracle on the small driver tables; entry() runs."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidemark.plans.queries import QUERIES as PLAN_QUERIES
from tidemark.plans.stage_queries import STAGE_QUERIES
from tools.compare_oracle import TABLES, rows_of

QUERIES = {**PLAN_QUERIES, **STAGE_QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = Path(SF_SMALL) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    (row,) = df.collect()
    assert row["staging_rows"] > 0 and row["dim_rows"] > 0
