"""Every SQL-expressible query key against its DuckDB oracle."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from helpers import ROOT, SF_ORACLE, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

LLM = getattr(E, "_llm", None)   # the training-data queries have tests of their own
SQL = {k: v for k, v in E.oracle_sql().items() if LLM is None or k not in LLM.llm_queries()}
QUERIES = E.queries()
HEADLINE = ["feature_join", "tier_risk", "kpi_metrics", "feature_stats", "as_of_join", "top_k_per_query", "psi"]


def _duck(sf):
    """A connection of its own for every test, with few threads and little memory beside the JVM's heap."""
    con = duckdb.connect(config={"threads": 2, "memory_limit": "2GB"})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.fixture()
def duck_small():
    with _duck(SF_SMALL) as con:
        yield con


@pytest.fixture()
def duck_oracle():
    with _duck(SF_ORACLE) as con:
        yield con


def _compare(spark, con, sf, key):
    sdf = QUERIES[key](spark, sf)
    s_cols, s_rows, s_hash = digest(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(SQL[key])
    d_cols, d_rows, d_hash = digest([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_hash == d_hash, [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]


def test_every_query_key_is_callable():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 120


@pytest.mark.parametrize("key", sorted(SQL))
def test_oracle_small(spark, duck_small, key):
    _compare(spark, duck_small, SF_SMALL, key)


@pytest.mark.parametrize("key", HEADLINE)
def test_oracle_sf001(spark, duck_oracle, key):
    _compare(spark, duck_oracle, SF_ORACLE, key)


def test_threshold_join_returns_every_subscriber_and_feature(spark):
    found = QUERIES["threshold_join"](spark, SF_SMALL)
    subscribers = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert found.select("subscriber_id").distinct().count() == subscribers
    assert found.groupBy("subscriber_id", "feature").count().where("count > 1").count() == 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tier", "subscribers", "at_risk", "revenue", "risk_pct", "revenue_at_risk"]
    assert df.count() == 3
