"""Nearest rows by the cell index against brute force, and its work under skew."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import business as BZ
from churnlens.operators import neighbours as NB

ROWS = "subscriber_id string, billing_cycle string, tenure_days int, total_engagements long, total_revenue double, churned int"
QUERIES = "query_id string, billing_cycle string, tenure_days int, total_engagements long, total_revenue double"


def brute(rows, queries, k):
    want = {}
    for q in {r[0]: r for r in queries}.values():
        own = [r for r in rows if r[1] == q[1] and q[1] is not None and None not in r[2:5]]
        if not own or None in q[2:5]:
            continue
        top = [max(max(abs(r[d] - q[d]) for r in own), 1) for d in (2, 3, 4)]
        score = lambda r: abs(r[2] - q[2]) / top[0] + abs(r[3] - q[3]) / top[1] + abs(r[4] - q[4]) / top[2]  # noqa: E731 (sum() compensates)
        scored = sorted((score(r), r[0]) for r in own)[:k]
        want[q[0]] = [s[1] for s in scored]
    return want


def check(spark, rows, queries, k, **sizes):
    found = BZ.similar_subscribers(spark.createDataFrame(rows, ROWS), spark.createDataFrame(queries, QUERIES), k=k, **sizes).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["subscriber_id"])
    assert got == brute(rows, queries, k)


def profiles(rng, n, cycles=("monthly", "annual", "weekly", None)):
    return [(f"s{i:05d}", rng.choice(cycles), rng.choice([None, *range(60)]), rng.randrange(30), float(rng.randrange(40)), i % 2) for i in range(n)]


def asked(rng, n):
    return [(f"q{i}", rng.choice(["monthly", "annual", "weekly", "never", None]), rng.randrange(-20, 90), rng.randrange(50),
             float(rng.randrange(60))) for i in range(n)]


@pytest.mark.parametrize("k,cell,few", [(5, 1, 0), (3, 8, 0), (40, 8, 0), (5, 64, 1000)])
def test_nearest_equals_brute_force(spark, monkeypatch, k, cell, few):
    monkeypatch.setattr(NB, "FAN", 3)   # several levels of nodes on little data
    rng = random.Random(k)
    queries = asked(rng, 40)
    check(spark, profiles(rng, 400), queries + queries[:3], k, cell=cell, few=few)


def test_nearest_with_few_distinct_profiles_and_an_outlier(spark, monkeypatch):
    """Nearly all rows share three profiles and one lies far out: ties by id, and the far one does not stretch the cells."""
    monkeypatch.setattr(NB, "FAN", 4)
    rng = random.Random(9)
    same = [(f"s{i:05d}", "monthly", *rng.choice([(0, 0, 0.0), (1, 0, 0.0), (0, 2, 5.0)]), i % 2) for i in range(600)]
    odd = [(f"t{i:05d}", "monthly", rng.randrange(50), rng.randrange(50), float(rng.randrange(50)), 0) for i in range(100)]
    far = [("far", "monthly", 10**6, 10**9, 1e12, 1)]
    check(spark, same + odd + far, [(f"q{i}", "monthly", *same[i][2:5]) for i in range(5)] + [("qf", "monthly", 10**6, 10**9, 1e12),
          ("qm", "monthly", 25, 25, 25.0)], 5, cell=8, few=0)


def test_nearest_empty_tables(spark):
    rng = random.Random(2)
    for few in (0, 64):
        check(spark, [], asked(rng, 3), 5, few=few)
        check(spark, profiles(rng, 20), [], 5, few=few)


def test_scored_rows_stay_few_under_skew(spark, monkeypatch):
    """One far outlier and all other rows within one ten-thousandth of its distance: a query still meets a few cells, not all."""
    n, m = 40_000, 400
    rng = np.random.default_rng(3)
    xyz = rng.lognormal(0, 1, (n, 3))
    xyz[0] = 1e9
    rows = spark.createDataFrame([(f"s{i}", "monthly", *map(float, xyz[i]), 0) for i in range(n)],
                                 "id string, cycle string, t double, e double, r double, churned int").repartition(8)
    asked_ = rows.where("id != 's0'").orderBy("id").limit(m).select(F.concat(F.lit("q"), "id").alias("q"), "cycle", "t", "e", "r")
    pairs = []
    own = NB._best
    monkeypatch.setattr(NB, "_best", lambda scored, *a: (pairs.append(scored.count()), own(scored, *a))[1])
    found = NB.nearest(rows, asked_, 5, "id", "q", "cycle", ["t", "e", "r"], cell=256, few=0)
    assert found.where("rank = 1 and q != concat('q', id)").count() == 0 and found.count() == 5 * m
    assert max(pairs) < 0.1 * n * m


def test_few_rows_a_query_are_sorted(spark, monkeypatch):
    """Of the cells that a query meets only the rows within its bound are sorted and dealt, not a cell's every row."""
    n, m = 20_000, 300
    xyz = np.random.default_rng(5).random((n, 3)) * 1000
    rows = spark.createDataFrame([(f"s{i}", "monthly", *map(float, xyz[i])) for i in range(n)], "id string, cycle string, t double, e double, r double")
    asked_ = rows.orderBy("id").limit(m).select(F.concat(F.lit("q"), "id").alias("q"), "cycle", "t", "e", "r")
    sorted_rows = []
    own = NB._best
    monkeypatch.setattr(NB, "_best", lambda scored, *a: (sorted_rows.append(scored.count()), own(scored, *a))[1])
    found = NB.nearest(rows, asked_, 5, "id", "q", "cycle", ["t", "e", "r"], cell=256, few=0)
    assert found.count() == 5 * m and sum(sorted_rows) < 100 * m


def test_many_queries_meet_cells_in_arrays(spark, monkeypatch):
    """With every row a query the queries go in arrays, and each one meets few cells: not a row a query and cell."""
    n = 12_000
    xyz = np.random.default_rng(7).random((n, 3)) * [365, 0, 1e6]
    rows = spark.createDataFrame([(f"s{i:05d}", "monthly" if i % 2 else "annual", *map(float, xyz[i])) for i in range(n)],
                                 "id string, cycle string, t double, e double, r double").repartition(4)
    asked_ = rows.select(F.concat(F.lit("q"), "id").alias("q"), "cycle", "t", "e", "r")
    met = []
    own = NB._rows_within
    monkeypatch.setattr(NB, "_rows_within", lambda points, *a: (met.append(points), own(points, *a))[1])
    found = NB.nearest(rows, asked_, 3, "id", "q", "cycle", ["t", "e", "r"], cell=128, few=0)
    assert found.where("rank = 1 and q = concat('q', id) and score = 0").count() == n and found.count() == 3 * n
    assert max(points.count() for points in met) < n / 10
    assert met[-1].select(F.sum(F.size("_points"))).first()[0] < 6 * n


def test_curve_joins_neighbours(monkeypatch):
    monkeypatch.setattr(NB, "RANK_BITS", 3)
    for dims in (1, 2, 3):
        ranks = np.stack(np.meshgrid(*[np.arange(8)] * dims)).reshape(dims, -1)
        code = NB._hilbert(list(ranks))
        assert sorted(code) == list(range(8 ** dims))
        assert (np.abs(np.diff(ranks[:, np.argsort(code)])).sum(axis=0) == 1).all()
