"""Drift from merged sketches: equal to exact counts, mergeable by period, and no second pass over rows."""

from __future__ import annotations

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import drift as DR
from churnlens.operators import monitor as MO
from churnlens.session import scratch_path
from churnlens.sources.versions import VersionedTable

LONG = "period string, split string, feature string, value double"


def rows(seed, n=900):
    rng = random.Random(seed)
    out = [(rng.choice(["2023-01-01", "2023-02-01", "2023-03-01"]), rng.choice(["train", "test", "validation"]), f,
            rng.choice([None, float(rng.randrange(40)), rng.gauss(0, 1) if f == "y" else 0.0])) for f in "xyz" for _ in range(n)]
    return out + [("2023-01-01", "train", "only_train", 1.0), ("2023-01-01", "test", "only_test", 1.0)] + [("2023-02-01", "train", "null", None)]


def exact_bins(data):
    out = set()
    for f in {r[2] for r in data}:
        of = lambda s: np.sort([r[3] for r in data if r[1] == s and r[2] == f and r[3] is not None])
        e, a = of("train"), of("test")
        if not len(e):
            continue
        edges = sorted({e[max(0, int(np.ceil(i / 10 * len(e))) - 1)] for i in range(1, 10)})
        for b in range(len(edges) + 1):
            n_e, n_a = (int(((np.searchsorted(edges, v) == b)).sum()) if len(v) else 0 for v in (e, a))
            if n_e + n_a:
                out.add((f, b, n_e, n_a))
    return out


def table(spark):
    return VersionedTable(spark, scratch_path(spark, "test_drift", uuid.uuid4().hex[:8]))


@pytest.mark.parametrize("seed", [1, 2])
def test_bins_equal_exact_counts(spark, seed):
    data = rows(seed)
    got = {tuple(r) for r in DR.bins(DR.sketches(spark.createDataFrame(data, LONG), "period")).collect()}
    assert got == exact_bins(data)


def test_periods_published_one_by_one_give_the_whole(spark):
    """Each period arrives on its own, one of them twice: merged on read they are the whole table's drift."""
    data, t = rows(3), table(spark)
    by = lambda p: spark.createDataFrame([r for r in data if r[0] == p], LONG)
    DR.publish(t, by("2023-02-01").where("value < 10"), F.col("period"))    # a first, partial run of February
    for p in ("2023-01-01", "2023-02-01", "2023-03-01"):
        DR.publish(t, by(p), F.col("period"))
    merged = t.read(t.latest(), DR.SCHEMA)
    assert len(t.latest().parts) == 3 and t.latest().version == 4
    assert {tuple(r) for r in DR.bins(merged).collect()} == exact_bins(data)
    january = t.read(t.latest(), DR.SCHEMA, "period=2023-01-01")
    assert {tuple(r) for r in DR.bins(january).collect()} == exact_bins([r for r in data if r[0] == "2023-01-01"])


def test_many_values_stay_within_the_sketch_error(spark):
    """200,000 values a split, fifty times what a sketch holds: bin shares are off by less than 1 %, PSI of equal splits is nearly 0."""
    long = spark.range(400_000).select(F.lit("2023-01-01").alias("period"), F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"),
                                       F.lit("x").alias("feature"), F.rand(7).alias("value"))
    sk = DR.sketches(long, "period")
    for r in DR.bins(sk).collect():
        assert abs(r["n_expected"] / 200_000 - 0.1) < 0.01 and abs(r["n_actual"] / 200_000 - 0.1) < 0.01
    assert MO.psi(sk).first()["psi"] < 0.001


def test_reading_drift_scans_sketches_only(spark):
    t = table(spark)
    DR.publish(t, spark.createDataFrame(rows(4), LONG), F.col("period"))
    calls = []
    again = DR.stored(spark, t.root, lambda: calls.append(1), F.col("period"))
    assert MO.psi(again).count() == 4 and not calls
    assert "SortMergeJoin" not in MO.psi(again)._jdf.queryExecution().executedPlan().toString()


def test_empty_input(spark):
    assert DR.bins(DR.sketches(spark.createDataFrame([], LONG), "period")).count() == 0
