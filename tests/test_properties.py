"""Property tests against brute force on small random inputs (few examples: each runs Spark jobs)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlens.operators import business as BZ
from churnlens.operators.order_stats import exact_quantile_value

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       q=st.sampled_from([0.1, 0.25, 0.5, 0.9]), parts=st.integers(min_value=1, max_value=6))
def test_exact_quantile_is_numpy_linear(spark, values, q, parts):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert exact_quantile_value(df, "x", q, partitions=parts) == pytest.approx(float(np.quantile(values, q)))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["monthly", "annual"]), st.integers(0, 400),
                               st.integers(0, 50), st.integers(0, 300), st.integers(0, 1)),
                     min_size=3, max_size=40),
       queries=st.lists(st.tuples(st.sampled_from(["monthly", "annual"]), st.integers(0, 400),
                                  st.integers(0, 50), st.integers(0, 300)), min_size=1, max_size=3),
       k=st.integers(1, 5))
def test_similar_subscribers_matches_brute_force(spark, rows, queries, k):
    wide_pd = pd.DataFrame(rows, columns=["billing_cycle", "tenure_days", "total_engagements", "total_revenue",
                                          "churned"])
    wide_pd.insert(0, "subscriber_id", [f"s{i:03d}" for i in range(len(wide_pd))])
    wide_pd["total_revenue"] = wide_pd["total_revenue"].astype(float)
    q_pd = pd.DataFrame(queries, columns=["billing_cycle", "tenure_days", "total_engagements", "total_revenue"])
    q_pd.insert(0, "query_id", [f"q{i}" for i in range(len(q_pd))])
    q_pd["total_revenue"] = q_pd["total_revenue"].astype(float)
    wide = spark.createDataFrame(wide_pd, "subscriber_id string, billing_cycle string, tenure_days int, "
                                          "total_engagements long, total_revenue double, churned int")
    qdf = spark.createDataFrame(q_pd, "query_id string, billing_cycle string, tenure_days int, "
                                      "total_engagements long, total_revenue double")
    got = {(r["query_id"], r["rank"]): r["subscriber_id"] for r in BZ.similar_subscribers(wide, qdf, k=k).collect()}
    want = {}
    for _, q in q_pd.iterrows():
        c = wide_pd[wide_pd.billing_cycle == q.billing_cycle].copy()
        if c.empty:
            continue
        dt_, de, dr = ((c.tenure_days - q.tenure_days).abs(), (c.total_engagements - q.total_engagements).abs(),
                       (c.total_revenue - q.total_revenue).abs())
        c["score"] = dt_ / max(dt_.max(), 1) + de / max(de.max(), 1) + dr / max(dr.max(), 1.0)
        top = c.sort_values(["score", "subscriber_id"]).head(k)
        for i, sid in enumerate(top.subscriber_id, start=1):
            want[(q.query_id, i)] = sid
    assert got == want
