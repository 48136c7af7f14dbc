"""Plan shape at scale: no cartesian products, single-pass statistics, pruning."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", ["feature_join", "kpi_metrics", "tier_risk", "feature_stats", "as_of_join",
                                 "top_k_per_query", "risk_factors", "key_check", "psi", "billing_schedule"])
def test_no_cartesian_or_nested_loop(spark, key):
    p = plan(Q[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p or key in ()


def test_feature_stats_reads_each_source_once(spark):
    """A15 is one unpivot + one aggregate, not 28 union branches each with its own scans."""
    from churnlens.plans.queries import REGISTRY
    from churnlens.plans.workspace import Workspace
    text = optimized(REGISTRY["feature_stats"](Workspace(spark, SF_SMALL, materialize=False)))   # down to the raw scans
    scans = len(re.findall(r"Relation \[", text))
    assert scans <= 8, scans  # customer, events, orders x2, (lineitem, orders) x2


def test_scan_is_pruned(spark):
    from churnlens.plans.queries import REGISTRY
    from churnlens.plans.workspace import Workspace
    text = plan(REGISTRY["tier_risk"](Workspace(spark, SF_SMALL, materialize=False)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas
    for m in schemas:
        assert "c_name" not in m and "o_comment" not in m


def test_bucketed_views_join_without_exchange(spark):
    """With broadcasts off (the large-table path), predictions x payment view is a bucket-aligned
    sort-merge join: the only exchange left is the final aggregate's."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q["at_risk_summary"](spark, SF_SMALL)
        p = df._jdf.queryExecution().executedPlan()
        text = p.toString()
        final = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "SortMergeJoin" in final
        join_part = final.split("SortMergeJoin", 1)[1].split("\n\n", 1)[0]
        assert "Exchange" not in join_part, final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_star_join_has_no_shuffle_when_large(spark):
    """Subscribers x five views, all bucketed alike in the feature store: no exchange anywhere."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = Q["star_left_5"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 5
        assert "Exchange" not in text, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sizing_helpers(spark):
    """Shuffle partitions and bucket counts come from the data size, inside their bounds."""
    from churnlens.plans.feature_store import default_buckets
    from churnlens.session import tune_for_input
    from churnlens.sources.catalog import Catalog
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        parts = tune_for_input(spark, [SF_SMALL], target_partition_bytes=64 * 1024)
        assert parts >= 8 and spark.conf.get("spark.sql.shuffle.partitions") == str(parts)
        assert tune_for_input(spark, [SF_SMALL]) == 8  # a few MB of input: the minimum
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    b = default_buckets(spark, Catalog(spark, SF_SMALL))
    assert 8 <= b <= 4096 and b & (b - 1) == 0


def test_lookup_of_one_id_reads_one_bucket_of_each_table(spark):
    """An id typed in any case reads one bucket of the index of folded ids, and its row one bucket of the wide table."""
    from churnlens.plans import feature_store as FS
    from churnlens.plans.workspace import Workspace
    from helpers import fixture_catalog, sub
    ids = [f"Sub-{i:03d}" for i in range(40)] + ["sub-007"]
    ws = Workspace(spark, "", catalog=fixture_catalog(spark, [sub(i) for i in ids]), materialize=True)
    # a plan without joins names its buckets only if Spark is told to scan by bucket; files are pruned either way
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        own = ws._store["folded_ids"].where(FS.F.col(FS.FOLDED).isin([FS.fold(FS.F.lit("suB-011"))]))
        assert "SelectedBucketsCount: 1 out of 8" in plan(own)
        found = ws.lookup(["suB-011"])
        assert "SelectedBucketsCount: 1 out of 8" in plan(found)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert [r["subscriber_id"] for r in found.collect()] == ["Sub-011"]
    assert sorted(r["subscriber_id"] for r in ws.lookup(["SUB-007", "nobody"]).collect()) == ["Sub-007", "sub-007"]
    assert ws.lookup(["nobody"]).count() == 0 and ws.lookup([]).count() == 0
    wanted = spark.createDataFrame([("sub-003",), ("SUB-003",), ("SUB-007",), (None,), ("x",)], "id string")
    assert sorted(r["subscriber_id"] for r in ws.lookup(wanted).collect()) == ["Sub-003", "Sub-007", "sub-007"]
    with pytest.raises(ValueError):
        ws.lookup([str(i) for i in range(FS.MAX_POINTS + 1)])


def test_joins_on_subscribers_are_not_broadcast(spark):
    """a few columns of millions of subscribers look small to Spark, which would collect them on the driver."""
    text = Q["filter_null"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text, text


def test_buckets_and_build_shuffles_follow_counted_subscribers(spark, monkeypatch):
    """a bucket holds a bounded number of rows however well they compress, and the store's build shuffles no coarser."""
    from churnlens.plans import feature_store as FS
    from churnlens.plans.workspace import Workspace
    from helpers import fixture_catalog, sub
    cat = fixture_catalog(spark, [sub(f"s{i:03d}") for i in range(90)])
    assert FS.default_buckets(spark, cat) == 8
    monkeypatch.setattr(FS, "BUCKET_TARGET_ROWS", 5)
    assert FS.default_buckets(spark, cat) == 32   # 18 or more
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    table = FS._table
    monkeypatch.setattr(FS, "_table", lambda *a, **k: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or table(*a, **k))
    ws = Workspace(spark, "", catalog=cat, materialize=True)
    assert ws.wide.count() == 90
    assert min(seen) >= 32 and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_build_puts_few_shuffled_bytes_together_for_a_task(spark):
    from churnlens.plans import feature_store as FS
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    own = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "8")
        spark.conf.set(names[1], "256m")
        with FS.shuffle_partitions(spark, 64):
            assert [spark.conf.get(n) for n in names] == ["64", FS.TASK_READ]
        assert [spark.conf.get(n) for n in names] == ["8", "256m"]
    finally:
        for n, v in zip(names, own):
            spark.conf.set(n, v)
