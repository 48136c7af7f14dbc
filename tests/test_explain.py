"""Tree attribution (U9): exactness against brute-force Shapley values, and additivity."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from churnlens.operators import explain as XP
from churnlens.operators import model as M
from churnlens.operators import quality as QA
from churnlens.plans.workspace import Workspace
from churnlens.session import scratch_path


def _cond_expectation(tt, x, subset, node=0):
    """E[f(x) | x_S] by the cover-weighted traversal (path-dependent value function)."""
    if tt.left[node] < 0:
        return tt.value[node]
    f = tt.feature[node]
    lc, rc = tt.left[node], tt.right[node]
    if f in subset:
        gl = XP._goes_left(tt, node, np.array([x[f]]))[0] > 0
        return _cond_expectation(tt, x, subset, lc if gl else rc)
    c = tt.cover[node]
    return (tt.cover[lc] * _cond_expectation(tt, x, subset, lc) + tt.cover[rc] * _cond_expectation(tt, x, subset, rc)) / c


def _brute_shap(tt, x, n_features):
    used = sorted({int(f) for f in tt.feature if f >= 0})
    phi = np.zeros(n_features)
    m = len(used)
    for i in used:
        others = [u for u in used if u != i]
        for k in range(len(others) + 1):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[i] += w * (_cond_expectation(tt, x, set(s) | {i}) - _cond_expectation(tt, x, set(s)))
    return phi


@pytest.fixture(scope="module")
def small_model(spark):
    ws = Workspace(spark, SF_SMALL)
    wide = QA.with_split(ws.wide)
    model = M.fit(wide, M.GBTParams(n_estimators=4, max_depth=4))
    path = scratch_path(spark, "test_models", "shap_small")
    model.write().overwrite().save(path)
    return ws, model, path


def test_tree_shap_matches_brute_force(spark, small_model):
    ws, model, path = small_model
    tables = XP.load_tree_tables(spark, path, list(M.gbt_stage(model).treeWeights))
    X = np.stack([np.array(r["x"]) for r in XP._features_array(model, ws.wide).limit(25).collect()])
    fast = XP.tree_shap(tables, X)
    via_tables = XP.tree_shap_tables(tables, [XP.leaf_tables(tt) for tt in tables], X)
    for row in range(X.shape[0]):
        brute = sum(_brute_shap(tt, X[row], X.shape[1]) for tt in tables)
        np.testing.assert_allclose(fast[row], brute, atol=1e-9)
        np.testing.assert_allclose(via_tables[row], brute, atol=1e-9)


def _deep_tree(rng, depth, n_features):
    """A random tree whose first path goes ``depth`` splits deep, with continuous and categorical splits."""
    left, right, feature, threshold, categories, value, cover = [], [], [], [], [], [], []

    def grow(d, rows):
        i = len(left)
        for column, x in ((left, -1), (right, -1), (feature, -1), (threshold, 0.0), (categories, None),
                          (value, rng.normal()), (cover, float(rows))):
            column.append(x)
        if d and rows > 1:
            feature[i] = int(rng.integers(n_features))
            if rng.random() < 0.3:
                categories[i] = np.array([0.0, 2.0])
            else:
                threshold[i] = float(rng.integers(3)) + 0.5
            share = int(rng.integers(1, rows))
            left[i] = grow(d - 1, share)
            right[i] = grow(d - 1 if rng.random() < 0.3 else 0, rows - share)
        return i

    grow(depth, 10_000)
    return XP.TreeTable(np.array(left), np.array(right), np.array(feature), np.array(threshold), categories, np.array(value), np.array(cover))


@pytest.mark.parametrize("depth", [0, 1, 5, 9])
def test_leaves_with_and_without_tables_match_brute_force(depth):
    """The same values whether all, some or no leaves have a table, also for repeated features, deep paths and a lone leaf."""
    rng = np.random.default_rng(depth)
    tables = [_deep_tree(rng, depth, 7) for _ in range(3)]
    X = rng.integers(0, 4, (12, 7)).astype(float)
    want = [sum(_brute_shap(tt, x, 7) for tt in tables) for x in X]
    for room in (0, 600, XP.MAX_TABLE_BYTES):
        leaves = XP.model_leaves(tables, room)
        kept = [leaf.table is not None for own in leaves for leaf in own if len(leaf.splits)]
        assert sum(leaf.table.nbytes for own in leaves for leaf in own if leaf.table is not None) <= room
        assert not kept or any(kept) == (room > 0) and (room < 1000 or all(kept))
        np.testing.assert_allclose(XP.tree_shap_tables(tables, leaves, X), want, atol=1e-9)


def test_paths_too_long_for_tables():
    """A path of 40 features: its table would not fit, its values still add up to the margin."""
    rng = np.random.default_rng(1)
    tt = _deep_tree(rng, 1, 40)
    n = 40
    nodes = 2 * n + 1
    chain = XP.TreeTable(np.full(nodes, -1), np.full(nodes, -1), np.full(nodes, -1), np.zeros(nodes), [None] * nodes,
                         rng.normal(size=nodes), np.ones(nodes))
    for i in range(n):   # node 2i splits on feature i: leaf 2i + 1 of one row, next 2i + 2
        chain.left[2 * i], chain.right[2 * i], chain.feature[2 * i] = 2 * i + 1, 2 * i + 2, i
    chain.cover[::2] = 100.0 - np.arange(n + 1)
    X = rng.normal(size=(6, n))
    X[0] = 1.0
    leaves = XP.model_leaves([tt, chain])
    assert all(leaf.table is not None for leaf in leaves[0]) and any(leaf.table is None for leaf in leaves[1])
    phi = XP.tree_shap_tables([tt, chain], leaves, X)
    np.testing.assert_allclose(phi.sum(axis=1) + XP.expected_value([tt, chain]), XP.tree_margin([tt, chain], X), atol=1e-8)


def test_agreements_and_tables_by_columns(monkeypatch):
    """A batch is tested once per split, leaves share what is known of their paths, and looks up tables by columns."""
    rng = np.random.default_rng(3)
    tt = _deep_tree(rng, 6, 5)
    X = rng.integers(0, 4, (20, 5)).astype(float)
    X[0, 2] = np.nan
    leaves = XP.leaf_tables(tt)
    left = {nd: XP._goes_left(tt, nd, X[:, tt.feature[nd]]) for nd in range(len(tt.left)) if tt.left[nd] >= 0}
    tested = []
    plain = XP._goes_left
    monkeypatch.setattr(XP, "_goes_left", lambda t, nd, x: tested.append(nd) or plain(t, nd, x))
    got = list(XP.agreements(tt, X.T))
    assert sorted(tested) == sorted(left) and len(got) == len(leaves)
    want = np.zeros(X.shape)
    for leaf, agree in zip(leaves, got):
        for splits, a in zip(leaf.splits, agree):
            assert (a == np.all([left[nd] == went for nd, went in splits], axis=0)).all()
        want[:, leaf.features] += leaf.table[sum(a.astype(int) << k for k, a in enumerate(agree))]
        assert leaf.table.flags.f_contiguous
    assert (XP.tree_shap_tables([tt], [leaves], X) == want).all()


def test_attribution_is_additive_and_matches_spark_margin(spark, small_model):
    ws, model, path = small_model
    attr = XP.tree_attribution(spark, model, path, ws.wide)
    rows = attr.collect()
    assert len(rows) == ws.wide.count()
    for r in rows:
        assert abs(r["base_value"] + sum(r["attribution"]) - r["margin"]) < 1e-9
    # the walked margin equals Spark's own raw prediction (rawPrediction = [-m, m])
    from pyspark.ml.functions import vector_to_array
    raw = {r["subscriber_id"]: r["m"] for r in model.transform(M.model_inputs(ws.wide))
           .select("subscriber_id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    for r in rows:
        assert abs(raw[r["subscriber_id"]] - r["margin"]) < 1e-9


def test_permutation_importance_shape(spark, small_model):
    ws, model, _ = small_model
    res = XP.permutation_importance(model, ws.wide).collect()
    assert len(res) == len(M.feature_columns())
    assert all(-1.0 <= r["importance"] <= 1.0 for r in res)


def test_permutation_is_one_of_all_rows_and_independent_of_partitioning(spark):
    """Every row takes all its values from one other row, each row is taken once, whatever the partitioning; no bucket count."""
    rows = spark.range(500).select((F.col("id") % 400).cast("string").alias("subscriber_id"), F.col("id").alias("a"), (F.col("id") * 2).alias("b"))
    got = sorted(map(tuple, XP.permuted_columns(rows, ["a", "b"]).select("a", "_s_a", "_s_b").collect()))
    assert sorted(x[1] for x in got) == list(range(500)) and all(x[2] == 2 * x[1] for x in got)
    assert sum(x[0] == x[1] for x in got) < 10
    for parts in (1, 13):
        again = XP.permuted_columns(rows.repartition(parts), ["a", "b"]).select("a", "_s_a", "_s_b")
        assert sorted(map(tuple, again.collect())) == got
    assert sorted(x[1] for x in map(tuple, XP.permuted_columns(rows, ["a", "b"], seed=1).select("a", "_s_a").collect())) == list(range(500))
    # no window spans the table and none is split into a fixed number of buckets
    plan = XP.permuted_columns(rows, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 4 and sum("[_range#" in w for w in windows) == 4 and "pmod" not in plan


def test_metrics_equal_spark_evaluator(spark, small_model):
    """Accuracy / precision / recall / F1 from the confusion cells equal Spark ML's evaluator."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from churnlens.operators import evaluate as EV
    ws, model, _ = small_model
    scored = model.transform(M.model_inputs(ws.wide))
    ours = EV.classification_metrics(M.predict(model, ws.wide)).first()
    ev = MulticlassClassificationEvaluator(labelCol="churned", predictionCol="prediction")
    assert ours["accuracy"] == pytest.approx(ev.evaluate(scored, {ev.metricName: "accuracy"}), abs=1e-6)
    for ours_name, spark_name in [("precision", "precisionByLabel"), ("recall", "recallByLabel"),
                                  ("f1_score", "fMeasureByLabel")]:
        theirs = ev.evaluate(scored, {ev.metricName: spark_name, ev.metricLabel: 1.0})
        assert ours[ours_name] == pytest.approx(theirs, abs=1e-6)


def test_dependence_reads_values_by_a_sort_merge_join_and_once(spark, small_model, monkeypatch):
    """The unpivoted values have a row per id and feature: they are never collected for a broadcast, and the rows are joined once."""
    ws, model, path = small_model
    joined = []
    write = XP.write_and_read
    monkeypatch.setattr(XP, "write_and_read", lambda s, df, name: (joined.append(df), write(s, df, name))[1])
    long = XP.attribution_long(XP.tree_attribution(spark, model, path, ws.wide))
    found = XP.attribution_dependence(long, ws.wide, XP.mean_abs_attribution(long), top_n=40).collect()
    n = ws.wide.count()
    per_feature = {}
    for r in found:
        per_feature[r["feature"]] = per_feature.get(r["feature"], 0) + r["n"]
    assert set(per_feature) == {c for c in M.feature_columns() if not c.endswith("_idx")} and set(per_feature.values()) == {n}
    assert len(joined) == 1 and "strategy=merge" in joined[0]._jdf.queryExecution().optimizedPlan().toString()


def test_training_rows_are_spread_by_count(spark, small_model, monkeypatch):
    ws, _, _ = small_model
    wide = QA.with_split(ws.wide)
    n = wide.count()
    monkeypatch.setattr(M, "TRAIN_ROWS_PER_PARTITION", 40)
    prepared = M.prepare(wide)
    assert prepared.rows.rdd.getNumPartitions() == -(-n // 40) > 1 and prepared.rows.count() == n


def test_training_partitions_stay_with_the_cores(spark, small_model, monkeypatch):
    """a level merges a table from each partition, so their number follows the cores, and the rows a task holds are bounded."""
    ws, _, _ = small_model
    wide = QA.with_split(ws.wide)
    cores = M.train_cores(spark)
    monkeypatch.setattr(M, "TRAIN_ROWS_PER_PARTITION", 1)
    prepared = M.prepare(wide)
    assert prepared.rows.rdd.getNumPartitions() == cores < prepared.rows.count() == wide.count()
    monkeypatch.undo()
    assert [M.training_partitions(n, 12) for n in (0, 1, 20_000, 20_001, 540_000, 3_000_000, 3_000_001, 30_000_000)] == [
        1, 1, 1, 2, 12, 12, 24, 120]
