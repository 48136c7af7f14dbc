"""Model explanations.

U9 computes exact path-dependent tree SHAP values (Lundberg, Erion & Lee, 2018,
"Consistent individualized feature attribution for tree ensembles") for every row --
not a 500-row sample.  At each leaf they depend on a row only through which features of
the leaf's path it agrees with, so one kernel gives the contributions for a matrix of
agreements: of all patterns once per model, as tables of at most MAX_TABLE_BYTES in
all, and of a batch's rows at leaves whose tables would go beyond that.  The model's
nodes and those tables are broadcast (size independent of the data); rows stream
through ``mapInPandas`` in Arrow batches.

Margin scale: Spark's boosted trees predict ``sum(weight_t * tree_t(x))`` and
``P(churn) = 1 / (1 + exp(-2 * margin))``; attributions satisfy
``base_value + sum(attribution) == margin`` (checked in the tests).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import list_dir
from ..sources.io import materialize, write_and_read
from .features import KEY
from .model import LABEL, feature_columns, gbt_stage, model_inputs
from .order_stats import positions


@dataclass
class TreeTable:
    left: np.ndarray        # child ids, -1 at leaves
    right: np.ndarray
    feature: np.ndarray     # split feature index, -1 at leaves
    threshold: np.ndarray   # continuous split: left if x <= threshold
    categories: list        # categorical split: set of categories going left, else None
    value: np.ndarray       # leaf prediction x tree weight
    cover: np.ndarray       # training rows reaching the node


def load_tree_tables(spark: SparkSession, model_path: str, weights: list[float]) -> list[TreeTable]:
    """Node tables of the saved GBT stage (one small collect: the model, not the data)."""
    stages = list_dir(spark, f"{model_path.rstrip('/')}/stages")
    stage_dir = [d for d in stages if "GBTClassifier" in d.rsplit("/", 1)[-1]][0]
    rows = (spark.read.parquet(f"{stage_dir}/data")
            .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
                    "nodeData.rightChild", "nodeData.split.featureIndex",
                    "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories")
            .collect())
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    tables = []
    for t in sorted(by_tree):
        nodes = sorted(by_tree[t], key=lambda r: r["id"])
        n = len(nodes)
        tt = TreeTable(np.full(n, -1), np.full(n, -1), np.full(n, -1), np.zeros(n), [None] * n,
                       np.zeros(n), np.zeros(n))
        for r in nodes:
            i = r["id"]
            tt.left[i], tt.right[i] = r["leftChild"], r["rightChild"]
            tt.value[i] = r["prediction"] * weights[t]
            tt.cover[i] = float(r["rawCount"])
            if r["leftChild"] >= 0:
                tt.feature[i] = r["featureIndex"]
                if r["numCategories"] is not None and r["numCategories"] >= 0:
                    tt.categories[i] = np.array(r["leftCategoriesOrThreshold"], dtype=float)
                else:
                    tt.threshold[i] = r["leftCategoriesOrThreshold"][0]
        tables.append(tt)
    return tables


def _goes_left(tt: TreeTable, node: int, x: np.ndarray) -> np.ndarray:
    if tt.categories[node] is not None:
        return np.isin(x, tt.categories[node])
    return x <= tt.threshold[node]


def tree_margin(tables: list[TreeTable], X: np.ndarray) -> np.ndarray:
    """Raw margin sum(weight * leaf) by walking each tree (vectorised over rows)."""
    out = np.zeros(X.shape[0])
    columns = np.ascontiguousarray(X.T)
    for tt in tables:
        stack = [(0, np.arange(X.shape[0]))]   # a node and the rows that reach it
        while stack:
            node, rows = stack.pop()
            if tt.left[node] < 0:
                out[rows] += tt.value[node]
            elif len(rows):
                goes = _goes_left(tt, node, columns[tt.feature[node]][rows])
                stack += [(tt.left[node], rows[goes]), (tt.right[node], rows[~goes])]
    return out


def expected_value(tables: list[TreeTable]) -> float:
    """Cover-weighted mean of the leaves, summed over trees (the SHAP base value)."""
    total = 0.0
    for tt in tables:
        leaves = tt.left < 0
        total += float((tt.value[leaves] * tt.cover[leaves]).sum() / tt.cover[0])
    return total


# ---------------------------------------------------------------------------
# Contributions of a leaf by patterns of agreement (Fast TreeSHAP, Yang 2021)
# ---------------------------------------------------------------------------

#: Bytes of a model's pattern tables; leaves beyond it are computed for each batch.
MAX_TABLE_BYTES = 64 << 20


@dataclass
class Leaf:
    splits: list            # per path feature: [(node, went_left), ...] along the root->leaf path
    features: np.ndarray    # path features
    ratios: np.ndarray      # product of the cover ratios along each path feature's splits
    value: float
    table: np.ndarray | None = None   # (2^m, m): contribution of each path feature for each pattern of agreement


def contributions(leaf: Leaf, agree: np.ndarray) -> np.ndarray:
    """Each path feature's contribution at a leaf, for rows of 0/1 agreements with the path features.

    Of m path features, a set of k others is known before u with weight k! (m - 1 - k)! / m!, which is the integral of
    t^k (1 - t)^(m - 1 - k) over 0..1.  So the sum over all sets is the integral of the product over the others of
    t * agrees + (1 - t) * ratio: a polynomial of degree m - 1, which Gauss-Legendre nodes integrate exactly.
    """
    m = agree.shape[1]
    out = np.zeros(agree.shape)
    for x, weight in zip(*np.polynomial.legendre.leggauss(m // 2 + 1)):
        t = (x + 1) / 2
        factors = t * agree + (1 - t) * leaf.ratios
        out += weight / 2 * factors.prod(axis=1, keepdims=True) / factors
    return out * (agree - leaf.ratios) * leaf.value


def leaf_tables(tt: TreeTable, room: int = MAX_TABLE_BYTES) -> list[Leaf]:
    """Every leaf with its path, and the contributions of all its patterns as long as the tables fit ``room`` bytes."""
    out = []
    stack: list[tuple[int, dict, dict]] = [(0, {}, {})]
    while stack:
        node, splits, ratios = stack.pop()
        if tt.left[node] >= 0:
            f = int(tt.feature[node])
            for child, went_left in ((tt.left[node], True), (tt.right[node], False)):
                stack.append((child, splits | {f: splits.get(f, []) + [(node, went_left)]},
                              ratios | {f: ratios.get(f, 1.0) * tt.cover[child] / tt.cover[node]}))
            continue
        leaf = Leaf(list(splits.values()), np.array(list(splits), dtype=int), np.array(list(ratios.values()), dtype=float), tt.value[node])
        m = len(splits)
        if (m << m) * 8 <= room:
            room -= (m << m) * 8
            # by columns: a batch looks up one path feature after the other
            leaf.table = np.asfortranarray(contributions(leaf, ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)))
        out.append(leaf)
    return out


def model_leaves(tables: list[TreeTable], room: int = MAX_TABLE_BYTES) -> list[list[Leaf]]:
    """Leaves of all trees, whose tables share ``room`` bytes."""
    out = []
    for tt in tables:
        out.append(leaf_tables(tt, room))
        room -= sum(leaf.table.nbytes for leaf in out[-1] if leaf.table is not None)
    return out


def agreements(tt: TreeTable, columns: np.ndarray) -> Iterator[list[np.ndarray]]:
    """For every leaf, as ``leaf_tables`` orders them, which rows agree with each of its path features.

    Rows are tested once per split, and leaves share what is known of the path above them.
    """
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, agree = stack.pop()
        if tt.left[node] < 0:
            yield list(agree.values())
            continue
        f = int(tt.feature[node])
        left = _goes_left(tt, node, columns[f])
        for child, went in ((tt.left[node], left), (tt.right[node], ~left)):
            stack.append((child, agree | {f: agree[f] & went if f in agree else went}))


def tree_shap_tables(tables: list[TreeTable], leaves: list[list[Leaf]], X: np.ndarray) -> np.ndarray:
    """SHAP values of a batch, (rows, features), from the leaves of all trees."""
    columns = np.ascontiguousarray(X.T)
    phi = np.zeros(columns.shape)   # a feature's values lie together
    found = np.empty(len(X))
    for tt, own in zip(tables, leaves):
        for leaf, agree in zip(own, agreements(tt, columns)):
            if leaf.table is None:
                phi[leaf.features] += contributions(leaf, np.stack(agree, axis=1).astype(float)).T
                continue
            pattern = np.zeros(len(X), dtype=np.uint8 if len(agree) <= 8 else np.int32)
            for k, a in enumerate(agree):
                pattern |= a.astype(pattern.dtype) << k
            pattern = pattern.astype(np.intp)
            for k, f in enumerate(leaf.features):
                phi[f] += np.take(leaf.table[:, k], pattern, out=found, mode="clip")   # clip: no copy; all patterns are inside
    return np.ascontiguousarray(phi.T)


def tree_shap(tables: list[TreeTable], X: np.ndarray) -> np.ndarray:
    """SHAP values of a batch without pattern tables."""
    return tree_shap_tables(tables, model_leaves(tables, 0), X)


def _features_array(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows as (id, features array) using the fitted encoders and assembler (D11: no re-fit)."""
    prep = PipelineModel(stages=model.stages[:-1])
    return prep.transform(model_inputs(df)).select(KEY, vector_to_array("features").alias("x"))


def tree_attribution(spark: SparkSession, model: PipelineModel, model_path: str, df: DataFrame,
                     rows_per_task: int = 20_000) -> DataFrame:
    """Per row base value, margin and one attribution per model input (wide array).

    The work is CPU-bound Python per row while the input is small in bytes, so AQE would
    coalesce it into a single task; the rows are spread over an explicit partition count
    (about ``rows_per_task`` rows each, at least the cluster's parallelism) instead.
    """
    tables = load_tree_tables(spark, model_path, list(gbt_stage(model).treeWeights))
    base = expected_value(tables)
    leaves = model_leaves(tables)   # per model, row-independent
    bc = spark.sparkContext.broadcast((tables, leaves))

    def attribute(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf["x"].to_numpy())
            tabs, lvs = bc.value
            phi = tree_shap_tables(tabs, lvs, X)
            yield pd.DataFrame({KEY: pdf[KEY].to_numpy(), "base_value": base,
                                "margin": tree_margin(tabs, X), "attribution": list(phi)})

    schema = f"{KEY} string, base_value double, margin double, attribution array<double>"
    feats = _features_array(model, df)
    n = feats.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n // rows_per_task))
    return feats.repartition(parts, KEY).mapInPandas(attribute, schema)


def attribution_long(attr: DataFrame) -> DataFrame:
    """(id, feature, attribution) rows."""
    names = F.array(*[F.lit(c) for c in feature_columns()])
    return attr.select(KEY, F.posexplode("attribution").alias("pos", "attribution")).select(
        KEY, F.element_at(names, F.col("pos") + 1).alias("feature"), "attribution")


def mean_abs_attribution(long: DataFrame) -> DataFrame:
    """Mean |attribution| per feature (all rows kept; take the top 15 on read, D12)."""
    return long.groupBy("feature").agg(F.round(F.avg(F.abs("attribution")), 6).alias("shap_importance"))


def attribution_dependence(long: DataFrame, wide: DataFrame, importance: DataFrame, top_n: int = 6,
                           bins: int = 10) -> DataFrame:
    """For the top features, mean attribution per equal-width bin of the feature value."""
    top = importance.orderBy(F.desc("shap_importance"), "feature").limit(top_n).select("feature")
    from .monitor import to_long
    numeric = [c for c in feature_columns() if not c.endswith("_idx")]
    vals = to_long(wide.select(KEY, *[F.col(c).cast("double").alias(c) for c in numeric]), numeric, [KEY])
    # both sides have a row per id and feature: Spark takes the unpivoted one for as small as the table and would collect it
    j = long.join(F.broadcast(top), "feature").join(vals.join(F.broadcast(top), "feature").hint("merge"), [KEY, "feature"])
    j = write_and_read(wide.sparkSession, j.select("feature", "value", "attribution"), "attribution_values")
    rng = j.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = j.join(F.broadcast(rng), "feature")  # one row per top feature
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / width * bins),
                                                 F.lit(bins - 1))).cast("int")
    return j.withColumn("bin", b).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean_value"),
        F.round(F.avg("attribution"), 6).alias("mean_attribution"))


def permuted_columns(rows: DataFrame, cols: list[str], seed: int = 42) -> DataFrame:
    """``rows`` with ``_s_<c>`` for each of ``cols``: the values of another row, all from the same one, by one permutation of all rows.

    Rows are numbered twice, each time along an order by a seeded hash of the key (ranges with summed counts, see
    ``order_stats.positions``); the row at a place of the first order takes the values of the row at that place of the second. The
    orders depend on keys alone, so the permutation doesn't change with partitioning or the number of machines.
    """
    own = positions(rows, [F.xxhash64(KEY, F.lit(seed)), F.col(KEY), F.xxhash64(*cols)])   # the last only parts rows of one key
    # renamed before they are stored, so that the plan behind it is free of aliases (the optimizer derives constraints from each)
    moved = rows.select(KEY, *[F.col(c).alias(f"_s_{c}") for c in cols])
    other = positions(moved, [F.xxhash64(KEY, F.lit(seed + 1)), F.col(KEY), F.xxhash64(*[f"_s_{c}" for c in cols])]).drop(KEY)
    return own.join(other, "row_number").drop("row_number")


def permutation_importance(model: PipelineModel, df: DataFrame, features: list[str] | None = None, seed: int = 42) -> DataFrame:
    """Accuracy drop when one input column is shuffled over the whole table (``permuted_columns``).

    Each row is repeated once per feature (by its index, the column replaced where the index says so) and once
    unchanged; all variants are scored by a single ``transform`` and one groupBy gives the permuted and the base accuracy.
    """
    names = features or list(feature_columns())
    cols = [f[:-4] if f.endswith("_idx") else f for f in names]
    shuffled = materialize(permuted_columns(model_inputs(df), cols, seed))
    variants = shuffled.withColumn("_v", F.explode(F.sequence(F.lit(-1), F.lit(len(cols) - 1))))
    scored = model.transform(variants.select(KEY, LABEL, "_v", *[
        F.when(F.col("_v") == i, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for i, c in enumerate(cols)]))
    acc = scored.groupBy("_v").agg(F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("accuracy"))
    every = Window.partitionBy(F.lit(0))   # one row a feature
    acc = acc.withColumn("base_accuracy", F.max(F.when(F.col("_v") == -1, F.col("accuracy"))).over(every))
    feature = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_v") + 1)
    return acc.where("_v >= 0").select(feature.alias("feature"), F.round("accuracy", 6).alias("permuted_accuracy"),
                                       F.round(F.col("base_accuracy") - F.col("accuracy"), 6).alias("importance"))
