"""Model-backed query keys (U1-U15, A25, S13, L5).  Checked rows-only, except U1 (SQL).

The pipeline is fitted once per (session, data root, parameters) on the training split
and saved under the shared folder; later keys load that version instead of refitting.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import explain as XP
from ..operators import features as FE
from ..operators import model as M
from ..operators import quality as QA
from ..session import scratch_path
from ..sources import io as IO
from .queries import KEY, register
from .workspace import Workspace

# The reference's hyper-parameter configurations by number of runs.
SWEEP_CONFIGS = {
    1: [(100, 6, 0.1)],
    2: [(30, 4, 0.3), (40, 5, 0.25)],
    3: [(30, 4, 0.3), (40, 5, 0.25), (50, 6, 0.2)],
}

_LOCK = threading.Lock()
_FITS: dict[tuple, threading.Lock] = {}   # one fit at a time of the same model
_CACHE: dict[tuple, tuple[PipelineModel, str]] = {}


def param_grid(num_runs: int) -> list[M.GBTParams]:
    """1-3 fixed configurations, or ``num_runs`` evenly spaced ones."""
    if num_runs in SWEEP_CONFIGS:
        return [M.GBTParams(n, d, lr) for n, d, lr in SWEEP_CONFIGS[num_runs]]
    step = 0.15 / max(1, num_runs - 1)
    return [M.GBTParams(30 + 10 * i, 4 + i, round(0.3 - step * i, 3)) for i in range(num_runs)]


def split_frames(ws: Workspace) -> dict[str, DataFrame]:
    s = QA.with_split(ws.wide)
    return {k: s.filter(F.col("split") == k) for k in ("train", "validation", "test")}


def trained(ws: Workspace, params: M.GBTParams = M.GBTParams(), prepared: M.Prepared | None = None) -> tuple[PipelineModel, str]:
    """Fit on the training split once per data version; returns (model, saved path).

    The saved pipeline is keyed by the feature-store key (data fingerprint + clock +
    definitions) and the parameters, so another process over the same data loads it
    instead of refitting; a new fit is saved to a private path and renamed into place. Calls with different parameters may
    run side by side, on the same ``prepared`` rows.
    """
    import hashlib
    import uuid
    from pyspark.ml import PipelineModel as PM
    from ..session import path_exists, rename_path
    from .feature_store import default_buckets, store_key

    with _LOCK:
        buckets = default_buckets(ws.spark, ws.cat)
        tag = hashlib.sha1(f"{store_key(ws.spark, ws.cat, ws.as_of, buckets)}|{params}".encode()).hexdigest()[:16]
        mem_key = (id(ws.spark), tag)   # the tag names data, clock, definitions and parameters
        own = _FITS.setdefault(mem_key, threading.Lock())
    with own:
        if mem_key in _CACHE:
            return _CACHE[mem_key]
        path = scratch_path(ws.spark, "models", M.MODEL_NAME.lower(), tag)
        if path_exists(ws.spark, f"{path}/metadata"):
            model = PM.load(path)
        else:
            model = M.fit(prepared or split_frames(ws)["train"], params)
            tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
            model.write().save(tmp)
            if rename_path(ws.spark, tmp, path):
                metrics_row = M.evaluate(model, split_frames(ws)["validation"]).first().asDict()
                M.register_version(ws.spark, path, tag, metrics_row, params, comment=f"trained on {ws.root}")
        _CACHE[mem_key] = (model, path)
        return _CACHE[mem_key]


@register("label_encode")
def label_encode(ws):  # U1: indexers fitted on the training split, applied to every row
    train = split_frames(ws)["train"]
    stages = [e.fit(train) for e in M.label_encoders()]
    out = ws.spine
    for s in stages:
        out = s.transform(out)
    return out.select(KEY, *[F.col(M.indexed_name(c)).cast("int").alias(M.indexed_name(c))
                             for c in FE.CATEGORICAL_FEATURES])


@register("gbt_fit")
def gbt_fit(ws):  # U2: the fitted ensemble's shape
    model, _ = trained(ws)
    g = M.gbt_stage(model)
    return ws.spark.createDataFrame(
        [(g.getNumTrees, int(g.totalNumNodes), g.numFeatures, float(sum(g.treeWeights)))],
        "num_trees int, total_nodes int, num_features int, weight_sum double")


@register("pipeline_fit")
def pipeline_fit(ws):  # U4: validation metrics of the fitted pipeline
    model, _ = trained(ws)
    return M.evaluate(model, split_frames(ws)["validation"])


@register("predict_batch")
def predict_batch(ws):  # U3: test split scored in one plan beside id and label
    model, _ = trained(ws)
    return M.predict(model, split_frames(ws)["test"], ws.as_of)


@register("churn_probability")
def churn_probability(ws):  # U15
    model, _ = trained(ws)
    return M.predict(model, ws.wide, ws.as_of).select(KEY, "churn_probability")


@register("model_metrics")
def model_metrics(ws):  # A9-A11 on the model's test predictions (tested once, after tuning)
    model, _ = trained(ws)
    return M.evaluate(model, split_frames(ws)["test"])


@register("model_save")
def model_save(ws):  # U7 + S13: registry rows, newest first
    trained(ws)
    return M.versions(ws.spark).select("model_name", "model_version_name", "comment", "is_default")


@register("model_versions")
def model_versions(ws):  # S13 + P18: metric fields out of the JSON metadata
    trained(ws)
    return M.versions(ws.spark).select("model_version_name", "created_on", "is_default", "accuracy", "precision", "recall", "f1_score")


@register("model_sql_function")
def model_sql_function(ws):  # U8: score first, then query the scores in SQL
    model, _ = trained(ws)
    M.predict(model, split_frames(ws)["test"], ws.as_of).createOrReplaceTempView("churnlens_scored")
    return ws.spark.sql("SELECT predicted_churn, COUNT(*) AS n, AVG(churn_probability) AS mean_probability "
                        "FROM churnlens_scored GROUP BY predicted_churn")


@register("gain_importance")
def gain_importance(ws):  # U10
    model, _ = trained(ws)
    return M.gain_importance(model)


@register("top_importance")
def top_importance(ws):  # L5: 15 most important inputs
    model, _ = trained(ws)
    return M.gain_importance(model).orderBy(F.desc("importance"), "feature").limit(15)


def _attribution(ws) -> DataFrame:
    model, path = trained(ws)
    return XP.tree_attribution(ws.spark, model, path, ws.wide)


@register("tree_attribution")
def tree_attribution(ws):  # U9: all rows, with the additivity residual
    a = _attribution(ws)
    return a.select(KEY, F.round("base_value", 6).alias("base_value"), F.round("margin", 6).alias("margin"),
                    F.round(F.col("margin") - F.col("base_value") - F.aggregate(
                        "attribution", F.lit(0.0), lambda acc, x: acc + x), 9).alias("residual"))


@register("mean_abs_attribution")
def mean_abs_attribution(ws):  # A25
    return XP.mean_abs_attribution(XP.attribution_long(_attribution(ws)))


@register("attribution_dependence")
def attribution_dependence(ws):  # U12
    # read for the ranking and for the bins: attributed once
    long = XP.attribution_long(IO.write_and_read(ws.spark, _attribution(ws), "attributions"))
    return XP.attribution_dependence(long, ws.wide, XP.mean_abs_attribution(long))


@register("permutation_importance")
def permutation_importance(ws):  # U11
    model, _ = trained(ws)
    return XP.permutation_importance(model, split_frames(ws)["validation"])


def score_subscribers(spark, root: str, as_of=None, out: str | None = None,
                      ws: Workspace | None = None, version: str | None = None) -> DataFrame:
    """U13, the nightly job: unlabelled base + views, fill 0 (D5: no row dropped), predict with the named or the
    default version of the registry, write (id, predicted_churn, scored_at) as a new version, return it.

    Nothing is fitted here: new data is scored by the registered model. A registry without a default is an error.
    """
    from ..sources.schemas import DEFAULT_AS_OF
    ws = ws or Workspace(spark, root, as_of or DEFAULT_AS_OF, materialize=True)
    model = M.load_version(spark, version)
    base = FE.subscriber_base(ws.cat, ws.as_of)
    wide = FE.join_views(base, ws.views).fillna(0)
    scores = M.predict(model, wide, ws.as_of).select(KEY, "predicted_churn",
                                                     F.col("prediction_timestamp").alias("scored_at"))
    if out:
        IO.sink_overwrite(scores, out)
        return spark.read.parquet(out)
    return IO.write_and_read(spark, scores, "ml/daily_churn_scores")


@register("daily_scores")
def daily_scores(ws):  # U13: with the default version; the first run on an empty registry registers one
    if not M.has_default(ws.spark):
        M.set_default(ws.spark, trained(ws)[1].rsplit("/", 1)[1])
    return score_subscribers(ws.spark, ws.root, ws.as_of, ws=ws)


@register("score_profiles")
def score_profiles(ws):  # U14: every monthly subscriber re-scored as if on annual billing
    model, _ = trained(ws)
    monthly = ws.wide.filter(F.col("billing_cycle") == "monthly")
    before = M.predict(model, monthly, ws.as_of).select(KEY, F.col("churn_probability").alias("p_before"))
    after = M.predict(model, monthly.withColumn("billing_cycle", F.lit("annual")), ws.as_of).select(
        KEY, F.col("churn_probability").alias("p_after"))
    return before.join(after, KEY).withColumn("change", F.round(F.col("p_after") - F.col("p_before"), 6))


#: Fits of a sweep that run side by side: each is a long row of small jobs that leaves most cores idle.
PARALLEL_FITS = 4


def sweep(ws, params: list[M.GBTParams], parallel: int = PARALLEL_FITS) -> DataFrame:
    """U5 + U6: fit each configuration, validate all, pick the best F1 (W1), test that one once and make it the
    default version. Appends the runs to the stored table (S5) and returns the winner with its test metrics.

    The training rows are encoded and stored once for all fits, and ``parallel`` fits run at a time.
    """
    from concurrent.futures import ThreadPoolExecutor
    frames = split_frames(ws)
    metrics = ("accuracy", "precision", "recall", "f1_score")
    prepared = M.prepare(frames["train"])

    def one(p: M.GBTParams) -> tuple:
        model, path = trained(ws, p, prepared)
        m = M.evaluate(model, frames["validation"]).first()
        return model, path, (p.run_name, p.n_estimators, p.max_depth, p.learning_rate, *[float(m[x]) for x in metrics])

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = list(pool.map(one, params))
    paths = {run[0]: (model, path) for model, path, run in done}
    df = ws.spark.createDataFrame([run for _, _, run in done], "run_name string, n_estimators int, max_depth int, learning_rate double, "
                                                               "accuracy double, precision double, recall double, f1_score double")
    df = df.withColumn("run_timestamp", F.current_timestamp())
    IO.append_runs(df, IO.runs_path(ws.spark, ws.data_version))
    best = EV.best_run(df)
    model, path = paths[best.first()["run_name"]]
    tested = M.evaluate(model, frames["test"]).select(*[F.col(x).alias(f"test_{x}") for x in metrics])
    M.set_default(ws.spark, path.rsplit("/", 1)[1])
    return best.crossJoin(tested)   # one row x one row


@register("sweep_select")
def sweep_select(ws):
    return sweep(ws, param_grid(3))


@register("sweep_facts")
def sweep_facts(ws):  # U6 + S14: the stored table holds every run of the sweep, its winner has the best F1 and is the default
    params = param_grid(2)
    winner = sweep(ws, params).first()
    runs = IO.newest_runs(ws.spark, IO.runs_path(ws.spark, ws.data_version), 1000, prefix="gbt_").where(
        F.col("run_name").isin([p.run_name for p in params]))
    inside = [F.col(m).between(0, 1).cast("int") for m in IO.RUN_METRICS]
    facts = runs.agg(
        F.countDistinct("run_name").alias("configurations"), F.countDistinct("n_estimators", "max_depth", "learning_rate").alias("settings"),
        F.min(sum(inside[1:], inside[0])).alias("metrics_in_range"), (F.round(F.max("f1_score"), 6) == round(winner["f1_score"], 6)).cast("int").alias("winner_is_best"))
    default = M.versions(ws.spark).agg(F.sum(F.col("is_default").cast("int")).alias("defaults"))
    wide = facts.crossJoin(default)   # one row x one row
    return wide.select([F.col(c).cast("double").alias(c) for c in wide.columns]).unpivot([], wide.columns, "fact", "value")


@register("model_surface_facts")
def model_surface_facts(ws):  # what must hold of the rows that each model query returns, whatever the model
    model, path = trained(ws)
    cells = lambda key, df, **facts: df.agg(*[c.cast("double").alias(n) for n, c in facts.items()]).unpivot(
        [], list(facts), "fact", "value").select(F.lit(key).alias("query"), "fact", "value")
    rows, ids = F.count(F.lit(1)), F.countDistinct(KEY)
    flag = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0))
    loaded = M.predict(PipelineModel.load(path), split_frames(ws)["test"], ws.as_of)
    ranked = M.gain_importance(model).orderBy(F.desc("importance"), "feature").limit(15)
    parts = [
        cells("predict_batch", predict_batch(ws), rows=rows, ids=ids, nulls=flag(F.col("predicted_churn").isNull())),
        cells("churn_probability", churn_probability(ws), rows=rows, ids=ids, inside=flag(F.col("churn_probability").between(0, 1))),
        cells("daily_scores", daily_scores(ws), rows=rows, ids=ids, classes=flag(F.col("predicted_churn").isin(0, 1))),
        cells("score_profiles", score_profiles(ws), rows=rows, ids=ids,
              off=flag(F.abs(F.col("change") - (F.col("p_after") - F.col("p_before"))) > 1e-6)),
        cells("model_sql_function", model_sql_function(ws), rows=F.sum("n"), outside=flag(~F.col("mean_probability").between(0, 1))),
        cells("model_save", loaded.exceptAll(predict_batch(ws)), rows=rows),
        cells("model_versions", M.versions(ws.spark).where(F.col("model_version_name") == path.rsplit("/", 1)[1]).limit(1), rows=rows,
              metrics=flag(F.col("accuracy").between(0, 1) & F.col("f1_score").between(0, 1))),
        cells("gain_importance", M.gain_importance(model), rows=rows, total=F.round(F.sum("importance"), 6), negative=flag(F.col("importance") < 0)),
        cells("top_importance", ranked, rows=rows, features=F.countDistinct("feature")),
        cells("gbt_fit", gbt_fit(ws), trees=F.max("num_trees"), inputs=F.max("num_features")),
        cells("pipeline_fit", pipeline_fit(ws), rows=rows, inside=flag(F.col("accuracy").between(0, 1))),
        cells("model_metrics", model_metrics(ws), rows=rows, inside=flag(F.col("f1_score").between(0, 1))),
    ]
    return reduce(DataFrame.unionByName, parts)


@register("param_grid")
def param_grids(ws):  # U5: the configurations of every sweep size the page offers, with the rows each would be fitted on
    rows = [(n, i, p.n_estimators, p.max_depth, p.learning_rate) for n in (1, 2, 3, 4, 10, 23, 60) for i, p in enumerate(param_grid(n))]
    grid = ws.spark.createDataFrame(rows, "num_runs int, run int, n_estimators int, max_depth int, learning_rate double")
    train = split_frames(ws)["train"].agg(F.count(F.lit(1)).alias("training_rows"))
    return grid.crossJoin(F.broadcast(train))   # one-row side


@register("model_facts")
def model_facts(ws):  # what must hold of every fitted model's outputs, whatever the model
    model, _ = trained(ws)
    scored = M.predict(model, split_frames(ws)["validation"], ws.as_of)
    p, a = F.col("predicted_churn"), F.col("actual_churn")
    facts = scored.agg(
        F.count(F.lit(1)).alias("scored_rows"), F.countDistinct(KEY).alias("scored_ids"), F.sum(a).alias("positives"),
        F.sum(((p == 1) & (a == 1)).cast("int") + ((p == 0) & (a == 0)).cast("int") + ((p == 1) & (a == 0)).cast("int")
              + ((p == 0) & (a == 1)).cast("int")).alias("confusion_cells"),
        F.sum(p.isNull().cast("int") + F.col("churn_probability").isNull().cast("int")).alias("nulls"),
        F.sum((~F.col("churn_probability").between(0, 1)).cast("int")).alias("outside_0_1"),
        F.sum(((F.col("churn_probability") > 0.5).cast("int") != p).cast("int") * (F.col("churn_probability") != 0.5).cast("int")).alias("against_probability"))
    importance = M.gain_importance(model).agg(F.round(F.sum("importance"), 6).alias("importance_sum"), F.count(F.lit(1)).alias("inputs"))
    names = ["scored_rows", "scored_ids", "positives", "confusion_cells", "nulls", "outside_0_1", "against_probability", "importance_sum", "inputs"]
    wide = facts.crossJoin(importance).select(*[F.col(c).cast("double").alias(c) for c in names])   # one row x one row
    return wide.unpivot([], names, "fact", "value")


@register("risk_factors_model")
def risk_factors_model(ws):  # Q6 with the model's own ranking: top-6 features by mean |SHAP|
    imp = XP.mean_abs_attribution(XP.attribution_long(_attribution(ws))).select(
        F.regexp_replace("feature", "_idx$", "").alias("feature"), F.col("shap_importance").alias("importance"))
    from ..operators import business as BZ
    return BZ.risk_factors(ws.wide, imp, top_n=6)


@register("model_prediction_nulls")
def model_prediction_nulls(ws):  # A20 on the fitted model's validation predictions
    model, _ = trained(ws)
    return QA.prediction_nulls(M.predict(model, split_frames(ws)["validation"], ws.as_of))


@register("model_degenerate_check")
def model_degenerate_check(ws):  # A21 on the fitted model's validation predictions (all rows, no sample)
    model, _ = trained(ws)
    return QA.degenerate_check(M.predict(model, split_frames(ws)["validation"], ws.as_of))


@register("score_one")
def score_one(ws):  # the predict page: one subscriber's stored feature row scored by the loaded model
    model, _ = trained(ws)
    top = (ws.predictions.filter(F.col("predicted_churn") == 1)
           .join(ws.payment_view.select(KEY, "total_revenue"), KEY)
           .orderBy(F.desc("total_revenue"), KEY).limit(1).select(KEY))
    return M.predict(model, ws.lookup([r[0] for r in top.collect()]), ws.as_of)


@register("importance_explained")
def importance_explained(ws):  # L5 + F19: the 15 largest mean |SHAP| features with their explanations
    from ..operators import business as BZ
    imp = XP.mean_abs_attribution(XP.attribution_long(_attribution(ws)))
    top = imp.orderBy(F.desc("shap_importance"), "feature").limit(15)
    return BZ.with_explanation(top)
