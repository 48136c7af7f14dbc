"""Feature statistics, drift and model monitoring (A15, A24, A28, Q1, Q8-Q11, Q18, Q19, T1 batch).

A15 replaces the reference's 28-branch UNION ALL (which Spark would plan as 28 scans
and 28 shuffles) with one unpivot and one ``groupBy('feature')``: each input row is
read once, partial aggregates (including the mergeable percentile sketch) are built
map-side, and only 28 small groups cross the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ratio_or_zero, round_ratio
from . import drift

# Fixed values of the reference's monitoring rules.
BASELINE_CHURN_RATE = 0.29
BASELINE_ACCURACY = 0.90
ALERT_DRIFT = 0.15
RETRAIN_ACCURACY = 0.85
PROPORTION_FLOOR = 1e-4


def to_long(df: DataFrame, features: list[str], id_cols: list[str] | None = None) -> DataFrame:
    """Unpivot numeric feature columns to (feature, value double)."""
    id_cols = id_cols or []
    casted = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in features])
    return casted.unpivot(id_cols, features, "feature", "value")


def feature_stats(long: DataFrame, exact_median: bool = False) -> DataFrame:
    """Non-null count, mean, sample std, min, max, median per feature in one pass."""
    v = F.col("value")
    med = F.median(v) if exact_median else F.percentile_approx(v, 0.5)
    return long.groupBy("feature").agg(
        F.count(v).alias("cnt"),
        round_ratio(F.avg(v)).alias("mean"),
        round_ratio(F.stddev(v)).alias("std"),
        F.min(v).alias("min_val"),
        F.max(v).alias("max_val"),
        med.alias("median"),
    )


def class_histogram(long_with_label: DataFrame, bins: int = 10, label: str = "churned") -> DataFrame:
    """Equal-width histogram per feature and class over the whole table (no sampling).

    Range per feature is one aggregate row per feature -- bounded by the feature count,
    so broadcasting it is safe.
    """
    rng = long_with_label.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long_with_label.filter(F.col("value").isNotNull()).join(F.broadcast(rng), "feature")
    width = F.col("hi") - F.col("lo")
    bucket = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1))).cast("int")
    return (j.withColumn("bucket", bucket)
            .groupBy("feature", label, "bucket")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.first("lo").alias("lo"), F.first("hi").alias("hi"))
            .select("feature", label, "bucket", "n",
                    round_ratio(F.col("lo") + F.col("bucket") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start")))


def health_status(pred: DataFrame, baseline_churn: float = BASELINE_CHURN_RATE,
                  baseline_accuracy: float = BASELINE_ACCURACY) -> DataFrame:
    """Q1: drift of the predicted rate and the Healthy / Warning / Critical rule (D18 kept)."""
    m = pred.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.avg((F.col("predicted_churn") == 1).cast("double")).alias("predicted_churn_rate"),
        F.avg((F.col("actual_churn") == 1).cast("double")).alias("actual_churn_rate"),
        F.avg((F.col("predicted_churn") == F.col("actual_churn")).cast("double")).alias("accuracy"),
    )
    drift = F.abs(F.col("predicted_churn_rate") - baseline_churn) / baseline_churn
    acc = F.col("accuracy")
    status = (F.when((acc >= 0.90) & (drift < 0.1), "Healthy")
              .when((acc >= 0.85) | (drift < 0.2), "Warning")
              .otherwise("Critical"))
    return m.select(
        "total_predictions",
        round_ratio("predicted_churn_rate").alias("predicted_churn_rate"),
        round_ratio("actual_churn_rate").alias("actual_churn_rate"),
        round_ratio(acc).alias("accuracy"),
        round_ratio(drift).alias("churn_drift"),
        round_ratio((F.lit(baseline_accuracy) - acc) / baseline_accuracy).alias("accuracy_drift"),
        status.alias("health"),
    )


def drift_alert(pred: DataFrame, baseline_churn: float = BASELINE_CHURN_RATE,
                threshold: float = ALERT_DRIFT) -> DataFrame:
    """Q8 (J16): one-row aggregate; fires when |avg(predicted) - base| / base > threshold.

    Empty input gives a NULL rate and no alert (D16), unlike the reference's EXISTS form.
    """
    m = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("predicted_churn").cast("double")).alias("rate"))
    drift = F.abs(F.col("rate") - baseline_churn) / baseline_churn
    return m.select("n", round_ratio("rate").alias("predicted_rate"), round_ratio(drift).alias("drift"),
                    F.coalesce((drift > threshold).cast("int"), F.lit(0)).alias("fires"))


def mean_shift(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Q9: per feature |mean - base| / max(base, 0.001), Stable / Monitor / Drifted, spread = std / mean.

    Both inputs are A15 outputs (one row per feature), so the join is tiny.
    """
    b = baseline.select("feature", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"))
    j = current.select("feature", "cnt", "mean", "std").join(b, "feature")
    score = F.abs(F.col("mean") - F.col("baseline_mean")) / F.greatest(F.col("baseline_mean"), F.lit(0.001))
    return j.select(
        "feature", "cnt", "mean", "baseline_mean",
        round_ratio(score).alias("drift_score"),
        F.when(score < 0.1, "Stable").when(score < 0.2, "Monitor").otherwise("Drifted").alias("status"),
        round_ratio(F.when(F.col("mean") != 0, F.col("std") / F.col("mean")).otherwise(0.0)).alias("spread"),
    )


def bin_proportions(sketch_rows: DataFrame, n_bins: int = 10) -> DataFrame:
    """Expected (baseline) and actual (current) bin shares per feature, floored for empty bins, from merged sketches."""
    j = drift.bins(sketch_rows, n_bins=n_bins)
    w = Window.partitionBy("feature")   # at most n_bins rows
    share = lambda n: F.greatest(F.try_divide(F.col(n), F.sum(n).over(w)), F.lit(PROPORTION_FLOOR))
    return j.select("feature", "bin", share("n_expected").alias("p_expected"), share("n_actual").alias("p_actual"))


def split_sketches(baseline_long: DataFrame, current_long: DataFrame) -> DataFrame:
    """Sketches of two frames of (feature, value) rows as the baseline's and the current split's."""
    labelled = baseline_long.withColumn("split", F.lit("train")).unionByName(current_long.withColumn("split", F.lit("test")))
    return drift.sketches(labelled)


def psi(sketch_rows: DataFrame, n_bins: int = 10) -> DataFrame:
    """Q10: population stability index per feature; < 0.1 stable, < 0.2 moderate, else significant."""
    p = bin_proportions(sketch_rows, n_bins)
    term = (F.col("p_actual") - F.col("p_expected")) * F.ln(F.col("p_actual") / F.col("p_expected"))
    s = p.groupBy("feature").agg(F.sum(term).alias("psi"))
    return s.select("feature", round_ratio("psi").alias("psi"),
                    F.when(F.col("psi") < 0.1, "stable").when(F.col("psi") < 0.2, "moderate")
                    .otherwise("significant").alias("band"))


def distribution_distance(sketch_rows: DataFrame, n_bins: int = 10) -> DataFrame:
    """Q11: KL, Jensen-Shannon, Kolmogorov-Smirnov, chi-squared and Wasserstein (in bin units) per feature."""
    p = bin_proportions(sketch_rows, n_bins)
    a, e = F.col("p_actual"), F.col("p_expected")
    m = (a + e) / 2
    w = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("cdf_gap", F.abs(F.sum(a).over(w) - F.sum(e).over(w)))
    return p.groupBy("feature").agg(
        round_ratio(F.sum(a * F.ln(a / e))).alias("kl"),
        round_ratio(F.sum(0.5 * a * F.ln(a / m) + 0.5 * e * F.ln(e / m))).alias("js"),
        round_ratio(F.max("cdf_gap")).alias("ks"),
        round_ratio(F.sum((a - e) * (a - e) / e)).alias("chi2"),
        round_ratio(F.sum("cdf_gap")).alias("wasserstein"),
    )


# ---------------------------------------------------------------------------
# T1 (batch form), Q18, Q19
# ---------------------------------------------------------------------------

def monitoring_source(pred: DataFrame, ts: DataFrame, ts_col: str) -> DataFrame:
    """(id, timestamp, prediction, actual) with explicit casts."""
    return pred.join(ts.select("subscriber_id", F.col(ts_col).alias("timestamp")), "subscriber_id").select(
        F.col("subscriber_id").cast("string").alias("id"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("predicted_churn").cast("long").alias("prediction"),
        F.col("actual_churn").cast("long").alias("actual"))


def daily_metric_columns(p: str = "prediction", a: str = "actual"):
    p, a = F.col(p), F.col(a)
    tp = F.sum(((p == 1) & (a == 1)).cast("long"))
    fp = F.sum(((p == 1) & (a == 0)).cast("long"))
    fn = F.sum(((p == 0) & (a == 1)).cast("long"))
    correct = F.sum((p == a).cast("long"))
    n = F.count(F.lit(1))
    return [n.alias("volume"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), correct.alias("correct"),
            F.sum(p).alias("predicted_positive")]


def finish_daily(agg: DataFrame) -> DataFrame:
    """Metric ratios from the additive daily counts (so stream and batch share one definition)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return agg.select(
        "day", "volume",
        round_ratio(ratio_or_zero(F.col("correct"), F.col("volume"))).alias("accuracy"),
        round_ratio(precision).alias("precision"),
        round_ratio(recall).alias("recall"),
        round_ratio(f1).alias("f1_score"),
        round_ratio(ratio_or_zero(F.col("predicted_positive"), F.col("volume"))).alias("predicted_rate"),
    )


def monitor_daily(source: DataFrame) -> DataFrame:
    """T1 batch: tumbling one-day windows over the monitoring source."""
    agg = (source.groupBy(F.window("timestamp", "1 day").alias("w"))
           .agg(*daily_metric_columns())
           .withColumn("day", F.col("w.start").cast("date").cast("string")).drop("w"))
    return finish_daily(agg)


def retrain_trigger(daily: DataFrame, threshold: float = RETRAIN_ACCURACY) -> DataFrame:
    """Q18: days whose accuracy fell below the threshold."""
    return daily.filter(F.col("accuracy") < threshold).select("day", "accuracy", "volume")


def melt_metrics(daily: DataFrame, metrics=("accuracy", "precision", "recall", "f1_score")) -> DataFrame:
    """Q19: wide metric columns to (day, metric, value)."""
    return daily.select("day", *metrics).unpivot(["day"], list(metrics), "metric", "value")
