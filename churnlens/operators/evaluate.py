"""Exploration, evaluation and KPI aggregates.

Every operator is a single aggregate or a join + aggregate over the predictions
table (``subscriber_id, actual_churn, predicted_churn, ...``) and the payment view.
One-row outputs are built as one ``agg`` (one job, partial aggregation map-side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import count_when, ratio_or_zero, round_money, round_ratio

KEY = "subscriber_id"


# ---------------------------------------------------------------------------
# Exploration
# ---------------------------------------------------------------------------

def churn_headline(subscribers: DataFrame, history: DataFrame) -> DataFrame:
    """A1: subscribers, cancel events (counted as events, D3), active, shares in percent."""
    total = subscribers.agg(F.count(F.lit(1)).alias("total_subscribers"))
    churned = history.filter(F.col("event_type") == "cancel").agg(F.count(F.lit(1)).alias("churned"))
    both = total.crossJoin(churned)  # two one-row frames
    return both.select(
        "total_subscribers", "churned",
        (F.col("total_subscribers") - F.col("churned")).alias("active"),
        round_ratio(F.try_divide(F.col("churned") * 100.0, F.col("total_subscribers"))).alias("churned_pct"),
        round_ratio(F.try_divide((F.col("total_subscribers") - F.col("churned")) * 100.0,
                                 F.col("total_subscribers"))).alias("active_pct"),
    )


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    """A2: group count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def churn_by_tier(subscribers: DataFrame, history: DataFrame) -> DataFrame:
    """Per tier total, churned, rate %. Non-distinct cancel events joined (D3), as the reference does."""
    cancels = history.filter(F.col("event_type") == "cancel").select(F.col(KEY).alias("cancel_id"))
    j = subscribers.select(KEY, "subscription_tier").join(
        cancels, F.col(KEY) == F.col("cancel_id"), "left")
    flag = F.when(F.col("cancel_id").isNotNull(), 1).otherwise(0)  # P9
    return (j.groupBy("subscription_tier")
            .agg(F.count(F.lit(1)).alias("total"), F.sum(flag).cast("long").alias("churned"))
            .withColumn("churn_rate_pct", round_ratio(F.col("churned") / F.col("total") * 100))
            .orderBy("subscription_tier"))


def label_distribution(wide: DataFrame) -> DataFrame:
    """A2 on the label: rows per class."""
    return count_by(wide, "churned").orderBy("churned")


# ---------------------------------------------------------------------------
# Confusion matrix and metrics
# ---------------------------------------------------------------------------

def confusion_cells(pred: DataFrame) -> DataFrame:
    """Count by actual x predicted."""
    return (pred.groupBy("actual_churn", "predicted_churn").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("actual_churn", "predicted_churn"))


def confusion_row(pred: DataFrame) -> DataFrame:
    """A10: total, predicted, actual, tp, tn, fp, fn in one row (missing cells are 0)."""
    p, a = F.col("predicted_churn"), F.col("actual_churn")
    return pred.agg(
        F.count(F.lit(1)).alias("total"),
        count_when(p == 1).alias("predicted_churn"),
        count_when(a == 1).alias("actual_churn"),
        count_when((p == 1) & (a == 1)).alias("tp"),
        count_when((p == 0) & (a == 0)).alias("tn"),
        count_when((p == 1) & (a == 0)).alias("fp"),
        count_when((p == 0) & (a == 1)).alias("fn"),
    ).fillna(0)


def metrics_from_cells(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 with zero guards, as columns over the A10 row."""
    tp, tn, fp, fn, total = (F.col(c) for c in ("tp", "tn", "fp", "fn", "total"))
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return cells.select(
        "total", "tp", "tn", "fp", "fn",
        round_ratio(ratio_or_zero(tp + tn, total)).alias("accuracy"),
        round_ratio(precision).alias("precision"),
        round_ratio(recall).alias("recall"),
        round_ratio(f1).alias("f1_score"),
    )


def classification_metrics(pred: DataFrame) -> DataFrame:
    return metrics_from_cells(confusion_row(pred))


def _with_revenue(pred: DataFrame, payment_view: DataFrame) -> DataFrame:
    """Predictions left join the payment view's revenue (missing -> 0)."""
    rev = payment_view.select(KEY, "total_revenue")
    return pred.join(rev, KEY, "left").withColumn(
        "revenue", F.coalesce(F.col("total_revenue").cast("double"), F.lit(0.0)))


def kpi_metrics(pred: DataFrame, payment_view: DataFrame) -> DataFrame:
    """Executive KPIs in one row, derived shares kept in the same plan."""
    j = _with_revenue(pred, payment_view)
    p, a = F.col("predicted_churn"), F.col("actual_churn")
    row = j.agg(
        F.count(F.lit(1)).alias("total_subscribers"),
        count_when(p == 1).alias("at_risk"),
        count_when(a == 1).alias("actual_churn"),
        count_when((p == 1) & (a == 1)).alias("tp"),
        F.sum("revenue").alias("total_revenue"),
        F.sum(F.when(p == 1, F.col("revenue")).otherwise(0.0)).alias("revenue_at_risk"),
    )
    return row.select(
        "total_subscribers", "at_risk", "actual_churn", "tp",
        round_money("total_revenue").alias("total_revenue"),
        round_money("revenue_at_risk").alias("revenue_at_risk"),
        round_ratio(ratio_or_zero(F.col("at_risk") * 100.0, F.col("total_subscribers"))).alias("at_risk_pct"),
        round_ratio(ratio_or_zero(F.col("tp"), F.col("actual_churn"))).alias("recall"),
    )


def tier_risk(pred: DataFrame, subscribers: DataFrame, payment_view: DataFrame) -> DataFrame:
    """A13 (J6): per tier subscribers, at risk, revenue, risk % (1 decimal), revenue at risk."""
    j = _with_revenue(pred, payment_view).join(subscribers.select(KEY, "subscription_tier"), KEY)
    p = F.col("predicted_churn")
    return (j.groupBy(F.col("subscription_tier").alias("tier"))
            .agg(F.count(F.lit(1)).alias("subscribers"),
                 count_when(p == 1).alias("at_risk"),
                 F.sum("revenue").alias("revenue"),
                 F.sum(F.when(p == 1, F.col("revenue")).otherwise(0.0)).alias("revenue_at_risk"))
            .select("tier", "subscribers", "at_risk",
                    round_money("revenue").alias("revenue"),
                    F.round(F.col("at_risk").cast("double") / F.col("subscribers") * 100, 1).alias("risk_pct"),
                    round_money("revenue_at_risk").alias("revenue_at_risk"))
            .orderBy(F.desc("at_risk"), "tier"))


def at_risk_summary(pred: DataFrame, payment_view: DataFrame) -> DataFrame:
    """At-risk count, correctly predicted, revenue at risk. Filter first so it reaches the scan."""
    j = _with_revenue(pred.filter(F.col("predicted_churn") == 1), payment_view)
    return j.agg(
        F.count(F.lit(1)).alias("total_at_risk"),
        count_when(F.col("actual_churn") == 1).alias("correctly_predicted"),
        F.sum("revenue").alias("revenue_at_risk"),
    ).select("total_at_risk", F.coalesce("correctly_predicted", F.lit(0)).alias("correctly_predicted"),
             round_money(F.coalesce("revenue_at_risk", F.lit(0.0))).alias("revenue_at_risk"))


def health_means(pred: DataFrame) -> DataFrame:
    """Predicted and actual churn rate and accuracy as means of booleans."""
    return pred.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        round_ratio(F.avg((F.col("predicted_churn") == 1).cast("double"))).alias("predicted_churn_rate"),
        round_ratio(F.avg((F.col("actual_churn") == 1).cast("double"))).alias("actual_churn_rate"),
        round_ratio(F.avg((F.col("predicted_churn") == F.col("actual_churn")).cast("double"))).alias("accuracy"),
    )


def alignment_accuracy(pred: DataFrame) -> DataFrame:
    """Share of rows whose prediction equals the label, from one plan (never paired by position)."""
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        round_ratio(F.avg((F.col("predicted_churn") == F.col("actual_churn")).cast("int"))).alias("accuracy"),
    )


def conditional_counts(pred: DataFrame, payment_view: DataFrame) -> DataFrame:
    """The documentation KPI forms: COUNT(CASE ..), SUM/NULLIF(SUM), join USING."""
    j = pred.join(payment_view.select(KEY, F.col("total_revenue").cast("double").alias("revenue")), KEY)
    p, a = F.col("predicted_churn"), F.col("actual_churn")
    return j.agg(
        F.count(F.lit(1)).alias("total"),
        round_ratio(F.sum(F.when(p == a, 1).otherwise(0)) / F.count(F.lit(1))).alias("accuracy"),
        round_ratio(F.try_divide(F.sum(F.when((p == 1) & (a == 1), 1).otherwise(0)).cast("double"),
                                 F.nullif(F.sum(F.when(a == 1, 1).otherwise(0)), F.lit(0)).cast("double")))
        .alias("recall"),
        F.count(F.when(p == 1, F.lit(1))).alias("at_risk"),
        round_money(F.sum(F.when(p == 1, F.col("revenue")).otherwise(0.0))).alias("revenue_at_risk"),
    )


# ---------------------------------------------------------------------------
# Revenue-ordered lists
# ---------------------------------------------------------------------------

def at_risk_rows(pred: DataFrame, subscribers: DataFrame, payment_view: DataFrame,
                 as_of) -> DataFrame:
    """At-risk subscribers with tier, cycle, tenure, label and revenue."""
    from ..functions.scalar import days_between, ts_lit
    j = (_with_revenue(pred.filter(F.col("predicted_churn") == 1), payment_view)
         .join(subscribers.select(KEY, "subscription_tier", "billing_cycle", "signup_date"), KEY))
    return j.select(
        KEY, "subscription_tier", "billing_cycle",
        days_between("signup_date", ts_lit(as_of)).alias("tenure_days"),
        "actual_churn", round_money("revenue").alias("total_revenue"))


def at_risk_page(rows: DataFrame, page: int = 0, page_size: int = 100) -> DataFrame:
    """L3: one page by revenue descending; the id tie-break makes pages stable."""
    return (rows.orderBy(F.desc("total_revenue"), F.asc(KEY))
            .offset(page * page_size).limit(page_size))


def page_count(rows: DataFrame, page_size: int = 100) -> DataFrame:
    """L3: number of pages, (n - 1) // size + 1 (0 rows -> 0 pages)."""
    n = F.count(F.lit(1))
    return rows.agg(n.alias("n_rows"),
                    F.when(n > 0, F.floor((n - 1) / page_size) + 1).otherwise(0).cast("long").alias("n_pages"))


def number_pages(rows: DataFrame, page_size: int = 100, partitions: int | None = None) -> DataFrame:
    """Global position (revenue desc, id asc; NULL revenue last) and page for every row, without a single-task row_number."""
    from .order_stats import positions
    numbered = positions(rows, [F.desc_nulls_last("total_revenue"), F.asc(KEY)], partitions)
    return numbered.withColumn("page", (F.floor((F.col("row_number") - 1) / page_size) + 1).cast("long"))


def top_by_revenue(rows: DataFrame, n: int) -> DataFrame:
    """First n by revenue (TakeOrderedAndProject)."""
    return rows.orderBy(F.desc("total_revenue"), F.asc(KEY)).limit(n)


def top_value_total(rows: DataFrame, n: int = 20) -> DataFrame:
    """The n highest-revenue at-risk subscribers and their summed revenue."""
    top = top_by_revenue(rows, n)
    return top.agg(F.count(F.lit(1)).alias("n"), round_money(F.sum("total_revenue")).alias("top_revenue"))


def deterministic_sample(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """Order by id, then limit."""
    return df.orderBy(key).limit(n)


def hash_sample(df: DataFrame, n: int, seed: int = 42, key: str = KEY) -> DataFrame:
    """P20: n rows in a repeatable pseudo-random order (unlike rand(), stable across runs)."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


# ---------------------------------------------------------------------------
# Runs (W1, W4, J15)
# ---------------------------------------------------------------------------

def best_run(runs: DataFrame) -> DataFrame:
    """The run with the highest F1; the earliest run wins ties."""
    return runs.orderBy(F.desc("f1_score"), F.asc("run_timestamp"), F.asc("run_name")).limit(1)


def metric_trend(series: DataFrame, time_col: str, metrics: list[str]) -> DataFrame:
    """Metrics in time order with the change against the previous row.

    The series is one row per run or per day (small by construction); ordering it needs
    no partition key.
    """
    w = Window.orderBy(time_col)
    out = series
    for m in metrics:
        out = out.withColumn(f"{m}_change", round_ratio(F.col(m) - F.lag(m).over(w)))
    return out


def version_compare(runs: DataFrame, run_a: str, run_b: str,
                    metrics=("accuracy", "precision", "recall", "f1_score")) -> DataFrame:
    """Two runs side by side per metric, the difference and the winner."""
    long = runs.filter(F.col("run_name").isin(run_a, run_b)).unpivot(
        ["run_name"], list(metrics), "metric", "value")
    a = long.filter(F.col("run_name") == run_a).select("metric", F.col("value").alias("value_a"))
    b = long.filter(F.col("run_name") == run_b).select("metric", F.col("value").alias("value_b"))
    diff = F.col("value_b") - F.col("value_a")
    return a.join(b, "metric").select(
        "metric", "value_a", "value_b", round_ratio(diff).alias("difference"),
        F.when(diff > 0, F.lit(run_b)).when(diff < 0, F.lit(run_a)).otherwise(F.lit("tie")).alias("winner"))


RULE_SWEEP_THRESHOLDS = [3, 4, 5, 6]


def rule_sweep_runs(wide: DataFrame, as_of, thresholds=RULE_SWEEP_THRESHOLDS) -> DataFrame:
    """Experiment-run rows (ml.experiment_runs schema) for a sweep of rule classifiers.

    ``failed_payments >= t or cancel_tickets > 2`` for each t, evaluated in one pass: the
    threshold list is exploded per row and all runs aggregate in a single groupBy.
    """
    from ..functions.scalar import ts_lit
    x = wide.select("churned", "failed_payments", "cancel_tickets",
                    F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("t"))
    p = F.when((F.col("failed_payments") >= F.col("t")) | (F.col("cancel_tickets") > 2), 1).otherwise(0)
    a = F.col("churned")
    cells = x.groupBy("t").agg(
        F.count(F.lit(1)).alias("total"),
        count_when((p == 1) & (a == 1)).alias("tp"), count_when((p == 0) & (a == 0)).alias("tn"),
        count_when((p == 1) & (a == 0)).alias("fp"), count_when((p == 0) & (a == 1)).alias("fn"))
    tp, tn, fp, fn, total = (F.col(c) for c in ("tp", "tn", "fp", "fn", "total"))
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return cells.select(
        F.concat(F.lit("rule_fp"), F.col("t").cast("string")).alias("run_name"),
        F.col("t").cast("int").alias("n_estimators"), F.lit(0).alias("max_depth"),
        F.lit(0.0).alias("learning_rate"),
        round_ratio(ratio_or_zero(tp + tn, total)).alias("accuracy"),
        round_ratio(precision).alias("precision"), round_ratio(recall).alias("recall"),
        round_ratio(f1).alias("f1_score"),
        F.timestamp_add("MINUTE", F.col("t"), ts_lit(as_of)).alias("run_timestamp"))
