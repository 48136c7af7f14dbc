"""Business rules re-aimed from one typed-in row to whole tables.

Rules are column expressions over the wide table, so every subscriber is scored in
one scan.  Parameter frames (thresholds, scenario grid, campaign settings) have a
fixed, tiny row count and are the only sides ever broadcast explicitly.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import days_between, ratio_floor_one, round_money, round_ratio, ts_lit
from .neighbours import nearest

KEY = "subscriber_id"

# ---------------------------------------------------------------------------
# Fixed values (the reference's thresholds, rule texts and scenario grid).
# ---------------------------------------------------------------------------
FEATURE_THRESHOLDS = [
    # feature, threshold, direction
    ("unique_articles", 50.0, "high"),
    ("tenure_days", 90.0, "high"),
    ("total_revenue", 100.0, "high"),
    ("total_payments", 6.0, "high"),
    ("billing_cycle", None, "exact"),   # compared with the text 'annual'
    ("total_engagements", 50.0, "high"),
    ("avg_time_spent", 120.0, "high"),
    ("failed_payments", 0.0, "low"),
    ("cancel_tickets", 0.0, "low"),
    ("email_open_rate", 0.3, "high"),
]
EXACT_THRESHOLD_TEXT = {"billing_cycle": "annual"}

WHAT_IF_RULES = [
    # change, impact, effort, note
    ("Switch to annual billing", "High", "Medium", "Annual subscribers have 40% lower churn"),
    ("Focus on first 90 days engagement", "High", "Low", "Critical retention period - onboarding matters"),
    ("Increase content engagement", "High", "Medium", "Personalized recommendations could help"),
    ("Resolve payment issues", "Very High", "Low", "Update payment method or contact billing"),
    ("Address cancellation concerns", "Critical", "High", "Direct outreach from retention team"),
    ("Improve email relevance", "Medium", "Low", "Better subject lines or send times"),
]

# The reference's feature explanations (F19) and the text used for any other feature.
FEATURE_EXPLANATIONS = [
    ("UNIQUE_ARTICLES", "Number of unique articles read - higher engagement = lower churn"),
    ("TENURE_DAYS", "Days since subscription started - longer tenure = lower churn"),
    ("TOTAL_REVENUE", "Total payment amount - higher spending = lower churn"),
    ("TOTAL_PAYMENTS", "Number of successful payments - consistent payers stay"),
    ("TOTAL_ENGAGEMENTS", "Total content interactions - engaged users stay"),
    ("AVG_TIME_SPENT", "Average session duration - time invested = value perceived"),
    ("BILLING_CYCLE", "Monthly vs annual billing - monthly has higher churn"),
    ("EMAILS_OPENED", "Email engagement - connected users stay"),
    ("SUCCESSFUL_PAYMENTS", "Payment success count - billing issues cause churn"),
    ("TOTAL_VIEWS", "Content consumption - more views = more value"),
    ("TOTAL_TICKETS", "Support requests - more tickets may indicate frustration"),
    ("FAILED_PAYMENTS", "Payment failures - billing friction causes churn"),
    ("CANCEL_TICKETS", "Cancellation inquiries - strong churn signal"),
    ("HIGH_PRIORITY_TICKETS", "Urgent support requests - unresolved issues cause churn"),
    ("DEVICE_DIVERSITY", "Devices used - multi-device = integrated into life"),
]
DEFAULT_EXPLANATION = "Feature contributing to churn prediction"

SCENARIO_SUCCESS_RATES = [0.10, 0.20, 0.30]
SCENARIO_COSTS = [5.0, 10.0, 20.0]
SCENARIO_TARGET_SHARE = 0.8
SCENARIO_DISCOUNT = 0.15
FALLBACK_REVENUE = 150.0


def engagement_score(wide: DataFrame) -> DataFrame:
    """Q2: min(100, (articles x 2 + sessions + engagements / 5 + avg time / 6) / 4); bands > 60, > 30."""
    raw = (F.col("unique_articles") * 2 + F.col("total_sessions") + F.col("total_engagements") / 5
           + F.col("avg_time_spent") / 6) / 4
    score = F.least(F.lit(100.0), raw.cast("double"))
    return wide.select(KEY, round_ratio(score).alias("engagement_score"),
                       F.when(score > 60, "high").when(score > 30, "medium").otherwise("low")
                       .alias("engagement_band"))


def risk_bands(wide: DataFrame) -> DataFrame:
    """Q3: tenure status and payment failure band (failure rate = failed / max(total, 1))."""
    t = F.col("tenure_days")
    rate = ratio_floor_one("failed_payments", "total_payments")
    return wide.select(
        KEY,
        F.when(t > 90, "established").when(t > 30, "new").otherwise("very_new").alias("tenure_status"),
        round_ratio(rate).alias("failure_rate"),
        F.when(rate > 0.2, "high").when(rate > 0.1, "medium").otherwise("low").alias("failure_band"))


def thresholds_frame(spark: SparkSession) -> DataFrame:
    """Feature -> (threshold, direction), 10 rows."""
    rows = [(f, t, d, EXACT_THRESHOLD_TEXT.get(f)) for f, t, d in FEATURE_THRESHOLDS]
    return spark.createDataFrame(rows, "feature string, threshold double, direction string, threshold_text string")


def risk_factors(wide: DataFrame, importance: DataFrame | None = None, top_n: int = 6) -> DataFrame:
    """Q6: for every subscriber, the top features compared with their thresholds -> Good / Risk Factor.

    Without an importance table every thresholded feature is evaluated.
    """
    spark = wide.sparkSession
    th = thresholds_frame(spark)
    if importance is not None:
        top = (importance.orderBy(F.desc("importance"), "feature").limit(top_n)
               .select(F.lower("feature").alias("feature")))
        th = th.join(top, "feature", "left_semi")
    numeric = [f for f, _, d in FEATURE_THRESHOLDS if d != "exact"]
    long = wide.select(KEY, "billing_cycle", *[F.col(c).cast("double").alias(c) for c in numeric]) \
        .unpivot([KEY, "billing_cycle"], numeric, "feature", "value_num")
    exact = wide.select(KEY, "billing_cycle", F.lit("billing_cycle").alias("feature"),
                        F.lit(None).cast("double").alias("value_num"))
    long = long.unionByName(exact)
    j = long.join(F.broadcast(th), "feature")  # 10-row parameter table
    v, thr, d = F.col("value_num"), F.col("threshold"), F.col("direction")
    good = (F.when(d == "high", v >= thr).when(d == "low", v <= thr)
            .otherwise(F.col("billing_cycle") == F.col("threshold_text")))
    return j.select(KEY, "feature", round_ratio("value_num").alias("value_num"),
                    F.when(d == "exact", F.col("billing_cycle")).alias("value_text"),
                    F.when(good, "Good").otherwise("Risk Factor").alias("status"))


def with_explanation(df: DataFrame, feature_col: str = "feature") -> DataFrame:
    """F19 (J13): feature name -> explanation text, default text for features without one.
    The lookup has 15 fixed rows, so it is broadcast."""
    lookup = df.sparkSession.createDataFrame(FEATURE_EXPLANATIONS, "_code string, explanation string")
    j = df.join(F.broadcast(lookup), F.upper(F.col(feature_col)) == F.col("_code"), "left")
    return j.drop("_code").withColumn("explanation", F.coalesce("explanation", F.lit(DEFAULT_EXPLANATION)))


def what_if_actions(wide: DataFrame) -> DataFrame:
    """Q7: six rules -> (change, impact, effort, note) rows per subscriber, via array + explode."""
    conds = [
        F.col("billing_cycle") == "monthly",
        F.col("tenure_days") < 90,
        F.col("unique_articles") < 25,
        F.col("failed_payments") > 0,
        F.col("cancel_tickets") > 0,
        F.col("email_open_rate") < 0.2,
    ]
    items = [F.when(c, F.struct(F.lit(i).alias("rule"), F.lit(ch).alias("change"), F.lit(im).alias("impact"),
                                F.lit(ef).alias("effort"), F.lit(no).alias("note")))
             for i, (c, (ch, im, ef, no)) in enumerate(zip(conds, WHAT_IF_RULES))]
    arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    return wide.select(KEY, F.explode(arr).alias("a")).select(
        KEY, "a.rule", "a.change", "a.impact", "a.effort", "a.note")


def similar_subscribers(wide: DataFrame, queries: DataFrame, k: int = 5, cell: int | None = None, few: int | None = None) -> DataFrame:
    """Q5 (J12, W2, L7): for each query profile, the k nearest subscribers with the same billing cycle.

    score = |d tenure| / max(max d tenure, 1) + |d engagements| / max(max d eng, 1)
            + |d revenue| / max(max d revenue, 1), maxima over that cycle's candidates (D15:
            filter first; all three guarded), found by ``neighbours.nearest``; ties by subscriber id.
    Profiles without a cycle or with an unknown number have no neighbours and are nobody's neighbour.
    """
    number = {"t": "tenure_days", "e": "total_engagements", "r": "total_revenue"}
    columns = lambda df, first: df.select(*first, "billing_cycle", *[F.col(c).cast("double").alias(d) for d, c in number.items()])
    found = nearest(columns(wide, [KEY, "churned"]), columns(queries, ["query_id"]), k, KEY, "query_id", "billing_cycle", list(number),
                    **({} if cell is None else {"cell": cell}), **({} if few is None else {"few": few}))
    return found.select("query_id", "rank", KEY, round_ratio("score").alias("similarity_score"),
                        F.col("t").cast("int").alias("tenure_days"), round_money("r").alias("total_revenue"), "churned")


def similar_picks(similar: DataFrame, n: int = 2) -> DataFrame:
    """Q5: of each query's neighbours, the ``n`` nearest retained and the ``n`` nearest churned ones."""
    w = Window.partitionBy("query_id", "churned").orderBy("rank")   # at most k rows a query
    return (similar.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= n)
            .select("query_id", "churned", "pick", KEY, "similarity_score"))


def similar_churn_rate(similar: DataFrame) -> DataFrame:
    """Q5: churn rate among each query's neighbours."""
    return similar.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_similar"),
                                           round_ratio(F.avg(F.col("churned").cast("double"))).alias("churn_rate"))


def at_risk_revenue(pred: DataFrame, wide: DataFrame) -> DataFrame:
    """At-risk rows with revenue, tier and cycle (left join, revenue may be NULL)."""
    return pred.filter(F.col("predicted_churn") == 1).select(KEY).join(
        wide.select(KEY, F.col("total_revenue").cast("double").alias("total_revenue"),
                    "subscription_tier", "billing_cycle"), KEY, "left")


def revenue_stats(at_risk: DataFrame) -> DataFrame:
    """Mean, sum, exact median of at-risk revenue (NULLs skipped).

    The median comes from the distributed order statistic (no single-task value buffer).
    """
    from .order_stats import exact_median
    r = F.col("total_revenue")
    agg = at_risk.agg(F.count(F.lit(1)).alias("num_at_risk"), round_money(F.avg(r)).alias("avg_revenue"),
                      round_money(F.sum(r)).alias("total_revenue_at_risk"))
    med = exact_median(at_risk, "total_revenue").select(round_money("median").alias("median_revenue"))
    return agg.crossJoin(med)  # one row x one row


def revenue_overview(pred: DataFrame, at_risk: DataFrame, has_features: bool = True) -> DataFrame:
    """Q14: at-risk count, mean and total revenue; annualized impact (D19) =
    total at-risk revenue x 12 / max(all predictions, 1) x 1000; flat 150 per row without features."""
    s = revenue_stats(at_risk)
    if not has_features:
        s = s.select("num_at_risk", F.lit(FALLBACK_REVENUE).alias("avg_revenue"),
                     (F.col("num_at_risk") * FALLBACK_REVENUE).alias("total_revenue_at_risk"),
                     F.lit(FALLBACK_REVENUE).alias("median_revenue"))
    n = pred.agg(F.count(F.lit(1)).alias("_n"))
    return s.crossJoin(n).withColumn("annualized_impact", round_money(
        F.col("total_revenue_at_risk") * 12 / F.greatest(F.col("_n"), F.lit(1)) * 1000)).drop("_n")


def campaign_roi(at_risk: DataFrame, success_rate: float = 0.20, cost_per_contact: float = 10.0,
                 discount: float = 0.15, target_share: float = 1.0, high_value_only: bool = False) -> DataFrame:
    """Q12: campaign cost, saves, gross and net revenue, ROI %, cost per save.

    High-value targeting keeps rows with revenue >= the exact median (a one-row aggregate
    crossed back onto the rows).
    """
    target = at_risk
    if high_value_only:
        from .order_stats import exact_quantile_value
        med = exact_quantile_value(at_risk, "total_revenue", 0.5)
        target = at_risk.filter(F.col("total_revenue") >= F.lit(med)) if med is not None else at_risk.limit(0)
    avg_all = at_risk.agg(F.avg("total_revenue").alias("avg_all"))
    t = target.agg(F.count(F.lit(1)).alias("n_target"), F.avg("total_revenue").alias("avg_target")).crossJoin(avg_all)
    contacted = F.floor(F.col("n_target") * F.lit(target_share)).cast("long")
    saved = F.floor(contacted * F.lit(success_rate)).cast("long")
    per_saved = F.when(F.col("n_target") > 0, F.col("avg_target")).otherwise(F.col("avg_all"))
    out = t.select(contacted.alias("customers_to_contact"), saved.alias("customers_saved"),
                   per_saved.alias("revenue_per_saved"))
    campaign = F.col("customers_to_contact") * cost_per_contact
    disc = F.col("customers_saved") * F.col("revenue_per_saved") * discount
    total = campaign + disc
    gross = F.col("customers_saved") * F.col("revenue_per_saved")
    net = gross - total
    return out.select(
        "customers_to_contact", "customers_saved",
        round_money("revenue_per_saved").alias("revenue_per_saved"),
        round_money(campaign).alias("campaign_cost"), round_money(disc).alias("discount_cost"),
        round_money(total).alias("total_cost"), round_money(gross).alias("gross_revenue_saved"),
        round_money(net).alias("net_revenue_saved"),
        round_ratio(F.when(total > 0, net / total * 100).otherwise(0.0)).alias("roi_pct"),
        round_money(total / F.greatest(F.col("customers_saved").cast("double"), F.lit(1.0))).alias("cost_per_save"),
    )


def scenario_grid(at_risk: DataFrame) -> DataFrame:
    """Q13 (J11): success {0.1,0.2,0.3} x cost {5,10,20} against the at-risk totals (9 rows)."""
    spark = at_risk.sparkSession
    grid = spark.createDataFrame([(s, c) for s in SCENARIO_SUCCESS_RATES for c in SCENARIO_COSTS],
                                 "success_rate double, cost_per_contact double")
    tot = at_risk.agg(F.count(F.lit(1)).alias("num_at_risk"),
                      F.coalesce(F.avg("total_revenue"), F.lit(FALLBACK_REVENUE)).alias("avg_revenue"))
    j = grid.crossJoin(tot)  # 9 x 1 rows
    contacted = F.floor(F.col("num_at_risk") * F.lit(SCENARIO_TARGET_SHARE)).cast("long")
    saved = F.floor(contacted * F.col("success_rate")).cast("long")
    j = j.select("success_rate", "cost_per_contact", "avg_revenue",
                 contacted.alias("contacted"), saved.alias("saved"))
    cost = F.col("contacted") * F.col("cost_per_contact") + F.col("saved") * F.col("avg_revenue") * SCENARIO_DISCOUNT
    revenue = F.col("saved") * F.col("avg_revenue")
    net = revenue - cost
    return j.select("success_rate", "cost_per_contact", "contacted", "saved",
                    round_money(cost).alias("total_cost"), round_money(revenue).alias("revenue_saved"),
                    round_money(net).alias("net_benefit"),
                    round_ratio(F.when(cost > 0, net / cost * 100).otherwise(0.0)).alias("roi_pct"))


# One conditional aggregate over the scored frame; rates and costs are bound, never formatted in.
ROI_SQL = """
SELECT COUNT_IF(predicted_churn = 1) AS at_risk_count,
       ROUND(SUM(IF(predicted_churn = 1, total_revenue, NULL)), 2) AS revenue_at_risk,
       ROUND(100 * (:success_rate * AVG(IF(predicted_churn = 1, total_revenue, NULL)) / :cost_per_contact - 1), 6)
           AS roi_percent
FROM {scored}
"""


def roi_sql(spark: SparkSession, scored_with_revenue: DataFrame, success_rate: float = 0.2,
            cost_per_contact: float = 10.0) -> DataFrame:
    """Q16 (S2, S7): campaign return as Spark SQL with bound parameters."""
    name = "churnlens_roi_input"
    scored_with_revenue.createOrReplaceTempView(name)
    return spark.sql(ROI_SQL.format(scored=name),
                     args={"success_rate": float(success_rate), "cost_per_contact": float(cost_per_contact)})


def billing_schedule(subscribers: DataFrame, history: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Q20: expected charge dates every 30 (monthly) or 365 (annual) days from signup, strictly before
    the first cancel date (or the evaluation clock)."""
    first_cancel = history.filter(F.col("event_type") == "cancel").groupBy(KEY).agg(
        F.min("event_timestamp").alias("cancel_ts"))
    s = subscribers.select(KEY, "billing_cycle", "signup_date").join(first_cancel, KEY, "left")
    end = F.coalesce(F.least(F.col("cancel_ts"), ts_lit(as_of)), ts_lit(as_of))
    step = F.when(F.col("billing_cycle") == "annual", 365).otherwise(30)
    n = F.floor(days_between("signup_date", end) / step).cast("int")
    base = s.select(KEY, "billing_cycle", "signup_date", step.alias("step"), n.alias("n"), end.alias("end_ts"))
    idx = base.filter(F.col("n") >= 0).select(
        KEY, "billing_cycle", "signup_date", "step", "end_ts", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("k"))
    charge = F.date_add(F.col("signup_date").cast("date"), F.col("k") * F.col("step"))
    return idx.select(KEY, "billing_cycle", F.col("k").alias("charge_number"),
                      charge.cast("string").alias("charge_date")) \
        .filter(charge.cast("timestamp_ntz") < F.col("end_ts"))


#: Days a promotion of each type may last; other types last as the last entry says.
PROMO_DURATIONS = (("trial", (14,)), ("discount", (30, 90, 180)), (None, (30, 60)))


def promo_status(promotions: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Q21: expired when the end date is before the clock, else active; duration in days, and whether it is one that
    the promotion's type allows."""
    days = days_between("start_date", "end_date")
    allowed = days.isin(*PROMO_DURATIONS[-1][1])
    for kind, lengths in PROMO_DURATIONS[:-1]:
        allowed = F.when(F.col("promo_type") == kind, days.isin(*lengths)).otherwise(allowed)
    return promotions.select(
        "promotion_id", KEY, "promo_type",
        F.when(F.col("end_date") < ts_lit(as_of), "expired").otherwise("active").alias("status"),
        days.alias("duration_days"), allowed.alias("usual_duration"))


def recency(engagement_view: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Q22: days since the last engagement."""
    return engagement_view.select(KEY, days_between("last_engagement_date", ts_lit(as_of)).alias("days_since_last"))
