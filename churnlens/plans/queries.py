"""The query catalogue: one DataFrame-returning function per SURVEY 2 inventory key.

Every query reads the driver tables through the Workspace (so its work grows with
them) and returns a lazy DataFrame.  Outputs that an independent SQL engine checks
(``oracle.py``) round doubles to 6 places and money to 2, and carry no decimals.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import days_between, round_money, round_ratio, ts_lit
from ..operators import business as BZ
from ..operators import drift as DR
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import monitor as MO
from ..operators import quality as QA
from ..operators import timeline as TL
from ..sources import io as IO
from ..sources.schemas import PRIMARY_KEYS
from .workspace import Workspace

KEY = "subscriber_id"
REGISTRY: dict[str, Callable[[Workspace], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Decimals and doubles -> double rounded to ``places`` (stable across engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


# ---------------------------------------------------------------------------
# 2.1 scans, sources, sinks
# ---------------------------------------------------------------------------

@register("scan_table")
def scan_table(ws):  # S1 + S10 (schema-checked adapter)
    return ws.cat.subscribers


@register("sql_query")
def sql_query(ws):  # S2 + S7: SQL text with bound values
    return IO.sql_query(ws.spark, {"subscribers": ws.cat.subscribers},
                        "SELECT subscription_tier, COUNT(*) AS n FROM subscribers "
                        "WHERE billing_cycle = :cycle GROUP BY subscription_tier",
                        args={"cycle": "monthly"})


@register("table_counts")
def table_counts(ws):  # S12
    return IO.table_counts({n: ws.cat.raw(n) for n in ws.cat.RAW_TABLES})


@register("ctas_cast")
def ctas_cast(ws):  # S6: monitoring source with explicit casts, written and read back
    src = MO.monitoring_source(ws.predictions, ws.subscribers, "signup_date")
    return IO.write_and_read(ws.spark, src, "monitoring_source")


@register("materialize")
def materialize(ws):  # S8: pin the predictions with a reliable checkpoint
    return IO.materialize(ws.predictions.drop("prediction_timestamp"))


@register("dataset_snapshot")
def dataset_snapshot(ws):  # S20: write the versioned training set once, read it back
    return tidy(IO.write_and_read(ws.spark, ws.wide, "datasets/churn_training_data"))


@register("id_lookup")
def id_lookup(ws):  # S16 re-aimed to a list: wide rows of the at-risk ids, case-insensitive, by the index of folded ids
    return tidy(ws.lookup(ws.predictions.filter(F.col("predicted_churn") == 1).select(F.lower(KEY).alias("id"))))


@register("id_lookup_point")
def id_lookup_point(ws):  # S16 as the page does it: a few typed ids (the three at-risk subscribers with the highest revenue)
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    return tidy(ws.lookup([r[0].lower() for r in EV.top_by_revenue(rows, 3).select(KEY).collect()]))


@register("head_rows")
def head_rows(ws):  # S21: first n rows, always ordered
    return tidy(ws.wide.orderBy(KEY).limit(10))


# ---------------------------------------------------------------------------
# 2.2 projections, filters, predicates
# ---------------------------------------------------------------------------

@register("project")
def project(ws):  # P1-P4
    return (ws.cat.subscribers.select(KEY, "subscription_tier", "birth_year")
            .withColumn("source", F.lit("raw"))
            .withColumnsRenamed({"birth_year": "year_of_birth"})
            .drop("source"))


@register("filter_eq")
def filter_eq(ws):  # P5
    return ws.cat.subscription_history.filter(F.col("event_type") == "cancel").select("history_id", KEY)


@register("filter_range")
def filter_range(ws):  # P6 + P19: the validation split by bucket range
    return QA.with_split(ws.spine).filter((F.col("bucket") >= 60) & (F.col("bucket") < 80)).select(KEY, "bucket")


@register("filter_null")
def filter_null(ws):  # P7: subscribers whose payment failure rate is NULL or who have no engagement row
    j = FE.join_views(ws.spine, ws.views)
    return j.filter(F.col("last_engagement_date").isNull()).select(KEY)


@register("case_when")
def case_when(ws):  # P8 + P9
    return ws.cat.payments.select("payment_id", F.when(F.col("payment_status") == "failed", 1)
                                  .otherwise(0).alias("is_failed"))


@register("fill_numeric")
def fill_numeric(ws):  # P10-P12: wide table with numeric gaps filled
    return tidy(ws.wide.drop("last_engagement_date"))


@register("drop_null_rows")
def drop_null_rows(ws):  # P13: rows with any NULL dropped (in effect: no engagement timestamp)
    return tidy(ws.wide.dropna())


@register("split_hash")
def split_hash(ws):  # P19
    return QA.with_split(ws.spine).select(KEY, "bucket", "split")


@register("sample_n")
def sample_n(ws):  # P20
    return EV.hash_sample(ws.spine.select(KEY, "churned"), 100)


@register("json_path")
def json_path(ws):  # P18 / F15: field of semi-structured text
    ev = ws.cat.driver("events")
    return ev.select(F.col("event_id"), F.get_json_object("props", "$.k").cast("int").alias("k"))


# ---------------------------------------------------------------------------
# 2.3 joins
# ---------------------------------------------------------------------------

@register("left_join_expr")
def left_join_expr(ws):  # J1 + P9
    s, h = ws.cat.subscribers, ws.cat.subscription_history.filter(F.col("event_type") == "cancel")
    c = h.select(F.col(KEY).alias("cancel_id"))
    return s.join(c, s[KEY] == c["cancel_id"], "left").select(
        s[KEY], F.when(c["cancel_id"].isNotNull(), 1).otherwise(0).alias("churned"))


@register("label_join")
def label_join(ws):  # J2
    return FE.churn_label(ws.cat)


@register("spine_join")
def spine_join(ws):  # J3
    return ws.spine


@register("feature_join")
def feature_join(ws):  # J4
    return tidy(ws.wide)


@register("star_left_5")
def star_left_5(ws):  # J5: subscribers left join five views, 28 drift columns, NULLs kept
    base = ws.subscribers.select(KEY, days_between("signup_date", ts_lit(ws.as_of)).alias("tenure_days"))
    j = FE.join_views(base, ws.views)
    return tidy(j.select(KEY, *FE.DRIFT_FEATURES))


@register("inner_then_left")
def inner_then_left(ws):  # J6
    return EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)


@register("merge_left")
def merge_left(ws):  # J8
    return tidy(BZ.at_risk_revenue(ws.predictions, ws.wide), 2)


@register("inner_chain")
def inner_chain(ws):  # J9: views joined USING(subscriber_id), inner
    v = ws.views
    j = v["payment"].select(KEY, "total_revenue").join(v["support"].select(KEY, "total_tickets"), KEY) \
        .join(v["promo"].select(KEY, "total_promos"), KEY)
    return tidy(j, 2)


@register("unseen_categories")
def unseen_categories(ws):  # J10 / O4
    s = QA.with_split(ws.spine)
    return QA.unseen_categories(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "validation"),
                                FE.CATEGORICAL_FEATURES)


@register("unseen_segments")
def unseen_segments(ws):  # J10 / O4 on a fine category: city, tier, cycle and gender that training rows never showed together
    who = ws.cat.subscribers.select(KEY, F.concat_ws("/", "city", "subscription_tier", "billing_cycle", "gender").alias("segment"))
    s = QA.with_split(ws.spine).select(KEY, "split").join(who, KEY)
    return QA.unseen_categories(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "validation"), ["segment"])


@register("scalar_broadcast")
def scalar_broadcast(ws):  # J12: column maxima attached to every row
    w = ws.wide.select(KEY, "tenure_days", "total_engagements", "total_revenue")
    mx = w.agg(F.max("tenure_days").alias("max_tenure"), F.max("total_engagements").alias("max_engagements"),
               F.max("total_revenue").alias("max_revenue"))
    return tidy(w.crossJoin(F.broadcast(mx)).select(
        KEY, (F.col("tenure_days") / F.col("max_tenure")).alias("tenure_share"),
        F.try_divide(F.col("total_engagements"), F.col("max_engagements")).alias("engagement_share"),
        F.try_divide(F.col("total_revenue").cast("double"), F.col("max_revenue").cast("double")).alias("revenue_share")))


@register("threshold_join")
def threshold_join(ws):  # J13 / Q6
    return BZ.risk_factors(ws.wide)


@register("as_of_join")
def as_of_join(ws):  # J14 / W5
    spine = ws.cat.subscription_history.filter(F.col("event_type") == "cancel").select(
        "history_id", KEY, F.col("event_timestamp").alias("ts"))
    ev = ws.cat.payments.select(KEY, F.col("transaction_timestamp").alias("ts"), "payment_id", "amount",
                                (F.col("payment_status") == "failed").cast("int").alias("failed"),
                                "payment_status")
    out = TL.as_of_features(spine, ev, KEY, "ts", "history_id", order_col="payment_id",
                            sums=["amount", "failed"], last_cols=["payment_status"])
    return out.select("history_id", KEY, F.col("n_events").alias("payments_so_far"),
                      round_money("sum_amount").alias("revenue_so_far"),
                      F.col("sum_failed").cast("long").alias("failed_so_far"),
                      F.col("last_payment_status").alias("last_payment_status"))


#: Times of the training snapshots that the point-in-time queries look at (the driver tables cover two spans of time).
SNAPSHOTS = ("1996-12-31", "1999-06-30", "2001-12-31", "2024-01-08", "2024-01-20", "2024-01-31")


def _snapshot_spine(ws):
    """Every subscriber at every snapshot time."""
    at = F.explode(F.array(*[F.lit(t).cast("timestamp_ntz") for t in SNAPSHOTS]))
    return ws.cat.subscribers.select(KEY, at.alias("as_of"))


def _register_view_as_of(view: str):
    features = FE.FEATURE_VIEWS[view].features

    def query(ws):  # J14
        return tidy(TL.view_as_of(_snapshot_spine(ws), ws.cat, view, KEY, "as_of", features))
    query.__name__, query.__doc__ = f"as_of_{view}", f"The {view} view of every subscriber at every snapshot time."
    register(f"as_of_{view}")(query)


for _view in FE.VIEW_ORDER:
    _register_view_as_of(_view)


@register("as_of_training")
def as_of_training(ws):  # J14 over all five views: the wide row of each cancelling subscriber as of the cancel event
    spine = ws.cat.subscription_history.filter(F.col("event_type") == "cancel").select(
        "history_id", KEY, F.col("event_timestamp").alias("as_of"))
    spine = spine.unionByName(_snapshot_spine(ws).select(F.concat_ws("@", KEY, F.col("as_of").cast("date")).alias("history_id"), KEY, "as_of"))
    return tidy(TL.training_set_as_of(spine, ws.cat, KEY, "as_of", {v: FE.FEATURE_VIEWS[v].features for v in FE.VIEW_ORDER}))


@register("exists_scalar")
def exists_scalar(ws):  # J16: per tier, does a predicted churner with a cancellation ticket exist (a semi join, then a flag)
    found = ws.predictions.where("predicted_churn = 1").join(ws.wide.where("cancel_tickets > 0").select(KEY, "subscription_tier"), KEY)
    tiers = ws.wide.select("subscription_tier").distinct()
    return (tiers.join(found.select("subscription_tier").distinct().withColumn("found", F.lit(1)), "subscription_tier", "left")
            .select("subscription_tier", F.coalesce("found", F.lit(0)).alias("any_churner")))


# ---------------------------------------------------------------------------
# 2.4 aggregations
# ---------------------------------------------------------------------------

@register("churn_headline")
def churn_headline(ws):
    return EV.churn_headline(ws.cat.subscribers, ws.cat.subscription_history)


@register("count_by")
def count_by(ws):
    return EV.label_distribution(ws.wide)


@register("engagement_features")
def engagement_features(ws):
    return tidy(ws.views["engagement"])


@register("payment_features")
def payment_features(ws):
    return tidy(ws.views["payment"])


@register("email_features")
def email_features(ws):
    return tidy(ws.views["email"])


@register("support_features")
def support_features(ws):
    return ws.views["support"]


@register("promo_features")
def promo_features(ws):
    return tidy(ws.views["promo"])


@register("churn_by_tier")
def churn_by_tier(ws):
    return EV.churn_by_tier(ws.cat.subscribers, ws.cat.subscription_history)


@register("confusion_cells")
def confusion_cells(ws):
    return EV.confusion_cells(ws.predictions)


@register("confusion_row")
def confusion_row(ws):
    return EV.confusion_row(ws.predictions)


@register("classification_metrics")
def classification_metrics(ws):
    return EV.classification_metrics(ws.predictions)


@register("kpi_metrics")
def kpi_metrics(ws):
    return EV.kpi_metrics(ws.predictions, ws.payment_view)


@register("tier_risk")
def tier_risk(ws):
    return EV.tier_risk(ws.predictions, ws.subscribers, ws.payment_view)


@register("at_risk_summary")
def at_risk_summary(ws):
    return EV.at_risk_summary(ws.predictions, ws.payment_view)


def _star_long(ws) -> DataFrame:
    base = ws.subscribers.select(KEY, days_between("signup_date", ts_lit(ws.as_of)).alias("tenure_days"))
    return MO.to_long(FE.join_views(base, ws.views), FE.DRIFT_FEATURES)


@register("feature_stats")
def feature_stats(ws):  # A15: one pass over the star join, NULLs skipped per feature
    return MO.feature_stats(_star_long(ws))


@register("feature_stats_explained")
def feature_stats_explained(ws):  # A15 + F19: statistics with each feature's explanation text
    return BZ.with_explanation(MO.feature_stats(_star_long(ws)).select("feature", "cnt", "mean"))


@register("coverage_check")
def coverage_check(ws):
    return QA.coverage_check(ws.subscribers, ws.views)


@register("split_quality")
def split_quality(ws):
    return QA.split_quality(QA.with_split(ws.wide))


@register("null_profile")
def null_profile(ws):
    return QA.null_profile(FE.join_views(ws.spine, ws.views))


@register("category_values")
def category_values(ws):  # A19 on the training split, as the reference inspects it
    train = QA.with_split(ws.wide).filter(F.col("split") == "train")
    return QA.category_values(train, FE.CATEGORICAL_FEATURES)


@register("prediction_nulls")
def prediction_nulls(ws):
    return QA.prediction_nulls(ws.predictions)


@register("degenerate_check")
def degenerate_check(ws):
    return QA.degenerate_check(ws.predictions)


@register("health_means")
def health_means(ws):
    return EV.health_means(ws.predictions)


@register("revenue_stats")
def revenue_stats(ws):
    return BZ.revenue_stats(BZ.at_risk_revenue(ws.predictions, ws.wide))


@register("class_histogram")
def class_histogram(ws):
    long = MO.to_long(ws.wide, FE.DRIFT_FEATURES, ["churned"])
    return MO.class_histogram(long)


@register("alignment_accuracy")
def alignment_accuracy(ws):
    return EV.alignment_accuracy(ws.predictions)


@register("conditional_count")
def conditional_count(ws):
    return EV.conditional_counts(ws.predictions, ws.payment_view)


@register("simple_drift_stats")
def simple_drift_stats(ws):  # A28: one column
    long = MO.to_long(ws.views["payment"], ["total_revenue"])
    return MO.feature_stats(long).select("feature", "mean", "std", "median")


# ---------------------------------------------------------------------------
# 2.5 windows, 2.6 sorts
# ---------------------------------------------------------------------------

def _rule_runs(ws) -> DataFrame:
    """Experiment-run rows from rule classifiers over the wide table (one per threshold)."""
    return EV.rule_sweep_runs(ws.wide, ws.as_of)


@register("experiment_runs")
def experiment_runs(ws):  # S14: newest 50 runs of the stored table
    path = IO.runs_path(ws.spark, ws.data_version)   # the table that a sweep of fitted models appends to as well
    IO.append_runs(_rule_runs(ws), path)
    return IO.newest_runs(ws.spark, path, 50, prefix="rule_")


@register("best_run")
def best_run(ws):  # W1
    return EV.best_run(_rule_runs(ws))


@register("metric_trend")
def metric_trend(ws):  # W4 over the daily monitor
    return EV.metric_trend(_daily(ws), "day", ["accuracy", "f1_score"])


@register("version_compare")
def version_compare(ws):  # J15
    return EV.version_compare(_rule_runs(ws), "rule_fp4", "rule_fp5")


@register("top_k_per_query")
def top_k_per_query(ws):  # W2 / Q5 batch form: the 5 highest-revenue at-risk subscribers as queries
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    q = EV.top_by_revenue(rows, 5).select(F.col(KEY).alias("query_id"))
    queries = ws.wide.join(q, ws.wide[KEY] == q["query_id"]).select(
        "query_id", "billing_cycle", "tenure_days", "total_engagements", "total_revenue")
    return BZ.similar_subscribers(ws.wide, queries)


@register("page_number")
def page_number(ws):  # W3
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    return EV.number_pages(rows).select(KEY, "row_number", "page")


@register("order_by")
def order_by(ws):  # L1
    return EV.churn_by_tier(ws.cat.subscribers, ws.cat.subscription_history).orderBy(F.desc("churned"), "subscription_tier")


@register("order_by_expr")
def order_by_expr(ws):  # L2: ORDER BY COALESCE(revenue, 0) DESC
    return EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of) \
        .orderBy(F.desc(F.coalesce("total_revenue", F.lit(0.0))), KEY)


@register("at_risk_page")
def at_risk_page(ws):  # L3: second page of 100
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    return EV.at_risk_page(rows, page=1, page_size=100)


@register("page_count")
def page_count(ws):
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    return EV.page_count(rows)


@register("top_100_export")
def top_100_export(ws):  # L4 + S11
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    top = EV.at_risk_page(rows, 0, 100)
    return IO.export_csv_and_read(ws.spark, top, "exports/at_risk_top_100")


@register("top_20_value")
def top_20_value(ws):  # L6
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    return EV.top_value_total(rows, 20)


@register("n_smallest")
def n_smallest(ws):  # L7: 5 nearest to one profile (the highest-revenue at-risk subscriber)
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of)
    q = EV.top_by_revenue(rows, 1).select(F.col(KEY).alias("query_id"))
    queries = ws.wide.join(q, ws.wide[KEY] == q["query_id"]).select(
        "query_id", "billing_cycle", "tenure_days", "total_engagements", "total_revenue")
    return BZ.similar_subscribers(ws.wide, queries, k=5)


@register("deterministic_sample")
def deterministic_sample(ws):  # L8
    return EV.deterministic_sample(ws.predictions.drop("prediction_timestamp"), 50)


# ---------------------------------------------------------------------------
# 2.7 set operations
# ---------------------------------------------------------------------------

@register("union_all")
def union_all(ws):  # O1: per-view row counts stacked with unionByName
    return QA.view_counts(ws.subscribers, ws.views)


@register("concat")
def concat(ws):  # O2: two scenario frames stacked
    at_risk = BZ.at_risk_revenue(ws.predictions, ws.wide)
    a = BZ.campaign_roi(at_risk).withColumn("scenario", F.lit("default"))
    b = BZ.campaign_roi(at_risk, high_value_only=True).withColumn("scenario", F.lit("high_value"))
    return a.unionByName(b)


@register("distinct")
def distinct(ws):  # O3
    return FE.churned_ids(ws.cat)


@register("set_minus")
def set_minus(ws):  # O4: subscribers without any engagement event
    return ws.cat.subscribers.select(KEY).join(ws.cat.engagement_events.select(KEY), KEY, "left_anti")


# ---------------------------------------------------------------------------
# 2.8 scalar functions (tested through one query each)
# ---------------------------------------------------------------------------

@register("scalar_functions")
def scalar_functions(ws):  # F1-F11, F13, F18, F20
    s = ws.cat.subscribers
    return s.select(
        KEY,
        days_between("signup_date", ts_lit(ws.as_of)).alias("tenure_days"),              # F1
        (F.year(ts_lit(ws.as_of)) - F.col("birth_year")).cast("int").alias("age"),       # F2
        F.pmod(F.conv(F.substring(F.md5(KEY), 1, 8), 16, 10).cast("long"), F.lit(100)).alias("bucket"),  # F4
        F.round(F.col("birth_year") / 7.0, 1).alias("rounded"),                            # F5
        F.coalesce(F.col("last_name"), F.col("first_name")).alias("display_name"),         # F6
        F.floor(F.col("birth_year") * 0.37).cast("long").alias("truncated"),              # F8
        F.greatest(F.least(F.col("birth_year"), F.lit(1990)), F.lit(1960)).alias("clamped"),  # F9/F10
        F.upper("subscription_tier").alias("tier_upper"),                                  # F11
        F.substring(F.col("email"), 1, 12).alias("email_prefix"),                          # F13
        F.date_add(F.col("signup_date").cast("date"), 30).cast("string").alias("plus_30_days"),  # F18
        F.array_join(F.array("subscription_tier", "billing_cycle"), ", ").alias("joined"),  # F20
    )


@register("month_ends")
def month_ends(ws):  # F16: month-end dates spanned by each tier's signups
    s = ws.cat.subscribers.groupBy("subscription_tier").agg(F.min("signup_date").alias("lo"),
                                                            F.max("signup_date").alias("hi"))
    from ..functions.scalar import month_ends as me
    return s.select("subscription_tier", F.explode(me("lo", "hi")).alias("month_end")) \
        .select("subscription_tier", F.col("month_end").cast("string").alias("month_end"))


# ---------------------------------------------------------------------------
# 2.11 business and monitoring
# ---------------------------------------------------------------------------

@register("health_status")
def health_status(ws):
    return MO.health_status(ws.predictions)


@register("engagement_score")
def engagement_score(ws):
    return BZ.engagement_score(ws.wide)


@register("risk_bands")
def risk_bands(ws):
    return BZ.risk_bands(ws.wide)


@register("key_check")
def key_check(ws):
    return QA.key_check({n: ws.cat.raw(n) for n in ws.cat.RAW_TABLES}, PRIMARY_KEYS)


def _similar(ws) -> DataFrame:
    """Q5 with every at-risk subscriber as a query."""
    rows = EV.at_risk_rows(ws.predictions, ws.subscribers, ws.payment_view, ws.as_of).select(F.col(KEY).alias("query_id"))
    return BZ.similar_subscribers(ws.wide, ws.wide.join(rows, ws.wide[KEY] == rows["query_id"]).select(
        "query_id", "billing_cycle", "tenure_days", "total_engagements", "total_revenue"))


@register("similar_subscribers")
def similar_subscribers(ws):
    return _similar(ws)


@register("similar_churn_rate")
def similar_churn_rate(ws):
    return BZ.similar_churn_rate(_similar(ws))


@register("similar_picks")
def similar_picks(ws):  # Q5: up to two retained and two churned neighbours
    return BZ.similar_picks(_similar(ws))


@register("risk_factors")
def risk_factors(ws):
    return BZ.risk_factors(ws.wide)


@register("what_if_actions")
def what_if_actions(ws):
    return BZ.what_if_actions(ws.wide)


@register("drift_alert")
def drift_alert(ws):
    return MO.drift_alert(ws.predictions)


def _split_long(ws, split: str) -> DataFrame:
    s = QA.with_split(ws.wide).filter(F.col("split") == split)
    return MO.to_long(s, FE.DRIFT_FEATURES)


@register("mean_shift")
def mean_shift(ws):  # Q9: test split against the training-split baseline
    return MO.mean_shift(MO.feature_stats(_split_long(ws, "test")), MO.feature_stats(_split_long(ws, "train")))


def _drift_sketches(ws) -> DataFrame:
    """The stored sketches of every signup month and split, made once per data version by one scan of the wide table."""
    def long():
        dated = QA.with_split(ws.wide).join(ws.subscribers.select(KEY, F.trunc("signup_date", "month").alias("month")), KEY)
        return MO.to_long(dated, FE.DRIFT_FEATURES, ["split", "month"])
    return DR.stored(ws.spark, IO.scratch_path(ws.spark, "drift_sketches", ws.data_version), long, F.col("month"))


@register("psi")
def psi(ws):  # Q10
    return MO.psi(_drift_sketches(ws))


@register("distribution_distance")
def distribution_distance(ws):  # Q11
    return MO.distribution_distance(_drift_sketches(ws))


@register("campaign_roi")
def campaign_roi(ws):  # Q12 default parameters
    return BZ.campaign_roi(BZ.at_risk_revenue(ws.predictions, ws.wide))


@register("campaign_roi_high_value")
def campaign_roi_high_value(ws):  # Q12 with the median filter
    return BZ.campaign_roi(BZ.at_risk_revenue(ws.predictions, ws.wide), target_share=0.5, high_value_only=True)


@register("scenario_grid")
def scenario_grid(ws):  # Q13 / J11
    return BZ.scenario_grid(BZ.at_risk_revenue(ws.predictions, ws.wide))


@register("revenue_overview")
def revenue_overview(ws):  # Q14
    return BZ.revenue_overview(ws.predictions, BZ.at_risk_revenue(ws.predictions, ws.wide))


@register("roi_sql")
def roi_sql(ws):  # Q16
    scored = ws.predictions.join(ws.wide.select(KEY, F.col("total_revenue").cast("double").alias("total_revenue")), KEY)
    return BZ.roi_sql(ws.spark, scored)


def _view_rows(ws) -> DataFrame:
    counts = QA.view_counts(ws.subscribers, ws.views)
    names = ws.spark.createDataFrame([(k, FE.FEATURE_VIEWS[k].name) for k in FE.VIEW_ORDER] + [("subscribers", "SUBSCRIBER_FEATURES")],
                                     "name string, feature_view string")
    return counts.join(names, "name").select("feature_view", F.col("rows").alias("view_rows"))


@register("lineage")
def lineage(ws):  # Q17: per view feature count and list, with the rows each view holds
    return FE.lineage_summary(FE.lineage()).join(_view_rows(ws), "feature_view").select(
        "source", "feature_view", "feature_count", "feature_list", "view_rows")


@register("lineage_rows")
def lineage_rows(ws):  # Q17: one row for each (source, view, feature, model), with the rows the view holds
    return FE.lineage().join(_view_rows(ws), "feature_view").select("source", "feature_view", "feature", "model", "view_rows")


def _daily(ws) -> DataFrame:
    src = MO.monitoring_source(ws.predictions, ws.subscribers, "signup_date")
    return MO.monitor_daily(src)


@register("monitor_daily")
def monitor_daily(ws):  # T1 batch
    return _daily(ws)


@register("retrain_trigger")
def retrain_trigger(ws):  # Q18
    return MO.retrain_trigger(_daily(ws))


@register("melt_metrics")
def melt_metrics(ws):  # Q19
    return MO.melt_metrics(_daily(ws))


@register("billing_schedule")
def billing_schedule(ws):  # Q20
    return BZ.billing_schedule(ws.cat.subscribers, ws.cat.subscription_history, ws.as_of)


@register("promo_status")
def promo_status(ws):  # Q21
    return BZ.promo_status(ws.cat.promotions, ws.as_of)


@register("recency")
def recency(ws):  # Q22
    return BZ.recency(ws.views["engagement"], ws.as_of)


def all_queries() -> dict[str, Callable[[Workspace], DataFrame]]:
    from . import model_queries  # noqa: F401  (registers the model-backed keys)
    from ..streaming import queries as stream_queries  # noqa: F401
    return dict(REGISTRY)


# ---------------------------------------------------------------------------
# Remaining inventory keys (one small plan each, all over the given tables)
# ---------------------------------------------------------------------------

@register("alias")
def alias(ws):  # P2: computed columns renamed, names folded to lower case
    s = ws.cat.subscribers.select(F.col("subscriber_id").alias("SUBSCRIBER_ID"),
                                  F.col("subscription_tier").alias("TIER"))
    return s.toDF(*[c.lower() for c in s.columns]).withColumnsRenamed({"tier": "subscription_tier"})


@register("with_column")
def with_column(ws):  # P3: constant and computed columns
    return ws.spine.select(KEY, "tenure_days").withColumn("source", F.lit("spine")) \
        .withColumn("tenure_weeks", F.floor(F.col("tenure_days") / 7).cast("long"))


@register("drop_columns")
def drop_columns(ws):  # P4
    return QA.with_split(ws.spine).drop("bucket", "age", "acquisition_channel")


@register("match_flag")
def match_flag(ws):  # P9: 1 when the outer-join partner exists (subscribers with any promotion)
    p = ws.cat.promotions.select(F.col(KEY).alias("promo_id")).distinct()
    s = ws.cat.subscribers.select(KEY)
    return s.join(p, s[KEY] == p["promo_id"], "left").select(
        KEY, F.when(F.col("promo_id").isNotNull(), 1).otherwise(0).alias("has_promo"))


@register("fill_by_map")
def fill_by_map(ws):  # P10: fillna({'churned': 0}) after the label join
    ids = ws.cat.subscribers.select(KEY)
    c = FE.churned_ids(ws.cat).withColumn("churned", F.lit(1))
    return ids.join(c, KEY, "left").fillna({"churned": 0})


@register("fill_all")
def fill_all(ws):  # P12: fill 0 in every column that accepts it (the scoring path)
    j = FE.join_views(FE.subscriber_base(ws.cat, ws.as_of), ws.views).fillna(0)
    return tidy(j.drop("last_engagement_date"))


@register("cast")
def cast(ws):  # P14: ::FLOAT ::INT ::VARCHAR ::NUMBER, try_cast for text
    p = ws.cat.payments
    return p.select("payment_id", F.col("amount").cast("double").alias("amount_float"),
                    # ::INT on a decimal rounds in the reference's warehouse; Spark's cast truncates
                    F.round("amount", 0).cast("int").alias("amount_int"),
                    F.col("transaction_timestamp").cast("string").alias("ts_text"),
                    F.col("payment_id").try_cast("long").alias("payment_number"),
                    F.lit("n/a").try_cast("int").alias("bad_number"))


@register("coalesce")
def coalesce(ws):  # P15
    j = ws.subscribers.select(KEY).join(ws.views["promo"].select(KEY, "total_promos"), KEY, "left")
    return j.select(KEY, F.coalesce("total_promos", F.lit(0)).alias("total_promos"))


@register("safe_ratio")
def safe_ratio(ws):  # P16: the three zero guards side by side
    from ..functions.scalar import ratio_floor_one, ratio_or_null, ratio_or_zero
    e = ws.views["email"]
    return e.select(KEY, round_ratio(ratio_or_null("emails_opened", "emails_sent")).alias("nullif_rate"),
                    round_ratio(ratio_or_zero("emails_clicked", "emails_opened")).alias("case_rate"),
                    round_ratio(ratio_floor_one("emails_clicked", "emails_opened")).alias("floor_rate"))


@register("schema_introspect")
def schema_introspect(ws):  # P17: column types of the wide table, with non-null counts from the data
    w = ws.wide
    numeric = [f.name for f in w.schema.fields if isinstance(f.dataType, T.NumericType)]
    counts = w.agg(*[F.count(c).alias(c) for c in numeric])
    types = ws.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in w.schema.fields
                                      if f.name in numeric], "column_name string, data_type string")
    long = counts.unpivot([], numeric, "column_name", "non_null")
    return types.join(long, "column_name")


@register("left_for_sum")
def left_for_sum(ws):  # J7: predictions left join revenue, then sum
    j = ws.predictions.join(ws.payment_view.select(KEY, "total_revenue"), KEY, "left")
    return j.agg(round_money(F.sum(F.coalesce(F.col("total_revenue").cast("double"), F.lit(0.0))))
                 .alias("total_revenue"))


@register("scenario_cross")
def scenario_cross(ws):  # J11: every scenario of the grid for every tier's at-risk subscribers
    tiers = BZ.at_risk_revenue(ws.predictions, ws.wide).groupBy("subscription_tier").agg(
        F.count(F.lit(1)).alias("num_at_risk"), F.sum("total_revenue").alias("revenue"))
    grid = ws.spark.createDataFrame([(s, c) for s in BZ.SCENARIO_SUCCESS_RATES for c in BZ.SCENARIO_COSTS], "success_rate double, cost_per_contact double")
    return tiers.crossJoin(F.broadcast(grid)).select(   # 9 rows on the other side
        "subscription_tier", "success_rate", "cost_per_contact", round_money(F.col("num_at_risk") * F.col("cost_per_contact")).alias("contact_cost"),
        round_money(F.col("revenue") * F.col("success_rate")).alias("revenue_saved"))


@register("as_of_last")
def as_of_last(ws):  # W5: last payment status at or before each cancel event
    spine = ws.cat.subscription_history.filter(F.col("event_type") == "cancel").select(
        "history_id", KEY, F.col("event_timestamp").alias("ts"))
    ev = ws.cat.payments.select(KEY, F.col("transaction_timestamp").alias("ts"), "payment_id", "payment_status")
    out = TL.as_of_features(spine, ev, KEY, "ts", "history_id", order_col="payment_id", sums=[],
                            last_cols=["payment_status", "payment_id"])
    return out.select("history_id", KEY, "last_payment_status", "last_payment_id")


@register("sink_overwrite")
def sink_overwrite(ws):  # S4: overwrite the predictions table twice, read the final state
    import uuid
    path = IO.scratch_path(ws.spark, "ml", "churn_predictions", uuid.uuid4().hex[:8])   # frames of other calls stay readable
    IO.sink_overwrite(ws.predictions.filter(F.col("predicted_churn") == 1), path)
    IO.sink_overwrite(ws.predictions.drop("prediction_timestamp"), path)
    return ws.spark.read.parquet(path)


@register("sink_append")
def sink_append(ws):  # S5: append the run rows twice to a table created on first write
    import uuid
    path = IO.scratch_path(ws.spark, "ml", "experiment_runs_" + uuid.uuid4().hex[:8])
    runs = EV.rule_sweep_runs(ws.wide, ws.as_of)
    IO.sink_append(runs, path)
    IO.sink_append(runs, path)
    return ws.spark.read.parquet(path)


@register("bulk_load")
def bulk_load(ws):  # S9: helper columns dropped, NaN -> NULL, overwrite, read back
    import uuid
    root = IO.scratch_path(ws.spark, "raw_load", uuid.uuid4().hex[:8])
    pays = ws.cat.payments.withColumn("_is_failed", F.col("payment_status") == "failed") \
        .withColumn("ratio", F.when(F.col("payment_status") == "failed", F.lit(float("nan")))
                    .otherwise(F.col("amount").cast("double")))
    paths = IO.bulk_load(ws.spark, {"payments": pays}, root)
    return tidy(ws.spark.read.parquet(paths["payments"]).select("payment_id", "amount", "ratio"))


@register("schema_ddl")
def schema_ddl(ws):  # S10: payments checked against the declared schema, decimals kept exact
    from ..sources.schemas import PAYMENTS, check_schema
    return tidy(check_schema(ws.cat.payments, PAYMENTS, "payments").select(
        "payment_id", KEY, "amount", "payment_status", "created_at"), 2)


@register("export_csv")
def export_csv(ws):  # S11: the churn figures a tier as a CSV file, read back
    return IO.export_csv_and_read(ws.spark, churn_by_tier(ws), "exports/churn_by_tier")


@register("feature_view_list")
def feature_view_list(ws):  # S15: view definitions with the rows each stored view holds
    defs = IO.feature_view_list(ws.spark, {k: FE.FEATURE_VIEWS[k] for k in FE.VIEW_ORDER})
    names = ws.spark.createDataFrame([(k, FE.FEATURE_VIEWS[k].name) for k in FE.VIEW_ORDER],
                                     "view string, name string")
    counts = QA.view_counts(ws.subscribers, ws.views).withColumnRenamed("name", "view")
    return defs.join(names, "name").join(counts, "view").drop("view")


@register("register_view")
def register_view(ws):  # S17: get-or-create the payment view at its versioned path
    import uuid
    root = IO.scratch_path(ws.spark, "views_" + uuid.uuid4().hex[:8])
    fv = FE.FEATURE_VIEWS["payment"]
    IO.register_view(ws.spark, fv, fv.build(ws.cat), root)
    again = IO.register_view(ws.spark, fv, fv.build(ws.cat), root)  # second call reads, no rebuild
    return tidy(again)


@register("register_entity")
def register_entity(ws):  # S18: the entity's join key must be unique and non-null in the base table
    kc = QA.key_check({"subscribers": ws.cat.subscribers}, {"subscribers": KEY})
    return kc.select(F.lit(FE.SUBSCRIBER.name).alias("entity"), "key_column", "rows", "null_keys",
                     "duplicate_keys")


@register("refresh_view")
def refresh_view(ws):  # S19: recompute one view now and overwrite it in place
    import uuid
    root = IO.scratch_path(ws.spark, "views_" + uuid.uuid4().hex[:8])
    fv = FE.FEATURE_VIEWS["support"]
    IO.register_view(ws.spark, fv, fv.build(ws.cat).limit(0), root)
    return IO.register_view(ws.spark, fv, fv.build(ws.cat), root, refresh=True)
