"""Hand fixtures for the semantics to keep."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from helpers import fixture_catalog, sub
from churnlens.operators import business as BZ
from churnlens.operators import evaluate as EV
from churnlens.operators import features as FE
from churnlens.operators import model as M
from churnlens.operators import monitor as MO
from churnlens.operators import quality as QA
from churnlens.plans.workspace import Workspace

T0 = dt.datetime(2023, 1, 1)


def hist(hid, sid, etype, ts=T0):
    return {"history_id": hid, "subscriber_id": sid, "event_type": etype, "event_timestamp": ts}


def pay(pid, sid, amount, status, ts=T0):
    from decimal import Decimal
    return {"payment_id": pid, "subscriber_id": sid, "amount": Decimal(amount), "payment_status": status,
            "transaction_timestamp": ts}


def test_twice_cancelled(spark):
    """The label counts distinct cancelled ids; D3: tier totals and the headline count events."""
    cat = fixture_catalog(spark, [sub("a"), sub("b")],
                          subscription_history=[hist("1", "a", "cancel"), hist("2", "a", "cancel")])
    label = {r["subscriber_id"]: r["churned"] for r in FE.churn_label(cat).collect()}
    assert label == {"a": 1, "b": 0}
    tier = EV.churn_by_tier(cat.subscribers, cat.subscription_history).first()
    assert (tier["total"], tier["churned"]) == (3, 2)
    head = EV.churn_headline(cat.subscribers, cat.subscription_history).first()
    assert (head["total_subscribers"], head["churned"], head["active"]) == (2, 2, 0)


def test_no_activity_and_zero_guards(spark):
    """A subscriber absent from every view gets zeros; D7: rate guards."""
    cat = fixture_catalog(
        spark, [sub("c"), sub("d")],
        payments=[pay("p1", "d", "10.00", "success")],
        email_interactions=[{"interaction_id": "e1", "subscriber_id": "d", "event_type": "clicked",
                             "event_timestamp": T0}])
    ws = Workspace(spark, "", catalog=cat)
    rows = {r["subscriber_id"]: r for r in ws.wide.collect()}
    c, d = rows["c"], rows["d"]
    assert c["total_payments"] == 0 and c["payment_failure_rate"] == 0 and c["emails_sent"] == 0
    assert c["last_engagement_date"] is None
    # zero_sent: clicks without sends or opens -> both rates 0, not an error
    assert (d["emails_clicked"], d["email_open_rate"], d["email_click_rate"]) == (1, 0.0, 0.0)
    # payments: NULLIF form is NULL only when there are no rows; the view then has no row at all
    assert ws.views["payment"].filter("subscriber_id = 'c'").count() == 0


def test_null_category_dropped_for_training_only(spark):
    """Training drops rows with a NULL categorical; scoring fills and keeps them."""
    cat = fixture_catalog(spark, [sub("e", tier=None), sub("f")])
    ws = Workspace(spark, "", catalog=cat)
    assert M.model_inputs(ws.wide).dropna().count() == 1
    base = FE.join_views(FE.subscriber_base(cat), ws.views).fillna(0)
    assert base.count() == 2


def test_midnight_tenure(spark):
    """23:00 -> 01:00 next day crosses one midnight: tenure 1."""
    cat = fixture_catalog(spark, [sub("g", signup=dt.datetime(2024, 1, 30, 23, 0))])
    spine = FE.spine(cat, dt.datetime(2024, 1, 31, 1, 0)).first()
    assert spine["tenure_days"] == 1


def test_all_failed_revenue_counts(spark):
    """Failed charges still count in revenue and the average."""
    cat = fixture_catalog(spark, [sub("h")], payments=[pay("1", "h", "9.99", "failed"),
                                                       pay("2", "h", "9.99", "failed")])
    r = FE.payment_features(cat).first()
    assert float(r["total_revenue"]) == pytest.approx(19.98)
    assert r["payment_failure_rate"] == 1.0 and r["successful_payments"] == 0


def test_revenue_ties_pages_are_stable(spark):
    """L3: equal revenue over two pages: the id tie-break makes pages disjoint and complete."""
    rows = spark.createDataFrame([(f"s{i}", 50.0) for i in range(5)], "subscriber_id string, total_revenue double")
    p0 = [r[0] for r in EV.at_risk_page(rows, 0, 3).collect()]
    p1 = [r[0] for r in EV.at_risk_page(rows, 1, 3).collect()]
    assert p0 == ["s0", "s1", "s2"] and p1 == ["s3", "s4"]
    numbered = {r["subscriber_id"]: (r["row_number"], r["page"]) for r in EV.number_pages(rows, 3, 2).collect()}
    assert numbered == {"s0": (1, 1), "s1": (2, 1), "s2": (3, 1), "s3": (4, 2), "s4": (5, 2)}
    assert EV.page_count(rows, 3).first()["n_pages"] == 2


def _pred(spark, rows):
    return spark.createDataFrame(rows, "subscriber_id string, actual_churn int, predicted_churn int")


def test_one_class_predictions(spark):
    """All-zero predictions: zero guards, degenerate flag."""
    p = _pred(spark, [("a", 1, 0), ("b", 0, 0), ("c", 0, 0)])
    m = EV.classification_metrics(p).first()
    assert (m["tp"], m["tn"], m["fn"], m["precision"], m["recall"], m["f1_score"]) == (0, 2, 1, 0.0, 0.0, 0.0)
    assert QA.degenerate_check(p).first()["single_class"] == 1


def test_empty_predictions(spark):
    """No rows -> zero counts and no alert (never an error)."""
    p = _pred(spark, [])
    assert EV.confusion_row(p).first()["total"] == 0
    alert = MO.drift_alert(p).collect()
    assert len(alert) == 1 and alert[0]["fires"] == 0
    pay_view = spark.createDataFrame([], "subscriber_id string, total_revenue double")
    k = EV.kpi_metrics(p, pay_view).first()
    assert k["total_subscribers"] == 0 and k["recall"] == 0.0


def test_equal_tenure_guard(spark):
    """All candidates share the query's tenure: the guarded maximum avoids 0/0."""
    wide = spark.createDataFrame(
        [(f"s{i}", "monthly", 100, i, float(10 * i), i % 2) for i in range(6)],
        "subscriber_id string, billing_cycle string, tenure_days int, total_engagements long, "
        "total_revenue double, churned int")
    q = spark.createDataFrame([("q", "monthly", 100, 2, 20.0)],
                              "query_id string, billing_cycle string, tenure_days int, total_engagements long, "
                              "total_revenue double")
    res = BZ.similar_subscribers(wide, q).orderBy("rank").collect()
    assert [r["subscriber_id"] for r in res] == ["s2", "s1", "s3", "s0", "s4"]
    assert all(math.isfinite(r["similarity_score"]) for r in res)


@pytest.mark.parametrize("acc,drift,expected", [
    (0.90, 0.09, "Healthy"), (0.90, 0.19, "Warning"), (0.90, 0.21, "Warning"),
    (0.85, 0.09, "Warning"), (0.85, 0.21, "Warning"), (0.84, 0.19, "Warning"),
    (0.84, 0.21, "Critical"),
])
def test_health_edges(spark, acc, drift, expected):
    """Warning when accuracy >= 0.85 OR drift < 0.2."""
    n = 10000
    n_pos = round(0.29 * (1 + drift) * n)
    n_ok = round(acc * n)
    p = (spark.range(n).select(F.col("id").cast("string").alias("subscriber_id"),
                               (F.col("id") < n_pos).cast("int").alias("predicted_churn"))
         .withColumn("actual_churn", F.when(F.col("subscriber_id").cast("long") < n_ok, F.col("predicted_churn"))
                     .otherwise(1 - F.col("predicted_churn"))))
    assert MO.health_status(p).first()["health"] == expected


def test_same_histogram_psi_zero(spark):
    """Q10/Q11: identical distributions have zero distance."""
    long = spark.range(1000).select(F.lit("x").alias("feature"), (F.col("id") % 37).cast("double").alias("value"))
    assert MO.psi(MO.split_sketches(long, long)).first()["psi"] == 0.0
    d = MO.distribution_distance(MO.split_sketches(long, long)).first()
    assert (d["kl"], d["js"], d["ks"], d["chi2"], d["wasserstein"]) == (0.0, 0.0, 0.0, 0.0, 0.0)


def test_sample_profile_rules(spark):
    """Q2, Q3, Q7 on typed-in profiles: a struggling monthly subscriber and a loyal annual one."""
    cols = ("subscriber_id string, billing_cycle string, tenure_days int, unique_articles long, "
            "total_sessions long, total_engagements long, avg_time_spent double, failed_payments long, "
            "total_payments long, cancel_tickets long, email_open_rate double")
    wide = spark.createDataFrame([
        ("risky", "monthly", 20, 5, 3, 10, 30.0, 2, 4, 1, 0.1),
        ("loyal", "annual", 400, 150, 80, 400, 300.0, 0, 24, 0, 0.6)], cols)
    es = {r["subscriber_id"]: r for r in BZ.engagement_score(wide).collect()}
    assert es["risky"]["engagement_score"] == pytest.approx((5 * 2 + 3 + 10 / 5 + 30 / 6) / 4)
    assert es["loyal"]["engagement_score"] == 100.0 and es["loyal"]["engagement_band"] == "high"
    rb = {r["subscriber_id"]: r for r in BZ.risk_bands(wide).collect()}
    assert rb["risky"]["tenure_status"] == "very_new" and rb["risky"]["failure_band"] == "high"
    acts = BZ.what_if_actions(wide).groupBy("subscriber_id").count().collect()
    assert {r["subscriber_id"]: r["count"] for r in acts} == {"risky": 6}


def test_billing_schedule_strictly_before_end(spark):
    """Q20: charges every 30 (monthly) / 365 (annual) days from signup, strictly before the first
    cancel, or before the clock when never cancelled."""
    as_of = dt.datetime(2024, 1, 31)
    cat = fixture_catalog(
        spark, [sub("m", cycle="monthly", signup=dt.datetime(2023, 12, 1)),
                sub("a", cycle="annual", signup=dt.datetime(2022, 1, 31)),
                sub("c", cycle="monthly", signup=dt.datetime(2023, 11, 1))],
        subscription_history=[hist("1", "c", "cancel", dt.datetime(2023, 12, 1)),
                              hist("2", "c", "cancel", dt.datetime(2024, 1, 20))])
    rows = BZ.billing_schedule(cat.subscribers, cat.subscription_history, as_of).collect()
    got = {}
    for r in rows:
        got.setdefault(r["subscriber_id"], []).append(r["charge_date"])
    assert sorted(got["m"]) == ["2023-12-01", "2023-12-31", "2024-01-30"]
    assert sorted(got["a"]) == ["2022-01-31", "2023-01-31"]      # 2024-01-31 is not before the clock
    assert sorted(got["c"]) == ["2023-11-01"]                    # 2023-12-01 is the first cancel


def test_key_check_finds_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "subscriber_id string")
    r = QA.key_check({"subscribers": df}, {"subscribers": "subscriber_id"}).first()
    assert (r["rows"], r["null_keys"], r["duplicate_keys"]) == (4, 1, 1)


def test_unseen_categories(spark):
    train = spark.createDataFrame([("basic", "monthly"), ("premium", "annual")], "tier string, cycle string")
    val = spark.createDataFrame([("basic", "monthly"), ("standard", "weekly")], "tier string, cycle string")
    got = {(r["column_name"], r["value"]) for r in QA.unseen_categories(train, val, ["tier", "cycle"]).collect()}
    assert got == {("tier", "standard"), ("cycle", "weekly")}


def test_promo_status_and_recency(spark):
    as_of = dt.datetime(2024, 1, 31)
    promos = [{"promotion_id": "p1", "subscriber_id": "x", "promo_type": "trial", "start_date": dt.datetime(2023, 12, 1),
               "end_date": dt.datetime(2023, 12, 31)},
              {"promotion_id": "p2", "subscriber_id": "x", "promo_type": "discount",
               "start_date": dt.datetime(2024, 1, 15), "end_date": dt.datetime(2024, 2, 14)}]
    cat = fixture_catalog(spark, [sub("x")], promotions=promos,
                          engagement_events=[{"event_id": "e", "subscriber_id": "x", "event_type": "view",
                                              "event_timestamp": dt.datetime(2024, 1, 30, 23, 59)}])
    st = {r["promotion_id"]: (r["status"], r["duration_days"]) for r in BZ.promo_status(cat.promotions, as_of).collect()}
    assert st == {"p1": ("expired", 30), "p2": ("active", 30)}
    rec = BZ.recency(FE.engagement_features(cat), as_of).first()
    assert rec["days_since_last"] == 1
