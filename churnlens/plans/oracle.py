"""Independent SQL (DuckDB dialect) for every SQL-expressible query key.

The oracle sees only the driver tables, so each statement starts with the adapter
CTEs of FIXTURES 3 and recomputes the raw layer, the views, the wide table and the
rule-based predictions itself.  Column names and types follow the Spark side:
counts BIGINT, flags INTEGER, money and ratios DOUBLE rounded (2 / 6 places).
"""

from __future__ import annotations

from ..operators import business as BZ
from ..operators import features as FE

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _pick(expr: str, values: list[str]) -> str:
    lst = ", ".join(f"'{v}'" for v in values)
    return f"([{lst}])[({expr}) % {len(values)} + 1]"


PRELUDE = f"""
subscribers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS subscriber_id,
         'subscriber' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         c_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
         CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS signup_date,
         CAST(1950 + 2 * c_nationkey AS INTEGER) AS birth_year,
         {_pick('c_custkey', ['male', 'female', 'other', 'prefer_not_to_say'])} AS gender,
         'city_' || CAST(c_nationkey AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip_code,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'basic'
              WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'standard'
              ELSE 'premium' END AS subscription_tier,
         CASE WHEN c_acctbal < 5000 THEN 'monthly' ELSE 'annual' END AS billing_cycle,
         {_pick('c_nationkey', ['organic', 'paid_search', 'social', 'referral', 'email'])} AS acquisition_channel,
         {AS_OF} AS created_at, {AS_OF} AS updated_at
  FROM customer),
subscription_history AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS history_id, CAST(o_custkey AS VARCHAR) AS subscriber_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'cancel'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'pause'
              WHEN o_orderstatus = 'P' THEN 'downgrade' ELSE 'signup' END AS event_type,
         CAST(o_orderdate AS TIMESTAMP) AS event_timestamp
  FROM orders),
payments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_custkey AS VARCHAR) AS subscriber_id,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
         CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS payment_status,
         CAST(o_orderdate AS TIMESTAMP) AS transaction_timestamp
  FROM orders),
engagement_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS subscriber_id,
         CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS article_id,
         CAST(event_id // 4 AS VARCHAR) AS session_id,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'share'
                         WHEN 'purchase' THEN 'comment' ELSE 'save' END AS event_type,
         {_pick('event_id', ['mobile', 'desktop', 'tablet'])} AS device_type,
         CAST(floor(value) AS INTEGER) AS time_spent_seconds,
         CAST(json_extract(props, '$.k') AS INTEGER) AS scroll_depth_pct,
         CAST(ts AS TIMESTAMP) AS event_timestamp
  FROM events),
email_interactions AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS interaction_id,
         CAST(o.o_custkey AS VARCHAR) AS subscriber_id,
         CASE WHEN l.l_linenumber = 7 THEN 'unsubscribed' WHEN l.l_returnflag = 'N' THEN 'sent'
              WHEN l.l_returnflag = 'A' THEN 'opened' WHEN l.l_returnflag = 'R' THEN 'clicked' END AS event_type,
         CAST(l.l_shipdate AS TIMESTAMP) AS event_timestamp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
customer_support AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, CAST(o_custkey AS VARCHAR) AS subscriber_id,
         {_pick('o_orderkey', ['billing', 'technical', 'content', 'cancellation', 'other'])} AS ticket_type,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'medium' ELSE 'low' END AS priority,
         CAST(o_orderdate AS TIMESTAMP) AS created_timestamp
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
promotions AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS promotion_id, CAST(o.o_custkey AS VARCHAR) AS subscriber_id,
         {_pick('l.l_suppkey', ['trial', 'discount', 'referral', 'winback'])} AS promo_type,
         CAST(l.l_discount * 100 AS DECIMAL(5,2)) AS discount_pct,
         CAST(o.o_orderdate AS TIMESTAMP) AS start_date,
         CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL 30 DAY AS end_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_linenumber = 1 AND o.o_orderstatus = 'O'),
articles AS (
  SELECT CAST(p_partkey AS VARCHAR) AS article_id FROM part),
engagement_features AS (
  SELECT subscriber_id, COUNT(*) AS total_engagements,
         COUNT(DISTINCT article_id) AS unique_articles, COUNT(DISTINCT session_id) AS total_sessions,
         AVG(time_spent_seconds) AS avg_time_spent, AVG(scroll_depth_pct) AS avg_scroll_depth,
         CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS total_views,
         CAST(SUM(CASE WHEN event_type = 'share' THEN 1 ELSE 0 END) AS BIGINT) AS total_shares,
         CAST(SUM(CASE WHEN event_type = 'comment' THEN 1 ELSE 0 END) AS BIGINT) AS total_comments,
         COUNT(DISTINCT device_type) AS device_diversity,
         MAX(event_timestamp) AS last_engagement_date
  FROM engagement_events GROUP BY subscriber_id),
payment_features AS (
  SELECT subscriber_id, COUNT(*) AS total_payments,
         CAST(SUM(CASE WHEN payment_status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed_payments,
         CAST(SUM(CASE WHEN payment_status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successful_payments,
         AVG(CAST(amount AS DOUBLE)) AS avg_payment_amount,
         SUM(amount) AS total_revenue,
         CAST(SUM(CASE WHEN payment_status = 'failed' THEN 1 ELSE 0 END) AS DOUBLE)
           / NULLIF(COUNT(*), 0) AS payment_failure_rate
  FROM payments GROUP BY subscriber_id),
email_features AS (
  SELECT subscriber_id,
         CAST(SUM(CASE WHEN event_type = 'sent' THEN 1 ELSE 0 END) AS BIGINT) AS emails_sent,
         CAST(SUM(CASE WHEN event_type = 'opened' THEN 1 ELSE 0 END) AS BIGINT) AS emails_opened,
         CAST(SUM(CASE WHEN event_type = 'clicked' THEN 1 ELSE 0 END) AS BIGINT) AS emails_clicked,
         CAST(SUM(CASE WHEN event_type = 'unsubscribed' THEN 1 ELSE 0 END) AS BIGINT) AS email_unsubscribes,
         CASE WHEN SUM(CASE WHEN event_type = 'sent' THEN 1 ELSE 0 END) > 0
              THEN CAST(SUM(CASE WHEN event_type = 'opened' THEN 1 ELSE 0 END) AS DOUBLE)
                   / SUM(CASE WHEN event_type = 'sent' THEN 1 ELSE 0 END)
              ELSE 0 END AS email_open_rate,
         CASE WHEN SUM(CASE WHEN event_type = 'opened' THEN 1 ELSE 0 END) > 0
              THEN CAST(SUM(CASE WHEN event_type = 'clicked' THEN 1 ELSE 0 END) AS DOUBLE)
                   / SUM(CASE WHEN event_type = 'opened' THEN 1 ELSE 0 END)
              ELSE 0 END AS email_click_rate
  FROM email_interactions GROUP BY subscriber_id),
support_features AS (
  SELECT subscriber_id, COUNT(*) AS total_tickets,
         CAST(SUM(CASE WHEN ticket_type = 'billing' THEN 1 ELSE 0 END) AS BIGINT) AS billing_tickets,
         CAST(SUM(CASE WHEN ticket_type = 'cancellation' THEN 1 ELSE 0 END) AS BIGINT) AS cancel_tickets,
         CAST(SUM(CASE WHEN priority = 'high' THEN 1 ELSE 0 END) AS BIGINT) AS high_priority_tickets
  FROM customer_support GROUP BY subscriber_id),
promo_features AS (
  SELECT subscriber_id, COUNT(*) AS total_promos, MAX(discount_pct) AS max_discount_pct,
         CAST(SUM(CASE WHEN promo_type = 'trial' THEN 1 ELSE 0 END) AS BIGINT) AS trial_promos
  FROM promotions GROUP BY subscriber_id),
spine AS (
  SELECT s.subscriber_id, s.subscription_tier, s.billing_cycle, s.acquisition_channel,
         CAST(datediff('day', s.signup_date, {AS_OF}) AS INTEGER) AS tenure_days,
         CAST(2024 - s.birth_year AS INTEGER) AS age,
         CASE WHEN c.subscriber_id IS NOT NULL THEN 1 ELSE 0 END AS churned
  FROM subscribers s
  LEFT JOIN (SELECT DISTINCT subscriber_id FROM subscription_history WHERE event_type = 'cancel') c
    ON s.subscriber_id = c.subscriber_id),
joined AS (
  SELECT * FROM spine
  LEFT JOIN engagement_features USING (subscriber_id)
  LEFT JOIN payment_features USING (subscriber_id)
  LEFT JOIN email_features USING (subscriber_id)
  LEFT JOIN support_features USING (subscriber_id)
  LEFT JOIN promo_features USING (subscriber_id)),
churn_features AS (
  SELECT subscriber_id, subscription_tier, billing_cycle, acquisition_channel, tenure_days, age, churned,
         COALESCE(total_engagements, 0) AS total_engagements, COALESCE(unique_articles, 0) AS unique_articles,
         COALESCE(total_sessions, 0) AS total_sessions, COALESCE(avg_time_spent, 0) AS avg_time_spent,
         COALESCE(avg_scroll_depth, 0) AS avg_scroll_depth, COALESCE(total_views, 0) AS total_views,
         COALESCE(total_shares, 0) AS total_shares, COALESCE(total_comments, 0) AS total_comments,
         COALESCE(device_diversity, 0) AS device_diversity, last_engagement_date,
         COALESCE(total_payments, 0) AS total_payments, COALESCE(failed_payments, 0) AS failed_payments,
         COALESCE(successful_payments, 0) AS successful_payments,
         COALESCE(avg_payment_amount, 0) AS avg_payment_amount, COALESCE(total_revenue, 0) AS total_revenue,
         COALESCE(payment_failure_rate, 0) AS payment_failure_rate,
         COALESCE(emails_sent, 0) AS emails_sent, COALESCE(emails_opened, 0) AS emails_opened,
         COALESCE(emails_clicked, 0) AS emails_clicked, COALESCE(email_unsubscribes, 0) AS email_unsubscribes,
         COALESCE(email_open_rate, 0) AS email_open_rate, COALESCE(email_click_rate, 0) AS email_click_rate,
         COALESCE(total_tickets, 0) AS total_tickets, COALESCE(billing_tickets, 0) AS billing_tickets,
         COALESCE(cancel_tickets, 0) AS cancel_tickets, COALESCE(high_priority_tickets, 0) AS high_priority_tickets,
         COALESCE(total_promos, 0) AS total_promos, COALESCE(max_discount_pct, 0) AS max_discount_pct,
         COALESCE(trial_promos, 0) AS trial_promos
  FROM joined),
churn_predictions AS (
  SELECT subscriber_id, churned AS actual_churn,
         CASE WHEN failed_payments >= 5 OR cancel_tickets > 2 THEN 1 ELSE 0 END AS predicted_churn
  FROM churn_features),
split AS (
  SELECT subscriber_id,
         CAST((('0x' || substr(md5(subscriber_id), 1, 8))::BIGINT) % 100 AS INTEGER) AS bucket
  FROM subscribers),
wide_split AS (
  SELECT w.*, s.bucket,
         CASE WHEN s.bucket < 60 THEN 'train' WHEN s.bucket < 80 THEN 'validation' ELSE 'test' END AS split
  FROM churn_features w JOIN split s USING (subscriber_id)),
at_risk_rows AS (
  SELECT p.subscriber_id, s.subscription_tier, s.billing_cycle,
         CAST(datediff('day', s.signup_date, {AS_OF}) AS INTEGER) AS tenure_days,
         p.actual_churn,
         ROUND(COALESCE(CAST(pf.total_revenue AS DOUBLE), 0.0), 2) AS total_revenue
  FROM churn_predictions p
  JOIN subscribers s ON p.subscriber_id = s.subscriber_id
  LEFT JOIN payment_features pf ON p.subscriber_id = pf.subscriber_id
  WHERE p.predicted_churn = 1),
at_risk_revenue AS (
  SELECT p.subscriber_id, CAST(w.total_revenue AS DOUBLE) AS total_revenue, w.subscription_tier, w.billing_cycle
  FROM churn_predictions p LEFT JOIN churn_features w ON p.subscriber_id = w.subscriber_id
  WHERE p.predicted_churn = 1),
monitoring_source AS (
  SELECT p.subscriber_id AS id, s.signup_date AS ts,
         CAST(p.predicted_churn AS BIGINT) AS prediction, CAST(p.actual_churn AS BIGINT) AS actual
  FROM churn_predictions p JOIN subscribers s ON p.subscriber_id = s.subscriber_id),
daily_counts AS (
  SELECT CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS day, COUNT(*) AS volume,
         SUM(CASE WHEN prediction = 1 AND actual = 1 THEN 1 ELSE 0 END) AS tp,
         SUM(CASE WHEN prediction = 1 AND actual = 0 THEN 1 ELSE 0 END) AS fp,
         SUM(CASE WHEN prediction = 0 AND actual = 1 THEN 1 ELSE 0 END) AS fn,
         SUM(CASE WHEN prediction = actual THEN 1 ELSE 0 END) AS correct,
         SUM(prediction) AS predicted_positive
  FROM monitoring_source GROUP BY 1),
daily AS (
  SELECT day, volume,
         ROUND(CASE WHEN volume > 0 THEN CAST(correct AS DOUBLE) / volume ELSE 0 END, 6) AS accuracy,
         ROUND(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END, 6) AS precision,
         ROUND(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END, 6) AS recall,
         ROUND(CASE WHEN (CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END)
                       + (CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END) > 0
                    THEN 2 * (CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END)
                           * (CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END)
                         / ((CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END)
                           + (CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END))
                    ELSE 0 END, 6) AS f1_score,
         ROUND(CASE WHEN volume > 0 THEN CAST(predicted_positive AS DOUBLE) / volume ELSE 0 END, 6) AS predicted_rate
  FROM daily_counts),
rule_runs AS (
  SELECT 'rule_fp' || CAST(t AS VARCHAR) AS run_name, CAST(t AS INTEGER) AS n_estimators,
         CAST(0 AS INTEGER) AS max_depth, CAST(0.0 AS DOUBLE) AS learning_rate,
         ROUND(CASE WHEN total > 0 THEN CAST(tp + tn AS DOUBLE) / total ELSE 0 END, 6) AS accuracy,
         ROUND(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END, 6) AS precision,
         ROUND(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END, 6) AS recall,
         ROUND(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END, 6) AS f1_score,
         {AS_OF} + to_minutes(CAST(t AS BIGINT)) AS run_timestamp
  FROM (
    SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS pr,
              CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS rc
    FROM (
      SELECT t, COUNT(*) AS total,
             SUM(CASE WHEN p = 1 AND churned = 1 THEN 1 ELSE 0 END) AS tp,
             SUM(CASE WHEN p = 0 AND churned = 0 THEN 1 ELSE 0 END) AS tn,
             SUM(CASE WHEN p = 1 AND churned = 0 THEN 1 ELSE 0 END) AS fp,
             SUM(CASE WHEN p = 0 AND churned = 1 THEN 1 ELSE 0 END) AS fn
      FROM (SELECT g.t, w.churned,
                   CASE WHEN w.failed_payments >= g.t OR w.cancel_tickets > 2 THEN 1 ELSE 0 END AS p
            FROM churn_features w CROSS JOIN (VALUES (3), (4), (5), (6)) g(t))
      GROUP BY t)))
"""

WIDE_COLS = ["subscriber_id", "subscription_tier", "billing_cycle", "acquisition_channel", "tenure_days",
             "age", "churned", "total_engagements", "unique_articles", "total_sessions", "avg_time_spent",
             "avg_scroll_depth", "total_views", "total_shares", "total_comments", "device_diversity",
             "last_engagement_date", "total_payments", "failed_payments", "successful_payments",
             "avg_payment_amount", "total_revenue", "payment_failure_rate", "emails_sent", "emails_opened",
             "emails_clicked", "email_unsubscribes", "email_open_rate", "email_click_rate", "total_tickets",
             "billing_tickets", "cancel_tickets", "high_priority_tickets", "total_promos", "max_discount_pct",
             "trial_promos"]
REAL_COLS = {"avg_time_spent", "avg_scroll_depth", "avg_payment_amount", "total_revenue", "payment_failure_rate",
             "email_open_rate", "email_click_rate", "max_discount_pct"}


def _sel(cols, places: int = 6, prefix: str = "") -> str:
    out = []
    for c in cols:
        if c in REAL_COLS:
            out.append(f"ROUND(CAST({prefix}{c} AS DOUBLE), {places}) AS {c}")
        else:
            out.append(f"{prefix}{c}")
    return ", ".join(out)


def q(body: str) -> str:
    return "WITH " + PRELUDE.strip() + "\n" + body.strip()


def qx(extra_ctes: str, body: str) -> str:
    """Prelude + extra CTEs (comma-separated, no leading comma) + final SELECT."""
    return "WITH " + PRELUDE.strip() + ",\n" + extra_ctes.strip() + "\n" + body.strip()


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_SNAPSHOT_POINTS = ("SELECT subscriber_id, CAST(unnest(['1996-12-31', '1999-06-30', '2001-12-31', '2024-01-08', '2024-01-20', '2024-01-31']) "
                    "AS TIMESTAMP) AS as_of FROM subscribers")

#: A view's source, its event time and its features over the events that a point in time has seen.
_AS_OF = {
    "engagement": ("engagement_events", "event_timestamp", {
        "total_engagements": "COUNT(e.event_timestamp)", "unique_articles": "COUNT(DISTINCT article_id)",
        "total_sessions": "COUNT(DISTINCT session_id)", "avg_time_spent": "ROUND(COALESCE(AVG(time_spent_seconds), 0), 6)",
        "avg_scroll_depth": "ROUND(COALESCE(AVG(scroll_depth_pct), 0), 6)", "total_views": "COUNT(*) FILTER (e.event_type = 'view')",
        "total_shares": "COUNT(*) FILTER (e.event_type = 'share')", "total_comments": "COUNT(*) FILTER (e.event_type = 'comment')",
        "device_diversity": "COUNT(DISTINCT device_type)", "last_engagement_date": "MAX(e.event_timestamp)"}),
    "payment": ("payments", "transaction_timestamp", {
        "total_payments": "COUNT(e.transaction_timestamp)", "failed_payments": "COUNT(*) FILTER (payment_status = 'failed')",
        "successful_payments": "COUNT(*) FILTER (payment_status = 'success')",
        "avg_payment_amount": "ROUND(COALESCE(CAST(SUM(amount) AS DOUBLE) / COUNT(amount), 0), 6)",
        "total_revenue": "ROUND(CAST(COALESCE(SUM(amount), 0) AS DOUBLE), 6)",
        "payment_failure_rate": "ROUND(COALESCE(CAST(COUNT(*) FILTER (payment_status = 'failed') AS DOUBLE) / NULLIF(COUNT(e.transaction_timestamp), 0), 0), 6)"}),
    "email": ("email_interactions", "event_timestamp", {
        "emails_sent": "COUNT(*) FILTER (e.event_type = 'sent')", "emails_opened": "COUNT(*) FILTER (e.event_type = 'opened')",
        "emails_clicked": "COUNT(*) FILTER (e.event_type = 'clicked')", "email_unsubscribes": "COUNT(*) FILTER (e.event_type = 'unsubscribed')",
        "email_open_rate": "ROUND(COALESCE(CAST(COUNT(*) FILTER (e.event_type = 'opened') AS DOUBLE) / NULLIF(COUNT(*) FILTER (e.event_type = 'sent'), 0), 0), 6)",
        "email_click_rate": "ROUND(COALESCE(CAST(COUNT(*) FILTER (e.event_type = 'clicked') AS DOUBLE) / NULLIF(COUNT(*) FILTER (e.event_type = 'opened'), 0), 0), 6)"}),
    "support": ("customer_support", "created_timestamp", {
        "total_tickets": "COUNT(e.created_timestamp)", "billing_tickets": "COUNT(*) FILTER (ticket_type = 'billing')",
        "cancel_tickets": "COUNT(*) FILTER (ticket_type = 'cancellation')", "high_priority_tickets": "COUNT(*) FILTER (priority = 'high')"}),
    "promo": ("promotions", "start_date", {
        "total_promos": "COUNT(e.start_date)", "max_discount_pct": "ROUND(CAST(COALESCE(MAX(discount_pct), 0) AS DOUBLE), 6)",
        "trial_promos": "COUNT(*) FILTER (promo_type = 'trial')"}),
}


def _view_as_of_sql(view: str, points: str) -> str:
    source, at, features = _AS_OF[view]
    cols = ", ".join(f"{e} AS {n}" for n, e in features.items())
    return (f"SELECT p.subscriber_id, p.as_of, {cols} FROM {points} p LEFT JOIN {source} e "
            f"ON e.subscriber_id = p.subscriber_id AND e.{at} <= p.as_of GROUP BY p.subscriber_id, p.as_of")


def _feature_stats_sql(source: str, cols: list[str]) -> str:
    """A15 body over ``source``: one branch per feature (the reference's own UNION ALL form)."""
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS feature, COUNT({v}) AS cnt, ROUND(AVG({v}), 6) AS mean, "
            f"ROUND(STDDEV_SAMP({v}), 6) AS std, MIN({v}) AS min_val, MAX({v}) AS max_val, "
            f"quantile_disc({v}, 0.5) AS median FROM {source}")
    return _union(parts)


def _long_sql(source: str, cols: list[str], extra: str = "") -> str:
    parts = [f"SELECT {extra}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in cols]
    return _union(parts)


DRIFT = FE.DRIFT_FEATURES
STAR = f"""
star AS (
  SELECT s.subscriber_id, CAST(datediff('day', s.signup_date, {AS_OF}) AS INTEGER) AS tenure_days,
         e.* EXCLUDE (subscriber_id), p.* EXCLUDE (subscriber_id), em.* EXCLUDE (subscriber_id),
         su.* EXCLUDE (subscriber_id), pr.* EXCLUDE (subscriber_id)
  FROM subscribers s
  LEFT JOIN engagement_features e ON s.subscriber_id = e.subscriber_id
  LEFT JOIN payment_features p ON s.subscriber_id = p.subscriber_id
  LEFT JOIN email_features em ON s.subscriber_id = em.subscriber_id
  LEFT JOIN support_features su ON s.subscriber_id = su.subscriber_id
  LEFT JOIN promo_features pr ON s.subscriber_id = pr.subscriber_id)
"""


def _bins_sql(n_bins: int = 10) -> str:
    """Shared CTEs for Q10/Q11: baseline (train) deciles, binned counts, floored shares."""
    probs = ", ".join(str(i / n_bins) for i in range(1, n_bins))
    train = _long_sql("wide_split WHERE split = 'train'", DRIFT)
    test = _long_sql("wide_split WHERE split = 'test'", DRIFT)
    return f""",
base_long AS ({train}),
cur_long AS ({test}),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_disc(value, [{probs}]))) AS edges
  FROM base_long GROUP BY feature),
eb AS (
  SELECT b.feature, len(list_filter(e.edges, lambda x: x < b.value)) AS bin, COUNT(*) AS n_expected
  FROM base_long b JOIN edges e USING (feature) WHERE b.value IS NOT NULL GROUP BY 1, 2),
ab AS (
  SELECT c.feature, len(list_filter(e.edges, lambda x: x < c.value)) AS bin, COUNT(*) AS n_actual
  FROM cur_long c JOIN edges e USING (feature) WHERE c.value IS NOT NULL GROUP BY 1, 2),
bins AS (
  SELECT COALESCE(eb.feature, ab.feature) AS feature, COALESCE(eb.bin, ab.bin) AS bin,
         COALESCE(n_expected, 0) AS n_expected, COALESCE(n_actual, 0) AS n_actual
  FROM eb FULL OUTER JOIN ab ON eb.feature = ab.feature AND eb.bin = ab.bin),
props AS (
  SELECT feature, bin,
         greatest(CAST(n_expected AS DOUBLE) / SUM(n_expected) OVER (PARTITION BY feature), 0.0001) AS pe,
         greatest(CAST(n_actual AS DOUBLE) / SUM(n_actual) OVER (PARTITION BY feature), 0.0001) AS pa
  FROM bins)
"""


def _campaign_sql(target_share: float, high_value: bool, success: float = 0.2, cost: float = 10.0,
                  discount: float = 0.15) -> str:
    where = ("WHERE total_revenue >= (SELECT median(total_revenue) FROM at_risk_revenue)" if high_value else "")
    return f"""
SELECT customers_to_contact, customers_saved, ROUND(revenue_per_saved, 2) AS revenue_per_saved,
       ROUND(campaign_cost, 2) AS campaign_cost, ROUND(discount_cost, 2) AS discount_cost,
       ROUND(campaign_cost + discount_cost, 2) AS total_cost,
       ROUND(customers_saved * revenue_per_saved, 2) AS gross_revenue_saved,
       ROUND(customers_saved * revenue_per_saved - (campaign_cost + discount_cost), 2) AS net_revenue_saved,
       ROUND(CASE WHEN campaign_cost + discount_cost > 0
                  THEN (customers_saved * revenue_per_saved - (campaign_cost + discount_cost))
                       / (campaign_cost + discount_cost) * 100 ELSE 0 END, 6) AS roi_pct,
       ROUND((campaign_cost + discount_cost) / greatest(CAST(customers_saved AS DOUBLE), 1.0), 2) AS cost_per_save
FROM (
  SELECT *, customers_to_contact * {cost} AS campaign_cost,
         customers_saved * revenue_per_saved * {discount} AS discount_cost
  FROM (
    SELECT *, CAST(floor(customers_to_contact * {success}) AS BIGINT) AS customers_saved
    FROM (
      SELECT CAST(floor(COUNT(*) * {target_share}) AS BIGINT) AS customers_to_contact,
             CASE WHEN COUNT(*) > 0 THEN AVG(total_revenue)
                  ELSE (SELECT AVG(total_revenue) FROM at_risk_revenue) END AS revenue_per_saved
      FROM at_risk_revenue {where})))
"""


def _similar_sql(n_queries: int | None, k: int = 5) -> str:
    limit = "" if n_queries is None else f" ORDER BY total_revenue DESC, subscriber_id LIMIT {n_queries}"
    return f"""
, qids AS (SELECT subscriber_id AS query_id FROM at_risk_rows{limit}),
qf AS (SELECT q.query_id, w.billing_cycle, CAST(w.tenure_days AS DOUBLE) AS qt,
              CAST(w.total_engagements AS DOUBLE) AS qe, CAST(w.total_revenue AS DOUBLE) AS qr
       FROM qids q JOIN churn_features w ON w.subscriber_id = q.query_id),
cand AS (SELECT subscriber_id, billing_cycle, CAST(tenure_days AS DOUBLE) AS t,
                CAST(total_engagements AS DOUBLE) AS e, CAST(total_revenue AS DOUBLE) AS r, churned
         FROM churn_features),
pairs AS (SELECT qf.*, c.subscriber_id, c.t, c.e, c.r, c.churned FROM qf JOIN cand c USING (billing_cycle)),
mx AS (SELECT query_id, greatest(MAX(abs(t - qt)), 1.0) AS t_max, greatest(MAX(abs(e - qe)), 1.0) AS e_max,
              greatest(MAX(abs(r - qr)), 1.0) AS r_max FROM pairs GROUP BY query_id),
scored AS (SELECT p.*, abs(p.t - p.qt) / m.t_max + abs(p.e - p.qe) / m.e_max + abs(p.r - p.qr) / m.r_max AS score
           FROM pairs p JOIN mx m USING (query_id)),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score, subscriber_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, subscriber_id, ROUND(score, 6) AS similarity_score,
       CAST(t AS INTEGER) AS tenure_days, ROUND(r, 2) AS total_revenue, churned
FROM ranked WHERE rank <= {k}
"""


def _null_profile_sql() -> str:
    cols = [c for c in WIDE_COLS]
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM joined"
             for c in cols]
    return f"SELECT * FROM ({_union(parts)}) WHERE null_count > 0"


def _risk_factor_sql() -> str:
    numeric = [(f, t, d) for f, t, d in BZ.FEATURE_THRESHOLDS if d != "exact"]
    parts = [f"SELECT subscriber_id, billing_cycle, '{f}' AS feature, CAST({f} AS DOUBLE) AS value_num, "
             f"{t} AS threshold, '{d}' AS direction FROM churn_features" for f, t, d in numeric]
    parts.append("SELECT subscriber_id, billing_cycle, 'billing_cycle' AS feature, CAST(NULL AS DOUBLE) AS value_num, "
                 "CAST(NULL AS DOUBLE) AS threshold, 'exact' AS direction FROM churn_features")
    return f"""
SELECT subscriber_id, feature, ROUND(value_num, 6) AS value_num,
       CASE WHEN direction = 'exact' THEN billing_cycle END AS value_text,
       CASE WHEN (CASE direction WHEN 'high' THEN value_num >= threshold WHEN 'low' THEN value_num <= threshold
                                 ELSE billing_cycle = 'annual' END) THEN 'Good' ELSE 'Risk Factor' END AS status
FROM ({_union(parts)})
"""


def _what_if_sql() -> str:
    conds = ["billing_cycle = 'monthly'", "tenure_days < 90", "unique_articles < 25", "failed_payments > 0",
             "cancel_tickets > 0", "email_open_rate < 0.2"]
    parts = []
    for i, (c, (ch, im, ef, no)) in enumerate(zip(conds, BZ.WHAT_IF_RULES)):
        parts.append(f"SELECT subscriber_id, {i} AS rule, '{ch}' AS change, '{im}' AS impact, '{ef}' AS effort, "
                     f"'{no}' AS note FROM churn_features WHERE {c}")
    return _union(parts)


def _key_check_sql() -> str:
    keys = {"subscribers": "subscriber_id", "subscription_history": "history_id", "payments": "payment_id",
            "engagement_events": "event_id", "email_interactions": "interaction_id",
            "customer_support": "ticket_id", "promotions": "promotion_id", "articles": "article_id"}
    parts = []
    for t, k in keys.items():
        parts.append(f"""SELECT CAST(SUM(n) AS BIGINT) AS rows,
       CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
       COUNT(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS duplicate_keys,
       '{t}' AS table_name, '{k}' AS key_column
FROM (SELECT {k} AS k, COUNT(*) AS n FROM {t} GROUP BY {k})""")
    return _union(parts)


def _lineage_sql(rows_out: bool = False) -> str:
    views = [(FE.FEATURE_VIEWS[k].source.upper(), FE.FEATURE_VIEWS[k].name, f"{k}_features", FE.FEATURE_VIEWS[k].features) for k in FE.VIEW_ORDER]
    views.append(("SUBSCRIBERS", "SUBSCRIBER_FEATURES", "subscribers", ("tenure_days",)))
    counts = _union([f"SELECT '{name}' AS feature_view, COUNT(*) AS view_rows FROM {table}" for _, name, table, _ in views])
    if rows_out:
        rows = ", ".join(f"('{src}', '{name}', '{f}')" for src, name, _, own in views for f in own)
        return (f"SELECT d.source, d.feature_view, d.feature, 'CHURN_MODEL' AS model, c.view_rows "
                f"FROM (VALUES {rows}) d(source, feature_view, feature) JOIN ({counts}) c USING (feature_view)")
    rows = ", ".join(f"('{src}', '{name}', {len(own)}, '{', '.join(sorted(own))}')" for src, name, _, own in views)
    return (f"SELECT d.source, d.feature_view, CAST(d.feature_count AS BIGINT) AS feature_count, d.feature_list, c.view_rows "
            f"FROM (VALUES {rows}) d(source, feature_view, feature_count, feature_list) JOIN ({counts}) c USING (feature_view)")


def oracle_sql() -> dict[str, str]:
    wide_sel = _sel(WIDE_COLS)
    wide_no_ts = _sel([c for c in WIDE_COLS if c != "last_engagement_date"])
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in WIDE_COLS)
    m = {}
    m["scan_table"] = q("SELECT * FROM subscribers")
    m["sql_query"] = q("SELECT subscription_tier, COUNT(*) AS n FROM subscribers WHERE billing_cycle = 'monthly' "
                       "GROUP BY subscription_tier")
    m["table_counts"] = q(_union([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in
                                  ("subscribers", "subscription_history", "payments", "engagement_events",
                                   "email_interactions", "customer_support", "promotions", "articles")]))
    m["ctas_cast"] = q('SELECT id, ts AS "timestamp", prediction, actual FROM monitoring_source')
    m["materialize"] = q("SELECT subscriber_id, actual_churn, predicted_churn FROM churn_predictions")
    m["dataset_snapshot"] = q(f"SELECT {wide_sel} FROM churn_features")
    m["id_lookup"] = q(f"SELECT {wide_sel} FROM churn_features WHERE upper(subscriber_id) IN "
                       "(SELECT upper(subscriber_id) FROM churn_predictions WHERE predicted_churn = 1)")
    m["id_lookup_point"] = q(f"SELECT {wide_sel} FROM churn_features WHERE upper(subscriber_id) IN (SELECT upper(subscriber_id) "
                             "FROM at_risk_rows ORDER BY total_revenue DESC, subscriber_id LIMIT 3)")
    m["head_rows"] = q(f"SELECT {wide_sel} FROM churn_features ORDER BY subscriber_id LIMIT 10")
    m["project"] = q("SELECT subscriber_id, subscription_tier, birth_year AS year_of_birth FROM subscribers")
    m["filter_eq"] = q("SELECT history_id, subscriber_id FROM subscription_history WHERE event_type = 'cancel'")
    m["filter_range"] = q("SELECT subscriber_id, bucket FROM split WHERE bucket >= 60 AND bucket < 80")
    m["filter_null"] = q("SELECT subscriber_id FROM joined WHERE last_engagement_date IS NULL")
    m["case_when"] = q("SELECT payment_id, CASE WHEN payment_status = 'failed' THEN 1 ELSE 0 END AS is_failed "
                       "FROM payments")
    m["fill_numeric"] = q(f"SELECT {wide_no_ts} FROM churn_features")
    m["drop_null_rows"] = q(f"SELECT {wide_sel} FROM churn_features WHERE {not_null}")
    m["split_hash"] = q("SELECT subscriber_id, bucket, CASE WHEN bucket < 60 THEN 'train' WHEN bucket < 80 "
                        "THEN 'validation' ELSE 'test' END AS split FROM split")
    m["sample_n"] = q("SELECT subscriber_id, churned FROM spine ORDER BY md5(subscriber_id || ':42'), subscriber_id "
                      "LIMIT 100")
    m["json_path"] = q("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
    m["left_join_expr"] = q("""SELECT s.subscriber_id, CASE WHEN c.subscriber_id IS NOT NULL THEN 1 ELSE 0 END AS churned
FROM subscribers s LEFT JOIN (SELECT subscriber_id FROM subscription_history WHERE event_type = 'cancel') c
ON s.subscriber_id = c.subscriber_id""")
    m["label_join"] = q("SELECT subscriber_id, churned FROM spine")
    m["spine_join"] = q("SELECT * FROM spine")
    m["feature_join"] = q(f"SELECT {wide_sel} FROM churn_features")
    m["star_left_5"] = qx(STAR, f"SELECT subscriber_id, {_sel(DRIFT)} FROM star")
    m["inner_then_left"] = q("SELECT * FROM at_risk_rows")
    m["merge_left"] = q("SELECT subscriber_id, ROUND(total_revenue, 2) AS total_revenue, subscription_tier, "
                        "billing_cycle FROM at_risk_revenue")
    m["inner_chain"] = q("""SELECT subscriber_id, ROUND(CAST(total_revenue AS DOUBLE), 2) AS total_revenue,
       total_tickets, total_promos
FROM payment_features JOIN support_features USING (subscriber_id) JOIN promo_features USING (subscriber_id)""")
    cat_long = lambda where: _union([f"SELECT '{c}' AS column_name, {c} AS value FROM wide_split WHERE {where}"
                                     for c in FE.CATEGORICAL_FEATURES])
    m["unseen_categories"] = q(f"""SELECT DISTINCT column_name, value FROM ({cat_long("split = 'validation'")}) v
WHERE value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({cat_long("split = 'train'")}) t
  WHERE t.column_name = v.column_name AND t.value = v.value)""")
    segments = ("SELECT concat_ws('/', s.city, s.subscription_tier, s.billing_cycle, s.gender) AS segment "
                "FROM subscribers s JOIN wide_split w USING (subscriber_id) WHERE w.split = '{}'")
    m["unseen_segments"] = q(f"SELECT DISTINCT 'segment' AS column_name, segment AS value FROM ({segments.format('validation')}) "
                             f"WHERE segment NOT IN (SELECT segment FROM ({segments.format('train')}))")
    m["scalar_broadcast"] = q("""SELECT subscriber_id,
       ROUND(CAST(tenure_days AS DOUBLE) / max_tenure, 6) AS tenure_share,
       ROUND(CAST(total_engagements AS DOUBLE) / max_engagements, 6) AS engagement_share,
       ROUND(CAST(total_revenue AS DOUBLE) / CAST(max_revenue AS DOUBLE), 6) AS revenue_share
FROM churn_features CROSS JOIN (SELECT MAX(tenure_days) AS max_tenure, MAX(total_engagements) AS max_engagements,
                                       MAX(total_revenue) AS max_revenue FROM churn_features)""")
    m["threshold_join"] = q(_risk_factor_sql())
    m["as_of_join"] = qx("""
asof_pairs AS (
  SELECT c.history_id, c.subscriber_id, p.payment_id, p.transaction_timestamp AS pts,
         CAST(p.amount AS DOUBLE) AS amount, p.payment_status
  FROM (SELECT history_id, subscriber_id, event_timestamp AS ts FROM subscription_history
        WHERE event_type = 'cancel') c
  LEFT JOIN payments p ON p.subscriber_id = c.subscriber_id AND p.transaction_timestamp <= c.ts)""", """
SELECT a.history_id, a.subscriber_id, a.payments_so_far, a.revenue_so_far, a.failed_so_far, l.last_payment_status
FROM (
  SELECT history_id, subscriber_id, COUNT(payment_id) AS payments_so_far,
         ROUND(SUM(amount), 2) AS revenue_so_far,
         CAST(SUM(CASE WHEN payment_status = 'failed' THEN 1 WHEN payment_status IS NOT NULL THEN 0 END) AS BIGINT)
           AS failed_so_far
  FROM asof_pairs GROUP BY history_id, subscriber_id) a
LEFT JOIN (
  SELECT history_id, payment_status AS last_payment_status FROM (
    SELECT history_id, payment_status,
           ROW_NUMBER() OVER (PARTITION BY history_id ORDER BY pts DESC, payment_id DESC) AS rn
    FROM asof_pairs WHERE payment_id IS NOT NULL) WHERE rn = 1) l
USING (history_id)""")
    for v in FE.VIEW_ORDER:
        m[f"as_of_{v}"] = qx(f"points AS ({_SNAPSHOT_POINTS})", _view_as_of_sql(v, "points"))
    wide = " JOIN ".join(f"({_view_as_of_sql(v, 'points')}) {v}" + ("" if v == FE.VIEW_ORDER[0] else " USING (subscriber_id, as_of)")
                         for v in FE.VIEW_ORDER)
    m["as_of_training"] = qx(f"""
wanted AS (SELECT history_id, subscriber_id, event_timestamp AS as_of FROM subscription_history WHERE event_type = 'cancel'
           UNION ALL SELECT subscriber_id || '@' || CAST(CAST(as_of AS DATE) AS VARCHAR), subscriber_id, as_of FROM ({_SNAPSHOT_POINTS})),
points AS (SELECT DISTINCT subscriber_id, as_of FROM wanted)""", f"""
SELECT history_id, w.*, CAST(datediff('day', last_engagement_date, as_of) AS INTEGER) AS days_since_engagement
FROM wanted JOIN (SELECT * FROM {wide}) w USING (subscriber_id, as_of)""")
    drift_sql = """SELECT COUNT(*) AS n, ROUND(AVG(CAST(predicted_churn AS DOUBLE)), 6) AS predicted_rate,
       ROUND(abs(AVG(CAST(predicted_churn AS DOUBLE)) - 0.29) / 0.29, 6) AS drift,
       COALESCE(CAST(abs(AVG(CAST(predicted_churn AS DOUBLE)) - 0.29) / 0.29 > 0.15 AS INTEGER), 0) AS fires
FROM churn_predictions"""
    m["drift_alert"] = q(drift_sql)
    m["exists_scalar"] = q("""SELECT subscription_tier, CAST(EXISTS (SELECT 1 FROM churn_predictions p JOIN churn_features w USING (subscriber_id)
         WHERE p.predicted_churn = 1 AND w.cancel_tickets > 0 AND w.subscription_tier = t.subscription_tier) AS INTEGER) AS any_churner
FROM (SELECT DISTINCT subscription_tier FROM churn_features) t""")
    m["churn_headline"] = q("""SELECT total_subscribers, churned, total_subscribers - churned AS active,
       ROUND(churned * 100.0 / total_subscribers, 6) AS churned_pct,
       ROUND((total_subscribers - churned) * 100.0 / total_subscribers, 6) AS active_pct
FROM (SELECT COUNT(*) AS total_subscribers FROM subscribers)
CROSS JOIN (SELECT COUNT(*) AS churned FROM subscription_history WHERE event_type = 'cancel')""")
    m["count_by"] = q("SELECT churned, COUNT(*) AS n FROM churn_features GROUP BY churned")
    m["engagement_features"] = q(f"SELECT {_sel(['subscriber_id'] + list(FE.FEATURE_VIEWS['engagement'].features))} "
                                 "FROM engagement_features")
    m["payment_features"] = q(f"SELECT {_sel(['subscriber_id'] + list(FE.FEATURE_VIEWS['payment'].features))} "
                              "FROM payment_features")
    m["email_features"] = q(f"SELECT {_sel(['subscriber_id'] + list(FE.FEATURE_VIEWS['email'].features))} "
                            "FROM email_features")
    m["support_features"] = q("SELECT * FROM support_features")
    m["promo_features"] = q("SELECT subscriber_id, total_promos, ROUND(CAST(max_discount_pct AS DOUBLE), 6) "
                            "AS max_discount_pct, trial_promos FROM promo_features")
    tier_sql = """SELECT s.subscription_tier, COUNT(*) AS total,
       CAST(SUM(CASE WHEN c.subscriber_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS churned,
       ROUND(CAST(SUM(CASE WHEN c.subscriber_id IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100, 6)
         AS churn_rate_pct
FROM subscribers s LEFT JOIN (SELECT subscriber_id FROM subscription_history WHERE event_type = 'cancel') c
  ON s.subscriber_id = c.subscriber_id
GROUP BY s.subscription_tier ORDER BY s.subscription_tier"""
    m["churn_by_tier"] = q(tier_sql)
    m["confusion_cells"] = q("SELECT actual_churn, predicted_churn, COUNT(*) AS n FROM churn_predictions "
                             "GROUP BY 1, 2 ORDER BY 1, 2")
    cells = """SELECT COUNT(*) AS total,
       CAST(COALESCE(SUM(CASE WHEN predicted_churn = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS predicted_churn,
       CAST(COALESCE(SUM(CASE WHEN actual_churn = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS actual_churn,
       CAST(COALESCE(SUM(CASE WHEN predicted_churn = 1 AND actual_churn = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp,
       CAST(COALESCE(SUM(CASE WHEN predicted_churn = 0 AND actual_churn = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tn,
       CAST(COALESCE(SUM(CASE WHEN predicted_churn = 1 AND actual_churn = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp,
       CAST(COALESCE(SUM(CASE WHEN predicted_churn = 0 AND actual_churn = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn
FROM churn_predictions"""
    m["confusion_row"] = q(cells)
    m["classification_metrics"] = q(f"""SELECT total, tp, tn, fp, fn,
       ROUND(CASE WHEN total > 0 THEN CAST(tp + tn AS DOUBLE) / total ELSE 0 END, 6) AS accuracy,
       ROUND(pr, 6) AS precision, ROUND(rc, 6) AS recall,
       ROUND(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END, 6) AS f1_score
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS pr,
                CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS rc
      FROM ({cells}))""")
    m["kpi_metrics"] = q("""SELECT total_subscribers, at_risk, actual_churn, tp,
       ROUND(total_revenue, 2) AS total_revenue, ROUND(revenue_at_risk, 2) AS revenue_at_risk,
       ROUND(CASE WHEN total_subscribers > 0 THEN CAST(at_risk AS DOUBLE) * 100.0 / total_subscribers ELSE 0 END, 6)
         AS at_risk_pct,
       ROUND(CASE WHEN actual_churn > 0 THEN CAST(tp AS DOUBLE) / actual_churn ELSE 0 END, 6) AS recall
FROM (
  SELECT COUNT(*) AS total_subscribers,
         CAST(SUM(CASE WHEN p.predicted_churn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS at_risk,
         CAST(SUM(CASE WHEN p.actual_churn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS actual_churn,
         CAST(SUM(CASE WHEN p.predicted_churn = 1 AND p.actual_churn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         SUM(COALESCE(CAST(pf.total_revenue AS DOUBLE), 0)) AS total_revenue,
         SUM(CASE WHEN p.predicted_churn = 1 THEN COALESCE(CAST(pf.total_revenue AS DOUBLE), 0) ELSE 0 END)
           AS revenue_at_risk
  FROM churn_predictions p LEFT JOIN payment_features pf ON p.subscriber_id = pf.subscriber_id)""")
    m["tier_risk"] = q("""SELECT s.subscription_tier AS tier, COUNT(*) AS subscribers,
       CAST(SUM(CASE WHEN p.predicted_churn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS at_risk,
       ROUND(SUM(COALESCE(CAST(pf.total_revenue AS DOUBLE), 0)), 2) AS revenue,
       ROUND(CAST(SUM(CASE WHEN p.predicted_churn = 1 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100, 1) AS risk_pct,
       ROUND(SUM(CASE WHEN p.predicted_churn = 1 THEN COALESCE(CAST(pf.total_revenue AS DOUBLE), 0) ELSE 0 END), 2)
         AS revenue_at_risk
FROM churn_predictions p
JOIN subscribers s ON p.subscriber_id = s.subscriber_id
LEFT JOIN payment_features pf ON p.subscriber_id = pf.subscriber_id
GROUP BY s.subscription_tier ORDER BY at_risk DESC""")
    m["at_risk_summary"] = q("""SELECT COUNT(*) AS total_at_risk,
       CAST(COALESCE(SUM(CASE WHEN p.actual_churn = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS correctly_predicted,
       ROUND(COALESCE(SUM(COALESCE(CAST(pf.total_revenue AS DOUBLE), 0)), 0), 2) AS revenue_at_risk
FROM churn_predictions p LEFT JOIN payment_features pf ON p.subscriber_id = pf.subscriber_id
WHERE p.predicted_churn = 1""")
    m["feature_stats"] = qx(STAR,
                          f"SELECT feature, cnt, mean, std, ROUND(min_val, 6) AS min_val, ROUND(max_val, 6) AS max_val, "
                          f"median FROM ({_feature_stats_sql('star', DRIFT)})")
    m["coverage_check"] = q(f"""SELECT v.name AS view, v.rows, s.subscribers,
       ROUND(CAST(v.rows AS DOUBLE) / s.subscribers, 6) AS coverage,
       CASE WHEN v.name IN ('engagement', 'payment') THEN 1 ELSE 0 END AS required,
       CASE WHEN v.name IN ('engagement', 'payment') AND v.rows < s.subscribers * 0.9 THEN 'fail' ELSE 'pass' END
         AS status
FROM ({_union([f"SELECT '{k}' AS name, COUNT(*) AS rows FROM {k}_features" for k in FE.VIEW_ORDER])}) v
CROSS JOIN (SELECT COUNT(*) AS subscribers FROM subscribers) s""")
    m["split_quality"] = q("SELECT split, COUNT(*) AS rows, ROUND(AVG(CAST(churned AS DOUBLE)), 6) AS churn_rate "
                           "FROM wide_split GROUP BY split")
    m["null_profile"] = q(_null_profile_sql())
    m["category_values"] = q(f"""SELECT column_name, COUNT(*) AS n_values, string_agg(value, ',' ORDER BY value) AS values
FROM (SELECT DISTINCT column_name, value FROM ({_union([f"SELECT '{c}' AS column_name, {c} AS value FROM wide_split "
                                                        "WHERE split = 'train'" for c in FE.CATEGORICAL_FEATURES])})
      WHERE value IS NOT NULL)
GROUP BY column_name""")
    m["prediction_nulls"] = q("SELECT COUNT(*) FILTER (WHERE predicted_churn IS NULL) AS null_predictions, "
                              "COUNT(*) AS total FROM churn_predictions")
    m["degenerate_check"] = q("""SELECT COUNT(DISTINCT predicted_churn) AS distinct_predictions,
       ROUND(AVG(CAST(predicted_churn AS DOUBLE)), 6) AS positive_share,
       CAST(COUNT(DISTINCT predicted_churn) <= 1 AS INTEGER) AS single_class
FROM churn_predictions""")
    m["health_means"] = q("""SELECT COUNT(*) AS total_predictions,
       ROUND(AVG(CAST(predicted_churn = 1 AS DOUBLE)), 6) AS predicted_churn_rate,
       ROUND(AVG(CAST(actual_churn = 1 AS DOUBLE)), 6) AS actual_churn_rate,
       ROUND(AVG(CAST(predicted_churn = actual_churn AS DOUBLE)), 6) AS accuracy
FROM churn_predictions""")
    m["revenue_stats"] = q("""SELECT COUNT(*) AS num_at_risk, ROUND(AVG(total_revenue), 2) AS avg_revenue,
       ROUND(SUM(total_revenue), 2) AS total_revenue_at_risk, ROUND(median(total_revenue), 2) AS median_revenue
FROM at_risk_revenue""")
    hist_long = _long_sql("churn_features", DRIFT, extra="churned, ")
    m["class_histogram"] = qx(f"""hl AS ({hist_long}),
rng AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM hl GROUP BY feature)""", """
SELECT feature, churned, bucket, COUNT(*) AS n, ROUND(lo + bucket * (hi - lo) / 10, 6) AS bin_start
FROM (SELECT h.feature, h.churned, r.lo, r.hi,
             CAST(CASE WHEN r.hi - r.lo = 0 THEN 0
                       ELSE least(floor((h.value - r.lo) / (r.hi - r.lo) * 10), 9) END AS INTEGER) AS bucket
      FROM hl h JOIN rng r USING (feature) WHERE h.value IS NOT NULL)
GROUP BY feature, churned, bucket, lo, hi""")
    m["alignment_accuracy"] = q("SELECT COUNT(*) AS n, ROUND(AVG(CAST(predicted_churn = actual_churn AS INTEGER)), 6) "
                                "AS accuracy FROM churn_predictions")
    m["conditional_count"] = q("""SELECT COUNT(*) AS total,
       ROUND(CAST(SUM(CASE WHEN predicted_churn = actual_churn THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 6) AS accuracy,
       ROUND(CAST(SUM(CASE WHEN predicted_churn = 1 AND actual_churn = 1 THEN 1 ELSE 0 END) AS DOUBLE)
             / NULLIF(SUM(CASE WHEN actual_churn = 1 THEN 1 ELSE 0 END), 0), 6) AS recall,
       COUNT(CASE WHEN predicted_churn = 1 THEN 1 END) AS at_risk,
       ROUND(SUM(CASE WHEN predicted_churn = 1 THEN CAST(total_revenue AS DOUBLE) ELSE 0 END), 2) AS revenue_at_risk
FROM churn_predictions p JOIN payment_features r USING (subscriber_id)""")
    m["simple_drift_stats"] = q("""SELECT 'total_revenue' AS feature,
       ROUND(AVG(CAST(total_revenue AS DOUBLE)), 6) AS mean, ROUND(STDDEV_SAMP(CAST(total_revenue AS DOUBLE)), 6) AS std,
       quantile_disc(CAST(total_revenue AS DOUBLE), 0.5) AS median
FROM payment_features""")
    m["experiment_runs"] = q("SELECT * FROM rule_runs ORDER BY run_timestamp DESC, run_name LIMIT 50")
    m["best_run"] = q("SELECT * FROM rule_runs ORDER BY f1_score DESC, run_timestamp, run_name LIMIT 1")
    m["metric_trend"] = q("""SELECT *, ROUND(accuracy - LAG(accuracy) OVER (ORDER BY day), 6) AS accuracy_change,
       ROUND(f1_score - LAG(f1_score) OVER (ORDER BY day), 6) AS f1_score_change FROM daily""")
    m["version_compare"] = q("""SELECT metric, value_a, value_b, ROUND(value_b - value_a, 6) AS difference,
       CASE WHEN value_b - value_a > 0 THEN 'rule_fp5' WHEN value_b - value_a < 0 THEN 'rule_fp4' ELSE 'tie' END AS winner
FROM (SELECT a.metric, a.value AS value_a, b.value AS value_b
      FROM (UNPIVOT (SELECT accuracy, precision, recall, f1_score FROM rule_runs WHERE run_name = 'rule_fp4')
            ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value) a
      JOIN (UNPIVOT (SELECT accuracy, precision, recall, f1_score FROM rule_runs WHERE run_name = 'rule_fp5')
            ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value) b USING (metric))""")
    m["top_k_per_query"] = q(_similar_sql(5).lstrip().lstrip(",")).replace(
        "WITH " + PRELUDE.strip() + "\n", "WITH " + PRELUDE.strip() + ",\n", 1)
    m["page_number"] = q("""SELECT subscriber_id, row_number, CAST(floor((row_number - 1) / 100) + 1 AS BIGINT) AS page
FROM (SELECT subscriber_id, ROW_NUMBER() OVER (ORDER BY total_revenue DESC, subscriber_id) AS row_number
      FROM at_risk_rows)""")
    m["order_by"] = q(tier_sql)
    m["order_by_expr"] = q("SELECT * FROM at_risk_rows ORDER BY COALESCE(total_revenue, 0) DESC, subscriber_id")
    m["at_risk_page"] = q("SELECT * FROM at_risk_rows ORDER BY total_revenue DESC, subscriber_id LIMIT 100 OFFSET 100")
    m["page_count"] = q("SELECT COUNT(*) AS n_rows, CAST(CASE WHEN COUNT(*) > 0 THEN floor((COUNT(*) - 1) / 100) + 1 "
                        "ELSE 0 END AS BIGINT) AS n_pages FROM at_risk_rows")
    m["top_100_export"] = q("SELECT * FROM at_risk_rows ORDER BY total_revenue DESC, subscriber_id LIMIT 100")
    m["top_20_value"] = q("SELECT COUNT(*) AS n, ROUND(SUM(total_revenue), 2) AS top_revenue FROM "
                          "(SELECT * FROM at_risk_rows ORDER BY total_revenue DESC, subscriber_id LIMIT 20)")
    m["n_smallest"] = q(_similar_sql(1).lstrip().lstrip(",")).replace(
        "WITH " + PRELUDE.strip() + "\n", "WITH " + PRELUDE.strip() + ",\n", 1)
    m["deterministic_sample"] = q("SELECT subscriber_id, actual_churn, predicted_churn FROM churn_predictions "
                                  "ORDER BY subscriber_id LIMIT 50")
    m["union_all"] = q(_union(["SELECT COUNT(*) AS rows, 'subscribers' AS name FROM subscribers"] +
                              [f"SELECT COUNT(*) AS rows, '{k}' AS name FROM {k}_features" for k in FE.VIEW_ORDER]))
    m["concat"] = q(f"SELECT *, 'default' AS scenario FROM ({_campaign_sql(1.0, False)}) UNION ALL "
                    f"SELECT *, 'high_value' AS scenario FROM ({_campaign_sql(1.0, True)})")
    m["distinct"] = q("SELECT DISTINCT subscriber_id FROM subscription_history WHERE event_type = 'cancel'")
    m["set_minus"] = q("SELECT subscriber_id FROM subscribers WHERE subscriber_id NOT IN "
                       "(SELECT subscriber_id FROM engagement_events)")
    m["scalar_functions"] = q(f"""SELECT subscriber_id,
       CAST(datediff('day', signup_date, {AS_OF}) AS INTEGER) AS tenure_days,
       CAST(2024 - birth_year AS INTEGER) AS age,
       (('0x' || substr(md5(subscriber_id), 1, 8))::BIGINT) % 100 AS bucket,
       ROUND(birth_year / 7.0, 1) AS rounded,
       COALESCE(last_name, first_name) AS display_name,
       CAST(floor(birth_year * 0.37) AS BIGINT) AS truncated,
       greatest(least(birth_year, 1990), 1960) AS clamped,
       upper(subscription_tier) AS tier_upper,
       substr(email, 1, 12) AS email_prefix,
       CAST(CAST(signup_date AS DATE) + 30 AS VARCHAR) AS plus_30_days,
       subscription_tier || ', ' || billing_cycle AS joined
FROM subscribers""")
    m["month_ends"] = q("""SELECT subscription_tier, CAST(last_day(CAST(m AS DATE)) AS VARCHAR) AS month_end
FROM (SELECT subscription_tier,
             unnest(generate_series(date_trunc('month', MIN(signup_date)), date_trunc('month', MAX(signup_date)),
                                    INTERVAL 1 MONTH)) AS m
      FROM subscribers GROUP BY subscription_tier)""")
    m["health_status"] = q("""SELECT total_predictions, ROUND(pr, 6) AS predicted_churn_rate,
       ROUND(ar, 6) AS actual_churn_rate, ROUND(acc, 6) AS accuracy,
       ROUND(abs(pr - 0.29) / 0.29, 6) AS churn_drift, ROUND((0.90 - acc) / 0.90, 6) AS accuracy_drift,
       CASE WHEN acc >= 0.90 AND abs(pr - 0.29) / 0.29 < 0.1 THEN 'Healthy'
            WHEN acc >= 0.85 OR abs(pr - 0.29) / 0.29 < 0.2 THEN 'Warning' ELSE 'Critical' END AS health
FROM (SELECT COUNT(*) AS total_predictions, AVG(CAST(predicted_churn = 1 AS DOUBLE)) AS pr,
             AVG(CAST(actual_churn = 1 AS DOUBLE)) AS ar, AVG(CAST(predicted_churn = actual_churn AS DOUBLE)) AS acc
      FROM churn_predictions)""")
    m["engagement_score"] = q("""SELECT subscriber_id, ROUND(score, 6) AS engagement_score,
       CASE WHEN score > 60 THEN 'high' WHEN score > 30 THEN 'medium' ELSE 'low' END AS engagement_band
FROM (SELECT subscriber_id, least(100.0, CAST((unique_articles * 2 + total_sessions + total_engagements / 5
                                         + avg_time_spent / 6) / 4 AS DOUBLE)) AS score FROM churn_features)""")
    m["risk_bands"] = q("""SELECT subscriber_id,
       CASE WHEN tenure_days > 90 THEN 'established' WHEN tenure_days > 30 THEN 'new' ELSE 'very_new' END AS tenure_status,
       ROUND(rate, 6) AS failure_rate,
       CASE WHEN rate > 0.2 THEN 'high' WHEN rate > 0.1 THEN 'medium' ELSE 'low' END AS failure_band
FROM (SELECT *, CAST(failed_payments AS DOUBLE) / greatest(CAST(total_payments AS DOUBLE), 1.0) AS rate
      FROM churn_features)""")
    m["key_check"] = q(_key_check_sql())
    m["similar_subscribers"] = q(_similar_sql(None).lstrip().lstrip(",")).replace(
        "WITH " + PRELUDE.strip() + "\n", "WITH " + PRELUDE.strip() + ",\n", 1)
    last = m["similar_subscribers"].rindex("SELECT query_id, CAST(rank AS INTEGER)")
    m["similar_churn_rate"] = m["similar_subscribers"][:last] + (
        "SELECT query_id, COUNT(*) AS n_similar, ROUND(AVG(CAST(churned AS DOUBLE)), 6) AS churn_rate\n"
        "FROM ranked WHERE rank <= 5 GROUP BY query_id")
    m["similar_picks"] = m["similar_subscribers"][:last] + (
        "SELECT query_id, churned, CAST(pick AS INTEGER) AS pick, subscriber_id, ROUND(score, 6) AS similarity_score\n"
        "FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id, churned ORDER BY rank) AS pick FROM ranked WHERE rank <= 5)\n"
        "WHERE pick <= 2")
    m["risk_factors"] = q(_risk_factor_sql())
    m["what_if_actions"] = q(_what_if_sql())
    stats = lambda where: _feature_stats_sql(f"wide_split WHERE split = '{where}'", DRIFT)
    m["mean_shift"] = q(f"""SELECT c.feature, c.cnt, c.mean, b.mean AS baseline_mean,
       ROUND(abs(c.mean - b.mean) / greatest(b.mean, 0.001), 6) AS drift_score,
       CASE WHEN abs(c.mean - b.mean) / greatest(b.mean, 0.001) < 0.1 THEN 'Stable'
            WHEN abs(c.mean - b.mean) / greatest(b.mean, 0.001) < 0.2 THEN 'Monitor' ELSE 'Drifted' END AS status,
       ROUND(CASE WHEN c.mean != 0 THEN c.std / c.mean ELSE 0 END, 6) AS spread
FROM ({stats('test')}) c JOIN ({stats('train')}) b USING (feature)""")
    m["psi"] = q(_bins_sql().lstrip().lstrip(",") + """
SELECT feature, ROUND(psi, 6) AS psi,
       CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS band
FROM (SELECT feature, SUM((pa - pe) * ln(pa / pe)) AS psi FROM props GROUP BY feature)""").replace(
        "WITH " + PRELUDE.strip() + "\n", "WITH " + PRELUDE.strip() + ",\n", 1)
    m["distribution_distance"] = q(_bins_sql().lstrip().lstrip(",") + """,
cdf AS (SELECT *, abs(SUM(pa) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                    - SUM(pe) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                  AS cdf_gap FROM props)
SELECT feature, ROUND(SUM(pa * ln(pa / pe)), 6) AS kl,
       ROUND(SUM(0.5 * pa * ln(pa / ((pa + pe) / 2)) + 0.5 * pe * ln(pe / ((pa + pe) / 2))), 6) AS js,
       ROUND(MAX(cdf_gap), 6) AS ks, ROUND(SUM((pa - pe) * (pa - pe) / pe), 6) AS chi2,
       ROUND(SUM(cdf_gap), 6) AS wasserstein
FROM cdf GROUP BY feature""").replace(
        "WITH " + PRELUDE.strip() + "\n", "WITH " + PRELUDE.strip() + ",\n", 1)
    m["campaign_roi"] = q(_campaign_sql(1.0, False))
    m["campaign_roi_high_value"] = q(_campaign_sql(0.5, True))
    m["scenario_grid"] = q("""SELECT success_rate, cost_per_contact, contacted, saved,
       ROUND(cost, 2) AS total_cost, ROUND(revenue, 2) AS revenue_saved, ROUND(revenue - cost, 2) AS net_benefit,
       ROUND(CASE WHEN cost > 0 THEN (revenue - cost) / cost * 100 ELSE 0 END, 6) AS roi_pct
FROM (SELECT *, contacted * cost_per_contact + saved * avg_revenue * 0.15 AS cost, saved * avg_revenue AS revenue
      FROM (SELECT *, CAST(floor(contacted * success_rate) AS BIGINT) AS saved
            FROM (SELECT g.success_rate, g.cost_per_contact, t.avg_revenue,
                         CAST(floor(t.num_at_risk * 0.8) AS BIGINT) AS contacted
                  FROM (SELECT CAST(s AS DOUBLE) AS success_rate, CAST(c AS DOUBLE) AS cost_per_contact
                        FROM (VALUES (0.1), (0.2), (0.3)) a(s) CROSS JOIN (VALUES (5.0), (10.0), (20.0)) b(c)) g
                  CROSS JOIN (SELECT COUNT(*) AS num_at_risk, COALESCE(AVG(total_revenue), 150.0) AS avg_revenue
                              FROM at_risk_revenue) t)))""")
    m["revenue_overview"] = q("""SELECT *, ROUND(total_revenue_at_risk * 12 / greatest((SELECT COUNT(*) FROM churn_predictions), 1)
                      * 1000, 2) AS annualized_impact
FROM (SELECT COUNT(*) AS num_at_risk, ROUND(AVG(total_revenue), 2) AS avg_revenue,
             ROUND(SUM(total_revenue), 2) AS total_revenue_at_risk, ROUND(median(total_revenue), 2) AS median_revenue
      FROM at_risk_revenue)""")
    m["roi_sql"] = q("""SELECT at_risk_count, ROUND(revenue_at_risk, 2) AS revenue_at_risk,
       ROUND((potential_saves - campaign_cost) / campaign_cost * 100, 6) AS roi_percent
FROM (SELECT COUNT(*) AS at_risk_count, SUM(annual_revenue) AS revenue_at_risk,
             COUNT(*) * 0.2 * AVG(annual_revenue) AS potential_saves, COUNT(*) * 10.0 AS campaign_cost
      FROM (SELECT p.subscriber_id, CAST(w.total_revenue AS DOUBLE) AS annual_revenue
            FROM churn_predictions p JOIN churn_features w USING (subscriber_id) WHERE p.predicted_churn = 1))""")
    m["lineage"] = q(_lineage_sql())
    m["lineage_rows"] = q(_lineage_sql(True))
    m["monitor_daily"] = q("SELECT * FROM daily")
    m["retrain_trigger"] = q("SELECT day, accuracy, volume FROM daily WHERE accuracy < 0.85")
    m["melt_metrics"] = q("UNPIVOT (SELECT day, accuracy, precision, recall, f1_score FROM daily) "
                          "ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value")
    m["billing_schedule"] = q(f"""SELECT subscriber_id, billing_cycle, CAST(k AS INTEGER) AS charge_number,
       CAST(CAST(signup_date AS DATE) + CAST(k * step AS INTEGER) AS VARCHAR) AS charge_date
FROM (SELECT *, unnest(range(0, n + 1)) AS k
      FROM (SELECT s.subscriber_id, s.billing_cycle, s.signup_date, end_ts,
                   CASE WHEN s.billing_cycle = 'annual' THEN 365 ELSE 30 END AS step,
                   CAST(floor(datediff('day', s.signup_date, end_ts)
                              / (CASE WHEN s.billing_cycle = 'annual' THEN 365 ELSE 30 END)) AS INTEGER) AS n
            FROM (SELECT s.*, COALESCE(least(c.cancel_ts, {AS_OF}), {AS_OF}) AS end_ts
                  FROM subscribers s LEFT JOIN (SELECT subscriber_id, MIN(event_timestamp) AS cancel_ts
                                                FROM subscription_history WHERE event_type = 'cancel'
                                                GROUP BY subscriber_id) c USING (subscriber_id)) s)
      WHERE n >= 0)
WHERE CAST(CAST(signup_date AS DATE) + CAST(k * step AS INTEGER) AS TIMESTAMP) < end_ts""")
    m["promo_status"] = q(f"""SELECT promotion_id, subscriber_id, promo_type,
       CASE WHEN end_date < {AS_OF} THEN 'expired' ELSE 'active' END AS status,
       CAST(datediff('day', start_date, end_date) AS INTEGER) AS duration_days,
       CASE promo_type WHEN 'trial' THEN datediff('day', start_date, end_date) = 14
            WHEN 'discount' THEN datediff('day', start_date, end_date) IN (30, 90, 180)
            ELSE datediff('day', start_date, end_date) IN (30, 60) END AS usual_duration
FROM promotions""")
    m["recency"] = q(f"SELECT subscriber_id, CAST(datediff('day', last_engagement_date, {AS_OF}) AS INTEGER) "
                     "AS days_since_last FROM engagement_features")
    m["incremental_features"] = m["engagement_features"]
    expl = ", ".join(f"('{c}', '{t}')" for c, t in BZ.FEATURE_EXPLANATIONS)
    m["feature_stats_explained"] = qx(STAR, f"""SELECT s.feature, s.cnt, s.mean,
       COALESCE(e.explanation, '{BZ.DEFAULT_EXPLANATION}') AS explanation
FROM ({_feature_stats_sql('star', DRIFT)}) s
LEFT JOIN (VALUES {expl}) e(code, explanation) ON upper(s.feature) = e.code""")
    m["alias"] = q("SELECT subscriber_id, subscription_tier FROM subscribers")
    m["with_column"] = q("SELECT subscriber_id, tenure_days, 'spine' AS source, "
                         "CAST(floor(tenure_days / 7) AS BIGINT) AS tenure_weeks FROM spine")
    m["drop_columns"] = q("""SELECT sp.subscriber_id, sp.subscription_tier, sp.billing_cycle, sp.tenure_days, sp.churned,
       CASE WHEN s.bucket < 60 THEN 'train' WHEN s.bucket < 80 THEN 'validation' ELSE 'test' END AS split
FROM spine sp JOIN split s USING (subscriber_id)""")
    m["match_flag"] = q("""SELECT s.subscriber_id, CASE WHEN p.subscriber_id IS NOT NULL THEN 1 ELSE 0 END AS has_promo
FROM subscribers s LEFT JOIN (SELECT DISTINCT subscriber_id FROM promotions) p ON s.subscriber_id = p.subscriber_id""")
    m["fill_by_map"] = q("SELECT subscriber_id, churned FROM spine")
    fill_cols = [c for c in WIDE_COLS if c not in ("churned", "last_engagement_date")]
    m["fill_all"] = q(f"SELECT {_sel(fill_cols)} FROM churn_features")
    m["cast"] = q("""SELECT payment_id, CAST(amount AS DOUBLE) AS amount_float, CAST(amount AS INTEGER) AS amount_int,
       CAST(transaction_timestamp AS VARCHAR) AS ts_text, TRY_CAST(payment_id AS BIGINT) AS payment_number,
       TRY_CAST('n/a' AS INTEGER) AS bad_number
FROM payments""")
    m["coalesce"] = q("SELECT s.subscriber_id, COALESCE(p.total_promos, 0) AS total_promos FROM subscribers s "
                      "LEFT JOIN promo_features p ON s.subscriber_id = p.subscriber_id")
    m["safe_ratio"] = q("""SELECT subscriber_id,
       ROUND(CAST(emails_opened AS DOUBLE) / NULLIF(emails_sent, 0), 6) AS nullif_rate,
       ROUND(CASE WHEN emails_opened > 0 THEN CAST(emails_clicked AS DOUBLE) / emails_opened ELSE 0 END, 6) AS case_rate,
       ROUND(CAST(emails_clicked AS DOUBLE) / greatest(CAST(emails_opened AS DOUBLE), 1.0), 6) AS floor_rate
FROM email_features""")
    m["left_for_sum"] = q("SELECT ROUND(SUM(COALESCE(CAST(pf.total_revenue AS DOUBLE), 0)), 2) AS total_revenue "
                          "FROM churn_predictions p LEFT JOIN payment_features pf USING (subscriber_id)")
    m["scenario_cross"] = q("""SELECT subscription_tier, CAST(s AS DOUBLE) AS success_rate, CAST(c AS DOUBLE) AS cost_per_contact,
       ROUND(n * CAST(c AS DOUBLE), 2) AS contact_cost, ROUND(revenue * CAST(s AS DOUBLE), 2) AS revenue_saved
FROM (SELECT subscription_tier, COUNT(*) AS n, SUM(total_revenue) AS revenue FROM at_risk_revenue GROUP BY subscription_tier)
CROSS JOIN (VALUES (0.1), (0.2), (0.3)) a(s) CROSS JOIN (VALUES (5.0), (10.0), (20.0)) b(c)""")
    m["as_of_last"] = q("""SELECT history_id, subscriber_id, last_payment_status, last_payment_id FROM (
  SELECT c.history_id, c.subscriber_id, p.payment_status AS last_payment_status, p.payment_id AS last_payment_id,
         ROW_NUMBER() OVER (PARTITION BY c.history_id
                            ORDER BY p.transaction_timestamp DESC NULLS LAST, p.payment_id DESC NULLS LAST) AS rn
  FROM (SELECT history_id, subscriber_id, event_timestamp AS ts FROM subscription_history
        WHERE event_type = 'cancel') c
  LEFT JOIN payments p ON p.subscriber_id = c.subscriber_id AND p.transaction_timestamp <= c.ts)
WHERE rn = 1""")
    m["sink_overwrite"] = q("SELECT subscriber_id, actual_churn, predicted_churn FROM churn_predictions")
    m["sink_append"] = q("SELECT * FROM rule_runs UNION ALL SELECT * FROM rule_runs")
    m["bulk_load"] = q("""SELECT payment_id, ROUND(CAST(amount AS DOUBLE), 6) AS amount,
       CASE WHEN payment_status = 'failed' THEN NULL ELSE ROUND(CAST(amount AS DOUBLE), 6) END AS ratio
FROM payments""")
    m["schema_ddl"] = q("SELECT payment_id, subscriber_id, ROUND(CAST(amount AS DOUBLE), 2) AS amount, payment_status, "
                        f"{AS_OF} AS created_at FROM payments")
    m["export_csv"] = m["churn_by_tier"]
    fv_rows = ", ".join(f"('{FE.FEATURE_VIEWS[k].name}', '{FE.FEATURE_VIEWS[k].version}', "
                        f"'{FE.FEATURE_VIEWS[k].entity.name}', '{FE.FEATURE_VIEWS[k].description}', "
                        f"'{FE.FEATURE_VIEWS[k].refresh}', '{k}')" for k in FE.VIEW_ORDER)
    fv_counts = _union([f"SELECT '{k}' AS view, COUNT(*) AS rows FROM {k}_features" for k in FE.VIEW_ORDER])
    m["feature_view_list"] = q(f"""SELECT d.name, d.version, d.entity, d.description, d.refresh, c.rows
FROM (VALUES {fv_rows}) d(name, version, entity, description, refresh, view) JOIN ({fv_counts}) c USING (view)""")
    m["register_view"] = m["payment_features"]
    m["register_entity"] = q("""SELECT 'SUBSCRIBER' AS entity, 'subscriber_id' AS key_column, CAST(SUM(n) AS BIGINT) AS rows,
       CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
       COUNT(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS duplicate_keys
FROM (SELECT subscriber_id AS k, COUNT(*) AS n FROM subscribers GROUP BY subscriber_id)""")
    m["refresh_view"] = m["support_features"]
    # T1 stream: append mode emits a window once the watermark (max event time - 1 day) reaches its end
    m["monitor_daily_stream"] = q("SELECT * FROM daily")
    enc = []
    for c in FE.CATEGORICAL_FEATURES:
        enc.append(f"""CAST(CASE WHEN {c} IN (SELECT {c} FROM wide_split WHERE split = 'train')
            THEN (SELECT COUNT(DISTINCT t.{c}) FROM wide_split t WHERE t.split = 'train' AND t.{c} < s.{c})
            ELSE (SELECT COUNT(DISTINCT t.{c}) FROM wide_split t WHERE t.split = 'train') END AS INTEGER)
          AS {c}_idx""")
    m["label_encode"] = q(f"SELECT s.subscriber_id, {', '.join(enc)} FROM spine s")
    grids = {1: [(100, 6, 0.1)], 2: [(30, 4, 0.3), (40, 5, 0.25)], 3: [(30, 4, 0.3), (40, 5, 0.25), (50, 6, 0.2)]}
    fixed = ", ".join(f"({n}, {i}, {t}, {d}, {lr})" for n, own in grids.items() for i, (t, d, lr) in enumerate(own))
    m["param_grid"] = q(f"""SELECT g.*, (SELECT COUNT(*) FROM wide_split WHERE split = 'train') AS training_rows
FROM (SELECT CAST(num_runs AS INTEGER) AS num_runs, CAST(run AS INTEGER) AS run, CAST(n_estimators AS INTEGER) AS n_estimators,
             CAST(max_depth AS INTEGER) AS max_depth, CAST(learning_rate AS DOUBLE) AS learning_rate
      FROM (VALUES {fixed}) t(num_runs, run, n_estimators, max_depth, learning_rate)
      UNION ALL
      SELECT n, i, 30 + 10 * i, 4 + i, round(0.3 - i * (0.15 / (n - 1)), 3)
      FROM (SELECT n, CAST(unnest(range(n)) AS INTEGER) AS i FROM (VALUES (4), (10), (23), (60)) t(n))) g""")
    m["sweep_facts"] = q("""SELECT unnest(['configurations', 'settings', 'metrics_in_range', 'winner_is_best', 'defaults']) AS fact,
       unnest([2.0::DOUBLE, 2, 4, 1, 1]) * (COUNT(*) > 0)::INT AS value FROM churn_features""")
    m["model_surface_facts"] = q("""
SELECT 'predict_batch' AS query, unnest(['rows', 'ids', 'nulls']) AS fact, unnest([COUNT(*), COUNT(DISTINCT subscriber_id), 0])::DOUBLE AS value FROM wide_split WHERE split = 'test'
UNION ALL SELECT 'churn_probability', unnest(['rows', 'ids', 'inside']), unnest([COUNT(*), COUNT(*), COUNT(*)])::DOUBLE FROM churn_features
UNION ALL SELECT 'daily_scores', unnest(['rows', 'ids', 'classes']), unnest([COUNT(*), COUNT(*), COUNT(*)])::DOUBLE FROM subscribers
UNION ALL SELECT 'score_profiles', unnest(['rows', 'ids', 'off']), unnest([COUNT(*), COUNT(*), 0])::DOUBLE FROM subscribers WHERE billing_cycle = 'monthly'
UNION ALL SELECT 'model_sql_function', unnest(['rows', 'outside']), unnest([COUNT(*), 0])::DOUBLE FROM wide_split WHERE split = 'test'
UNION ALL SELECT 'model_save', 'rows', 0::DOUBLE
UNION ALL SELECT 'model_versions', unnest(['rows', 'metrics']), unnest([1, 1])::DOUBLE
UNION ALL SELECT 'gain_importance', unnest(['rows', 'total', 'negative']), unnest([33, 1, 0])::DOUBLE
UNION ALL SELECT 'top_importance', unnest(['rows', 'features']), unnest([15, 15])::DOUBLE
UNION ALL SELECT 'gbt_fit', unnest(['trees', 'inputs']), unnest([100, 33])::DOUBLE
UNION ALL SELECT 'pipeline_fit', unnest(['rows', 'inside']), unnest([1, 1])::DOUBLE
UNION ALL SELECT 'model_metrics', unnest(['rows', 'inside']), unnest([1, 1])::DOUBLE""")
    wide_types = {"int": ("tenure_days", "age", "churned"),
                  "bigint": ("total_engagements", "unique_articles", "total_sessions", "total_views", "total_shares", "total_comments",
                             "device_diversity", "total_payments", "failed_payments", "successful_payments", "emails_sent", "emails_opened",
                             "emails_clicked", "email_unsubscribes", "total_tickets", "billing_tickets", "cancel_tickets",
                             "high_priority_tickets", "total_promos", "trial_promos"),
                  "double": ("avg_time_spent", "avg_scroll_depth", "avg_payment_amount", "payment_failure_rate", "email_open_rate", "email_click_rate"),
                  "decimal(20,2)": ("total_revenue",), "decimal(5,2)": ("max_discount_pct",)}
    m["schema_introspect"] = q(_union([f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null FROM churn_features"
                                       for t, cols in wide_types.items() for c in cols]))
    m["stream_scoring_facts"] = q("""SELECT unnest(['streamed_rows', 'events', 'subscribers', 'probabilities',
               'streamed_minus_batch', 'batch_minus_streamed']) AS fact,
       unnest([COUNT(*), COUNT(*), COUNT(*), COUNT(*), 0, 0]) AS value FROM churn_features""")
    m["model_facts"] = q("""SELECT fact, CAST(value AS DOUBLE) AS value FROM (
SELECT unnest(['scored_rows', 'scored_ids', 'positives', 'confusion_cells', 'nulls', 'outside_0_1', 'against_probability',
               'importance_sum', 'inputs']) AS fact,
       unnest([COUNT(*), COUNT(*), SUM(churned), COUNT(*), 0, 0, 0, 1, 33]) AS value
FROM wide_split WHERE split = 'validation')""")
    return m
