"""Raw subscriber tables projected from the driver's star-schema tables (FIXTURES 3).

Every adapter is a pure column projection (plus one key join for e-mail and
promotions), so Catalyst prunes the driver columns it does not need and pushes
filters into the Parquet scans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import schemas as S


def pick(index: Column, values: list[str]) -> Column:
    """values[index mod n] as a JVM-side expression (no UDF)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def _ts(value: _dt.datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def subscribers(customer: DataFrame) -> DataFrame:
    c = customer
    seg = F.col("c_mktsegment")
    df = c.select(
        F.col("c_custkey").cast("string").alias("subscriber_id"),
        F.concat(F.lit("subscriber"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("c_custkey", F.lit(365)).cast("int"))
        .cast("timestamp_ntz").alias("signup_date"),
        (F.lit(1950) + F.lit(2) * F.col("c_nationkey")).cast("int").alias("birth_year"),
        pick(F.col("c_custkey"), S.GENDERS).alias("gender"),
        F.concat(F.lit("city_"), F.col("c_nationkey").cast("string")).alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("zip_code"),
        F.when(seg.isin("BUILDING", "MACHINERY"), "basic")
        .when(seg.isin("FURNITURE", "HOUSEHOLD"), "standard")
        .otherwise("premium").alias("subscription_tier"),
        F.when(F.col("c_acctbal") < 5000, "monthly").otherwise("annual").alias("billing_cycle"),
        pick(F.col("c_nationkey"), S.ACQUISITION_CHANNELS).alias("acquisition_channel"),
    )
    return S.check_schema(df, S.SUBSCRIBERS, "subscribers")


def subscription_history(orders: DataFrame) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    prio = F.col("o_orderpriority")
    etype = (F.when(pending & (prio == "1-URGENT"), "cancel")
             .when(pending & (prio == "2-HIGH"), "pause")
             .when(pending, "downgrade")
             .otherwise("signup"))
    df = orders.select(
        F.col("o_orderkey").cast("string").alias("history_id"),
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        etype.alias("event_type"),
        F.lit(None).cast("string").alias("old_tier"),
        F.lit(None).cast("string").alias("new_tier"),
        F.lit(None).cast("string").alias("old_billing_cycle"),
        F.lit(None).cast("string").alias("new_billing_cycle"),
        F.when(etype == "cancel", "too_expensive").when(etype == "pause", "vacation")
        .when(etype == "downgrade", "cost").otherwise("new_subscription").alias("reason"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_timestamp"),
    )
    return S.check_schema(df, S.SUBSCRIPTION_HISTORY, "subscription_history")


def payments(orders: DataFrame) -> DataFrame:
    failed = F.col("o_orderstatus") == "P"
    df = orders.select(
        F.col("o_orderkey").cast("string").alias("payment_id"),
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        # no division before the cast: the engines round ties differently (FIXTURES 3)
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        pick(F.col("o_orderkey"), S.PAYMENT_METHODS).alias("payment_method"),
        F.when(failed, "failed").otherwise("success").alias("payment_status"),
        F.when(failed, pick(F.col("o_orderkey"), S.FAILURE_REASONS)).alias("failure_reason"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("transaction_timestamp"),
    )
    return S.check_schema(df, S.PAYMENTS, "payments")


def engagement_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    df = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("subscriber_id"),
        k.cast("string").alias("article_id"),
        F.floor(F.col("event_id") / 4).cast("string").alias("session_id"),
        F.when(et == "view", "view").when(et == "click", "share")
        .when(et == "purchase", "comment").otherwise("save").alias("event_type"),
        pick(F.col("event_id"), S.DEVICE_TYPES).alias("device_type"),
        pick(F.col("user_id"), S.PLATFORMS).alias("platform"),
        F.floor("value").cast("int").alias("time_spent_seconds"),
        k.alias("scroll_depth_pct"),
        F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
    )
    return S.check_schema(df, S.ENGAGEMENT_EVENTS, "engagement_events")


def email_interactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(o, "l_orderkey")
    rf = F.col("l_returnflag")
    df = j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("interaction_id"),
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        F.concat(F.lit("campaign_"), F.pmod("l_partkey", F.lit(50)).cast("string")).alias("email_campaign_id"),
        pick(F.col("l_partkey"), S.EMAIL_TYPES).alias("email_type"),
        F.when(F.col("l_linenumber") == 7, "unsubscribed").when(rf == "N", "sent")
        .when(rf == "A", "opened").when(rf == "R", "clicked").alias("event_type"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("event_timestamp"),
    )
    return S.check_schema(df, S.EMAIL_INTERACTIONS, "email_interactions")


def customer_support(orders: DataFrame) -> DataFrame:
    prio = F.col("o_orderpriority")
    o = orders.filter(prio.isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
    status = (F.when(F.col("o_orderstatus") == "O", "open")
              .when(F.col("o_orderstatus") == "P", "resolved").otherwise("closed"))
    is_open = F.col("o_orderstatus") == "O"
    ttype = pick(F.col("o_orderkey"), S.TICKET_TYPES)
    created = F.col("o_orderdate").cast("timestamp_ntz")
    df = o.select(
        F.col("o_orderkey").cast("string").alias("ticket_id"),
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        ttype.alias("ticket_type"),
        F.when(prio == "1-URGENT", "high").when(prio == "2-HIGH", "medium").otherwise("low").alias("priority"),
        status.alias("status"),
        F.concat(ttype, F.lit(" request")).alias("subject"),
        F.when(~is_open, F.lit("resolved by agent")).alias("resolution"),
        created.alias("created_timestamp"),
        F.when(~is_open, F.timestamp_add("HOUR", F.pmod("o_orderkey", F.lit(72)) + 1, created))
        .alias("resolved_timestamp"),
    )
    return S.check_schema(df, S.CUSTOMER_SUPPORT, "customer_support")


def promotions(lineitem: DataFrame, orders: DataFrame, as_of: _dt.datetime) -> DataFrame:
    li = lineitem.filter(F.col("l_linenumber") == 1).select("l_orderkey", "l_suppkey", "l_discount")
    o = orders.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(o, "l_orderkey")
    ptype = pick(F.col("l_suppkey"), S.PROMO_TYPES)
    start = F.col("o_orderdate").cast("timestamp_ntz")
    end = F.timestamp_add("DAY", F.lit(30), start)
    df = j.select(
        F.col("l_orderkey").cast("string").alias("promotion_id"),
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        F.concat(F.upper(ptype), F.col("l_orderkey").cast("string")).alias("promo_code"),
        ptype.alias("promo_type"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
        F.lit(None).cast("decimal(10,2)").alias("discount_amount"),
        start.alias("start_date"),
        end.alias("end_date"),
        # Q21: expired once the end date has passed the evaluation clock
        F.when(end < _ts(as_of), "expired").otherwise("active").alias("status"),
    )
    return S.check_schema(df, S.PROMOTIONS, "promotions")


def articles(part: DataFrame) -> DataFrame:
    df = part.select(
        F.col("p_partkey").cast("string").alias("article_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("subcategory"),
        F.concat(F.lit("author_"), F.pmod("p_partkey", F.lit(100)).cast("string")).alias("author"),
        F.date_add(F.lit("2022-01-01").cast("date"), F.pmod("p_partkey", F.lit(700)).cast("int"))
        .cast("timestamp_ntz").alias("publish_date"),
        pick(F.col("p_partkey"), S.PAYWALL_TYPES).alias("paywall_type"),
        F.col("p_size").cast("int").alias("word_count"),
    )
    return S.check_schema(df, S.ARTICLES, "articles")
