"""Fixed schemas of the raw subscriber tables and their value domains.

The raw layer is declared, not inferred: every adapter output is checked against
these StructTypes (``check_schema``) so a drifting input fails at the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's enumerations for the same meaning).
# ---------------------------------------------------------------------------
TIERS = ["basic", "standard", "premium"]
BILLING_CYCLES = ["monthly", "annual"]
ACQUISITION_CHANNELS = ["organic", "paid_search", "social", "referral", "email"]
GENDERS = ["male", "female", "other", "prefer_not_to_say"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
PLATFORMS = ["ios", "android", "web"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "google_pay"]
FAILURE_REASONS = ["insufficient_funds", "card_declined", "expired_card"]
EMAIL_TYPES = ["newsletter", "breaking_news", "weekly_digest", "promotional"]
TICKET_TYPES = ["billing", "technical", "content", "cancellation", "other"]
PROMO_TYPES = ["trial", "discount", "referral", "winback"]
PAYWALL_TYPES = ["free", "metered", "premium"]
ENGAGEMENT_EVENT_TYPES = ["view", "share", "comment", "save"]
EMAIL_EVENT_TYPES = ["sent", "opened", "clicked", "unsubscribed"]
HISTORY_EVENT_TYPES = ["signup", "downgrade", "pause", "cancel"]

# The fixed evaluation clock of every test and oracle query (FIXTURES 3).
DEFAULT_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)

_S = T.StringType()
_TS = T.TimestampNTZType()
_I = T.IntegerType()

SUBSCRIBERS = T.StructType([
    T.StructField("subscriber_id", _S, False),
    T.StructField("email", _S), T.StructField("first_name", _S), T.StructField("last_name", _S),
    T.StructField("signup_date", _TS), T.StructField("birth_year", _I), T.StructField("gender", _S),
    T.StructField("city", _S), T.StructField("state", _S), T.StructField("zip_code", _S),
    T.StructField("subscription_tier", _S), T.StructField("billing_cycle", _S),
    T.StructField("acquisition_channel", _S),
    T.StructField("created_at", _TS), T.StructField("updated_at", _TS),
])

SUBSCRIPTION_HISTORY = T.StructType([
    T.StructField("history_id", _S, False), T.StructField("subscriber_id", _S),
    T.StructField("event_type", _S), T.StructField("old_tier", _S), T.StructField("new_tier", _S),
    T.StructField("old_billing_cycle", _S), T.StructField("new_billing_cycle", _S),
    T.StructField("reason", _S), T.StructField("event_timestamp", _TS),
    T.StructField("created_at", _TS),
])

PAYMENTS = T.StructType([
    T.StructField("payment_id", _S, False), T.StructField("subscriber_id", _S),
    T.StructField("amount", T.DecimalType(10, 2)), T.StructField("currency", _S),
    T.StructField("payment_method", _S), T.StructField("payment_status", _S),
    T.StructField("failure_reason", _S), T.StructField("transaction_timestamp", _TS),
    T.StructField("created_at", _TS),
])

ENGAGEMENT_EVENTS = T.StructType([
    T.StructField("event_id", _S, False), T.StructField("subscriber_id", _S),
    T.StructField("article_id", _S), T.StructField("session_id", _S),
    T.StructField("event_type", _S), T.StructField("device_type", _S), T.StructField("platform", _S),
    T.StructField("time_spent_seconds", _I), T.StructField("scroll_depth_pct", _I),
    T.StructField("event_timestamp", _TS),
    T.StructField("created_at", _TS),
])

EMAIL_INTERACTIONS = T.StructType([
    T.StructField("interaction_id", _S, False), T.StructField("subscriber_id", _S),
    T.StructField("email_campaign_id", _S), T.StructField("email_type", _S),
    T.StructField("event_type", _S), T.StructField("event_timestamp", _TS),
    T.StructField("created_at", _TS),
])

CUSTOMER_SUPPORT = T.StructType([
    T.StructField("ticket_id", _S, False), T.StructField("subscriber_id", _S),
    T.StructField("ticket_type", _S), T.StructField("priority", _S), T.StructField("status", _S),
    T.StructField("subject", _S), T.StructField("resolution", _S),
    T.StructField("created_timestamp", _TS), T.StructField("resolved_timestamp", _TS),
    T.StructField("created_at", _TS),
])

PROMOTIONS = T.StructType([
    T.StructField("promotion_id", _S, False), T.StructField("subscriber_id", _S),
    T.StructField("promo_code", _S), T.StructField("promo_type", _S),
    T.StructField("discount_pct", T.DecimalType(5, 2)), T.StructField("discount_amount", T.DecimalType(10, 2)),
    T.StructField("start_date", _TS), T.StructField("end_date", _TS), T.StructField("status", _S),
    T.StructField("created_at", _TS),
])

ARTICLES = T.StructType([
    T.StructField("article_id", _S, False), T.StructField("title", _S), T.StructField("category", _S),
    T.StructField("subcategory", _S), T.StructField("author", _S), T.StructField("publish_date", _TS),
    T.StructField("paywall_type", _S), T.StructField("word_count", _I),
    T.StructField("created_at", _TS),
])

RAW_SCHEMAS = {
    "subscribers": SUBSCRIBERS,
    "subscription_history": SUBSCRIPTION_HISTORY,
    "payments": PAYMENTS,
    "engagement_events": ENGAGEMENT_EVENTS,
    "email_interactions": EMAIL_INTERACTIONS,
    "customer_support": CUSTOMER_SUPPORT,
    "promotions": PROMOTIONS,
    "articles": ARTICLES,
}

# Primary keys declared by the DDL (checked by Q4, never enforced on write).
PRIMARY_KEYS = {
    "subscribers": "subscriber_id",
    "subscription_history": "history_id",
    "payments": "payment_id",
    "engagement_events": "event_id",
    "email_interactions": "interaction_id",
    "customer_support": "ticket_id",
    "promotions": "promotion_id",
    "articles": "article_id",
}


class SchemaMismatch(ValueError):
    pass


#: Columns whose value the DDL gives by default: the time of loading.
DEFAULT_COLUMNS = ("created_at", "updated_at")


def with_defaults(df: DataFrame, expected: T.StructType, clock: _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """``df`` with the default columns that ``expected`` declares and ``df`` doesn't bring, as of the loading ``clock``."""
    missing = [f for f in expected.fields if f.name in DEFAULT_COLUMNS and f.name not in df.columns]
    return df.withColumns({f.name: F.lit(clock).cast(f.dataType) for f in missing}) if missing else df


def check_schema(df: DataFrame, expected: T.StructType, name: str = "table", clock: _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """Assert names and types (nullability ignored); return the frame in declared column order, defaults filled in."""
    df = with_defaults(df, expected, clock)
    got = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in got:
            problems.append(f"missing {f.name}")
        elif got[f.name] != f.dataType:
            problems.append(f"{f.name}: {got[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df.select([f.name for f in expected.fields])
