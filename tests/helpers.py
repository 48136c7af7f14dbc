"""Constants and hand-made raw tables that the tests share (a name of its own: several folders hold a conftest)."""

from __future__ import annotations

import datetime as dt
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def make_raw(spark, name: str, rows: list[dict]):
    """A raw table with its declared schema; columns a fixture omits are NULL."""
    from churnlens.sources.schemas import RAW_SCHEMAS
    schema = RAW_SCHEMAS[name]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def sub(i: str, tier="basic", cycle="monthly", channel="organic", signup=dt.datetime(2023, 6, 1), birth=1990):
    return {"subscriber_id": i, "subscription_tier": tier, "billing_cycle": cycle, "acquisition_channel": channel,
            "signup_date": signup, "birth_year": birth, "email": f"{i}@example.com", "first_name": i}


def fixture_catalog(spark, subscribers=None, **tables):
    """Catalog over hand-made raw tables (all eight present, empty unless given)."""
    from churnlens.sources.catalog import Catalog
    frames = {"subscribers": make_raw(spark, "subscribers", subscribers or [])}
    for name in ("subscription_history", "payments", "engagement_events", "email_interactions",
                 "customer_support", "promotions", "articles"):
        frames[name] = make_raw(spark, name, tables.get(name, []))
    return Catalog.from_frames(spark, frames)
