"""S1 scan_table: the catalogue of driver tables and the raw subscriber layer on top.

``Catalog`` is lazy: nothing is read until a query asks for a table, and each
table is a plain DataFrame so Catalyst sees through the whole adapter chain.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from . import adapters
from .schemas import DEFAULT_AS_OF

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def scan_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one driver table; a directory of part files or a single ``<name>.parquet``."""
    from ..session import path_exists
    base = root.rstrip("/")
    path = f"{base}/{name}.parquet"
    if not path_exists(spark, path) and path_exists(spark, f"{base}/{name}"):
        path = f"{base}/{name}"
    return spark.read.parquet(path)


class Catalog:
    """Driver tables at ``root`` plus the eight raw subscriber tables derived from them."""

    # driver tables the raw layer is projected from (the data-version fingerprint covers them)
    SOURCE_TABLES = ("customer", "orders", "lineitem", "events", "part")

    def __init__(self, spark: SparkSession, root: str, as_of: _dt.datetime = DEFAULT_AS_OF):
        self.spark = spark
        self.root = root
        self.as_of = as_of
        base = root.rstrip("/")
        self.source_paths = [f"{base}/{t}.parquet" for t in self.SOURCE_TABLES] if root else []
        self.subscriber_path = f"{base}/customer.parquet" if root else None

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame],
                    as_of: _dt.datetime = DEFAULT_AS_OF) -> "Catalog":
        """A catalog over given raw tables (hand fixtures, or tables already stored elsewhere)."""
        cat = cls(spark, root="", as_of=as_of)
        for name, df in frames.items():
            cat.__dict__[name] = df  # pre-fills the cached property
        return cat  # no source paths: a feature store over it is never reused

    @classmethod
    def from_stored(cls, spark: SparkSession, root: str,
                    as_of: _dt.datetime = DEFAULT_AS_OF) -> "Catalog":
        """The raw tables as stored Parquet tables at ``root/<name>``, read with their declared
        schema (no inference) and checked.  Filters on enum columns then reach the scan as pushed
        Parquet filters, and date-partitioned tables prune partitions."""
        from .schemas import RAW_SCHEMAS, check_schema
        frames = {}
        for name, schema in RAW_SCHEMAS.items():
            df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
            frames[name] = check_schema(df, schema, name)
        cat = cls.from_frames(spark, frames, as_of)
        cat.root = root
        cat.source_paths = [f"{root.rstrip('/')}/{name}" for name in RAW_SCHEMAS]
        cat.subscriber_path = f"{root.rstrip('/')}/subscribers"
        return cat

    def driver(self, name: str) -> DataFrame:
        return scan_table(self.spark, self.root, name)

    # -- raw layer (FIXTURES 3) -------------------------------------------------
    @cached_property
    def subscribers(self) -> DataFrame:
        return adapters.subscribers(self.driver("customer"))

    @cached_property
    def subscriber_count(self) -> int:
        return self.subscribers.count()

    @cached_property
    def subscription_history(self) -> DataFrame:
        return adapters.subscription_history(self.driver("orders"))

    @cached_property
    def payments(self) -> DataFrame:
        return adapters.payments(self.driver("orders"))

    @cached_property
    def engagement_events(self) -> DataFrame:
        return adapters.engagement_events(self.driver("events"))

    @cached_property
    def email_interactions(self) -> DataFrame:
        return adapters.email_interactions(self.driver("lineitem"), self.driver("orders"))

    @cached_property
    def customer_support(self) -> DataFrame:
        return adapters.customer_support(self.driver("orders"))

    @cached_property
    def promotions(self) -> DataFrame:
        return adapters.promotions(self.driver("lineitem"), self.driver("orders"), self.as_of)

    @cached_property
    def articles(self) -> DataFrame:
        return adapters.articles(self.driver("part"))

    def raw(self, name: str) -> DataFrame:
        return getattr(self, name)

    RAW_TABLES = ("subscribers", "subscription_history", "payments", "engagement_events",
                  "email_interactions", "customer_support", "promotions", "articles")
