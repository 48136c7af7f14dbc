"""A per-run bundle of the lazy frames most queries share (raw tables, views, wide table, predictions).

Frames are built on first use and stay lazy DataFrames; nothing here triggers a job.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..sources.catalog import Catalog
from ..sources.schemas import DEFAULT_AS_OF


class Workspace:
    def __init__(self, spark: SparkSession, root: str, as_of: _dt.datetime = DEFAULT_AS_OF,
                 catalog: Catalog | None = None, materialize: bool = False):
        self.spark = spark
        self.root = root
        self.as_of = as_of
        self.cat = catalog or Catalog(spark, root, as_of)
        self.materialize = materialize

    @cached_property
    def _store(self) -> dict:
        from .feature_store import store
        return store(self)

    @cached_property
    def subscribers(self) -> DataFrame:
        """The subscriber dimension for joins: the bucketed store copy when materialized."""
        return self._store["subscribers"] if self.materialize else self.cat.subscribers

    @cached_property
    def data_version(self) -> str:
        """A key of the data, the clock and the definitions: names what is stored about them."""
        from .feature_store import default_buckets, store_key
        return store_key(self.spark, self.cat, self.as_of, default_buckets(self.spark, self.cat))

    def lookup(self, ids) -> DataFrame:
        """Wide rows of ids in any case, a short list or a frame with a column ``id``, by the store's index."""
        from .feature_store import lookup
        return lookup(self._store, ids)

    @cached_property
    def views(self) -> dict[str, DataFrame]:
        """The five feature views: lazy plans, or the bucketed feature-store tables."""
        if self.materialize:
            return self._store["views"]
        return FE.view_frames(self.cat)

    @cached_property
    def spine(self) -> DataFrame:
        return FE.spine(self.cat, self.as_of)

    @cached_property
    def wide(self) -> DataFrame:
        """CHURN_FEATURES: spine + five views, numeric gaps 0."""
        if self.materialize:
            return self._store["wide"]
        return FE.churn_features(self.cat, self.as_of, self.views)

    @cached_property
    def predictions(self) -> DataFrame:
        """Rule-based CHURN_PREDICTIONS (deterministic, SQL-checkable)."""
        return FE.rule_predictions(self.wide, self.as_of)

    @property
    def payment_view(self) -> DataFrame:
        return self.views["payment"]
