"""Exact order statistics and positions without a single-task buffer (A23 median, Q12 high-value filter, W3 pages).

``F.median`` / ``percentile`` keep every distinct value of a group in one aggregation buffer, and a global
``row_number`` sorts everything in one task. Here rows are range-partitioned by the sort key and stored once
with the number of their range, so every later step sees the same ranges; the ranges' row counts (one row a range)
are summed up in a small frame, and that frame is joined. Nothing but one-row results reaches the driver, and
the plan doesn't grow with the number of ranges.

The quantile interpolates between the two middle ranks like ``median`` in pandas, DuckDB and Spark
(``percentile`` with linear interpolation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialize


def with_ranges(df: DataFrame, keys: list[Column], weight: Column, partitions: int | None = None) -> DataFrame:
    """``df`` stored once with ``_range`` (its range of the sort key) and ``_before`` (summed weight of all ranges before)."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()))
    totals = rows.groupBy("_range").agg(F.sum(weight).alias("_n"))
    # one row a range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(totals.select("_range", before.cast("long").alias("_before")), "_range")


def positions(df: DataFrame, keys: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` with ``row_number`` over the whole frame in the order of ``keys``."""
    ranged = with_ranges(df, keys, F.lit(1), partitions)
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return ranged.withColumn("row_number", F.col("_before") + own.cast("long")).drop("_range", "_before")


def group_positions(df: DataFrame, group: list[str], keys: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` with ``position`` (from 0, in its group, by ``keys``) and ``group_size``; a group may span any number of ranges."""
    order = [*[F.col(g) for g in group], *keys]
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = materialize(dealt.withColumn("_range", F.spark_partition_id()))
    counts = rows.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_range", *group, before.alias("_before"), F.sum("_n").over(own).alias("group_size"))
    at = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*keys)) - 1
    return rows.withColumn("_at", at).join(starts, ["_range", *group]).withColumn("position", F.col("_before") + F.col("_at")) \
        .drop("_range", "_before", "_at")


def quantile(df: DataFrame, col: str, q: float = 0.5, partitions: int | None = None, name: str = "quantile") -> DataFrame:
    """One-row frame with the exact quantile of ``col`` (NULL for no rows, NULLs skipped).

    Values are first reduced to (value, count) pairs, so a value held by a third of all rows is one pair.
    """
    pairs = (df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
             .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    ranged = with_ranges(pairs, [F.col("v")], F.col("c"), partitions)
    upto = F.sum("c").over(Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    held = ranged.select("v", upto.alias("_to"), (upto - F.col("c")).alias("_from"))
    place = held.agg(((F.max("_to") - 1) * q).alias("place")).select(
        "place", F.floor("place").alias("low"), F.ceil("place").alias("high"))
    at = lambda rank: F.max(F.when((F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_to")), F.col("v")))
    found = held.crossJoin(F.broadcast(place)).agg(at("low").alias("a"), at("high").alias("b"), F.max(F.col("place") - F.col("low")).alias("f"))   # one-row side
    return found.select((F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias(name))


def exact_quantile_value(df: DataFrame, col: str, q: float = 0.5, partitions: int | None = None) -> float | None:
    """The exact quantile as a number."""
    return quantile(df, col, q, partitions).first()[0]


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with the exact median of ``col`` (NULL for no rows)."""
    return quantile(df, col, 0.5, name="median")
