"""Data-quality gates (A16-A21, J10, Q4, P19 split).

Each gate is one aggregate job over the whole table (no per-column action loops):
columns are unpivoted to (column, value) rows and aggregated together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_ratio, split_bucket, split_name

KEY = "subscriber_id"


class CoverageError(ValueError):
    pass


def view_counts(subscribers: DataFrame, views: dict[str, DataFrame]) -> DataFrame:
    """S12-style row counts of each view next to the subscriber count (one union, one job)."""
    parts = [subscribers.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit("subscribers"))]
    parts += [v.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(k)) for k, v in views.items()]
    return reduce(DataFrame.unionByName, parts)


def coverage_check(subscribers: DataFrame, views: dict[str, DataFrame],
                   required=("engagement", "payment"), min_share: float = 0.9) -> DataFrame:
    """Per view rows, share of subscribers, required flag, pass/fail.

    A required view below ``min_share`` of the subscriber count fails the gate.
    """
    counts = view_counts(subscribers, views)
    subs = counts.filter(F.col("name") == "subscribers").select(F.col("rows").alias("subscribers"))
    v = counts.filter(F.col("name") != "subscribers")
    req = F.col("name").isin(*required)
    return (v.crossJoin(subs)  # one-row right side
            .select(F.col("name").alias("view"), "rows", "subscribers",
                    round_ratio(F.col("rows") / F.col("subscribers")).alias("coverage"),
                    req.cast("int").alias("required"),
                    F.when(req & (F.col("rows") < F.col("subscribers") * min_share), "fail")
                    .otherwise("pass").alias("status")))


def assert_coverage(result: DataFrame) -> None:
    """Raise when any required view fails (the reference's hard gate); one small collect of <= 5 rows."""
    bad = [r["view"] for r in result.filter(F.col("status") == "fail").select("view").collect()]
    if bad:
        raise CoverageError(f"feature views below coverage: {', '.join(sorted(bad))}")


def with_split(df: DataFrame, key: str = KEY) -> DataFrame:
    """Bucket 0..99 from an md5 prefix of the id, then 60/20/20 train/validation/test."""
    return df.withColumn("bucket", split_bucket(key)).withColumn("split", split_name(F.col("bucket")))


def split_quality(df_with_split: DataFrame, label: str = "churned") -> DataFrame:
    """Rows and churn rate per split, one job."""
    return df_with_split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        round_ratio(F.avg(F.col(label).cast("double"))).alias("churn_rate"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count per column, only columns with at least one NULL; one aggregate + unpivot."""
    cols = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "null_count")
    return long.filter(F.col("null_count") > 0)


def _category_long(df: DataFrame, categorical: list[str]) -> DataFrame:
    # stack() keeps (column, value) pairs; all categoricals are strings
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in categorical
    ])).alias("kv")).select("kv.column_name", "kv.value")


def category_values(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Distinct values per categorical column, sorted, as a list and a count.

    Distinct (column, value) pairs are aggregated first, so collect_set sees at most the
    number of distinct values per column, never the row count.
    """
    pairs = _category_long(df, categorical).filter(F.col("value").isNotNull()).distinct()
    return pairs.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.array_join(F.array_sort(F.collect_list("value")), ",").alias("values"))


def unseen_categories(train: DataFrame, other: DataFrame, categorical: list[str]) -> DataFrame:
    """Category values present in ``other`` but absent from ``train``, per column (left anti)."""
    a = _category_long(train, categorical).filter(F.col("value").isNotNull()).distinct()
    b = _category_long(other, categorical).filter(F.col("value").isNotNull()).distinct()
    return b.join(a, ["column_name", "value"], "left_anti")


def prediction_nulls(pred: DataFrame, col: str = "predicted_churn") -> DataFrame:
    """NULL predictions vs total."""
    return pred.agg(F.count_if(F.col(col).isNull()).alias("null_predictions"),
                    F.count(F.lit(1)).alias("total"))


def degenerate_check(pred: DataFrame, col: str = "predicted_churn") -> DataFrame:
    """Does the model predict one class only; share of positives."""
    return pred.agg(
        F.countDistinct(col).alias("distinct_predictions"),
        round_ratio(F.avg(F.col(col).cast("double"))).alias("positive_share"),
    ).withColumn("single_class", (F.col("distinct_predictions") <= 1).cast("int"))


def key_check(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """Q4: per table rows, NULL keys and keys that occur more than once.

    The keys of all tables are one column beside the table's name, counted by one groupBy (map-side partial counts, a hot
    duplicated key costs one row per task) and summed by a second one over tables: two shuffles, whatever the number of tables.
    A table without rows counts 0.
    """
    rows = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("table_name"), F.col(keys[name]).cast("string").alias("_k")) for name, df in tables.items()])
    per_key = rows.groupBy("table_name", "_k").agg(F.count(F.lit(1)).alias("_n"))
    counted = per_key.groupBy("table_name").agg(
        F.sum("_n").alias("rows"), F.sum(F.when(F.col("_k").isNull(), F.col("_n"))).alias("null_keys"),
        F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).alias("duplicate_keys"))
    names = rows.sparkSession.createDataFrame([(n, keys[n]) for n in tables], "table_name string, key_column string")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return F.broadcast(names).join(counted, "table_name", "left").select(   # one row a table
        zero("rows"), zero("null_keys"), zero("duplicate_keys"), "table_name", "key_column")
