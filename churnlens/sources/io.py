"""Sources and sinks.

Written intermediate tables go under the shared checkpoint folder
(``spark.checkpoint.dir``); lineage is cut with a reliable ``checkpoint()`` or a
written Parquet table, never with a machine-local folder.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, path_exists, scratch_path
from .versions import VersionedTable


def sql_query(spark: SparkSession, views: dict[str, DataFrame], text: str, args: dict | None = None) -> DataFrame:
    """S2 + S7: register frames as temp views, run SQL with values bound through ``args``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or {})


def create_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """S3: small local rows -> DataFrame (parameter tables, run records only)."""
    return spark.createDataFrame(rows, schema)


def sink_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S4."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_append(df: DataFrame, path: str) -> None:
    """Append, created if missing."""
    df.write.mode("append").parquet(path)


def write_and_read(spark: SparkSession, df: DataFrame, name: str, version: str | None = None) -> DataFrame:
    """Write once into a new version directory under the shared folder, read it back.

    ``errorifexists`` keeps a written version immutable (write once, read many).
    """
    version = version or f"v{_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%d%H%M%S')}-{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name, version)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Pin a plan's rows so later reads agree -- a reliable checkpoint in the shared folder.

    (cache() alone can recompute after eviction or executor loss; localCheckpoint is lost
    with its executor.)
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bulk_load(spark: SparkSession, frames: dict[str, DataFrame], root: str,
              partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Drop helper columns (leading underscore), NaN -> NULL for doubles, overwrite each table.

    ``partition_by`` optionally names partition columns per table (e.g. an event date), so
    time-bounded reads prune whole directories.
    """
    out = {}
    partition_by = partition_by or {}
    for name, df in frames.items():
        keep = [c for c in df.columns if not c.startswith("_")]
        cols = []
        for f in df.select(keep).schema.fields:
            if f.dataType.typeName() in ("double", "float"):
                cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
            else:
                cols.append(F.col(f.name))
        path = os.path.join(root, name)
        w = df.select(cols).write.mode("overwrite")
        if partition_by.get(name):
            w = w.partitionBy(*partition_by[name])
        w.parquet(path)
        out[name] = path
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header; callers pass a limited frame, so one output file is fine."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_csv_and_read(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name, uuid.uuid4().hex[:12])
    export_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one union of one-row aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).select("table_name", "row_count")


RUN_METRICS = ("accuracy", "precision", "recall", "f1_score")


def runs_path(spark: SparkSession, dataset: str) -> str:
    """The stored table of experiment runs on one data version."""
    return scratch_path(spark, "registry", "experiment_runs", dataset)


def append_runs(df: DataFrame, path: str) -> None:
    """Append runs to the stored table, created if missing; a run (name and time) that is in already is not added again."""
    spark = df.sparkSession
    rows = df.select("run_name", F.col("n_estimators").cast("int"), F.col("max_depth").cast("int"),
                     *[F.col(c).cast("double") for c in ("learning_rate", *RUN_METRICS)], F.col("run_timestamp").cast("timestamp_ntz"))
    if path_exists(spark, f"{path}/_SUCCESS"):
        rows = rows.join(spark.read.parquet(path), ["run_name", "run_timestamp"], "left_anti").select(rows.columns)
    rows.write.mode("append").parquet(path)


def newest_runs(spark: SparkSession, path: str, n: int = 50, prefix: str = "") -> DataFrame:
    """The newest ``n`` stored runs, of those whose name begins with ``prefix``."""
    return spark.read.parquet(path).where(F.col("run_name").startswith(prefix)).orderBy(F.desc("run_timestamp"), "run_name").limit(n)


# ---------------------------------------------------------------------------
# Registries stored as Parquet tables: model versions (S13), feature views
# ---------------------------------------------------------------------------

def registry_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "registry", name)


def register_view(spark: SparkSession, fv, frame: DataFrame, root: str, refresh: bool = False) -> DataFrame:
    """Get-or-create a versioned feature view at ``root/<name>/<version>``, hash-partitioned on the entity key
    when written; ``refresh`` recomputes it and publishes the result as the next version of the stored table
    (``sources.versions``): frames read before keep their rows, readers in between see one version or the other.
    The bucketed, join-aligned form used by the queries is ``plans.feature_store``.
    """
    table = VersionedTable(spark, os.path.join(root, fv.name.lower(), fv.version.lower()))
    dealt = frame.repartition(*fv.entity.join_keys)
    found = table.publish(dealt) if refresh else table.get_or_create(lambda: table.write(dealt))
    return table.read(found, frame.schema)


def feature_view_list(spark: SparkSession, views: dict) -> DataFrame:
    """Name, version, entity, description, refresh of each view definition."""
    rows = [(fv.name, fv.version, fv.entity.name, fv.description, fv.refresh) for fv in views.values()]
    return spark.createDataFrame(rows, "name string, version string, entity string, description string, "
                                       "refresh string")
