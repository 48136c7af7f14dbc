"""Keep the engagement feature view fresh from new event files only.

The view's state is a table published by manifests (``sources.versions``), dealt by a hash of the subscriber into a fixed
number of buckets:

- ``rows/bucket=i``: one row a subscriber with the additive sums and the three distinct counts;
- ``pairs/bucket=i``: the (subscriber, feature, value) pairs seen so far, which tell a new value from a known one.

A micro-batch touches the buckets of its subscribers. Its distinct pairs are anti-joined with those buckets' pairs; what is new is
appended and counted, and the buckets' rows are rewritten with the batch's sums added. One manifest publishes all of it together
with the batch's number, so a batch that is run again after a crash changes nothing, and a reader never sees half a batch. A
batch reads and writes its buckets, never the log; reading the view reads the rows, one a subscriber, no aggregation.

Appended pairs make a bucket's list of folders longer; past ``MAX_FOLDERS`` the batch that touches the bucket folds them into one.
A subscriber holding a third of the events costs one row a task: sums are combined before the shuffle, pairs spread by value.

Defined results: an event without a subscriber changes nothing; NULL values aren't counted as distinct; NULL numbers
are left out of means; an empty batch publishes its number only; duplicate events count twice, as in the batch view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import count_when
from ..session import scratch_path
from ..sources.schemas import ENGAGEMENT_EVENTS
from ..sources.versions import Manifest, VersionedTable

KEY = "subscriber_id"
DISTINCT_COLS = {"unique_articles": "article_id", "total_sessions": "session_id", "device_diversity": "device_type"}
ADDITIVE = ("n", "sum_time", "n_time", "sum_scroll", "n_scroll", "views", "shares", "comments")

#: Buckets of the state, and folders of pairs a bucket holds before they are folded.
BUCKETS, MAX_FOLDERS = 32, 8

PAIRS = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("feature", T.StringType()), T.StructField("value", T.StringType())])
ROWS = T.StructType([T.StructField(KEY, T.StringType()), *[T.StructField(c, T.LongType()) for c in (*ADDITIVE, *DISTINCT_COLS)],
                     T.StructField("last_ts", T.TimestampNTZType())])


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def batch_partials(batch: DataFrame) -> DataFrame:
    """The additive part of a batch, one row a subscriber."""
    et = F.col("event_type")
    return batch.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("time_spent_seconds"), F.lit(0)).cast("long").alias("sum_time"), F.count("time_spent_seconds").alias("n_time"),
        F.coalesce(F.sum("scroll_depth_pct"), F.lit(0)).cast("long").alias("sum_scroll"), F.count("scroll_depth_pct").alias("n_scroll"),
        count_when(et == "view").alias("views"), count_when(et == "share").alias("shares"),
        count_when(et == "comment").alias("comments"), F.max("event_timestamp").alias("last_ts"))


def batch_pairs(batch: DataFrame) -> DataFrame:
    """The distinct (subscriber, feature, value) pairs of a batch."""
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(c).cast("string").alias("value")) for f, c in DISTINCT_COLS.items()])
    return batch.select(KEY, F.explode(each).alias("p")).select(KEY, "p.feature", "p.value").where("value is not null").distinct()


def apply_batch(table: VersionedTable, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> Manifest:
    """Publish the state with one more batch; a batch number that is in already changes nothing."""
    base = table.latest()
    if base is not None:
        if batch_id <= base.info["batch_id"]:
            return base
        buckets = base.info["buckets"]   # fixed when the state began
    info = {"batch_id": batch_id, "buckets": buckets}
    batch = batch.where(F.col(KEY).isNotNull())
    batch.persist()   # two aggregates and the list of buckets read it
    try:
        touched = [r[0] for r in batch.select(bucket(buckets).alias("b")).distinct().collect()]   # at most ``buckets`` numbers
        if not touched:
            return table.commit(base, {}, info)
        names = {b: (f"rows/bucket={b:05d}", f"pairs/bucket={b:05d}") for b in touched}

        def held(kind: int, schema: T.StructType) -> DataFrame:
            paths = [p for b in touched for p in (table.folders(base, names[b][kind]) if base else [])]
            return table.spark.read.schema(schema).parquet(*paths) if paths else table.spark.createDataFrame([], schema)

        known = held(1, PAIRS)
        fresh_folder = table.write_partitioned(batch_pairs(batch).join(known, PAIRS.names, "left_anti"), bucket(buckets))
        fresh = table.spark.read.schema(PAIRS).parquet(f"{table.root}/{fresh_folder}")
        counts = fresh.groupBy(KEY).agg(*[count_when(F.col("feature") == f).alias(f) for f in DISTINCT_COLS])
        added = held(0, ROWS).unionByName(batch_partials(batch), allowMissingColumns=True).unionByName(counts, allowMissingColumns=True)
        rows = added.groupBy(KEY).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in (*ADDITIVE, *DISTINCT_COLS)],
                                      F.max("last_ts").alias("last_ts"))
        rows_folder = table.write_partitioned(rows, bucket(buckets))
    finally:
        batch.unpersist()

    parts: dict[str, list[str]] = {}
    with_pairs = table.partitions(fresh_folder)
    for b in touched:
        row_part, pair_part = names[b]
        parts[row_part] = [f"{rows_folder}/bucket={b}"]
        if b in with_pairs:
            parts[pair_part] = [*(base.parts.get(pair_part, []) if base else []), f"{fresh_folder}/bucket={b}"]
    long = [b for b in touched if len(parts.get(names[b][1], [])) > MAX_FOLDERS]
    if long:
        every = table.spark.read.schema(PAIRS).parquet(*[f"{table.root}/{f}" for b in long for f in parts[names[b][1]]])
        folded = table.write_partitioned(every, bucket(buckets))
        parts.update({names[b][1]: [f"{folded}/bucket={b}"] for b in long})
    return table.commit(base, parts, info)


def view_table(spark: SparkSession, state_dir: str) -> VersionedTable:
    return VersionedTable(spark, state_dir)


def read_view(spark: SparkSession, state_dir: str, version: int | None = None) -> DataFrame:
    """The engagement view of the latest (or a named) version: one stored row a subscriber."""
    table = view_table(spark, state_dir)
    rows = table.read(table.latest() if version is None else table.at(version), ROWS, "rows/")
    mean = lambda total, n: F.try_divide(F.col(total).cast("double"), F.col(n))
    return rows.select(
        KEY, F.col("n").alias("total_engagements"), "unique_articles", "total_sessions", mean("sum_time", "n_time").alias("avg_time_spent"),
        mean("sum_scroll", "n_scroll").alias("avg_scroll_depth"), F.col("views").alias("total_views"), F.col("shares").alias("total_shares"),
        F.col("comments").alias("total_comments"), "device_diversity", F.col("last_ts").alias("last_engagement_date"))


def run_incremental(spark: SparkSession, source_dir: str, run_id: str, max_files_per_trigger: int | None = 1,
                    buckets: int = BUCKETS) -> DataFrame:
    """Process every new event file in ``source_dir`` (availableNow), one file per micro-batch; returns the view.

    Run again with the same ``run_id``, it goes on where it stopped, after a crash too.
    """
    state_dir = scratch_path(spark, "streams", run_id, "engagement_state")
    ckpt = scratch_path(spark, "streams", run_id, "engagement_ckpt")
    table = view_table(spark, state_dir)
    reader = spark.readStream.schema(ENGAGEMENT_EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source_dir).writeStream.foreachBatch(lambda batch, i: apply_batch(table, batch, i, buckets) and None)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_view(spark, state_dir)
