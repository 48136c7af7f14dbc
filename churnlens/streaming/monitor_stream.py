"""T1 streaming form: daily model-quality windows with a watermark, every window published.

The counts kept per window (volume, tp, fp, fn, correct, predicted positives) are additive, so the state per
window is a handful of longs regardless of traffic; ratios are derived after the stream, with the batch
definition (``monitor.finish_daily``). The query runs in update mode: each micro-batch hands over the windows
it changed, and ``foreachBatch`` writes them under its batch id, so a retried batch replaces its own output and
open windows are published like closed ones. A day's counts are those of the last batch that changed it.
Rows later than the watermark are dropped by the engine and counted by a listener over all progress events.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.monitor import daily_metric_columns, finish_daily
from ..session import path_exists, scratch_path

SOURCE_SCHEMA = "id string, timestamp timestamp_ntz, prediction long, actual long"


def daily_window_counts(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Watermarked one-day tumbling windows of additive counts (``withWatermark`` needs a zoned timestamp)."""
    s = stream.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return (s.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", "1 day").alias("w"))
            .agg(*daily_metric_columns())
            .withColumn("day", F.col("w.start").cast("date").cast("string")).drop("w"))


class DroppedRows(StreamingQueryListener):
    """Adds up the rows that all state operators of one query dropped for being late."""

    def __init__(self) -> None:
        self.rows, self.batches, self.ended = 0, 0, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += sum(int(op.numRowsDroppedByWatermark) for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def run_monitor_stream(spark: SparkSession, source_dir: str, run_id: str, delay: str = "1 day",
                       max_files_per_trigger: int | None = None) -> tuple[DataFrame, dict]:
    """Run the monitor over all files now in ``source_dir`` (availableNow); return every window + progress."""
    reader = spark.readStream.schema(SOURCE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = daily_window_counts(reader.parquet(source_dir), delay)
    out_dir = scratch_path(spark, "streams", run_id, "monitor_out")
    ckpt = scratch_path(spark, "streams", run_id, "monitor_ckpt")
    schema = counts.schema

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    dropped = DroppedRows()
    spark.streams.addListener(dropped)
    try:
        q = (counts.writeStream.outputMode("update").foreachBatch(publish)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        dropped.ended.wait(60)
    finally:
        spark.streams.removeListener(dropped)
    progress = {"batches": dropped.batches, "rows_dropped_by_watermark": dropped.rows}
    if not path_exists(spark, out_dir):
        return finish_daily(spark.createDataFrame([], schema)), progress
    fields = [f.name for f in schema.fields if f.name != "day"]
    last = (spark.read.option("basePath", out_dir).parquet(out_dir)
            .groupBy("day").agg(F.max_by(F.struct(*fields), "batch_id").alias("last")))
    return finish_daily(last.select("day", "last.*")), progress
