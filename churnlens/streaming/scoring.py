"""Score requests as they arrive, each event id once (the fitted PipelineModel on a streaming frame).

A request is a feature row with an event id and a time. Producers repeat requests (a retried call, a file delivered twice), so
duplicates of an id are dropped within a watermark: state holds the ids of the last ``horizon`` of event time and no more, spread by
id. The file sink publishes each micro-batch once, whatever is retried, so every id is written once, with the score that the batch
job gives the same row.

Defined results: of requests with one id the first to arrive counts (repeats are copies); a repeat that comes later than ``horizon`` behind
the newest event is dropped as late, like any request so late; a request without an id or time is not scored.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.model import predict
from ..session import scratch_path

EVENT_ID, EVENT_TIME, HORIZON = "event_id", "event_time", "1 day"


def run_stream_scoring(spark: SparkSession, model: PipelineModel, source_dir: str, schema: T.StructType,
                       run_id: str, as_of=None, horizon: str = HORIZON, max_files_per_trigger: int | None = None) -> DataFrame:
    """Score every new request file in ``source_dir`` (availableNow); returns (event id, id, prediction, probability, time).

    Run again with the same ``run_id``, it goes on where it stopped.
    """
    out_dir = scratch_path(spark, "streams", run_id, "scores_out")
    ckpt = scratch_path(spark, "streams", run_id, "scores_ckpt")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(source_dir).where(F.col(EVENT_ID).isNotNull() & F.col(EVENT_TIME).isNotNull())
    # Structured Streaming keeps event time as an instant
    requests = requests.withColumn(EVENT_TIME, F.col(EVENT_TIME).cast("timestamp"))
    once = requests.withWatermark(EVENT_TIME, horizon).dropDuplicatesWithinWatermark([EVENT_ID])
    out = predict(model, once, as_of, keep=(EVENT_ID,))
    q = (out.writeStream.outputMode("append").format("parquet")
         .option("path", out_dir).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(out_dir)
