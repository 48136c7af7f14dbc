"""Streaming query keys.

Each key lands the batch input as files under the shared folder, runs the streaming
query over them with ``trigger(availableNow=True)`` and returns the sink as a
DataFrame.  T1 and T2 have SQL oracles: T1 must equal the batch daily monitor on every day, T2 the
batch engagement view.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import monitor as MO
from ..plans.feature_store import shuffle_partitions
from ..plans.queries import KEY, register, tidy
from ..sources import io as IO
from . import incremental, monitor_stream, scoring


@register("monitor_daily_stream")
def monitor_daily_stream(ws):  # T1 stream form
    src = MO.monitoring_source(ws.predictions, ws.subscribers, "signup_date")
    run = uuid.uuid4().hex[:12]
    path = IO.scratch_path(ws.spark, "streams", run, "monitor_source")
    src.write.parquet(path)
    daily, _ = monitor_stream.run_monitor_stream(ws.spark, path, run)
    return daily


@register("incremental_features")
def incremental_features(ws):  # T2: engagement view maintained from event files, one per micro-batch
    run = uuid.uuid4().hex[:12]
    path = IO.scratch_path(ws.spark, "streams", run, "engagement_source")
    ws.cat.engagement_events.write.parquet(path)
    return tidy(incremental.run_incremental(ws.spark, path, run, max_files_per_trigger=1))


#: Subscribers for each request file of a part: a task writes and reads one file.
ROWS_PER_FILE = 50_000


def request_files(rows: int) -> int:
    return max(4, -(-rows // ROWS_PER_FILE))


def _score_requests(ws):
    """(batch rows, streamed scores): every subscriber's feature row as a request, each delivered in two or three of four files."""
    from ..operators.model import model_inputs
    from ..plans.model_queries import trained
    model, _ = trained(ws)
    run = uuid.uuid4().hex[:12]
    path = IO.scratch_path(ws.spark, "streams", run, "score_source")
    h = F.pmod(F.xxhash64(KEY), F.lit(4))
    rows = model_inputs(ws.wide).select(
        F.concat(F.lit("request-"), KEY).alias(scoring.EVENT_ID),
        F.timestamp_add("SECOND", -F.pmod(F.xxhash64(KEY), F.lit(3600)), F.lit(ws.as_of).cast("timestamp_ntz")).alias(scoring.EVENT_TIME), "*")
    rows = IO.materialize(rows)
    files = request_files(rows.count())
    for i in range(4):
        sent = rows.where((h == i) | (h == (i + 1) % 4) | ((h == (i + 2) % 4) & (F.length(KEY) % 2 == 0)))
        (sent.coalesce(4) if files == 4 else sent.repartition(files)).write.parquet(f"{path}/part={i}")
    with shuffle_partitions(ws.spark, files):   # a micro-batch takes a fixed share of the requests, its tasks a fixed number
        streamed = scoring.run_stream_scoring(ws.spark, model, f"{path}/part=*", rows.schema, run, ws.as_of, max_files_per_trigger=files + 1)
    return model, rows, streamed


@register("stream_scoring")
def stream_scoring(ws):  # T3: each request scored once, though files repeat requests
    return _score_requests(ws)[2]


@register("stream_scoring_facts")
def stream_scoring_facts(ws):  # T3 against the batch scores: same ids, each once, no row differs
    from ..operators.model import predict
    model, rows, streamed = _score_requests(ws)
    streamed = IO.materialize(streamed)
    cols = [KEY, "predicted_churn", "churn_probability"]
    batch = IO.materialize(predict(model, rows, ws.as_of).select(cols))
    facts = streamed.agg(F.count(F.lit(1)).alias("streamed_rows"), F.countDistinct(scoring.EVENT_ID).alias("events"),
                         F.countDistinct(KEY).alias("subscribers"), F.count_if(F.col("churn_probability").between(0, 1)).alias("probabilities"))
    sides = [a.select(cols).exceptAll(b.select(cols)).agg(F.count(F.lit(1)).alias(n))
             for a, b, n in ((streamed, batch, "streamed_minus_batch"), (batch, streamed, "batch_minus_streamed"))]
    one = facts.crossJoin(sides[0]).crossJoin(sides[1])   # one row each
    return one.unpivot([], one.columns, "fact", "value")
