"""Structured Streaming (T1-T2): stream = batch, late rows dropped by the watermark."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import functions as F

from helpers import SF_SMALL
from churnlens.operators import monitor as MO
from churnlens.plans.queries import tidy
from churnlens.plans.workspace import Workspace
from churnlens.session import scratch_path
from churnlens.streaming import incremental, monitor_stream


def _src_rows(spark, rows):
    return spark.createDataFrame(rows, monitor_stream.SOURCE_SCHEMA)


def test_late_row_is_dropped(spark):
    run = uuid.uuid4().hex[:8]
    src = scratch_path(spark, "test_streams", run, "src")
    d = dt.datetime(2024, 1, 1)
    first = [(f"a{i}", d + dt.timedelta(days=i), 1, 1) for i in range(10)]
    _src_rows(spark, first).coalesce(1).write.parquet(src + "/part=1")
    # Late rows are judged against the watermark of the previous micro-batch, so one on-time
    # batch moves the watermark to day 9 before the late file arrives.
    time.sleep(1.1)
    _src_rows(spark, [("b", d + dt.timedelta(days=10), 1, 1)]).coalesce(1).write.mode("append").parquet(src + "/part=1")
    time.sleep(1.1)
    late = [("late", d + dt.timedelta(days=6, hours=12), 1, 0)]  # two days behind the watermark
    _src_rows(spark, late).coalesce(1).write.mode("append").parquet(src + "/part=1")
    daily, progress = monitor_stream.run_monitor_stream(spark, src + "/part=1", run, max_files_per_trigger=1)
    assert progress["rows_dropped_by_watermark"] == 1
    by_day = {r["day"]: r["volume"] for r in daily.collect()}
    assert by_day["2024-01-07"] == 1  # the late row never reached its window


def test_stream_equals_batch_on_every_window(spark):
    ws = Workspace(spark, SF_SMALL)
    src = MO.monitoring_source(ws.predictions, ws.cat.subscribers, "signup_date")
    run = uuid.uuid4().hex[:8]
    path = scratch_path(spark, "test_streams", run, "src")
    src.repartition(3).write.parquet(path)
    stream, _ = monitor_stream.run_monitor_stream(spark, path, run)
    batch = MO.monitor_daily(src)
    s = {tuple(r) for r in stream.collect()}
    b = {tuple(r) for r in batch.collect()}
    assert s and s == b


def test_incremental_view_equals_batch(spark):
    ws = Workspace(spark, SF_SMALL)
    run = uuid.uuid4().hex[:8]
    path = scratch_path(spark, "test_streams", run, "events")
    ws.cat.engagement_events.repartition(3, "event_id").write.parquet(path)
    inc = tidy(incremental.run_incremental(spark, path, run, max_files_per_trigger=1))
    batch = tidy(ws.views["engagement"])
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, batch.select(inc.columns).collect()))


def _event_files(spark, run, n, per_file=120):
    """Events dealt into ``n`` files: one subscriber holds a third of them, with NULLs and values that come back in later files."""
    ids = spark.range(n * per_file)
    when = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.expr("make_interval(0, 0, 0, 0, 0, cast(id as int), 0)")
    who = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 17).cast("string"))
    events = ids.select(
        F.col("id").cast("string").alias("event_id"), who.alias("subscriber_id"), (F.col("id") % 29).cast("string").alias("article_id"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 80).cast("string")).alias("session_id"),
        F.element_at(F.array(F.lit("view"), F.lit("share"), F.lit("comment"), F.lit("save")), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        F.lit("mobile").alias("device_type"), F.lit("ios").alias("platform"), F.when(F.col("id") % 5 > 0, F.col("id").cast("int")).alias("time_spent_seconds"),
        (F.col("id") % 100).cast("int").alias("scroll_depth_pct"), when.alias("event_timestamp"))
    path = scratch_path(spark, "test_streams", run, "events")
    for i in range(n):
        events.where(F.floor(F.col("id") / per_file) == i).coalesce(1).write.mode("append").parquet(path)
    return path, events


def _view_rows(df):
    return sorted(map(str, map(tuple, tidy(df).collect())))


def _batch_view(spark, events):
    from helpers import fixture_catalog
    from churnlens.operators import features as FE
    cat = fixture_catalog(spark)
    cat.__dict__["engagement_events"] = events.where("subscriber_id is not null")
    return FE.engagement_features(cat)


def test_view_survives_a_crash_between_writing_and_publishing(spark, monkeypatch):
    """The second batch writes its files and dies before its manifest; the restarted stream ends with the batch view."""
    from churnlens.sources.versions import VersionedTable
    run = uuid.uuid4().hex[:8]
    path, events = _event_files(spark, run, 4)
    commit, calls = VersionedTable.commit, []

    def dying(self, base, parts, info=None, whole=False):
        calls.append(info["batch_id"])
        if len(calls) == 2:
            raise RuntimeError("executor host lost")
        return commit(self, base, parts, info, whole)
    monkeypatch.setattr(VersionedTable, "commit", dying)
    import pytest
    with pytest.raises(Exception, match="executor host lost"):
        incremental.run_incremental(spark, path, run, buckets=4)
    got = incremental.run_incremental(spark, path, run, buckets=4)
    want = _batch_view(spark, events).select(got.columns)
    assert calls[:3] == [0, 1, 1] and _view_rows(got) == _view_rows(want)


def test_a_batch_run_twice_changes_nothing_and_versions_stay_readable(spark):
    run = uuid.uuid4().hex[:8]
    path, events = _event_files(spark, run, 3)
    state = scratch_path(spark, "test_streams", run, "state")
    table = incremental.view_table(spark, state)
    batches = [events.where(F.floor(F.col("event_id").cast("long") / 120) == i) for i in range(3)]
    seen = []
    for i, b in enumerate(batches):
        incremental.apply_batch(table, b, i, buckets=4)
        seen.append(_view_rows(incremental.read_view(spark, state)))
        incremental.apply_batch(table, b, i, buckets=4)
        assert _view_rows(incremental.read_view(spark, state)) == seen[-1]
    incremental.apply_batch(table, events.limit(0), 3)
    assert table.latest().info["batch_id"] == 3 and _view_rows(incremental.read_view(spark, state)) == seen[-1]
    assert [_view_rows(incremental.read_view(spark, state, v)) for v in (1, 2, 3)] == seen


def test_reading_the_view_costs_the_table_and_folders_are_folded(spark, monkeypatch):
    """After many batches the view is read from one folder a bucket, without a shuffle, and no bucket has a long list of pair folders."""
    monkeypatch.setattr(incremental, "MAX_FOLDERS", 3)
    run = uuid.uuid4().hex[:8]
    path, events = _event_files(spark, run, 6, per_file=60)
    state = scratch_path(spark, "test_streams", run, "state")
    table = incremental.view_table(spark, state)
    for i in range(6):
        incremental.apply_batch(table, events.where(F.floor(F.col("event_id").cast("long") / 60) == i), i, buckets=2)
    view = incremental.read_view(spark, state)
    assert "Exchange" not in view._jdf.queryExecution().executedPlan().toString()
    assert {len(f) for p, f in table.latest().parts.items() if p.startswith("rows/")} == {1}
    assert max(len(f) for p, f in table.latest().parts.items() if p.startswith("pairs/")) <= 3
    assert _view_rows(view) == _view_rows(_batch_view(spark, events).select(view.columns))


def test_a_batch_rewrites_only_its_buckets(spark):
    run = uuid.uuid4().hex[:8]
    path, events = _event_files(spark, run, 1)
    table = incremental.view_table(spark, scratch_path(spark, "test_streams", run, "state"))
    first = incremental.apply_batch(table, events, 0, buckets=16)
    second = incremental.apply_batch(table, events.where("subscriber_id = 'hot'"), 1)
    changed = {p for p in second.parts if second.parts[p] != first.parts.get(p)}
    assert len(changed) == 1 and next(iter(changed)).startswith("rows/")   # one bucket, and no pair is new


def test_scores_are_written_once_for_repeated_requests_and_after_a_restart(spark):
    """Three files repeat each other's requests; the stream is stopped after two and goes on with the third."""
    from churnlens.operators import model as M
    from churnlens.operators import quality as QA
    from churnlens.streaming import scoring
    ws = Workspace(spark, SF_SMALL)
    wide = QA.with_split(ws.wide)
    model = M.fit(wide.where("split = 'train'"), M.GBTParams(2, 2, 0.3))
    rows = M.model_inputs(ws.wide).withColumns({"event_id": F.concat(F.lit("e"), "subscriber_id"), "event_time": F.lit(ws.as_of).cast("timestamp_ntz")})
    run = uuid.uuid4().hex[:8]
    path = scratch_path(spark, "test_streams", run, "requests")
    third = F.crc32(F.col("subscriber_id").cast("binary")) % 3
    send = lambda df: df.coalesce(1).write.mode("append").parquet(path)
    go = lambda: scoring.run_stream_scoring(spark, model, path, rows.schema, run, ws.as_of, max_files_per_trigger=1)
    send(rows.where(third < 2).unionByName(rows.where(third == 0)))
    send(rows.where(third == 1).unionByName(rows.where(third == 1).withColumn("event_id", F.lit(None).cast("string"))))
    first = go().count()
    send(rows)
    scored = go()
    cols = ["subscriber_id", "predicted_churn", "churn_probability"]
    batch = M.predict(model, ws.wide, ws.as_of).select(cols)
    assert first == rows.where(third < 2).count() and scored.count() == rows.count()
    assert sorted(map(tuple, scored.select(cols).collect())) == sorted(map(tuple, batch.collect()))


def test_request_files_grow_in_number_with_the_subscribers(spark, monkeypatch):
    from churnlens.operators import model as M
    from churnlens.operators import quality as QA
    from churnlens.plans import model_queries as MQ
    from churnlens.streaming import queries as SQ
    ws = Workspace(spark, SF_SMALL)
    model = M.fit(QA.with_split(ws.wide).where("split = 'train'"), M.GBTParams(2, 2, 0.3))
    monkeypatch.setattr(MQ, "trained", lambda ws: (model, ""))
    n = ws.wide.count()
    monkeypatch.setattr(SQ, "ROWS_PER_FILE", -(-n // 12), raising=False)
    read, run = [], SQ.scoring.run_stream_scoring
    monkeypatch.setattr(SQ.scoring, "run_stream_scoring", lambda *a, **k: (read.append(a[2]), run(*a, **k))[1])
    _, rows, streamed = SQ._score_requests(ws)
    files = spark.read.parquet(read[0]).select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert len(files) > 16 and max(r["count"] for r in files) < n / 4   # four files a part held a quarter of it each
    assert streamed.count() == streamed.select("event_id").distinct().count() == n == rows.count()
