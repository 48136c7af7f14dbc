"""Point-in-time features: every aggregate against brute force, hot keys in blocks, one read of the events."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from churnlens.operators import timeline as TL

RUNNING = [TL.Running("n", "count", "true"), TL.Running("failed", "count", "status = 'failed'"), TL.Running("total", "sum", "amount"),
           TL.Running("top", "max", "amount"), TL.Running("status", "last", "status"), TL.Running("last_id", "last", "event_id"),
           TL.Running("kinds", "distinct", "kind"), TL.Running("places", "distinct", "place")]
EVENT = "key string, ts timestamp_ntz, event_id int, amount decimal(10,2), status string, kind string, place int"
SPINE = "row int, key string, ts timestamp_ntz, note string"


def at(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def brute(spine, events):
    out = []
    for row, key, ts, note in spine:
        seen = [e for e in events if key is not None and ts is not None and e[0] == key and e[1] is not None and e[1] <= ts]
        seen.sort(key=lambda e: (e[1], e[2]))
        amounts = [e[3] for e in seen if e[3] is not None]
        last = [e[4] for e in seen if e[4] is not None]
        out.append((row, key, ts, note, len(seen), sum(e[4] == "failed" for e in seen), sum(amounts) if amounts else None,
                    max(amounts, default=None), last[-1] if last else None, seen[-1][2] if seen else None,
                    len({e[5] for e in seen if e[5] is not None}), len({e[6] for e in seen if e[6] is not None})))
    return out


def rows_of(rng, n_events, n_spine, hot=1 / 3):
    key = lambda: "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "d", None])
    when = lambda: rng.choice([None, *range(1, 40)]) if rng.random() < 0.9 else 7
    events = [(key(), at(when()), i, rng.choice([None, Decimal(rng.randrange(100))]), rng.choice(["failed", "ok", None]),
               rng.choice(["x", "y", "z", None]), rng.randrange(9)) for i in range(n_events)]
    spine = [(i, key(), at(when()), rng.choice(["n", None])) for i in range(n_spine)]
    return events, spine + [(9999, "nobody", at(50), None), (9998, "hot", at(0), None)]


@pytest.mark.parametrize("blocks", [None, 1, 7, 40])
def test_as_of_equals_brute_force(spark, blocks):
    events, spine = rows_of(random.Random(blocks or 0), 300, 120)
    got = TL.as_of(spark.createDataFrame(spine + spine[:3], SPINE), spark.createDataFrame(events, EVENT), "key", "ts", RUNNING, "event_id", blocks)
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(map(str, brute_rows(spine + spine[:3], events)))


def brute_rows(spine, events):
    money = lambda v: None if v is None else Decimal(v).quantize(Decimal("0.01"))
    return [(*r[:6], money(r[6]), money(r[7]), *r[8:]) for r in brute(spine, events)]


def test_as_of_empty_tables(spark):
    events, spine = rows_of(random.Random(1), 20, 10)
    none = TL.as_of(spark.createDataFrame([], SPINE), spark.createDataFrame(events, EVENT), "key", "ts", RUNNING, "event_id")
    assert none.count() == 0
    got = TL.as_of(spark.createDataFrame(spine, SPINE), spark.createDataFrame([], EVENT), "key", "ts", RUNNING, "event_id")
    assert {tuple(r)[4:] for r in got.collect()} == {(0, 0, None, None, None, None, 0, 0)}


def test_a_hot_key_spreads_over_blocks(spark, monkeypatch):
    """One key holds a third of all events and spine rows, half of those at one timestamp: no (key, block) group is large."""
    stored = []
    keep = TL.write_and_read
    monkeypatch.setattr(TL, "write_and_read", lambda *a: stored.append(keep(*a)) or stored[-1])
    n = 30_000
    ids = spark.range(n)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    ts = F.lit(at(0)).cast("timestamp_ntz") + F.expr("make_interval(0, 0, 0, 0, 0, 0, if(id % 6 = 0, 5000, id))")
    events = ids.select(key.alias("key"), ts.alias("ts"), F.col("id").cast("int").alias("event_id"), F.lit(1).cast("decimal(10,2)").alias("amount"),
                        F.lit("ok").alias("status"), (F.col("id") % 1000).cast("string").alias("kind"), F.lit(1).alias("place"))
    spine = ids.select(F.col("id").cast("int").alias("row"), key.alias("key"), ts.alias("ts"), F.lit(None).cast("string").alias("note"))
    got = TL.as_of(spine, events, "key", "ts", RUNNING, "event_id", blocks=20)
    hot = got.where("key = 'hot'").agg(F.count("*"), F.max("n"), F.max("kinds"), F.sum("n")).first()
    assert hot[0] == n // 3 and hot[1] == n // 3 and hot[2] == 1000
    at_once = n // 6                     # every sixth event stands at 5,000 seconds, the others one by one
    others = [i for i in range(0, n, 3) if i % 6]
    want = sum(sum(j <= i for j in others) + (at_once if i >= 5000 else 0) for i in others[:10])
    first = got.where(F.col("row").isin(others[:10])).agg(F.sum("n")).first()[0]
    assert first == want
    sizes = stored[0].groupBy("_key", "_block").count()
    total = stored[0].count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * total / 20


def test_events_are_read_once_for_additive_aggregates(spark, tmp_path, monkeypatch):
    """The timeline's plan scans the events once, and once more only where distinct counts need first occurrences."""
    events, spine = rows_of(random.Random(2), 50, 20)
    spark.createDataFrame(events, EVENT).write.parquet(str(tmp_path / "events_table"))
    ev, sp = spark.read.parquet(str(tmp_path / "events_table")), spark.createDataFrame(spine, SPINE)
    scans = []

    def count(s, df, name):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return df
    monkeypatch.setattr(TL, "write_and_read", count)
    TL.as_of(sp, ev, "key", "ts", [r for r in RUNNING if r.how != "distinct"], "event_id")
    TL.as_of(sp, ev, "key", "ts", RUNNING, "event_id")
    assert scans == [1, 2]


def test_ranges_are_sized_by_rows(spark, monkeypatch):
    """As many ranges as counted rows ask for, whatever their bytes, with the same results."""
    events, spine = rows_of(random.Random(3), 300, 120)
    stored = []
    write = TL.write_and_read
    monkeypatch.setattr(TL, "write_and_read", lambda *a: (stored.append(write(*a)), stored[-1])[1])
    monkeypatch.setattr(TL, "BLOCK_ROWS", 60)
    got = TL.as_of(spark.createDataFrame(spine, SPINE), spark.createDataFrame(events, EVENT), "key", "ts", RUNNING, "event_id")
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(map(str, brute_rows(spine, events)))
    sizes = [r["count"] for r in stored[0].groupBy("_block").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 180
