"""Point-in-time features (J14 as-of join, W5 last value before a timestamp).

For every spine row (key, ts) we want aggregates of the events of the same key with ``event.ts <= spine.ts``. A plain
non-equi join would pair every spine row with every earlier event of its key -- quadratic for a hot key. Here both
lie on one timeline and every aggregate is a prefix aggregate along it, computed in blocks:

1. events and spine rows are sorted into ranges of (key, ts, events first) and stored once with the number of their range.
   A range is a block; a key that holds a third of all rows spreads over a third of the blocks, a hot timestamp too;
2. each (key, block) gets its totals, and a window over a key's blocks (at most as many as there are ranges) turns them into what
   all earlier blocks hold;
3. a window inside each (key, block) adds what stands before a spine row in its own block.

Distinct counts are not additive, first occurrences are: each (key, value) is reduced to its earliest timestamp, which
becomes a row of its own on the timeline, and the distinct count as of a time is a running sum of those. Sums, counts,
maxima, last values and distinct counts of any number of columns thus come from one pass; each input is read for the
timeline once, events with distinct counts once more for the first occurrences. Ranges and the tasks of the windows are sized by
counted rows, so a task's memory doesn't grow with the input.

Defined results: events without key or timestamp belong to no spine row; a spine row without key or timestamp has no events;
events at the very timestamp count; without events sums, maxima and last values are NULL, counts 0; a last value is the
latest one that isn't NULL, by (ts, order column); repeated spine rows each get a row; the spine's own columns are kept.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import days_between
from ..sources.catalog import Catalog
from ..sources.io import write_and_read


#: Rows of a range, and of a task that sorts: tasks sized by compressed bytes would hold more rows the better they compress.
BLOCK_ROWS = 100_000


def _parts(rows: int) -> int:
    return max(1, -(-rows // BLOCK_ROWS))


@dataclass(frozen=True)
class Running:
    """An aggregate of ``value``, a SQL expression, over a key's events up to a time: ``how`` is count, sum, max, last or distinct.

    ``count`` counts the events for which ``value`` is true (a NULL is not).
    """
    name: str
    how: str
    value: str


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("long")


def _first_occurrences(events: DataFrame, at: str, key: str, running: list[Running], parts: int) -> DataFrame:
    """(key, at, which): the earliest timestamp of every value of every distinct-counted column."""
    if parts > 1:   # nearly every value may be a first one, and a scan's task has more rows than its hash map should
        events = events.repartition(parts, F.col(key), F.col(at), *[F.expr(r.value) for r in running])
    each = F.array(*[F.struct(F.lit(i).alias("which"), F.expr(r.value).cast("string").alias("value")) for i, r in enumerate(running)])
    return (events.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.explode(each).alias("_e"))
            .where("_e.value is not null").groupBy("_key", "_e.which", "_e.value").agg(F.min("_at").alias("_at"))
            .select("_key", "_at", "which"))


def as_of(spine: DataFrame, events: DataFrame, key: str, at: str, running: list[Running], order_col: str | None = None,
          blocks: int | None = None) -> DataFrame:
    """``spine`` with one column per running aggregate of the events of its row's key up to its row's ``at``.

    ``blocks`` fixes the number of ranges; by default one for every ``BLOCK_ROWS`` rows.
    """
    distinct = [r for r in running if r.how == "distinct"]
    others = [r for r in running if r.how != "distinct"]
    known = events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    tie = F.col(order_col) if order_col else F.lit(None).cast("string")
    rows = known.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(0).alias("_kind"), tie.alias("_tie"),
                        *[(_flag(F.expr(r.value)) if r.how == "count" else F.expr(r.value)).alias(f"_v_{r.name}") for r in others])
    n_events, n_spine = known.count(), spine.count()
    if distinct:
        first = _first_occurrences(known, at, key, distinct, _parts(n_events)).select(
            "_key", "_at", F.lit(0).alias("_kind"), *[_flag(F.col("which") == i).alias(f"_v_{r.name}") for i, r in enumerate(distinct)])
        rows = rows.unionByName(first, allowMissingColumns=True)
    marks = spine.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                         F.xxhash64(*[F.col(f"`{c}`") for c in spine.columns]).alias("_mark"),
                         F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(spine.columns)]).alias("_spine"))
    rows = rows.unionByName(marks, allowMissingColumns=True)

    order = [F.col(c) for c in ("_key", "_at", "_kind", "_tie", "_mark")]
    blocks = blocks or _parts(n_events * (1 + len(distinct)) + n_spine)
    dealt = rows.repartitionByRange(blocks, *order)
    rows = write_and_read(spine.sparkSession, dealt.withColumn("_block", F.spark_partition_id()), "timeline")

    def fold(r: Running, value: str):
        if r.how == "max":
            return F.max(value)
        return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct("_at", "_tie"))) if r.how == "last" else F.sum(value)

    def scan(r: Running, value: str, w) -> Column:
        if r.how == "last":
            return F.last(value, ignorenulls=True).over(w)
        return (F.max if r.how == "max" else F.sum)(value).over(w)

    totals = rows.where("_kind = 0").groupBy("_key", "_block").agg(*[fold(r, f"_v_{r.name}").alias(f"_t_{r.name}") for r in running])
    # a block of spine rows alone has no totals of its own but what stands before it
    every = rows.select("_key", "_block").distinct().join(totals, ["_key", "_block"], "left")
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = every.select("_key", "_block", *[scan(r, f"_t_{r.name}", earlier).alias(f"_b_{r.name}") for r in running])
    inside = Window.partitionBy("_key", "_block").orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (rows.repartition(blocks, "_key", "_block").join(before, ["_key", "_block"], "left")
             .select("_kind", "_spine", *[f"_b_{r.name}" for r in running],
                     *[scan(r, f"_v_{r.name}", inside).alias(f"_o_{r.name}") for r in running])
             .where("_kind = 1"))

    def joined(r: Running) -> Column:
        before_, own = F.col(f"_b_{r.name}"), F.col(f"_o_{r.name}")
        if r.how == "max":
            return F.greatest(before_, own)
        if r.how == "last":
            return F.coalesce(own, before_)
        total = F.coalesce(before_ + own, own, before_)
        return F.coalesce(total, F.lit(0)).cast("long") if r.how in ("count", "distinct") else total

    return found.select(*[F.col(f"_spine.c{i}").alias(c) for i, c in enumerate(spine.columns)],
                        *[joined(r).alias(r.name) for r in running])


def as_of_features(spine: DataFrame, events: DataFrame, key: str, ts: str, spine_id: str,
                   order_col: str, sums: list[str], last_cols: list[str]) -> DataFrame:
    """Per spine row: n_events, sum_<c> for ``sums``, last_<c> (latest by (ts, order_col)) for ``last_cols``."""
    running = [Running("n_events", "count", "true"), *[Running(f"sum_{c}", "sum", c) for c in sums],
               *[Running(f"last_{c}", "last", c) for c in last_cols]]
    return as_of(spine.select(key, spine_id, ts), events, key, ts, running, order_col)


# ---------------------------------------------------------------------------
# The five feature views as of a time
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class PointInTimeView:
    """A feature view as running aggregates of its source and SQL expressions over them."""
    source: str
    at: str
    running: tuple[Running, ...]
    features: tuple[tuple[str, str], ...] = ()


AS_OF_VIEWS: dict[str, PointInTimeView] = {
    "engagement": PointInTimeView(
        "engagement_events", "event_timestamp",
        (Running("total_engagements", "count", "true"),
         Running("unique_articles", "distinct", "article_id"),
         Running("total_sessions", "distinct", "session_id"),
         Running("device_diversity", "distinct", "device_type"),
         Running("time_sum", "sum", "bigint(time_spent_seconds)"),
         Running("time_n", "count", "time_spent_seconds is not null"),
         Running("scroll_sum", "sum", "bigint(scroll_depth_pct)"),
         Running("scroll_n", "count", "scroll_depth_pct is not null"),
         Running("total_views", "count", "event_type = 'view'"),
         Running("total_shares", "count", "event_type = 'share'"),
         Running("total_comments", "count", "event_type = 'comment'"),
         Running("last_engagement_date", "max", "event_timestamp")),
        (("avg_time_spent", "try_divide(time_sum, time_n)"), ("avg_scroll_depth", "try_divide(scroll_sum, scroll_n)"))),
    "payment": PointInTimeView(
        "payments", "transaction_timestamp",
        (Running("total_payments", "count", "true"),
         Running("failed_payments", "count", "payment_status = 'failed'"),
         Running("successful_payments", "count", "payment_status = 'success'"),
         Running("total_revenue", "sum", "amount"),
         Running("amount_n", "count", "amount is not null")),
        (("avg_payment_amount", "try_divide(double(total_revenue), amount_n)"),
         ("payment_failure_rate", "try_divide(failed_payments, total_payments)"))),
    "email": PointInTimeView(
        "email_interactions", "event_timestamp",
        (Running("emails_sent", "count", "event_type = 'sent'"),
         Running("emails_opened", "count", "event_type = 'opened'"),
         Running("emails_clicked", "count", "event_type = 'clicked'"),
         Running("email_unsubscribes", "count", "event_type = 'unsubscribed'")),
        (("email_open_rate", "try_divide(emails_opened, emails_sent)"),
         ("email_click_rate", "try_divide(emails_clicked, emails_opened)"))),
    "support": PointInTimeView(
        "customer_support", "created_timestamp",
        (Running("total_tickets", "count", "true"),
         Running("billing_tickets", "count", "ticket_type = 'billing'"),
         Running("cancel_tickets", "count", "ticket_type = 'cancellation'"),
         Running("high_priority_tickets", "count", "priority = 'high'"))),
    "promo": PointInTimeView(
        "promotions", "start_date",
        (Running("total_promos", "count", "true"),
         Running("max_discount_pct", "max", "discount_pct"),
         Running("trial_promos", "count", "promo_type = 'trial'"))),
}


def view_as_of(spine: DataFrame, cat: Catalog, view: str, key: str, at: str, features: tuple[str, ...]) -> DataFrame:
    """``spine`` with the ``features`` of a view as of each row's ``at``; 0 where no event counts, as in the wide table (D4),
    dates NULL."""
    v = AS_OF_VIEWS[view]
    events = cat.raw(v.source).withColumn(at, F.col(v.at)) if v.at != at else cat.raw(v.source)
    out = as_of(spine, events, key, at, list(v.running)).withColumns({n: F.expr(e) for n, e in v.features})
    return out.select(*spine.columns, *[F.col(f) if f.endswith("_date") else F.coalesce(f, F.lit(0)).alias(f) for f in features])


def training_set_as_of(spine: DataFrame, cat: Catalog, key: str, at: str, views: dict[str, tuple[str, ...]]) -> DataFrame:
    """The wide training rows as of each spine row: every view's features on (key, at), and the days since the last engagement.

    The views are separate timelines over the same distinct (key, at) pairs; the spine joins them on that pair.
    """
    points = spine.select(key, at).where(F.col(key).isNotNull() & F.col(at).isNotNull()).distinct()
    with ThreadPoolExecutor(max_workers=len(views)) as pool:   # each view stores its timeline: jobs that can share the cluster
        parts = list(pool.map(lambda v: view_as_of(points, cat, v, key, at, views[v]), views))
    wide = reduce(lambda a, b: a.join(b, [key, at]), parts)
    if "last_engagement_date" in wide.columns:
        wide = wide.withColumn("days_since_engagement", days_between("last_engagement_date", F.col(at)))
    return spine.join(wide, [key, at], "left")
