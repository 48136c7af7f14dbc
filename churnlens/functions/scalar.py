"""Scalar column helpers. All JVM-side expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def ts_lit(value: _dt.datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def days_between(start, end) -> Column:
    """whole calendar midnights crossed from ``start`` to ``end`` (D9, two-argument form)."""
    return F.date_diff(as_col(end), as_col(start))


def age_at(birth_year, as_of: _dt.datetime) -> Column:
    """year(as_of) - birth_year."""
    return F.year(ts_lit(as_of)) - as_col(birth_year)


def ratio_or_null(num, den) -> Column:
    """P16 flavour 1: num / NULLIF(den, 0) as double (NULL when den = 0)."""
    return F.try_divide(as_col(num).cast("double"), F.nullif(as_col(den), F.lit(0)).cast("double"))


def ratio_or_zero(num, den) -> Column:
    """P16 flavour 2: CASE WHEN den > 0 THEN num / den ELSE 0 END."""
    return F.when(as_col(den) > 0, as_col(num).cast("double") / as_col(den).cast("double")).otherwise(F.lit(0.0))


def ratio_floor_one(num, den) -> Column:
    """P16 flavour 3: num / max(den, 1)."""
    return as_col(num).cast("double") / F.greatest(as_col(den).cast("double"), F.lit(1.0))


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as long."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def split_bucket(id_col) -> Column:
    """Deterministic bucket 0..99 from the id: first 32 bits of md5 as an unsigned int, mod 100.

    Same value in any engine that has md5 (the oracle uses the identical formula), and
    unlike abs(hash) it cannot overflow under ANSI arithmetic.
    """
    h = F.conv(F.substring(F.md5(as_col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(100)).cast("int")


def split_name(bucket) -> Column:
    """60/20/20 train / validation / test by bucket."""
    b = as_col(bucket)
    return F.when(b < 60, "train").when(b < 80, "validation").otherwise("test")



def month_ends(start, end) -> Column:
    """F16: array of month-end dates from start to end."""
    return F.transform(F.sequence(F.trunc(as_col(start).cast("date"), "month"),
                                  F.trunc(as_col(end).cast("date"), "month"),
                                  F.expr("interval 1 month")), lambda d: F.last_day(d))



def round_money(c) -> Column:
    return F.round(as_col(c).cast("double"), 2)


def round_ratio(c, places: int = 6) -> Column:
    return F.round(as_col(c).cast("double"), places)
