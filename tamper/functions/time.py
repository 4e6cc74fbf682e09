"""Date and time functions.

Every function that compares with "now" takes an explicit ``as_of`` so results
are repeatable; callers resolve "now" once per run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value, ntz: bool = True) -> Column:
    """A timestamp literal. ``ntz`` gives TIMESTAMP_NTZ, the type parquet
    timestamps without zone load as, so comparisons need no cast on the column
    side and stay pushable to the scan."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    lit = F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f"))
    return lit.cast(T.TimestampNTZType() if ntz else T.TimestampType())


def date_literal(value) -> Column:
    if isinstance(value, str):
        value = dt.date.fromisoformat(value[:10])
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value.isoformat()).cast(T.DateType())


def null_if_future(c, as_of) -> Column:
    """Keep a date only if it is not after ``as_of`` (a date compares as its
    midnight against a timestamp)."""
    c = _col(c)
    return F.when(c.cast(T.TimestampNTZType()) <= ts_literal(as_of), c)


def null_if_negative(c) -> Column:
    c = _col(c)
    return F.when(c < 0, F.lit(None)).otherwise(c)


def lookback(ts, hours: int, as_of) -> Column:
    """``ts >= as_of - hours``. The bound is folded into one literal on the
    driver, so the predicate reaches the Parquet scan as a pushed filter."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if int(hours) < 1:
        raise ValueError("look-back must be at least one hour")
    return _col(ts) >= ts_literal(as_of - dt.timedelta(hours=int(hours)))


def seconds_between(start, end) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (both truncated to
    the second, then subtracted), the warehouse's DATEDIFF(second, ...)."""
    s = F.date_trunc("second", _col(start).cast(T.TimestampType()))
    e = F.date_trunc("second", _col(end).cast(T.TimestampType()))
    return F.unix_seconds(e) - F.unix_seconds(s)


def lag_minutes(ts, as_of) -> Column:
    """Minutes from ``ts`` (date or timestamp) to ``as_of``; NULL stays NULL."""
    t = _col(ts).cast(T.TimestampType())
    return (F.unix_micros(ts_literal(as_of, ntz=False)) - F.unix_micros(t)).cast("double") / 60e6


def first_of_month(c) -> Column:
    return F.trunc(_col(c).cast(T.DateType()), "MM")


# A time of day and zone after a date; the written date counts, not the day in UTC.
TIME_SUFFIX = (r"(?:T|\s+)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?"
               r"\s*(?:Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)?$")
# ISO, compact, year first with slashes, month first with slashes, month names.
DATE_FORMATS = ["yyyy-M-d", "yyyyMMdd", "yyyy/M/d", "M/d/yyyy", "MMM d, yyyy", "MMMM d, yyyy",
                "d MMM yyyy", "d MMMM yyyy"]


def try_date(c) -> Column:
    """String -> DATE in any of ``DATE_FORMATS``, with or without a time of day and zone.
    The date is the one that is written, whatever the zone; a bad value (``2025-13-01``)
    becomes NULL."""
    day = F.regexp_replace(F.trim(_col(c).cast("string")), TIME_SUFFIX, "")
    return F.coalesce(*[F.try_to_date(day, f) for f in DATE_FORMATS])
