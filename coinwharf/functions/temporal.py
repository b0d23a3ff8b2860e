"""Days, months and clocks. A clock is always an argument, so runs can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

WHOLE_DAY = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?\s*\z"


def day_literal(as_of: dt.date | str | None) -> Column:
    """The reference day as a literal; ``None`` means today in the session's time zone."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def instant_literal(run_ts: dt.datetime | str | None) -> Column:
    """The run's instant as a timestamp; ``None`` means now, naive values are UTC."""
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, str):
        run_ts = dt.datetime.fromisoformat(run_ts)
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=dt.timezone.utc)
    return F.lit(run_ts)


def to_day(col: Column) -> Column:
    """The day of a date, timestamp or text value.

    Text must be a whole ``yyyy-MM-dd``, alone or before a whole time; all else gives NULL.
    """
    return F.when(F.regexp_like(col.cast("string"), F.lit(WHOLE_DAY)), col.try_cast("date"))


def to_instant(col: Column) -> Column:
    """The instant of a timestamp or text value.

    Text must hold a whole day, as for :func:`to_day`; a year or a time alone gives NULL.
    """
    return F.when(F.regexp_like(col.cast("string"), F.lit(WHOLE_DAY)), col.try_cast("timestamp"))


def clamp_future(day: Column, as_of: Column) -> Column:
    """Days after ``as_of`` become ``as_of``; NULL stays NULL (``least`` would not keep it)."""
    return F.when(day > as_of, as_of).otherwise(day)


def months_before(as_of: Column, months: int) -> Column:
    """The same day some months earlier, moved to the month's last day where needed."""
    return F.add_months(as_of, -months)


def year_month(day: Column) -> Column:
    """``2025-07`` for any day of July 2025."""
    return F.date_format(day, "yyyy-MM")
