"""Date filters.

The predicate is a half-open timestamp range on ``published_date`` rather than
``to_date(published_date) BETWEEN``: the range form reaches the Parquet scan as
pushed filters.  Rows that carry their day (``published_day``, the partition
column of stored articles) get the day range as well, derived from the same
bounds, so that a scan of stored articles lists and reads only these days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_DAYS = 7
DAY_COLUMN = "published_day"


def parse_day(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    text = str(value)
    try:
        if len(text) > 10:  # an instant: its day
            return _dt.datetime.fromisoformat(text).date()
        return _dt.datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError as exc:
        raise ValueError(f"invalid date {value!r}: use YYYY-MM-DD") from exc


def day_bounds(start, end) -> tuple[_dt.datetime, _dt.datetime]:
    s, e = parse_day(start), parse_day(end)
    if s > e:
        raise ValueError(f"start date {s} is after end date {e}")
    lo = _dt.datetime.combine(s, _dt.time())
    hi = _dt.datetime.combine(e + _dt.timedelta(days=1), _dt.time())
    return lo, hi


def filter_date_range(df: DataFrame, start, end, col: str = "published_date") -> DataFrame:
    """Days start..end, both inclusive; rows without a date are dropped."""
    lo, hi = day_bounds(start, end)
    c = F.col(col)
    if col == "published_date" and DAY_COLUMN in df.columns:
        df = df.where(F.col(DAY_COLUMN).between(F.lit(lo.date()), F.lit((hi - _dt.timedelta(days=1)).date())))
    return df.where((c >= F.lit(lo).cast("timestamp_ntz")) & (c < F.lit(hi).cast("timestamp_ntz")))


def last_n_days_bounds(as_of, days: int | None = None) -> tuple[_dt.date, _dt.date]:
    """C2 bounds: [as_of - n days, as_of]; n missing or 0 means the default 7."""
    end = parse_day(as_of)
    n = days or DEFAULT_DAYS
    return end - _dt.timedelta(days=n), end


def last_n_days(df: DataFrame, as_of, days: int | None = None, col: str = "published_date") -> DataFrame:
    """The look-back window ending on the ``as_of`` day."""
    start, end = last_n_days_bounds(as_of, days)
    return filter_date_range(df, start, end, col)


def resolve_range(start=None, end=None, days: int | None = None, as_of=None):
    """The pipeline's range choice: an explicit pair wins; a lone bound is an
    error; otherwise the look-back window."""
    if (start is None) != (end is None):
        raise ValueError("give both start and end dates, or neither")
    if start is not None:
        return parse_day(start), parse_day(end)
    if as_of is None:
        raise ValueError("as_of is required for a look-back window")
    return last_n_days_bounds(as_of, days)
