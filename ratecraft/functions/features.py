"""Scalar feature expressions: release year, epoch conversion, date rounding.

All expressions are built-in Spark functions (JVM side, codegen'd) and are
independent of the session time zone: timestamps are handled as
``timestamp_ntz`` wall-clock values in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the analysis being reproduced:
# a title ends in a four-digit year in parentheses, e.g. "Toy Story (1995)".
YEAR_PATTERN = r"\(\d{4}\)$"
_YEAR_GROUP = r"\((\d{4})\)$"
# Genres inside one string are separated by a pipe.
GENRE_SEPARATOR = r"\|"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_has_year(title="title") -> Column:
    """True when the title ends in "(yyyy)" (str_detect)."""
    return _c(title).rlike(YEAR_PATTERN)


def release_year(title="title") -> Column:
    """Year in the trailing "(yyyy)" of a title, null when absent (int)."""
    raw = F.regexp_extract(_c(title), _YEAR_GROUP, 1)
    return F.when(raw != "", raw.cast("int"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz`` column."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _c(ts))


def from_epoch_seconds(secs) -> Column:
    """Epoch seconds to a UTC wall-clock ``timestamp_ntz`` (as_datetime)."""
    return F.timestamp_add("SECOND", _c(secs), F.expr(_EPOCH_NTZ))


def _period_bounds(d: Column, unit: str):
    if unit == "month":
        lo = F.trunc(d, "MM")
        return lo, F.add_months(lo, 1)
    if unit == "year":
        lo = F.trunc(d, "YYYY")
        return lo, F.add_months(lo, 12)
    if unit == "week":
        # Weeks start on Sunday; Spark's trunc('week') starts on Monday, so
        # shift by one day before and after truncating.
        lo = F.date_sub(F.trunc(F.date_add(d, 1), "week"), 1)
        return lo, F.date_add(lo, 7)
    if unit == "day":
        return d, F.date_add(d, 1)
    raise ValueError(f"unknown period unit {unit!r}")


def round_to_period(ts, unit: str = "month") -> Column:
    """Nearest period start of a ``timestamp_ntz`` (ties go up), as a date.

    Same rule as rounding a date-time to the closest week or month
    boundary: compare the distance to the period start with the distance to
    the next period start.
    """
    t = _c(ts)
    lo, hi = _period_bounds(F.to_date(t), unit)
    lo_ts, hi_ts = lo.cast("timestamp_ntz"), hi.cast("timestamp_ntz")
    past = F.timestamp_diff("MICROSECOND", lo_ts, t)
    ahead = F.timestamp_diff("MICROSECOND", t, hi_ts)
    return F.when(past >= ahead, hi).otherwise(lo)


def split_genres(genres="genres") -> Column:
    """Pipe-separated genre string to an array of genres."""
    return F.split(_c(genres), GENRE_SEPARATOR)


def first_genre(genres="genres") -> Column:
    """First genre of the pipe-separated string."""
    return F.get(split_genres(genres), 0)
