"""Date column functions (DATE-1 .. DATE-6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRIDAY = 4  # weekday(): Monday = 0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday(d: Column | str) -> Column:
    """DATE-6: day of week, Monday = 0 .. Sunday = 6."""
    return F.weekday(_col(d))


def last_friday(d: Column | str) -> Column:
    """DATE-1: the most recent Friday on or before ``d``."""
    d = _col(d)
    return F.date_sub(d, (F.weekday(d) + 3) % 7)


def week_ending_friday(d: Column | str) -> Column:
    """The Friday on or after ``d``: the label of a week that ends on Friday."""
    d = _col(d)
    return F.date_add(d, (F.lit(FRIDAY) - F.weekday(d) + 7) % 7)


def days_before(d: Column | str, n: int | Column) -> Column:
    """DATE-2: ``d`` minus ``n`` days."""
    return F.date_sub(_col(d), n if isinstance(n, Column) else F.lit(n))


def lookback_offsets(d: Column | str, mode: str = "corrected", days: int = 7) -> Column:
    """DATE-3: candidate offsets (days before ``d``) in trial order.

    ``corrected``: weekdays only, nearest first, within ``days`` days.
    ``reference``: the source job's order.  Its weekend shift is applied
    twice: trial ``i`` lands ``i+2`` days back when ``d - i`` is a Saturday
    and ``i+4`` when it is a Sunday, so near business days can be skipped
    and some are tried twice.
    """
    d = _col(d)
    idx = F.sequence(F.lit(0), F.lit(days - 1))
    if mode == "corrected":
        return F.filter(idx, lambda o: F.weekday(F.date_sub(d, o)) < 5)
    if mode == "reference":
        return F.transform(idx, lambda i: i + F.when(F.weekday(F.date_sub(d, i)) == 6, 4)
                           .when(F.weekday(F.date_sub(d, i)) == 5, 2).otherwise(0))
    raise ValueError(f"unknown lookback mode {mode!r}")


def format_compact(d: Column | str) -> Column:
    """DATE-4: ``yyyyMMdd``."""
    return F.date_format(_col(d), "yyyyMMdd")


def format_iso(d: Column | str) -> Column:
    """DATE-4: ``yyyy-MM-dd``."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def format_stamp(ts: Column | str) -> Column:
    """DATE-4: ``yyyy-MM-dd_HH-mm-ss`` (landing file names)."""
    return F.date_format(_col(ts), "yyyy-MM-dd_HH-mm-ss")


def as_of_date(as_of: str | None = None) -> Column:
    """DATE-5: the run date as a column; ``current_date()`` only as default."""
    return F.to_date(F.lit(as_of)) if as_of else F.current_date()
