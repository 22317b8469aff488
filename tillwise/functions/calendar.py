"""Calendar expressions: truncation, extraction, whole-day and whole-month distances."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def week_of(ts: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(F.to_date(ts), "week")


def week_ending_sunday(ts: Column) -> Column:
    """The Sunday that closes the week, used as a bucket label."""
    return F.date_add(F.trunc(F.to_date(ts), "week"), 6)


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
    ).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970, also for timestamps without zone (read as UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def instant(value) -> Column:
    """A literal point in time. Without zone, so that it compares with either timestamp
    type without casting the column, and the filter can reach the scan."""
    return F.lit(value).cast("timestamp_ntz")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed time in days, rounded down (also for negative spans)."""
    return F.floor(
        (micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_DAY))
    ).cast("bigint")


def order_calendar(ts: Column) -> dict[str, Column]:
    """Calendar columns of the order fact table; Monday is day 0."""
    weekday = F.weekday(ts)
    return {
        "year": F.year(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
        "day_of_week": weekday.cast("bigint"),
        "hour": F.hour(ts).cast("bigint"),
        "quarter": F.quarter(ts).cast("bigint"),
        "is_weekend": (weekday >= 5).cast("bigint"),
    }


def series_calendar(date: Column) -> dict[str, Column]:
    """Calendar columns of a daily series."""
    weekday = F.weekday(date)
    return {
        "day_of_week": weekday.cast("bigint"),
        "day_of_month": F.dayofmonth(date).cast("bigint"),
        "week_of_year": F.weekofyear(date).cast("bigint"),
        "month": F.month(date).cast("bigint"),
        "quarter": F.quarter(date).cast("bigint"),
        "year": F.year(date).cast("bigint"),
        "is_weekend": (weekday >= 5).cast("bigint"),
        "is_month_start": (F.dayofmonth(date) == 1).cast("bigint"),
        "is_month_end": (date == F.last_day(date)).cast("bigint"),
    }


def cyclic(month: Column, weekday: Column) -> dict[str, Column]:
    turn = 2.0 * math.pi
    return {
        "month_sin": F.sin(F.lit(turn) * month / F.lit(12.0)),
        "month_cos": F.cos(F.lit(turn) * month / F.lit(12.0)),
        "dow_sin": F.sin(F.lit(turn) * weekday / F.lit(7.0)),
        "dow_cos": F.cos(F.lit(turn) * weekday / F.lit(7.0)),
    }
