"""Clock and paging arithmetic. The present time is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import PAGE_ROWS, REBUILD_HOUR, REBUILD_MINUTES


def lookback_minutes(now: Column, last: Column) -> Column:
    """Whole minutes since the last run plus two; both times in epoch seconds."""
    return ((now - last) / 60).cast("bigint") + 2


def time_text(at: Column) -> Column:
    """A time as the service writes it into its answers and rows."""
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def page_count(total: Column) -> Column:
    """Pages to fetch; an exact multiple of the page size has one empty page more."""
    return F.floor(total / PAGE_ROWS) + 1


def hhmm(ts: Column) -> Column:
    return F.date_format(ts, "HHmm")


def hhmm_hour(text: Column) -> Column:
    return F.left(text, F.lit(2)).cast("int")


def hhmm_minute(text: Column) -> Column:
    return F.substr(text, F.lit(3)).cast("int")


def in_rebuild_window(ts: Column) -> Column:
    return (F.hour(ts) == REBUILD_HOUR) & (F.minute(ts) < REBUILD_MINUTES)


def minute_number(ts: Column) -> Column:
    """Minutes since 1970 of a time without zone; slices the rows of hot keys."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a time without zone."""
    return minute_number(ts) * 60 + F.second(ts)
