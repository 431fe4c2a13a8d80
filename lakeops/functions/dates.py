"""Time functions and batch windows. "Today" is always an argument."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end."""
    whole = lambda c: F.unix_seconds(F.date_trunc("second", c.cast("timestamp")))
    return whole(end) - whole(start)


def last_n_days(ts: Column, n: int, today: Column) -> Column:
    """At or after the start of the day n days before today."""
    return ts >= F.date_sub(today.cast("date"), n).cast("timestamp_ntz")


def epoch_or_iso_to_ts(text: Column) -> Column:
    """A timestamp from epoch seconds in digits or from an ISO string."""
    text = text.cast("string")
    return F.when(text.rlike("^[0-9]+$"), F.timestamp_seconds(text.try_cast("bigint"))).otherwise(
        F.try_to_timestamp(text)
    )


def try_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def first_timestamp(candidates: list[Column], path_parts: list[Column]) -> Column:
    """First candidate that is a timestamp, else the date spelled by year, month and day path parts."""
    from_path = F.try_to_timestamp(F.concat_ws("-", *path_parts), F.lit("yyyy-MM-dd"))
    return F.coalesce(*[F.try_to_timestamp(c) for c in candidates], from_path)


def business_date(ts: Column, zone: str = "America/Los_Angeles", days_back: int = 1) -> Column:
    """Local date of a UTC instant, minus the days the snapshot lags behind."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(ts, zone)), days_back)


def local_stamp(ts: Column) -> Column:
    """Timestamp without zone, as the test tables hold it."""
    return ts.cast("timestamp_ntz")


# Half-open windows [start, end) for batch jobs.


def daily_window(day: date) -> tuple[datetime, datetime]:
    start = datetime(day.year, day.month, day.day)
    return start, start + timedelta(days=1)


def weekly_window(day: date, starts_on_sunday: bool = False) -> tuple[datetime, datetime]:
    back = (day.weekday() + 1) % 7 if starts_on_sunday else day.weekday()
    start = daily_window(day - timedelta(days=back))[0]
    return start, start + timedelta(days=7)


def month_start(day: date, months: int = 0) -> datetime:
    index = day.year * 12 + day.month - 1 + months
    return datetime(index // 12, index % 12 + 1, 1)


def monthly_window(day: date) -> tuple[datetime, datetime]:
    return month_start(day), month_start(day, 1)


def padded_window(
    start: datetime, end: datetime, before: timedelta = timedelta(hours=3),
    after: timedelta = timedelta(days=1), full_refresh: bool = False,
) -> tuple[datetime | None, datetime | None]:
    """Window of an incremental model with room for late rows; no bounds on a full refresh."""
    return (None, None) if full_refresh else (start - before, end + after)


def lookback_window(start: datetime, end: datetime, hours: int = 3) -> tuple[datetime, datetime]:
    return start - timedelta(hours=hours), end


def previous_and_current_month(today: date) -> tuple[datetime, datetime]:
    return month_start(today, -1), month_start(today, 1)


def last_full_week(today: date) -> tuple[datetime, datetime]:
    this_week = weekly_window(today)[0]
    return this_week - timedelta(days=7), this_week


def backfill_window(today: date, days: int = 31) -> tuple[datetime, datetime]:
    """The last n whole days, as one range for one run."""
    end = daily_window(today)[0]
    return end - timedelta(days=days), end


def trailing_hours(now: datetime, hours: int = 24) -> tuple[datetime, datetime]:
    end = now.replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=hours), end


def in_window(ts: Column, window: tuple[datetime | None, datetime | None]) -> Column:
    """Half-open window predicate on literals, so it is pushed down to the scan."""
    start, end = window
    out = F.lit(True)
    if start is not None:
        out = out & (ts >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
    if end is not None:
        out = out & (ts < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
    return out
