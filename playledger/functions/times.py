"""Weekly windows and epoch conversions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_WEEK = datetime(2026, 1, 25, tzinfo=timezone.utc)
WEEK = timedelta(days=7)


def week_start(moment: Column) -> Column:
    """Sunday 00:00 of the week a timestamp falls in."""
    day = F.to_date(moment)
    return F.date_sub(day, F.dayofweek(day) - F.lit(1))


def week_window(key: str) -> tuple[datetime, datetime]:
    """`[start, end)` of the weekly partition named by its first day."""
    start = datetime.fromisoformat(key).replace(tzinfo=timezone.utc)
    if start.weekday() != 6:
        raise ValueError(f"{key} is not a Sunday")
    return start, start + WEEK


def last_complete_week(now: datetime) -> str | None:
    """Key of the newest finished week, or None before the first one ended."""
    finished = (now.astimezone(timezone.utc) - FIRST_WEEK) // WEEK
    if finished < 1:
        return None
    return (FIRST_WEEK + (finished - 1) * WEEK).date().isoformat()


def epoch_seconds(moment: datetime) -> int:
    return int(moment.timestamp())


def epoch_millis(moment: datetime) -> int:
    return int(moment.timestamp() * 1000)


def in_range(moment: Column, start: datetime | None, end: datetime | None) -> Column:
    """Half-open range test; an open bound is None."""
    test = F.lit(True)
    if start is not None:
        test = test & (moment >= F.timestamp_seconds(F.lit(epoch_seconds(start))))
    if end is not None:
        test = test & (moment < F.timestamp_seconds(F.lit(epoch_seconds(end))))
    return test
