"""Time expressions. Instants are UTC; ``hr`` is the integer UTC hour; ``ts`` is local wall clock."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "Asia/Karachi"


def parse_ts_utc(text: Column) -> Column:
    """Naive or zoned text, with or without fraction -> instant. Naive means UTC, junk is NULL.

    Relies on a UTC session zone (see ``session.configure``).
    """
    return F.try_to_timestamp(text)


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def utc_hour(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def hour_number(instant: Column) -> Column:
    """Hours since the epoch, floored (also before 1970)."""
    return F.floor(F.unix_seconds(instant.cast("timestamp")) / 3600).cast("bigint")


def hour_to_utc(hr: Column) -> Column:
    """Hour number -> naive UTC timestamp."""
    return F.timestamp_seconds(hr * 3600).cast("timestamp_ntz")


def hour_to_local(hr: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Hour number -> naive local wall clock."""
    return F.from_utc_timestamp(F.timestamp_seconds(hr * 3600), zone).cast("timestamp_ntz")


def local_hour(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    local = F.from_utc_timestamp(instant.cast("timestamp"), zone)
    return F.date_trunc("hour", local).cast("timestamp_ntz")


def local_day(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant.cast("timestamp"), zone))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """hour, day, month and day_of_week (Monday is 0)."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "day_of_week": F.weekday(ts),
    }


def cyclical(ts: Column, with_hour: bool = True) -> dict[str, Column]:
    """sin/cos of the hour of day and of the day of year, so midnight and new year are continuous."""
    turn = 2 * math.pi
    day = F.dayofyear(ts)
    parts = {
        "doy_sin": F.sin(F.lit(turn) * day / 365.25),
        "doy_cos": F.cos(F.lit(turn) * day / 365.25),
    }
    if with_hour:
        parts["hour_sin"] = F.sin(F.lit(turn) * F.hour(ts) / 24)
        parts["hour_cos"] = F.cos(F.lit(turn) * F.hour(ts) / 24)
    return parts
