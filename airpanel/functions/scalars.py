"""Scalar expressions: weather physics, forecast post-processing, payload access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wind_u(speed: Column, direction: Column) -> Column:
    return -speed * F.sin(F.radians(direction))


def wind_v(speed: Column, direction: Column) -> Column:
    return -speed * F.cos(F.radians(direction))


def ventilation_index(speed: Column, mixing_height: Column) -> Column:
    return speed * mixing_height


def inversion_strength(upper: Column, lower: Column) -> Column:
    """Positive when temperature rises with height."""
    return upper - lower


def clip(value: Column, low: float = 0.0, high: float = 500.0) -> Column:
    """Bound a forecast level; NULL stays NULL (greatest/least alone would skip it)."""
    return F.when(
        value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def gain_pct(baseline: Column, rmse: Column) -> Column:
    """Improvement over a baseline error in percent; NULL for a missing or non-positive baseline."""
    return F.when(baseline > 0, (baseline - rmse) / baseline * 100)


def band_low(value: Column, rmse: Column) -> Column:
    return value - F.coalesce(rmse, F.lit(0.0))


def band_high(value: Column, rmse: Column) -> Column:
    return value + F.coalesce(rmse, F.lit(0.0))


def alert_severity(is_now: Column, first_horizon: Column) -> Column:
    """'now', 'expected' (first crossing within a day) or 'possible'."""
    return (F.when(is_now, "now")
            .when(first_horizon <= 24, "expected")
            .when(first_horizon.isNotNull(), "possible"))


def json_number(document: Column, path: str, default: float | None = None) -> Column:
    """A number inside a JSON document; a missing key or junk gives the default."""
    value = F.get_json_object(document, path).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def json_text(document: Column, path: str, default: str | None = None) -> Column:
    value = F.get_json_object(document, path)
    return value if default is None else F.coalesce(value, F.lit(default))
