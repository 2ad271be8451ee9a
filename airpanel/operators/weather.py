"""Weather: derived variables and the hour join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.functions import scalars
from airpanel.operators.relational import drop_stale_weather
from airpanel.operators.timegrid import trailing_mean
from airpanel.schemas import HOUR, SERIES


def derive_weather(weather: DataFrame) -> DataFrame:
    """Dispersion variables, each only when its inputs exist.

    The wind mean is over the last 24 hours of an hourly archive, at least 12 present.
    """
    have = set(weather.columns)
    added = {}
    if {"temperature_100m", "temperature_2m"} <= have:
        added["inversion_strength"] = scalars.inversion_strength(
            F.col("temperature_100m"), F.col("temperature_2m"))
    if "wind_speed_10m" in have:
        if "boundary_layer_height" in have:
            added["ventilation_index"] = scalars.ventilation_index(
                F.col("wind_speed_10m"), F.col("boundary_layer_height"))
        added["wind_speed_24h_mean"] = trailing_mean("wind_speed_10m", 24, 12)
        if "wind_direction_10m" in have:
            added["wind_u"] = scalars.wind_u(F.col("wind_speed_10m"), F.col("wind_direction_10m"))
            added["wind_v"] = scalars.wind_v(F.col("wind_speed_10m"), F.col("wind_direction_10m"))
    return weather.withColumns(added) if added else weather


def join_weather(features: DataFrame, weather: DataFrame) -> DataFrame:
    """Left equi-join on series and UTC hour.

    Legacy weather columns, and columns of an earlier weather join, are dropped
    first. No join hint: the archive is broadcast only when its measured size is
    small; otherwise adaptive execution sort-merges and splits a skewed hour.
    """
    new_columns = [c for c in weather.columns if c not in (SERIES, HOUR)]
    return drop_stale_weather(features).drop(*new_columns).join(weather, [SERIES, HOUR], "left")


def join_coverage(joined: DataFrame, weather_columns: list[str], warn_below: float = 90.0) -> DataFrame:
    """Percent of rows with every weather column, and whether that is too low."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in weather_columns])
    covered = joined.agg(
        F.count("*").alias("n_rows"),
        (F.count_if(complete) * 100.0 / F.count("*")).alias("coverage_pct"))
    return covered.withColumn("is_low", F.col("coverage_pct") < warn_below)
