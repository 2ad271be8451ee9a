"""Splitting one long series over several tasks.

Hourly rows are bounded by the calendar, so a series normally fits one window
partition. Where few, very long series should use many executors, rows can be
cut into time buckets: each bucket also receives the rows its windows reach into
(its halo), windows run per bucket, and halo rows are dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.schemas import FEATURE_LOOKBACK_HOURS, HOUR, HOURLY_HORIZONS, SERIES


def split_with_halo(
    df: DataFrame,
    width: int = 30 * 24,
    lookback: int = FEATURE_LOOKBACK_HOURS,
    lookahead: int = max(HOURLY_HORIZONS),
) -> DataFrame:
    """Replaces the series key by struct<id, bucket>; a row goes to every bucket that needs it.

    Interpolate before splitting: its reach is not bounded by a number of hours.
    """
    first = F.floor((F.col(HOUR) - lookahead) / width)
    last = F.floor((F.col(HOUR) + lookback) / width)
    return (df.withColumn("_bucket", F.explode(F.sequence(first, last)))
            .withColumn(SERIES, F.struct(F.col(SERIES).alias("id"), F.col("_bucket").alias("bucket")))
            .withColumn("_is_core", F.floor(F.col(HOUR) / width) == F.col("_bucket"))
            .drop("_bucket"))


def drop_halo(df: DataFrame) -> DataFrame:
    """Keeps each row once, in its own bucket, and restores the series key."""
    return df.filter("_is_core").drop("_is_core").withColumn(SERIES, F.col(f"{SERIES}.id"))
