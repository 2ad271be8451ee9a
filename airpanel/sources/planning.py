"""What still has to be loaded: chunk calendars and loaded ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.functions.timefn import parse_ts_utc
from airpanel.schemas import HOUR, SERIES

EARLIEST_HOUR = 446_232  # fixed value: 2020-11-27T00:00Z, the first hour the history source serves


def backfill_plan(
    ends: DataFrame, days: int, chunk_days: int = 7, earliest: int = EARLIEST_HOUR
) -> DataFrame:
    """Contiguous chunks [chunk_start, chunk_end) in hours per series, the last one clipped.

    ``ends`` has one row per series with ``end_hr``; the window starts ``days``
    earlier, but not before ``earliest``.
    """
    width = chunk_days * 24
    start = F.greatest(F.col("end_hr") - days * 24, F.lit(earliest).cast("bigint"))
    chunks = (ends.withColumn("_start", start)
              .filter(F.col("_start") < F.col("end_hr"))
              .withColumn("chunk_start", F.explode(F.sequence(
                  F.col("_start"), F.col("end_hr") - 1, F.lit(width).cast("bigint")))))
    return chunks.select(
        SERIES, "chunk_start", F.least(F.col("chunk_start") + width, "end_hr").alias("chunk_end"))


def date_chunks(windows: DataFrame, chunk_days: int = 365) -> DataFrame:
    """Inclusive date chunks between ``first_date`` and ``last_date`` per series."""
    start = F.explode(F.sequence(
        F.col("first_date"), F.col("last_date"), F.make_dt_interval(F.lit(chunk_days))))
    return (windows.select("*", start.alias("chunk_first"))
            .select(SERIES, "chunk_first",
                    F.least(F.date_add("chunk_first", chunk_days - 1), "last_date").alias("chunk_last")))


def chunks_to_load(plan: DataFrame, loaded: DataFrame) -> DataFrame:
    """Chunks with missing hours, and how many: a chunk is re-requested until all its hours arrived."""
    hours = plan.withColumn(
        HOUR, F.explode(F.sequence(F.col("chunk_start"), F.col("chunk_end") - 1)))
    return (hours.join(loaded.select(SERIES, HOUR), [SERIES, HOUR], "left_anti")
            .groupBy(SERIES, "chunk_start", "chunk_end")
            .agg(F.count("*").alias("n_missing")))


def target_window(df: DataFrame, fetched: Column | None = None) -> DataFrame:
    """First and last date of the parseable fetch times per series; no row means nothing parses."""
    instant = parse_ts_utc(F.col("fetched_at")) if fetched is None else fetched
    return (df.select(SERIES, F.to_date(instant).alias("_d"))
            .filter(F.col("_d").isNotNull())
            .groupBy(SERIES)
            .agg(F.min("_d").alias("first_date"), F.max("_d").alias("last_date")))
