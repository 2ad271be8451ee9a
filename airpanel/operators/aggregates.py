"""Statistics of a panel: profiles, coverage, variability, gaps, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.operators.timegrid import series_window
from airpanel.schemas import HOUR, POLLUTANTS, SERIES
from airpanel.session import stored


def series_stats(df: DataFrame, time: str = "ts", value: str = "aqi") -> DataFrame:
    """Rows, time range, mean and sample standard deviation per series."""
    return df.groupBy(SERIES).agg(
        F.count("*").alias("n_rows"),
        F.min(time).alias("first_ts"),
        F.max(time).alias("last_ts"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"))


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over the rows that have both; NaN if one of them never varies there, NULL without such rows.

    ``corr`` divides by zero for a column that never varies, which is an error in ANSI mode. Extremes tell such a column:
    its sum of squares may keep a rest of rounding when partial aggregates are merged.
    """
    xs, ys = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    fixed = (F.min(xs) == F.max(xs)) | (F.min(ys) == F.max(ys)) | (spread == 0)
    return F.when(fixed, F.lit(float("nan"))).otherwise(F.regr_sxy(y, x) / spread)


# A bucket of values is this part of an octave, so values in [0, 1) spread like others.
_OCTAVE_PARTS = 1 << 16


def _value_bucket(value: Column) -> Column:
    """An order-preserving whole number per value, of bounded relative width."""
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    part = (octave + 1100) * _OCTAVE_PARTS + F.floor((size / F.pow(F.lit(2.0), octave) - 1) * _OCTAVE_PARTS)
    return F.when(value > 0, part).when(value < 0, -part).otherwise(F.lit(0)).cast("bigint")


def describe(df: DataFrame, col: str, by: str = SERIES) -> DataFrame:
    """count, mean, std, min, quartiles (linear between ranks), max per group; a group without values has a count of 0.

    The rows are read once, for the counts of each value, which are stored; everything else comes from them. Exact
    quartiles without holding a group in one buffer: ranks are found in two levels, buckets of a group (at most
    65,536 an octave, whatever the number of rows) and the values of one bucket.
    """
    value = F.col(col).cast("double")
    counts = stored(df.groupBy(by, value.alias("_v")).agg(F.count(col).alias("_n"))
                    .withColumn("_b", F.coalesce(_value_bucket(F.col("_v")), F.lit(0).cast("bigint"))), "value-counts")
    whole = Window.partitionBy(by)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy(by, "_b").agg(F.sum("_n").alias("_bn"), F.sum(F.col("_n") * F.col("_v")).alias("_bs"))
    buckets = buckets.select(
        by, "_b",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_start"),
        F.sum("_bn").over(whole).alias("_total"),
        (F.sum("_bs").over(whole) / F.sum("_bn").over(whole)).alias("_mean"))
    inside = Window.partitionBy(by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    # Groups may be null, so they are compared as structs would be.
    other = buckets.select(F.col(by).alias("_by"), F.col("_b").alias("_bb"), "_start", "_total", "_mean")
    ranked = (counts.join(other, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_b") == F.col("_bb")))
              .withColumn("_upto", F.col("_start") + F.sum("_n").over(inside)))

    def at_rank(rank):
        # Smallest value whose cumulative count passes a zero-based rank.
        return F.min(F.when((F.col("_upto") > rank) & (F.col("_n") > 0), F.col("_v")))

    picks = []
    for percent in (25, 50, 75):
        position = (F.col("_total") - 1) * (percent / 100)
        picks += [at_rank(F.floor(position)).alias(f"_lo{percent}"),
                  at_rank(F.ceil(position)).alias(f"_hi{percent}"),
                  F.max(position - F.floor(position)).alias(f"_f{percent}")]
    apart = F.sum(F.col("_n") * (F.col("_v") - F.col("_mean")) ** 2)
    found = ranked.groupBy(by).agg(
        F.sum("_n").alias("count"), F.first("_mean").alias("mean"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        apart.alias("_apart"), *picks)

    def quartile(percent):
        low, high, part = (F.col(f"_{name}{percent}") for name in ("lo", "hi", "f"))
        return low + (high - low) * part

    return found.select(
        by, "count", "mean", F.when(F.col("count") > 1, F.sqrt(F.col("_apart") / (F.col("count") - 1))).alias("std"), "min",
        quartile(25).alias("q25"), quartile(50).alias("q50"), quartile(75).alias("q75"), "max")


def null_profile(df: DataFrame, threshold_pct: float = 0.0, top: int | None = None) -> DataFrame:
    """NULL count and percent per column in one pass; above a threshold, worst first."""
    total = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = (total.unpivot(["_rows"], df.columns, "column_name", "n_null")
            .select("column_name", F.col("n_null").cast("bigint").alias("n_null"),
                    F.try_divide(F.col("n_null") * 100.0, F.col("_rows")).alias("null_pct"))
            .filter(F.col("null_pct") > threshold_pct)
            .orderBy(F.col("null_pct").desc(), "column_name"))
    return long if top is None else long.limit(top)


def coverage(df: DataFrame, time: str = "observed_at") -> DataFrame:
    """Rows against the hourly slots of the whole days spanned, in percent, per series."""
    stats = df.groupBy(SERIES).agg(
        F.count("*").alias("n_rows"), F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    seconds = F.unix_seconds(F.col("_hi").cast("timestamp")) - F.unix_seconds(
        F.col("_lo").cast("timestamp"))
    return (stats.withColumn("span_days", F.floor(seconds / 86400).cast("bigint"))
            .select(SERIES, "n_rows", "span_days",
                    (F.col("n_rows") * 100.0 / F.greatest(F.col("span_days") * 24, F.lit(1)))
                    .alias("coverage_pct")))


def regime_variability(daily: DataFrame) -> DataFrame:
    """Sample standard deviation of the day-over-day index change per series, year and quarter."""
    change = F.col("aqi") - F.lag("aqi").over(series_window("date"))
    return (daily.withColumn("_change", change)
            .groupBy(SERIES, F.year("date").alias("year"), F.quarter("date").alias("quarter"))
            .agg(F.count("_change").alias("n_changes"), F.stddev_samp("_change").alias("change_std")))


def worst_gap(grid: DataFrame, days: int = 14) -> DataFrame:
    """The window of ``days`` whole days with the most missing hours per series (earliest on ties).

    Counts are whole numbers, so the sliding count is a difference of running
    counts. Only complete windows compete.
    """
    width = days * 24
    running = series_window().rowsBetween(Window.unboundedPreceding, 0)
    counted = (grid
               .withColumn("_missing", F.sum(F.when(F.col("is_observed"), 0).otherwise(1)).over(running))
               .withColumn("_rows", F.row_number().over(series_window())))
    before = F.coalesce(F.lag("_missing", width).over(series_window()), F.lit(0))
    windows = (counted.withColumn("_in", F.col("_missing") - before)
               .filter(F.col("_rows") >= width))
    order = F.struct(F.col("_in"), -F.col(HOUR))
    return (windows.groupBy(SERIES).agg(
        F.max("_in").alias("n_missing"), F.max_by(HOUR, order).alias("end_hr"))
        .select(SERIES, "n_missing", "end_hr",
                (F.col("n_missing") * 100.0 / width).alias("missing_pct")))


def cell_counts(readings: DataFrame, time: str = "observed_at") -> DataFrame:
    """Raw rows, distinct hours, sentinels and capped concentrations per series.

    Reduced to hours first, so the distinct count needs no second pass over raw rows.
    """
    from airpanel.functions.timefn import hour_number

    negatives = sum((F.when(F.col(c) < 0, 1).otherwise(0) for c in POLLUTANTS), F.lit(0))
    hours = (readings.groupBy(SERIES, hour_number(F.col(time)).alias(HOUR))
             .agg(F.count("*").alias("_n"), F.sum(negatives).alias("_neg"),
                  F.count_if(F.col("pm25") > 500.4).alias("_cap")))
    return hours.groupBy(SERIES).agg(
        F.sum("_n").alias("n_rows"),
        F.count("*").alias("n_hours"),
        F.sum("_neg").alias("n_sentinels"),
        F.sum("_cap").alias("n_capped"))
