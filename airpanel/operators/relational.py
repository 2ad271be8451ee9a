"""Projections, filters, sorts, limits, set operations and keyed merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.functions.timefn import parse_ts_utc
from airpanel.schemas import HOUR, LEGACY_WEATHER, SERIES


# -- projections and predicates -------------------------------------------------------------

def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fails while the plan is built, naming every missing column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")
    return df


def select_features(df: DataFrame, cols: Sequence[str], pk: Sequence[str] = (SERIES, "ts")) -> DataFrame:
    """Key plus features, in order, without repeats, only columns that exist."""
    return df.select(*[c for c in dict.fromkeys([*pk, *cols]) if c in df.columns])


def drop_stale_weather(df: DataFrame) -> DataFrame:
    return df.drop(*LEGACY_WEATHER)


def observed_at(df: DataFrame) -> DataFrame:
    """Adds ``observed_at``: station time, else fetch time. The station column may be absent."""
    def instant(name: str) -> Column:
        text = dict(df.dtypes)[name] == "string"
        return parse_ts_utc(F.col(name)) if text else F.col(name).cast("timestamp")

    if "station_timestamp" not in df.columns:
        return df.withColumn("observed_at", instant("fetched_at"))
    return df.withColumn(
        "observed_at", F.coalesce(instant("station_timestamp"), instant("fetched_at")))


def drop_unparseable(df: DataFrame, col: str = "observed_at") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def unparseable_count(df: DataFrame, col: str = "observed_at") -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(col).isNull()).alias("n_dropped"))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def split_by_presence(
    df: DataFrame, col: str, n_with: int, n_without: int, order: Sequence[str]
) -> DataFrame:
    """The first rows that have a value and the first that have none (``has_value`` tells)."""
    present = df.filter(F.col(col).isNotNull()).orderBy(*order).limit(n_with)
    absent = df.filter(F.col(col).isNull()).orderBy(*order).limit(n_without)
    return (present.withColumn("has_value", F.lit(True))
            .unionByName(absent.withColumn("has_value", F.lit(False))))


def latest_per_key(df: DataFrame, key: str = SERIES, time: str = "ts", name: str = "latest") -> DataFrame:
    return df.groupBy(key).agg(F.max(time).alias(name))


def newer_than(df: DataFrame, stored: DataFrame, time: str = "ts") -> DataFrame:
    """Rows after the latest stored time of their series; a new series passes whole.

    The right side has one row per series. Spark broadcasts it when its size
    statistics allow and joins by shuffle otherwise.
    """
    latest = latest_per_key(stored, time=time, name="_latest")
    joined = df.join(latest, SERIES, "left")
    return joined.filter(F.col("_latest").isNull() | (F.col(time) > F.col("_latest"))).drop("_latest")


def tail_window(df: DataFrame, days: int, time: str = "ts") -> DataFrame:
    """Rows of each series from ``days`` before its newest row on."""
    latest = latest_per_key(df, time=time, name="_latest")
    cutoff = F.col("_latest") - F.make_dt_interval(F.lit(days))
    return df.join(latest, SERIES).filter(F.col(time) >= cutoff).drop("_latest")


def breaches(forecast: DataFrame, threshold: float = 150) -> DataFrame:
    """Strictly above the threshold."""
    return forecast.filter(F.col("aqi") > threshold)


def for_series(df: DataFrame, series: str) -> DataFrame:
    return df.filter(F.col(SERIES) == series)


WINNER_PREFIX = "WINNER:"


def candidate_rows(metrics: DataFrame) -> DataFrame:
    """Metric rows of real candidates, without the marked winner copies."""
    return metrics.filter(~F.col("model").startswith(WINNER_PREFIX))


# -- sorts, limits, top-k -------------------------------------------------------------------

def sort_by_time(df: DataFrame, *cols: str) -> DataFrame:
    return df.orderBy(*(cols or (SERIES, "ts")))


def latest_row(df: DataFrame, complete: Sequence[str] = (), time: str = HOUR) -> DataFrame:
    """Newest row per series, or the newest one whose ``complete`` columns are all present."""
    source = complete_cases(df, complete) if complete else df
    rest = [c for c in df.columns if c != SERIES]
    newest = source.groupBy(SERIES).agg(F.max_by(F.struct(*rest), F.col(time)).alias("_row"))
    return newest.select(SERIES, *[F.col(f"_row.{c}").alias(c) for c in rest])


def top_features(table: DataFrame, n: int, by: str = "horizon", value: str = "value") -> DataFrame:
    """The ``n`` features of largest magnitude per group; names break ties.

    A group is one feature list, so the ranking window is bounded by the model width.
    """
    w = Window.partitionBy(by).orderBy(F.abs(value).desc(), F.col("feature"))
    return (table.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n))


def top_features_overall(table: DataFrame, n: int, value: str = "value") -> DataFrame:
    """The ``n`` features of largest mean magnitude across horizons."""
    return (table.groupBy("feature").agg(F.avg(F.abs(value)).alias("mean_abs"))
            .orderBy(F.col("mean_abs").desc(), "feature").limit(n))


def first_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def peak_and_first_crossing(forecast: DataFrame, threshold: float = 150) -> DataFrame:
    """Per series: the highest breach (earliest on ties) and the earliest breaching horizon."""
    order = F.struct("aqi", -F.col("horizon"))
    return (breaches(forecast, threshold).groupBy(SERIES).agg(
        F.max_by("aqi", order).alias("peak"),
        F.max_by("horizon", order).alias("peak_horizon"),
        F.min("horizon").alias("first_horizon"),
        F.count("*").alias("n_breaches")))


def sample_rows(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] = (SERIES, HOUR)) -> DataFrame:
    """A repeatable sample of at most ``n`` rows, chosen by a hash that other engines share, in time order."""
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))).cast("binary"))
    return (df.withColumn("_draw", draw).orderBy("_draw", *keys).limit(n)
            .drop("_draw").orderBy(*keys))


# -- set operations and merges --------------------------------------------------------------

def append_rows(*frames: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_keyed(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: existing rows whose key is not redelivered, plus the new rows."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def missing_keys(wanted: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(present.select(*keys), list(keys), "left_anti")
