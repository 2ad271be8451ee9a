"""Hourly and daily grids: means, explicit gaps, short-gap interpolation, sentinels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel.functions.aqi import aqi_capped, aqi_from_pm25
from airpanel.functions.timefn import DEFAULT_ZONE, hour_number, hour_to_local, local_day
from airpanel.schemas import HOUR, POLLUTANTS, SERIES


def series_window(order: str = HOUR) -> Window:
    """The one window family of the package.

    It only ever runs on rows already reduced to one per series and hour (or
    day), so a partition is bounded by the calendar (8,766 rows a year), however
    many raw readings a hot series has.
    """
    return Window.partitionBy(SERIES).orderBy(order)


def mask_sentinels(df: DataFrame, cols: list[str]) -> DataFrame:
    """Negative readings (such as -9999) become NULL."""
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in cols})


def hourly_mean(
    readings: DataFrame,
    cols: list[str] | None = None,
    mask: str = "after_mean",
    time: str = "observed_at",
) -> DataFrame:
    """Mean per series and UTC hour; collapses duplicate readings.

    ``mask`` says where sentinels turn NULL: ``after_mean`` (one sentinel voids its
    hour), ``before_mean`` (it is skipped) or ``none``.
    """
    cols = cols or POLLUTANTS
    if mask not in ("after_mean", "before_mean", "none"):
        raise ValueError(f"unknown mask mode {mask!r}")
    source = readings.select(SERIES, hour_number(F.col(time)).alias(HOUR), *cols)
    if mask == "before_mean":
        source = mask_sentinels(source, cols)
    means = source.groupBy(SERIES, HOUR).agg(*[F.avg(c).alias(c) for c in cols])
    return mask_sentinels(means, cols) if mask == "after_mean" else means


def hourly_mean_all(readings: DataFrame, time: str = "observed_at") -> DataFrame:
    """The same over every numeric column."""
    numeric = [f.name for f in readings.schema.fields
               if isinstance(f.dataType, T.NumericType) and f.name not in (SERIES, HOUR)]
    return hourly_mean(readings, numeric, mask="none", time=time)


def since(df: DataFrame, cutoff: str | None, ts: str = "ts") -> DataFrame:
    """Regime filter on local time; None keeps everything."""
    if cutoff is None:
        return df
    return df.filter(F.col(ts) >= F.lit(cutoff).cast("timestamp_ntz"))


def hourly_grid(hourly: DataFrame) -> DataFrame:
    """One row per hour between the first and last hour of each series; missing hours are NULL.

    Each observed row emits itself and the empty hours up to the next observed
    one. That needs no calendar table and no join: one exchange of the already
    aggregated rows. Adds ``is_observed``.
    """
    w = series_window()
    values = [c for c in hourly.columns if c not in (SERIES, HOUR)]
    own = F.col("_hour") == F.col(HOUR)
    spans = (hourly
             .withColumn("_last", F.coalesce(F.lead(HOUR).over(w) - 1, F.col(HOUR)))
             .withColumn("_hour", F.explode(F.sequence(HOUR, "_last"))))
    return spans.select(
        SERIES, F.col("_hour").alias(HOUR),
        *[F.when(own, F.col(c)).alias(c) for c in values],
        own.alias("is_observed"))


def fill_gaps(
    df: DataFrame,
    cols: list[str],
    limit: int,
    position: str = HOUR,
    strict: bool = False,
) -> DataFrame:
    """Linear interpolation of the first ``limit`` NULLs of each interior run.

    Longer runs are filled partly; with ``strict`` they are left alone. Nothing is
    filled before the first or after the last value. ``position`` is the integer
    axis: the hour on a grid, a row number on an unaligned series.
    """
    over = f"OVER (PARTITION BY {SERIES} ORDER BY {position})"
    back = (f"OVER (PARTITION BY {SERIES} ORDER BY {position} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    neighbours: dict[str, Column] = {}
    for c in cols:
        known = f"CASE WHEN `{c}` IS NOT NULL THEN {position} END"
        neighbours[f"_{c}_pv"] = F.expr(f"last(`{c}`, true) {back}")
        neighbours[f"_{c}_pp"] = F.expr(f"last({known}, true) {back}")
        # The next known value through an ignore-nulls offset: linear in the
        # series, while a frame that looks ahead without bound is quadratic.
        neighbours[f"_{c}_nv"] = F.expr(f"lead(`{c}`, 1) IGNORE NULLS {over}")
        neighbours[f"_{c}_np"] = F.expr(f"lead({known}, 1) IGNORE NULLS {over}")
    framed = df.select("*", *[e.alias(name) for name, e in neighbours.items()])

    def filled(c: str) -> Column:
        pv, pp = F.col(f"_{c}_pv"), F.col(f"_{c}_pp")
        nv, np_ = F.col(f"_{c}_nv"), F.col(f"_{c}_np")
        step = F.col(position) - pp
        allowed = step <= limit
        if strict:
            allowed = (np_ - pp - 1) <= limit
        value = pv + (nv - pv) * step / (np_ - pp)
        return F.when(F.col(c).isNotNull(), F.col(c)).when(allowed & nv.isNotNull(), value)

    return framed.select(*[filled(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def trailing_mean(col: str, n: int, min_periods: int, order: str = HOUR) -> Column:
    """Mean of the last ``n`` positions, the current one included."""
    frame = series_window(order).rangeBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) >= min_periods, F.avg(col).over(frame))


def prior_mean(col: str, n: int, min_periods: int, order: str = HOUR) -> Column:
    """Mean of the ``n`` positions before the current one."""
    frame = series_window(order).rangeBetween(-n, -1)
    return F.when(F.count(col).over(frame) >= min_periods, F.avg(col).over(frame))


def add_aqi(grid: DataFrame, mode: str = "epa24h") -> DataFrame:
    """Adds ``aqi`` (DOUBLE): from the 24 h mean concentration, or from the hour itself.

    The mean is rounded to 6 places before its truncation to one decimal, so the
    last bits of a floating-point sum cannot move a value across a step.
    """
    if mode == "epa24h":
        grid = grid.withColumn("_pm", F.round(trailing_mean("pm25", 24, 18), 6))
    elif mode == "instant":
        grid = grid.withColumn("_pm", F.col("pm25"))
    else:
        raise ValueError(f"unknown target mode {mode!r}")
    return grid.withColumn("aqi", aqi_capped("_pm").cast("double")).drop("_pm")


def hourly_frame(
    readings: DataFrame,
    cutoff: str | None = None,
    mode: str = "epa24h",
    mask: str = "after_mean",
    zone: str = DEFAULT_ZONE,
    limit: int = 3,
    time: str = "observed_at",
) -> DataFrame:
    """Readings -> gap-explicit hourly grid with short gaps filled and the index attached."""
    return grid_frame(hourly_mean(readings, mask=mask, time=time), cutoff, mode, zone, limit)


def grid_frame(
    hourly: DataFrame,
    cutoff: str | None = None,
    mode: str = "epa24h",
    zone: str = DEFAULT_ZONE,
    limit: int = 3,
) -> DataFrame:
    """The same chain from hourly means on; batch, incremental and serving all pass through here."""
    if cutoff is not None:
        hourly = since(hourly.withColumn("ts", hour_to_local(F.col(HOUR), zone)), cutoff).drop("ts")
    filled = fill_gaps(hourly_grid(hourly), POLLUTANTS, limit)
    return add_aqi(filled, mode).withColumn("ts", hour_to_local(F.col(HOUR), zone))


def daily_mean(
    readings: DataFrame,
    zone: str = DEFAULT_ZONE,
    time: str = "observed_at",
    aqi_mode: str = "mean_concentration",
) -> DataFrame:
    """Pollutant means and row count per local day. Sentinels are kept, as in the hourly 'none' mode.

    The index comes from the mean concentration, or with ``aqi_mode='mean_hourly'``
    is the mean of the readings' own index column. Means and counts come from one
    aggregation, so they are aligned by construction.
    """
    own_aqi = aqi_mode == "mean_hourly"
    cols = POLLUTANTS + (["aqi"] if own_aqi else [])
    daily = (readings
             .select(SERIES, local_day(F.col(time), zone).alias("date"), *cols)
             .groupBy(SERIES, "date")
             .agg(*[F.avg(c).alias(c) for c in cols], F.count("*").alias("n_readings")))
    if own_aqi:
        return daily
    return daily.withColumn("aqi", aqi_from_pm25("pm25").cast("double"))


def min_readings(daily: DataFrame, n: int = 18) -> DataFrame:
    """Drop days with fewer raw rows."""
    return daily.filter(F.col("n_readings") >= n)


def daily_calendar(daily: DataFrame) -> DataFrame:
    """Every day between the first and last one of each series."""
    return (daily.groupBy(SERIES)
            .agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
            .select(SERIES, F.explode(F.sequence("_lo", "_hi")).alias("date")))


def calendar_gaps(daily: DataFrame) -> DataFrame:
    """Days of the calendar without a row."""
    return daily_calendar(daily).join(daily.select(SERIES, "date"), [SERIES, "date"], "left_anti")
