"""The one feature definition: training, incremental updates and serving all call these functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.functions.timefn import cyclical
from airpanel.operators.timegrid import (
    calendar_gaps, daily_calendar, daily_mean, fill_gaps, min_readings, prior_mean, series_window)
from airpanel.schemas import (
    DAILY_FEATURES, DAILY_HORIZONS, HOUR, HOURLY_FEATURES, HOURLY_HORIZONS, POLLUTANTS, SERIES)

__all__ = [
    "add_hourly_features", "add_daily_features", "calendar_gaps", "change_rate",
    "change_rate_latest", "daily_frame", "delta_targets", "deviations", "diffs", "lags",
    "long_targets", "prior_means_of_integers", "same_hour_norm", "training_rows",
]


def lags(col: str, steps: list[int], order: str = HOUR) -> dict[str, Column]:
    """Value ``n`` positions back; on a complete grid that is ``n`` hours back."""
    w = series_window(order)
    return {f"{col}_lag{n}": F.lag(col, n).over(w) for n in steps}


def diffs(col: str, steps: list[int], order: str = HOUR) -> dict[str, Column]:
    w = series_window(order)
    return {f"{col}_diff{n}": F.col(col) - F.lag(col, n).over(w) for n in steps}


def deviations(col: str, norms: dict[str, str]) -> dict[str, Column]:
    """``{output name: norm column}`` -> value minus norm."""
    return {name: F.col(col) - F.col(norm) for name, norm in norms.items()}


def same_hour_norm(col: str, order: str = HOUR) -> Column:
    """Deviation from the mean of this hour on the three previous days; NULL if any is missing."""
    w = series_window(order)
    return F.col(col) - (
        F.lag(col, 24).over(w) + F.lag(col, 48).over(w) + F.lag(col, 72).over(w)) / 3.0


def prior_means_of_integers(
    df: DataFrame, col: str, windows: dict[str, tuple[int, int]], order: str = HOUR
) -> DataFrame:
    """Means over the ``n`` positions before the current one, ``{name: (n, min_periods)}``.

    For whole-numbered columns such as the index. Running sums of whole numbers
    are exact in a double, so a window is the difference of two running sums:
    constant work per row and window instead of ``n`` additions, and the same
    bits whatever the order of evaluation. Needs a complete grid.
    """
    w = series_window(order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    summed = (df
              .withColumn("_sum", F.coalesce(F.sum(col).over(running), F.lit(0.0)))
              .withColumn("_cnt", F.count(col).over(running)))
    means = {}
    for name, (n, min_periods) in windows.items():
        count = (F.coalesce(F.lag("_cnt", 1).over(w), F.lit(0))
                 - F.coalesce(F.lag("_cnt", n + 1).over(w), F.lit(0)))
        total = (F.coalesce(F.lag("_sum", 1).over(w), F.lit(0.0))
                 - F.coalesce(F.lag("_sum", n + 1).over(w), F.lit(0.0)))
        means[name] = F.when(count >= min_periods, total / count)
    return summed.withColumns(means).drop("_sum", "_cnt")


def add_hourly_features(grid: DataFrame) -> DataFrame:
    """Grid with ``aqi`` and local ``ts`` -> the 26 model features. Nothing looks past its own hour."""
    rolled = prior_means_of_integers(
        grid, "aqi",
        {"aqi_roll24": (24, 18), "aqi_roll72": (72, 48), "aqi_roll168": (168, 120)})
    return (rolled
            .withColumns({
                **lags("aqi", [1, 2, 3, 24, 48, 168]),
                **diffs("aqi", [1, 3]),
                "aqi_minus_hourly_norm": same_hour_norm("aqi"),
            })
            .withColumns({
                **deviations("aqi", {
                    "aqi_minus_roll24": "aqi_roll24", "aqi_minus_roll168": "aqi_roll168"}),
                **cyclical(F.col("ts")),
                "day_of_week": F.weekday("ts"),
            }))


def delta_targets(
    df: DataFrame, horizons: list[int] | None = None, col: str = "aqi", order: str = HOUR
) -> DataFrame:
    """Adds ``target_h`` (value ``h`` positions ahead) and ``delta_h`` (its change)."""
    w = series_window(order)
    horizons = horizons or HOURLY_HORIZONS
    return (df
            .withColumns({f"target_{h}": F.lead(col, h).over(w) for h in horizons})
            .withColumns({f"delta_{h}": F.col(f"target_{h}") - F.col(col) for h in horizons}))


def long_targets(
    df: DataFrame, horizons: list[int] | None = None, col: str = "aqi", order: str = HOUR
) -> DataFrame:
    """One row per position and horizon with ``target`` and ``delta``; absent targets are dropped."""
    w = series_window(order)
    horizons = horizons or HOURLY_HORIZONS
    wide = df.withColumn("_targets", F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.lead(col, h).over(w).alias("target"))
        for h in horizons]))
    return (wide
            .withColumn("_t", F.explode("_targets"))
            .select(*df.columns, "_t.horizon", "_t.target",
                    (F.col("_t.target") - F.col(col)).alias("delta"))
            .filter(F.col("target").isNotNull()))


def training_rows(
    features: DataFrame,
    names: list[str] | None = None,
    horizons: list[int] | None = None,
    order: str = HOUR,
) -> DataFrame:
    """Complete feature rows in long form, ready for folds.

    Targets are looked up before incomplete rows are dropped: a target only needs
    its own index, not the features of its hour.
    """
    names = names or HOURLY_FEATURES
    return long_targets(features, horizons, order=order).na.drop(subset=names)


def daily_frame(
    readings: DataFrame,
    n_min: int = 18,
    limit: int = 2,
    by: str = "row",
    **mean_options: object,
) -> DataFrame:
    """Readings -> daily rows with short holes filled and the 16 daily features.

    ``by='row'`` keeps lags by row, without inserting missing days; ``by='calendar'``
    puts the series on a full calendar first.
    """
    daily = min_readings(daily_mean(readings, **mean_options), n_min)
    if by == "calendar":
        daily = daily_calendar(daily).join(daily, [SERIES, "date"], "left")
    elif by != "row":
        raise ValueError(f"unknown daily mode {by!r}")
    w = series_window("date")
    positioned = daily.withColumn("pos", F.row_number().over(w))
    filled = fill_gaps(positioned, ["aqi", *POLLUTANTS], limit, position="pos")
    return add_daily_features(filled)


def add_daily_features(daily: DataFrame) -> DataFrame:
    """Daily rows with ``pos`` (row number) and ``aqi`` -> the daily model features."""
    return (daily
            .withColumns({
                "aqi_change_rate": diffs("aqi", [1], "pos")["aqi_diff1"],
                **lags("aqi", [1, 2], "pos"),
                "aqi_rolling_mean_3": prior_mean("aqi", 3, 2, "pos"),
                "aqi_rolling_mean_7": prior_mean("aqi", 7, 5, "pos"),
            })
            .withColumns({
                **deviations("aqi", {
                    "aqi_minus_rolling_3": "aqi_rolling_mean_3",
                    "aqi_minus_rolling_7": "aqi_rolling_mean_7"}),
                **cyclical(F.col("date"), with_hour=False),
            }))


def daily_training_rows(daily: DataFrame, horizons: list[int] | None = None) -> DataFrame:
    return training_rows(daily, DAILY_FEATURES, horizons or DAILY_HORIZONS, order="pos")


def change_rate(deduped: DataFrame, time: str = "fetched_at") -> DataFrame:
    """Row-over-row index change per series, NULL counted as 0.

    Expects at most one row per series and hour (``dedupe_hour_prefer_live``), which
    keeps a window partition bounded by the calendar.
    """
    step = F.col("aqi") - F.lag("aqi").over(series_window(time))
    return deduped.withColumn("aqi_change_rate", F.coalesce(step, F.lit(0).cast("double")))


def change_rate_latest(new: DataFrame, history: DataFrame, time: str = "fetched_at") -> DataFrame:
    """Change of each new row against the latest stored row of its series; 0 without one."""
    latest = history.groupBy(SERIES).agg(
        F.max_by(F.col("aqi").cast("double"), F.col(time)).alias("_latest"))
    return (new.join(latest, SERIES, "left")
            .withColumn("aqi_change_rate", F.coalesce(F.col("aqi") - F.col("_latest"), F.lit(0.0)))
            .drop("_latest"))
