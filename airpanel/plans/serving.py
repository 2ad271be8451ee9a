"""Serving tables: forecast, outlook, alert, history, readings, importance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.functions.aqi import categorise
from airpanel.functions.scalars import alert_severity, band_high, band_low, clip
from airpanel.models.evaluate import CELL
from airpanel.models.linear import predict_linear
from airpanel.models.trees import PACKED_FIELDS, predict_trees
from airpanel.operators.relational import (
    breaches, latest_row, require_columns, tail_window, top_features)
from airpanel.schemas import HOURLY_FEATURES, SERIES


def attach_skill(forecast: DataFrame, skill: DataFrame, keys: tuple[str, ...] = (SERIES, "horizon")) -> DataFrame:
    """Left lookup of cross-validated error and gain; a horizon without skill gets NULLs."""
    wanted = skill.select(*keys, "rmse", "gain", F.col("model").alias("_skill_model"))
    return forecast.join(wanted, list(keys), "left")


def predicted_delta(features: list[str]) -> Column:
    """Change predicted by a registered model row (``model``, ``k``, ``intercept``, ``weights``, ``tree_value``)."""
    damped = {"damped_reversion": "aqi_minus_roll24", "damped_persistence": "aqi_minus_rolling_7"}
    delta = (F.when(F.col("model").isin("persistence", "persistence_baseline"), F.lit(0.0))
             .when(F.col("model").isin("ridge", "elastic_net"), predict_linear(features))
             .when(F.col("model").isin("hist_gbr", "random_forest"), F.col("tree_value"))
             .when(F.col("model") == "boosted_residual", predict_linear(features) + F.col("tree_value"))
             .when(F.col("model") == "ensemble", (predict_linear(features) + F.col("tree_value")) / 2))
    if "aqi_lag24" in features:
        delta = delta.when(F.col("model") == "diurnal_naive", F.col("aqi_lag24") - F.col("aqi"))
    if "aqi_minus_rolling_7" in features:
        delta = delta.when(F.col("model") == "climatology_7d", -F.col("aqi_minus_rolling_7"))
    for model, deviation in damped.items():
        if deviation in features:
            delta = delta.when(F.col("model") == model, F.col("k") * -F.col(deviation))
    return delta


def tree_values(latest: DataFrame, models: DataFrame, features: list[str]) -> DataFrame:
    """(series, horizon, tree_value) where the registered model has trees; one row each."""
    own = models.where(F.col("trees").isNotNull()).select(
        *CELL, F.lit(0).alias("fold"), F.lit("tree_value").alias("model"), *[F.col(f"trees.{c}").alias(c) for c in PACKED_FIELDS])
    rows = latest.select(SERIES, *features).join(own.select(*CELL, "fold"), SERIES)
    return predict_trees(rows, own, features, ["tree_value"]).drop("fold")


def latest_features(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The newest complete feature row of each series."""
    names = names or HOURLY_FEATURES
    return latest_row(require_columns(features, names), complete=names)


def forecast(
    latest: DataFrame, models: DataFrame, skill: DataFrame, names: list[str] | None = None, unit: str = "hours",
) -> DataFrame:
    """One row per series and horizon: level = clip(current + predicted change); ``unit`` is hours or days.

    Every kind of registered model is dispatched to its parameters: columns for baselines and linear models, the
    stored trees for the others. A model that yields no number for a series leaves that horizon out.
    """
    names = names or HOURLY_FEATURES
    for c, kind in {"k": "double", "intercept": "double", "weights": "array<double>"}.items():
        if c not in models.columns:
            models = models.withColumn(c, F.lit(None).cast(kind))
    scored = latest.join(models.drop("trees"), SERIES)
    if "trees" in models.columns:
        scored = scored.join(tree_values(latest, models, names), CELL, "left")
    else:
        scored = scored.withColumn("tree_value", F.lit(None).cast("double"))
    scored = scored.withColumn("_delta", predicted_delta(names))
    time = "ts" if unit == "hours" else "date"
    ahead = (F.col(time) + F.make_dt_interval(hours=F.col("horizon")) if unit == "hours"
             else F.date_add(time, F.col("horizon")))
    points = scored.filter(F.col("_delta").isNotNull()).select(
        SERIES, "horizon", ahead.alias(time), clip(F.col("aqi") + F.col("_delta")).alias("aqi"),
        F.col("model").alias("_kind"))
    return attach_skill(points, skill).select(
        SERIES, "horizon", time, "aqi", "rmse", "gain",
        F.coalesce("_skill_model", "_kind").alias("model"))


def interval_band(points: DataFrame) -> DataFrame:
    return points.withColumns({
        "low": band_low(F.col("aqi"), F.col("rmse")),
        "high": band_high(F.col("aqi"), F.col("rmse"))})


def daily_outlook(points: DataFrame, latest: DataFrame) -> DataFrame:
    """The current reading (error 0) and the forecast, grouped into calendar days per series."""
    now = latest.select(SERIES, "ts", "aqi", F.lit(0.0).alias("rmse"))
    today = latest.select(SERIES, F.to_date("ts").alias("_today"))
    rows = now.unionByName(points.select(SERIES, "ts", "aqi", "rmse"))
    days = rows.groupBy(SERIES, F.to_date("ts").alias("date")).agg(
        F.avg("aqi").alias("avg"), F.min("aqi").alias("low"), F.max("aqi").alias("high"),
        F.avg("rmse").alias("err"), F.count("*").alias("n"))
    return (days.join(today, SERIES)
            .withColumn("is_today", F.col("date") == F.col("_today")).drop("_today")
            .orderBy(SERIES, "date"))


def tomorrow(outlook: DataFrame) -> DataFrame:
    """The first day of the outlook that is not today."""
    ahead = outlook.filter(~F.col("is_today"))
    rest = [c for c in outlook.columns if c != SERIES]
    return (ahead.groupBy(SERIES).agg(F.min_by(F.struct(*rest), "date").alias("_d"))
            .select(SERIES, *[F.col(f"_d.{c}").alias(c) for c in rest]))


def alert(points: DataFrame, latest: DataFrame, threshold: float = 150) -> DataFrame:
    """At most one row per series: the worst coming breach, else an unhealthy current reading."""
    order = F.struct("aqi", -F.col("horizon"))
    coming = breaches(points, threshold).groupBy(SERIES).agg(
        F.max_by(F.struct("aqi", "ts", "rmse"), order).alias("_w"),
        F.min("horizon").alias("first_horizon"),
        F.min_by("ts", "horizon").alias("starts"),
        F.count("*").alias("n_breaches"))
    forecasted = points.select(SERIES).distinct()
    joined = (latest.select(SERIES, F.col("ts").alias("_now"), F.col("aqi").alias("_current"))
              .join(forecasted, SERIES, "left_semi")
              .join(coming, SERIES, "left"))
    is_now = F.col("first_horizon").isNull()
    chosen = joined.filter(F.col("first_horizon").isNotNull() | (F.col("_current") > threshold))
    return (chosen
            .withColumn("peak", F.when(is_now, F.col("_current")).otherwise(F.col("_w.aqi")))
            .withColumn("_c", categorise("peak"))
            .select(
                SERIES, "peak", F.col("_c.label").alias("label"), F.col("_c.colour").alias("colour"),
                F.col("_c.guidance").alias("guidance"),
                F.when(is_now, F.col("_now")).otherwise(F.col("_w.ts")).alias("at"),
                F.coalesce(F.col("_w.rmse"), F.lit(0.0)).alias("err"),
                is_now.alias("is_now"),
                F.when(is_now, 0).otherwise(F.col("first_horizon")).alias("first_horizon"),
                "starts", F.coalesce("n_breaches", F.lit(0)).alias("n_breaches"),
                alert_severity(is_now, F.col("first_horizon")).alias("severity")))


def recent_history(grid: DataFrame, days: int = 5, value: str = "aqi") -> DataFrame:
    """Non-null values of the last days of each series."""
    return tail_window(grid.select(SERIES, "ts", value), days).filter(F.col(value).isNotNull())


def latest_readings(latest: DataFrame, columns: list[str]) -> DataFrame:
    """(series, parameter, value) of what the newest row measured."""
    have = [c for c in columns if c in latest.columns]
    return (latest.select(SERIES, *[F.col(c).cast("double").alias(c) for c in have])
            .unpivot([SERIES], have, "parameter", "value")
            .filter(F.col("value").isNotNull()))


def importance_top(tables: list[DataFrame | None], n: int = 10, by: str = SERIES) -> DataFrame | None:
    """The largest magnitudes of the first importance table that exists."""
    for table in tables:
        if table is not None:
            return top_features(table, n, by=by).withColumn("value", F.abs("value"))
    return None
