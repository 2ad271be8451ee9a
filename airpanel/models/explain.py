"""Why a model predicts what it predicts: attributions and how linear the responses are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airpanel.models.evaluate import CELL
from airpanel.models.trees import predict_trees, tree_contributions
from airpanel.schemas import HOUR


def linear_attribution(
    rows: DataFrame, coefficients: DataFrame, features: list[str], background: DataFrame | None = None
) -> DataFrame:
    """Long table (feature, x, attribution) with attribution = weight * (x - mean x).

    For a linear model this closed form is the exact additive attribution. Means
    are over ``background`` (the training rows; else the given rows) per series and horizon.
    """
    means = (rows if background is None else background).groupBy(*CELL).agg(F.array(*[F.avg(c) for c in features]).alias("_means"))
    named = F.array(*[F.lit(c) for c in features])
    values = F.array(*[F.col(c).cast("double") for c in features])
    return (rows.join(means, CELL)
            .join(coefficients.select(*CELL, "weights"), CELL)
            .select(*CELL, F.explode(F.arrays_zip(
                named.alias("feature"), values.alias("x"), F.col("_means").alias("m"),
                F.col("weights").alias("w"))).alias("_z"))
            .select(*CELL, "_z.feature", "_z.x",
                    (F.col("_z.w") * (F.col("_z.x") - F.col("_z.m"))).alias("attribution")))


def tree_attribution(rows: DataFrame, models: DataFrame, features: list[str], order: str = HOUR) -> DataFrame:
    """Long table (series, horizon, fold, model, feature, x, attribution) of tree models: path contributions of every row.

    ``rows`` has the fold whose models are meant. Per row, attributions and ``base`` of ``tree_contributions`` add up
    to the prediction.
    """
    named = F.array(*[F.lit(f) for f in features])
    return (tree_contributions(rows, models, features, order)
            .select(*CELL, "fold", "model", F.explode(F.arrays_zip(
                named.alias("feature"), F.col("x").alias("x"), F.col("contributions").alias("attribution"))).alias("_z"))
            .select(*CELL, "fold", "model", "_z.feature", "_z.x", "_z.attribution"))


def mean_abs_attribution(attributions: DataFrame, by: list[str] | None = None) -> DataFrame:
    return attributions.groupBy(*(by or ["feature"])).agg(F.avg(F.abs("attribution")).alias("mean_abs"))


def response_linearity(attributions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Straight-line fit of attribution on the feature value; r2 near 1 means a linear response."""
    return attributions.groupBy(*(by or ["feature"])).agg(
        F.regr_slope("attribution", "x").alias("slope"),
        F.regr_intercept("attribution", "x").alias("intercept"),
        F.regr_r2("attribution", "x").alias("r2"))


def permutation_importance(
    models: DataFrame, rows: DataFrame, features: list[str], name: str, seed: int = 42, label: str = "delta"
) -> DataFrame:
    """(series, horizon, feature, increase): how much squared error grows when a feature is another row's.

    Every row gets one partner within its series and horizon by hash order; each feature in turn takes the
    partner's value, and all variants go through the models of their ``fold`` in one pass.
    """
    draw = F.xxhash64(HOUR, F.lit(seed))
    by_time = Window.partitionBy(*CELL).orderBy(HOUR)
    by_hash = Window.partitionBy(*CELL).orderBy(draw, HOUR)
    left = rows.select(
        *CELL, "fold", *features, F.col(label).cast("double").alias("_label"), F.row_number().over(by_time).alias("_i"))
    right = rows.select(
        *CELL, *[F.col(c).alias(f"_o_{c}") for c in features], F.row_number().over(by_hash).alias("_i"))
    paired = left.join(right, [*CELL, "_i"])
    variants = paired.withColumn("swapped", F.explode(F.array(*[F.lit(c) for c in ["", *features]])))
    swapped = variants.select(*CELL, "fold", "swapped", "_label", *[
        F.when(F.col("swapped") == c, F.col(f"_o_{c}")).otherwise(F.col(c)).cast("double").alias(c)
        for c in features])
    error = (F.col(name) - F.col("_label")) ** 2
    losses = predict_trees(swapped, models, features, [name], keep=["swapped", "_label"]).groupBy(*CELL, "swapped").agg(
        F.avg(error).alias("_mse"))
    # A window holds one row per feature.
    base = F.max(F.when(F.col("swapped") == "", F.col("_mse"))).over(Window.partitionBy(*CELL))
    return (losses.withColumn("increase", F.col("_mse") - base).filter("swapped <> ''")
            .select(*CELL, F.col("swapped").alias("feature"), "increase"))
