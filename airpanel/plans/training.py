"""Training runs: readings -> fold frame -> fits of all candidates -> one table of scores -> refitted winners."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.models import evaluate, linear, trees
from airpanel.models.evaluate import CELL
from airpanel.operators.features import (
    add_hourly_features, daily_frame, daily_training_rows, training_rows)
from airpanel.operators.timegrid import hourly_frame
from airpanel.schemas import DAILY_FEATURES, HOUR, HOURLY_FEATURES, HOURLY_HORIZONS, SERIES
from airpanel.session import stored

#: Candidates that add a tree part to the fit of this linear model.
LINEAR_PART = {"boosted_residual": "ridge", "ensemble": "ridge"}
#: Candidates whose tree part is that of another one.
TREE_PART = {"hist_gbr": "hist_gbr", "boosted_residual": "boosted_residual", "ensemble": "hist_gbr",
             "random_forest": "random_forest"}


def _lookup(parts: dict[str, str]) -> Column:
    """The part that the candidate in ``model`` has; null for the others."""
    found = F.lit(None).cast("string")
    for name, part in parts.items():
        found = F.when(F.col("model") == name, F.lit(part)).otherwise(found)
    return found


@dataclass(frozen=True)
class HourlyConfig:
    """Settings of an hourly run; the defaults are the published ones."""

    cutoff: str | None = "2025-07-01"
    mode: str = "epa24h"
    mask: str = "after_mean"
    folds: int = 4
    min_train: int = evaluate.MIN_TRAIN_HOURLY
    horizons: tuple[int, ...] = tuple(HOURLY_HORIZONS)
    linear_models: tuple[str, ...] = ("ridge", "elastic_net")
    tree_models: Mapping[str, trees.Boosting | trees.Forest] = field(default_factory=lambda: dict(trees.HOURLY_TREES))


class Panel(NamedTuple):
    """What an evaluation leaves: fold scores of all candidates, the fits behind them, and the fold frame."""

    scores: DataFrame
    coefficients: DataFrame
    trees: DataFrame
    folded: DataFrame


@dataclass(frozen=True)
class _Kind:
    """What differs between hourly and daily candidates."""

    features: list[str]
    order: str
    deviation: str
    candidates: list[str]
    rows_per_split: int
    spread: bool  # whether the folds of a series are fitted in tasks of their own

    def baselines(self) -> dict[str, Column]:
        return evaluate.daily_baselines() if self is DAILY else evaluate.hourly_baselines()


HOURLY = _Kind(HOURLY_FEATURES, HOUR, "aqi_minus_roll24", evaluate.HOURLY_CANDIDATES, 500, False)
DAILY = _Kind(DAILY_FEATURES, "pos", "aqi_minus_rolling_7", evaluate.DAILY_CANDIDATES, 40, True)


def hourly_features(readings: DataFrame, config: HourlyConfig) -> DataFrame:
    return add_hourly_features(
        hourly_frame(readings, config.cutoff, config.mode, config.mask))


def linear_scores(
    training: DataFrame, coefficients: DataFrame, k: int, min_train: int,
    features: list[str], models: tuple[str, ...], order: str, candidates: list[str],
) -> DataFrame:
    """Fold scores of linear models: coefficients joined to their test rows, native arithmetic."""
    folded = evaluate.expanding_folds(training, k, min_train, order).filter("is_scored")
    wide = linear.coefficients_wide(coefficients.filter("fold > 0"), models)
    test = folded.withColumnRenamed("block", "fold").join(wide, [*CELL, "fold"])
    return evaluate.score(
        test, {m: linear.predict_linear(features, f"{m}_") for m in models}, candidates)


def candidate_predictions(
    folded: DataFrame, coefficients: DataFrame, models: DataFrame, linear_models: tuple[str, ...],
    tree_models: tuple[str, ...], kind: _Kind = HOURLY,
) -> tuple[DataFrame, list[str]]:
    """(test rows with one predicted change per candidate, the candidates' names); columns are named after candidates."""
    test = (evaluate.with_reversion_k(folded, kind.deviation).filter("is_scored")
            .withColumnRenamed("block", "fold"))
    predictions = kind.baselines()
    if linear_models:
        wide = linear.coefficients_wide(coefficients.filter("fold > 0"), linear_models)
        test = test.join(wide, [*CELL, "fold"], "left")
        predictions |= {m: linear.predict_linear(kind.features, f"{m}_") for m in linear_models}
    names = list(predictions)
    # Features and candidates share no name; level and target stay for the scores.
    kept = ["aqi", "target", "delta", "n_rows", "k", kind.order]
    test = test.select(*CELL, "fold", *[c for c in kept if c not in kind.features], *kind.features,
                       *[p.cast("double").alias(n) for n, p in predictions.items()])
    if tree_models:
        test = trees.predict_trees(test, models, kind.features, tree_models, keep=[*kept, *names])
        if "boosted_residual" in tree_models:
            test = test.withColumn("boosted_residual", F.col("ridge") + F.col("boosted_residual"))
        names += tree_models
        if "hist_gbr" in tree_models and "ridge" in linear_models:
            test = test.withColumn("ensemble", trees.mean_ensemble(["ridge", "hist_gbr"]))
            names.append("ensemble")
    return test, names


def evaluate_panel(
    training: DataFrame, k: int, min_train: int, linear_models: tuple[str, ...],
    tree_models: Mapping[str, trees.Boosting | trees.Forest], kind: _Kind = HOURLY,
) -> Panel:
    """All candidates on every series, horizon and fold.

    The fold frame is computed once; each family of candidates is fitted on it for all cells side by side and stored, and
    one aggregation scores all predictions.
    """
    folded = stored(evaluate.expanding_folds(training, k, min_train, kind.order), "folds")
    coefficients = stored(linear.fit_folds(
        folded, k, min_train, kind.features, linear_models, kind.rows_per_split), "coefficients")
    models = stored(trees.fit_trees(
        folded.where(F.col("n_rows") >= 2 * min_train), kind.features, tree_models, range(1, k + 1), min_train, coefficients, kind.spread), "trees")
    test, names = candidate_predictions(folded, coefficients, models, linear_models, tuple(tree_models), kind)
    scores = evaluate.score(test, {n: F.col(n) for n in names}, kind.candidates)
    return Panel(stored(scores, "scores"), coefficients, models, folded)


def evaluate_hourly(features: DataFrame, config: HourlyConfig) -> Panel:
    """The eight hourly candidates on every horizon."""
    training = training_rows(features, HOURLY_FEATURES, list(config.horizons))
    return evaluate_panel(training, config.folds, config.min_train, config.linear_models, config.tree_models)


def evaluate_daily(
    readings: DataFrame, folds: int = 5, min_train: int = evaluate.MIN_TRAIN_DAILY,
    tree_models: Mapping[str, trees.Boosting | trees.Forest] | None = None, **frame: object,
) -> Panel:
    """The five daily candidates; inner splits grow by 40 rows."""
    training = daily_training_rows(daily_frame(readings, **frame))
    specs = trees.DAILY_TREES if tree_models is None else tree_models
    return evaluate_panel(training, folds, min_train, ("ridge",), specs, DAILY)


def final_models(
    panel: Panel, min_train: int, tree_models: Mapping[str, trees.Boosting | trees.Forest], kind: _Kind = HOURLY,
) -> DataFrame:
    """Winner per series and horizon with the parameters of its fit on all complete rows.

    ``k`` belongs to damped baselines, ``intercept`` and ``weights`` to linear models and to winners that build on one,
    ``trees`` (a struct of arrays) to winners with a tree part. Only winners' trees are grown.
    """
    winners = stored(evaluate.pick_winner(evaluate.fold_summary(panel.scores)).select(*CELL, "model", "n_rows"), "winners")
    k = evaluate.fit_reversion_k(panel.folded, kind.deviation).filter("fold = 0").drop("fold")
    mapped = winners.withColumn("linear_part", F.coalesce(_lookup(LINEAR_PART), F.col("model"))).withColumn(
        "tree_part", _lookup(TREE_PART))
    fits = panel.coefficients.filter("fold = 0").select(
        *CELL, F.col("model").alias("linear_part"), "alpha", "l1_ratio", "intercept", "weights")
    grown = None
    for name, spec in tree_models.items():
        cells = panel.folded.join(mapped.where(F.col("tree_part") == name).select(*CELL), CELL, "left_semi")
        own = trees.fit_trees(cells, kind.features, {name: spec}, [0], min_train, panel.coefficients)
        grown = own if grown is None else grown.unionByName(own)
    out = mapped.join(k, CELL, "left").join(fits, [*CELL, "linear_part"], "left")
    if grown is None:
        out = out.withColumn("trees", F.lit(None).cast(trees.PACKED))
    else:
        out = out.join(grown.select(*CELL, F.struct(*trees.PACKED_FIELDS).alias("trees")), CELL, "left")
    damped = F.col("model").isin("damped_reversion", "damped_persistence")
    return out.select(SERIES, "horizon", "model", F.col("n_rows").alias("n_train"), F.when(damped, F.col("k")).alias("k"),
                      "alpha", "l1_ratio", "intercept", "weights", "trees")
