"""Ridge and elastic net for every series and horizon from one pass over the rows.

The rows of an expanding-window evaluation fall into cells: runs of rows that no
outer or inner split ever separates. Spark reduces the rows to one moment matrix
per series, horizon and cell. Every training and validation set is a union of
cells, so scaling, all penalties, inner validation and outer fits need only sums
of those 28 x 28 matrices, whatever the number of rows behind them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.models.evaluate import CELL, expanding_folds
from airpanel.schemas import HOUR, HOURLY_FEATURES, SERIES

# Executors get the helpers below with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Penalty grids of the two linear models.
RIDGE_ALPHAS = np.logspace(0, 4, 30)
L1_RATIOS = [0.1, 0.5, 0.7, 0.9, 0.95, 1.0]
N_NET_ALPHAS = 100
NET_PATH_RATIO = 1e-3
NET_MAX_STEPS = 2_000


def inner_splits(n_train: Column, rows_per_split: int = 500) -> Column:
    """Inner folds for a training size: one per ``rows_per_split`` rows, from 3 to 5."""
    return F.greatest(F.lit(3), F.least(F.lit(5), F.floor(n_train / rows_per_split)))


def add_cells(folded: DataFrame, k: int, rows_per_split: int = 500) -> DataFrame:
    """Adds ``cell``: outer block plus, for each fold and the final fit, the inner block.

    A cell is written as numbers with dots between: number 0 is the outer block, number
    ``f`` the inner block inside the training set of fold ``f`` (0 when the row is not
    in it), number ``k + 1`` the inner block of the fit on all rows. Inner blocks
    count from 1; no number is bounded, whatever the number of folds.
    """
    step = F.expr(f"n_rows div {k + 1}")
    df = folded.withColumn("_step", step).withColumn("_first", F.col("n_rows") - k * F.col("_step"))

    def inner(n_train: Column) -> Column:
        splits = inner_splits(n_train, rows_per_split).cast("bigint")
        size = F.floor(n_train / (splits + 1))
        start = n_train - splits * size
        block = F.when(F.col("rn") < start, F.lit(1)).otherwise(
            F.floor((F.col("rn") - start) / F.greatest(size, F.lit(1))) + 2)
        return F.when(F.col("rn") < n_train, block).otherwise(F.lit(0))

    numbers = [F.col("block"), *[inner(F.col("_first") + (f - 1) * F.col("_step")) for f in range(1, k + 1)],
               inner(F.col("n_rows"))]
    cell = F.concat_ws(".", *[n.cast("bigint").cast("string") for n in numbers])
    return df.withColumn("cell", cell).drop("_step", "_first")


def moment_rows(celled: DataFrame, features: list[str]) -> DataFrame:
    """Partial moment matrices (upper triangles), one per Arrow batch, series, horizon and cell.

    Map-side reduction: the rows themselves are never shuffled.
    """
    size = len(features) + 2
    upper = np.triu_indices(size)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            group = batch.groupby([SERIES, "horizon", "cell"], sort=False).ngroup().to_numpy()
            order = np.argsort(group, kind="stable")
            z = np.ones((len(batch), size))
            z[:, 1:] = batch[[*features, "delta"]].to_numpy(float)[order]
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            ends = np.append(starts[1:], len(order))
            out = batch[[SERIES, "horizon", "cell"]].iloc[order[starts]].reset_index(drop=True)
            out["moments"] = [
                (z[s:e].T @ z[s:e])[upper] for s, e in zip(starts, ends, strict=True)]
            yield out

    slim = celled.select(
        SERIES, F.col("horizon").cast("int"), "cell",
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col("delta").cast("double").alias("delta"))
    return slim.mapInPandas(
        partial, f"{SERIES} STRING, horizon INT, cell STRING, moments ARRAY<DOUBLE>")


class _Moments:
    """Standardised sums of one training set, split by inner block."""

    def __init__(self, by_block: dict[int, np.ndarray]):
        total = sum(by_block.values())
        n = total[0, 0]
        mean = total[0, 1:-1] / n
        spread = np.diag(total)[1:-1] / n - mean**2
        # A constant column keeps scale 1, as a standard scaler does.
        scale = np.sqrt(np.where(spread > 1e-12 * np.maximum(mean**2, 1.0), spread, 1.0))
        change = np.eye(len(total))
        change[0, 1:-1] = -mean / scale
        change[1:-1, 1:-1] = np.diag(1.0 / scale)
        self.n, self.mean, self.scale = n, mean, scale
        self.blocks = {b: change.T @ m @ change for b, m in by_block.items()}
        self.total = sum(self.blocks.values())

    def inner(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(training, validation) sums of the expanding inner splits."""
        order = sorted(self.blocks)
        pairs, grown = [], self.blocks[order[0]]
        for b in order[1:]:
            pairs.append((grown, self.blocks[b]))
            grown = grown + self.blocks[b]
        return pairs


def _centred(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Centred X'X and X'y with the means, from raw sums."""
    n = m[0, 0]
    x_mean, y_mean = m[0, 1:-1] / n, m[0, -1] / n
    gram = m[1:-1, 1:-1] - n * np.outer(x_mean, x_mean)
    cross = m[1:-1, -1] - n * x_mean * y_mean
    return gram, cross, x_mean, y_mean


def _errors(m: np.ndarray, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Sum of squared errors of many linear models on one set, from its sums."""
    full = np.hstack([intercepts[:, None], weights])
    return (m[-1, -1] - 2 * full @ m[:-1, -1]
            + np.einsum("ai,ij,aj->a", full, m[:-1, :-1], full))


def _ridge_path(m: np.ndarray, alphas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gram, cross, x_mean, y_mean = _centred(m)
    values, vectors = np.linalg.eigh(gram)
    values = np.maximum(values, 0.0)
    rotated = vectors.T @ cross
    weights = (rotated[None, :] / (values[None, :] + alphas[:, None])) @ vectors.T
    return weights, y_mean - weights @ x_mean


def fit_ridge(training_sets: list[_Moments], alphas: np.ndarray = RIDGE_ALPHAS) -> list[tuple]:
    """Penalty by mean R2 over the inner splits, then a fit on everything, per training set."""
    fits = []
    for moments in training_sets:
        scores = []
        for train, valid in moments.inner():
            sse = _errors(valid, *_ridge_path(train, alphas))
            spread = valid[-1, -1] - valid[0, -1] ** 2 / valid[0, 0]
            scores.append(1 - sse / spread if spread > 0 else np.zeros(len(alphas)))
        alpha = alphas[int(np.argmax(np.mean(scores, axis=0)))]
        weights, intercepts = _ridge_path(moments.total, np.array([alpha]))
        fits.append((float(alpha), None, weights[0], float(intercepts[0]), True))
    return fits


def _descend(gram: np.ndarray, cross: np.ndarray, l1, l2, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Elastic-net minimisers of many problems at once, by an active-set search.

    ``gram`` is (feature, problem, feature), ``cross`` and the weights (feature,
    problem). A step solves each problem exactly for its nonzero weights and their signs. If a weight would change its
    sign, the step ends where the first one reaches zero, and that one leaves the set; otherwise the zero weight
    with the steepest gradient beyond ``l1`` enters. A problem is done when there is none. On a path of
    penalties the set rarely changes, so most problems take one step. Returns the weights and, per problem,
    whether it was done before ``NET_MAX_STEPS``.
    """
    full, c, w = gram.transpose(1, 0, 2), cross.T, start.T.copy()
    signs = np.sign(w)
    slack = 1e-6 * np.abs(c).max(axis=1)
    live = np.arange(len(w))
    diagonal = np.arange(w.shape[1])
    for _ in range(NET_MAX_STEPS):
        g, own, sign, p1 = full[live], w[live], signs[live], l1[live, None]
        active = sign != 0
        system = g * (active[:, :, None] & active[:, None, :])
        # The small term keeps exactly collinear features solvable.
        system[:, diagonal, diagonal] += np.where(active, l2[live, None] + 1e-9, 1.0)
        wanted = np.where(active, c[live] - p1 * sign, 0.0)
        aim = np.linalg.solve(system, wanted[:, :, None])[:, :, 0]
        wrong = active & (np.sign(aim) != sign)
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(wrong, np.where(own == aim, 0.0, own / (own - aim)), np.inf)
        first = reach.min(axis=1)
        stopped = np.isfinite(first)
        own = own + np.where(stopped, first, 1.0)[:, None] * (aim - own)
        left = wrong & (reach <= first[:, None] * (1 + 1e-12))
        own[left | ~active], sign[left] = 0.0, 0.0
        pull = c[live] - np.einsum("bij,bj->bi", g, own)
        excess = np.where(sign == 0, np.abs(pull) - p1, -np.inf)
        steepest = excess.argmax(axis=1)
        each = np.arange(len(live))
        done = ~stopped & (excess[each, steepest] <= slack[live])
        entering = ~stopped & ~done
        sign[each[entering], steepest[entering]] = np.sign(pull[each[entering], steepest[entering]])
        w[live], signs[live] = own, sign
        live = live[~done]
        if not len(live):
            break
    converged = np.ones(len(w), bool)
    converged[live] = False
    return w.T, converged


def fit_elastic_net(training_sets: list[_Moments]) -> list[tuple]:
    """Mix and penalty by mean squared error over the inner splits, then a fit on everything.

    The inner problems of all training sets and mixes go down the penalty path
    side by side.
    """
    ratios = np.array(L1_RATIOS)
    whole = [_centred(m.total) for m in training_sets]
    peaks = [np.abs(cross).max() / m.n for m, (_, cross, _, _) in zip(training_sets, whole, strict=True)]
    shape = np.logspace(0, np.log10(NET_PATH_RATIO), N_NET_ALPHAS)
    parts = [(i, _centred(train), train[0, 0], valid)
             for i, m in enumerate(training_sets) for train, valid in m.inner()]
    owner = np.repeat([i for i, *_ in parts], len(ratios))
    mix = np.tile(ratios, len(parts))
    top = np.array(peaks)[owner] / mix
    gram = np.repeat(np.stack([c[0] / n for _, c, n, _ in parts]), len(ratios), axis=0)
    gram = np.ascontiguousarray(gram.transpose(1, 0, 2))
    cross = np.repeat(np.stack([c[1] / n for _, c, n, _ in parts], axis=1), len(ratios), axis=1)
    w = np.zeros_like(cross)
    losses = np.zeros((len(training_sets), len(ratios), N_NET_ALPHAS))
    for a in range(N_NET_ALPHAS):
        alpha = top * shape[a]
        w, _ = _descend(gram, cross, alpha * mix, alpha * (1 - mix), w)
        for q, (i, (_, _, x_mean, y_mean), _, valid) in enumerate(parts):
            own = w[:, q * len(ratios):(q + 1) * len(ratios)].T
            losses[i, :, a] += _errors(valid, own, y_mean - own @ x_mean) / valid[0, 0]
    counts = np.bincount([i for i, *_ in parts], minlength=len(training_sets))
    best = [np.unravel_index(int(np.argmin(losses[i] / counts[i])), losses[i].shape)
            for i in range(len(training_sets))]
    chosen = np.array([ratios[r] for r, _ in best])
    alphas = np.array([peaks[i] / ratios[r] * shape[a] for i, (r, a) in enumerate(best)])
    final, converged = _descend(
        np.ascontiguousarray(np.stack(
            [c[0] / m.n for m, c in zip(training_sets, whole, strict=True)], axis=1)),
        np.stack([c[1] / m.n for m, c in zip(training_sets, whole, strict=True)], axis=1),
        alphas * chosen, alphas * (1 - chosen), np.zeros((len(cross), len(training_sets))))
    return [(float(alphas[i]), float(chosen[i]), final[:, i], float(whole[i][3] - final[:, i] @ whole[i][2]),
             bool(converged[i])) for i in range(len(training_sets))]


_FITS = {"ridge": fit_ridge, "elastic_net": fit_elastic_net}

_COEFFICIENTS = (
    f"{SERIES} STRING, horizon INT, fold INT, model STRING, n_train BIGINT, alpha DOUBLE, "
    "l1_ratio DOUBLE, intercept DOUBLE, weights ARRAY<DOUBLE>, standardised ARRAY<DOUBLE>, "
    "converged BOOLEAN")


def fit_linear(
    training: DataFrame,
    k: int,
    min_train: int,
    features: list[str] | None = None,
    models: tuple[str, ...] = ("ridge", "elastic_net"),
    order: str = HOUR,
    rows_per_split: int = 500,
) -> DataFrame:
    """Coefficients per series, horizon, fold and model; fold 0 is the fit on all rows.

    ``weights`` apply to raw features, ``standardised`` are the same on unit scale;
    ``converged`` is false where the elastic net stopped at its limit of steps.
    """
    return fit_folds(expanding_folds(training, k, min_train, order), k, min_train, features, models, rows_per_split)


def fit_folds(
    folded: DataFrame,
    k: int,
    min_train: int,
    features: list[str] | None = None,
    models: tuple[str, ...] = ("ridge", "elastic_net"),
    rows_per_split: int = 500,
) -> DataFrame:
    """``fit_linear`` on rows that ``expanding_folds`` has numbered already."""
    features = features or HOURLY_FEATURES
    partial = moment_rows(add_cells(folded, k, rows_per_split), features)
    size = len(features) + 2
    upper = np.triu_indices(size)

    def solve(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        cells: dict[tuple[int, ...], np.ndarray] = {}
        for name, flat in zip(parts["cell"], parts["moments"], strict=True):
            block = np.zeros((size, size))
            block[upper] = flat
            block += np.triu(block, 1).T
            cell = tuple(map(int, name.split(".")))
            cells[cell] = cells[cell] + block if cell in cells else block
        folds, sets = [], []
        for fold in range(k + 1):
            digit = fold if fold else k + 1
            by_inner: dict[int, np.ndarray] = {}
            for cell, m in cells.items():
                inner = cell[digit]
                if inner:
                    by_inner[inner] = by_inner[inner] + m if inner in by_inner else m
            n_train = int(round(sum(m[0, 0] for m in by_inner.values())))
            if n_train >= min_train and len(by_inner) > 1:
                folds.append((fold, n_train))
                sets.append(_Moments(by_inner))
        out = []
        for name in models if sets else ():
            for (fold, n_train), moments, (alpha, ratio, beta, intercept, converged) in zip(
                    folds, sets, _FITS[name](sets), strict=True):
                raw = beta / moments.scale
                out.append((key[0], key[1], fold, name, n_train, alpha, ratio,
                            intercept - float(raw @ moments.mean), raw, beta, converged))
        return pd.DataFrame(out, columns=[
            SERIES, "horizon", "fold", "model", "n_train", "alpha", "l1_ratio",
            "intercept", "weights", "standardised", "converged"])

    # Little data, much work per group: a fixed number of partitions keeps adaptive
    # execution from merging all groups into one task.
    tasks = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return partial.repartition(tasks, *CELL).groupBy(*CELL).applyInPandas(solve, _COEFFICIENTS)


def predict_linear(features: list[str], prefix: str = "") -> Column:
    """intercept + weights . features as a native expression."""
    intercept, weights = F.col(f"{prefix}intercept"), F.col(f"{prefix}weights")
    value = intercept
    for i, name in enumerate(features):
        value = value + F.get(weights, F.lit(i)) * F.col(name)
    return value


def coefficients_wide(coefficients: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """One row per series, horizon and fold with ``<model>_intercept`` and ``<model>_weights``."""
    picks = []
    for name in models:
        own = F.col("model") == name
        picks += [F.max(F.when(own, F.col("intercept"))).alias(f"{name}_intercept"),
                  F.max(F.when(own, F.col("weights"))).alias(f"{name}_weights")]
    return coefficients.groupBy(*CELL, "fold").agg(*picks)


def standardise(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(value - mean) / population deviation per group; a constant column is only centred.

    Moments are aggregated and joined back: one row per group on the right side.
    """
    moments = df.groupBy(*by).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    return (df.join(moments, by)
            .select(*by, *[c for c in df.columns if c not in by and c not in cols], *[
                ((F.col(c) - F.col(f"_m_{c}"))
                 / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)).alias(c)
                for c in cols]))


def coefficient_table(coefficients: DataFrame, features: list[str], model: str = "ridge") -> DataFrame:
    """Standardised coefficients of the all-rows fits, one row per series, horizon and feature."""
    names = F.array(*[F.lit(f) for f in features])
    return (coefficients.filter((F.col("fold") == 0) & (F.col("model") == model))
            .select(*CELL, F.posexplode(F.arrays_zip(
                names.alias("feature"), F.col("standardised").alias("value"))).alias("position", "_c"))
            .select(*CELL, "position", "_c.feature", "_c.value"))


def certificate(folded: DataFrame, coefficients: DataFrame, features: list[str], tolerance: float = 1e-6) -> DataFrame:
    """(series, horizon, fold, model, n_train, holds): whether each fit meets the optimality conditions on its rows.

    With standardised features z, residuals r and slack relative to the steepest feature, a ridge fit has
    z'r = alpha * w in every feature; an elastic net has z'r / n = alpha * ((1 - l1_ratio) * w + l1_ratio * sign(w)), and at most
    alpha * l1_ratio beside it where w is 0. Checked on the rows themselves, in one aggregation.
    """
    key = [*CELL, "fold", "model"]
    fits = coefficients.select(*key, "n_train", "alpha", "l1_ratio", "intercept", "weights", "standardised")
    # A row trains every later fold and the final fit.
    rows = folded.drop("n_train", "fold").join(fits, CELL).where((F.col("fold") == 0) | (F.col("block") < F.col("fold")))
    residual = F.col("delta") - predict_linear(features)
    sums = [F.sum(F.col(c) * residual).alias(f"_r_{c}") for c in features]
    sums += [F.covar_pop(F.col(c).cast("double"), F.col("delta").cast("double")).alias(f"_y_{c}") for c in features]
    sums += [F.avg(c).alias(f"_m_{c}") for c in features] + [F.stddev_pop(c).alias(f"_s_{c}") for c in features]
    names = ["n_train", "alpha", "l1_ratio", "standardised"]
    found = rows.groupBy(*key).agg(
        F.count("*").alias("n"), F.sum(residual).alias("_r"), *[F.first(c).alias(c) for c in names], *sums)

    def scaled(value: Column, c: str) -> Column:
        return F.when(F.col(f"_s_{c}") > 1e-6 * F.greatest(F.abs(f"_m_{c}"), F.lit(1.0)), value / F.col(f"_s_{c}")).otherwise(0.0)

    steepest = F.greatest(*[F.abs(scaled(F.col(f"_y_{c}"), c)) for c in features])
    misses = []
    for i, c in enumerate(features):
        pull = scaled(F.col(f"_r_{c}") - F.col("_r") * F.col(f"_m_{c}"), c) / F.col("n")
        w = F.get("standardised", F.lit(i))
        sparse = F.when(w == 0, F.greatest(F.abs(pull) - F.col("alpha") * F.col("l1_ratio"), F.lit(0.0))).otherwise(
            F.abs(pull - F.col("alpha") * ((1 - F.col("l1_ratio")) * w + F.col("l1_ratio") * F.signum(w))))
        misses.append(F.when(F.col("l1_ratio").isNull(), F.abs(pull - F.col("alpha") * w / F.col("n"))).otherwise(sparse))
    worst = F.greatest(*misses) / F.greatest(steepest, F.lit(1e-12))
    return found.select(*key, "n_train", ((F.col("n") == F.col("n_train")) & (worst <= tolerance)).alias("holds"), worst.alias("worst"))
