"""Boosted trees and forests, one model per series, horizon and fold, kept as rows.

The rows of one series and horizon are a cell. On an hourly grid a cell is bounded by the calendar (8,766 rows a year,
whatever the number of readings behind them), so a cell is fitted in one task and the cells of a panel side by side.
Features become at most 255 bins; a tree grows level by level, and NumPy searches the splits of all nodes of a level at
once: from sums per (node, feature, bin), or along the sorted rows where those are fewer. A fitted model is one row of arrays (``MODEL``), which is stored, versioned, joined and
explained like any other table.

Boosting stops by itself: the newest share of the training rows is held out, and growing ends once ``patience``
rounds have not improved on the best, which is where the model is cut.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel.models.evaluate import CELL
from airpanel.schemas import HOUR, SERIES

# Executors get the helpers below with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = (f"{SERIES} STRING, horizon INT, fold INT, model STRING, n_train BIGINT, rounds INT, base DOUBLE, "
         "roots ARRAY<INT>, feature ARRAY<INT>, threshold ARRAY<DOUBLE>, `left` ARRAY<INT>, `right` ARRAY<INT>, "
         "value ARRAY<DOUBLE>")
#: The trees alone, as a column of a model table.
PACKED_FIELDS = ["base", "roots", "feature", "threshold", "left", "right", "value"]
PACKED = ("struct<base:double,roots:array<int>,feature:array<int>,threshold:array<double>,"
          "`left`:array<int>,`right`:array<int>,value:array<double>>")
BINS = 255


@dataclass(frozen=True)
class Boosting:
    """Settings of a booster; ``on`` names the linear model whose residuals it learns, if any."""

    rounds: int = 500
    step: float = 0.06
    depth: int = 6
    min_leaf: int = 20
    leaves: int = 31
    l2: float = 1.0
    held: float = 0.15
    patience: int = 25
    on: str | None = None


@dataclass(frozen=True)
class Forest:
    """Settings of a forest of trees on bootstrap samples."""

    trees: int = 400
    depth: int = 8
    min_leaf: int = 3
    share: float = 0.5
    seed: int = 42


# Settings of the tree candidates.
HIST_GBR = Boosting()
BOOSTED_RESIDUAL = Boosting(rounds=300, step=0.05, depth=4, min_leaf=25, patience=20, on="ridge")
HOURLY_TREES = {"hist_gbr": HIST_GBR, "boosted_residual": BOOSTED_RESIDUAL}
DAILY_TREES = {"random_forest": Forest()}


def _edges(values: np.ndarray) -> np.ndarray:
    """Cut points between neighbouring values, or between quantiles of many."""
    known = np.unique(values)
    if len(known) > BINS:
        known = np.unique(np.quantile(values, np.linspace(0, 1, BINS), method="lower"))
    return (known[:-1] + known[1:]) / 2


class _Binned:
    """Codes of the features; a code of ``b`` or less means a value of ``edges[b]`` or less."""

    def __init__(self, x: np.ndarray, fitted: np.ndarray):
        self.edges = [_edges(x[fitted, j]) for j in range(x.shape[1])]
        self.codes = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1)
        self.n_bins = max(len(e) for e in self.edges) + 1
        self.order = self.codes.T.argsort(axis=1, kind="stable")


class _Tree:
    """Arrays of one tree's nodes; a leaf has feature -1."""

    def __init__(self, value: float):
        self.feature, self.bin, self.left, self.right, self.value = [-1], [0], [-1], [-1], [value]

    def split(self, node: int, feature: int, at: int, low: float, high: float) -> tuple[int, int]:
        self.feature[node], self.bin[node] = feature, at
        self.left[node], self.right[node] = len(self.value), len(self.value) + 1
        for value in (low, high):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(value)
        return self.left[node], self.right[node]


def _gain(n_left, s_left, n, s, min_leaf: int, l2: float, allowed) -> np.ndarray:
    """Fall of the squared error by a split; 0 where it is not allowed."""
    n_right, s_right = n - n_left, s - s_left
    allowed = allowed & (n_left >= min_leaf) & (n_right >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(allowed, s_left**2 / (n_left + l2) + s_right**2 / (n_right + l2) - s**2 / (n + l2), 0.0)


def _best_by_bins(binned: _Binned, node: np.ndarray, weight, weighted, n_nodes: int, min_leaf: int, l2: float, mask):
    """Best split per node from sums per (node, feature, bin): cheap where rows are many."""
    width, n_bins = binned.codes.shape[1], binned.n_bins
    rows = np.flatnonzero(node >= 0)
    cell = (node[rows][:, None] * (width * n_bins) + np.arange(width) * n_bins + binned.codes[rows]).ravel()
    shape, size = (n_nodes, width, n_bins), n_nodes * width * n_bins
    counts = np.bincount(cell, np.repeat(weight[rows], width), size).reshape(shape).cumsum(axis=2)
    sums = np.bincount(cell, np.repeat(weighted[rows], width), size).reshape(shape).cumsum(axis=2)
    gain = _gain(counts, sums, counts[:, :, -1:], sums[:, :, -1:], min_leaf, l2, mask[:, :, None]).reshape(n_nodes, -1)
    at = gain.argmax(axis=1)
    each, (feature, code) = np.arange(n_nodes), np.divmod(at, n_bins)
    return (gain[each, at], feature, code, counts[each, feature, code], sums[each, feature, code],
            counts[:, 0, -1], sums[:, 0, -1])


def _best_by_rows(binned: _Binned, node: np.ndarray, weight, weighted, n_nodes: int, min_leaf: int, l2: float, mask):
    """Best split per node from running sums over the rows in the order of each feature: cheap where rows are few."""
    counts = np.bincount(node[node >= 0], minlength=n_nodes)
    ends = np.cumsum(counts)
    starts, live = ends - counts, int(ends[-1])
    by_node = np.where(node < 0, n_nodes, node).astype(np.uint16)[binned.order]
    rows = np.take_along_axis(binned.order, by_node.argsort(axis=1, kind="stable")[:, :live], axis=1)
    owner = np.repeat(np.arange(n_nodes), counts)
    n_run, s_run = weight[rows].cumsum(axis=1), weighted[rows].cumsum(axis=1)
    n_before, s_before = (np.where(starts > 0, run[:, starts - 1], 0.0)[:, owner] for run in (n_run, s_run))
    n, s = (np.bincount(node[node >= 0], v[node >= 0], n_nodes) for v in (weight, weighted))
    codes = np.take_along_axis(binned.codes.T, rows, axis=1)
    ahead = np.zeros(codes.shape, bool)
    ahead[:, :-1] = (codes[:, :-1] != codes[:, 1:]) & (owner[:-1] == owner[1:])
    gain = _gain(n_run - n_before, s_run - s_before, n[owner], s[owner], min_leaf, l2, ahead & mask.T[:, owner])
    of_row = gain.max(axis=0)
    best = np.maximum.reduceat(of_row, starts)
    _, first = np.unique(owner[hits := np.flatnonzero(of_row == best[owner])], return_index=True)
    at = hits[first]
    feature = gain[:, at].argmax(axis=0)
    return (best, feature, codes[feature, at], (n_run - n_before)[feature, at], (s_run - s_before)[feature, at], n, s)


def _grow(
    binned: _Binned, target: np.ndarray, weight: np.ndarray, depth: int, min_leaf: int, l2: float = 0.0,
    leaves: int | None = None, share: float = 1.0, rng: np.random.Generator | None = None,
) -> tuple[_Tree, np.ndarray]:
    """A tree of weighted least squares and the node of every row; rows of weight 0 only follow the splits.

    Where a level would exceed ``leaves``, its splits with the largest gain are made.
    """
    codes, width = binned.codes, binned.codes.shape[1]
    weighted = weight * target
    tree = _Tree(float(weighted.sum() / (weight.sum() + l2)))
    at = np.zeros(len(target), np.int64)
    active, n_leaves = np.array([0]), 1
    for _ in range(depth):
        slot = np.full(len(tree.value), -1)
        slot[active] = np.arange(len(active))
        node = np.where(weight > 0, slot[at], -1)
        mask = np.ones((len(active), width), bool)
        if share < 1:
            mask = rng.random((len(active), width)).argsort(axis=1).argsort(axis=1) < max(1, int(share * width))
        search = _best_by_rows if len(target) < len(active) * binned.n_bins else _best_by_bins
        gain, feature, code, n_left, s_left, n, s = search(binned, node, weight, weighted, len(active), min_leaf, l2, mask)
        order = np.argsort(-gain, kind="stable")
        order = order[gain[order] > 1e-12]
        if leaves is not None:
            order = order[:leaves - n_leaves]
        if not len(order):
            break
        n_leaves += len(order)
        low, high = s_left / (n_left + l2 + 1e-300), (s - s_left) / (n - n_left + l2 + 1e-300)
        children = np.full((len(active), 2), -1)
        for i in order.tolist():
            children[i] = tree.split(int(active[i]), int(feature[i]), int(code[i]), float(low[i]), float(high[i]))
        own = slot[at]
        moving = np.flatnonzero((own >= 0) & (children[own, 0] >= 0))
        own = own[moving]
        at[moving] = children[own, (codes[moving, feature[own]] > code[own]).astype(np.int64)]
        active = children[order].ravel()
    return tree, at


def _boost(x: np.ndarray, y: np.ndarray, spec: Boosting) -> tuple[float, list[_Tree], list[np.ndarray], int]:
    """Base value, trees up to the best round, cut points and rounds grown; rows are in time order."""
    n_held = int(spec.held * len(y))
    weight = np.ones(len(y))
    weight[len(y) - n_held:] = 0
    binned = _Binned(x, weight > 0)
    base = float(y[weight > 0].mean())
    left = y - base
    grown, best, kept = [], np.mean(left[weight == 0] ** 2) if n_held else np.inf, 0
    while len(grown) < spec.rounds and (not n_held or len(grown) - kept < spec.patience):
        tree, at = _grow(binned, left, weight, spec.depth, spec.min_leaf, spec.l2, spec.leaves)
        tree.value = [v * spec.step for v in tree.value]
        grown.append(tree)
        left = left - np.array(tree.value)[at]
        error = np.mean(left[weight == 0] ** 2) if n_held else 0.0
        if not n_held or error < best:
            best, kept = error, len(grown)
    return base, grown[:kept], binned.edges, len(grown)


def _plant(x: np.ndarray, y: np.ndarray, spec: Forest, salt: int) -> tuple[float, list[_Tree], list[np.ndarray], int]:
    rng = np.random.default_rng([spec.seed, salt])
    binned = _Binned(x, np.ones(len(y), bool))
    grown = []
    for _ in range(spec.trees):
        drawn = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)).astype(float)
        tree, _ = _grow(binned, y, drawn, spec.depth, spec.min_leaf, share=spec.share, rng=rng)
        tree.value = [v / spec.trees for v in tree.value]
        grown.append(tree)
    return 0.0, grown, binned.edges, len(grown)


def _packed(base: float, trees: list[_Tree], edges: list[np.ndarray], rounds: int) -> dict[str, object]:
    """The trees behind one another, children by their place in the joint arrays."""
    sizes = [len(t.value) for t in trees]
    roots = np.cumsum([0, *sizes[:-1]]).astype(np.int64) if trees else np.zeros(0, np.int64)
    join = lambda name: np.concatenate([np.array(getattr(t, name)) for t in trees]) if trees else np.zeros(0)
    feature, cut, shift = join("feature").astype(np.int64), join("bin").astype(np.int64), np.repeat(roots, sizes)
    threshold = np.array([edges[f][b] if f >= 0 else np.nan for f, b in zip(feature.tolist(), cut.tolist())])
    inner = feature >= 0
    return {"rounds": rounds, "base": base, "roots": roots.tolist(), "feature": feature.tolist(),
            "threshold": [t if i else None for t, i in zip(threshold.tolist(), inner.tolist())],
            "left": np.where(inner, join("left") + shift, -1).astype(int).tolist(),
            "right": np.where(inner, join("right") + shift, -1).astype(int).tolist(), "value": join("value").tolist()}


def _matrix(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    columns = [table.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names]
    return np.stack(columns, axis=1) if columns else np.zeros((table.num_rows, 0))


def _fit_cell(
    rows: pa.Table, lines: pa.Table, features: list[str], specs: dict[str, Boosting | Forest], folds: list[int] | None, min_train: int,
) -> pa.Table:
    """The models of one cell; ``lines`` holds its linear fits by fold."""
    out: list[dict[str, object]] = []
    if rows.num_rows:
        rows = rows.sort_by("rn")
        x, y, block = _matrix(rows, features), rows.column("delta").to_numpy().astype(float), rows.column("block").to_numpy()
        linear = {r["fold"]: r for r in lines.to_pylist()}
        for fold in folds if folds is not None else [rows.column("fold")[0].as_py()]:
            used = block < fold if fold else np.ones(len(y), bool)
            if used.sum() < min_train:
                continue
            for name, spec in specs.items():
                target = y[used]
                on = getattr(spec, "on", None)
                if on is not None:
                    if fold not in linear:
                        continue
                    target = target - (x[used] @ np.array(linear[fold]["weights"]) + linear[fold]["intercept"])
                fit = _boost(x[used], target, spec) if isinstance(spec, Boosting) else _plant(x[used], target, spec, fold)
                out.append({SERIES: rows.column(SERIES)[0].as_py(), "horizon": rows.column("horizon")[0].as_py(), "fold": fold,
                            "model": name, "n_train": int(used.sum()), **_packed(*fit)})
    ints, doubles = pa.list_(pa.int32()), pa.list_(pa.float64())
    return pa.Table.from_pylist(out, schema=pa.schema([
        (SERIES, pa.string()), ("horizon", pa.int32()), ("fold", pa.int32()), ("model", pa.string()), ("n_train", pa.int64()),
        ("rounds", pa.int32()), ("base", pa.float64()), ("roots", ints), ("feature", ints), ("threshold", doubles),
        ("left", ints), ("right", ints), ("value", doubles)]))


def fit_trees(
    folded: DataFrame,
    features: list[str],
    specs: Mapping[str, Boosting | Forest],
    folds: Sequence[int],
    min_train: int,
    linear: DataFrame | None = None,
    spread: bool = False,
) -> DataFrame:
    """One ``MODEL`` row per series, horizon, fold and name in ``specs``; fold 0 is the fit on all rows.

    ``folded`` comes from ``expanding_folds``; ``linear`` has the fits that specs with ``on`` build on. A fold with fewer than
    ``min_train`` rows has no model. A cell's folds are fitted in one task, for which its rows move once; with
    ``spread`` each fold is a task of its own, for few cells with costly fits.
    """
    spark = folded.sparkSession
    bases = {s.on for s in specs.values() if isinstance(s, Boosting) and s.on}
    if bases and (linear is None or len(bases) > 1):
        raise ValueError("boosting on residuals needs the fits of one linear model")
    lines = (spark.createDataFrame([], f"{SERIES} STRING, horizon INT, fold INT, intercept DOUBLE, weights ARRAY<DOUBLE>")
             if not bases else linear.filter(F.col("model") == bases.pop()).select(*CELL, "fold", "intercept", "weights"))
    rows = folded.select(
        SERIES, F.col("horizon").cast("int").alias("horizon"), "rn", "block",
        *[F.col(c).cast("double").alias(c) for c in features], F.col("delta").cast("double").alias("delta"))
    key, chosen = CELL, list(folds)
    if spread:
        each = F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: (f == 0) | (F.col("block") < f))
        rows, key, chosen = rows.withColumn("fold", F.explode(each)), [*CELL, "fold"], None
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Little data, much work per cell: a fixed number of partitions keeps them from being merged into one task.
    return (rows.repartition(tasks, *key).groupBy(*key).cogroup(_fresh(lines).repartition(tasks, *key).groupBy(*key))
            .applyInArrow(partial(_fit_cell, features=list(features), specs=dict(specs), folds=chosen, min_train=min_train),
                          MODEL))


class _Walker:
    """A packed model ready for many rows."""

    def __init__(self, model: dict[str, object]):
        self.base = model["base"]
        self.roots, self.feature, self.left, self.right = (
            np.array(model[k], np.int64) for k in ("roots", "feature", "left", "right"))
        self.threshold = np.array([np.nan if t is None else t for t in model["threshold"]], float)
        self.value = np.array(model["value"], float)

    def _levels(self, x: np.ndarray):
        """Per level: the rows and nodes that split there, and the nodes they go to."""
        node = np.tile(self.roots, len(x))
        row = np.repeat(np.arange(len(x)), len(self.roots))
        while len(node):
            inner = self.feature[node] >= 0
            row, node = row[inner], node[inner]
            to = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            yield row, node, to
            node = to

    def contributions(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """What every prediction starts from, and what each feature adds to it along the paths."""
        width = x.shape[1]
        added = np.zeros(len(x) * width)
        for row, node, to in self._levels(x):
            added += np.bincount(row * width + self.feature[node], self.value[to] - self.value[node], len(added))
        return self.base + float(self.value[self.roots].sum()), added.reshape(len(x), width)

    def predict(self, x: np.ndarray) -> np.ndarray:
        start, added = self.contributions(x)
        return start + added.sum(axis=1)


ROWS_AT_ONCE = 4_096


def _chunks(x: np.ndarray):
    for start in range(0, max(len(x), 1), ROWS_AT_ONCE):
        yield x[start:start + ROWS_AT_ONCE]


def _predict_cell(rows: pa.Table, models: pa.Table, features: list[str], names: list[str]) -> pa.Table:
    x = _matrix(rows, features)
    found = {m["model"]: _Walker(m) for m in models.to_pylist()} if rows.num_rows else {}
    out = rows.drop_columns(features)
    for name in names:
        values = np.concatenate([found[name].predict(part) for part in _chunks(x)]) if name in found else None
        out = out.append_column(name, pa.array(values, pa.float64()) if values is not None else pa.nulls(rows.num_rows, pa.float64()))
    return out


def _fresh(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, for a cogroup with rows that were made from them."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def predict_trees(rows: DataFrame, models: DataFrame, features: list[str], names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(series, horizon, fold, *keep) and a prediction per name for every row; null where there is no such model.

    ``rows`` has the fold whose model is meant. Rows and models meet by series, horizon and fold.
    """
    key = [*CELL, "fold"]
    keep = [c for c in keep if c not in key]
    own = rows.select(SERIES, F.col("horizon").cast("int").alias("horizon"), F.col("fold").cast("int").alias("fold"), *keep,
                      *[F.col(c).cast("double").alias(f"_x_{c}") for c in features])
    columns = [f"_x_{c}" for c in features]
    kind = T.StructType([f for f in own.schema.fields if f.name not in columns]
                        + [T.StructField(n, T.DoubleType()) for n in names])
    return own.groupBy(*key).cogroup(_fresh(models.filter(F.col("model").isin(*names))).groupBy(*key)).applyInArrow(
        partial(_predict_cell, features=columns, names=list(names)), kind)


_ATTRIBUTED = (f"{SERIES} STRING, horizon INT, fold INT, model STRING, {HOUR} BIGINT, base DOUBLE, x ARRAY<DOUBLE>, "
               "contributions ARRAY<DOUBLE>")


def _attribute_cell(rows: pa.Table, models: pa.Table, features: list[str]) -> pa.Table:
    parts: dict[str, list] = {n: [] for n in (SERIES, "horizon", "fold", "model", HOUR, "base", "x", "contributions")}
    x = _matrix(rows, features)
    for model in models.to_pylist() if rows.num_rows else ():
        walker = _Walker(model)
        pieces = [walker.contributions(part) for part in _chunks(x)]
        for name in (SERIES, "horizon", "fold", HOUR):
            parts[name] += rows.column(name).to_pylist()
        parts["model"] += [model["model"]] * rows.num_rows
        parts["base"] += [pieces[0][0]] * rows.num_rows
        parts["x"] += x.tolist()
        parts["contributions"] += np.concatenate([p[1] for p in pieces]).tolist()
    kinds = {"horizon": pa.int32(), "fold": pa.int32(), HOUR: pa.int64(), "base": pa.float64(),
             "x": pa.list_(pa.float64()), "contributions": pa.list_(pa.float64())}
    return pa.table({n: pa.array(v, kinds.get(n, pa.string())) for n, v in parts.items()})


def tree_contributions(rows: DataFrame, models: DataFrame, features: list[str], order: str = HOUR) -> DataFrame:
    """Per row and model: ``base``, the features ``x`` and what each adds to it (arrays in the order of ``features``).

    A feature's contribution is the sum of the changes of the node value at every split on it along the row's paths
    through all trees, so base and contributions add up to the prediction exactly as it is made.
    """
    key = [*CELL, "fold"]
    own = rows.select(
        SERIES, F.col("horizon").cast("int").alias("horizon"), F.col("fold").cast("int").alias("fold"),
        F.col(order).cast("bigint").alias(HOUR), *[F.col(c).cast("double").alias(f"_x_{c}") for c in features])
    return own.groupBy(*key).cogroup(_fresh(models).groupBy(*key)).applyInArrow(
        partial(_attribute_cell, features=[f"_x_{c}" for c in features]), _ATTRIBUTED)


def nodes(models: DataFrame) -> DataFrame:
    """The models as a node table: one row per node, with its feature's number and children."""
    each = F.arrays_zip(*[F.col(c) for c in ("feature", "threshold", "left", "right", "value")])
    return (models.select(*CELL, "fold", "model", F.posexplode(each).alias("node", "_n"))
            .select(*CELL, "fold", "model", "node", "_n.feature", "_n.threshold", "_n.left", "_n.right", "_n.value"))


def mean_ensemble(columns: list[str]) -> Column:
    """Plain mean of fitted members' prediction columns."""
    return sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)
