"""Expanding-window evaluation as aggregations: folds, baseline fits, scores, winners.

All horizons and all series go through one plan. Training sets grow block by
block, so whatever a fold needs from its training rows is a running sum of
per-block aggregates; no fold re-reads or re-joins its training rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.functions.scalars import gain_pct
from airpanel.operators.relational import WINNER_PREFIX, candidate_rows
from airpanel.schemas import HOUR, REPORT_HORIZONS, SERIES

CELL = [SERIES, "horizon"]

# Candidate order, which breaks ties.
HOURLY_CANDIDATES = [
    "persistence", "diurnal_naive", "damped_reversion", "hist_gbr",
    "ridge", "elastic_net", "boosted_residual", "ensemble",
]
DAILY_CANDIDATES = [
    "persistence_baseline", "climatology_7d", "damped_persistence", "random_forest", "ridge",
]

MIN_TRAIN_HOURLY = 800
MIN_TRAIN_DAILY = 60


def fold_index(rows: DataFrame, order: str = HOUR) -> DataFrame:
    """Adds row position ``rn`` (from 0) and row count ``n_rows`` per series and horizon."""
    ordered = Window.partitionBy(*CELL).orderBy(order)
    whole = Window.partitionBy(*CELL)
    return (rows.withColumn("rn", (F.row_number().over(ordered) - 1).cast("bigint"))
            .withColumn("n_rows", F.count("*").over(whole)))


def expanding_folds(
    rows: DataFrame, k: int, min_train: int, order: str = HOUR, purge: bool = False
) -> DataFrame:
    """Adds ``block`` (0 = only ever trained on), ``n_train`` and ``is_scored``.

    Fold ``f`` trains on blocks below ``f`` and tests block ``f``. ``is_scored`` is
    false for folds with too little training data and for series too short
    altogether. With ``purge``, ``is_purged`` marks rows whose target lies in the
    next block and which a strict split leaves out of that block's training set.
    """
    step = F.expr(f"n_rows div {k + 1}")
    first = F.col("n_rows") - k * F.col("_step")
    block = (F.when(F.col("rn") < F.col("_first"), F.lit(0).cast("bigint"))
             .otherwise(F.expr("(rn - _first) div _step") + 1))
    folded = (fold_index(rows, order)
              .withColumn("_step", step)
              .filter(F.col("_step") > 0)
              .withColumn("_first", first)
              .withColumn("block", block.cast("int"))
              .withColumn("n_train", F.when(
                  F.col("block") > 0, F.col("_first") + (F.col("block") - 1) * F.col("_step")))
              .withColumn("is_scored", F.coalesce(
                  (F.col("n_train") >= min_train) & (F.col("n_rows") >= 2 * min_train),
                  F.lit(False))))
    if purge:
        last = F.max(order).over(Window.partitionBy(*CELL, "block"))
        folded = folded.withColumn("is_purged", F.col(order) + F.col("horizon") > last)
    return folded.drop("_step", "_first")


def fold_ranges(folded: DataFrame, time: str = "ts") -> DataFrame:
    """Test period of every scored fold."""
    return (folded.filter("is_scored").groupBy(*CELL, F.col("block").alias("fold"))
            .agg(F.min(time).alias("test_start"), F.max(time).alias("test_end"),
                 F.first("n_train").alias("n_train"), F.count("*").alias("n_test")))


def fit_reversion_k(folded: DataFrame, deviation: str) -> DataFrame:
    """Least squares through the origin of ``delta`` on ``-deviation``, per fold (fold 0: all rows).

    Block sums come from one aggregation; a fold's training sums are the running
    total over the blocks before it.
    """
    x, y = -F.col(deviation), F.col("delta")
    if "is_purged" in folded.columns:
        # A purged row still trains every later fold, so its share is kept apart
        # and only the fold right after its block goes without it.
        inside = F.when(F.col("is_purged"), 0.0).otherwise(1.0)
    else:
        inside = F.lit(1.0)
    blocks = folded.groupBy(*CELL, "block").agg(
        F.sum(x * y).alias("_xy"), F.sum(x * x).alias("_xx"),
        F.sum(x * y * inside).alias("_xyi"), F.sum(x * x * inside).alias("_xxi"))
    by_block = Window.partitionBy(*CELL).orderBy("block")
    older = by_block.rowsBetween(Window.unboundedPreceding, -2)

    def training(total: str, own: str) -> Column:
        return F.coalesce(F.sum(total).over(older), F.lit(0.0)) + F.lag(own).over(by_block)

    per_fold = (blocks
                .withColumn("_sxy", training("_xy", "_xyi"))
                .withColumn("_sxx", training("_xx", "_xxi"))
                .filter(F.col("block") > 0)
                .select(*CELL, F.col("block").alias("fold"), _ratio("_sxy", "_sxx").alias("k")))
    final = (blocks.groupBy(*CELL).agg(F.sum("_xy").alias("_sxy"), F.sum("_xx").alias("_sxx"))
             .select(*CELL, F.lit(0).alias("fold"), _ratio("_sxy", "_sxx").alias("k")))
    return per_fold.unionByName(final)


def _ratio(num: str, den: str) -> Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def with_reversion_k(folded: DataFrame, deviation: str) -> DataFrame:
    """Attach each fold's k to its test rows.

    The training sums of a block are a range frame over the blocks before it, so
    the rows are neither joined nor computed a second time.
    """
    x, y = -F.col(deviation), F.col("delta")
    by_block = Window.partitionBy(*CELL).orderBy("block")
    before = by_block.rangeBetween(Window.unboundedPreceding, -1)
    sxy, sxx = F.sum(x * y).over(before), F.sum(x * x).over(before)
    if "is_purged" in folded.columns:
        older = by_block.rangeBetween(Window.unboundedPreceding, -2)
        previous = by_block.rangeBetween(-1, -1)
        kept = F.when(F.col("is_purged"), 0.0).otherwise(1.0)

        def strict(term: Column) -> Column:
            return (F.coalesce(F.sum(term).over(older), F.lit(0.0))
                    + F.coalesce(F.sum(term * kept).over(previous), F.lit(0.0)))

        sxy, sxx = strict(x * y), strict(x * x)
    return (folded.withColumns({"_sxy": sxy, "_sxx": sxx})
            .withColumn("k", _ratio("_sxy", "_sxx")).drop("_sxy", "_sxx"))


def hourly_baselines() -> dict[str, Column]:
    """Predicted change of the closed-form hourly models; needs column ``k``."""
    return {
        "persistence": F.lit(0.0),
        "diurnal_naive": F.col("aqi_lag24") - F.col("aqi"),
        "damped_reversion": F.col("k") * -F.col("aqi_minus_roll24"),
    }


def daily_baselines() -> dict[str, Column]:
    return {
        "persistence_baseline": F.lit(0.0),
        "climatology_7d": -F.col("aqi_minus_rolling_7"),
        "damped_persistence": F.col("k") * -F.col("aqi_minus_rolling_7"),
    }


def score(rows: DataFrame, predictions: Mapping[str, Column], order: list[str]) -> DataFrame:
    """Fold scores of several models from one aggregation over the test rows.

    ``rows`` are test rows with ``fold``, ``aqi``, ``target`` and ``delta``. The
    models stay side by side until the sums are taken, and only the sums are
    turned into one row per model.
    """
    def square(c: Column) -> Column:
        return F.sum(c * c)

    sums = [
        F.count("*").alias("_n"), F.first("n_rows").alias("n_rows"),
        F.sum("target").alias("_ty"), square(F.col("target")).alias("_tyy"),
        F.sum("delta").alias("_dy"), square(F.col("delta")).alias("_dyy"),
    ]
    if "k" in rows.columns:
        sums.append(F.first("k").alias("_k"))
    for name, predicted in predictions.items():
        level_error = F.col("target") - (F.col("aqi") + predicted)
        sums += [square(level_error).alias(f"_sse_{name}"),
                 F.sum(F.abs(level_error)).alias(f"_sae_{name}"),
                 square(F.col("delta") - predicted).alias(f"_dsse_{name}")]
    totals = rows.groupBy(*CELL, "fold").agg(*sums)

    def r2(sse: Column, total: Column, squares: Column) -> Column:
        spread = squares - total * total / F.col("_n")
        return (F.when(spread > 0, 1 - sse / spread)
                .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))

    fitted = {"damped_reversion", "damped_persistence"}

    def entry(name: str) -> Column:
        k = F.col("_k") if name in fitted and "k" in rows.columns else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("model"), F.lit(order.index(name)).alias("model_order"),
            F.sqrt(F.col(f"_sse_{name}") / F.col("_n")).alias("rmse"),
            (F.col(f"_sae_{name}") / F.col("_n")).alias("mae"),
            r2(F.col(f"_sse_{name}"), F.col("_ty"), F.col("_tyy")).alias("r2"),
            r2(F.col(f"_dsse_{name}"), F.col("_dy"), F.col("_dyy")).alias("delta_r2"),
            k.alias("k"))

    return (totals
            .withColumn("_m", F.explode(F.array(*[entry(name) for name in predictions])))
            .select(*CELL, "fold", "n_rows", F.col("_n").alias("n_test"), "_m.*"))


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean over folds; the spread of RMSE is the population deviation; k ignores missing values."""
    return scores.groupBy(*CELL, "model", "model_order").agg(
        F.first("n_rows").alias("n_rows"), F.count("*").alias("n_folds"),
        F.avg("rmse").alias("rmse"), F.stddev_pop("rmse").alias("rmse_std"),
        F.avg("mae").alias("mae"), F.avg("r2").alias("r2"),
        F.avg("delta_r2").alias("delta_r2"), F.avg("k").alias("k"))


def cross_validate(
    training: DataFrame,
    k: int,
    min_train: int,
    daily: bool = False,
    order: str | None = None,
    purge: bool = False,
) -> DataFrame:
    """Baseline metrics per series and horizon; series without a scored fold give no row."""
    return fold_summary(baseline_scores(training, k, min_train, daily, order, purge))


def baseline_scores(
    training: DataFrame, k: int, min_train: int, daily: bool = False,
    order: str | None = None, purge: bool = False,
) -> DataFrame:
    order = order or ("pos" if daily else HOUR)
    deviation = "aqi_minus_rolling_7" if daily else "aqi_minus_roll24"
    folded = expanding_folds(training, k, min_train, order, purge)
    test = (with_reversion_k(folded, deviation).filter("is_scored")
            .withColumnRenamed("block", "fold"))
    return score(
        test,
        daily_baselines() if daily else hourly_baselines(),
        DAILY_CANDIDATES if daily else HOURLY_CANDIDATES)


def pick_winner(metrics: DataFrame) -> DataFrame:
    """Lowest RMSE per series and horizon; ties go to the earlier candidate."""
    others = [c for c in metrics.columns if c not in (*CELL, "rmse", "model_order")]
    best = metrics.groupBy(*CELL).agg(
        F.min(F.struct("rmse", "model_order", *others)).alias("_w"))
    return best.select(*CELL, *[F.col(f"_w.{c}").alias(c) for c in metrics.columns if c not in CELL])


def _baseline_rmse(baseline: str) -> Column:
    return F.min(F.when(F.col("model") == baseline, F.col("rmse")))


def skill_table(metrics: DataFrame, baseline: str = "persistence") -> DataFrame:
    """Best candidate per series and horizon with the baseline's RMSE and the gain over it."""
    with_base = candidate_rows(metrics).withColumn(
        "baseline_rmse", _baseline_rmse(baseline).over(Window.partitionBy(*CELL)))
    return pick_winner(with_base).withColumn(
        "gain", gain_pct(F.col("baseline_rmse"), F.col("rmse")))


def select_models(metrics: DataFrame, baseline: str = "persistence", mark: bool = False) -> DataFrame:
    """Winners with their ``gain``; with ``mark``, all metrics and a WINNER copy of the best row.

    A window partition holds the candidates of one horizon, a handful of rows.
    """
    cell = Window.partitionBy(*CELL)
    rank = F.struct("rmse", "model_order")
    judged = metrics.withColumns({
        "gain": gain_pct(_baseline_rmse(baseline).over(cell), F.col("rmse")),
        "_is_best": rank == F.min(rank).over(cell)})
    if not mark:
        return judged.filter("_is_best").drop("_is_best")
    names = F.when(F.col("_is_best"), F.array(
        F.col("model"), F.concat(F.lit(WINNER_PREFIX), "model"))).otherwise(F.array("model"))
    return judged.withColumn("model", F.explode(names)).drop("_is_best")


def registry_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics to register per horizon: the marked winner when there is one, else the lowest RMSE."""
    unmarked = ~F.col("model").startswith(WINNER_PREFIX)
    row = F.struct(unmarked.alias("u"), "rmse", "model", "mae", "r2")
    return (metrics.groupBy(*CELL).agg(F.min(row).alias("_w"))
            .select(*CELL, "_w.model", "_w.rmse", "_w.mae", "_w.r2"))


def curve_summary(metrics: DataFrame, report: list[int] | None = None) -> DataFrame:
    """Mean RMSE per model over the whole curve and over the report horizons, best first."""
    chosen = F.when(F.col("horizon").isin(report or REPORT_HORIZONS), F.col("rmse"))
    return (metrics.groupBy(SERIES, "model", "model_order").agg(
        F.avg("rmse").alias("curve_rmse"), F.avg(chosen).alias("report_rmse"),
        F.count("*").alias("n_horizons"))
        .withColumn("rank", F.row_number().over(
            Window.partitionBy(SERIES).orderBy("curve_rmse", "model_order"))))


def shuffled_targets(training: DataFrame, seed: int = 42) -> DataFrame:
    """Leakage control: targets permuted within each series and horizon.

    Row ``i`` in time order receives the change that comes ``i``-th in hash order.
    """
    by_time = Window.partitionBy(*CELL).orderBy(HOUR)
    draw = F.md5(F.concat_ws("|", F.col(HOUR).cast("string"), F.lit(str(seed))).cast("binary"))
    by_hash = Window.partitionBy(*CELL).orderBy(draw, HOUR)
    rows = training.withColumn("_i", F.row_number().over(by_time)).drop("delta", "target")
    shuffled = training.select(
        *CELL, "delta", F.row_number().over(by_hash).alias("_i"))
    return (rows.join(shuffled, [*CELL, "_i"]).drop("_i")
            .withColumn("target", F.col("aqi") + F.col("delta")))


def target_mode_compare(metrics_by_mode: Mapping[str, DataFrame]) -> DataFrame:
    """Curve means per target mode, model and series, with the margin over persistence."""
    parts = [curve_summary(m).withColumn("target_mode", F.lit(mode))
             for mode, m in metrics_by_mode.items()]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    cell = Window.partitionBy(SERIES, "target_mode")
    base = F.min(F.when(F.col("model") == "persistence", F.col("curve_rmse"))).over(cell)
    return both.withColumn("margin_pct", gain_pct(base, F.col("curve_rmse"))).drop("rank")


def skipped_cells(features: DataFrame, training: DataFrame, horizons: list[int], k: int, min_train: int) -> DataFrame:
    """(series, horizon, n_rows, reason) of every series and horizon that has no scored fold.

    Series are those of ``features``, so one without any usable row is named as well.
    """
    asked = features.select(SERIES).distinct().select(
        SERIES, F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon"))
    counted = training.groupBy(*CELL).agg(F.count("*").alias("_n"))
    rows = asked.join(counted, CELL, "left").withColumn("n_rows", F.coalesce("_n", F.lit(0)))
    # The last fold has the most training rows: all but the last of its k + 1 blocks.
    largest = F.col("n_rows") - F.expr(f"n_rows div {k + 1}")
    few = F.col("n_rows") < 2 * min_train
    reason = F.when(few, F.format_string("only %d usable rows", "n_rows")).when(
        (largest < min_train) | (F.col("n_rows") < k + 1), F.lit("no fold has enough training rows"))
    return rows.withColumn("reason", reason).where("reason IS NOT NULL").select(*CELL, "n_rows", "reason")
