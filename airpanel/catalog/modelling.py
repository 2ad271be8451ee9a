"""Queries: models, evaluation, selection, serving, explanation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.catalog import sqltext as S
from airpanel.catalog.base import Tables, query
from airpanel.catalog.timeseries import hourly_features
from airpanel.models import evaluate, explain, linear, trees
from airpanel.models.evaluate import CELL
from airpanel.operators import timegrid
from airpanel.operators.aggregates import correlation
from airpanel.operators.features import (
    add_hourly_features, daily_frame, daily_training_rows, training_rows)
from airpanel.operators.relational import candidate_rows, latest_row
from airpanel.plans import serving, training
from airpanel.schemas import (
    DAILY_FEATURES, HOUR, HOURLY_FEATURES, METRICS, REPORT_HORIZONS, SERIES)
from airpanel.session import stored
from airpanel.sources import store, writers

FOLDS, MIN_TRAIN = 4, 100  # a month of hours per series: smaller training sets than in production
CONFIG = training.HourlyConfig(cutoff=None, folds=FOLDS, min_train=MIN_TRAIN)

_LONG = f"WITH {S.chain()}, {S.features()}, {S.long_rows()}, {S.folds()}"
_SCORED = f"{_LONG}, {S.reversion()}, {S.baseline_scores()}"
_METRICS = f"{_SCORED}, {S.summary()}"
_SCORE_FLOATS = "rmse mae r2 delta_r2 k"
_METRIC_FLOATS = "rmse rmse_std mae r2 delta_r2 k"


def long_rows(t: Tables, horizons: list[int] | None = None) -> DataFrame:
    return training_rows(hourly_features(t), horizons=horizons)


def metrics(t: Tables) -> DataFrame:
    return evaluate.cross_validate(long_rows(t), FOLDS, MIN_TRAIN)


def daily_rows(t: Tables) -> DataFrame:
    return daily_training_rows(daily_frame(t.daily_readings()))


# -- folds and baselines --------------------------------------------------------------------

@query("e1_expanding_folds", sql=f"""
{_LONG} SELECT series_id, horizon, hr, CAST(block AS INTEGER) AS block, n_train, is_scored FROM fd""")
def e1(t: Tables) -> DataFrame:
    return evaluate.expanding_folds(long_rows(t), FOLDS, MIN_TRAIN).select(
        SERIES, "horizon", HOUR, "block", "n_train", "is_scored")


@query("e4_fold_ranges", sql=f"""
{_LONG} SELECT series_id, horizon, CAST(block AS INTEGER) AS fold, min(ts) AS test_start,
  max(ts) AS test_end, any_value(n_train) AS n_train, count(*) AS n_test
FROM fd WHERE is_scored GROUP BY series_id, horizon, block""")
def e4(t: Tables) -> DataFrame:
    return evaluate.fold_ranges(evaluate.expanding_folds(long_rows(t), FOLDS, MIN_TRAIN))


@query("a12_fit_reversion_k", floats="k", sql=f"""
{_LONG}, {S.reversion()} SELECT series_id, horizon, CAST(fold AS INTEGER) AS fold, k FROM kk
UNION ALL SELECT series_id, horizon, 0 AS fold,
  sum(-aqi_minus_roll24 * delta) / sum(aqi_minus_roll24 * aqi_minus_roll24) AS k
FROM fd GROUP BY series_id, horizon""")
def a12(t: Tables) -> DataFrame:
    folded = evaluate.expanding_folds(long_rows(t), FOLDS, MIN_TRAIN)
    return evaluate.fit_reversion_k(folded, "aqi_minus_roll24")


@query("e1_purged_reversion_k", floats="k", sql=f"""
{_LONG}, ends AS (SELECT series_id, horizon, block + 1 AS fold, max(hr) AS last_hr FROM fd GROUP BY ALL)
SELECT e.series_id, e.horizon, CAST(e.fold AS INTEGER) AS fold,
  CASE WHEN sum(t.aqi_minus_roll24 * t.aqi_minus_roll24) > 0 THEN
    sum(-t.aqi_minus_roll24 * t.delta) / sum(t.aqi_minus_roll24 * t.aqi_minus_roll24) ELSE 0 END AS k
FROM ends e JOIN fd t ON t.series_id = e.series_id AND t.horizon = e.horizon AND t.block < e.fold
  AND (t.block < e.fold - 1 OR t.hr + t.horizon <= e.last_hr)
WHERE e.fold <= {FOLDS} GROUP BY ALL""")
def e1_purged(t: Tables) -> DataFrame:
    """Folds whose training rows may not look into the test block."""
    folded = evaluate.expanding_folds(long_rows(t), FOLDS, MIN_TRAIN, purge=True)
    return evaluate.fit_reversion_k(folded, "aqi_minus_roll24").filter("fold > 0")


def _prediction(name: str):
    def run(t: Tables) -> DataFrame:
        folded = evaluate.expanding_folds(long_rows(t), FOLDS, MIN_TRAIN)
        rows = evaluate.with_reversion_k(folded, "aqi_minus_roll24").filter("is_scored")
        return rows.select(
            SERIES, "horizon", HOUR, evaluate.hourly_baselines()[name].alias("predicted"))
    return run


def _prediction_sql(expr: str) -> str:
    return f"""{_LONG}, {S.reversion()}
SELECT d.series_id, d.horizon, d.hr, CAST({expr} AS DOUBLE) AS predicted FROM fd d
JOIN kk ON kk.series_id = d.series_id AND kk.horizon = d.horizon AND kk.fold = d.block WHERE d.is_scored"""


query("m1_persistence", floats="predicted", sql=_prediction_sql("0"))(_prediction("persistence"))
query("m2_diurnal_naive", floats="predicted", sql=_prediction_sql("aqi_lag24 - aqi"))(
    _prediction("diurnal_naive"))
query("m3_damped_reversion", floats="predicted", sql=_prediction_sql("k * -aqi_minus_roll24"))(
    _prediction("damped_reversion"))


_DLONG = f"""WITH {S.daily()},
{S.long_rows('df', 'dlg', [1, 2, 3], ' AND '.join(c + ' IS NOT NULL' for c in S.DAILY_FEATURES), 'pos')},
{S.folds('dlg', 'dfd', 5, 60, 'pos')}, {S.reversion('dfd', 'dkk', 'aqi_minus_rolling_7')},
{S.baseline_scores('dfd', 'dkk', 'dsc', daily=True)}, {S.summary('dsc', 'dmt')}"""


@query("m4_climatology_7d", floats="predicted", sql=f"""
{_DLONG} SELECT horizon, date, -aqi_minus_rolling_7 AS predicted FROM dfd""")
def m4(t: Tables) -> DataFrame:
    return daily_rows(t).select(
        "horizon", "date", evaluate.daily_baselines()["climatology_7d"].alias("predicted"))


_METRIC_COLUMNS = ("series_id, horizon, model, CAST(model_order AS INTEGER) AS model_order, n_rows, "
                   "n_folds, rmse, rmse_std, mae, r2, delta_r2, k")


@query("e3_cross_validate_daily", floats=_METRIC_FLOATS, sql=f"{_DLONG} SELECT {_METRIC_COLUMNS} FROM dmt")
def e3_daily(t: Tables) -> DataFrame:
    return evaluate.cross_validate(daily_rows(t), 5, 60, daily=True)


@query("e2_score", floats=_SCORE_FLOATS, sql=f"""
{_SCORED} SELECT series_id, horizon, CAST(fold AS INTEGER) AS fold, n_rows, n_test, model,
  CAST(model_order AS INTEGER) AS model_order, rmse, mae, r2, delta_r2, k FROM sc""")
def e2(t: Tables) -> DataFrame:
    return evaluate.baseline_scores(long_rows(t), FOLDS, MIN_TRAIN)


@query("e3_cross_validate", floats=_METRIC_FLOATS, sql=f"{_METRICS} SELECT {_METRIC_COLUMNS} FROM mt")
def e3(t: Tables) -> DataFrame:
    return metrics(t)


@query("a9_fold_summary", floats="rmse rmse_std", sql=f"""
{_METRICS} SELECT series_id, model, horizon, n_folds, rmse, rmse_std FROM mt""")
def a9(t: Tables) -> DataFrame:
    scores = evaluate.baseline_scores(long_rows(t), FOLDS, MIN_TRAIN)
    return evaluate.fold_summary(scores).select(
        SERIES, "model", "horizon", "n_folds", "rmse", "rmse_std")


_WINNER = f"""{_METRICS}, wn AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY series_id, horizon ORDER BY rmse, model_order) AS pick FROM mt) WHERE pick = 1)"""


@query("a11_pick_winner", floats="rmse mae", sql=f"""
{_WINNER} SELECT series_id, horizon, model, rmse, mae FROM wn""")
def a11(t: Tables) -> DataFrame:
    return evaluate.pick_winner(metrics(t)).select(SERIES, "horizon", "model", "rmse", "mae")


_CURVE = """cu AS (SELECT series_id, model, any_value(model_order) AS model_order, avg(rmse) AS curve_rmse,
  avg(rmse) FILTER (horizon IN (24, 48, 72)) AS report_rmse, count(*) AS n_horizons
  FROM mt GROUP BY series_id, model)"""


@query("a10_curve_mean", floats="curve_rmse report_rmse", sql=f"""
{_METRICS}, {_CURVE} SELECT series_id, model, curve_rmse, report_rmse FROM cu""")
def a10(t: Tables) -> DataFrame:
    return evaluate.curve_summary(metrics(t)).select(SERIES, "model", "curve_rmse", "report_rmse")


@query("e6_curve_summary", floats="curve_rmse report_rmse", sql=f"""
{_METRICS}, {_CURVE} SELECT series_id, model, CAST(model_order AS INTEGER) AS model_order, curve_rmse,
  report_rmse, n_horizons, CAST(row_number() OVER (
    PARTITION BY series_id ORDER BY curve_rmse, model_order) AS INTEGER) AS rank FROM cu""")
def e6(t: Tables) -> DataFrame:
    return evaluate.curve_summary(metrics(t))


_GAIN = "CASE WHEN b.base > 0 THEN (b.base - m.rmse) / b.base * 100 END AS gain"
_BASE = """bs AS (SELECT series_id, horizon, rmse AS base FROM mt WHERE model = 'persistence')"""


@query("e5_select_models", floats="rmse gain", sql=f"""
{_WINNER}, {_BASE}, al AS (SELECT series_id, horizon, model, rmse FROM mt
  UNION ALL SELECT series_id, horizon, 'WINNER:' || model, rmse FROM wn)
SELECT m.series_id, m.horizon, model, rmse, {_GAIN} FROM al m
LEFT JOIN bs b ON b.series_id = m.series_id AND b.horizon = m.horizon""")
def e5(t: Tables) -> DataFrame:
    return evaluate.select_models(metrics(t), mark=True).select(
        SERIES, "horizon", "model", "rmse", "gain")


@query("p13_candidate_rows", floats="rmse", sql=f"""
{_METRICS} SELECT series_id, horizon, model, rmse FROM mt""")
def p13(t: Tables) -> DataFrame:
    marked = evaluate.select_models(metrics(t), mark=True)
    return candidate_rows(marked).select(SERIES, "horizon", "model", "rmse")


@query("v4_skill_table", floats="rmse baseline_rmse gain", sql=f"""
{_WINNER}, {_BASE} SELECT m.series_id, m.horizon, m.model, m.rmse, b.base AS baseline_rmse, {_GAIN}
FROM wn m LEFT JOIN bs b ON b.series_id = m.series_id AND b.horizon = m.horizon""")
def v4(t: Tables) -> DataFrame:
    return evaluate.skill_table(metrics(t)).select(
        SERIES, "horizon", "model", "rmse", "baseline_rmse", "gain")


@query("v5_registry_metrics", floats="rmse mae r2", sql=f"""
{_WINNER} SELECT series_id, horizon, 'WINNER:' || model AS model, rmse, mae, r2 FROM wn""")
def v5(t: Tables) -> DataFrame:
    return evaluate.registry_metrics(evaluate.select_models(metrics(t), mark=True))


@query("s12_write_metrics", floats=_METRIC_FLOATS, sql=f"""
{_METRICS} SELECT {_METRIC_COLUMNS.replace('CAST(model_order AS INTEGER) AS model_order, ', '')} FROM mt""")
def s12(t: Tables) -> DataFrame:
    """Metrics written as CSV and read back under the declared schema."""
    path = t.folder("metrics")
    names = [f.name for f in METRICS.fields]
    writers.write_metrics(metrics(t).select(*names), path, "csv")
    return writers.read_metrics(t.spark, path, METRICS, "csv")


@query("e9_target_mode_compare", floats="curve_rmse report_rmse margin_pct", sql=(
    "WITH " + ",\n".join(
        f"{mode}_ AS (WITH {S.metrics(mode=mode)}, {_CURVE} SELECT *, '{mode}' AS target_mode FROM cu)"
        for mode in ("epa24h", "instant"))
    + """, bo AS (SELECT * FROM epa24h_ UNION ALL SELECT * FROM instant_)
SELECT m.series_id, m.model, CAST(m.model_order AS INTEGER) AS model_order, m.curve_rmse, m.report_rmse,
  m.n_horizons, m.target_mode,
  CASE WHEN b.curve_rmse > 0 THEN (b.curve_rmse - m.curve_rmse) / b.curve_rmse * 100 END AS margin_pct
FROM bo m LEFT JOIN bo b ON b.series_id = m.series_id AND b.target_mode = m.target_mode
  AND b.model = 'persistence'"""))
def e9(t: Tables) -> DataFrame:
    by_mode = {}
    for mode in ("epa24h", "instant"):
        grid = timegrid.hourly_frame(t.faulty_readings(), mode=mode)
        by_mode[mode] = evaluate.cross_validate(
            training_rows(add_hourly_features(grid)), FOLDS, MIN_TRAIN)
    return evaluate.target_mode_compare(by_mode)


# -- linear models --------------------------------------------------------------------------

@query("m11_standardise", floats="aqi aqi_roll24 pm10", sql=f"""
WITH {S.chain()}, {S.features()}, cc AS (SELECT * FROM ft WHERE {S.COMPLETE})
SELECT series_id, hr, (aqi - avg(aqi) OVER w) / stddev_pop(aqi) OVER w AS aqi,
  (aqi_roll24 - avg(aqi_roll24) OVER w) / stddev_pop(aqi_roll24) OVER w AS aqi_roll24,
  (pm10 - avg(pm10) OVER w) / stddev_pop(pm10) OVER w AS pm10
FROM cc WINDOW w AS (PARTITION BY series_id)""")
def m11(t: Tables) -> DataFrame:
    rows = hourly_features(t).na.drop(subset=HOURLY_FEATURES).select(
        SERIES, HOUR, "aqi", "aqi_roll24", "pm10")
    return linear.standardise(rows, ["aqi", "aqi_roll24", "pm10"], [SERIES])


def _fits(t: Tables, model: str) -> tuple[DataFrame, DataFrame]:
    """(fold frame, fits of one linear model on every horizon and fold)."""
    folded = stored(evaluate.expanding_folds(long_rows(t), FOLDS, MIN_TRAIN), "folds")
    return folded, stored(linear.fit_folds(folded, FOLDS, MIN_TRAIN, models=(model,)), "fits")


def _linear_metrics(t: Tables, model: str) -> DataFrame:
    """Cross-validated errors of one linear model; the penalty search has no SQL form."""
    folded, fits = _fits(t, model)
    test, _ = training.candidate_predictions(folded, fits, fits, (model,), ())
    return evaluate.fold_summary(evaluate.score(test, {model: F.col(model)}, evaluate.HOURLY_CANDIDATES))


@query("m5_ridge")
def m5(t: Tables) -> DataFrame:
    """Cross-validated ridge on every horizon."""
    return _linear_metrics(t, "ridge")


@query("m6_elastic_net")
def m6(t: Tables) -> DataFrame:
    """Cross-validated elastic net on every horizon."""
    return _linear_metrics(t, "elastic_net")


def _certificate_sql(model: str) -> str:
    """Sizes of all training sets that are large enough; every fit on them has to be an optimum."""
    sizes = " UNION ALL ".join(
        f"SELECT series_id, horizon, {f} AS fold, count(*) AS n_train FROM fd WHERE {f'block < {f}' if f else 'TRUE'} "
        "GROUP BY series_id, horizon" for f in range(FOLDS + 1))
    return (f"{_LONG} SELECT series_id, horizon, CAST(fold AS INTEGER) AS fold, '{model}' AS model, n_train, TRUE AS holds "
            f"FROM ({sizes}) WHERE n_train >= {MIN_TRAIN}")


def _certified(t: Tables, model: str, tolerance: float) -> DataFrame:
    folded, fits = _fits(t, model)
    return linear.certificate(folded, fits, HOURLY_FEATURES, tolerance).drop("worst")


@query("m5_ridge_certificate", sql=_certificate_sql("ridge"))
def m5_certificate(t: Tables) -> DataFrame:
    """The normal equations of every ridge fit, checked on its training rows."""
    return _certified(t, "ridge", 1e-6)


@query("m6_elastic_net_certificate", sql=_certificate_sql("elastic_net"))
def m6_certificate(t: Tables) -> DataFrame:
    """The subgradient conditions of every elastic-net fit, checked on its training rows, within its tolerance."""
    return _certified(t, "elastic_net", 1e-3)


@query("m5_ridge_daily")
def m5_daily(t: Tables) -> DataFrame:
    return evaluate.fold_summary(_daily_panel(t, {}).scores)


@query("l1_coefficient_table")
def l1(t: Tables) -> DataFrame:
    """Standardised ridge coefficients at the report horizons, one column per horizon."""
    fits = linear.fit_linear(long_rows(t, REPORT_HORIZONS), FOLDS, MIN_TRAIN, models=("ridge",))
    return _pivoted(linear.coefficient_table(fits, HOURLY_FEATURES))


def _pivoted(long: DataFrame) -> DataFrame:
    return (long.groupBy(SERIES, "position", "feature").pivot("horizon", REPORT_HORIZONS)
            .agg(F.first("value")).orderBy(SERIES, "position"))


_GIVEN = ["aqi_diff1", "aqi_minus_roll24", "aqi_minus_roll168", "aqi_minus_hourly_norm"]


@query("l1_table_of_given_coefficients", floats='"24" "48" "72"', sql=f"""
{_LONG} SELECT series_id, CAST(position AS INTEGER) AS position, feature, {', '.join(
    f'max(value) FILTER (horizon = {h}) AS "{h}"' for h in REPORT_HORIZONS)} FROM ({' UNION ALL '.join(
    f"SELECT series_id, horizon, {i} AS position, '{c}' AS feature, corr({c}, delta) AS value FROM fd GROUP BY ALL"
    for i, c in enumerate(_GIVEN))}) GROUP BY ALL""")
def l1_given(t: Tables) -> DataFrame:
    """The table of one-feature coefficients, which are correlations, at the report horizons."""
    fits = long_rows(t, REPORT_HORIZONS).groupBy(*CELL).agg(
        F.array(*[F.corr(c, "delta") for c in _GIVEN]).alias("standardised"))
    return _pivoted(linear.coefficient_table(
        fits.withColumns({"fold": F.lit(0), "model": F.lit("ridge")}), _GIVEN))


@query("l2_attribution")
def l2(t: Tables) -> DataFrame:
    """Mean absolute attribution of the ridge fit at +24 h over all rows, around their means, per series."""
    rows = stored(long_rows(t, [24]), "rows")
    fits = linear.fit_linear(rows, FOLDS, MIN_TRAIN, models=("ridge",)).filter("fold = 0")
    return explain.mean_abs_attribution(
        explain.linear_attribution(rows, fits, HOURLY_FEATURES),
        [SERIES, "horizon", "feature"])


@query("l2_attribution_of_given_weights", floats="mean_abs", sql=f"""
{_LONG} SELECT series_id, horizon, feature, avg(abs(w * (x - m))) AS mean_abs FROM ({' UNION ALL '.join(
    f"SELECT series_id, horizon, '{c}' AS feature, {i + 1}.0::DOUBLE AS w, CAST({c} AS DOUBLE) AS x, "
    f"avg({c}) OVER (PARTITION BY series_id, horizon) AS m FROM fd" for i, c in enumerate(_GIVEN))})
GROUP BY ALL""")
def l2_given(t: Tables) -> DataFrame:
    """Attributions of linear models whose weights are given, per series and horizon."""
    rows = long_rows(t)
    weights = F.array(*[F.lit(float(i + 1)) for i in range(len(_GIVEN))])
    given = rows.select(SERIES, "horizon").distinct().withColumn("weights", weights)
    return explain.mean_abs_attribution(
        explain.linear_attribution(rows, given, _GIVEN), [SERIES, "horizon", "feature"])


@query("l3_attribution_linearity")
def l3_attribution(t: Tables) -> DataFrame:
    """How linear the boosted trees' response to each feature is, per series and horizon, over all rows."""
    rows, models = _boosted_on_everything(t)
    long = explain.tree_attribution(rows, models, HOURLY_FEATURES)
    return explain.response_linearity(long, [SERIES, "horizon", "feature"])


@query("l3_response_linearity", floats="slope intercept r2", sql=f"""
{_LONG} SELECT feature, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2
FROM ({' UNION ALL '.join(
    f"SELECT '{c}' AS feature, {c} AS x, least(500, greatest(0, target)) - aqi AS y FROM fd WHERE horizon = 24"
    for c in ("aqi_diff1", "aqi_minus_roll24", "aqi_minus_roll168", "aqi_minus_hourly_norm"))})
GROUP BY feature""")
def l3(t: Tables) -> DataFrame:
    names = ["aqi_diff1", "aqi_minus_roll24", "aqi_minus_roll168", "aqi_minus_hourly_norm"]
    response = (F.least(F.lit(500.0), F.greatest(F.lit(0.0), "target")) - F.col("aqi"))
    rows = long_rows(t, [24]).withColumn("attribution", response)
    return explain.response_linearity(
        rows.unpivot(["attribution"], names, "feature", "x"))


@query("e8_shuffled_targets", sql=f"""
{_LONG}, rk AS (SELECT series_id, horizon, hr, aqi, target - aqi AS delta,
  row_number() OVER (PARTITION BY series_id, horizon ORDER BY hr) AS i,
  row_number() OVER (PARTITION BY series_id, horizon ORDER BY md5(concat_ws('|', hr, 42)), hr) AS j FROM fd)
SELECT a.series_id, a.horizon, a.hr, CAST(a.aqi + b.delta AS BIGINT) AS target
FROM rk a JOIN rk b ON a.series_id = b.series_id AND a.horizon = b.horizon AND a.i = b.j""")
def e8_targets(t: Tables) -> DataFrame:
    """The permuted targets themselves, all horizons."""
    return evaluate.shuffled_targets(long_rows(t)).select(
        SERIES, F.col("horizon"), HOUR, F.col("target").cast("bigint").alias("target"))


@query("e8_shuffled_target_control")
def e8(t: Tables) -> DataFrame:
    """Ridge on permuted targets, every horizon: its delta_r2 has to stay near or below zero."""
    rows = stored(evaluate.shuffled_targets(long_rows(t)), "shuffled")
    fits = stored(linear.fit_linear(rows, FOLDS, MIN_TRAIN, models=("ridge",)), "fits")
    return evaluate.fold_summary(training.linear_scores(
        rows, fits, FOLDS, MIN_TRAIN, HOURLY_FEATURES, ("ridge",), HOUR,
        evaluate.HOURLY_CANDIDATES))


# -- the panel of all candidates --------------------------------------------------------------

def _panel(t: Tables, features: DataFrame | None = None) -> training.Panel:
    return training.evaluate_hourly(hourly_features(t) if features is None else features, CONFIG)


def _daily_panel(t: Tables, tree_models: dict | None = None) -> training.Panel:
    return training.evaluate_daily(t.daily_readings(), tree_models=tree_models)


def _counts_sql(chain: str, folded: str, models: list[str]) -> str:
    """Rows of every candidate in a complete panel."""
    names = ", ".join(f"('{m}')" for m in models)
    return f"""{chain}, ts AS (SELECT series_id, horizon, block, any_value(n_rows) AS n_rows, count(*) AS n FROM {folded}
  WHERE is_scored GROUP BY ALL)
SELECT series_id, horizon, model, any_value(n_rows) AS n_rows, count(*) AS n_folds, TRUE AS is_complete
FROM ts, (VALUES {names}) AS c(model) GROUP BY series_id, horizon, model"""


def _counted(scores: DataFrame) -> DataFrame:
    known = F.col("rmse").isNotNull() & F.col("mae").isNotNull() & F.col("r2").isNotNull() & F.col("delta_r2").isNotNull()
    return scores.groupBy(*CELL, "model").agg(
        F.first("n_rows").alias("n_rows"), F.count("*").alias("n_folds"), F.bool_and(known).alias("is_complete"))


@query("e3_candidate_panel", sql=_counts_sql(_LONG, "fd", evaluate.HOURLY_CANDIDATES))
def e3_panel(t: Tables) -> DataFrame:
    """All eight hourly candidates on every horizon and fold: what the table of scores holds."""
    return _counted(_panel(t).scores)


@query("e3_candidate_metrics")
def e3_metrics(t: Tables) -> DataFrame:
    """The scores of all eight hourly candidates."""
    return evaluate.fold_summary(_panel(t).scores)


@query("e3_candidate_panel_daily", sql=_counts_sql(_DLONG, "dfd", evaluate.DAILY_CANDIDATES))
def e3_panel_daily(t: Tables) -> DataFrame:
    """All five daily candidates, forest included, on every horizon and fold."""
    return _counted(_daily_panel(t).scores)


@query("e3_skipped_cells", sql=f"""
{_LONG}, asked AS (SELECT s.series_id, h.horizon FROM (SELECT DISTINCT series_id FROM ft) s,
  (VALUES {', '.join(f'({h})' for h in S.HORIZONS)}) AS h(horizon)),
n AS (SELECT a.series_id, a.horizon, count(l.series_id) AS n_rows FROM asked a
  LEFT JOIN lg l ON l.series_id = a.series_id AND l.horizon = a.horizon GROUP BY ALL)
SELECT series_id, CAST(horizon AS INTEGER) AS horizon, n_rows, 'only ' || n_rows || ' usable rows' AS reason FROM n WHERE n_rows < 2 * 240""")
def e3_skipped(t: Tables) -> DataFrame:
    """Series and horizons with too few rows, and why, if a training set needs 240."""
    features = hourly_features(t)
    return evaluate.skipped_cells(features, training_rows(features), S.HORIZONS, FOLDS, 240)


def _winners(t: Tables) -> tuple[DataFrame, training.Panel, DataFrame]:
    """(features, panel, final models of the winners among all candidates)."""
    features = stored(hourly_features(t), "features")
    panel = _panel(t, features)
    return features, panel, stored(training.final_models(panel, MIN_TRAIN, CONFIG.tree_models), "final")


_PARAMETERS = {
    "damped_reversion": "k", "damped_persistence": "k", "ridge": "weights", "elastic_net": "weights",
    "hist_gbr": "trees", "boosted_residual": "trees", "ensemble": "trees", "random_forest": "trees"}


def _has_parameters() -> Column:
    """Whether a final model has what its kind needs."""
    held = F.lit(True)
    for model, column in _PARAMETERS.items():
        held = F.when(F.col("model") == model, F.col(column).isNotNull()).otherwise(held)
    on_linear = F.when(F.col("model").isin(*training.LINEAR_PART), F.col("weights").isNotNull()).otherwise(True)
    return held & on_linear


@query("e7_fit_final")
def e7(t: Tables) -> DataFrame:
    """Winner per series and horizon among all eight candidates, refitted on all rows."""
    return _winners(t)[2].select(
        SERIES, "horizon", "model", "n_train", "k", "alpha", "l1_ratio", "intercept", F.size("trees.roots").alias("n_trees"))


@query("e7_final_counts", sql=f"""
{_LONG} SELECT series_id, horizon, count(*) AS n_train, TRUE AS is_fitted FROM fd GROUP BY series_id, horizon""")
def e7_counts(t: Tables) -> DataFrame:
    """One model per series and horizon, fitted on all complete rows, with the parameters of its kind."""
    return _winners(t)[2].select(SERIES, "horizon", "n_train", _has_parameters().alias("is_fitted"))


@query("e7_final_counts_daily", sql=f"""
{_DLONG} SELECT series_id, horizon, count(*) AS n_train, TRUE AS is_fitted FROM dfd GROUP BY series_id, horizon""")
def e7_counts_daily(t: Tables) -> DataFrame:
    final = training.final_models(_daily_panel(t), evaluate.MIN_TRAIN_DAILY, trees.DAILY_TREES, training.DAILY)
    return final.select(SERIES, "horizon", "n_train", _has_parameters().alias("is_fitted"))


@query("s11_register_models")
def s11(t: Tables) -> DataFrame:
    """The winners among all candidates, registered and read back with their metrics."""
    _, panel, models = _winners(t)
    root = t.folder("registry")
    marked = evaluate.select_models(evaluate.fold_summary(panel.scores), mark=True)
    store.register_models(models, evaluate.registry_metrics(marked), root)
    return store.read_registry(t.spark, root).select(
        SERIES, "horizon", "name", "model", "target", F.col("metrics")["rmse"].alias("rmse"),
        F.size("metrics").alias("n_metrics"), F.size("trees.roots").alias("n_trees"), "version")


@query("s11_registry_versions", floats="rmse", sql=f"""
{_WINNER} SELECT series_id, horizon, 'aqi_hourly_h' || horizon AS name, model, rmse, 3 AS n_metrics, CAST(v AS INTEGER) AS version
FROM wn, (VALUES (1), (2)) AS x(v) WHERE v = 2 OR horizon <= 24""")
def s11_versions(t: Tables) -> DataFrame:
    """Two registrations of the baselines' winners, the first of the near horizons only, both read back."""
    summary = stored(metrics(t), "metrics")
    winners = evaluate.pick_winner(summary).select(*CELL, "model")
    root = t.folder("registry")
    best = evaluate.registry_metrics(summary)
    first = store.register_models(winners.where("horizon <= 24"), best, root)
    store.register_models(winners, best, root)
    both = store.read_registry(t.spark, root, first).unionByName(store.read_registry(t.spark, root))
    return both.select(SERIES, "horizon", "name", "model", F.col("metrics")["rmse"].alias("rmse"),
                       F.size("metrics").alias("n_metrics"), "version")


# -- tree models ----------------------------------------------------------------------------

@query("m7_m8_m9_boosted_models")
def m789(t: Tables) -> DataFrame:
    """Boosting, boosting on ridge residuals and their ensemble: every horizon and fold, up to 500 and 300 rounds."""
    return _panel(t).scores.filter(F.col("model").isin("hist_gbr", "boosted_residual", "ensemble"))


def _models_sql(chain: str, folded: str, names: list[str], k: int, min_train: int) -> str:
    sizes = " UNION ALL ".join(f"SELECT series_id, horizon, {f} AS fold, count(*) AS n_train FROM {folded} "
                               f"WHERE n_rows >= {2 * min_train} AND block < {f} GROUP BY ALL" for f in range(1, k + 1))
    return f"""{chain} SELECT series_id, horizon, CAST(fold AS INTEGER) AS fold, model, n_train, TRUE AS is_sound
FROM ({sizes}), (VALUES {', '.join(f"('{n}')" for n in names)}) AS c(model) WHERE n_train >= {min_train}"""


def _sound(models: DataFrame, most: dict[str, int]) -> DataFrame:
    """Whether a model's trees are whole: as many as its rounds allow, every inner node with two children behind it."""
    nodes = trees.nodes(models)
    inner = F.col("feature") >= 0
    whole = F.bool_and(F.when(inner, (F.col("left") > F.col("node")) & (F.col("right") == F.col("left") + 1)
                              & F.col("threshold").isNotNull()).otherwise(F.col("left") == -1))
    children = F.sum(F.when(inner, 2).otherwise(0))
    key = [*CELL, "fold", "model"]
    checked = nodes.groupBy(*key).agg(whole.alias("w"), (F.count("*") - children).alias("n_roots"))
    limit = F.lit(0)
    for name, rounds in most.items():
        limit = F.when(F.col("model") == name, F.lit(rounds)).otherwise(limit)
    roots = F.coalesce("n_roots", F.lit(0))
    return models.select(*key, "n_train", "rounds", F.size("roots").alias("n")).join(checked, key, "left").select(
        *key, "n_train", (F.coalesce("w", F.lit(True)) & (roots == F.col("n")) & (F.col("n") <= F.col("rounds"))
                          & (F.col("rounds") <= limit)).alias("is_sound"))


@query("m7_m8_tree_tables", sql=_models_sql(_LONG, "fd", list(trees.HOURLY_TREES), FOLDS, MIN_TRAIN))
def m78_tables(t: Tables) -> DataFrame:
    """The boosted models of every horizon and fold as node tables: sizes of their training sets, and whole trees."""
    return _sound(_panel(t).trees, {n: s.rounds for n, s in trees.HOURLY_TREES.items()})


@query("m10_random_forest")
def m10(t: Tables) -> DataFrame:
    """Daily forest of 400 trees on every horizon and fold."""
    return _daily_panel(t).scores.filter("model = 'random_forest'")


@query("m10_tree_tables", sql=_models_sql(_DLONG, "dfd", ["random_forest"], 5, 60))
def m10_tables(t: Tables) -> DataFrame:
    """The forests of every horizon and fold as node tables."""
    return _sound(_daily_panel(t).trees, {"random_forest": 400})


def _boosted_on_everything(t: Tables, horizons: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(all training rows with fold 0, the boosted models fitted on them)."""
    folded = stored(evaluate.expanding_folds(long_rows(t, horizons), FOLDS, MIN_TRAIN).withColumn("fold", F.lit(0)), "folds")
    specs = {"hist_gbr": trees.HIST_GBR}
    return folded, stored(trees.fit_trees(folded, HOURLY_FEATURES, specs, [0], MIN_TRAIN), "trees")


@query("l2_tree_attribution")
def l2_trees(t: Tables) -> DataFrame:
    """Mean absolute path contribution of each feature to the boosted trees, per series and horizon, over all rows."""
    rows, models = _boosted_on_everything(t)
    return explain.mean_abs_attribution(
        explain.tree_attribution(rows, models, HOURLY_FEATURES), [SERIES, "horizon", "feature"])


@query("l2_tree_additivity", sql=f"""
{_LONG} SELECT series_id, horizon, count(*) AS n_rows, TRUE AS adds_up FROM fd GROUP BY series_id, horizon
HAVING count(*) >= {MIN_TRAIN}""")
def l2_additivity(t: Tables) -> DataFrame:
    """Base and contributions of every row against the prediction of the same trees."""
    rows, models = _boosted_on_everything(t)
    parts = trees.tree_contributions(rows, models, HOURLY_FEATURES)
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    predicted = trees.predict_trees(rows, models, HOURLY_FEATURES, ["hist_gbr"], keep=[HOUR])
    both = parts.select(*CELL, HOUR, total.alias("total")).join(predicted, [*CELL, HOUR])
    return both.groupBy(*CELL).agg(
        F.count("*").alias("n_rows"), (F.max(F.abs(F.col("total") - F.col("hist_gbr"))) <= 1e-6).alias("adds_up"))


@query("l2_permutation_importance")
def l2_permutation(t: Tables) -> DataFrame:
    """Rise of the boosted trees' error at +24 h when a feature is swapped between rows, per series, over all rows."""
    rows, models = _boosted_on_everything(t, [24])
    return explain.permutation_importance(models, rows, HOURLY_FEATURES, "hist_gbr")


# -- serving --------------------------------------------------------------------------------

_FORECAST = f"""{_WINNER}, {_BASE},
kf AS (SELECT series_id, horizon, sum(-aqi_minus_roll24 * delta) / sum(aqi_minus_roll24 * aqi_minus_roll24) AS k
  FROM fd GROUP BY series_id, horizon),
nw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY hr DESC) AS pick
  FROM ft WHERE {S.COMPLETE}) WHERE pick = 1),
fc AS (SELECT w.series_id, w.horizon, nw.ts + w.horizon * INTERVAL 1 HOUR AS ts,
    greatest(0, least(500, nw.aqi + CASE w.model WHEN 'persistence' THEN 0
      WHEN 'diurnal_naive' THEN nw.aqi_lag24 - nw.aqi ELSE kf.k * -nw.aqi_minus_roll24 END)) AS aqi,
    w.rmse, CASE WHEN b.base > 0 THEN (b.base - w.rmse) / b.base * 100 END AS gain, w.model
  FROM wn w JOIN nw ON nw.series_id = w.series_id
  JOIN kf ON kf.series_id = w.series_id AND kf.horizon = w.horizon
  LEFT JOIN bs b ON b.series_id = w.series_id AND b.horizon = w.horizon)"""


def _serve(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(forecast points, latest rows) from the baselines' winners."""
    features = stored(hourly_features(t), "features")
    folded = stored(evaluate.expanding_folds(training_rows(features), FOLDS, MIN_TRAIN), "folds")
    test, names = training.candidate_predictions(folded, folded, folded, (), ())
    summary = stored(evaluate.fold_summary(evaluate.score(
        test, {n: F.col(n) for n in names}, evaluate.HOURLY_CANDIDATES)), "metrics")
    k = evaluate.fit_reversion_k(folded, "aqi_minus_roll24").filter("fold = 0").drop("fold")
    models = evaluate.pick_winner(summary).select(*CELL, "model").join(k, CELL)
    latest = serving.latest_features(features)
    return serving.forecast(latest, models, evaluate.skill_table(summary)), latest


@query("v1_forecast", floats="aqi rmse gain", sql=f"{_FORECAST} SELECT * FROM fc")
def v1(t: Tables) -> DataFrame:
    return _serve(t)[0]


@query("v1_forecast_any_winner", sql=f"""
{_LONG}, nw AS (SELECT series_id, max(ts) AS ts FROM ft WHERE {S.COMPLETE} GROUP BY 1)
SELECT DISTINCT f.series_id, f.horizon, nw.ts + f.horizon * INTERVAL 1 HOUR AS ts, TRUE AS in_range
FROM fd f JOIN nw ON nw.series_id = f.series_id""")
def v1_any(t: Tables) -> DataFrame:
    """Forecast from the registered winners among all eight candidates: every horizon of every series has a number."""
    features, panel, models = _winners(t)
    root = t.folder("registry")
    summary = evaluate.fold_summary(panel.scores)
    store.register_models(models, evaluate.registry_metrics(summary), root)
    points = serving.forecast(
        serving.latest_features(features), store.read_registry(t.spark, root), evaluate.skill_table(summary))
    return points.select(SERIES, "horizon", "ts", F.col("aqi").between(0, 500).alias("in_range"))


@query("v1_forecast_trees", sql=f"""
{_LONG}, nw AS (SELECT series_id, max(ts) AS ts FROM ft WHERE {S.COMPLETE} GROUP BY 1)
SELECT DISTINCT f.series_id, f.horizon, nw.ts + f.horizon * INTERVAL 1 HOUR AS ts, TRUE AS in_range, 'hist_gbr' AS model
FROM fd f JOIN nw ON nw.series_id = f.series_id""")
def v1_trees(t: Tables) -> DataFrame:
    """Forecast of series whose registered model is a boosted one on every horizon."""
    rows, fits = _boosted_on_everything(t)
    models = fits.select(*CELL, "model", F.struct(*trees.PACKED_FIELDS).alias("trees"))
    skill = rows.select(*CELL).distinct().withColumns(
        {"rmse": F.lit(1.0), "gain": F.lit(None).cast("double"), "model": F.lit("hist_gbr")})
    points = serving.forecast(serving.latest_features(hourly_features(t)), models, skill)
    return points.select(SERIES, "horizon", "ts", F.col("aqi").between(0, 500).alias("in_range"), "model")


@query("v1_forecast_daily", sql=f"""
{_DLONG}, nw AS (SELECT series_id, max(date) AS date FROM df
  WHERE {' AND '.join(c + ' IS NOT NULL' for c in S.DAILY_FEATURES)} GROUP BY 1)
SELECT DISTINCT f.series_id, f.horizon, CAST(nw.date + f.horizon * INTERVAL 1 DAY AS DATE) AS date, TRUE AS in_range
FROM dfd f JOIN nw ON nw.series_id = f.series_id""")
def v1_daily(t: Tables) -> DataFrame:
    """Daily forecast from the winners among all five candidates."""
    panel = _daily_panel(t)
    models = training.final_models(panel, evaluate.MIN_TRAIN_DAILY, trees.DAILY_TREES, training.DAILY)
    latest = latest_row(daily_frame(t.daily_readings()), DAILY_FEATURES, "pos")
    skill = evaluate.skill_table(evaluate.fold_summary(panel.scores), "persistence_baseline")
    points = serving.forecast(latest, models, skill, DAILY_FEATURES, "days")
    return points.select(SERIES, "horizon", "date", F.col("aqi").between(0, 500).alias("in_range"))


@query("j5_attach_skill", floats="aqi rmse gain", sql=f"""
{_FORECAST} SELECT series_id, horizon, aqi, CASE WHEN horizon <= 48 THEN rmse END AS rmse,
  CASE WHEN horizon <= 48 THEN gain END AS gain FROM fc""")
def j5(t: Tables) -> DataFrame:
    points = _serve(t)[0]
    bare = points.drop("rmse", "gain", "model")
    known = points.filter("horizon <= 48").select(SERIES, "horizon", "rmse", "gain", "model")
    return serving.attach_skill(bare, known).select(SERIES, "horizon", "aqi", "rmse", "gain")


_OUTLOOK = f"""{_FORECAST}, al AS (SELECT series_id, ts, aqi, rmse FROM fc
  UNION ALL SELECT series_id, ts, aqi, 0 FROM nw),
ol AS (SELECT a.series_id, CAST(a.ts AS DATE) AS date, avg(a.aqi) AS avg, min(a.aqi) AS low,
  max(a.aqi) AS high, avg(a.rmse) AS err, count(*) AS n,
  CAST(a.ts AS DATE) = CAST(any_value(nw.ts) AS DATE) AS is_today
  FROM al a JOIN nw ON nw.series_id = a.series_id GROUP BY a.series_id, CAST(a.ts AS DATE))"""


@query("a8_daily_outlook", floats="avg low high err", sql=f"{_OUTLOOK} SELECT * FROM ol")
def a8(t: Tables) -> DataFrame:
    return serving.daily_outlook(*_serve(t))


@query("v2_outlook_tomorrow", floats="avg low high err", sql=f"""
{_OUTLOOK} SELECT * EXCLUDE (pick) FROM (SELECT *, row_number() OVER (
  PARTITION BY series_id ORDER BY date) AS pick FROM ol WHERE NOT is_today) WHERE pick = 1""")
def v2(t: Tables) -> DataFrame:
    return serving.tomorrow(serving.daily_outlook(*_serve(t)))


@query("v3_alert", floats="peak err", sql=f"""
{_FORECAST}, br AS (SELECT * FROM fc WHERE aqi > 120),
wo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY aqi DESC, horizon) AS pick,
    min(horizon) OVER (PARTITION BY series_id) AS h1, count(*) OVER (PARTITION BY series_id) AS nb FROM br)
  WHERE pick = 1),
fi AS (SELECT series_id, arg_min(ts, horizon) AS starts FROM br GROUP BY 1),
al AS (SELECT nw.series_id, coalesce(wo.aqi, nw.aqi) AS peak, coalesce(wo.ts, nw.ts) AS "at",
    coalesce(wo.rmse, 0) AS err, wo.series_id IS NULL AS is_now, CAST(coalesce(wo.h1, 0) AS INTEGER) AS first_horizon,
    fi.starts, coalesce(wo.nb, 0) AS n_breaches
  FROM nw LEFT JOIN wo ON wo.series_id = nw.series_id LEFT JOIN fi ON fi.series_id = nw.series_id
  WHERE wo.series_id IS NOT NULL OR nw.aqi > 120)
SELECT *, {S.display('peak')} AS label, {S.display('peak', 'colour')} AS colour,
  CASE WHEN is_now THEN 'now' WHEN first_horizon <= 24 THEN 'expected' ELSE 'possible' END AS severity
FROM al""")
def v3(t: Tables) -> DataFrame:
    return serving.alert(*_serve(t), threshold=120).drop("guidance")


@query("v6_recent_history", floats="aqi", sql=f"""
WITH {S.chain()} SELECT aq.series_id, ts, aqi FROM aq JOIN (
  SELECT series_id, max(ts) AS m FROM aq GROUP BY 1) x ON x.series_id = aq.series_id
WHERE ts >= m - INTERVAL 5 DAY AND aqi IS NOT NULL""")
def v6(t: Tables) -> DataFrame:
    return serving.recent_history(timegrid.hourly_frame(t.faulty_readings()), 5)


@query("v6_latest_readings", floats="value", sql=f"""
WITH {S.chain()}, nw AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY series_id ORDER BY hr DESC) AS pick FROM aq) WHERE pick = 1)
SELECT series_id, parameter, value FROM ({' UNION ALL '.join(
    f"SELECT series_id, '{c}' AS parameter, {c} AS value FROM nw" for c in S.COLS)})
WHERE value IS NOT NULL""")
def v6_latest(t: Tables) -> DataFrame:
    latest = latest_row(timegrid.hourly_frame(t.faulty_readings()))
    return serving.latest_readings(latest, [*S.COLS, "temperature_2m"])


@query("v7_importance_top10", floats="value", sql=f"""
WITH {S.chain()}, {S.features()}, co_ AS ({' UNION ALL '.join(
    f"SELECT series_id, '{c}' AS feature, corr({c}, aqi) AS value FROM ft GROUP BY series_id"
    for c in S.FEATURES if c not in ('aqi', 'day_of_week'))})
SELECT series_id, feature, abs(value) AS value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (
  PARTITION BY series_id ORDER BY abs(value) DESC, feature) AS rank FROM co_) WHERE rank <= 10""")
def v7(t: Tables) -> DataFrame:
    names = [c for c in HOURLY_FEATURES if c not in ("aqi", "day_of_week")]
    wide = hourly_features(t).groupBy(SERIES).agg(*[correlation(c, "aqi").alias(c) for c in names])
    return serving.importance_top([None, wide.unpivot([SERIES], names, "feature", "value")])


@query("x10_forecast_band", floats="low high", sql=f"""
{_FORECAST} SELECT series_id, horizon, aqi - coalesce(rmse, 0) AS low, aqi + coalesce(rmse, 0) AS high FROM fc""")
def x10_band(t: Tables) -> DataFrame:
    return serving.interval_band(_serve(t)[0]).select(SERIES, "horizon", "low", "high")
