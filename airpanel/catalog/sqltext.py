"""SQL building blocks of the twins (DuckDB dialect), as named CTE texts."""

from __future__ import annotations

COLS = ["pm25", "pm10", "o3", "no2", "so2", "co"]
LIST = ", ".join(COLS)
HR = "CAST(epoch_us({}) // 3600000000 AS BIGINT)"

_VALUE = "floor(value * 64) / 64"
_SENTINEL = f"CASE WHEN event_id % 97 = 0 THEN -9999e0 ELSE {_VALUE} END"
_FAULTY = (f"CASE WHEN NOT (day(ts) % 7 = 3 AND hour(ts) BETWEEN 2 AND 7) THEN {_SENTINEL} END")


def ev(kind: str = "plain", where: str = "") -> str:
    """CTE ``ev``: hourly panel readings."""
    pm25 = {"plain": _VALUE, "sentinel": _SENTINEL, "faulty": _FAULTY}[kind]
    return f"""ev AS (
  SELECT event_type AS series_id, ts AS observed_at, (event_id % 3 = 0) AS is_backfilled,
    event_id AS ingest_seq, {pm25} AS pm25,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pm10,
    CAST(user_id % 120 AS DOUBLE) AS o3, CAST(user_id % 37 AS DOUBLE) AS no2,
    CAST(event_id % 23 AS DOUBLE) AS so2, CAST(event_id % 401 AS DOUBLE) AS co,
    {HR.format('ts')} AS hr
  FROM events {where})"""


DAILY_EV = """dv AS (
  SELECT 'all' AS series_id, l_shipdate AS observed_at, l_quantity AS pm25,
    CAST(floor(l_extendedprice) AS DOUBLE) AS pm10, round(l_discount * 100) AS o3,
    round(l_tax * 100) AS no2, CAST(l_linenumber AS DOUBLE) AS so2,
    CAST(l_partkey % 100 AS DOUBLE) AS co
  FROM lineitem)"""


def means(source: str = "ev", name: str = "hm") -> str:
    return (f"{name} AS (SELECT series_id, hr, "
            + ", ".join(f"avg({c}) AS {c}" for c in COLS)
            + f" FROM {source} GROUP BY series_id, hr)")


def masked(source: str = "hm", name: str = "mk", keep: str = "series_id, hr") -> str:
    return (f"{name} AS (SELECT {keep}, "
            + ", ".join(f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" for c in COLS)
            + f" FROM {source})")


def grid(source: str = "mk", name: str = "gr") -> str:
    return f"""{name} AS (
  SELECT c.series_id, c.hr, {', '.join('h.' + c for c in COLS)}, h.hr IS NOT NULL AS is_observed
  FROM (SELECT series_id, unnest(generate_series(lo, hi)) AS hr
        FROM (SELECT series_id, min(hr) AS lo, max(hr) AS hi FROM {source} GROUP BY series_id)) c
  LEFT JOIN {source} h ON h.series_id = c.series_id AND h.hr = c.hr)"""


def fill(source: str = "gr", name: str = "fl", limit: int = 3, pos: str = "hr",
         cols: list[str] | None = None, rest: str = "series_id, hr, is_observed",
         strict: bool = False) -> str:
    cols = cols or COLS
    back = f"OVER (PARTITION BY series_id ORDER BY {pos} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER (PARTITION BY series_id ORDER BY {pos} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    near = ", ".join(
        f"last_value({c} IGNORE NULLS) {back} AS {c}_pv, "
        f"last_value(CASE WHEN {c} IS NOT NULL THEN {pos} END IGNORE NULLS) {back} AS {c}_pp, "
        f"first_value({c} IGNORE NULLS) {ahead} AS {c}_nv, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN {pos} END IGNORE NULLS) {ahead} AS {c}_np"
        for c in cols)

    def test(c: str) -> str:
        return (f"{c}_np - {c}_pp - 1 <= {limit}" if strict else f"{pos} - {c}_pp <= {limit}")

    out = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {test(c)} "
        f"THEN {c}_pv + ({c}_nv - {c}_pv) * ({pos} - {c}_pp) / ({c}_np - {c}_pp) END AS {c}"
        for c in cols)
    return f"{name} AS (SELECT {rest}, {out} FROM (SELECT *, {near} FROM {source}))"


# The breakpoint table once more, for the other engine.
_BANDS = [
    (0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400), (350.5, 500.4, 401, 500)]


def aqi(v: str) -> str:
    """INTEGER index of a concentration expression."""
    c = f"(floor(({v}) * 10) / 10)"
    arms = " ".join(
        f"WHEN {c} <= {hi}::DOUBLE THEN ({ih} - {il}) / ({hi}::DOUBLE - {lo}::DOUBLE) "
        f"* ({c} - {lo}::DOUBLE) + {il}" for lo, hi, il, ih in _BANDS)
    return (f"CAST(round_even(CASE WHEN ({v}) IS NULL OR isnan(({v})::DOUBLE) OR ({v}) < 0 THEN NULL "
            f"{arms} ELSE 500 END, 0) AS INTEGER)")


def category(v: str) -> str:
    return (f"CASE WHEN {v} > 500 THEN 'Hazardous' WHEN {v} BETWEEN 0 AND 50 THEN 'Good' "
            f"WHEN {v} BETWEEN 51 AND 100 THEN 'Moderate' "
            f"WHEN {v} BETWEEN 101 AND 150 THEN 'Unhealthy for Sensitive Groups' "
            f"WHEN {v} BETWEEN 151 AND 200 THEN 'Unhealthy' "
            f"WHEN {v} BETWEEN 201 AND 300 THEN 'Very Unhealthy' "
            f"WHEN {v} BETWEEN 301 AND 500 THEN 'Hazardous' END")


def display(v: str, what: str = "label") -> str:
    texts = {
        "label": ["Good", "Moderate", "Unhealthy for sensitive groups", "Unhealthy",
                  "Very unhealthy", "Hazardous", "Unknown"],
        "colour": ["#5b9c78", "#c9a94e", "#d18448", "#c25f4e", "#9a5b8c", "#8d4a52", "#7c93a8"],
    }[what]
    arms = " ".join(f"WHEN {v} <= {b} THEN '{t}'" for b, t in zip(
        [50, 100, 150, 200, 300, 500], texts, strict=False))
    return f"CASE WHEN {v} IS NULL THEN '{texts[6]}' {arms} ELSE '{texts[5]}' END"


def with_aqi(source: str = "fl", name: str = "aq", mode: str = "epa24h") -> str:
    w = "OVER (PARTITION BY series_id ORDER BY hr ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    pm = (f"CASE WHEN count(pm25) {w} >= 18 THEN round(avg(pm25) {w}, 6) END"
          if mode == "epa24h" else "pm25")
    return f"""{name} AS (
  SELECT * EXCLUDE (pm), CAST({aqi('pm')} AS DOUBLE) AS aqi,
    make_timestamp(hr * 3600000000) + INTERVAL 5 HOUR AS ts
  FROM (SELECT *, {pm} AS pm FROM {source}))"""


def chain(kind: str = "faulty", mode: str = "epa24h", mask: str = "after_mean") -> str:
    """CTEs ev .. aq: readings to the hourly frame with index."""
    if mask == "before_mean":
        parts = [ev(kind), masked("ev", "em", "series_id, hr"), means("em", "mk")]
    else:
        parts = [ev(kind), means(), masked()]
    return ",\n".join([*parts, grid(), fill(), with_aqi(mode=mode)])


LAG = "lag({c}, {n}) OVER (PARTITION BY series_id ORDER BY {o})"


def lag(n: int, c: str = "aqi", o: str = "hr") -> str:
    return LAG.format(c=c, n=n, o=o)


def prior(n: int, minimum: int, c: str = "aqi", o: str = "hr") -> str:
    w = f"OVER (PARTITION BY series_id ORDER BY {o} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({c}) {w} >= {minimum} THEN avg({c}) {w} END"


def features(source: str = "aq", name: str = "ft") -> str:
    return f"""{name} AS (
  SELECT *, aqi - aqi_roll24 AS aqi_minus_roll24, aqi - aqi_roll168 AS aqi_minus_roll168
  FROM (SELECT *,
    {lag(1)} AS aqi_lag1, {lag(2)} AS aqi_lag2, {lag(3)} AS aqi_lag3,
    aqi - {lag(1)} AS aqi_diff1, aqi - {lag(3)} AS aqi_diff3,
    {lag(24)} AS aqi_lag24, {lag(48)} AS aqi_lag48, {lag(168)} AS aqi_lag168,
    {prior(24, 18)} AS aqi_roll24, {prior(72, 48)} AS aqi_roll72, {prior(168, 120)} AS aqi_roll168,
    aqi - ({lag(24)} + {lag(48)} + {lag(72)}) / 3 AS aqi_minus_hourly_norm,
    sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
    sin(2 * pi() * dayofyear(ts) / 365.25) AS doy_sin,
    cos(2 * pi() * dayofyear(ts) / 365.25) AS doy_cos,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
  FROM {source}))"""


FEATURES = [
    *COLS, "aqi", "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_diff1", "aqi_diff3", "aqi_lag24",
    "aqi_lag48", "aqi_lag168", "aqi_roll24", "aqi_roll72", "aqi_roll168", "aqi_minus_roll24",
    "aqi_minus_roll168", "aqi_minus_hourly_norm", "hour_sin", "hour_cos", "doy_sin", "doy_cos",
    "day_of_week"]
FLOAT_FEATURES = [c for c in FEATURES if c != "day_of_week"]
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)

HORIZONS = [1, 3, 6, 12, 24, 36, 48, 60, 72]


def long_rows(source: str = "ft", name: str = "lg", horizons: list[int] | None = None,
              complete: str = COMPLETE, order: str = "hr") -> str:
    """Complete rows per horizon, with target and delta."""
    wide = ", ".join(
        f"lead(aqi, {h}) OVER (PARTITION BY series_id ORDER BY {order}) AS t{h}"
        for h in horizons or HORIZONS)
    each = " UNION ALL ".join(
        f"SELECT * EXCLUDE ({', '.join(f't{x}' for x in horizons or HORIZONS)}), "
        f"{h} AS horizon, t{h} AS target, t{h} - aqi AS delta FROM wide_{name} "
        f"WHERE t{h} IS NOT NULL AND {complete}" for h in horizons or HORIZONS)
    return f"wide_{name} AS (SELECT *, {wide} FROM {source}),\n{name} AS ({each})"


def folds(source: str = "lg", name: str = "fd", k: int = 4, min_train: int = 100,
          order: str = "hr") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN block > 0 THEN first_n + (block - 1) * step_n END AS n_train,
    coalesce(block > 0 AND first_n + (block - 1) * step_n >= {min_train}
             AND n_rows >= {2 * min_train}, false) AS is_scored
  FROM (SELECT *, CASE WHEN rn < first_n THEN 0 ELSE (rn - first_n) // step_n + 1 END AS block
    FROM (SELECT *, n_rows // {k + 1} AS step_n, n_rows - {k} * (n_rows // {k + 1}) AS first_n
      FROM (SELECT *, row_number() OVER (PARTITION BY series_id, horizon ORDER BY {order}) - 1 AS rn,
              count(*) OVER (PARTITION BY series_id, horizon) AS n_rows FROM {source})
      WHERE n_rows // {k + 1} > 0)))"""


def reversion(source: str = "fd", name: str = "kk", dev: str = "aqi_minus_roll24") -> str:
    """k per series, horizon and fold by joining each fold with the rows before it."""
    return f"""{name} AS (
  SELECT f.series_id, f.horizon, f.fold,
    CASE WHEN sum(t.{dev} * t.{dev}) > 0
         THEN sum(-t.{dev} * t.delta) / sum(t.{dev} * t.{dev}) ELSE 0 END AS k
  FROM (SELECT DISTINCT series_id, horizon, block AS fold FROM {source} WHERE block > 0) f
  JOIN {source} t ON t.series_id = f.series_id AND t.horizon = f.horizon AND t.block < f.fold
  GROUP BY ALL)"""


def baseline_scores(folded: str = "fd", ks: str = "kk", name: str = "sc",
                    daily: bool = False) -> str:
    models = ([("persistence_baseline", 0, "0e0"), ("climatology_7d", 1, "-aqi_minus_rolling_7"),
               ("damped_persistence", 2, "k * -aqi_minus_rolling_7")] if daily else
              [("persistence", 0, "0e0"), ("diurnal_naive", 1, "aqi_lag24 - aqi"),
               ("damped_reversion", 2, "k * -aqi_minus_roll24")])
    parts = " UNION ALL ".join(
        f"SELECT series_id, horizon, fold, n_rows, '{m}' AS model, {i} AS model_order, target, delta, "
        f"aqi, {p} AS pred, {'k' if m.startswith('damped') else 'NULL::DOUBLE'} AS k FROM tst_{name}"
        for m, i, p in models)
    return f"""tst_{name} AS (
  SELECT d.*, d.block AS fold, q.k FROM {folded} d
  LEFT JOIN {ks} q ON q.series_id = d.series_id AND q.horizon = d.horizon AND q.fold = d.block
  WHERE d.is_scored),
prd_{name} AS ({parts}),
{name} AS (
  SELECT p.series_id, p.horizon, p.fold, any_value(n_rows) AS n_rows, count(*) AS n_test, p.model,
    any_value(model_order) AS model_order,
    sqrt(avg((target - aqi - pred) ** 2)) AS rmse, avg(abs(target - aqi - pred)) AS mae,
    CASE WHEN any_value(m.sst) > 0 THEN 1 - sum((target - aqi - pred) ** 2) / any_value(m.sst)
         WHEN sum((target - aqi - pred) ** 2) = 0 THEN 1 ELSE 0 END AS r2,
    CASE WHEN any_value(m.dsst) > 0 THEN 1 - sum((delta - pred) ** 2) / any_value(m.dsst)
         WHEN sum((delta - pred) ** 2) = 0 THEN 1 ELSE 0 END AS delta_r2,
    any_value(k) AS k
  FROM prd_{name} p JOIN (
    SELECT series_id, horizon, fold,
      sum(target * target) - sum(target) * sum(target) / count(*) AS sst,
      sum(delta * delta) - sum(delta) * sum(delta) / count(*) AS dsst
    FROM tst_{name} GROUP BY ALL) m
  ON m.series_id = p.series_id AND m.horizon = p.horizon AND m.fold = p.fold
  GROUP BY p.series_id, p.horizon, p.fold, p.model)"""


def summary(scores: str = "sc", name: str = "mt") -> str:
    return f"""{name} AS (
  SELECT series_id, horizon, model, any_value(model_order) AS model_order,
    any_value(n_rows) AS n_rows, count(*) AS n_folds, avg(rmse) AS rmse, stddev_pop(rmse) AS rmse_std,
    avg(mae) AS mae, avg(r2) AS r2, avg(delta_r2) AS delta_r2, avg(k) AS k
  FROM {scores} GROUP BY series_id, horizon, model)"""


def metrics(kind: str = "faulty", mode: str = "epa24h", horizons: list[int] | None = None) -> str:
    """CTEs up to ``mt``: baseline metrics of the hourly panel."""
    return ",\n".join([
        chain(kind, mode), features(), long_rows(horizons=horizons), folds(), reversion(),
        baseline_scores(), summary()])


DAILY_FEATURES = [
    *COLS, "aqi", "aqi_change_rate", "aqi_lag1", "aqi_lag2", "aqi_rolling_mean_3",
    "aqi_rolling_mean_7", "aqi_minus_rolling_3", "aqi_minus_rolling_7", "doy_sin", "doy_cos"]


def daily(n_min: int = 18) -> str:
    """CTEs dv, dm (all days), dd (kept days with position), df (features)."""
    return f"""{DAILY_EV},
dm AS (
  SELECT series_id, CAST(observed_at + INTERVAL 5 HOUR AS DATE) AS date,
    {', '.join(f'avg({c}) AS {c}' for c in COLS)}, count(*) AS n_readings
  FROM dv GROUP BY ALL),
dd AS (
  SELECT *, CAST({aqi('pm25')} AS DOUBLE) AS aqi,
    CAST(row_number() OVER (PARTITION BY series_id ORDER BY date) AS INTEGER) AS pos
  FROM dm WHERE n_readings >= {n_min}),
{fill('dd', 'dl', 2, 'pos', ['aqi', *COLS], 'series_id, date, n_readings, pos')},
df AS (
  SELECT *, aqi - aqi_rolling_mean_3 AS aqi_minus_rolling_3,
    aqi - aqi_rolling_mean_7 AS aqi_minus_rolling_7
  FROM (SELECT *, aqi - {lag(1, o='pos')} AS aqi_change_rate,
    {lag(1, o='pos')} AS aqi_lag1, {lag(2, o='pos')} AS aqi_lag2,
    {prior(3, 2, o='pos')} AS aqi_rolling_mean_3, {prior(7, 5, o='pos')} AS aqi_rolling_mean_7,
    sin(2 * pi() * dayofyear(date) / 365.25) AS doy_sin,
    cos(2 * pi() * dayofyear(date) / 365.25) AS doy_cos
  FROM dl))"""
