"""Queries: projections, joins, sorts, limits, set operations, aggregates, quality gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.catalog import sqltext as S
from airpanel.catalog.base import Tables, query
from airpanel.catalog.scalars import WEATHER_SQL, weather
from airpanel.catalog.timeseries import frame, hourly_features, raw_times
from airpanel.functions.aqi import aqi_from_pm25
from airpanel.functions.timefn import hour_number
from airpanel.operators import aggregates, quality, relational, timegrid
from airpanel.operators.features import daily_frame
from airpanel.operators.weather import join_coverage, join_weather
from airpanel.schemas import HOUR, HOURLY_FEATURES, POLLUTANTS, SERIES

_AQ = f"WITH {S.chain()}"
_FT = f"{_AQ}, {S.features()}"


def keyed(t: Tables) -> DataFrame:
    return t.readings().withColumn(HOUR, hour_number(F.col("observed_at")))


# -- projections and predicates -------------------------------------------------------------

@query("p1_select_features", floats="pm25 co", sql=f"""
WITH {S.ev()} SELECT series_id, hr, pm25, co FROM ev""")
def p1(t: Tables) -> DataFrame:
    return relational.select_features(keyed(t), ["pm25", "hr", "absent", "co", "pm25"], (SERIES, HOUR))


@query("p2_drop_stale_weather", floats="pm25", sql=f"""
WITH {S.ev()} SELECT ingest_seq, pm25 FROM ev""")
def p2(t: Tables) -> DataFrame:
    legacy = t.readings().select(
        "ingest_seq", "pm25", F.col("o3").alias("temperature"), F.col("no2").alias("wind"))
    return relational.drop_stale_weather(legacy)


@query("p6_complete_cases", floats="aqi_roll168", sql=f"""
{_FT} SELECT series_id, hr, aqi_roll168 FROM ft WHERE {S.COMPLETE}""")
def p6(t: Tables) -> DataFrame:
    return relational.complete_cases(hourly_features(t), HOURLY_FEATURES).select(
        SERIES, HOUR, "aqi_roll168")


@query("p7_split_by_presence", floats="pm25", sql=f"""
WITH {S.ev('faulty')}
(SELECT ingest_seq, pm25, true AS has_value FROM ev WHERE pm25 IS NOT NULL ORDER BY ingest_seq LIMIT 10)
UNION ALL
(SELECT ingest_seq, pm25, false AS has_value FROM ev WHERE pm25 IS NULL ORDER BY ingest_seq LIMIT 5)""")
def p7(t: Tables) -> DataFrame:
    return relational.split_by_presence(
        t.faulty_readings().select("ingest_seq", "pm25"), "pm25", 10, 5, ["ingest_seq"])


@query("p8_require_columns", floats="pm25", sql=f"""
WITH {S.ev()} SELECT ingest_seq, pm25 FROM ev""")
def p8(t: Tables) -> DataFrame:
    """Checked while the plan is built; a complete frame passes unchanged."""
    df = relational.require_columns(t.readings(), [SERIES, *POLLUTANTS])
    try:
        relational.require_columns(df, ["absent"])
    except KeyError:
        return df.select("ingest_seq", "pm25")
    raise AssertionError("a missing column went unnoticed")


@query("p9_newer_than", floats="pm25", sql=f"""
WITH {S.ev()}, {S.means()}, st AS (SELECT series_id, max(hr) AS m FROM ev WHERE is_backfilled GROUP BY 1)
SELECT hm.series_id, hm.hr, pm25 FROM hm LEFT JOIN st USING (series_id) WHERE m IS NULL OR hr > m - 100""")
def p9(t: Tables) -> DataFrame:
    readings = keyed(t)
    stored = readings.filter("is_backfilled").withColumn(HOUR, F.col(HOUR) - 100)
    return relational.newer_than(
        timegrid.hourly_mean(t.readings()), stored, time=HOUR).select(SERIES, HOUR, "pm25")


@query("p10_tail_window", sql=f"""
WITH {S.ev()} SELECT series_id, ingest_seq, observed_at FROM ev JOIN (
  SELECT series_id, max(observed_at) AS m FROM ev GROUP BY 1) USING (series_id)
WHERE observed_at >= m - INTERVAL 5 DAY""")
def p10(t: Tables) -> DataFrame:
    return relational.tail_window(t.readings(), 5, "observed_at").select(
        SERIES, "ingest_seq", "observed_at")


@query("p11_breaches", floats="aqi", sql=f"""
{_AQ} SELECT series_id, hr, aqi FROM aq WHERE aqi > 150""")
def p11(t: Tables) -> DataFrame:
    return relational.breaches(frame(t), 150).select(SERIES, HOUR, "aqi")


@query("p12_for_series", floats="pm25", sql=f"""
WITH {S.ev()} SELECT series_id, ingest_seq, pm25 FROM ev WHERE series_id = 'purchase'""")
def p12(t: Tables) -> DataFrame:
    return relational.for_series(t.readings(), "purchase").select(SERIES, "ingest_seq", "pm25")


# -- joins ----------------------------------------------------------------------------------

@query("j1_join_weather", floats="pm25 wind_speed_10m temperature_2m", sql=f"""
WITH {S.ev()}, {WEATHER_SQL}
SELECT ev.series_id, ev.hr, ingest_seq, pm25, wind_speed_10m, temperature_2m
FROM ev LEFT JOIN wx ON wx.series_id = ev.series_id AND wx.hr = ev.hr""")
def j1(t: Tables) -> DataFrame:
    stale = keyed(t).withColumns({"temperature": F.col("o3"), "temperature_2m": F.lit(0.0)})
    return join_weather(stale, weather(t)).select(
        SERIES, HOUR, "ingest_seq", "pm25", "wind_speed_10m", "temperature_2m")


@query("q3_join_coverage", floats="coverage_pct", sql=f"""
WITH {S.ev()}, {WEATHER_SQL}, jn AS (
  SELECT ev.hr, wx.wind_speed_10m FROM ev LEFT JOIN wx ON wx.series_id = ev.series_id AND wx.hr = ev.hr)
SELECT count(*) AS n_rows, count(wind_speed_10m) * 100.0 / count(*) AS coverage_pct,
  count(wind_speed_10m) * 100.0 / count(*) < 90 AS is_low FROM jn""")
def q3(t: Tables) -> DataFrame:
    archive = weather(t)
    return join_coverage(
        join_weather(keyed(t), archive), [c for c in archive.columns if c not in (SERIES, HOUR)])


@query("j4_gap_anti_join", sql=f"""
WITH {S.ev()}, {S.means()}, {S.grid('hm')} SELECT series_id, hr FROM gr WHERE NOT is_observed""")
def j4(t: Tables) -> DataFrame:
    hourly = timegrid.hourly_mean(t.readings())
    spans = hourly.groupBy(SERIES).agg(F.min(HOUR).alias("lo"), F.max(HOUR).alias("hi"))
    calendar = spans.select(SERIES, F.explode(F.sequence("lo", "hi")).alias(HOUR))
    return relational.missing_keys(calendar, hourly, [SERIES, HOUR])


_MERGE = f"""WITH {S.ev()},
ex AS (SELECT series_id, hr, max(ingest_seq) AS seq FROM ev WHERE is_backfilled GROUP BY ALL),
nw AS (SELECT series_id, hr, max(ingest_seq) AS seq FROM ev WHERE NOT is_backfilled GROUP BY ALL)"""


@query("j7_merge_keyed", sql=f"""
{_MERGE} SELECT series_id, hr, coalesce(nw.seq, ex.seq) AS seq, nw.seq IS NOT NULL AS is_new
FROM ex FULL JOIN nw USING (series_id, hr)""")
def j7(t: Tables) -> DataFrame:
    def side(condition: str, new: bool) -> DataFrame:
        return (keyed(t).filter(condition).groupBy(SERIES, HOUR)
                .agg(F.max("ingest_seq").alias("seq")).withColumn("is_new", F.lit(new)))
    return relational.merge_keyed(
        side("is_backfilled", False), side("NOT is_backfilled", True), [SERIES, HOUR])


# -- sorts, limits, top-k -------------------------------------------------------------------

@query("k1_sort_by_time", floats="pm25", sql=f"""
WITH {S.ev()} SELECT series_id, observed_at, ingest_seq, pm25 FROM ev
ORDER BY series_id, observed_at, ingest_seq""")
def k1(t: Tables) -> DataFrame:
    return relational.sort_by_time(
        t.readings().select(SERIES, "observed_at", "ingest_seq", "pm25"),
        SERIES, "observed_at", "ingest_seq")


@query("k2_latest_per_series", floats="aqi pm25", sql=f"""
{_FT} SELECT series_id, hr, ts, aqi, pm25 FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY hr DESC) AS pick
  FROM ft WHERE {S.COMPLETE}) WHERE pick = 1""")
def k2(t: Tables) -> DataFrame:
    return relational.latest_row(hourly_features(t), complete=HOURLY_FEATURES).select(
        SERIES, HOUR, "ts", "aqi", "pm25")


_CORR = " UNION ALL ".join(
    f"SELECT series_id AS horizon, '{c}' AS feature, corr({c}, aqi) AS value FROM ft GROUP BY series_id"
    for c in ("pm10", "o3", "no2", "so2", "co", "aqi_lag1", "aqi_lag24", "aqi_roll72"))


def association(t: Tables) -> DataFrame:
    """Correlation of features with the index per series, in long form."""
    names = ["pm10", "o3", "no2", "so2", "co", "aqi_lag1", "aqi_lag24", "aqi_roll72"]
    wide = hourly_features(t).groupBy(F.col(SERIES).alias("horizon")).agg(
        *[F.corr(c, "aqi").alias(c) for c in names])
    return wide.unpivot(["horizon"], names, "feature", "value")


@query("k3_top_features", floats="value", sql=f"""
{_FT}, co_ AS ({_CORR}) SELECT horizon, feature, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY abs(value) DESC, feature) AS rank
  FROM co_) WHERE rank <= 4""")
def k3(t: Tables) -> DataFrame:
    return relational.top_features(association(t), 4)


@query("k3_top_features_overall", floats="mean_abs", sql=f"""
{_FT}, co_ AS ({_CORR}) SELECT feature, avg(abs(value)) AS mean_abs FROM co_
GROUP BY feature ORDER BY mean_abs DESC, feature LIMIT 5""")
def k3_overall(t: Tables) -> DataFrame:
    return relational.top_features_overall(association(t), 5)


@query("k4_first_n", sql=f"""
WITH {S.ev()}, {S.means()}, {S.grid('hm')}
SELECT series_id, hr FROM gr WHERE NOT is_observed ORDER BY hr, series_id LIMIT 5""")
def k4(t: Tables) -> DataFrame:
    grid = timegrid.hourly_grid(timegrid.hourly_mean(t.readings()))
    return relational.first_n(
        grid.filter(~F.col("is_observed")).select(SERIES, HOUR), 5, HOUR, SERIES)


@query("k5_peak_and_first_crossing", floats="peak", sql=f"""
{_AQ}, fc AS (SELECT series_id, aqi, hr - min(hr) OVER (PARTITION BY series_id) AS horizon FROM aq)
SELECT series_id, max(aqi) AS peak,
  arg_max(horizon, aqi * 1000000 - horizon) AS peak_horizon,
  min(horizon) AS first_horizon, count(*) AS n_breaches
FROM fc WHERE aqi > 120 GROUP BY series_id""")
def k5(t: Tables) -> DataFrame:
    points = frame(t)
    start = points.groupBy(SERIES).agg(F.min(HOUR).alias("_start"))
    ahead = points.join(start, SERIES).withColumn("horizon", F.col(HOUR) - F.col("_start"))
    return relational.peak_and_first_crossing(ahead, 120)


@query("k6_sample_rows", sql=f"""
{_FT} SELECT series_id, hr, aqi FROM (SELECT * FROM ft WHERE {S.COMPLETE}
  ORDER BY md5(concat_ws('|', series_id, hr, 42)), series_id, hr LIMIT 1500)""")
def k6(t: Tables) -> DataFrame:
    rows = relational.complete_cases(hourly_features(t), HOURLY_FEATURES)
    return relational.sample_rows(rows, 1500).select(SERIES, HOUR, "aqi")


# -- set operations -------------------------------------------------------------------------

@query("u1_append_rows", floats="pm25 humidity", sql=f"""
WITH {S.ev()} SELECT ingest_seq, pm25, NULL::DOUBLE AS humidity FROM ev WHERE is_backfilled
UNION ALL SELECT ingest_seq, pm25, o3 AS humidity FROM ev WHERE NOT is_backfilled""")
def u1(t: Tables) -> DataFrame:
    old = t.readings().filter("is_backfilled").select("ingest_seq", "pm25")
    live = t.readings().filter("NOT is_backfilled").select(
        F.col("o3").alias("humidity"), "pm25", "ingest_seq")
    return relational.append_rows(old, live)


@query("u3_calendar_difference", sql="""
SELECT series_id, date FROM (
  SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (
    SELECT CAST(l_suppkey AS VARCHAR) AS series_id, min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi
    FROM lineitem GROUP BY 1))
EXCEPT SELECT CAST(l_suppkey AS VARCHAR), CAST(l_shipdate AS DATE) FROM lineitem""")
def u3(t: Tables) -> DataFrame:
    days = t.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias(SERIES), F.to_date("l_shipdate").alias("date")).distinct()
    return timegrid.calendar_gaps(days)


# -- aggregates -----------------------------------------------------------------------------

@query("a4_series_stats", floats="mean std", sql=f"""
{_AQ} SELECT series_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts,
  avg(aqi) AS mean, stddev_samp(aqi) AS std FROM aq GROUP BY series_id""")
def a4(t: Tables) -> DataFrame:
    return aggregates.series_stats(frame(t))


@query("a5_describe", floats="mean std min q25 q50 q75 max", sql=f"""
WITH {S.ev()}, sc AS (SELECT series_id, {S.aqi('pm25')} AS aqi FROM ev)
SELECT series_id, count(aqi) AS count, avg(aqi) AS mean, stddev_samp(aqi) AS std,
  CAST(min(aqi) AS DOUBLE) AS min, quantile_cont(aqi, 0.25) AS q25, quantile_cont(aqi, 0.5) AS q50,
  quantile_cont(aqi, 0.75) AS q75, CAST(max(aqi) AS DOUBLE) AS max FROM sc GROUP BY series_id""")
def a5(t: Tables) -> DataFrame:
    return aggregates.describe(t.readings().withColumn("aqi", aqi_from_pm25("pm25")), "aqi")


@query("a5_describe_concentration", floats="mean std min q25 q50 q75 max", sql=f"""
WITH {S.ev()} SELECT series_id, count(pm25) AS count, avg(pm25) AS mean, stddev_samp(pm25) AS std,
  min(pm25) AS min, quantile_cont(pm25, 0.25) AS q25, quantile_cont(pm25, 0.5) AS q50,
  quantile_cont(pm25, 0.75) AS q75, max(pm25) AS max FROM ev GROUP BY series_id""")
def a5_concentration(t: Tables) -> DataFrame:
    return aggregates.describe(t.readings(), "pm25")


@query("a6_null_profile", floats="null_pct", sql=f"""
{_FT}, np AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, (count(*) - count({c})) * 100.0 / count(*) AS null_pct FROM ft"
    for c in S.FEATURES)})
SELECT column_name, n_null, null_pct FROM np WHERE null_pct > 1 ORDER BY null_pct DESC, column_name LIMIT 6""")
def a6(t: Tables) -> DataFrame:
    return aggregates.null_profile(hourly_features(t).select(*HOURLY_FEATURES), 1.0, 6)


@query("a7_coverage", floats="coverage_pct", sql=f"""
WITH {S.ev()} SELECT series_id, count(*) AS n_rows, span_days,
  count(*) * 100.0 / greatest(span_days * 24, 1) AS coverage_pct
FROM ev JOIN (SELECT series_id, CAST(floor((floor(epoch(max(observed_at))) - floor(epoch(min(observed_at)))) / 86400) AS BIGINT) AS span_days
  FROM ev GROUP BY 1) USING (series_id) GROUP BY series_id, span_days""")
def a7(t: Tables) -> DataFrame:
    return aggregates.coverage(t.readings())


@query("a14_regime_variability", floats="change_std", sql=f"""
WITH {S.daily()}, ch AS (
  SELECT *, aqi - lag(aqi) OVER (PARTITION BY series_id ORDER BY date) AS change FROM df)
SELECT series_id, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
  count(change) AS n_changes, stddev_samp(change) AS change_std FROM ch GROUP BY ALL""")
def a14(t: Tables) -> DataFrame:
    return aggregates.regime_variability(daily_frame(t.daily_readings()))


@query("a15_worst_gap", floats="missing_pct", sql=f"""
WITH {S.ev()}, {S.means()}, {S.grid('hm')}, sl AS (
  SELECT series_id, hr, count(*) OVER w AS n, count(*) FILTER (NOT is_observed) OVER w AS missing
  FROM gr WINDOW w AS (PARTITION BY series_id ORDER BY hr ROWS BETWEEN 335 PRECEDING AND CURRENT ROW))
SELECT series_id, CAST(missing AS BIGINT) AS n_missing, hr AS end_hr, missing * 100.0 / 336 AS missing_pct FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY missing DESC, hr) AS pick
  FROM sl WHERE n = 336) WHERE pick = 1""")
def a15(t: Tables) -> DataFrame:
    return aggregates.worst_gap(timegrid.hourly_grid(timegrid.hourly_mean(t.readings())))


_NEG = " + ".join(f"(CASE WHEN {c} < 0 THEN 1 ELSE 0 END)" for c in POLLUTANTS)


@query("a16_cell_counts", sql=f"""
WITH {S.ev('sentinel')} SELECT series_id, count(*) AS n_rows, count(DISTINCT hr) AS n_hours,
  CAST(sum({_NEG}) AS BIGINT) AS n_sentinels, count(*) FILTER (pm25 > 500.4) AS n_capped
FROM ev GROUP BY series_id""")
def a16(t: Tables) -> DataFrame:
    return aggregates.cell_counts(t.sentinel_readings())


# -- quality gates --------------------------------------------------------------------------

@query("q1_validate_features", sql=f"""
WITH {S.ev()}, pr AS (
  SELECT 'null key' AS "check", 'series_id,hr' AS subject,
    count(*) FILTER (hr IS NULL) AS amount FROM (SELECT series_id, CASE WHEN ingest_seq % 41 = 0 THEN NULL ELSE hr END AS hr FROM ev)
  UNION ALL SELECT 'duplicate key', 'series_id,hr', CAST(sum(n - 1) AS BIGINT) FROM (
    SELECT count(*) AS n FROM (SELECT series_id, CASE WHEN ingest_seq % 41 = 0 THEN NULL ELSE hr END AS hr FROM ev) GROUP BY series_id, hr)
  UNION ALL SELECT 'non-numeric column', 'observed_at', 1)
SELECT "check", subject, CAST(amount AS BIGINT) AS amount FROM pr WHERE amount > 0""")
def q1(t: Tables) -> DataFrame:
    rows = keyed(t).withColumn(HOUR, F.when(F.col("ingest_seq") % 41 != 0, F.col(HOUR)))
    return quality.validate_features(rows, [SERIES, HOUR])


@query("q2_describe_frame", sql=f"""
WITH {S.ev('faulty')} SELECT 'rows' AS item, CAST(count(*) AS VARCHAR) AS detail FROM ev
UNION ALL SELECT 'columns', '10'
UNION ALL SELECT 'first', CAST(min(hr) AS VARCHAR) FROM ev
UNION ALL SELECT 'last', CAST(max(hr) AS VARCHAR) FROM ev
UNION ALL SELECT 'nulls in pm25', printf('%.1f', (count(*) - count(pm25)) * 100.0 / count(*)) FROM ev""")
def q2(t: Tables) -> DataFrame:
    rows = t.faulty_readings().withColumn(HOUR, hour_number(F.col("observed_at"))).drop("observed_at")
    return quality.describe_frame(rows, key=HOUR)


@query("q4_freshness_gate", floats="gap_hours", sql=f"""
WITH {S.ev()}, st AS (SELECT series_id, date_trunc('hour', max(observed_at)) AS m FROM ev
  WHERE observed_at < TIMESTAMP '2024-01-20' GROUP BY 1)
SELECT series_id, ingest_seq, floor(epoch(observed_at)) / 3600 - epoch(m) / 3600 AS gap_hours,
  floor(epoch(observed_at)) - epoch(m) <= 43200 AS is_accepted
FROM ev JOIN st USING (series_id) WHERE observed_at >= TIMESTAMP '2024-01-20'""")
def q4(t: Tables) -> DataFrame:
    rows = t.readings().select(SERIES, "ingest_seq", F.col("observed_at").alias("ts"))
    cutoff = F.lit("2024-01-20").cast("timestamp_ntz")
    stored = rows.filter(F.col("ts") < cutoff).withColumn(
        "ts", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz"))
    return quality.freshness_gate(rows.filter(F.col("ts") >= cutoff), stored).drop("ts")


_AUDIT_DAILY = f"""ad AS (
  SELECT series_id, CAST(observed_at + INTERVAL 5 HOUR AS DATE) AS date, CAST({S.aqi('avg(pm25)')} AS DOUBLE) AS aqi
  FROM ev GROUP BY ALL)"""


@query("q5_audit_report", floats="value", sql=f"""
WITH {S.ev('faulty')}, {S.means()}, {S.grid('hm')}, {_AUDIT_DAILY},
cv AS (SELECT series_id, count(*) AS n_rows, CAST(floor((floor(epoch(max(observed_at))) - floor(epoch(min(observed_at)))) / 86400) AS BIGINT) AS d FROM ev GROUP BY 1),
rg AS (SELECT series_id, year(date) AS y, quarter(date) AS q, stddev_samp(change) AS s FROM (
  SELECT *, aqi - lag(aqi) OVER (PARTITION BY series_id ORDER BY date) AS change FROM ad) GROUP BY ALL),
sl AS (SELECT series_id, count(*) OVER w AS n, count(*) FILTER (NOT is_observed) OVER w AS missing
  FROM gr WINDOW w AS (PARTITION BY series_id ORDER BY hr ROWS BETWEEN 335 PRECEDING AND CURRENT ROW)),
wg AS (SELECT series_id, max(missing) AS m FROM sl WHERE n = 336 GROUP BY 1),
cc AS (SELECT series_id, count(*) AS n_rows, count(DISTINCT hr) AS n_hours, sum({_NEG.replace('pm25 <', 'coalesce(pm25, 0) <')}) AS neg,
  count(*) FILTER (pm25 > 500.4) AS cap FROM ev GROUP BY 1)
SELECT section, series_id, item, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'nulls' AS section, NULL AS series_id, 'pm25' AS item, (count(*) - count(pm25)) * 100.0 / count(*) AS value FROM ev
  UNION ALL SELECT 'coverage', series_id, 'n_rows', n_rows FROM cv
  UNION ALL SELECT 'coverage', series_id, 'span_days', d FROM cv
  UNION ALL SELECT 'coverage', series_id, 'coverage_pct', n_rows * 100.0 / greatest(d * 24, 1) FROM cv
  UNION ALL SELECT 'variability', series_id, 'change_std ' || y || 'Q' || q, s FROM rg
  UNION ALL SELECT 'worst_gap', series_id, 'n_missing', m FROM wg
  UNION ALL SELECT 'worst_gap', series_id, 'missing_pct', m * 100.0 / 336 FROM wg
  UNION ALL SELECT 'cells', series_id, 'n_rows', n_rows FROM cc
  UNION ALL SELECT 'cells', series_id, 'n_hours', n_hours FROM cc
  UNION ALL SELECT 'cells', series_id, 'n_sentinels', neg FROM cc
  UNION ALL SELECT 'cells', series_id, 'n_capped', cap FROM cc)""")
def q5(t: Tables) -> DataFrame:
    return quality.audit_report(t.faulty_readings())


__all__ = ["keyed", "raw_times"]
