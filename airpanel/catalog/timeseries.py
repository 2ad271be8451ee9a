"""Queries: flagship, time functions, grids, windows, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.catalog import sqltext as S
from airpanel.catalog.base import Tables, query
from airpanel.functions import timefn
from airpanel.functions.aqi import aqi_category
from airpanel.models.evaluate import fold_index
from airpanel.operators import dedupe, features, timegrid
from airpanel.operators.halo import drop_halo, split_with_halo
from airpanel.operators.relational import drop_unparseable, observed_at
from airpanel.schemas import DAILY_FEATURES, HOUR, HOURLY_FEATURES, POLLUTANTS, SERIES

SIX = " ".join(POLLUTANTS)


def frame(t: Tables, mode: str = "epa24h") -> DataFrame:
    return timegrid.hourly_frame(t.faulty_readings(), mode=mode)


def hourly_features(t: Tables) -> DataFrame:
    return features.add_hourly_features(frame(t))


@query("flagship_daily_air_quality", floats="mean_aqi max_aqi mean_pm25", sql=f"""
WITH {S.chain()}
SELECT series_id, CAST(ts AS DATE) AS date, avg(aqi) AS mean_aqi, max(aqi) AS max_aqi,
  {S.category('max(aqi)')} AS worst_category, avg(pm25) AS mean_pm25,
  count(*) AS n_hours, count(aqi) AS n_scored
FROM aq GROUP BY series_id, CAST(ts AS DATE)""")
def flagship(t: Tables) -> DataFrame:
    """Readings to hourly grid, index and category, summarised per series and local day."""
    return (frame(t).groupBy(SERIES, F.to_date("ts").alias("date")).agg(
        F.avg("aqi").alias("mean_aqi"), F.max("aqi").alias("max_aqi"),
        F.avg("pm25").alias("mean_pm25"), F.count("*").alias("n_hours"),
        F.count("aqi").alias("n_scored"))
        .withColumn("worst_category", aqi_category("max_aqi")))


# -- time functions -------------------------------------------------------------------------

_RAW_TEXT = """CASE event_id % 4
    WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+00:00'
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE 'junk' END"""


def raw_times(t: Tables) -> DataFrame:
    """Event times as text: naive, zoned, without fraction, and junk."""
    kind = F.col("event_id") % 4
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = (F.when(kind == 0, full).when(kind == 1, F.concat(full, F.lit("+00:00")))
            .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("junk"))
    return t.events().select(
        F.col("event_type").alias(SERIES), F.col("event_id").alias("ingest_seq"),
        text.alias("fetched_at"),
        F.when(F.col("user_id") % 2 == 0, text).alias("station_timestamp"))


@query("t1_parse_ts_utc", sql="""
SELECT event_id AS ingest_seq, CASE event_id % 4 WHEN 3 THEN NULL
  WHEN 2 THEN date_trunc('second', ts) ELSE ts END AS parsed
FROM events""")
def t1(t: Tables) -> DataFrame:
    return raw_times(t).select(
        "ingest_seq",
        timefn.parse_ts_utc(F.col("fetched_at")).cast("timestamp_ntz").alias("parsed"))


@query("t2_observed_at", sql="""
SELECT event_id AS ingest_seq, CASE event_id % 4 WHEN 3 THEN NULL
  WHEN 2 THEN date_trunc('second', ts) ELSE ts END AS observed_at,
  (event_id % 4 <> 3 AND user_id % 2 = 0) AS from_station
FROM events""")
def t2(t: Tables) -> DataFrame:
    df = observed_at(raw_times(t))
    return df.select(
        "ingest_seq", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"),
        timefn.parse_ts_utc(F.col("station_timestamp")).isNotNull().alias("from_station"))


@query("t3_local_hour", sql="""
SELECT event_id AS ingest_seq, date_trunc('hour', ts + INTERVAL 5 HOUR) AS ts FROM events""")
def t3(t: Tables) -> DataFrame:
    return t.events().select(
        F.col("event_id").alias("ingest_seq"), timefn.local_hour(F.col("ts")).alias("ts"))


@query("t4_local_day", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate + INTERVAL 5 HOUR AS DATE) AS date FROM lineitem""")
def t4(t: Tables) -> DataFrame:
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", timefn.local_day(F.col("l_shipdate")).alias("date"))


@query("t5_utc_hour", sql="""
SELECT event_id AS ingest_seq, date_trunc('hour', ts) AS hour_utc,
  CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS hr FROM events""")
def t5(t: Tables) -> DataFrame:
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        timefn.utc_hour(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour_utc"),
        timefn.hour_number(F.col("ts")).alias("hr"))


@query("t6_epoch_to_ts", sql="""
SELECT event_id AS ingest_seq, date_trunc('second', ts) AS ts FROM events""")
def t6(t: Tables) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        timefn.epoch_to_ts(seconds).cast("timestamp_ntz").alias("ts"))


@query("t7_calendar_parts", sql="""
SELECT event_id AS ingest_seq, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
  CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week FROM events""")
def t7(t: Tables) -> DataFrame:
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        *[c.alias(n) for n, c in timefn.calendar_parts(F.col("ts")).items()])


@query("t8_cyclical", floats="hour_sin hour_cos doy_sin doy_cos", sql="""
SELECT event_id AS ingest_seq, sin(2 * pi() * hour(ts) / 24) AS hour_sin,
  cos(2 * pi() * hour(ts) / 24) AS hour_cos, sin(2 * pi() * dayofyear(ts) / 365.25) AS doy_sin,
  cos(2 * pi() * dayofyear(ts) / 365.25) AS doy_cos FROM events""")
def t8(t: Tables) -> DataFrame:
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        *[c.alias(n) for n, c in timefn.cyclical(F.col("ts")).items()])


# -- grids, gaps, sentinels -----------------------------------------------------------------

@query("t9_hourly_grid", floats=SIX, sql=f"""
WITH {S.ev('faulty')}, {S.means()}, {S.masked()}, {S.grid()}
SELECT series_id, hr, is_observed, {S.LIST} FROM gr""")
def t9(t: Tables) -> DataFrame:
    return timegrid.hourly_grid(timegrid.hourly_mean(t.faulty_readings()))


@query("j2_grid_reindex", sql=f"""
WITH {S.ev()}, {S.means()}, {S.grid('hm')}
SELECT series_id, count(*) AS n_slots, count(*) FILTER (NOT is_observed) AS n_missing
FROM gr GROUP BY series_id""")
def j2(t: Tables) -> DataFrame:
    grid = timegrid.hourly_grid(timegrid.hourly_mean(t.readings()))
    return grid.groupBy(SERIES).agg(
        F.count("*").alias("n_slots"), F.count_if(~F.col("is_observed")).alias("n_missing"))


_CAL = """cal AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT series_id, min(date) AS lo, max(date) AS hi FROM kept GROUP BY series_id))"""


@query("t10_calendar_gaps", sql=f"""
WITH {S.daily()}, kept AS (SELECT series_id, date FROM dm WHERE n_readings >= 18), {_CAL}
SELECT cal.series_id, cal.date FROM cal LEFT JOIN kept USING (series_id, date)
WHERE kept.date IS NULL""")
def t10(t: Tables) -> DataFrame:
    return timegrid.calendar_gaps(timegrid.min_readings(timegrid.daily_mean(t.daily_readings()), 18))


@query("t11_fill_gaps", floats=SIX, sql=f"""
WITH {S.ev('faulty')}, {S.means()}, {S.masked()}, {S.grid()}, {S.fill()}
SELECT series_id, hr, {S.LIST} FROM fl""")
def t11(t: Tables) -> DataFrame:
    grid = timegrid.hourly_grid(timegrid.hourly_mean(t.faulty_readings()))
    return timegrid.fill_gaps(grid, POLLUTANTS, 3).drop("is_observed")


@query("t11_fill_gaps_strict", floats="pm25", sql=f"""
WITH {S.ev('faulty')}, {S.means()}, {S.masked()}, {S.grid()}, {S.fill(strict=True)}
SELECT series_id, hr, pm25 FROM fl""")
def t11_strict(t: Tables) -> DataFrame:
    grid = timegrid.hourly_grid(timegrid.hourly_mean(t.faulty_readings()))
    return timegrid.fill_gaps(grid, POLLUTANTS, 3, strict=True).select(SERIES, HOUR, "pm25")


@query("t12_mask_sentinels_raw", floats="pm25", sql=f"""
WITH {S.ev('sentinel')}, {S.masked('ev', 'mk', 'series_id, ingest_seq')}
SELECT series_id, ingest_seq, pm25 FROM mk""")
def t12(t: Tables) -> DataFrame:
    return timegrid.mask_sentinels(t.sentinel_readings(), POLLUTANTS).select(
        SERIES, "ingest_seq", "pm25")


@query("t12_mask_modes", floats="pm25_after pm25_before pm25_none", sql=f"""
WITH {S.ev('sentinel')}
SELECT series_id, hr, CASE WHEN avg(pm25) >= 0 THEN avg(pm25) END AS pm25_after,
  avg(CASE WHEN pm25 >= 0 THEN pm25 END) AS pm25_before, avg(pm25) AS pm25_none
FROM ev GROUP BY series_id, hr""")
def t12_modes(t: Tables) -> DataFrame:
    means = {m: timegrid.hourly_mean(t.sentinel_readings(), ["pm25"], mask=m)
             .withColumnRenamed("pm25", f"pm25_{m.split('_')[0]}")
             for m in ("after_mean", "before_mean", "none")}
    return (means["after_mean"].join(means["before_mean"], [SERIES, HOUR])
            .join(means["none"], [SERIES, HOUR]))


@query("a1_hourly_mean", floats=SIX, sql=f"""
WITH {S.ev('sentinel')}, {S.means()}, {S.masked()} SELECT * FROM mk""")
def a1(t: Tables) -> DataFrame:
    return timegrid.hourly_mean(t.sentinel_readings())


@query("a2_hourly_mean_all", floats=SIX + " ingest_seq", sql=f"""
WITH {S.ev()}
SELECT series_id, hr, avg(ingest_seq) AS ingest_seq,
  {', '.join(f'avg({c}) AS {c}' for c in POLLUTANTS)} FROM ev GROUP BY series_id, hr""")
def a2(t: Tables) -> DataFrame:
    return timegrid.hourly_mean_all(t.readings())


@query("a3_daily_mean", floats=SIX + " aqi", sql=f"""
WITH {S.daily()}
SELECT series_id, date, {S.LIST}, n_readings, CAST({S.aqi('pm25')} AS DOUBLE) AS aqi FROM dm""")
def a3(t: Tables) -> DataFrame:
    return timegrid.daily_mean(t.daily_readings())


@query("j3_daily_aqi_fallback", floats="aqi", sql=f"""
WITH {S.DAILY_EV}, hv AS (SELECT *, {S.aqi('pm25')} AS aqi FROM dv)
SELECT series_id, CAST(observed_at + INTERVAL 5 HOUR AS DATE) AS date, avg(aqi) AS aqi
FROM hv GROUP BY ALL""")
def j3(t: Tables) -> DataFrame:
    from airpanel.functions.aqi import aqi_from_pm25

    readings = t.daily_readings().withColumn("aqi", aqi_from_pm25("pm25"))
    return timegrid.daily_mean(readings, aqi_mode="mean_hourly").select(SERIES, "date", "aqi")


@query("j6_aligned_agg", floats="pm25", sql=f"""
WITH {S.daily()} SELECT series_id, date, pm25, n_readings FROM dm""")
def j6(t: Tables) -> DataFrame:
    return timegrid.daily_mean(t.daily_readings()).select(SERIES, "date", "pm25", "n_readings")


@query("p5_min_readings", floats="pm25", sql=f"""
WITH {S.daily()} SELECT series_id, date, pm25, n_readings FROM dm WHERE n_readings >= 18""")
def p5(t: Tables) -> DataFrame:
    return timegrid.min_readings(timegrid.daily_mean(t.daily_readings()), 18).select(
        SERIES, "date", "pm25", "n_readings")


@query("p3_since", floats="pm25", sql=f"""
WITH {S.ev()}, {S.means()}
SELECT series_id, hr, pm25 FROM hm
WHERE make_timestamp(hr * 3600000000) + INTERVAL 5 HOUR >= TIMESTAMP '2024-01-11'""")
def p3(t: Tables) -> DataFrame:
    hourly = timegrid.hourly_mean(t.readings())
    local = hourly.withColumn("ts", timefn.hour_to_local(F.col(HOUR)))
    return timegrid.since(local, "2024-01-11").select(SERIES, HOUR, "pm25")


@query("p4_drop_unparseable", sql="""
SELECT event_type AS series_id, event_id AS ingest_seq,
  CASE event_id % 4 WHEN 2 THEN date_trunc('second', ts) ELSE ts END AS observed_at
FROM events WHERE event_id % 4 <> 3""")
def p4(t: Tables) -> DataFrame:
    kept = drop_unparseable(observed_at(raw_times(t)))
    return kept.select(
        SERIES, "ingest_seq", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"))


@query("p4_unparseable_count", sql="""
SELECT count(*) AS n_rows, count(*) FILTER (event_id % 4 = 3) AS n_dropped FROM events""")
def p4_count(t: Tables) -> DataFrame:
    from airpanel.operators.relational import unparseable_count

    return unparseable_count(observed_at(raw_times(t)))


# -- windows --------------------------------------------------------------------------------

_AQ = f"WITH {S.chain()}"


@query("w1_lags", floats="aqi aqi_lag1 aqi_lag2 aqi_lag3 aqi_lag24 aqi_lag48 aqi_lag168", sql=f"""
{_AQ} SELECT series_id, hr, aqi, {', '.join(f'{S.lag(n)} AS aqi_lag{n}' for n in (1, 2, 3, 24, 48, 168))}
FROM aq""")
def w1(t: Tables) -> DataFrame:
    return frame(t).select(
        SERIES, HOUR, "aqi",
        *[c.alias(n) for n, c in features.lags("aqi", [1, 2, 3, 24, 48, 168]).items()])


@query("w2_diffs", floats="aqi_diff1 aqi_diff3", sql=f"""
{_AQ} SELECT series_id, hr, aqi - {S.lag(1)} AS aqi_diff1, aqi - {S.lag(3)} AS aqi_diff3 FROM aq""")
def w2(t: Tables) -> DataFrame:
    return frame(t).select(
        SERIES, HOUR, *[c.alias(n) for n, c in features.diffs("aqi", [1, 3]).items()])


@query("w3_trailing_mean", floats="pm25_24h", sql=f"""
{_AQ} SELECT series_id, hr, CASE WHEN count(pm25) OVER w >= 18 THEN avg(pm25) OVER w END AS pm25_24h
FROM aq WINDOW w AS (PARTITION BY series_id ORDER BY hr ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def w3(t: Tables) -> DataFrame:
    return frame(t).select(
        SERIES, HOUR, timegrid.trailing_mean("pm25", 24, 18).alias("pm25_24h"))


@query("w4_prior_mean", floats="pm25_prior24 aqi_roll24 aqi_roll72 aqi_roll168", sql=f"""
{_AQ} SELECT series_id, hr, {S.prior(24, 18, 'pm25')} AS pm25_prior24, {S.prior(24, 18)} AS aqi_roll24,
  {S.prior(72, 48)} AS aqi_roll72, {S.prior(168, 120)} AS aqi_roll168 FROM aq""")
def w4(t: Tables) -> DataFrame:
    rolled = features.prior_means_of_integers(
        frame(t), "aqi",
        {"aqi_roll24": (24, 18), "aqi_roll72": (72, 48), "aqi_roll168": (168, 120)})
    return rolled.select(
        SERIES, HOUR, timegrid.prior_mean("pm25", 24, 18).alias("pm25_prior24"),
        "aqi_roll24", "aqi_roll72", "aqi_roll168")


@query("w5_deviations", floats="aqi_minus_roll24 aqi_minus_roll168", sql=f"""
{_AQ}, {S.features()} SELECT series_id, hr, aqi_minus_roll24, aqi_minus_roll168 FROM ft""")
def w5(t: Tables) -> DataFrame:
    return hourly_features(t).select(SERIES, HOUR, "aqi_minus_roll24", "aqi_minus_roll168")


@query("w6_same_hour_norm", floats="aqi_minus_hourly_norm", sql=f"""
{_AQ} SELECT series_id, hr, aqi - ({S.lag(24)} + {S.lag(48)} + {S.lag(72)}) / 3 AS aqi_minus_hourly_norm
FROM aq""")
def w6(t: Tables) -> DataFrame:
    return frame(t).select(
        SERIES, HOUR, features.same_hour_norm("aqi").alias("aqi_minus_hourly_norm"))


@query("w7_delta_targets", floats=" ".join(f"target_{h} delta_{h}" for h in S.HORIZONS), sql=f"""
{_AQ} SELECT series_id, hr, {', '.join(
    f'lead(aqi, {h}) OVER w AS target_{h}, lead(aqi, {h}) OVER w - aqi AS delta_{h}'
    for h in S.HORIZONS)}
FROM aq WINDOW w AS (PARTITION BY series_id ORDER BY hr)""")
def w7(t: Tables) -> DataFrame:
    wide = features.delta_targets(frame(t))
    return wide.select(SERIES, HOUR, *[
        c for h in S.HORIZONS for c in (f"target_{h}", f"delta_{h}")])


@query("hourly_features", floats=" ".join(S.FLOAT_FEATURES), sql=f"""
{_AQ}, {S.features()} SELECT series_id, hr, ts, {', '.join(S.FEATURES)} FROM ft""")
def all_hourly_features(t: Tables) -> DataFrame:
    """The whole hourly feature table."""
    return hourly_features(t).select(SERIES, HOUR, "ts", *HOURLY_FEATURES)


@query("hourly_features_by_halo", floats=" ".join(S.FLOAT_FEATURES), sql=f"""
{_AQ}, {S.features()} SELECT series_id, hr, ts, {', '.join(S.FEATURES)} FROM ft""")
def halo_features(t: Tables) -> DataFrame:
    """The same table with every series cut into ten-day buckets."""
    parts = features.add_hourly_features(split_with_halo(frame(t), width=240))
    return drop_halo(parts).select(SERIES, HOUR, "ts", *HOURLY_FEATURES)


@query("daily_features", floats=" ".join(S.DAILY_FEATURES), sql=f"""
WITH {S.daily()} SELECT series_id, date, n_readings, {', '.join(S.DAILY_FEATURES)} FROM df""")
def all_daily_features(t: Tables) -> DataFrame:
    """The whole daily feature table, lags by row."""
    return features.daily_frame(t.daily_readings()).select(
        SERIES, "date", "n_readings", *DAILY_FEATURES)


@query("daily_features_by_calendar", floats="aqi aqi_lag1 aqi_rolling_mean_7", sql=f"""
WITH {S.daily()}, kept AS (SELECT * FROM dd), {_CAL},
full_days AS (SELECT cal.series_id, cal.date, kept.aqi,
  CAST(row_number() OVER (PARTITION BY cal.series_id ORDER BY cal.date) AS INTEGER) AS pos
  FROM cal LEFT JOIN kept USING (series_id, date)),
{S.fill('full_days', 'fc', 2, 'pos', ['aqi'], 'series_id, date, pos')}
SELECT series_id, date, aqi, {S.lag(1, o='pos')} AS aqi_lag1,
  {S.prior(7, 5, o='pos')} AS aqi_rolling_mean_7 FROM fc""")
def daily_by_calendar(t: Tables) -> DataFrame:
    return features.daily_frame(t.daily_readings(), by="calendar").select(
        SERIES, "date", "aqi", "aqi_lag1", "aqi_rolling_mean_7")


_HOURLY_LIVE = f"""{S.ev()}, dd AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY series_id, hr ORDER BY is_backfilled, ingest_seq DESC) AS pick FROM ev)
  WHERE pick = 1)"""


def deduped(t: Tables) -> DataFrame:
    readings = t.readings().withColumn(HOUR, timefn.hour_number(F.col("observed_at")))
    return dedupe.dedupe_hour_prefer_live(readings, [SERIES, HOUR])


@query("w8_change_rate", floats="aqi_change_rate", sql=f"""
WITH {_HOURLY_LIVE}
SELECT series_id, hr, aqi, CAST(coalesce(aqi - lag(aqi) OVER (PARTITION BY series_id ORDER BY observed_at), 0)
  AS DOUBLE) AS aqi_change_rate FROM (SELECT *, {S.aqi('pm25')} AS aqi FROM dd)""")
def w8(t: Tables) -> DataFrame:
    from airpanel.functions.aqi import aqi_from_pm25

    rows = deduped(t).withColumn("aqi", aqi_from_pm25("pm25"))
    return features.change_rate(rows, time="observed_at").select(
        SERIES, HOUR, "aqi", "aqi_change_rate")


@query("w9_change_rate_latest", floats="aqi_change_rate", sql=f"""
WITH {S.ev()}, sc AS (SELECT *, {S.aqi('pm25')} AS aqi FROM ev),
latest AS (SELECT series_id, arg_max(aqi, observed_at) AS last_aqi FROM sc
  WHERE is_backfilled GROUP BY series_id)
SELECT series_id, ingest_seq, CAST(coalesce(aqi - last_aqi, 0) AS DOUBLE) AS aqi_change_rate
FROM sc LEFT JOIN latest USING (series_id) WHERE NOT is_backfilled""")
def w9(t: Tables) -> DataFrame:
    from airpanel.functions.aqi import aqi_from_pm25

    scored = t.readings().withColumn("aqi", aqi_from_pm25("pm25"))
    history, new = scored.filter("is_backfilled"), scored.filter("NOT is_backfilled")
    return features.change_rate_latest(new, history, time="observed_at").select(
        SERIES, "ingest_seq", "aqi_change_rate")


_PICK = "SELECT series_id, hr, ingest_seq, observed_at, pm25, pm10 FROM"


@query("w10_dedupe_exact", floats="pm25", sql="""
SELECT series_id, minute, ingest_seq, pm25 FROM (
  SELECT event_type AS series_id, date_trunc('minute', ts) AS minute, event_id AS ingest_seq,
    floor(value * 64) / 64 AS pm25, row_number() OVER (
      PARTITION BY event_type, date_trunc('minute', ts) ORDER BY event_id DESC) AS pick
  FROM events) WHERE pick = 1""")
def w10(t: Tables) -> DataFrame:
    minute = F.date_trunc("minute", F.col("observed_at")).cast("timestamp_ntz")
    rows = t.readings().select(SERIES, minute.alias("minute"), "ingest_seq", "pm25")
    return dedupe.dedupe_exact(rows, [SERIES, "minute"])


@query("w11_dedupe_hour_prefer_live", floats="pm25 pm10", sql=f"""
WITH {_HOURLY_LIVE} SELECT series_id, hr, ingest_seq, observed_at, is_backfilled, pm25, pm10 FROM dd""")
def w11(t: Tables) -> DataFrame:
    return deduped(t).select(
        SERIES, HOUR, "ingest_seq", "observed_at", "is_backfilled", "pm25", "pm10")


@query("w12_dedupe_ts_last", floats="pm25 pm10", sql=f"""
WITH {S.ev()} {_PICK} (SELECT *, row_number() OVER (
  PARTITION BY series_id, hr ORDER BY ingest_seq DESC) AS pick FROM ev) WHERE pick = 1""")
def w12_last(t: Tables) -> DataFrame:
    readings = t.readings().withColumn(HOUR, timefn.hour_number(F.col("observed_at")))
    return dedupe.dedupe_ts(readings, [SERIES, HOUR], "ingest_seq").select(
        SERIES, HOUR, "ingest_seq", "observed_at", "pm25", "pm10")


@query("w12_dedupe_ts_first", floats="pm25 pm10", sql=f"""
WITH {S.ev()} {_PICK} (SELECT *, row_number() OVER (
  PARTITION BY series_id, hr ORDER BY ingest_seq) AS pick FROM ev) WHERE pick = 1""")
def w12_first(t: Tables) -> DataFrame:
    readings = t.readings().withColumn(HOUR, timefn.hour_number(F.col("observed_at")))
    return dedupe.dedupe_ts(readings, [SERIES, HOUR], "ingest_seq", "first").select(
        SERIES, HOUR, "ingest_seq", "observed_at", "pm25", "pm10")


@query("u2_distinct_keys", sql="""
SELECT DISTINCT event_type AS series_id, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS hr FROM events""")
def u2(t: Tables) -> DataFrame:
    readings = t.readings().withColumn(HOUR, timefn.hour_number(F.col("observed_at")))
    return dedupe.dedupe_exact(readings, [SERIES, HOUR]).select(SERIES, HOUR)


@query("a13_dup_count", sql=f"""
WITH {S.ev()} SELECT CAST(count(*) - count(DISTINCT (series_id, hr)) AS BIGINT) AS n_duplicates FROM ev""")
def a13(t: Tables) -> DataFrame:
    readings = t.readings().withColumn(HOUR, timefn.hour_number(F.col("observed_at")))
    return dedupe.dup_count(readings, [SERIES, HOUR])


@query("w13_fold_index", sql=f"""
{_AQ}, {S.features()}, {S.long_rows(horizons=[24])}
SELECT series_id, horizon, hr, row_number() OVER (PARTITION BY series_id, horizon ORDER BY hr) - 1 AS rn,
  count(*) OVER (PARTITION BY series_id, horizon) AS n_rows FROM lg""")
def w13(t: Tables) -> DataFrame:
    rows = features.training_rows(hourly_features(t), horizons=[24])
    return fold_index(rows).select(SERIES, "horizon", HOUR, "rn", "n_rows")
