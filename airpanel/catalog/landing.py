"""Queries: payload flattening, files, feature groups, planning.

Payload text is derived from the event table by Spark, so these grow with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel import schemas
from airpanel.catalog import sqltext as S
from airpanel.catalog.base import Tables, query
from airpanel.catalog.tables import keyed
from airpanel.catalog.timeseries import raw_times
from airpanel.functions.timefn import hour_number, hour_to_utc
from airpanel.operators import timegrid
from airpanel.plans import backfill
from airpanel.schemas import HOUR, POLLUTANTS, SERIES
from airpanel.sources import planning, readers, store, writers

_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def _event_numbers(t: Tables) -> DataFrame:
    from airpanel.functions.scalars import json_number

    return t.events().withColumns({
        "k": json_number(F.col("props"), "$.k"),
        "dt": F.unix_seconds(F.col("ts").cast("timestamp"))})


def _components(**values: object) -> F.Column:
    return F.struct(*[c.alias(name) for name, c in values.items()])


@query("s1_read_observations", floats="pm25 pm10 o3 temperature humidity wind", sql=f"""
SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'Karachi' ELSE event_type END AS series_id,
  ts AS fetched_at, date_trunc('second', ts) - INTERVAL 90 SECOND AS station_timestamp,
  CAST(user_id % 5 + 1 AS INTEGER) AS scale_1_5,
  CASE WHEN event_id % 13 > 0 THEN value END AS pm25, {_K} AS pm10, CAST(user_id AS DOUBLE) AS o3,
  CASE WHEN event_id % 13 > 0 THEN {S.aqi('value')} END AS aqi,
  {_K} / 2 AS temperature, CAST(user_id % 100 AS DOUBLE) AS humidity, value / 10 AS wind,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
FROM events""")
def s1(t: Tables) -> DataFrame:
    """Payload documents out of the events, parsed by the declared schema and flattened."""
    ev = _event_numbers(t)
    entry = F.struct(
        F.struct((F.col("user_id") % 5 + 1).alias("aqi")).alias("main"),
        _components(
            pm2_5=F.when(F.col("event_id") % 13 > 0, F.col("value")), pm10=F.col("k").cast("int"),
            o3=F.col("user_id"), nh3=F.lit(0)).alias("components"),
        F.col("dt").alias("dt"))
    document = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("fetched_at_utc"),
        F.lit(24.0).alias("lat"), F.lit(67.0).alias("lon"),
        F.struct(F.array(entry, entry).alias("list")).alias("pollution"),
        F.struct(
            F.struct((F.col("k") / 2).alias("temp"), F.lit(1002).alias("pressure"),
                     (F.col("user_id") % 100).alias("humidity")).alias("main"),
            F.struct((F.col("value") / 10).alias("speed")).alias("wind"),
            (F.col("dt") - 90).alias("dt"),
            F.when(F.col("user_id") % 5 > 0, F.col("event_type")).alias("name"),
        ).alias("weather")))
    parsed = ev.select(
        "event_id", F.from_json(document, schemas.OBSERVATION_PAYLOAD).alias("p")).select("event_id", "p.*")
    flat = readers.flatten_observations(parsed)
    naive = {c: F.col(c).cast("timestamp_ntz") for c in ("fetched_at", "station_timestamp")}
    return flat.withColumns(naive).select(
        "event_id", SERIES, "fetched_at", "station_timestamp", "scale_1_5", "pm25", "pm10", "o3",
        "aqi", "temperature", "humidity", "wind", "hour", "day_of_week")


@query("s2_read_history", floats="pm25 pm10", sql=f"""
SELECT event_id, event_type AS series_id, CAST(n AS INTEGER) AS entry_no,
  date_trunc('second', ts) + n * INTERVAL 1 HOUR AS fetched_at, CAST(n + 1 AS INTEGER) AS scale_1_5,
  CASE WHEN n = 0 THEN value END AS pm25, {_K} AS pm10,
  CASE WHEN n = 0 THEN {S.aqi('value')} END AS aqi, true AS is_backfilled
FROM events, (VALUES (0), (1)) v(n) WHERE user_id % 50 > 0""")
def s2(t: Tables) -> DataFrame:
    ev = _event_numbers(t)

    def entry(n: int) -> F.Column:
        pm25 = F.col("value") if n == 0 else F.lit(None).cast("double")
        return F.struct(
            F.struct(F.lit(n + 1).alias("aqi")).alias("main"),
            _components(pm2_5=pm25, pm10=F.col("k")).alias("components"),
            (F.col("dt") + n * 3600).alias("dt"))
    entries = F.when(F.col("user_id") % 50 > 0, F.array(entry(0), entry(1)))
    document = F.to_json(F.struct(F.coalesce(entries, F.array().cast(
        "array<struct<main:struct<aqi:int>,components:struct<pm2_5:double,pm10:double>,dt:bigint>>")
    ).alias("list")))
    parsed = ev.select(
        "event_id", "event_type",
        F.from_json(document, schemas.HISTORY_PAYLOAD).alias("p")).select("event_id", "event_type", "p.*")
    flat = readers.flatten_history(parsed, F.col("event_type"))
    return flat.select(
        "event_id", SERIES, "entry_no", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        "scale_1_5", "pm25", "pm10", "aqi", "is_backfilled")


@query("s3_read_station_feed", floats="value", sql=f"""
SELECT event_id, event_type AS city, CAST(user_id % 300 AS INTEGER) AS aqi, 'pm25' AS dominant_pollutant,
  date_trunc('second', ts) AS observed_at, p.parameter,
  CASE p.parameter WHEN 'pm25' THEN value WHEN 't' THEN {_K} ELSE CAST(user_id AS DOUBLE) END AS value
FROM events, (VALUES ('pm25'), ('t'), ('h')) p(parameter) WHERE event_id % 7 > 0""")
def s3(t: Tables) -> DataFrame:
    def reading(c: F.Column) -> F.Column:
        return F.struct(c.alias("v"))
    document = F.to_json(F.struct(
        F.when(F.col("event_id") % 7 > 0, "ok").otherwise("error").alias("status"),
        F.struct(
            (F.col("user_id") % 300).alias("aqi"),
            F.struct(F.col("event_type").alias("name")).alias("city"),
            F.lit("pm25").alias("dominentpol"),
            F.struct(reading(F.col("value")).alias("pm25"), reading(F.col("k")).alias("t"),
                     reading(F.col("user_id")).alias("h")).alias("iaqi"),
            F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("iso")).alias("time"),
        ).alias("data")))
    parsed = _event_numbers(t).select(
        "event_id", F.from_json(document, schemas.STATION_PAYLOAD).alias("p")).select("event_id", "p.*")
    return readers.flatten_station_feed(parsed).select(
        "event_id", "city", "aqi", "dominant_pollutant",
        F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "parameter", "value")


@query("s4_read_weather_archive", floats="temperature_2m wind_speed_10m", sql=f"""
WITH rows_ AS (SELECT event_type AS series_id, {S.HR.format('ts')} + n AS hr, event_id * 16384 + n AS seq,
    CASE WHEN n = 0 THEN {_K} END AS temperature_2m, value AS wind_speed_10m
  FROM events, (VALUES (0), (1)) v(n))
SELECT series_id, hr, temperature_2m, wind_speed_10m FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, hr ORDER BY seq) AS pick FROM rows_) WHERE pick = 1""")
def s4(t: Tables) -> DataFrame:
    """Two-hour archives with two variables; the schema carries only what the archive has."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    document = F.to_json(F.struct(F.struct(
        F.array(F.date_format(hour, "yyyy-MM-dd'T'HH:mm"),
                F.date_format(hour + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.array(F.col("k"), F.lit(None).cast("double")).alias("temperature_2m"),
        F.array("value", "value").alias("wind_speed_10m")).alias("hourly")))
    schema = schemas.weather_payload(["temperature_2m", "wind_speed_10m"])
    parsed = _event_numbers(t).select(
        "event_id", "event_type", F.from_json(document, schema).alias("p")).select(
        "event_id", "event_type", "p.*")
    return readers.flatten_weather_archive(parsed, F.col("event_type"), F.col("event_id"))


_CSV_HEADER = ["city", "fetched_at", "station_timestamp", "pm25", "pm10"]


@query("s5_read_feature_csv", floats="pm25", sql=f"""
SELECT event_type AS city, {S.HR.format('ts')} AS hr, count(*) AS n, avg(floor(value * 64) / 64) AS pm25
FROM events GROUP BY ALL""")
def s5(t: Tables) -> DataFrame:
    """Readings as CSV text on shared storage, read back all-text and pruned, then averaged."""
    path = t.folder("feature-csv")
    text = t.readings().select(
        F.col(SERIES).alias("city"),
        F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fetched_at"),
        F.lit(None).cast("string").alias("station_timestamp"), "pm25", "pm10")
    text.write.option("header", True).csv(path)
    back = readers.read_feature_csv(t.spark, path, _CSV_HEADER, ["city", "fetched_at", "pm25"])
    from airpanel.functions.timefn import parse_ts_utc

    return (back.groupBy("city", hour_number(parse_ts_utc(F.col("fetched_at"))).alias(HOUR))
            .agg(F.count("*").alias("n"), F.avg(F.col("pm25").cast("double")).alias("pm25")))


_HM = f"WITH {S.ev()}, {S.means()} SELECT series_id, hr, {S.LIST} FROM hm"
_SIX = " ".join(POLLUTANTS)


@query("s6_write_table", floats=_SIX, sql=_HM)
def s6(t: Tables) -> DataFrame:
    path = t.folder("sorted-table")
    writers.write_table(timegrid.hourly_mean(t.readings()), path, [HOUR, SERIES])
    return t.spark.read.parquet(path)


@query("s7_land_raw", floats="value", sql="""
SELECT event_id, value, props, CAST(ts AS DATE) AS fetch_date FROM events""")
def s7(t: Tables) -> DataFrame:
    path = t.folder("raw-landing")
    raw = t.events().select("event_id", "value", "props", F.col("ts").alias("fetched_at"))
    writers.land_raw(raw, path)
    return t.spark.read.schema("event_id BIGINT, value DOUBLE, props STRING, fetch_date DATE").json(path)


@query("s8_write_feature_group", floats="pm25", sql=f"""
WITH {S.ev()}, a AS (SELECT series_id, hr, avg(pm25) AS pm25 FROM ev WHERE is_backfilled GROUP BY ALL),
b AS (SELECT series_id, hr, avg(pm25) AS pm25 FROM ev WHERE NOT is_backfilled GROUP BY ALL)
SELECT series_id, hr, coalesce(b.pm25, a.pm25) AS pm25 FROM a FULL JOIN b USING (series_id, hr)""")
def s8(t: Tables) -> DataFrame:
    """Two deliveries with overlapping keys; the later one updates in place."""
    root = t.folder("feature-group")
    for batch, condition in enumerate(["is_backfilled", "NOT is_backfilled"]):
        rows = timegrid.hourly_mean(t.readings().filter(condition), ["pm25"]).withColumn(
            "ts", hour_to_utc(F.col(HOUR)))
        store.write_feature_group(rows, root, "hourly", 1, batch)
    return store.read_feature_group(t.spark, root, "hourly", 1).select(SERIES, HOUR, "pm25")


@query("s9_read_feature_group_tail", floats="pm25", sql=f"""
WITH {S.ev()}, {S.means()} SELECT series_id, hr, pm25 FROM hm
JOIN (SELECT series_id, max(hr) AS m FROM hm GROUP BY 1) USING (series_id) WHERE hr >= m - 14 * 24""")
def s9(t: Tables) -> DataFrame:
    root = t.folder("feature-group")
    rows = timegrid.hourly_mean(t.readings()).withColumn("ts", hour_to_utc(F.col(HOUR)))
    store.write_feature_group(rows, root, "hourly", 1, 0)
    return store.read_feature_group(t.spark, root, "hourly", 1, tail_days=14).select(
        SERIES, HOUR, "pm25")


@query("s10_export_features", floats=_SIX, sql=f"""
WITH {S.ev()}, {S.means()} SELECT series_id, make_timestamp(hr * 3600000000) AS fetched_at,
  make_timestamp(hr * 3600000000) AS station_timestamp, {S.LIST} FROM hm""")
def s10(t: Tables) -> DataFrame:
    path = t.folder("export")
    writers.write_export(timegrid.hourly_mean(t.readings()).withColumn("ts", hour_to_utc(F.col(HOUR))), path)
    return t.spark.read.parquet(path)


@query("s13_snapshot_table", floats=_SIX, sql=_HM)
def s13(t: Tables) -> DataFrame:
    path = t.folder("snapshot")
    timegrid.hourly_mean(t.readings()).write.parquet(path)
    return t.spark.read.parquet(writers.snapshot_table(t.spark, path, "pre_weather"))


_PLAN = f"""WITH {S.ev()}, {S.means()},
en AS (SELECT series_id, max(hr) + 1 AS end_hr FROM hm GROUP BY 1),
st AS (SELECT *, greatest(end_hr - 60 * 24, 473000) AS start_hr FROM en),
pl AS (SELECT series_id, s AS chunk_start, least(s + 168, end_hr) AS chunk_end
  FROM (SELECT *, unnest(generate_series(start_hr, end_hr - 1, 168)) AS s FROM st))"""


@query("s14_backfill_plan", sql=f"{_PLAN} SELECT * FROM pl")
def s14(t: Tables) -> DataFrame:
    ends = timegrid.hourly_mean(t.readings()).groupBy(SERIES).agg((F.max(HOUR) + 1).alias("end_hr"))
    return planning.backfill_plan(ends, days=60, earliest=473_000)


@query("s14_chunks_to_load", sql=f"""
{_PLAN}, hs AS (SELECT *, unnest(generate_series(chunk_start, chunk_end - 1)) AS hr FROM pl)
SELECT hs.series_id, chunk_start, chunk_end, count(*) AS n_missing
FROM hs LEFT JOIN hm ON hm.series_id = hs.series_id AND hm.hr = hs.hr WHERE hm.hr IS NULL GROUP BY ALL""")
def s14_missing(t: Tables) -> DataFrame:
    loaded = timegrid.hourly_mean(t.readings())
    ends = loaded.groupBy(SERIES).agg((F.max(HOUR) + 1).alias("end_hr"))
    return planning.chunks_to_load(planning.backfill_plan(ends, days=60, earliest=473_000), loaded)


def _run(t: Tables, stops: list[int | None]) -> tuple[DataFrame, str]:
    """A backfill of the last 60 days from the backfilled readings, in one or several runs; (plan, folder)."""
    readings = t.readings()
    ends = timegrid.hourly_mean(readings).groupBy(SERIES).agg((F.max(HOUR) + 1).alias("end_hr"))
    plan = planning.backfill_plan(ends, days=60, earliest=473_000)
    root = t.folder("backfill")
    for stop in stops:
        backfill.run_backfill(plan, readings.filter("is_backfilled"), root, chunks_per_step=3, stop_after=stop)
    return plan, root


@query("s14_backfill_ledger", sql=f"""
{_PLAN}, bf AS (SELECT DISTINCT series_id, hr FROM ev WHERE is_backfilled)
SELECT pl.series_id, chunk_start, chunk_end, CASE WHEN count(bf.hr) > 0 THEN 'landed' ELSE 'failed' END AS status,
  count(bf.hr) AS n_hours FROM pl LEFT JOIN bf ON bf.series_id = pl.series_id AND bf.hr >= chunk_start AND bf.hr < chunk_end
GROUP BY ALL""")
def s14_ledger(t: Tables) -> DataFrame:
    """What became of every chunk after a run that stopped half way and a second one."""
    plan, root = _run(t, [1, None])
    return backfill.chunk_states(plan, root)


@query("s14_backfill_run", floats="pm25 aqi_change_rate", sql=f"""
{_PLAN}, ip AS (SELECT e.* FROM ev e WHERE NOT is_backfilled OR EXISTS (
  SELECT 1 FROM pl WHERE pl.series_id = e.series_id AND e.hr >= chunk_start AND e.hr < chunk_end)),
pk AS (SELECT *, {S.aqi('pm25')} AS aqi FROM (SELECT *, row_number() OVER (
  PARTITION BY series_id, hr ORDER BY is_backfilled, ingest_seq DESC) AS pick FROM ip) WHERE pick = 1)
SELECT series_id, hr, pm25, is_backfilled, CAST(coalesce(aqi - lag(aqi) OVER (
  PARTITION BY series_id ORDER BY observed_at), 0) AS DOUBLE) AS aqi_change_rate FROM pk""")
def s14_run(t: Tables) -> DataFrame:
    """Backfilled in two runs, merged with the live readings, deduplicated and written."""
    _, root = _run(t, [1, None])
    live = t.readings().filter("NOT is_backfilled")
    return backfill.merge_backfill(t.spark, live, root, t.folder("merged")).select(
        SERIES, HOUR, "pm25", "is_backfilled", "aqi_change_rate")


@query("s14_weather_date_chunks", sql="""
SELECT series_id, CAST(s AS DATE) AS chunk_first, least(CAST(s + INTERVAL 364 DAY AS DATE), hi) AS chunk_last
FROM (SELECT *, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 365 DAY)) AS s FROM (
  SELECT l_returnflag AS series_id, min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi
  FROM lineitem GROUP BY 1))""")
def s14_dates(t: Tables) -> DataFrame:
    windows = t.table("lineitem").groupBy(F.col("l_returnflag").alias(SERIES)).agg(
        F.min(F.to_date("l_shipdate")).alias("first_date"),
        F.max(F.to_date("l_shipdate")).alias("last_date"))
    return planning.date_chunks(windows)


@query("s15_target_window", sql="""
SELECT event_type AS series_id, min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date
FROM events WHERE event_id % 4 <> 3 GROUP BY 1""")
def s15(t: Tables) -> DataFrame:
    return planning.target_window(raw_times(t))


__all__ = ["keyed"]
