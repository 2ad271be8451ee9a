"""Queries: scalar functions over every reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.catalog import sqltext as S
from airpanel.catalog.base import Tables, query
from airpanel.functions import aqi, scalars
from airpanel.operators.quality import validate_features
from airpanel.operators.weather import derive_weather
from airpanel.schemas import HOUR, SERIES
from airpanel.functions.timefn import hour_number


# Concentrations from every event, reaching all bands, both caps and the invalid side.
_CONC = "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -9999e0 ELSE value * 2 END"


def concentrations(t: Tables) -> DataFrame:
    c = (F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("double"))
         .when(F.col("event_id") % 97 == 0, F.lit(-9999.0)).otherwise(F.col("value") * 2))
    return t.events().select(F.col("event_id").alias("ingest_seq"), "value", c.alias("conc"))


@query("x1_aqi_from_pm25", sql=f"""
SELECT event_id AS ingest_seq, {S.aqi(_CONC)} AS aqi FROM events""")
def x1(t: Tables) -> DataFrame:
    return concentrations(t).select("ingest_seq", aqi.aqi_from_pm25("conc").alias("aqi"))


@query("x1_sql_function", sql=f"""
SELECT event_id AS ingest_seq, {S.aqi(_CONC)} AS aqi,
  {S.category('(value * 2)')} AS category, {S.display('(value * 2)')} AS label FROM events""")
def x1_sql(t: Tables) -> DataFrame:
    """The same lookups through the registered SQL functions."""
    aqi.register_sql_functions(t.spark)
    return concentrations(t).select(
        "ingest_seq", F.expr("airpanel_aqi(conc)").alias("aqi"),
        F.expr("airpanel_category(value * 2)").alias("category"),
        F.expr("airpanel_display_label(value * 2)").alias("label"))


@query("x2_aqi_category", sql=f"""
SELECT ingest_seq, index_value, {S.category('index_value')} AS category FROM (
  SELECT event_id AS ingest_seq, CAST(floor(value * 3) AS BIGINT) AS index_value FROM events)""")
def x2(t: Tables) -> DataFrame:
    index = F.floor(F.col("value") * 3).cast("bigint")
    return t.events().select(F.col("event_id").alias("ingest_seq"), index.alias("index_value")).select(
        "ingest_seq", "index_value", aqi.aqi_category("index_value").alias("category"))


@query("x2_category_of_fractions", sql=f"""
SELECT event_id AS ingest_seq, {S.category('(value * 3)')} AS category FROM events""")
def x2_fractions(t: Tables) -> DataFrame:
    """Fractions between two integer bands have no category."""
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        aqi.aqi_category(F.col("value") * 3).alias("category"))


@query("x3_categorise", sql=f"""
SELECT event_id AS ingest_seq, {S.display('(value * 3)')} AS label,
  {S.display('(value * 3)', 'colour')} AS colour FROM events""")
def x3(t: Tables) -> DataFrame:
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        aqi.categorise(F.col("value") * 3).alias("c")).select("ingest_seq", "c.label", "c.colour")


@query("x4_aqi_capped", sql=f"""
SELECT event_id AS ingest_seq, coalesce({S.aqi(_CONC)},
  CASE WHEN ({_CONC}) IS NOT NULL THEN 500 END) AS aqi FROM events""")
def x4(t: Tables) -> DataFrame:
    return concentrations(t).select("ingest_seq", aqi.aqi_capped("conc").alias("aqi"))


# Hourly weather of one station (here: of every series) out of the events.
WEATHER_SQL = f"""wx AS (
  SELECT event_type AS series_id, {S.HR.format('ts')} AS hr,
    avg(floor(value * 64) / 64) / 10 AS wind_speed_10m, avg(k) * 3.6 AS wind_direction_10m,
    20 + avg(k) / 10 AS temperature_2m, 19 + avg(k) / 8 AS temperature_100m,
    avg(floor(value * 64) / 64) * 10 AS boundary_layer_height
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
  WHERE NOT (hour(ts) = 13) GROUP BY ALL)"""


def weather(t: Tables) -> DataFrame:
    """Hourly weather per series; the archive has no 13 o'clock."""
    k = scalars.json_number(F.col("props"), "$.k")
    value = F.floor(F.col("value") * 64) / 64
    return (t.events().filter(F.hour("ts") != 13)
            .select(F.col("event_type").alias(SERIES), hour_number(F.col("ts")).alias(HOUR),
                    k.alias("k"), value.alias("v"))
            .groupBy(SERIES, HOUR).agg(
                (F.avg("v") / 10).alias("wind_speed_10m"),
                (F.avg("k") * 3.6).alias("wind_direction_10m"),
                (20 + F.avg("k") / 10).alias("temperature_2m"),
                (19 + F.avg("k") / 8).alias("temperature_100m"),
                (F.avg("v") * 10).alias("boundary_layer_height")))


@query("x5_wind_components", floats="wind_u wind_v", sql=f"""
WITH {WEATHER_SQL} SELECT series_id, hr, -wind_speed_10m * sin(radians(wind_direction_10m)) AS wind_u,
  -wind_speed_10m * cos(radians(wind_direction_10m)) AS wind_v FROM wx""")
def x5(t: Tables) -> DataFrame:
    speed, direction = F.col("wind_speed_10m"), F.col("wind_direction_10m")
    return weather(t).select(
        SERIES, HOUR, scalars.wind_u(speed, direction).alias("wind_u"),
        scalars.wind_v(speed, direction).alias("wind_v"))


@query("x6_ventilation_index", floats="ventilation_index", sql=f"""
WITH {WEATHER_SQL} SELECT series_id, hr, wind_speed_10m * boundary_layer_height AS ventilation_index
FROM wx""")
def x6(t: Tables) -> DataFrame:
    return weather(t).select(SERIES, HOUR, scalars.ventilation_index(
        F.col("wind_speed_10m"), F.col("boundary_layer_height")).alias("ventilation_index"))


@query("x7_inversion_strength", floats="inversion_strength", sql=f"""
WITH {WEATHER_SQL} SELECT series_id, hr, temperature_100m - temperature_2m AS inversion_strength
FROM wx""")
def x7(t: Tables) -> DataFrame:
    return weather(t).select(SERIES, HOUR, scalars.inversion_strength(
        F.col("temperature_100m"), F.col("temperature_2m")).alias("inversion_strength"))


@query("w3_wind_24h_mean", sql=f"""
WITH {WEATHER_SQL} SELECT series_id, hr, inversion_strength, ventilation_index, wind_u, wind_v,
  CASE WHEN count(wind_speed_10m) OVER w >= 12 THEN avg(wind_speed_10m) OVER w END AS wind_speed_24h_mean
FROM (SELECT *, temperature_100m - temperature_2m AS inversion_strength,
  wind_speed_10m * boundary_layer_height AS ventilation_index,
  -wind_speed_10m * sin(radians(wind_direction_10m)) AS wind_u,
  -wind_speed_10m * cos(radians(wind_direction_10m)) AS wind_v FROM wx)
WINDOW w AS (PARTITION BY series_id ORDER BY hr RANGE BETWEEN 23 PRECEDING AND CURRENT ROW)""",
       floats="inversion_strength ventilation_index wind_u wind_v wind_speed_24h_mean")
def w3_wind(t: Tables) -> DataFrame:
    return derive_weather(weather(t)).select(
        SERIES, HOUR, "inversion_strength", "ventilation_index", "wind_u", "wind_v",
        "wind_speed_24h_mean")


@query("x8_clip", floats="clipped", sql="""
SELECT event_id AS ingest_seq, greatest(0, least(500, value * 5 - 100)) AS clipped FROM events""")
def x8(t: Tables) -> DataFrame:
    return t.events().select(
        F.col("event_id").alias("ingest_seq"), scalars.clip(F.col("value") * 5 - 100).alias("clipped"))


@query("x9_gain_pct", floats="gain", sql="""
SELECT event_id AS ingest_seq, CASE WHEN base > 0 THEN (base - value) / base * 100 END AS gain
FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 40 AS DOUBLE) END AS base
  FROM events)""")
def x9(t: Tables) -> DataFrame:
    base = F.when(F.col("event_id") % 11 != 0, (F.col("user_id") % 40).cast("double"))
    return t.events().select(
        F.col("event_id").alias("ingest_seq"), scalars.gain_pct(base, F.col("value")).alias("gain"))


@query("x10_interval_band", floats="low high", sql="""
SELECT event_id AS ingest_seq, value - coalesce(err, 0) AS low, value + coalesce(err, 0) AS high
FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 40 AS DOUBLE) END AS err
  FROM events)""")
def x10(t: Tables) -> DataFrame:
    err = F.when(F.col("event_id") % 11 != 0, (F.col("user_id") % 40).cast("double"))
    return t.events().select(
        F.col("event_id").alias("ingest_seq"), scalars.band_low(F.col("value"), err).alias("low"),
        scalars.band_high(F.col("value"), err).alias("high"))


@query("x11_alert_severity", sql="""
SELECT event_id AS ingest_seq, CASE WHEN is_backfilled THEN 'now' WHEN h <= 24 THEN 'expected'
  WHEN h IS NOT NULL THEN 'possible' END AS severity
FROM (SELECT event_id, event_id % 3 = 0 AS is_backfilled,
  CASE WHEN user_id % 90 > 72 THEN NULL ELSE user_id % 90 END AS h FROM events)""")
def x11(t: Tables) -> DataFrame:
    h = F.when(F.col("user_id") % 90 <= 72, F.col("user_id") % 90)
    return t.events().select(
        F.col("event_id").alias("ingest_seq"),
        scalars.alert_severity(F.col("event_id") % 3 == 0, h).alias("severity"))


@query("x12_name_checks", sql="""
SELECT 'duplicate key' AS "check", 'user_id' AS subject,
  CAST(count(*) - count(DISTINCT user_id) AS BIGINT) AS amount FROM events
UNION ALL SELECT c, s, 1::BIGINT FROM (VALUES
  ('uppercase name', 'Event Type'), ('bad character in name', 'Event Type'),
  ('name starts with digit', '24h_value'), ('bad character in name', 'props.k'),
  ('non-numeric column', 'Event Type'), ('non-numeric column', 'props.k'),
  ('non-numeric column', 'ts')) v(c, s)""")
def x12(t: Tables) -> DataFrame:
    """Name checks as part of the gate over all events, under names a store would refuse."""
    return validate_features(t.events().select(
        "user_id", F.col("event_type").alias("Event Type"), F.col("value").alias("24h_value"),
        F.col("props").alias("props.k"), "ts"), ["user_id"])


@query("x13_json_access", floats="k missing_number", sql="""
SELECT event_id AS ingest_seq, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  -1.5::DOUBLE AS missing_number, 'none' AS missing_text FROM events""")
def x13(t: Tables) -> DataFrame:
    props = F.col("props")
    return t.events().select(
        F.col("event_id").alias("ingest_seq"), scalars.json_number(props, "$.k").alias("k"),
        scalars.json_number(props, "$.absent", -1.5).alias("missing_number"),
        scalars.json_text(props, "$.absent", "none").alias("missing_text"))
