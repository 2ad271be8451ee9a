"""Landed payloads and files -> flat readings. Schemas are declared; nothing is inferred.

Every ``read_*`` is a typed scan followed by a ``flatten_*`` on columns, so the
same flattening serves files, streams and payload text held in a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel import schemas
from airpanel.functions.aqi import aqi_from_pm25
from airpanel.functions.timefn import calendar_parts, epoch_to_ts, hour_number, parse_ts_utc
from airpanel.operators.dedupe import dedupe_ts
from airpanel.schemas import COMPONENTS, HOUR, LEGACY_WEATHER, SERIES, WEATHER_VARIABLES

DEFAULT_CITY = "Karachi"


def _components(entry: Column) -> dict[str, Column]:
    components = entry["components"]
    return {name: components[key] for key, name in COMPONENTS.items()}


def flatten_observations(payloads: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    """Combined pollution and weather payloads -> one reading each.

    Uses the first entry of the pollution list; the fetch time drives the calendar
    parts and the weather part the station time.
    """
    entry = F.get(F.col("pollution.list"), F.lit(0))
    carried = [c for c in payloads.columns if c not in schemas.OBSERVATION_PAYLOAD.names]
    fetched = parse_ts_utc(F.col("fetched_at_utc"))
    flat = payloads.select(
        *carried,
        F.coalesce(F.col("weather.name"), F.lit(city)).alias(SERIES),
        fetched.alias("fetched_at"),
        epoch_to_ts(F.col("weather.dt")).alias("station_timestamp"),
        entry["main"]["aqi"].alias("scale_1_5"),
        *[c.alias(name) for name, c in _components(entry).items()],
        F.col("weather.main.humidity").alias("humidity"),
        F.col("weather.main.pressure").alias("pressure"),
        F.col("weather.main.temp").alias("temperature"),
        F.col("weather.wind.speed").alias("wind"))
    return flat.withColumns({
        "aqi": aqi_from_pm25("pm25"), **calendar_parts(F.col("fetched_at"))})


def read_observations(spark: SparkSession, path: str, city: str = DEFAULT_CITY) -> DataFrame:
    payloads = spark.read.schema(schemas.OBSERVATION_PAYLOAD).json(path, multiLine=True)
    return flatten_observations(payloads, city)


def flatten_history(payloads: DataFrame, series: Column) -> DataFrame:
    """History payloads -> one backfilled reading per list entry; weather is not in the history."""
    carried = [c for c in payloads.columns if c not in schemas.HISTORY_PAYLOAD.names]
    entries = payloads.select(
        *[c for c in carried if c != SERIES], series.alias(SERIES), F.posexplode("list").alias("entry_no", "_entry"))
    entry = F.col("_entry")
    observed = epoch_to_ts(entry["dt"])
    flat = entries.select(
        *[c for c in carried if c != SERIES], SERIES, "entry_no",
        observed.alias("fetched_at"), observed.alias("station_timestamp"),
        entry["main"]["aqi"].alias("scale_1_5"),
        *[c.alias(name) for name, c in _components(entry).items()],
        F.lit(True).alias("is_backfilled"),
        *[F.lit(None).cast("double").alias(c) for c in LEGACY_WEATHER])
    return flat.withColumns({
        "aqi": aqi_from_pm25("pm25"), **calendar_parts(F.col("fetched_at"))})


def _panel(spark: SparkSession, path: str, schema: T.StructType, series: str | None) -> tuple[DataFrame, Column]:
    """Payloads and their series: given, or that of the folder ``series_id=...`` they lie in."""
    if series is not None:
        return spark.read.schema(schema).json(path, multiLine=True), F.lit(series)
    with_series = T.StructType([*schema.fields, T.StructField(SERIES, T.StringType())])
    return spark.read.schema(with_series).json(path, multiLine=True), F.col(SERIES)


def read_history(spark: SparkSession, path: str, series: str | None = DEFAULT_CITY) -> DataFrame:
    """One series, or with ``series=None`` a whole panel below ``series_id=<name>/`` folders in one scan."""
    return flatten_history(*_panel(spark, path, schemas.HISTORY_PAYLOAD, series))


def flatten_station_feed(payloads: DataFrame) -> DataFrame:
    """Accepted station payloads -> one row per reported parameter."""
    carried = [c for c in payloads.columns if c not in schemas.STATION_PAYLOAD.names]
    return (payloads.filter(F.col("status") == "ok")
            .select(
                *carried,
                F.col("data.city.name").alias("city"),
                F.col("data.aqi").alias("aqi"),
                F.col("data.dominentpol").alias("dominant_pollutant"),
                F.col("data.time.s").alias("local_time"),
                F.col("data.time.tz").alias("utc_offset"),
                parse_ts_utc(F.col("data.time.iso")).alias("observed_at"),
                F.explode("data.iaqi").alias("parameter", "_v"))
            .withColumn("value", F.col("_v.v")).drop("_v"))


def read_station_feed(spark: SparkSession, path: str) -> DataFrame:
    return flatten_station_feed(
        spark.read.schema(schemas.STATION_PAYLOAD).json(path, multiLine=True))


def flatten_weather_archive(payloads: DataFrame, series: Column, sequence: Column) -> DataFrame:
    """Struct-of-arrays weather -> hourly rows, the first delivery of an hour kept.

    ``sequence`` orders the payloads, by any orderable column or struct; equal values
    are told apart by the hour's place in its payload. Variables missing from the
    payload schema are simply absent from the result.
    """
    hourly = payloads.schema["hourly"].dataType
    variables = [v for v in WEATHER_VARIABLES if v in hourly.names]
    zipped = F.arrays_zip(*[F.col(f"hourly.{name}").alias(name) for name in ["time", *variables]])
    rows = payloads.select(
        series.alias(SERIES), sequence.alias("_payload"), F.posexplode(zipped).alias("_pos", "_h"))
    flat = rows.select(
        SERIES, hour_number(parse_ts_utc(F.col("_h.time"))).alias(HOUR),
        F.struct("_payload", "_pos").alias("_seq"),
        *[F.col(f"_h.{v}").alias(v) for v in variables])
    return dedupe_ts(flat.filter(F.col(HOUR).isNotNull()), [SERIES, HOUR], "_seq", "first").drop("_seq")


def read_weather_archive(
    spark: SparkSession, path: str, series: str | None, variables: list[str] | None = None
) -> DataFrame:
    """``variables`` narrows the schema to what the archive carries (the probe of the source).

    With ``series=None``, a whole panel below ``series_id=<name>/`` folders in one scan.
    """
    payloads, own = _panel(spark, path, schemas.weather_payload(variables), series)
    first = hour_number(parse_ts_utc(F.get(F.col("hourly.time"), F.lit(0))))
    # Files that begin at the same hour are told apart by their path.
    return flatten_weather_archive(payloads, own, F.struct(first, F.input_file_name()))


def read_feature_csv(
    spark: SparkSession, path: str, header: list[str], columns: list[str] | None = None
) -> DataFrame:
    """CSV with a header, every column text; timestamps are parsed later, in one place.

    ``columns`` prunes the scan to the named columns.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return df.select(*columns) if columns else df
