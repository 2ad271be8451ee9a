"""Registry of runnable queries and their SQL twins.

A query reads the given tables (through ``Tables``), runs one operator over all
of their rows, and returns a DataFrame. Its SQL twin is written separately, for
another engine, from the operator's definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel.functions.scalars import json_number
from airpanel.schemas import POLLUTANTS, SERIES
from airpanel.session import configure, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Added before rounding for comparison: keeps exact decimal halves, which means of
# whole numbers often are, away from the last-bit noise of two engines.
_NUDGE = 1e-9


class Tables:
    """Panel projections of the given tables. Every projection keeps every row."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def events(self) -> DataFrame:
        return self.table("events")

    def stream(self) -> DataFrame:
        """The events as a file stream (the glob also accepts a single file)."""
        return (self.spark.readStream.schema(self.events().schema)
                .parquet(f"{self.sf_dir}/events.parquet*"))

    def project(self, events: DataFrame, pm25: Column | None = None) -> DataFrame:
        # Readings are multiples of 1/64, so sums are exact in any order.
        value = F.floor(F.col("value") * 64) / 64 if pm25 is None else pm25
        return events.select(
            F.col("event_type").alias(SERIES),
            F.col("ts").alias("observed_at"),
            (F.col("event_id") % 3 == 0).alias("is_backfilled"),
            F.col("event_id").alias("ingest_seq"),
            value.alias("pm25"),
            json_number(F.col("props"), "$.k").alias("pm10"),
            (F.col("user_id") % 120).cast("double").alias("o3"),
            (F.col("user_id") % 37).cast("double").alias("no2"),
            (F.col("event_id") % 23).cast("double").alias("so2"),
            (F.col("event_id") % 401).cast("double").alias("co"))

    def readings(self) -> DataFrame:
        return self.project(self.events())

    def sentinel_readings(self) -> DataFrame:
        """Some readings carry the missing-data sentinel."""
        return self.project(self.events(), self._sentinel())

    def faulty_readings(self, events: DataFrame | None = None) -> DataFrame:
        """Sentinels, and an instrument that measures no PM2.5 on some nights."""
        night = (F.dayofmonth("ts") % 7 == 3) & F.hour("ts").between(2, 7)
        return self.project(
            self.events() if events is None else events, F.when(~night, self._sentinel()))

    @staticmethod
    def _sentinel() -> Column:
        return F.when(F.col("event_id") % 97 == 0, F.lit(-9999.0)).otherwise(
            F.floor(F.col("value") * 64) / 64)

    def daily_readings(self) -> DataFrame:
        line = self.table("lineitem")
        return line.select(
            F.lit("all").alias(SERIES),
            F.col("l_shipdate").alias("observed_at"),
            F.col("l_quantity").alias("pm25"),
            F.floor("l_extendedprice").cast("double").alias("pm10"),
            F.round(F.col("l_discount") * 100).alias("o3"),
            F.round(F.col("l_tax") * 100).alias("no2"),
            F.col("l_linenumber").cast("double").alias("so2"),
            (F.col("l_partkey") % 100).cast("double").alias("co"))

    def folder(self, name: str) -> str:
        return work_folder(self.spark, name)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places for comparison."""
    return df.select(*[
        (F.round(F.col(f.name) + F.lit(_NUDGE), 6) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def query(name: str, sql: str | None = None, floats: str = "") -> Callable:
    """Register a query; ``floats`` names the DOUBLE columns its SQL twin has to round."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Tables(configure(spark), sf_dir)))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _rounded_sql(sql, floats.split())
        return fn
    return register


def _rounded_sql(sql: str, floats: list[str]) -> str:
    if not floats:
        return sql
    replaced = ", ".join(f"round({c} + 1e-9, 6) + 0e0 AS {c}" for c in floats)
    return f"SELECT * REPLACE ({replaced}) FROM (\n{sql}\n) AS result"


__all__ = ["ORACLES", "POLLUTANTS", "QUERIES", "Tables", "query", "rounded"]
