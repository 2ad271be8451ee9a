"""Data-quality gates: each returns a table of findings rather than printing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel.functions.aqi import aqi_from_pm25
from airpanel.functions.timefn import DEFAULT_ZONE, hour_number, local_day
from airpanel.operators.aggregates import null_profile, regime_variability, worst_gap
from airpanel.operators.relational import latest_per_key
from airpanel.operators.timegrid import hourly_grid
from airpanel.schemas import HOUR, POLLUTANTS, SERIES
from airpanel.session import stored


def _problems(spark: SparkSession, check: str, subjects: list[str]) -> DataFrame:
    """One finding per subject, known while the plan is built."""
    return spark.range(1).select(
        F.lit(check).alias("check"),
        F.explode(F.array(*[F.lit(s) for s in subjects])).alias("subject"),
        F.lit(1).cast("bigint").alias("amount"))


def _rows(df: DataFrame, names: list[str], rows: list[tuple[Column, ...]]) -> DataFrame:
    """Several result rows out of each input row."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names, strict=True)]) for row in rows]
    return df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def name_checks(df: DataFrame) -> DataFrame:
    """Columns whose names are not lower-case letters, digits and underscores, or start with a digit."""
    names = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in df.columns])).alias("subject"))
    rules = {
        "uppercase name": F.col("subject") != F.lower("subject"),
        "bad character in name": ~F.col("subject").rlike(r"^[\p{L}\p{N}_]*$"),
        "name starts with digit": F.col("subject").rlike(r"^\p{N}"),
    }
    return (names
            .withColumn("check", F.explode(F.array_compact(F.array(
                *[F.when(rule, F.lit(name)) for name, rule in rules.items()]))))
            .select("check", "subject", F.lit(1).cast("bigint").alias("amount")))


def validate_features(df: DataFrame, pk: list[str], text_ok: list[str] | None = None) -> DataFrame:
    """Problems that forbid storing a frame; no row means it is safe.

    Duplicate keys are counted after grouping by key, and the row count and NULL
    keys come from the same grouping, so the data is read once.
    """
    spark = df.sparkSession
    missing = [c for c in pk if c not in df.columns]
    if missing:
        return _problems(spark, "missing key column", missing)
    allowed = set(pk) | set(text_ok or [])
    wrong_type = [f.name for f in df.schema.fields
                  if f.name not in allowed
                  and not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    by_key = df.groupBy(*pk).agg(F.count("*").alias("_n"))
    null_key = F.lit(False)
    for c in pk:
        null_key = null_key | F.col(c).isNull()
    totals = by_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dups"))
    key = ",".join(pk)
    found = _rows(totals, ["check", "subject", "amount"], [
        (F.lit("null key"), F.lit(key), F.col("nulls")),
        (F.lit("duplicate key"), F.lit(key), F.col("dups")),
        (F.lit("empty frame"), F.lit(""), (F.col("rows") == 0).cast("bigint")),
    ]).filter(F.col("amount") > 0)
    problems = found.unionByName(name_checks(df))
    if wrong_type:
        problems = problems.unionByName(_problems(spark, "non-numeric column", wrong_type))
    return problems


def _one_decimal(value: Column) -> Column:
    """Text with one decimal, rounded as C does: by the exact binary value, ties to even (``format_string`` rounds them up)."""
    tenths = 8 * value + 2 * value
    lacking = 2 * value - (tenths - 8 * value)  # ten times the value is exactly tenths + lacking
    nearest = F.when((tenths - F.floor(tenths) == 0.5) & (lacking != 0), F.floor(tenths) + (lacking > 0).cast("int"))
    return F.format_string("%.1f", F.coalesce(nearest.cast("double"), F.rint(tenths)) / 10)


def describe_frame(df: DataFrame, key: str = "ts", top: int = 6) -> DataFrame:
    """Row and column count, key range, and the columns with the most NULLs, as (item, detail) text."""
    shape = df.agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    head = _rows(shape, ["item", "detail"], [
        (F.lit("rows"), F.col("n").cast("string")),
        (F.lit("columns"), F.lit(str(len(df.columns)))),
        (F.lit("first"), F.col("lo").cast("string")),
        (F.lit("last"), F.col("hi").cast("string")),
    ])
    nulls = null_profile(df, top=top).select(
        F.concat(F.lit("nulls in "), "column_name").alias("item"),
        _one_decimal(F.col("null_pct")).alias("detail"))
    return head.unionByName(nulls)


def freshness_gate(
    readings: DataFrame, stored: DataFrame, max_hours: float = 12, time: str = "ts"
) -> DataFrame:
    """Adds ``gap_hours`` to the latest stored row and ``is_accepted``; a new series is accepted."""
    latest = latest_per_key(stored, time=time, name="_latest")
    seconds = (F.unix_seconds(F.col(time).cast("timestamp"))
               - F.unix_seconds(F.col("_latest").cast("timestamp")))
    return (readings.join(latest, SERIES, "left")
            .withColumn("gap_hours", seconds / 3600.0)
            .withColumn("is_accepted", F.coalesce(F.col("gap_hours") <= max_hours, F.lit(True)))
            .drop("_latest"))


def audit_hours(readings: DataFrame, time: str = "observed_at", zone: str = DEFAULT_ZONE) -> DataFrame:
    """One row per series, UTC hour and local day with everything the audit sums up.

    Every column's NULLs, the pollutants' sums and counts, rows, first and last time, negative and capped values.
    """
    negatives = sum((F.when(F.col(c) < 0, 1).otherwise(0) for c in POLLUTANTS), F.lit(0))
    sums = [f(c).alias(f"_{name}_{c}") for c in POLLUTANTS for name, f in (("sum", F.sum), ("count", F.count))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in readings.columns]
    return readings.groupBy(
        F.col(SERIES), hour_number(F.col(time)).alias(HOUR), local_day(F.col(time), zone).alias("date")).agg(
        F.count("*").alias("_n"), F.min(time).alias("_lo"), F.max(time).alias("_hi"), F.sum(negatives).alias("_neg"),
        F.count_if(F.col("pm25") > 500.4).alias("_cap"), *sums, *nulls)


def audit_report(readings: DataFrame, time: str = "observed_at", zone: str = DEFAULT_ZONE) -> DataFrame:
    """One long table (section, series_id, item, value) over every audit aggregate.

    The readings are read once and reduced to hours, which are stored; all sections come from those.
    """
    hours = stored(audit_hours(readings, time, zone), "audit-hours")
    total = hours.agg(F.sum("_n").alias("_rows"), *[F.sum(f"_null_{c}").alias(c) for c in readings.columns])
    nulls = (total.unpivot(["_rows"], readings.columns, "item", "_nulls").filter("_nulls > 0")
             .select(F.lit("nulls").alias("section"), F.lit(None).cast("string").alias(SERIES), "item",
                     (F.col("_nulls") * 100.0 / F.col("_rows")).alias("value")))
    means = lambda: [(F.sum(f"_sum_{c}") / F.sum(f"_count_{c}")).alias(c) for c in POLLUTANTS]
    daily = hours.groupBy(SERIES, "date").agg(*means()).withColumn("aqi", aqi_from_pm25("pm25").cast("double"))
    grid = hourly_grid(hours.groupBy(SERIES, HOUR).agg(*means()))
    seconds = F.unix_seconds(F.max("_hi").cast("timestamp")) - F.unix_seconds(F.min("_lo").cast("timestamp"))
    days = F.floor(seconds / 86400).cast("bigint")
    cells = hours.groupBy(SERIES).agg(
        F.sum("_n").alias("n_rows"), days.alias("span_days"),
        (F.sum("_n") * 100.0 / F.greatest(days * 24, F.lit(1))).alias("coverage_pct"),
        F.count_distinct(HOUR).alias("n_hours"), F.sum("_neg").alias("n_sentinels"), F.sum("_cap").alias("n_capped"))

    def melt(df: DataFrame, section: str, items: list[str], label: str | None = None) -> DataFrame:
        cast = df.select(
            SERIES, *([label] if label else []), *[F.col(c).cast("double").alias(c) for c in items])
        long = cast.unpivot([SERIES, *([label] if label else [])], items, "item", "value")
        name = F.concat_ws(" ", "item", label) if label else F.col("item")
        return long.select(F.lit(section).alias("section"), SERIES, name.alias("item"), "value")

    regimes = regime_variability(daily).withColumn(
        "_when", F.concat("year", F.lit("Q"), "quarter"))
    parts = [
        nulls,
        melt(cells, "coverage", ["n_rows", "span_days", "coverage_pct"]),
        melt(regimes, "variability", ["change_std"], "_when"),
        melt(worst_gap(grid), "worst_gap", ["n_missing", "missing_pct"]),
        melt(cells, "cells", ["n_rows", "n_hours", "n_sentinels", "n_capped"]),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


_PLAIN_NAME = re.compile(r"^[a-z_][a-z0-9_]*$")


def require_plain_name(name: str) -> str:
    """Guards names that become folder names."""
    if not _PLAIN_NAME.match(name):
        raise ValueError(f"not a plain lower-case name: {name!r}")
    return name
