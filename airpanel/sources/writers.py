"""Sinks: full tables, raw landing, snapshots, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airpanel.operators.relational import require_columns
from airpanel.schemas import POLLUTANTS, SERIES


def write_table(
    df: DataFrame, path: str, sort_key: list[str], fmt: str = "parquet", partitions: int | None = None
) -> None:
    """Overwrite a whole table in time order.

    Range partitioning gives every file its own time span and sorts inside it, so
    readers prune by min/max; a hot series is split like any other range.
    """
    keys = [F.col(k) for k in sort_key]
    ranged = (df.repartitionByRange(partitions, *keys) if partitions
              else df.repartitionByRange(*keys))
    writer = ranged.sortWithinPartitions(*keys).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def land_raw(df: DataFrame, path: str, fetched: str = "fetched_at", fmt: str = "json") -> None:
    """Append raw payloads below their fetch date."""
    (df.withColumn("fetch_date", F.to_date(fetched))
     .write.mode("append").partitionBy("fetch_date").format(fmt).save(path))


def snapshot_table(spark: SparkSession, path: str, label: str, fmt: str = "parquet") -> str:
    """Copy a table beside itself before it is overwritten; returns the copy's path."""
    target = f"{path.rstrip('/')}.{label}"
    spark.read.format(fmt).load(path).write.mode("overwrite").format(fmt).save(target)
    return target


def export_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Key, times and raw pollutants of a feature table, for a trainer that recomputes the rest."""
    require_columns(df, [SERIES, ts, *POLLUTANTS])
    return df.select(
        SERIES, F.col(ts).alias("fetched_at"), F.col(ts).alias("station_timestamp"), *POLLUTANTS)


def write_export(df: DataFrame, path: str, ts: str = "ts", fmt: str = "parquet") -> None:
    """Write the export in time order; an empty table is refused.

    Rows are counted while they are written, so the input is computed once for the
    rows (range partitioning samples it besides). A refused export leaves an empty folder.
    """
    seen = Observation()
    ordered = (export_features(df, ts).repartitionByRange("fetched_at", SERIES)
               .sortWithinPartitions("fetched_at", SERIES).observe(seen, F.count(F.lit(1)).alias("n")))
    ordered.write.mode("overwrite").format(fmt).save(path)
    if not seen.get["n"]:
        raise RuntimeError("feature table is empty")


def write_metrics(metrics: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = metrics.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_metrics(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
