"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every plan relies on; cluster sizing is left alone.

    Instants are compared and truncated in the session zone, so it is pinned to
    UTC. Adaptive execution picks join strategies from measured sizes, coalesces
    small shuffle partitions and splits skewed ones.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, below ``spark.checkpoint.dir``.

    The setting names storage that every executor can reach. Only a local-mode
    session without it falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="airpanel-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/airpanel/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written to the work folder and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
