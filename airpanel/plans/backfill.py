"""A backfill as one run that goes on where it was stopped: chunks, their ledger, and the merged table.

The plan names the chunks of every series. A step takes the next chunks of all series at once, keeps one reading per hour,
stores them as one batch of a feature group, and then writes what became of each chunk into the ledger. A step that died is
not in the ledger, so its chunks are taken again and its batch is replaced. Chunks without any reading are listed as
failed and taken again by the next run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airpanel.functions.aqi import aqi_from_pm25
from airpanel.functions.timefn import hour_number, hour_to_utc
from airpanel.operators.dedupe import dedupe_hour_prefer_live, keep_by_order
from airpanel.operators.features import change_rate
from airpanel.schemas import HOUR, SERIES
from airpanel.sources.store import _read, group_path, read_feature_group, write_feature_group
from airpanel.sources.writers import write_table

BACKFILL = "backfill_hourly"
LEDGER = f"{SERIES} STRING, chunk_start BIGINT, chunk_end BIGINT, status STRING, n_hours BIGINT, batch INT"
_CHUNK = [SERIES, "chunk_start", "chunk_end"]


def _ledger_path(root: str, version: int) -> str:
    return f"{group_path(root, BACKFILL, version)}_ledger"


def ledger(spark: SparkSession, root: str, version: int = 1) -> DataFrame | None:
    """The newest state of every chunk that was ever taken: landed or failed, with its hours; None before the first step."""
    entries = _read(spark, _ledger_path(root, version), LEDGER)
    return None if entries is None else keep_by_order(entries, _CHUNK, F.col("batch"))


def chunk_states(plan: DataFrame, root: str, version: int = 1) -> DataFrame:
    """The chunks of a plan with their status (pending, landed, failed) and hours."""
    known = ledger(plan.sparkSession, root, version)
    if known is None:
        return plan.select(*_CHUNK, F.lit("pending").alias("status"), F.lit(0).cast("bigint").alias("n_hours"))
    return plan.join(known.drop("batch"), _CHUNK, "left").select(
        *_CHUNK, F.coalesce("status", F.lit("pending")).alias("status"),
        F.coalesce("n_hours", F.lit(0).cast("bigint")).alias("n_hours"))


def failed_ranges(plan: DataFrame, root: str, version: int = 1) -> DataFrame:
    """Chunks to ask for again."""
    return chunk_states(plan, root, version).filter("status = 'failed'").select(*_CHUNK)


def run_backfill(
    plan: DataFrame, readings: DataFrame, root: str, version: int = 1, chunks_per_step: int = 8,
    stop_after: int | None = None, time: str = "observed_at", sequence: str = "ingest_seq",
) -> int:
    """Take all chunks that have not landed, ``chunks_per_step`` of every series a step; returns the steps made.

    ``readings`` are what the payload readers make of the landed files. ``stop_after`` ends the run after so many steps.
    """
    spark = plan.sparkSession
    hourly = readings.withColumn(HOUR, hour_number(F.col(time)))
    # A window holds the chunks of one series: one a week.
    numbered = Window.partitionBy(SERIES).orderBy("chunk_start")
    waiting = (chunk_states(plan, root, version).filter("status <> 'landed'")
               .withColumn("_step", F.floor((F.row_number().over(numbered) - 1) / chunks_per_step)))
    entries = _read(spark, _ledger_path(root, version), LEDGER)
    batch = 0 if entries is None else 1 + (entries.agg(F.max("batch")).first()[0] or 0)
    waiting = waiting.select(*_CHUNK, "_step").persist()
    try:
        steps = waiting.agg(F.max("_step")).first()[0]
        made = 0
        for step in range(0 if steps is None else steps + 1):
            if stop_after is not None and made >= stop_after:
                break
            todo = waiting.filter(F.col("_step") == step).drop("_step")
            _step(todo, hourly, root, version, batch + made, sequence)
            made += 1
        return made
    finally:
        waiting.unpersist()


def _step(todo: DataFrame, hourly: DataFrame, root: str, version: int, batch: int, sequence: str) -> None:
    spark = todo.sparkSession
    inside = (hourly[SERIES] == todo[SERIES]) & (hourly[HOUR] >= todo["chunk_start"]) & (hourly[HOUR] < todo["chunk_end"])
    rows = dedupe_hour_prefer_live(hourly.join(todo, inside, "left_semi"), [SERIES, HOUR], sequence)
    write_feature_group(rows.withColumn("ts", hour_to_utc(F.col(HOUR))), root, BACKFILL, version, batch)
    # What the batch holds now, by the hours it stored.
    stored = read_feature_group(spark, root, BACKFILL, version)
    counts = todo.select(*_CHUNK, F.lit("failed").alias("status"), F.lit(0).cast("bigint").alias("n_hours"))
    if stored is not None:
        held = stored.select(F.col(SERIES).alias("_s"), F.col(HOUR).alias("_h"))
        inside = (F.col(SERIES) == F.col("_s")) & (F.col("_h") >= F.col("chunk_start")) & (F.col("_h") < F.col("chunk_end"))
        n = F.count("_h")
        counts = todo.join(held, inside, "left").groupBy(*_CHUNK).agg(
            F.when(n > 0, "landed").otherwise("failed").alias("status"), n.alias("n_hours"))
    counts.write.mode("overwrite").parquet(f"{_ledger_path(root, version)}/batch={batch}")


def merge_backfill(
    spark: SparkSession, live: DataFrame, root: str, path: str, version: int = 1, time: str = "observed_at",
    sequence: str = "ingest_seq",
) -> DataFrame:
    """Backfilled and live readings as one table: a reading per hour, live ones first, with the change of the index."""
    own = live.withColumn(HOUR, hour_number(F.col(time)))
    stored = read_feature_group(spark, root, BACKFILL, version)
    both = own if stored is None else own.unionByName(stored.drop("ts"))
    merged = dedupe_hour_prefer_live(both, [SERIES, HOUR], sequence).withColumn("aqi", aqi_from_pm25("pm25"))
    write_table(change_rate(merged, time), path, [SERIES, HOUR])
    return spark.read.parquet(path)
