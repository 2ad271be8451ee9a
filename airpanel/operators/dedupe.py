"""Keyed deduplication as aggregations, so that copies collapse before the shuffle.

A window with ``row_number`` would move every copy of a hot key to one task.
``max_by`` over fixed-width columns runs as a hash aggregation with map-side
combine: however many copies a key has, one row per key and map task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Above every BIGINT: flag and sequence compare as one decimal, which is of fixed width.
_FLAG = 1 << 64

_FIXED_WIDTH = (
    T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_by_order(df: DataFrame, keys: list[str], order: Column, keep: str = "last") -> DataFrame:
    """One whole row per key: the one with the largest (or smallest) order value.

    ``order`` must be unique inside a key, otherwise columns could come from
    different rows; ingest sequence numbers are.
    """
    pick_value = F.max_by if keep == "last" else F.min_by
    pick = F.max if keep == "last" else F.min
    rest = [c for c in df.columns if c not in keys]
    fixed = [c for c in rest if isinstance(df.schema[c].dataType, _FIXED_WIDTH)]
    wide = [c for c in rest if c not in fixed]
    ordered = df.withColumn("_order", order)
    if wide:
        # Strings cannot live in a hash-aggregation buffer; take the row as one struct.
        picked = ordered.groupBy(*keys).agg(
            pick(F.struct("_order", *rest)).alias("_row"))
        return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(df.columns)
    return (ordered.groupBy(*keys)
            .agg(*[pick_value(c, "_order").alias(c) for c in fixed])
            .select(df.columns))


def dedupe_exact(df: DataFrame, keys: list[str], sequence: str = "ingest_seq") -> DataFrame:
    """Per key, the row written last."""
    return keep_by_order(df, keys, F.col(sequence))


def dedupe_hour_prefer_live(
    df: DataFrame,
    keys: list[str],
    sequence: str = "ingest_seq",
    flag: str = "is_backfilled",
) -> DataFrame:
    """Per key, live rows beat backfilled ones, then the last ingested wins; a NULL flag is live."""
    live = ~F.coalesce(F.col(flag), F.lit(False))
    flagged = F.when(live, F.lit(str(_FLAG)).cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)"))
    order = (F.col(sequence).cast("decimal(37,0)") + flagged).cast("decimal(38,0)")
    return keep_by_order(df.withColumn(flag, ~live), keys, order)


def dedupe_ts(df: DataFrame, keys: list[str], sequence: str, keep: str = "last") -> DataFrame:
    """Per timestamp, the first or the last row by sequence."""
    return keep_by_order(df, keys, F.col(sequence), keep)


def dup_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key (NULL keys count as equal)."""
    return (df.groupBy(*keys).agg(F.count("*").alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates")))
