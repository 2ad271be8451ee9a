"""Incremental features: the hourly micro-batch as Structured Streaming.

Observed hourly means and features live in two feature groups. Filled values are
never read back as observations: each update recomputes the fill from what was
observed, so batch, incremental and streaming results agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airpanel.functions.timefn import hour_to_utc
from airpanel.operators.dedupe import dedupe_hour_prefer_live, keep_by_order
from airpanel.operators.features import add_hourly_features
from airpanel.operators.quality import freshness_gate, validate_features
from airpanel.operators.relational import complete_cases, merge_keyed, newer_than, select_features
from airpanel.operators.timegrid import grid_frame, hourly_mean
from airpanel.schemas import FEATURE_LOOKBACK_HOURS, HOUR, HOURLY_FEATURES, POLLUTANTS, SERIES
from airpanel.sources.store import (
    compact_feature_group, pending_batches, read_batch, read_feature_group, write_feature_group)

HISTORY_DAYS = 14
MAX_GAP_HOURS = 12
OBSERVED, FEATURES, QUARANTINE = "observed_hourly", "features_hourly", "quarantine"


def rebuild_features(history: DataFrame, new: DataFrame) -> DataFrame:
    """Features over stored and new hourly means; a redelivered hour replaces the stored one."""
    observed = merge_keyed(
        history.select(SERIES, HOUR, *POLLUTANTS), new.select(SERIES, HOUR, *POLLUTANTS),
        [SERIES, HOUR])
    return add_hourly_features(grid_frame(observed))


def apply_late_policy(stored: DataFrame, new: DataFrame, policy: str = "append_new") -> DataFrame:
    """``append_new`` keeps only hours after the latest stored one; ``upsert`` keeps every hour."""
    if policy == "append_new":
        return newer_than(new, stored, time=HOUR)
    if policy == "upsert":
        return new
    raise ValueError(f"unknown late policy {policy!r}")


def affected_hours(observed: DataFrame, changed: DataFrame, lookback: int) -> DataFrame:
    """Per series, the hours whose features a change can move: [start_hr, end_hr].

    From the hour after the previous observed one (a gap before the change is
    interpolated anew) to the next observed hour plus the feature look-back.
    """
    axis = (observed.select(SERIES, HOUR, F.lit(False).alias("_new"))
            .join(changed.select(SERIES, HOUR), [SERIES, HOUR], "left_anti")
            .unionByName(changed.select(SERIES, HOUR, F.lit(True).alias("_new"))))
    w = Window.partitionBy(SERIES).orderBy(HOUR)
    known = F.when(~F.col("_new"), F.col(HOUR))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = (axis
             .withColumn("_prev", before)
             .withColumn("_next", F.expr(
                 f"lead(CASE WHEN NOT _new THEN {HOUR} END, 1) IGNORE NULLS "
                 f"OVER (PARTITION BY {SERIES} ORDER BY {HOUR})"))
             .filter("_new"))
    return spans.groupBy(SERIES).agg(
        F.min(F.coalesce(F.col("_prev") + 1, F.col(HOUR))).alias("start_hr"),
        F.max(F.coalesce(F.col("_next"), F.col(HOUR)) + lookback).alias("end_hr"))


def rebuild_affected(observed: DataFrame, changed: DataFrame) -> DataFrame:
    """Features of just the hours that changed readings can move.

    The history starts at the newest fully measured hour that lies a whole
    look-back before the first affected hour, so no window and no interpolation
    sees a cut.
    """
    spans = affected_hours(observed, changed, FEATURE_LOOKBACK_HOURS)
    starts = (complete_cases(observed, POLLUTANTS).join(spans, SERIES)
              .filter(F.col(HOUR) <= F.col("start_hr") - FEATURE_LOOKBACK_HOURS)
              .groupBy(SERIES).agg(F.max(HOUR).alias("_cut")))
    history = (observed.join(starts, SERIES, "left")
               .filter(F.col("_cut").isNull() | (F.col(HOUR) >= F.col("_cut"))))
    return (rebuild_features(history, changed).join(spans, SERIES)
            .filter(F.col(HOUR).between(F.col("start_hr"), F.col("end_hr")))
            .drop("start_hr", "end_hr"))


def incremental_update(
    readings: DataFrame,
    root: str,
    batch: int,
    version: int = 1,
    policy: str = "append_new",
    time: str = "observed_at",
    compact_every: int | None = None,
) -> None:
    """One micro-batch of readings: gate, rebuild over the stored tail, validate, store.

    Series whose reading is too far ahead of the store go to the quarantine group until their gap is backfilled, and so do
    faulty ones (infinite means, or no name), while the others are stored. Re-running a batch number replaces its own
    output and nothing else. With ``compact_every``, batches before this one are merged whenever so many have
    gathered, so the cost of an update does not follow the age of the store.
    """
    incoming = hourly_mean(readings, mask="before_mean", time=time).withColumn(
        "ts", hour_to_utc(F.col(HOUR))).persist()
    try:
        if not incoming.isEmpty():
            _update(incoming, root, batch, version, policy)
    finally:
        incoming.unpersist()
    if compact_every:
        compact(readings.sparkSession, root, batch - 1, version, compact_every)


def compact(spark: SparkSession, root: str, upto: int, version: int = 1, least: int = 2) -> None:
    """Merge the batches up to ``upto`` of every group that has gathered ``least`` or more."""
    for name in (OBSERVED, FEATURES, QUARANTINE):
        if pending_batches(spark, root, name, version) >= least:
            compact_feature_group(spark, root, name, version, upto)


def faulty_series(hourly: DataFrame, cols: list[str] = POLLUTANTS) -> DataFrame:
    """(series): those with an infinite mean, and the one without a name."""
    wrong = F.col(SERIES).isNull()
    for c in cols:
        wrong = wrong | (F.abs(F.col(c).cast("double")) == F.lit(float("inf")))
    return hourly.filter(wrong).select(SERIES).distinct()


def replay_quarantine(
    spark: SparkSession, root: str, batch: int, version: int = 1, policy: str = "append_new"
) -> None:
    """Try refused hours again, as a batch of its own; those whose gap was filled meanwhile leave the quarantine."""
    waiting = read_feature_group(spark, root, QUARANTINE, version, before_batch=batch)
    if waiting is None:
        return
    waiting = waiting.persist()
    try:
        if waiting.isEmpty():
            return
        refused = _update(waiting, root, batch, version, policy)
        mine = waiting.alias("mine")
        done = waiting if refused is None else mine.join(
            refused.alias("theirs"), F.col(f"mine.{SERIES}").eqNullSafe(F.col(f"theirs.{SERIES}")), "left_anti")
        # Beside what the same batch refused again.
        write_feature_group(done.withColumn("_deleted", F.lit(True)), root, QUARANTINE, version, batch, mode="append")
    finally:
        waiting.unpersist()


def _update(incoming: DataFrame, root: str, batch: int, version: int, policy: str) -> DataFrame | None:
    """Gate, store and rebuild from hourly means; returns the refused series, if any."""
    written, refused, stored = _store_observed(incoming, root, batch, version, policy)
    fresh = _fresh_features(written, stored, root, batch, version, policy).persist()
    try:
        problems = validate_features(
            fresh.filter(~F.col("_deleted")).drop("_deleted"), [SERIES, HOUR], text_ok=["ts"]).filter(
            F.col("check") != "empty frame")
        if not problems.isEmpty():
            found = [r.asDict() for r in problems.limit(20).collect()]
            raise ValueError(f"update refused: {found}")
        write_feature_group(fresh, root, FEATURES, version, batch)
    finally:
        fresh.unpersist()
    return refused


def _store_observed(
    incoming: DataFrame, root: str, batch: int, version: int, policy: str
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Gate and store new hourly means; returns what this batch stored, the refused series, and the tail before it."""
    spark = incoming.sparkSession
    stored = read_feature_group(
        spark, root, OBSERVED, version, tail_days=HISTORY_DAYS, before_batch=batch, only=incoming)
    refused = faulty_series(incoming)
    if stored is not None:
        # A redelivery of an old hour says nothing about the gap in front of the new ones.
        ahead = newer_than(incoming, stored, time=HOUR)
        first_hours = freshness_gate(
            ahead.groupBy(SERIES).agg(F.min("ts").alias("ts")), stored, MAX_GAP_HOURS)
        refused = refused.unionByName(first_hours.filter(~F.col("is_accepted")).select(SERIES)).distinct()
    accepted, waiting = incoming, None
    refused = refused.persist()
    if not refused.isEmpty():
        mine, theirs = incoming.alias("mine"), refused.alias("theirs")
        same = F.col(f"mine.{SERIES}").eqNullSafe(F.col(f"theirs.{SERIES}"))
        # The refused rows keep their own time, so that they can be replayed.
        write_feature_group(mine.join(theirs, same, "left_semi"), root, QUARANTINE, version, batch)
        accepted = mine.join(theirs, same, "left_anti")
        waiting = read_batch(spark, root, QUARANTINE, version, batch, incoming.schema).select(SERIES).distinct()
    refused.unpersist()
    if stored is not None:
        accepted = apply_late_policy(stored, accepted, policy)
    write_feature_group(accepted, root, OBSERVED, version, batch)
    return read_batch(spark, root, OBSERVED, version, batch, incoming.schema), waiting, stored


def _fresh_features(
    written: DataFrame, stored: DataFrame | None, root: str, batch: int, version: int, policy: str
) -> DataFrame:
    """Complete feature rows that the stored batch adds or changes; under ``upsert`` also tombstones.

    A changed hour may leave others without complete features; their tombstones hide
    the rows that earlier batches stored for them.
    """
    spark = written.sparkSession
    touched = written.select(SERIES).distinct()
    tail = {"tail_days": HISTORY_DAYS, "before_batch": batch, "only": touched}
    if policy == "append_new":
        observed = None if stored is None else stored.join(touched, SERIES, "left_semi")
    else:
        observed = read_feature_group(spark, root, OBSERVED, version, before_batch=batch, only=touched)
    history = written.limit(0) if observed is None else observed
    wanted = (SERIES, HOUR, "ts")
    if policy == "append_new":
        fresh = rebuild_features(history, written)
        done = read_feature_group(spark, root, FEATURES, version, **tail)
        if done is not None:
            fresh = newer_than(fresh, done, time=HOUR)
        return select_features(complete_cases(fresh, HOURLY_FEATURES), HOURLY_FEATURES, wanted).withColumn(
            "_deleted", F.lit(False))
    changed = select_features(rebuild_affected(history, written), HOURLY_FEATURES, wanted)
    is_complete = F.lit(True)
    for name in HOURLY_FEATURES:
        is_complete = is_complete & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    return changed.withColumn("_deleted", ~is_complete)


def run_updates(stream: DataFrame, root: str, checkpoint: str, first_batch: int = 1, **options) -> None:
    """Drain a stream of readings through ``incremental_update`` and stop."""
    (stream.writeStream
     .foreachBatch(lambda df, n: incremental_update(df, root, first_batch + n, **options))
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True)
     .start()
     .awaitTermination())


def stream_hourly_mean(
    stream: DataFrame, cols: list[str], path: str, checkpoint: str, time: str = "observed_at"
) -> DataFrame:
    """Drain a stream to one-hour means per series, however late a reading arrives.

    Every micro-batch stores its own sums and counts under its number; the means are
    their totals. No watermark is involved, so backfilled readings count like others,
    and a batch that runs again replaces its own part only.
    """
    def write(df: DataFrame, n: int) -> None:
        sums = [F.sum(c).alias(f"sum_{c}") for c in cols]
        counts = [F.count(c).alias(f"count_{c}") for c in cols]
        (df.groupBy(SERIES, F.date_trunc("hour", F.col(time)).alias("ts")).agg(*sums, *counts)
         .write.mode("overwrite").parquet(f"{path}/batch={n}"))

    (stream.writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())
    parts = stream.sparkSession.read.parquet(path).groupBy(SERIES, "ts").agg(
        *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in cols],
        *[F.sum(f"count_{c}").alias(f"count_{c}") for c in cols])
    return parts.select(SERIES, "ts", *[
        F.when(F.col(f"count_{c}") > 0, F.col(f"sum_{c}") / F.col(f"count_{c}")).alias(c) for c in cols])


def stream_dedupe(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Drain a stream to one row per key: live beats backfilled, then the last ingested.

    Each micro-batch is reduced before it is shuffled or stored, and the choice is
    the same over batches as within one, so re-deliveries in any order are harmless.
    """
    def write(df: DataFrame, n: int) -> None:
        dedupe_hour_prefer_live(df, keys).write.mode("overwrite").parquet(f"{path}/batch={n}")

    (stream.writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())
    landed = stream.sparkSession.read.parquet(path).drop("batch")
    return dedupe_hour_prefer_live(landed, keys)


def stream_dedupe_within_watermark(
    stream: DataFrame, watermark: str = "2 hours", time: str = "observed_at"
) -> DataFrame:
    """The stateful form for continuous consumers: re-deliveries within the watermark are dropped.

    Readings later than the watermark are dropped as well; ``missed_hours`` finds them.
    """
    return (stream.withColumn("_t", F.date_trunc("hour", F.col(time).cast("timestamp")))
            .withWatermark("_t", watermark)
            .dropDuplicatesWithinWatermark([SERIES, "_t"])
            .withColumnRenamed("_t", "hour_utc"))


def missed_hours(
    stream: DataFrame, emitted: DataFrame, path: str, checkpoint: str, time: str = "observed_at"
) -> DataFrame:
    """Hours of a stream that the stateful form did not emit, because every delivery came too late."""
    def write(df: DataFrame, n: int) -> None:
        (df.select(SERIES, F.date_trunc("hour", F.col(time).cast("timestamp")).alias("hour_utc")).distinct()
         .write.mode("overwrite").parquet(f"{path}/batch={n}"))

    (stream.writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())
    seen = stream.sparkSession.read.parquet(path).select(SERIES, "hour_utc").distinct()
    return seen.join(emitted.select(SERIES, "hour_utc"), [SERIES, "hour_utc"], "left_anti")


def drain_to_table(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], mode: str = "update"
) -> DataFrame:
    """Run a stream to its end into a batch-numbered folder; returns the newest row per key.

    In update mode a group is emitted again whenever it changes, so at the end of the
    stream the table holds every group without waiting for the watermark; rows that
    a watermark dropped on the way are not in it.
    """
    def write(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={n}")

    (stream.writeStream.foreachBatch(write).outputMode(mode)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())
    spark: SparkSession = stream.sparkSession
    return keep_by_order(spark.read.parquet(path), keys, F.col("batch")).drop("batch")


def heal_gaps(hourly: DataFrame, fill_limit: int = 3, max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """What an hourly update does with every gap between observed hours of a series.

    ``healed`` (all hours filled), ``partial`` (the first ``fill_limit`` filled) or
    ``refused`` (too far behind, waits for a backfill).
    """
    w = Window.partitionBy(SERIES).orderBy(HOUR)
    step = F.lead(HOUR).over(w) - F.col(HOUR)
    gaps = (hourly.select(SERIES, HOUR).withColumn("_step", step)
            .filter(F.col("_step") > 1)
            .withColumn("gap_hours", F.col("_step") - 1))
    return gaps.select(
        SERIES, F.col(HOUR).alias("after_hr"), "gap_hours",
        F.when(F.col("_step") > max_gap, "refused")
        .when(F.col("gap_hours") <= fill_limit, "healed").otherwise("partial").alias("action"),
        F.when(F.col("_step") > max_gap, F.lit(0).cast("bigint"))
        .otherwise(F.least(F.col("gap_hours"), F.lit(fill_limit))).cast("bigint").alias("n_filled"))

