"""Queries: incremental updates and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airpanel.catalog import sqltext as S
from airpanel.catalog.base import Tables, query
from airpanel.functions.timefn import hour_number, hour_to_utc
from airpanel.operators import timegrid
from airpanel.operators.relational import newer_than
from airpanel.schemas import HOUR, HOURLY_FEATURES, POLLUTANTS, SERIES
from airpanel.sources.store import read_feature_group
from airpanel.streaming import incremental

_CUT = "2024-01-25"
_FLOATS = " ".join(S.FLOAT_FEATURES)
_BATCH = f"WITH {S.chain(mask='before_mean')}, {S.features()}"
_COLUMNS = ", ".join(S.FEATURES)


def _features(t: Tables, root: str) -> DataFrame:
    stored = read_feature_group(t.spark, root, incremental.FEATURES, 1)
    return stored.select(SERIES, HOUR, *HOURLY_FEATURES)


@query("i1_rebuild_features", floats=_FLOATS, sql=f"""
{_BATCH}, st AS (SELECT series_id, max(hr) AS m FROM ev WHERE observed_at < TIMESTAMP '{_CUT}' GROUP BY 1)
SELECT ft.series_id, hr, {_COLUMNS} FROM ft JOIN st ON st.series_id = ft.series_id WHERE hr > m""")
def i1(t: Tables) -> DataFrame:
    """Stored history plus newly arrived hours give the features of a full batch run."""
    hourly = timegrid.hourly_mean(t.faulty_readings(), mask="before_mean")
    is_old = hour_to_utc(F.col(HOUR)) < F.lit(_CUT).cast("timestamp_ntz")
    history, new = hourly.filter(is_old), hourly.filter(~is_old)
    rebuilt = incremental.rebuild_features(history, new)
    return newer_than(rebuilt, history, time=HOUR).select(SERIES, HOUR, *HOURLY_FEATURES)


@query("i2_incremental_update", floats=_FLOATS, sql=f"""
{_BATCH} SELECT series_id, hr, {_COLUMNS} FROM ft WHERE {S.COMPLETE}""")
def i2(t: Tables) -> DataFrame:
    """A store seeded up to a date, then the rest streamed through: equal to one batch run."""
    root = t.folder("incremental")
    cut = F.lit(_CUT).cast("timestamp_ntz")
    incremental.incremental_update(t.faulty_readings().filter(F.col("observed_at") < cut), root, 0)
    stream = t.faulty_readings(t.stream()).filter(F.col("observed_at") >= cut)
    incremental.run_updates(stream, root, f"{root}/checkpoint")
    return _features(t, root)


@query("i3_stream_hourly_mean", floats=" ".join(POLLUTANTS), sql=f"""
WITH {S.ev()}, {S.means()} SELECT * FROM hm""")
def i3(t: Tables) -> DataFrame:
    root = t.folder("stream-mean")
    means = incremental.stream_hourly_mean(
        t.project(t.stream()), POLLUTANTS, f"{root}/table", f"{root}/checkpoint")
    return means.select(SERIES, hour_number(F.col("ts")).alias(HOUR), *POLLUTANTS)


@query("i3_stream_hourly_mean_late_files", floats=" ".join(POLLUTANTS), sql=f"""
WITH {S.ev()}, {S.means()} SELECT * FROM hm""")
def i3_late(t: Tables) -> DataFrame:
    """The readings as five files, the oldest last, one micro-batch each: no hour is lost."""
    root = t.folder("stream-late")
    cut = F.ntile(5).over(Window.partitionBy(F.lit(1)).orderBy(F.col("day").desc()))
    days = t.events().select(F.to_date("ts").alias("day")).distinct().withColumn("part", cut)
    staged = t.events().withColumn("day", F.to_date("ts")).join(days, "day").drop("day")
    for part in range(1, 6):
        staged.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{root}/landed")
    stream = (t.spark.readStream.schema(t.events().schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{root}/landed"))
    means = incremental.stream_hourly_mean(
        t.project(stream), POLLUTANTS, f"{root}/table", f"{root}/checkpoint")
    return means.select(SERIES, hour_number(F.col("ts")).alias(HOUR), *POLLUTANTS)


@query("i4_stream_dedupe", floats="pm25", sql=f"""
WITH {S.ev()} SELECT series_id, hr, ingest_seq, is_backfilled, pm25 FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, hr ORDER BY is_backfilled, ingest_seq DESC) AS pick
  FROM ev) WHERE pick = 1""")
def i4(t: Tables) -> DataFrame:
    root = t.folder("stream-dedupe")
    stream = t.project(t.stream()).withColumn(HOUR, hour_number(F.col("observed_at")))
    return incremental.stream_dedupe(
        stream, f"{root}/table", f"{root}/checkpoint", [SERIES, HOUR]).select(
        SERIES, HOUR, "ingest_seq", "is_backfilled", "pm25")


@query("i4_stream_dedupe_within_watermark", sql=f"""
WITH {S.ev()} SELECT DISTINCT series_id, date_trunc('hour', observed_at) AS hour_utc FROM ev""")
def i4_watermark(t: Tables) -> DataFrame:
    """The stateful form keeps an arbitrary delivery, so keys only."""
    root = t.folder("stream-dedupe")
    unique = incremental.stream_dedupe_within_watermark(t.project(t.stream())).select(
        SERIES, F.col("hour_utc").cast("timestamp_ntz").alias("hour_utc"))
    table = incremental.drain_to_table(
        unique.withColumn("seen", F.lit(1)), f"{root}/table", f"{root}/checkpoint",
        [SERIES, "hour_utc"], mode="append").drop("seen")
    missed = incremental.missed_hours(
        t.project(t.stream()), table.withColumn("hour_utc", F.col("hour_utc").cast("timestamp")),
        f"{root}/seen", f"{root}/seen-checkpoint")
    return table.unionByName(missed.withColumn("hour_utc", F.col("hour_utc").cast("timestamp_ntz")))


@query("i5_late_policy", sql=f"""
WITH {S.ev()}, sd AS (SELECT series_id, hr FROM ev WHERE hr % 5 > 0 AND observed_at < TIMESTAMP '{_CUT}' GROUP BY ALL),
mx AS (SELECT series_id, max(hr) AS m FROM sd GROUP BY 1), al AS (SELECT DISTINCT series_id, hr FROM ev)
SELECT 'append_new' AS policy, al.series_id, count(*) AS n_hours FROM al
  JOIN mx ON mx.series_id = al.series_id LEFT JOIN sd ON sd.series_id = al.series_id AND sd.hr = al.hr
  WHERE sd.hr IS NOT NULL OR al.hr > m GROUP BY al.series_id
UNION ALL SELECT 'upsert', series_id, count(*) FROM al GROUP BY series_id""")
def i5(t: Tables) -> DataFrame:
    """Hours held after late readings arrive, under either policy."""
    from airpanel.operators.relational import merge_keyed

    hourly = timegrid.hourly_mean(t.readings())
    in_time = hour_to_utc(F.col(HOUR)) < F.lit(_CUT).cast("timestamp_ntz")
    stored = hourly.filter(in_time & (F.col(HOUR) % 5 > 0))
    held = [
        merge_keyed(stored, incremental.apply_late_policy(stored, hourly, policy), [SERIES, HOUR])
        .groupBy(SERIES).agg(F.count("*").alias("n_hours")).withColumn("policy", F.lit(policy))
        for policy in ("append_new", "upsert")]
    return held[0].unionByName(held[1])


@query("i5_upsert_features", floats=_FLOATS, sql=f"""
{_BATCH} SELECT series_id, hr, {_COLUMNS} FROM ft WHERE {S.COMPLETE}""")
def i5_upsert(t: Tables) -> DataFrame:
    """A day that arrives late and is upserted leaves the same features as a full batch run."""
    root = t.folder("upsert")
    late = F.to_date("observed_at") == F.lit("2024-01-20").cast("date")
    incremental.incremental_update(t.faulty_readings().filter(~late), root, 0)
    incremental.incremental_update(t.faulty_readings().filter(late), root, 1, policy="upsert")
    return _features(t, root)


@query("i6_heal_gaps", sql=f"""
WITH {S.ev('faulty')}, ob AS (SELECT DISTINCT series_id, hr FROM ev WHERE pm25 >= 0), st AS (
  SELECT series_id, hr, lead(hr) OVER (PARTITION BY series_id ORDER BY hr) - hr AS step FROM ob)
SELECT series_id, hr AS after_hr, step - 1 AS gap_hours,
  CASE WHEN step > 12 THEN 'refused' WHEN step - 1 <= 3 THEN 'healed' ELSE 'partial' END AS action,
  CAST(CASE WHEN step > 12 THEN 0 ELSE least(step - 1, 3) END AS BIGINT) AS n_filled
FROM st WHERE step > 1""")
def i6(t: Tables) -> DataFrame:
    measured = t.faulty_readings().filter(F.col("pm25") >= 0)
    return incremental.heal_gaps(timegrid.hourly_mean(measured))
