"""Payload files, feature groups, incremental and streaming runs."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from airpanel.operators import quality
from airpanel.schemas import HOUR, HOURLY_FEATURES, POLLUTANTS, SERIES
from airpanel.sources import planning, readers, store, writers
from airpanel.streaming import incremental
from tests.test_grid import as_map, panel, spark_features


def land(tmp_path, name, *documents):
    folder = tmp_path / name
    folder.mkdir()
    for i, d in enumerate(documents):
        (folder / f"{i}.json").write_text(json.dumps(d, indent=2))
    return str(folder)


def observation(**changes):
    document = {
        "fetched_at_utc": "2026-03-02T04:05:06.000007+00:00", "lat": 1.5, "lon": 2.5,
        "pollution": {"list": [
            {"main": {"aqi": 2}, "dt": 1772424000,
             "components": {"co": 201.5, "no2": 3, "o3": 40.25, "so2": 1, "pm2_5": 12.03, "nh3": 0}},
            {"main": {"aqi": 5}, "dt": 1, "components": {"pm2_5": 400}}]},
        "weather": {"main": {"temp": 21.5, "pressure": 1002, "humidity": 64}, "wind": {"speed": 3},
                    "dt": 1772424300, "name": "Lagoon"}}
    document.update(changes)
    return document


def test_read_observations(spark, tmp_path):
    nameless = observation()
    del nameless["weather"]["name"]
    path = land(tmp_path, "obs", observation(), nameless)
    got = {r[SERIES]: r for r in readers.read_observations(spark, path).collect()}
    assert set(got) == {"Lagoon", "Karachi"}
    r = got["Lagoon"]
    assert (r.aqi, r.scale_1_5, r.pm25, r.pm10, r.no2, r.temperature, r.wind) == (
        50, 2, 12.03, None, 3.0, 21.5, 3.0)
    assert (r.hour, r.day, r.month, r.day_of_week) == (4, 2, 3, 0)
    assert r.station_timestamp.strftime("%H:%M:%S") == "04:05:00"


def test_read_history(spark, tmp_path):
    path = land(tmp_path, "hist", {"list": [
        {"dt": 1772424000, "main": {"aqi": 1}, "components": {"pm2_5": 5, "pm10": 9}},
        {"dt": 1772427600, "main": {"aqi": 3}, "components": {"pm10": -9999}}]}, {"list": []})
    got = readers.read_history(spark, path, "Lagoon").orderBy("fetched_at").collect()
    assert [(r.pm25, r.aqi, r.is_backfilled, r.temperature) for r in got] == [
        (5.0, 21, True, None), (None, None, True, None)]
    assert all(r.fetched_at == r.station_timestamp for r in got)


def test_read_station_feed_rejects_errors(spark, tmp_path, rows):
    good = {"status": "ok", "data": {
        "aqi": 61, "idx": 7, "city": {"name": "Quay", "geo": [1, 2]}, "dominentpol": "pm25",
        "iaqi": {"pm25": {"v": 61}, "t": {"v": 30.5}},
        "time": {"s": "2026-03-02 09:00:00", "tz": "+05:00", "v": 1, "iso": "2026-03-02T09:00:00+05:00"}}}
    path = land(tmp_path, "feed", good, {"status": "error", "data": "Unknown station"})
    got = readers.read_station_feed(spark, path)
    assert rows(got, "city", "parameter", "value") == [("Quay", "pm25", 61.0), ("Quay", "t", 30.5)]
    assert got.first().observed_at.strftime("%Y-%m-%d %H") == "2026-03-02 04"


def test_read_weather_archive_keeps_the_first_delivery(spark, tmp_path, rows):
    early = {"hourly": {"time": ["2026-03-01T00:00", "2026-03-01T01:00"], "temperature_2m": [20, None]}}
    late = {"hourly": {"time": ["2026-03-01T01:00", "2026-03-01T02:00"], "temperature_2m": [99, 22]}}
    path = land(tmp_path, "wx", early, late)
    got = readers.read_weather_archive(spark, path, "a", ["temperature_2m"])
    first = int(datetime(2026, 3, 1, tzinfo=timezone.utc).timestamp()) // 3600
    assert [t for _, _, t in rows(got)] == [20.0, None, 22.0]
    assert [h for _, h, _ in rows(got)] == [first, first + 1, first + 2]
    assert got.columns == [SERIES, HOUR, "temperature_2m"]


def test_csv_is_text_and_pruned(spark, tmp_path):
    (tmp_path / "f.csv").write_text("city,fetched_at,pm25\na,2026-01-01 00:00:00,7\n")
    df = readers.read_feature_csv(
        spark, str(tmp_path / "f.csv"), ["city", "fetched_at", "pm25"], ["fetched_at"])
    assert df.dtypes == [("fetched_at", "string")]
    assert "ReadSchema: struct<fetched_at:string>" in df._jdf.queryExecution().toString()


def test_backfill_plan(spark, rows):
    ends = spark.createDataFrame([("a", 447_000)], f"{SERIES} STRING, end_hr BIGINT")
    plan = planning.backfill_plan(ends, days=300)
    chunks = rows(plan, "chunk_start", "chunk_end")
    assert chunks[0][0] == planning.EARLIEST_HOUR and chunks[-1][1] == 447_000
    assert all(a[1] == b[0] for a, b in zip(chunks, chunks[1:], strict=False))
    assert all(e - s <= 168 for s, e in chunks)
    loaded = spark.range(planning.EARLIEST_HOUR, 447_000).filter("id <> 446500").select(
        F.lit("a").alias(SERIES), F.col("id").alias(HOUR))
    todo = planning.chunks_to_load(plan, loaded).collect()
    assert [(r.chunk_start <= 446_500 < r.chunk_end, r.n_missing) for r in todo] == [(True, 1)]


def hourly_with_ts(df):
    from airpanel.functions.timefn import hour_to_utc

    return df.withColumn("ts", hour_to_utc(F.col(HOUR)))


def test_feature_group_updates_in_place_and_repeats_harmlessly(spark, tmp_path, rows):
    root = str(tmp_path / "store")
    frame = f"{SERIES} STRING, {HOUR} BIGINT, v DOUBLE"
    first = hourly_with_ts(spark.createDataFrame([("a", 490_000, 1.0), ("a", 490_001, 2.0)], frame))
    second = hourly_with_ts(spark.createDataFrame([("a", 490_001, 9.0), ("a", 491_000, 3.0)], frame))
    store.write_feature_group(first, root, "hourly", 1, 0)
    for _ in range(2):
        store.write_feature_group(second, root, "hourly", 1, 1)
    got = store.read_feature_group(spark, root, "hourly", 1)
    assert rows(got, HOUR, "v") == [(490_000, 1.0), (490_001, 9.0), (491_000, 3.0)]
    tail = store.read_feature_group(spark, root, "hourly", 1, tail_days=14)
    assert rows(tail, HOUR) == [(491_000,)]
    assert rows(store.read_feature_group(spark, root, "hourly", 1, before_batch=1), HOUR, "v") == [
        (490_000, 1.0), (490_001, 2.0)]
    assert store.compact_feature_group(spark, root, "hourly", 1) == 1
    assert rows(store.read_feature_group(spark, root, "hourly", 1), HOUR, "v") == [
        (490_000, 1.0), (490_001, 9.0), (491_000, 3.0)]
    assert store.read_feature_group(spark, root, "absent", 1) is None
    with pytest.raises(ValueError):
        store.group_path(root, "../x", 1)


def test_snapshot_and_sorted_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("k"))
    writers.write_table(df, path, ["k"], partitions=3)
    copy = writers.snapshot_table(spark, path, "before")
    assert rows(spark.read.parquet(copy)) == rows(df)
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect()
    edges = sorted((r[1], r[2]) for r in spans)
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:], strict=False))


def test_export_refuses_empty_and_incomplete_tables(spark, tmp_path):
    empty = hourly_with_ts(panel(spark, 10)).limit(0)
    with pytest.raises(RuntimeError):
        writers.write_export(empty, str(tmp_path / "export"))
    with pytest.raises(KeyError):
        writers.export_features(empty.drop("co"))


def test_validation_problems(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x", 1.0), ("a", 1, "y", 2.0), (None, 2, "z", 3.0)],
        f"{SERIES} STRING, {HOUR} BIGINT, note STRING, `Bad-Name` DOUBLE")
    assert rows(quality.validate_features(df, [SERIES, HOUR])) == [
        ("bad character in name", "Bad-Name", 1), ("duplicate key", "series_id,hr", 1),
        ("non-numeric column", "note", 1), ("null key", "series_id,hr", 1),
        ("uppercase name", "Bad-Name", 1)]
    clean = df.filter("note = 'x'").drop("note", "Bad-Name")
    assert rows(quality.validate_features(clean, [SERIES, HOUR])) == []
    assert rows(quality.validate_features(clean.limit(0), [SERIES, HOUR]), "check") == [("empty frame",)]
    assert rows(quality.validate_features(clean, ["absent"]), "check", "subject") == [
        ("missing key column", "absent")]


def test_description_of_a_frame(spark, rows):
    # Shares of 6.25, 18.75 and 0.15 percent: ties go to even, and 0.15 lies below its tie.
    df = spark.range(80).select("id", F.col("id").alias(HOUR), F.when(F.col("id") >= 5, 1.0).alias("few"), F.when(F.col("id") >= 15, "x").alias("more"))
    assert rows(quality.describe_frame(df, key=HOUR)) == [
        ("columns", "4"), ("first", "0"), ("last", "79"), ("nulls in few", "6.2"), ("nulls in more", "18.8"), ("rows", "80")]
    long = spark.range(2000).select(F.col("id").alias(HOUR), F.when(F.col("id") >= 3, 1).alias("rare"))
    assert ("nulls in rare", "0.1") in rows(quality.describe_frame(long, key=HOUR))
    assert rows(quality.describe_frame(df.limit(0), key=HOUR)) == [("columns", "4"), ("first", None), ("last", None), ("rows", "0")]
    shares = spark.range(10_001).select((F.col("id") * 100.0 / 10_000).alias("share"))
    assert all(r[1] == f"{r[0]:.1f}" for r in shares.select("share", quality._one_decimal(F.col("share"))).collect())


def readings(hourly):
    """Hourly means as readings, one per hour."""
    return hourly_with_ts(hourly).withColumnRenamed("ts", "observed_at")


def complete(features):
    return as_map(features.na.drop(subset=HOURLY_FEATURES), HOURLY_FEATURES)


def stored(spark, root):
    return as_map(store.read_feature_group(spark, root, incremental.FEATURES, 1), HOURLY_FEATURES)


def assert_same(got, expected):
    assert set(got) == set(expected)
    for key, row in expected.items():
        assert got[key] == pytest.approx(row), key


@pytest.fixture(scope="module")
def series(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("series") / "hourly")
    panel(spark, 330, null=0.01).write.parquet(path)
    return spark.read.parquet(path)


def test_streaming_day_by_day_equals_one_batch_run(spark, tmp_path, series):
    root, landing = str(tmp_path / "store"), str(tmp_path / "landing")
    start = 480_000
    incremental.incremental_update(readings(series.filter(F.col(HOUR) < start + 300)), root, 0)
    schema = readings(series).schema
    for day, (lo, hi) in enumerate([(300, 301), (301, 312), (312, 330)]):
        part = series.filter(F.col(HOUR).between(start + lo, start + hi - 1))
        readings(part).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        incremental.run_updates(stream, root, f"{root}/checkpoint", first_batch=1)
        assert day < 3
    assert_same(stored(spark, root), complete(spark_features(series)))


def test_repeating_a_batch_changes_nothing(spark, tmp_path, series):
    root = str(tmp_path / "store")
    cut = F.col(HOUR) < 480_320
    incremental.incremental_update(readings(series.filter(cut)), root, 0)
    incremental.incremental_update(readings(series.filter(~cut)), root, 1)
    once = stored(spark, root)
    incremental.incremental_update(readings(series.filter(~cut)), root, 1)
    assert stored(spark, root) == once
    assert_same(once, complete(spark_features(series)))


def test_late_hours_are_discarded_or_upserted(spark, tmp_path, series):
    late = F.col(HOUR).between(480_250, 480_255)
    whole = complete(spark_features(series))
    without = complete(spark_features(series.filter(~late)))
    for policy, expected in (("append_new", without), ("upsert", whole)):
        root = str(tmp_path / policy)
        incremental.incremental_update(readings(series.filter(~late)), root, 0)
        incremental.incremental_update(readings(series.filter(late)), root, 1, policy=policy)
        got = stored(spark, root)
        assert_same({k: got.get(k) for k in expected}, expected)


def test_a_series_too_far_behind_is_quarantined(spark, tmp_path, series):
    root = str(tmp_path / "store")
    incremental.incremental_update(readings(series.filter(F.col(HOUR) < 480_300)), root, 0)
    ahead = series.filter((F.col(HOUR) >= 480_320) | ((F.col(SERIES) == "b") & (F.col(HOUR) >= 480_300)))
    incremental.incremental_update(readings(ahead), root, 1)
    refused = store.read_feature_group(spark, root, incremental.QUARANTINE, 1)
    assert {r[0] for r in refused.select(SERIES).distinct().collect()} == {"a"}
    newest = store.read_feature_group(spark, root, incremental.OBSERVED, 1).groupBy(SERIES).agg(
        F.max(HOUR)).collect()
    assert {r[0]: r[1] >= 480_300 for r in newest} == {"a": False, "b": True}


def test_a_redelivery_does_not_open_the_gate(spark, tmp_path, series):
    root = str(tmp_path / "store")
    incremental.incremental_update(readings(series.filter(F.col(HOUR) < 480_250)), root, 0)
    mixed = series.filter(F.col(HOUR).isin(480_150, 480_151, 480_320, 480_321))
    incremental.incremental_update(readings(mixed), root, 1)
    newest = store.read_feature_group(spark, root, incremental.OBSERVED, 1).agg(F.max(HOUR)).first()[0]
    refused = store.read_feature_group(spark, root, incremental.QUARANTINE, 1)
    assert newest < 480_250 and {r[0] for r in refused.select(SERIES).distinct().collect()} == {"a", "b"}


def test_refused_hours_are_replayed_after_their_backfill(spark, tmp_path, series):
    root = str(tmp_path / "store")
    gap = F.col(HOUR).between(480_290, 480_309)
    incremental.incremental_update(readings(series.filter(F.col(HOUR) < 480_290)), root, 0)
    incremental.incremental_update(readings(series.filter(F.col(HOUR) >= 480_310)), root, 1)
    incremental.replay_quarantine(spark, root, 2)
    assert store.read_feature_group(spark, root, incremental.QUARANTINE, 1).count() > 0
    incremental.incremental_update(readings(series.filter(gap)), root, 3)
    incremental.replay_quarantine(spark, root, 4)
    assert store.read_feature_group(spark, root, incremental.QUARANTINE, 1).count() == 0
    assert_same(stored(spark, root), complete(spark_features(series)))


def test_upserted_blanks_take_stored_features_away(spark, tmp_path, series):
    root = str(tmp_path / "store")
    blank = F.col(HOUR).between(480_250, 480_257)
    blanked = series.select(SERIES, HOUR, *[F.when(~blank, F.col(c)).alias(c) for c in POLLUTANTS])
    incremental.incremental_update(readings(series), root, 0)
    before = len(stored(spark, root))
    incremental.incremental_update(readings(blanked.filter(blank)), root, 1, policy="upsert")
    assert len(stored(spark, root)) < before
    assert_same(stored(spark, root), complete(spark_features(blanked)))


def test_gap_actions(spark, rows):
    df = spark.createDataFrame(
        [("a", h, *[1.0] * 6) for h in (0, 2, 6, 11, 30)],
        f"{SERIES} STRING, {HOUR} BIGINT, " + ", ".join(f"{c} DOUBLE" for c in POLLUTANTS))
    assert rows(incremental.heal_gaps(df), "after_hr", "gap_hours", "action", "n_filled") == [
        (0, 1, "healed", 1), (11, 18, "refused", 0), (2, 3, "healed", 3), (6, 4, "partial", 3)]


def test_export_is_in_time_order(spark, tmp_path):
    path = str(tmp_path / "export")
    writers.write_export(hourly_with_ts(panel(spark, 40)), path)
    spans = (spark.read.parquet(path).groupBy(F.input_file_name())
             .agg(F.min("fetched_at").alias("a"), F.max("fetched_at").alias("b"), F.count("*")).orderBy("a").collect())
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:], strict=False))


def test_panel_of_histories_in_one_scan(spark, tmp_path):
    for name, value in (("Lagoon", 5), ("Harbour", 7)):
        folder = tmp_path / "panel" / f"{SERIES}={name}"
        folder.mkdir(parents=True)
        (folder / "0.json").write_text(json.dumps({"list": [
            {"dt": 1772424000, "main": {"aqi": 1}, "components": {"pm2_5": value}}]}))
    got = {r[SERIES]: r.pm25 for r in readers.read_history(spark, str(tmp_path / "panel"), None).collect()}
    assert got == {"Lagoon": 5.0, "Harbour": 7.0}


def test_long_weather_payloads_keep_their_order(spark, tmp_path):
    def payload(n, value):
        hours = [datetime.fromtimestamp(1_600_000_000 // 3600 * 3600 + 3600 * i, timezone.utc).strftime("%Y-%m-%dT%H:%M") for i in range(n)]
        return {"hourly": {"time": hours, "temperature_2m": [value] * n}}

    folder = tmp_path / "archive" / f"{SERIES}=Lagoon"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps(payload(20_000, 1.0)))
    (folder / "b.json").write_text(json.dumps(payload(20_100, 2.0)))
    got = readers.read_weather_archive(spark, str(tmp_path / "archive"), None, ["temperature_2m"])
    counts = {r.temperature_2m: r["count"] for r in got.groupBy("temperature_2m").count().collect()}
    assert counts == {1.0: 20_000, 2.0: 100} and got.select(SERIES).distinct().collect()[0][0] == "Lagoon"


def test_live_rows_win_whatever_the_sequence(spark):
    from airpanel.operators.dedupe import dedupe_hour_prefer_live

    rows = [("a", 1, (1 << 62) + 5, True, 1.0), ("a", 1, 3, False, 2.0), ("a", 1, -7, False, 3.0), ("b", 1, (1 << 63) - 1, True, 4.0)]
    df = spark.createDataFrame(rows, f"{SERIES} string, {HOUR} long, ingest_seq long, is_backfilled boolean, pm25 double")
    got = {r[SERIES]: r.pm25 for r in dedupe_hour_prefer_live(df, [SERIES, HOUR]).collect()}
    assert got == {"a": 2.0, "b": 4.0}


def test_registry_keeps_versions_and_hides_half_written_ones(spark, tmp_path):
    root = str(tmp_path)
    models = spark.createDataFrame([("a", 1, "ridge", 0.5), ("a", 3, "persistence", None)],
                                   f"{SERIES} STRING, horizon INT, model STRING, alpha DOUBLE")
    metrics = spark.createDataFrame([("a", 1, 2.0, None, float("nan"))],
                                    f"{SERIES} STRING, horizon INT, rmse DOUBLE, mae DOUBLE, r2 DOUBLE")
    assert store.read_registry(spark, root) is None
    assert store.register_models(models, metrics, root) == 1
    # A second run that died before its row reached the log.
    models.write.parquet(f"{root}/model_registry/entries/version=2")
    assert store.read_registry(spark, root).first().version == 1
    assert store.register_models(models.filter("horizon = 1"), metrics, root) == 2
    newest = store.read_registry(spark, root).collect()
    assert [(r.version, r.horizon, r.name, r.target, r.metrics) for r in newest] == [(2, 1, "aqi_hourly_h1", "delta", {"rmse": 2.0})]
    first = {r.horizon: r.metrics for r in store.read_registry(spark, root, 1).collect()}
    assert first == {1: {"rmse": 2.0}, 3: None}
    assert [(r.version, r.n_models) for r in store.registered_versions(spark, root).orderBy("version").collect()] == [(1, 2), (2, 1)]
    with pytest.raises(ValueError):
        store.read_registry(spark, root, 3)


FRAME = f"{SERIES} STRING, {HOUR} BIGINT, v DOUBLE, _deleted BOOLEAN"


def opened(df):
    """(batch, month) of the files that a plan reads."""
    return {tuple(p.split("=")[1] for p in f.split("/")[-3:-1]) for f in df.inputFiles()}


def test_a_tail_opens_the_months_of_its_series_only(spark, tmp_path, rows):
    root = str(tmp_path)
    month = 24 * 31
    for batch in range(6):  # series "a" reports every month, "silent" in the first one only
        data = [("a", 490_000 + batch * month + i, float(i), False) for i in range(3)]
        data += [("silent", 490_000, 7.0, False)] if batch == 0 else []
        store.write_feature_group(hourly_with_ts(spark.createDataFrame(data, FRAME)), root, "g", 1, batch)
    pick = lambda *names: spark.createDataFrame([(n,) for n in names], f"{SERIES} STRING")
    latest = store.read_feature_group(spark, root, "g", 1, tail_days=3, only=pick("a"))
    assert {b for b, _ in opened(latest)} == {"5"} and latest.count() == 3
    both = store.read_feature_group(spark, root, "g", 1, tail_days=3)
    assert {b for b, _ in opened(both)} == {"0", "5"}
    assert rows(both, SERIES, HOUR)[-1] == ("silent", 490_000) and both.count() == 4
    early = store.read_feature_group(spark, root, "g", 1, tail_days=3, only=pick("a"), before_batch=3)
    assert {b for b, _ in opened(early)} == {"2"}
    assert store.read_feature_group(spark, root, "g", 1, only=pick("nobody")).count() == 0


def test_compaction_changes_no_row_and_a_crash_before_the_switch_changes_nothing(spark, tmp_path, rows, monkeypatch):
    root = str(tmp_path)
    put = lambda batch, *data: store.write_feature_group(
        hourly_with_ts(spark.createDataFrame([("a", *d) for d in data], FRAME)), root, "g", 1, batch)
    put(0, (490_000, 1.0, False), (490_001, 2.0, False), (491_500, 3.0, False))
    put(1, (490_001, 20.0, False), (491_500, None, True))
    put(2, (490_000, 100.0, False))
    wanted = [(490_000, 100.0), (490_001, 20.0)]
    read = lambda **k: rows(store.read_feature_group(spark, root, "g", 1, **k), HOUR, "v")
    assert read() == wanted and store.pending_batches(spark, root, "g", 1) == 3
    at_work = store.read_feature_group(spark, root, "g", 1)
    real = spark.createDataFrame
    with monkeypatch.context() as crash:
        crash.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.compact_feature_group(spark, root, "g", 1, 1)
    assert spark.createDataFrame.__func__ is real.__func__
    assert read() == wanted and store.pending_batches(spark, root, "g", 1) == 3
    assert store.compact_feature_group(spark, root, "g", 1, 1) == 1
    assert read() == wanted and rows(at_work, HOUR, "v") == wanted
    assert read(before_batch=2) == [(490_000, 1.0), (490_001, 20.0)]
    assert store.pending_batches(spark, root, "g", 1) == 1
    merged = spark.read.parquet(f"{store.group_path(root, 'g', 1)}/epoch=1")
    assert merged.count() == 2 and merged.filter("_deleted").count() == 0
    put(1, (490_001, -1.0, False))  # merged already: a replay does nothing
    put(3, (490_002, 5.0, False))
    assert read() == [*wanted, (490_002, 5.0)]
    assert store.compact_feature_group(spark, root, "g", 1) == 2 and read() == [*wanted, (490_002, 5.0)]
    assert store.compact_feature_group(spark, root, "g", 1) is None
    assert store.compact_feature_group(spark, root, "absent", 1) is None


def test_updates_with_compaction_equal_one_batch_run(spark, tmp_path, series):
    root = str(tmp_path / "store")
    start = 480_000
    incremental.incremental_update(readings(series.filter(F.col(HOUR) < start + 300)), root, 0)
    for batch, (lo, hi) in enumerate([(300, 304), (304, 312), (312, 330)], 1):
        part = series.filter(F.col(HOUR).between(start + lo, start + hi - 1))
        incremental.incremental_update(readings(part), root, batch, compact_every=3)
    assert store.pending_batches(spark, root, incremental.FEATURES, 1) == 2
    assert_same(stored(spark, root), complete(spark_features(series)))


def test_a_faulty_series_waits_while_the_others_are_stored(spark, tmp_path, series):
    root = str(tmp_path / "store")
    cut = F.col(HOUR) < 480_320
    incremental.incremental_update(readings(series.filter(cut)), root, 0)
    broken = F.when((F.col(SERIES) == "a") & (F.col(HOUR) == 480_322), F.lit(float("inf"))).otherwise(F.col("pm25"))
    new = series.filter(~cut).withColumn("pm25", broken)
    nameless = new.filter(f"{SERIES} = 'b' AND {HOUR} = 480321").withColumn(SERIES, F.lit(None).cast("string"))
    incremental.incremental_update(readings(new.unionByName(nameless)), root, 1)
    got = stored(spark, root)
    assert {k[0] for k in got if k[1] >= 480_320} == {"b"}
    assert_same({k: v for k, v in got.items() if k[0] == "b"},
                {k: v for k, v in complete(spark_features(series)).items() if k[0] == "b"})
    waiting = store.read_feature_group(spark, root, incremental.QUARANTINE, 1)
    assert {r[0] for r in waiting.select(SERIES).distinct().collect()} == {"a", None}


def test_a_stopped_backfill_goes_on_and_lists_failed_ranges(spark, tmp_path, rows):
    from airpanel.plans import backfill

    kind = f"{SERIES} STRING, {HOUR} BIGINT, pm25 DOUBLE, is_backfilled BOOLEAN, ingest_seq BIGINT"
    data = [("a", 480_000 + i, float(i), True, i) for i in range(0, 60, 2)]
    data += [("a", 480_004, 99.0, True, 900), ("b", 480_001, 5.0, True, 1), ("b", 480_055, 6.0, True, 2)]
    landed = readings(spark.createDataFrame(data, kind)).drop(HOUR)
    plan = spark.createDataFrame([(s, 480_000 + c, 480_010 + c) for s in "ab" for c in range(0, 60, 10)],
                                 f"{SERIES} STRING, chunk_start BIGINT, chunk_end BIGINT")
    live = readings(spark.createDataFrame([("a", 480_002, 1.5, False, 5)], kind)).drop(HOUR)
    results = []
    for name, stops in (("once", [None]), ("twice", [1, None])):
        root = str(tmp_path / name)
        assert {r.status for r in backfill.chunk_states(plan, root).collect()} == {"pending"}
        made = [backfill.run_backfill(plan, landed, root, chunks_per_step=3, stop_after=n) for n in stops]
        assert made == ([2] if name == "once" else [1, 2])
        failed = {(r[0], r[1]) for r in backfill.failed_ranges(plan, root).collect()}
        assert failed == {("b", 480_000 + c) for c in range(10, 50, 10)}
        table = backfill.merge_backfill(spark, live, root, f"{root}/merged")
        results.append((rows(backfill.chunk_states(plan, root)), rows(table, SERIES, HOUR, "pm25", "aqi_change_rate")))
    assert results[0] == results[1]
    values = {(r[0], r[1]): r[2] for r in results[0][1]}
    assert len(values) == 32 and values["a", 480_004] == 99.0 and values["a", 480_002] == 1.5
    # A later delivery of a failed range is taken; what landed is not read again.
    late = readings(spark.createDataFrame([("b", 480_020, 7.0, True, 3), ("a", 480_000, -1.0, True, 999)], kind)).drop(HOUR)
    assert backfill.run_backfill(plan, late, str(tmp_path / "once"), chunks_per_step=3) == 2
    again = rows(backfill.merge_backfill(spark, live, str(tmp_path / "once"), str(tmp_path / "m2")), SERIES, HOUR, "pm25")
    assert len(again) == 33 and ("b", 480_020, 7.0) in again and ("a", 480_000, 0.0) in again
