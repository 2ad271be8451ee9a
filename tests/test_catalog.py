"""Registered queries against their SQL twins. AIRPANEL_ALL=1 runs every one of them."""

from __future__ import annotations

import math
import os
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: A day needs 18 readings, which only the larger tables have.
BY_DAY = {"daily_features", "e3_cross_validate_daily", "t10_calendar_gaps"}
QUICK = [
    "flagship_daily_air_quality", "t1_parse_ts_utc", "t11_fill_gaps", "a1_hourly_mean", "a5_describe",
    "w11_dedupe_hour_prefer_live", "hourly_features", "daily_features", "j1_join_weather",
    "j7_merge_keyed", "s1_read_observations", "s8_write_feature_group", "e3_cross_validate_daily",
    "i3_stream_hourly_mean", "i6_heal_gaps", "t10_calendar_gaps", "m5_ridge_certificate", "e3_skipped_cells",
    "s11_registry_versions", "l1_table_of_given_coefficients",
]
CHOSEN = sorted(oracle_sql()) if os.environ.get("AIRPANEL_ALL") else QUICK

pytestmark = pytest.mark.skipif(not Path(LARGER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def tables():
    from check import open_tables

    return {path: open_tables(path) for path in (SMALL, LARGER)}


def folder(name):
    larger = name in BY_DAY or name.startswith(FITTED) or "daily" in name
    return LARGER if larger else SMALL


#: Folds need series of more than 200 hours.
FITTED = ("m", "e", "l1_", "l2_", "l3_", "s11_", "s12_", "v", "a8_", "a9_", "a10_", "a11_", "a12_", "j5_", "p13_", "w13_", "x10_")


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, tables, name):
    from check import compare

    path = folder(name)
    status, notes = compare(spark, tables[path], path, name)
    assert status == "ok" and "TYPES" not in notes, notes


def test_entry_and_contract(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())


def test_unset_work_folder_falls_back_only_in_local_mode(spark):
    from airpanel.session import work_folder

    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_importance_of_features_that_never_vary(spark, tmp_path):
    """One user (o3 and no2 never vary), one reading of the index, and a level that never changes."""
    from check import compare, open_tables

    start, hours = datetime(2024, 1, 4), {"user": 60, "short": 18, "level": 40}
    rows = [{"event_id": 97 * n + 1 + n % 89, "ts": start + timedelta(hours=i), "user_id": 5, "event_type": name,
             "value": 50.0 if name == "level" else 10.0 + (i * i * 7) % 61, "props": f'{{"k": {i * 13 % 29}}}'}
            for k, (name, many) in enumerate(hours.items()) for i in range(many) for n in [100 * k + i]]
    pq.write_table(pa.Table.from_pylist(rows, pa.schema({
        "event_id": pa.int64(), "ts": pa.timestamp("us"), "user_id": pa.int64(), "event_type": pa.string(),
        "value": pa.float64(), "props": pa.string()})), tmp_path / "events.parquet")
    name = "v7_importance_top10"
    status, notes = compare(spark, open_tables(str(tmp_path)), str(tmp_path), name)
    assert status == "ok", notes
    top = {s: [] for s in hours}
    for r in queries()[name](spark, str(tmp_path)).orderBy("series_id", "rank").collect():
        top[r.series_id].append((r.feature, math.nan if r.value is None else r.value))
    assert [f for f, _ in top["user"][:3]] == ["no2", "o3", "aqi_lag1"]
    assert [math.isnan(v) for _, v in top["user"]] == [True] * 2 + [False] * 8
    assert all(math.isnan(v) for s in ("short", "level") for _, v in top[s]) and {len(t) for t in top.values()} == {10}
