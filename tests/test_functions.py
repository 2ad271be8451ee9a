"""Golden values of the scalar functions."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from airpanel.functions import aqi, scalars, timefn

KNOWN = [
    (0.0, 0), (5.0, 21), (12.0, 50), (12.1, 51), (25.0, 78), (35.4, 100), (35.5, 101), (45.0, 124),
    (55.4, 150), (55.5, 151), (90.0, 169), (150.4, 200), (150.5, 201), (250.5, 301), (325.4, 375),
    (400.0, 434), (500.4, 500), (500.41, 500), (1965.05, 500), (None, None), (-5.0, None),
    (math.nan, None),
]
BETWEEN_BANDS = [12.03, 12.09, 35.43, 35.48, 55.41, 150.43, 150.48, 250.47, 350.42]


def plain_aqi(value):
    """The rule once more, one value at a time."""
    if value is None or math.isnan(value) or value < 0:
        return None
    c = math.floor(value * 10) / 10
    for lo, hi, i_lo, i_hi in aqi.PM25_BREAKPOINTS:
        if c <= hi:
            return int(round((i_hi - i_lo) / (hi - lo) * (c - lo) + i_lo))
    return 500


def test_known_index_values(spark):
    df = spark.createDataFrame(KNOWN, "v DOUBLE, expected INT")
    bad = df.filter(~aqi.aqi_from_pm25("v").eqNullSafe(F.col("expected"))).collect()
    assert bad == []


def test_every_hundredth_matches_the_plain_rule(spark):
    df = spark.range(0, 56_000).select((F.col("id") / 100).alias("v"))
    got = {r.v: r.a for r in df.select("v", aqi.aqi_from_pm25("v").alias("a")).collect()}
    assert all(plain_aqi(v) == a for v, a in got.items())


def test_values_between_bands_have_an_index(spark):
    df = spark.createDataFrame([(v,) for v in BETWEEN_BANDS], "v DOUBLE")
    assert df.filter(aqi.aqi_from_pm25("v").isNull()).count() == 0


def test_text_that_is_no_number_has_no_index(spark):
    df = spark.createDataFrame([("12.0",), ("smog",)], "v STRING")
    assert [r[0] for r in df.select(aqi.aqi_from_pm25("v")).collect()] == [50, None]


def test_capped_index(spark):
    df = spark.createDataFrame([(-5.0,), (None,), (math.nan,), (600.0,), (12.0,)], "v DOUBLE")
    assert [r[0] for r in df.select(aqi.aqi_capped("v")).collect()] == [500, None, None, 500, 50]


def test_categories(spark):
    df = spark.createDataFrame(
        [(50.0, "Good", "Good"), (51.0, "Moderate", "Moderate"), (50.5, None, "Moderate"),
         (500.0, "Hazardous", "Hazardous"), (501.0, "Hazardous", "Hazardous"),
         (-1.0, None, "Good"), (None, None, "Unknown"),
         (120.0, "Unhealthy for Sensitive Groups", "Unhealthy for sensitive groups")],
        "v DOUBLE, epa STRING, shown STRING")
    got = df.select("epa", aqi.aqi_category("v"), "shown", aqi.categorise("v")["label"]).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


def test_sql_functions_agree_with_columns(spark):
    aqi.register_sql_functions(spark)
    df = spark.createDataFrame([(v,) for v, _ in KNOWN], "v DOUBLE")
    assert df.filter(~F.expr("airpanel_aqi(v)").eqNullSafe(aqi.aqi_from_pm25("v"))).count() == 0


def test_timestamps(spark):
    df = spark.createDataFrame(
        [("2026-01-05 10:00:00",), ("2026-01-05T15:00:00+05:00",), ("2026-01-05 10:00:00.000000+00:00",),
         ("junk",), (None,)], "s STRING")
    hours = [r[0] for r in df.select(timefn.hour_number(timefn.parse_ts_utc(F.col("s")))).collect()]
    assert hours[0] == hours[1] == hours[2] and hours[3] is None and hours[4] is None


def test_monday_is_zero_and_local_hour_is_shifted(spark):
    one = spark.sql("SELECT TIMESTAMP_NTZ'2026-01-05 20:30:00' AS ts")
    r = one.select(
        timefn.calendar_parts(F.col("ts"))["day_of_week"].alias("d"),
        timefn.local_hour(F.col("ts")).cast("string").alias("h"),
        timefn.local_day(F.col("ts")).cast("string").alias("day")).first()
    assert (r.d, r.h, r.day) == (0, "2026-01-06 01:00:00", "2026-01-06")


def test_hours_before_the_epoch_are_floored(spark):
    one = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:30:00' AS ts")
    assert one.select(timefn.hour_number(F.col("ts"))).first()[0] == -1


def test_clip_gain_and_severity(spark):
    df = spark.createDataFrame([(-3.0, 10.0, 8.0), (600.0, 0.0, 8.0), (None, None, 8.0)],
                               "v DOUBLE, base DOUBLE, rmse DOUBLE")
    got = [tuple(r) for r in df.select(
        scalars.clip(F.col("v")), scalars.gain_pct(F.col("base"), F.col("rmse"))).collect()]
    assert got == [(0.0, 20.0), (500.0, None), (None, None)]
    hours = spark.createDataFrame([(True, None), (False, 24), (False, 25), (False, None)],
                                  "now BOOLEAN, h INT")
    assert [r[0] for r in hours.select(
        scalars.alert_severity(F.col("now"), F.col("h"))).collect()] == ["now", "expected", "possible", None]


@pytest.mark.parametrize(("direction", "u", "v"), [(0.0, 0.0, -2.0), (90.0, -2.0, 0.0), (270.0, 2.0, 0.0)])
def test_wind_components(spark, direction, u, v):
    r = spark.range(1).select(
        scalars.wind_u(F.lit(2.0), F.lit(direction)), scalars.wind_v(F.lit(2.0), F.lit(direction))).first()
    assert r[0] == pytest.approx(u, abs=1e-12) and r[1] == pytest.approx(v, abs=1e-12)
