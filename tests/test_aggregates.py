"""Exact quartiles of values that crowd in a narrow range."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.operators.aggregates import _value_bucket, correlation, describe
from airpanel.schemas import SERIES


def test_quartiles_of_many_distinct_values_below_one(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias(SERIES), (F.rand(3) - F.when(F.col("id") % 2 == 0, 0.0).otherwise(0.5)).alias("v"))
    df = df.persist()
    buckets = df.groupBy(SERIES, _value_bucket(F.col("v")).alias("b")).count().agg(F.max("count")).first()[0]
    assert buckets < 100  # no bucket gathers a share of a series
    for row in describe(df, "v").collect():
        v = np.array([r.v for r in df.filter(F.col(SERIES) == row[SERIES]).select("v").collect()])
        assert [row.q25, row.q50, row.q75] == pytest.approx(np.quantile(v, [0.25, 0.5, 0.75]).tolist(), abs=1e-12)
    df.unpersist()


def test_value_buckets_keep_the_order(spark):
    values = sorted([0.0, -0.0, 1.0, -1.0, 2.0, 1.9999999999999998, 0.5, 0.49999999999999994, 1e-300, -1e-300, 1e300, 3.7, -8.0, -7.999999])
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
           .select("i", _value_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def test_correlation_with_a_column_that_never_varies(spark):
    rows = [(g, i, float(i), 0.013 + 3 / 7, float(i * i % 5)) for g in ("long", "longer") for i in range(70 if g == "long" else 700)]
    rows += [("one", 0, 1.0, 2.0, 3.0), ("one", 1, None, 5.0, 6.0), ("none", 0, None, 1.0, 1.0)]
    # Dealt over tasks, so that partial aggregates are merged.
    df = spark.createDataFrame(rows, f"{SERIES} STRING, i INT, x DOUBLE, fixed DOUBLE, y DOUBLE").repartition(7, "i")
    got = {r[SERIES]: r for r in df.groupBy(SERIES).agg(
        correlation("x", "y").alias("xy"), correlation("fixed", "y").alias("fy"),
        correlation("x", "fixed").alias("xf")).collect()}
    for name in ("long", "longer"):
        x, y = np.array([(r[2], r[4]) for r in rows if r[0] == name]).T
        assert got[name].xy == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
        assert np.isnan(got[name].fy) and np.isnan(got[name].xf)
    assert np.isnan(got["one"].xy) and got["none"].xy is None
