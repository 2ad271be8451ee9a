from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel.llm import topk
from airpanel.llm.topk import quantised, top_k

KIND = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("row", T.StringType()), T.StructField("score", T.IntegerType()), T.StructField("qb", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(i, v, "r", 1, "q") for i, v in rows], KIND).repartition(4)


def whole(x):
    return max(-(2**63 - 1), min(2**63 - 1, math.floor(256 * float(np.float32(x)))))


def expected(rows, k):
    usable = [(n, i, [whole(x) for x in v]) for n, (i, v) in enumerate(rows)
              if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    out = []
    for n, i, v in usable:
        if i is None or i % 50:
            continue
        others = []
        for m, j, w in usable:
            if m != n:
                score = max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(v, w))))
                others.append((-score, j is None, j or 0))
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(others)[:k])]
    return sorted(out, key=repr)


def found(rows, k=5, **blocks):
    best = top_k(quantised(rows, "vec_id", "embedding"), F.col("id") % 50 == 0, k, **blocks)
    return sorted((tuple(r) for r in best.select("query_id", "rank", "id", "score").collect()), key=repr)


def sample():
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(12)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 12) for i in range(150)]                     # one frequent vector: ties
    rows += [(500, None), (501, []), (550, []), (502, [0.0] * 12), (600, [0.0] * 3), (503, [1.0, None]), (504, [float("nan")]),
             (650, [float("inf")] * 2), (None, [0.9] * 12), (None, [0.1, 0.2]), (50, rows[50][1]), (50, [0.3] * 12), (700, [0.1] * 40)]
    return rows


def test_equals_brute_force(spark):
    assert found(table(spark, sample())) == expected(sample(), 5)


@pytest.mark.parametrize("k,blocks", [(1, {"query_block": 3, "candidate_block": 100}), (700, {"query_block": 4, "candidate_block": 50})])
def test_any_blocks_give_the_same(spark, k, blocks):
    assert found(table(spark, sample()), k, **blocks) == expected(sample(), k)


def test_sums_beyond_doubles_and_longs_are_exact(spark):
    rng = random.Random(3)
    for size in (1e6, 3e7, 1e30):
        rows = [(i, [rng.uniform(-size, size) for _ in range(6)]) for i in range(0, 120, 10)]
        assert found(table(spark, rows)) == expected(rows, 5)


def test_blocks_are_longer_than_one_array(spark, monkeypatch):
    monkeypatch.setattr(topk, "ARRAY", 700)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(20_000, 8)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    w = np.floor(256 * vectors.astype(float)).astype(np.int64)
    asked = np.arange(0, 20_000, 50)
    scores = w[asked] @ w.T
    scores[np.arange(len(asked)), asked] = -2**62
    wanted = []
    for q, line in zip(asked.tolist(), scores):
        for r, j in enumerate(np.lexsort((np.arange(20_000), -line))[:5].tolist()):
            wanted.append((q, r + 1, j, int(line[j])))
    assert found(table(spark, rows)) == sorted(wanted, key=repr)


def test_small_and_empty_tables(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(50, [1.0])])) == []
    assert found(table(spark, [(1, [1.0])])) == []
    assert found(table(spark, [(50, [1.0]), (3, [2.0])])) == [(50, 1, 3, 256 * 512)]
