from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.llm import catalog
from airpanel.llm.periodic import frequent_segments, lag_scan, periodic_runs, run_lines, strongest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, exponent=3):
    found = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            smaller = any(all(words[k] == words[k + p] for k in range(start, end - p)) for p in range(1, q))
            if end - start >= max(least, exponent * q) and not smaller:
                found.add((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(5)
    made = [None, "", "  \n", "a", "x y z " * 30, "a " * 23, "a " * 24, "a\tb\n" * 12, "a b " * 11 + "a", "ab" * 100_000]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("abcdé") + rng.choice(["", "1"]) for _ in range(rng.randint(1, 12))]
            parts += unit * rng.randint(1, 9) + unit[:rng.randint(0, len(unit))]
            parts += [str(rng.random()) for _ in range(rng.randint(0, 2))]
        made.append(rng.choice([" ", "\n", "  "]).join(parts))
    for letters in ("ab", "abc", "aaaaaaab", "abcdefgh"):
        made += [" ".join(rng.choice(letters) for _ in range(rng.randint(30, 400))) for _ in range(15)]
    # Fibonacci words have very many runs; a period inside a period.
    a, b = ["a"], ["a", "b"]
    while len(b) < 500:
        a, b = b, b + a
    made.append(" ".join(b))
    inner = ["p"] * 30 + ["q"] + ["p"] * 30 + ["r"]
    made.append(" ".join(inner * 4))
    return made


def test_runs_equal_brute_force(documents):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "k l m " * 9), (3, "a"), (3, "a"), (4, "u v " * 40)]
    out = periodic_runs(documents(rows)).withColumn("best", strongest(F.col("runs"))).withColumn("lines", run_lines(F.col("runs")))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed, tuple(r.best) if r.best else None, r.lines)
                  for r in out.collect()), key=repr)
    wanted = []
    for i, t in rows:
        words = WORD.findall(t or "")
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        wanted.append((i, len(words), runs, collapsed(words, runs), best, "".join(f"{s},{n},{q}\n" for s, n, q in runs)))
    assert got == sorted(wanted, key=repr)
    assert sum(len(w[2]) for w in wanted) > 150


@pytest.mark.parametrize("least,exponent", [(1, 3), (6, 4), (40, 3)])
def test_other_thresholds(documents, least, exponent):
    rows = list(enumerate(texts()))
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(documents(rows), None, "doc_id", least, exponent).collect()}
    assert got == {i: brute_runs(WORD.findall(t or ""), least, exponent) for i, t in rows}
    with pytest.raises(ValueError):
        periodic_runs(documents(rows), exponent=2)


def test_the_whole_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 300)))) for i in range(200)]
    rows += [(200, None), (201, ""), (None, "a b " * 20), (7, "a b c"), (7, "a b c")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    wanted, planted = [], 0
    for i, t in rows:
        words = WORD.findall(t or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        wanted.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
                       hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    assert sorted((tuple(r) for r in out.select(names).collect()), key=repr) == sorted(wanted, key=repr)
    assert planted > 10 and any(w[1] for w in wanted)


def test_empty_table(documents):
    assert periodic_runs(documents([])).collect() == []


def test_long_texts_stay_fast():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(300_000, np.int64), np.arange(300_000) % 2, rng.integers(0, 40, 100_000), np.arange(300_000) % 100_000,
                (rng.random(100_000) < 0.02).astype(np.int64)):
        began = time.perf_counter()
        low, high = frequent_segments(ids, np.array([0]), np.array([len(ids)]), 24, 3)
        lag_scan(ids, low, high, 24, 3)
        assert time.perf_counter() - began < 20


def test_splitting_recurses_until_no_segment_has_a_rare_word():
    words = ("a b c " * 10 + "z " + "a b d " * 2 + "y " + "q " * 26).split()
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([names[w] for w in words])
    low, high = frequent_segments(ids, np.array([0]), np.array([len(ids)]), 24, 3)
    assert sorted(zip(low.tolist(), high.tolist())) == [(0, 30), (38, 64)]
