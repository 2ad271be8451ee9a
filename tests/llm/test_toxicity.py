from __future__ import annotations

import random
import time
import zlib

import numpy as np

from airpanel.llm.toxicity import DRIFT, Model, _decay, drop_toxic, fit, segments, toxic_passages, toxicity

rng = random.Random(4)
PLAIN = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}".replace("0", "") for i in range(200)]
BAD = ["idiot", "scum", "moron", "trash"]


def text(toxic):
    words = [rng.choice(PLAIN) for _ in range(rng.randrange(20, 120))]
    if toxic:
        for _ in range(rng.randrange(2, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).upper())
    return " ".join(words)


def sample(spark, documents, n=600):
    toxic = {i: int(i % 9 == 0) for i in range(n)}
    rows = [(i, text(toxic[i])) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, rows[0][1]), (None, rows[9][1]), (9, rows[9][1]), (n + 3, "word " * 200_000 + "idiot scum moron")]
    labels = [(i, 1, t) for i, t in toxic.items()] + [(3, 1, None), (18, 0, 0), (None, 1, 1)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), toxic


def test_held_out_accuracy_and_contract(spark, documents):
    docs, labels, toxic = sample(spark, documents)
    found = toxicity(docs, labels).collect()
    assert len(found) == 606
    held = [r for r in found if r.held_out and r.doc_id in toxic]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([toxic[r.doc_id] == r.predicted for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    score = {r.doc_id: r.score for r in found}
    assert score[602] == score[0] and score[None] == score[9] and score[600] == score[601] < 0.5


def test_labels_of_the_held_out_fold_and_other_columns_do_not_matter(spark, documents):
    docs, labels, _ = sample(spark, documents, 300)
    held = {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    other = spark.createDataFrame([(r.doc_id, 0, 1 - r.toxic if r.doc_id in held and r.toxic is not None else r.toxic) for r in labels.collect()],
                                  "doc_id long, quality int, toxic int")
    a, b = fit(docs, labels), fit(docs.withColumn("lang", docs.source), other)
    assert a.terms == b.terms and np.allclose(a.weights, b.weights) and a.k == b.k


def test_passages_are_where_the_words_are(spark, documents):
    docs, labels, _ = sample(spark, documents, 300)
    model = fit(docs, labels)
    assert set(BAD) <= {w for w, s in model.terms.items() if s > 0}
    long = [r for r in toxic_passages(docs, model).collect() if r.doc_id == 303]
    assert [(r.first_word, r.end_word, r.passage) for r in long] == [(200_000, 200_003, "idiot scum moron")]


def test_dropping_removes_toxic_rows_only(spark, documents):
    docs, labels, _ = sample(spark, documents, 300)
    bad = {r.doc_id for r in toxicity(docs, labels).where("predicted = 1").collect()}
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r.doc_id) for r in docs.collect() if r.doc_id not in bad)


def test_without_labels_or_documents(spark, documents):
    docs, labels, _ = sample(spark, documents, 60)
    none = labels.limit(0)
    assert {r.score for r in toxicity(docs, none).collect()} < {x for x in [0.0]} | {r.score for r in toxicity(docs, none).collect()}
    assert all(r.predicted == 0 for r in toxicity(docs, none).collect())
    assert toxicity(docs.limit(0), labels).collect() == [] and drop_toxic(docs.limit(0), labels).collect() == []
    assert all(r.predicted == 0 for r in toxicity(docs, labels.where("toxic = 0")).collect())


def brute_segments(scores, n, drift):
    """All maximal segments by their recursive definition: the best one, then those left and right of it."""
    line = [-drift] * n
    for at, s in scores:
        line[at] = s

    def best(a, b):
        top = max(((sum(line[i:j]), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if top is None or top[0] <= 1e-12:
            return []
        return best(a, top[3]) + [(top[0], top[3], top[4])] + best(top[4], b)

    return best(0, n)


def test_segments_equal_their_definition():
    for seed in range(300):
        r = random.Random(seed)
        n = r.randrange(1, 22)
        scores = sorted({i: r.uniform(-2, 3) for i in r.sample(range(n), r.randrange(0, n + 1))}.items())
        got, want = segments(scores, DRIFT), brute_segments(scores, n, DRIFT)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_long_texts_are_scanned_in_linear_time():
    shapes = [
        [(10 * i, 0.5) for i in range(100_000)],                                   # negative drift: every segment starts lower
        [(i, 1.0 if i % 2 else -0.9) for i in range(100_000)],                     # one growing segment
        [(i, -1.0 if i % 3 else 1.5) for i in range(100_000)],
        [(i, 100.0 / (i + 1) * (-1.0 if i % 2 else 1.0)) for i in range(100_000)],  # open ones pile up
    ]
    for hits in shapes:
        began = time.perf_counter()
        segments(hits, DRIFT)
        assert time.perf_counter() - began < 2


def test_decay_solves_its_equation():
    p, s = np.array([0.001, 0.002, 0.01]), np.array([4.0, 2.0, -1.0])
    x = _decay(p, s, 1 - p.sum())
    assert abs((p * np.exp(x * s)).sum() + (1 - p.sum()) * np.exp(-x * DRIFT) - 1) < 1e-6
    assert _decay(np.array([0.5]), np.array([1.0]), 0.5) == 1.0 and Model().terms == {}
