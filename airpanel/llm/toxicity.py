"""Toxic passages as maximum-scoring segments of token log-odds.

Fit: for a bounded sample of labelled documents, each word's documents per class give log-odds with an informative Dirichlet
prior (``PRIOR_SHARE`` of the word's own count, at least ``PRIOR_LEAST``). Words whose log-odds are ``LEAST_Z`` standard deviations from 0 become
terms. A term scores its log-odds, any other word ``-DRIFT``, so the expected score is negative and scores of
maximal segments follow an extreme-value law: with lambda from sum(p * exp(lambda * s)) = 1 over the words of clean
documents and K by maximum likelihood, a segment of score S among n words has E = K * n * exp(-lambda * S).

Score: one linear scan finds all disjoint maximal segments of a document. Those with E <= ``LARGEST_E`` are its toxic passages.
The largest lambda * S - ln(K * n), the total over significant passages and their presence are mapped to a probability
by a logistic fit on the same sample, weighted to the share of toxic labels among all training labels.

Bounds: ``PER_CLASS`` labelled documents of each class, whose words are all candidates for terms; the driver sees the terms and
three numbers of each sampled text. Only the fit is bounded, every text is scanned whole. Labels, language, source and id are no inputs of a score.

Defined results: null or empty text has no words and gets the score of a text without evidence; null labels are left
out, several labels of one id count as the largest; without both classes there are no terms and every score is the share of
toxic labels, or 0 without labels; equal texts get equal scores; a null doc_id is not held out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, slices, stored, text_or_empty, unused
from airpanel.llm.sampling import fold, labelled_ids

by_value(__name__)

PER_CLASS = 10_000   # labelled documents of each class that a model is fitted on
PRIOR_SHARE = 0.05   # weight of the Dirichlet prior, as a share of all counted words
PRIOR_LEAST = 0.5    # and its least weight for a word
LEAST_Z = 3.0
LEAST_DOCS = 3
DRIFT = 0.1
LARGEST_E = 0.05
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0               # lambda
    k: float = 1.0                   # K
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """(score, first word, end) of all maximal segments; ``scores`` holds (position, score) of terms, other words cost ``drift``.

    Runs of other words are one step down, so the work is linear in the number of terms: every open segment knows the
    nearest one before it that starts lower, and once a segment starts lower than all open ones, those are final.
    """
    done: list[list[float]] = []
    found: list[list[float]] = []  # left sum, right sum, first position, end
    lower: list[int] = []          # the nearest earlier place in ``found`` with a smaller left sum
    total, upto = 0.0, 0
    for at, score in scores:
        total -= drift * (at - upto)
        left, total, upto = total, total + score, at + 1
        if score <= 0:
            continue
        new = [left, total, at, at + 1]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= new[0]:
                j = lower[j]
            if j < 0:
                done += found
                found, lower = [], []
                break
            if found[j][1] >= new[1]:
                break
            new[0], new[2], before = found[j][0], found[j][2], lower[j]
            del found[j:], lower[j:]
            j = before
        found.append(new)
        lower.append(j)
    return [(right - left, int(a), int(b)) for left, right, a, b in done + found]


def passages(words: list[str], model: Model) -> list[tuple[float, int, int]]:
    """(lambda * S - ln(K n), first word, end) of every maximal segment."""
    hits = [(i, model.terms[w]) for i, w in enumerate(words) if w in model.terms]
    size = math.log(model.k * max(len(words), 1))
    return [(model.decay * s - size, a, b) for s, a, b in segments(hits, DRIFT)]


def features(words: list[str], model: Model) -> tuple[float, float, float]:
    """The largest evidence, the total over significant passages, and whether there is one."""
    found = [x for x, _, _ in passages(words, model)]
    strong = [x for x in found if x >= -math.log(LARGEST_E)]
    return max(found, default=-math.log(model.k * max(len(words), 1))), math.log1p(sum(strong)), float(bool(strong))


def score(words: list[str], model: Model) -> float:
    z = model.weights[0] + sum(w * x for w, x in zip(model.weights[1:], features(words, model)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs: dict[int, Counter] = {0: Counter(), 1: Counter()}
    tokens: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def out() -> pa.RecordBatch:
        rows = [(w, c, n, tokens[c][w]) for c in docs for w, n in docs[c].items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), *[pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)]],
            names=["word", "toxic", "docs", "tokens"])

    for batch in slices(batches, "text"):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = words_of(text)
            tokens[toxic].update(words)
            docs[toxic].update(set(words))
        if sum(map(len, docs.values())) > 500_000:
            yield out()
            for counter in (*docs.values(), *tokens.values()):
                counter.clear()
    yield out()


def _largest(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The largest evidence of each text."""
    for batch in slices(batches, "text"):
        found = [features(words_of(text), model)[0] for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64())], names=["toxic", "largest"])


def _measured(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The three features of each text."""
    for batch in slices(batches, "text"):
        found = [features(words_of(text), model) for text in batch.column("text").to_pylist()]
        columns = [pa.array([x[i] for x in found], pa.float64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], names=["toxic", "largest", "total", "present"])


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        scores = [score(words_of(text), model) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def _clean(batches: Iterator[pa.RecordBatch], model: Model, limit: float, name: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, name):
        scores = [score(words_of(text), model) for text in batch.column(name).to_pylist()]
        kept = batch.filter(pa.array([s < limit for s in scores]))
        yield pa.RecordBatch.from_arrays(kept.columns[:-1], schema=pa.schema(list(kept.schema)[:-1]))


def _spans(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            lower = text.lower()
            places = [m.span() for m in _WORD.finditer(lower)]
            for x, a, b in passages([lower[s:e] for s, e in places], model):
                if x >= -math.log(LARGEST_E):
                    rows.append((doc_id, a, b, math.exp(-x), " ".join(lower[s:e] for s, e in places[a:b])))
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()))],
            names=["doc_id", "first_word", "end_word", "e_value", "passage"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def _decay(shares: np.ndarray, scores: np.ndarray, rest: float) -> float:
    """lambda > 0 with sum(p * exp(lambda * s)) = 1; 1 if no score is positive."""
    value = lambda x: float((shares * np.exp(x * scores)).sum() + rest * math.exp(-x * DRIFT)) - 1
    if not (scores > 0).any() or float((shares * scores).sum()) - rest * DRIFT >= 0:
        return 1.0
    low, high = 0.0, 1e-3
    while value(high) < 0:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    design = np.column_stack([np.ones(len(y)), x])
    beta, ridge = np.zeros(design.shape[1]), np.diag([1e-6] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + ridge, slope)
        beta += step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return tuple(beta.tolist())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labels whose fold is not 0."""
    known = (labels.where(F.col("toxic").isNotNull() & (fold() != 0))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("long")).alias("toxic")))
    shares = dict(known.groupBy("toxic").count().where("toxic IN (0, 1)").collect())
    prior = shares.get(1, 0) / max(1, sum(shares.values()))
    if not shares.get(0) or not shares.get(1):
        return Model(weights=(math.log(prior / (1 - prior)) if 0 < prior < 1 else 40.0 * (2 * prior - 1), 0.0, 0.0, 0.0))
    sample = F.broadcast(labelled_ids(known, "toxic", (0, 1), per_class))  # at most 2 * per_class pairs of numbers
    rows = stored(_texts(docs).join(sample, "doc_id").select("text", "toxic"), "toxicity-sample")
    counted = (rows.mapInArrow(_counted, "word string, toxic long, docs long, tokens long").groupBy("word").agg(
        F.sum(F.expr("IF(toxic = 1, docs, 0)")).alias("a"), F.sum(F.expr("IF(toxic = 0, docs, 0)")).alias("b"),
        F.sum(F.expr("IF(toxic = 0, tokens, 0)")).alias("clean")))
    counted = stored(counted, "toxicity-words")
    whole = counted.agg(F.sum("a"), F.sum("b"), F.sum("clean")).first()
    total_a, total_b, total_clean = (max(1, x or 0) for x in whole)
    alpha, weight = F.greatest(PRIOR_SHARE * (F.col("a") + F.col("b")), F.lit(PRIOR_LEAST)), PRIOR_SHARE * (total_a + total_b)
    odds = lambda n, total: F.log((F.col(n) + alpha) / (total + weight - F.col(n) - alpha))
    delta, spread = odds("a", total_a) - odds("b", total_b), F.sqrt(1 / (F.col("a") + alpha) + 1 / (F.col("b") + alpha))
    terms = (counted.where(F.col("a") + F.col("b") >= LEAST_DOCS).withColumn("delta", delta).withColumn("z", delta / spread)
             .where(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "word").select("word", "delta", "clean").collect())
    model = Model(terms={r.word: r.delta for r in terms})
    if terms:
        p = np.array([max(r.clean, 0.5) for r in terms], float) / total_clean
        model.decay = _decay(p, np.array([r.delta for r in terms]), max(0.0, 1 - float(p.sum())))
    # With K = 1, evidence is lambda * S - ln(n), and K = N / sum(n * exp(-lambda * S)) over clean texts is the likeliest.
    clean = rows.where("toxic = 0").mapInArrow(partial(_largest, model=model), "toxic long, largest double").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.exp(-F.col("largest"))).alias("s")).first()
    model.k = clean.n / clean.s if clean.n else 1.0
    seen = rows.mapInArrow(  # three numbers of each text of the sample
        partial(_measured, model=model), "toxic long, largest double, total double, present double").collect()
    if not seen:
        return model
    x = np.array([r[1:] for r in seen], float)
    y = np.array([r.toxic for r in seen], float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    model.weights = _logistic(x, y, weight)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = _texts(docs).mapInArrow(partial(_scored, model=fit(docs, labels)), "doc_id long, score double")
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: doc_id, first_word, end_word (word numbers), e_value, passage."""
    return _texts(docs).mapInArrow(
        partial(_spans, model=model), "doc_id long, first_word long, end_word long, e_value double, passage string")


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``limit``; all columns as they are."""
    (name,) = unused(docs, "own_text")
    return docs.withColumn(name, text_or_empty()).mapInArrow(
        partial(_clean, model=fit(docs, labels), limit=limit, name=name), docs.schema)
