"""Exact top-k by inner product: exhaustive term-at-a-time accumulation in blocks.

Vectors are sparse rows: term numbers and integer weights. Queries and candidates are dealt into blocks by hashes of their row
numbers; a cell is one block of queries and one block of candidates. In a cell, candidates become posting lists by term, and
each term of a query row scatters its weighted postings into the query's dense array of scores, one place per
candidate. Partition selection takes the k best of each array, and the cells' survivors are merged per query.

Blocks have a bounded number of rows (``QUERY_BLOCK``, ``CANDIDATE_BLOCK``), so a task's memory does not follow the tables; a
candidate is moved once per block of queries and a query once per block of candidates. Every query meets every candidate:
nothing is pruned. Sums are exact: floats while their bound
is below 2^24, doubles below 2^53, else 64-bit integers, else Python's.

Defined results: a vector that is null or has a null or non-finite component takes no part; an empty vector, or one of zeros,
scores 0 with every other; vectors of different lengths meet on their common terms; ties go to the smaller id (null last);
rows that repeat an id are rows of their own, as queries and as candidates, and only the query's own row is no candidate; components
and scores beyond 64 bits are cut to the ends of that range; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, list_array, owner, stored

by_value(__name__)

QUERY_BLOCK = 8_192
CANDIDATE_BLOCK = 65_536
ARRAY = 8_192           # places of one dense array of scores
SIDE_BY_SIDE = 32       # query rows whose arrays are filled together
LONG_LIST = 4           # a posting list of one place in so many is kept as a whole line
_SPARSE = "row long, id long, terms array<int>, weights array<long>"
_MOST = np.iinfo(np.int64).max


def _quantise(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        offsets = vectors.offsets.to_numpy().astype(np.int64)
        parts = vectors.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).astype(float)
        offsets = offsets - offsets[0]
        whole = np.floor(scale * np.where(np.isfinite(parts), parts, 0.0))
        small = np.abs(whole) < 2.0**63
        whole = np.where(small, np.where(small, whole, 0).astype(np.int64), np.where(whole > 0, _MOST, -_MOST))
        used = whole != 0
        row = owner(offsets)
        terms = (np.arange(len(whole)) - offsets[row]).astype(np.int32)
        places = np.concatenate([[0], np.cumsum(np.bincount(row[used], minlength=batch.num_rows))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), list_array(pa.array(terms[used]), places),
             list_array(pa.array(whole[used]), places)], names=["row", "id", "terms", "weights"])


def quantised(vectors: DataFrame, key: str, vector: str, scale: float = 256.0) -> DataFrame:
    """Sparse rows (row, id, terms, weights) of floor(scale * component); ``row`` numbers the rows. Stored once."""
    usable = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"))
    return stored(rows.mapInArrow(partial(_quantise, scale=scale), _SPARSE), "topk-rows")


class _Rows:
    """Sparse rows in flat arrays, in ascending order of (id, row), null ids last."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks().sort_by([("id", "ascending"), ("row", "ascending")])
        self.row = table.column("row").to_numpy()
        self.id = table.column("id").combine_chunks()
        lists = table.column("terms").combine_chunks(), table.column("weights").combine_chunks()
        self.offsets = lists[0].offsets.to_numpy().astype(np.int64)
        self.offsets -= self.offsets[0]
        self.terms, self.weights = (x.flatten().to_numpy() for x in lists)

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row number from 0, term, weight) of the entries of these rows, by term."""
        part = slice(self.offsets[low], self.offsets[high])
        rows, terms = owner(self.offsets[low:high + 1]), self.terms[part]
        order = np.argsort(terms, kind="stable")
        return rows[order], terms[order], self.weights[part][order]


def _postings(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, kind, width: int) -> dict[int, tuple]:
    """By term: the places that hold it, or None, and their weights; a list that covers much of the width is a whole line."""
    names, at = np.unique(terms, return_index=True)
    ends = np.append(at[1:], len(terms))
    out = {}
    for t, a, b in zip(names.tolist(), at.tolist(), ends.tolist()):
        places, values = rows[a:b], weights[a:b].astype(kind)
        if LONG_LIST * (b - a) >= width:
            line = np.zeros(width, kind)
            line[places] = values
            places, values = None, line
        out[t] = places, values
    return out


def _exact_kind(queries: _Rows, candidates: _Rows):
    """The cheapest kind of number in which no sum of products can lose a digit."""
    def largest(rows: _Rows) -> tuple[int, int]:
        most = max((abs(int(rows.weights.max())), abs(int(rows.weights.min())))) if len(rows.weights) else 0
        return most, int(np.diff(rows.offsets).max()) if len(rows.offsets) > 1 else 0

    (a, n), (b, m) = largest(queries), largest(candidates)
    bound = a * b * min(n, m)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, the first places among equal ones."""
    if len(scores) <= k:
        return np.arange(len(scores))
    level = np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > level)
    return np.concatenate([above, np.flatnonzero(scores == level)[:k - len(above)]])


def _cell(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of this cell for each of its queries."""
    ask, give = _Rows(queries), _Rows(candidates)
    kind = _exact_kind(ask, give)
    groups = []
    for q in range(0, len(ask.row), SIDE_BY_SIDE):
        to = min(q + SIDE_BY_SIDE, len(ask.row))
        groups.append((q, to, _postings(*ask.between(q, to), kind, to - q)))
    kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in ask.row]
    for low in range(0, len(give.row), ARRAY):
        high = min(low + ARRAY, len(give.row))
        postings = _postings(*give.between(low, high), kind, high - low)
        product = np.empty((SIDE_BY_SIDE, high - low), kind)
        for q, to, wanted in groups:
            scores = np.zeros((to - q, high - low), kind)
            for term, (rows, weights) in wanted.items():
                if term not in postings:
                    continue
                places, values = postings[term]
                if rows is None and places is None:
                    out = product[:to - q]
                    np.multiply(weights[:, None], values, out=out)
                    scores += out
                elif places is None:
                    scores[rows] += weights[:, None] * values
                elif rows is None:
                    scores[:, places] += weights[:, None] * values
                else:
                    scores[rows[:, None], places] += weights[:, None] * values
            if kind is object:
                scores = np.clip(scores, -_MOST, _MOST)
            for i in range(q, to):
                own = np.flatnonzero(give.row[low:high] == ask.row[i])
                line = scores[i - q]
                at = _best(line, k + len(own))
                at = at[~np.isin(at, own)][:k] if len(own) else at
                kept[i].append((at + low, line[at]))
    picked, owners, totals = [], [], []
    for i, parts in enumerate(kept):
        at, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(at, kind="stable")
        at, values = at[order], values[order]
        best = _best(values, k)
        picked.append(at[best])
        totals.append(values[best])
        owners.append(np.full(len(best), i))
    place, who = np.concatenate(picked), np.concatenate(owners)
    score = np.concatenate(totals)
    return pa.table({"query": ask.row[who], "query_id": ask.id.take(pa.array(who)), "row": give.row[place],
                     "id": give.id.take(pa.array(place)), "score": score.astype(np.int64)})


_FOUND = "query long, query_id long, row long, id long, score long"


def _scored(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    if queries.num_rows and candidates.num_rows:
        return _cell(queries, candidates, k)
    return pa.table({name: pa.array([], pa.int64()) for name in ("query", "query_id", "row", "id", "score")})


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query, query_id, rank, row, id, score): the k best of all sparse ``rows`` for each row where ``is_query``.

    ``rows`` is a stored table (row, id, terms, weights), as ``quantised`` gives it; ``query`` and ``row`` are row numbers.
    """
    spark = rows.sparkSession
    queries = rows.where(is_query)
    n_queries, n_rows = queries.count(), rows.count()
    query_blocks = max(1, math.ceil(n_queries / query_block))
    # Small tables are cut finer, so that every core has a cell.
    cells = max(math.ceil(n_rows / candidate_block), 2 * spark.sparkContext.defaultParallelism // query_blocks, 1)
    by_hash = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("qb", by_hash(query_blocks, 1)).withColumn("cb", each(cells))
    given = rows.withColumn("cb", by_hash(cells, 2)).withColumn("qb", each(query_blocks))
    found = asked.groupBy("qb", "cb").cogroup(given.groupBy("qb", "cb")).applyInArrow(
        partial(_scored, k=k), _FOUND)
    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query", "query_id", "rank", "row", "id", "score"))

