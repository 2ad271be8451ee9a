"""Near duplicates by an inverted join over the coordinates of MinHash signatures.

1. A document is its set of distinct shingles of ``words`` words (64-bit hashes of the lower-cased words). Equal sets are one
   class; only one representative of a class goes on.
2. A signature has ``COORDINATES`` values. A pair counts as a candidate if at least ``threshold`` coordinates agree;
   the threshold is the largest that a pair of exactly the wanted similarity misses with a chance of ``MISS`` at most.
3. Representatives are posted under (coordinate, value). Values that occur once never collide, so a representative without
   ``threshold`` others is done. The rest are posted under their rarest values only, as many as are needed
   for any candidate pair to meet at least once (the prefix); long lists are thereby skipped.
4. A list is first merged with its hub only, the member whose values are the most common: in a group of edited copies
   that is the original. Hub pairs are as many as postings, whatever the size of a group.
5. Pairs whose members are linked by then need no comparison. Of lists that still hold several components, the other pairs are
   compared where the list is, in blocks of ``BLOCK`` members, and a pair goes on only in the first list it shares, if its collisions reach the threshold and
   upper bounds of the intersection suffice: the shingles its members share with anyone, and counts of their shingles in
   ``CELLS`` cells. No pair that could be a link is left out.
6. Every link is confirmed on the full sets: 100 * intersection >= 100 * similarity * union.

Defined results: null or empty texts, or texts of white space, have no shingles and are linked with nothing; a text
with fewer words is one shingle; documents with equal sets are linked whatever their size; repeated rows are
documents of their own with equal sets; a null doc_id is the component of a group only if all its ids are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, flat, list_array, slices, stored, text_or_empty, unused
from airpanel.llm.components import components

by_value(__name__)

COORDINATES = 32
MISS = 1e-6
CELLS = 512     # cells that the shingles of a set are counted in, for a bound on intersections
BLOCK = 2048    # members of a list that are compared in one piece of work with as many others
_RANDOM = np.random.default_rng(20240502)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_FLIP = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_SPREAD = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def threshold(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Most collisions that may be asked for: a pair of this similarity has fewer with a chance of at most ``miss``."""
    below = 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * similarity ** t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; the last ones are kept if they are of ordinary length."""
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    found = _POWERS.get(size) or (_powers(_BASE, size), _powers(_INVERSE, size))
    if size <= 1 << 23:
        _POWERS.clear()
        _POWERS[size] = found
    return found


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lowered, and the word offsets of the texts."""
    lower = np.where((body >= 65) & (body <= 90), body + np.uint8(32), body)
    space = (body == 32) | ((body >= 9) & (body <= 13))
    word = ~space
    head = word.copy()
    head[1:] &= space[:-1]
    borders = offsets[:-1][np.diff(offsets) > 0]
    head[borders] = word[borders]
    last = word.copy()
    last[:-1] &= space[1:]
    last[borders[1:] - 1] = word[borders[1:] - 1]
    starts, ends = np.flatnonzero(head), np.flatnonzero(last) + 1
    up, down = _tables(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_BYTE[lower] * up[:len(body)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(starts, offsets)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    hashes, at = word_hashes(body, offsets)
    factors = _powers(_BASE, words + 1)[1:] | np.uint64(1)
    n = len(hashes) - words + 1
    full = np.zeros(max(n, 0), np.uint64)
    for i in range(words if n > 0 else 0):
        full += hashes[i:i + n] * factors[i]
    full = _mixed(full)
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(full[a:b - words + 1]))
        elif b > a:  # salted with the number of words, so it equals no full shingle
            few = (hashes[a:b] * factors[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(_mixed(np.array([few], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` minima per non-empty set."""
    sets = [s for s in sets if len(s)]
    out = np.zeros((len(sets), COORDINATES), np.uint64)
    if sets:
        flat_sets = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        for k in range(COORDINATES):
            out[:, k] = np.minimum.reduceat((flat_sets ^ _FLIP[k]) * _SPREAD[k], starts)
    return out


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(np.ascontiguousarray(shingles), digest_size=16).digest()


def _signed(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = shingle_sets(*flat(batch.column("text")), words)
        filled = np.array([len(s) > 0 for s in sets])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_digest(s) for s in sets], pa.binary()),
             list_array(pa.array(signatures(sets).ravel().view(np.int64)),
                        np.concatenate([[0], np.cumsum(filled)]) * COORDINATES)],
            names=["doc_id", "text_key", "n_shingles", "set_id", "signature"])


def _cells(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles of each set per cell; an intersection is at most the sum of the smaller counts of both sides."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cell = (np.concatenate(sets) % np.uint64(CELLS)).astype(np.int64)
    return np.bincount(row * CELLS + cell, minlength=len(sets) * CELLS).reshape(len(sets), CELLS).astype("<u4")


def _full_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = shingle_sets(*flat(batch.column("text")), words)
        lengths = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        yield pa.RecordBatch.from_arrays(
            [pa.array([_digest(s) for s in sets], pa.binary()),
             list_array(pa.array(np.concatenate(sets).view(np.int64)), lengths),
             pa.array([row.tobytes() for row in _cells(sets)], pa.binary())], names=["set_id", "shingles", "cells"])


def _pairs_in(group: pa.Table, num: int, den: int, least: int) -> list[tuple[bytes, bytes]]:
    """Pairs of two blocks (or within one) of a list that may be links of different components."""
    ids, comps = group["set_id"].to_pylist(), group["component"].to_pylist()
    code = {c: i for i, c in enumerate(dict.fromkeys(comps))}
    comp = np.array([code[c] for c in comps])
    if len(code) < 2:
        return []
    n, shared = np.asarray(group["n_shingles"]), np.asarray(group["shared"])
    block, token = np.asarray(group["block"]), group["token"][0].as_py()
    signature = np.asarray(group["signature"].combine_chunks().flatten()).reshape(len(ids), COORDINATES)
    cells = np.frombuffer(b"".join(group["cells"].to_pylist()), "<u4").reshape(len(ids), CELLS)
    prefixes = group["prefix"].to_pylist()
    same = group["i"][0].as_py() == group["j"][0].as_py()
    left = np.arange(len(ids)) if same else np.flatnonzero(block == group["i"][0].as_py())
    right = left if same else np.flatnonzero(block == group["j"][0].as_py())
    enough = lambda both, x, y: den * both >= num * (n[x] + n[y] - both)
    found = []
    for at in range(0, len(left), 64):
        rows = left[at:at + 64]
        some = (comp[rows][:, None] != comp[right][None]) & enough(
            np.minimum(shared[rows][:, None], shared[right][None]), rows[:, None], right[None])
        if same:
            some &= rows[:, None] < right[None]
        x, y = np.nonzero(some)
        x, y = rows[x], right[y]
        for start in range(0, len(x), 20_000):
            a, b = x[start:start + 20_000], y[start:start + 20_000]
            match = (signature[a] == signature[b]).sum(axis=1) >= least
            a, b = a[match], b[match]
            close = enough(np.minimum(cells[a], cells[b]).sum(axis=1, dtype=np.int64), a, b)
            for p, q in zip(a[close].tolist(), b[close].tolist()):
                if min(set(prefixes[p]) & set(prefixes[q])) == token:  # else another list has the pair
                    found.append((min(ids[p], ids[q]), max(ids[p], ids[q])))
    return found


def _open_pairs(batches: Iterator[pa.RecordBatch], num: int, den: int, least: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (token, i, j); a group has two blocks at most."""
    def out(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _pairs_in(pa.Table.from_batches(parts), num, den, least) if parts else []
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    parts, key = [], None
    for batch in batches:
        keys = np.column_stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("token", "i", "j")])
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
        for a, b in zip(starts, np.append(starts[1:], len(keys))):
            if key != tuple(keys[a]):
                yield from out(parts)
                parts, key = [], tuple(keys[a])
            parts.append(batch.slice(a, b - a))
    yield from out(parts)


def _texts(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _agree(a: str, b: str) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    return (pairs.join(left, "a").join(right, "b")
            .where(den * both >= num * (F.size("left") + F.size("right") - both)).select("a", "b"))


def _postings(reps: DataFrame, least: int) -> DataFrame:
    """(set_id, n_shingles, score, token, prefix, signature) of representatives that may have a partner, by prefix token."""
    tokens = reps.select("set_id", F.posexplode("signature").alias("c", "value")).select(
        "set_id", F.xxhash64("c", "value").alias("token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chosen = (tokens.join(common, "token").groupBy("set_id")
              .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("all"))
              .where(F.size("all") >= least)
              .select("set_id", F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("score"),
                      F.slice(F.col("all.token"), 1, F.size("all") - least + 1).alias("prefix")))
    return chosen.join(reps.select("set_id", "n_shingles", "signature"), "set_id")


def links(docs: DataFrame, rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(a, b): set_ids of different sets; within a component they connect all sets that are similar enough."""
    least = threshold(num / den)
    reps = rows.where("n_shingles > 0").groupBy("set_id").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    posted = stored(_postings(reps, least), "near-postings")
    # One row of each candidate class, by the row key; then its shingles once more.
    # Copies are merged before they are joined, so a set that many rows share is no hot key.
    some = (rows.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_key")).alias("key"))
            .join(posted.select("set_id"), "set_id", "left_semi").select("key"))
    texts = _texts(docs)
    needed = texts.withColumn("key", F.struct("doc_id", "text_key")).join(some, "key", "left_semi").select("text")
    sets = stored(needed.mapInArrow(partial(_full_sets, words=words), "set_id binary, shingles array<long>, cells binary")
                  .dropDuplicates(["set_id"]), "near-sets")

    lists = posted.select("set_id", "n_shingles", "score", F.explode("prefix").alias("token"))
    hubs = lists.groupBy("token").agg(F.max(F.struct("score", "set_id")).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near_size = lambda a, b: den * F.least(a, b) >= num * F.greatest(a, b)
    of = posted.select("set_id", "n_shingles", "signature")
    pairs = (lists.join(hubs, "token").select(F.col("hub.set_id").alias("a"), F.col("set_id").alias("b"))
             .where("a <> b").distinct()
             .join(of.select(F.col("set_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb")), "b")
             .join(of.select(F.col("set_id").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa")), "a")
             .where(near_size(F.col("na"), F.col("nb")) & (_agree("sa", "sb") >= least)).select("a", "b"))
    first = stored(_confirmed(pairs, sets, num, den), "near-links")

    # What the hubs left open.
    known = components(first).select(F.col("node").alias("set_id"), "component")
    member = posted.join(known, "set_id", "left").select(
        "set_id", "n_shingles", "signature", "prefix", F.coalesce("component", "set_id").alias("component"))
    in_lists = member.select("set_id", "component", F.explode("prefix").alias("token"))
    unsettled = (in_lists.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                 .where("x <> y").select("token"))
    left_over = stored(in_lists.join(unsettled, "token", "left_semi").select("set_id", "token"), "near-unsettled")
    rare = (sets.join(left_over.select("set_id"), "set_id", "left_semi")
            .select("set_id", F.explode("shingles").alias("shingle"))
            .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.first("set_id").alias("set_id")).where("n = 1")
            .groupBy("set_id").agg(F.count(F.lit(1)).alias("own")))
    open_sets = (member.join(left_over.select("set_id"), "set_id", "left_semi").join(rare, "set_id", "left")
                 .join(sets.select("set_id", "cells"), "set_id")
                 .withColumn("shared", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
                 .where(den * F.col("shared") >= num * F.col("n_shingles")).drop("own"))
    # Blocks of a list meet pairwise, so no task ever holds more than two, whatever the length of a list.
    lengths = left_over.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    entries = (left_over.join(lengths, "token").join(open_sets, "set_id")
               .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    rest = (entries.select("token", "i", "j", "block", "set_id", "component", "n_shingles", "shared", "signature", "prefix", "cells")
            .repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
            .mapInArrow(partial(_open_pairs, num=num, den=den, least=least), "a binary, b binary").distinct())
    return first.union(_confirmed(rest, sets, num, den))


def _grouped(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    rows = stored(_texts(docs).mapInArrow(partial(_signed, words=words), (
        "doc_id long, text_key long, n_shingles long, set_id binary, signature array<long>")), "near-signatures")
    rows_only = rows.select("doc_id", "text_key", "n_shingles", "set_id")
    known = components(links(docs, rows, words, num, den)).select(F.col("node").alias("set_id"), "component")
    per_set = (rows_only.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
               .join(known, "set_id", "left").withColumn("component", F.coalesce("component", "set_id")))
    labels = per_set.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = per_set.join(labels, "component").select("set_id", "component", "component_id")
    return rows_only.join(named, "set_id", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. Linked from a similarity of num / den."""
    return _grouped(docs, words, num, den).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: one per group of near copies, all columns as they are.

    A group is a component of linked sets, whatever its ids: of each the row with the smallest doc_id stays, a null id last
    and equal ids by the hash of the text. Every row without words stays.
    """
    own_key, nth = unused(docs, "own_key", "nth")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    stay = (_grouped(docs, words, num, den).where("n_shingles > 0").groupBy("component").agg(first)
            .select(F.struct("first.doc_id", "first.text_key").alias(own_key)))
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_key"))
    again = Window.partitionBy(own_key).orderBy(own_key)
    worded = text_or_empty().rlike(r"[^\x20\x09-\x0D]")
    ones = (docs.where(worded).withColumn(own_key, own).join(stay, own_key).withColumn(nth, F.row_number().over(again))
            .where(F.col(nth) == 1).select(*docs.columns))
    return ones.union(docs.where(~worded))
