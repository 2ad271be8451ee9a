"""Exact duplicates by content-defined chunk recipes.

Texts are normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space) and cut where a rolling hash of the
last 32 bytes meets a pattern, so equal passages are cut alike wherever they stand. Chunks are deduplicated to
identifiers that are verified on their bytes: an identifier is the 64-bit digest of the chunk, plus an ordinal
where different chunks share a digest. A document is then its ordered list of identifiers, and only those short
lists are grouped; every chunk is moved once, after identical chunks of a map task were merged.

Defined results: null texts count as empty; all empty texts are one group; a null doc_id never becomes keep_id
unless its whole group has none; rows that repeat both doc_id and text of the kept row are all marked kept in
the report, and ``drop_exact_copies`` emits one of them; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, flat, list_array, slices, stored, text_or_empty, unused

by_value(__name__)

WINDOW = 32             # bytes that decide about a cut
CUT_BITS = 11           # a cut every 2 KiB on average
CHUNK_BYTES = 1 << 16   # longest chunk; only texts without any cut for so long are cut by length
_GEAR = np.random.default_rng(20240501).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalised(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every run of white space as one space, within each text."""
    space = (body == 32) | ((body >= 9) & (body <= 13))
    first = np.ones(len(body), bool)
    first[1:] = ~space[:-1]
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    keep = ~space | first
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return np.where(space, np.uint8(32), body)[keep], kept_before[offsets]


def cuts(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chunk ends in ascending order; every text end is one of them."""
    if not len(body):
        return np.zeros(0, np.int64)
    rolling = _GEAR[body]
    width = 1
    while width < WINDOW:  # sums over 2, 4, ... 32 bytes, the older half shifted out of the way
        moved = np.zeros_like(rolling)
        moved[width:] = rolling[:-width] << np.uint32(width)
        rolling = rolling + moved
        width *= 2
    found = np.flatnonzero((rolling >> np.uint32(32 - CUT_BITS)) == 0) + 1
    # A window that reaches back over the start of a text would see its neighbour.
    start = offsets[np.searchsorted(offsets, found - 1, side="right") - 1]
    ends = np.unique(np.concatenate([found[found - start >= WINDOW], offsets[1:][np.diff(offsets) > 0]]))
    wide = np.diff(ends, prepend=0) > CHUNK_BYTES
    if wide.any():
        before = np.concatenate([[0], ends[:-1]])[wide]
        ends = np.unique(np.concatenate([ends] + [
            np.arange(a + CHUNK_BYTES, b, CHUNK_BYTES) for a, b in zip(before, ends[wide])]))
    return ends


def _digest(chunk: memoryview, bits: int) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True) >> (64 - bits)


def _prepared(batches: Iterator[pa.RecordBatch], bits: int):
    """Per slice: batch, bytes, text offsets, chunk starts and ends, chunk digests."""
    for batch in slices(batches, "text"):
        body, offsets = normalised(*flat(batch.column("text")))
        ends = cuts(body, offsets)
        view = memoryview(np.ascontiguousarray(body))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        digests = [_digest(view[a:b], bits) for a, b in zip(starts.tolist(), ends.tolist())]
        yield batch, view, offsets, starts, ends, digests


def _shas(view: memoryview, offsets: np.ndarray) -> list[str]:
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _recipes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch, view, offsets, _, ends, digests in _prepared(batches, bits):
        places = np.searchsorted(ends, offsets, side="right")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(_shas(view, offsets)), list_array(pa.array(digests, pa.int64()), places)],
            names=["doc_id", "text_sha256", "recipe"])


def _chunks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Different chunks of each slice."""
    for _, view, _, starts, ends, digests in _prepared(batches, bits):
        keys = list({(d, bytes(view[a:b])) for a, b, d in zip(starts.tolist(), ends.tolist(), digests)})
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary())],
            names=["digest", "content"])


def _occurrences(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch, view, offsets, starts, ends, digests in _prepared(batches, bits):
        row = np.searchsorted(offsets, starts, side="right") - 1
        shas = _shas(view, offsets)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), pa.array([shas[r] for r in row], pa.string()), pa.array(starts - offsets[row]),
             pa.array(digests, pa.int64()),
             pa.array([bytes(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
            names=["doc_id", "text_sha256", "place", "digest", "content"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def shared_digests(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(digest, content, ordinal) of digests that stand for more than one chunk; nearly always empty.

    This is the verification: all different chunks meet under their digest and are compared byte by byte.
    """
    chunks = _texts(docs).select("text").mapInArrow(partial(_chunks, bits=bits), "digest long, content binary")
    distinct = chunks.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n"))
    contents = distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    twice = stored(contents.where("n > 1").select("digest"), "exact-shared")
    if twice.isEmpty():
        return twice.select("digest", F.lit(b"").alias("content"), F.lit(0).alias("ordinal"))
    numbered = Window.partitionBy("digest").orderBy("content")
    return (chunks.join(twice, "digest", "left_semi").distinct()
            .withColumn("ordinal", F.row_number().over(numbered)))


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, recipe): the ordered, verified chunk identifiers of every row.

    An identifier list holds the digests, and after them the ordinals of those chunks whose digest is shared.
    """
    plain = _texts(docs).mapInArrow(
        partial(_recipes, bits=bits), "doc_id long, text_sha256 string, recipe array<long>")
    shared = shared_digests(docs, bits)
    if shared.isEmpty():
        return plain
    found = (_texts(docs).mapInArrow(partial(_occurrences, bits=bits), (
                "doc_id long, text_sha256 string, place long, digest long, content binary"))
             .join(shared, ["digest", "content"])
             .select("doc_id", "text_sha256", F.struct("place", "ordinal").alias("at")).distinct()
             .groupBy("doc_id", "text_sha256").agg(F.sort_array(F.collect_list("at")).alias("at")))
    same = plain.doc_id.eqNullSafe(found.doc_id) & (plain.text_sha256 == found.text_sha256)
    ordinals = F.transform(F.col("at"), lambda x: x["ordinal"].cast("long"))
    return plain.join(found, same, "left").select(
        plain.doc_id, plain.text_sha256,
        F.concat("recipe", F.coalesce(ordinals, F.array().cast("array<long>"))).alias("recipe"))


def exact_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    listed = stored(recipes(docs, bits), "exact-recipes")
    # A table of its own, so that the join below is one that Spark can split where a group is large.
    groups = stored(listed.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
                    "exact-groups")
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts, one row with the smallest doc_id; all columns as they are."""
    own, nth = unused(docs, "own_key", "nth")
    keys = F.struct("doc_id", "text_sha256").alias(own)
    stay = exact_groups(docs).where("kept").select(keys).distinct()
    sha = F.sha2(F.regexp_replace(text_or_empty(), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256)
    marked = docs.withColumn(own, F.struct(F.col("doc_id").cast("long").alias("doc_id"), sha.alias("text_sha256")))
    first = Window.partitionBy(own).orderBy(own)
    return marked.join(stay, own).withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).select(*docs.columns)
