"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q and at least ``max(min_length, exponent * q)`` words that
no neighbouring word extends keeping the period. Each word of a run occurs ``exponent`` times within it, so a word that
occurs less often within its segment lies in no run and splits the segment there; the parts are counted anew until no
part holds a rare word, and parts below ``min_length`` words go. What survives is scanned by lag: the positions where a
word equals the one q further on form a stretch of at least 2q in a run, so a stretch holds two neighbouring
multiples of q, and only multiples of q are looked at for lag q (n log n comparisons for n words). Candidates are probed
at a few places and then followed word by word, which decides. Lags rise; a candidate whose 2q + 1 words lie in a run
already found repeats that run and is passed over.

Texts are cut into slices and never moved: one row in, one row out. Words are compared by their bytes.

Defined results: null and empty texts have no words, no run and an empty collapsed text; very long texts are whole (one
text is one unit of work); runs of different periods may overlap and are all reported; repeated rows and null ids are rows of
their own; an empty table gives an empty result; of other columns only the one named ``key`` is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, flat, list_array, slices, text_or_empty

by_value(__name__)

MIN_LENGTH = 24
EXPONENT = 3
RUN = "struct<start:long,length:long,period:long>"


def word_bounds(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start and end (exclusive); a text end always ends a word."""
    inside = ~((body == 32) | ((body >= 9) & (body <= 13)))
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(body) else inside
    after = np.concatenate([inside[1:], [False]]) if len(body) else inside
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def word_ids(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, equal for equal words, and the bytes of all words without what stands between."""
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    packed = body[np.repeat(starts - places[:-1], ends - starts) + np.arange(places[-1])]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), packed


def frequent_segments(
    ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int, times: int
) -> tuple[np.ndarray, np.ndarray]:
    """Segments of at least ``min_length`` words in which every word occurs ``times`` times or more."""
    done_starts, done_ends = [], []
    kinds = int(ids.max()) + 1 if len(ids) else 1
    while len(starts):
        long = ends - starts >= min_length
        starts, ends = starts[long], ends[long]
        lengths = ends - starts
        if not len(lengths):
            break
        firsts = np.cumsum(lengths) - lengths
        segment = np.repeat(np.arange(len(lengths)), lengths)
        at = np.repeat(starts - firsts, lengths) + np.arange(len(segment))
        codes, _ = pd.factorize(segment * kinds + ids[at])
        rare = np.bincount(codes)[codes] < times
        whole = np.add.reduceat(rare, firsts, dtype=np.int64) == 0
        done_starts.append(starts[whole])
        done_ends.append(ends[whole])
        kept = ~rare & ~whole[segment]
        at, segment = at[kept], segment[kept]
        if not len(at):
            break
        fresh = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0))
        starts, ends = at[fresh], np.append(at[fresh[1:] - 1], at[-1]) + 1
    if not done_starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(done_starts), np.concatenate(done_ends)


def _stretch(ids: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The positions around ``at`` whose word equals the one ``lag`` further on, between ``low`` and ``high``."""
    end, step = at + 1, 64
    while end + lag < high:
        stop = min(end + step, high - lag)
        differ = np.flatnonzero(ids[end:stop] != ids[end + lag:stop + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, step * 2
    start, step = at, 64
    while start > low:
        stop = max(start - step, low)
        differ = np.flatnonzero(ids[stop:start] != ids[stop + lag:start + lag])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, step * 2
    return start, end


def lag_scan(
    ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int, exponent: int
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run within the segments."""
    by_length = np.argsort(starts - ends, kind="stable")
    starts, lengths = starts[by_length], (ends - starts)[by_length]
    upto = np.concatenate([[0], np.cumsum(lengths)])
    if not upto[-1]:
        return []
    # The segments side by side, the longest first: a lag concerns a prefix of them.
    moved = np.repeat(starts - upto[:-1], lengths)
    longest = int(lengths[0]) // exponent
    words = np.concatenate([ids[moved + np.arange(upto[-1])], np.full(2 * longest + 1, -1)])
    first, last = np.repeat(upto[:-1], lengths), np.repeat(upto[1:], lengths)
    covered = np.zeros(upto[-1], np.int64)  # the furthest end of a run that holds this word
    found = []
    for lag in range(1, longest + 1):
        least = max(min_length, exponent * lag)
        n = int(upto[np.searchsorted(-lengths, -least, side="right")])
        if not n:
            break
        at = np.flatnonzero(words[0:n:lag] == words[lag:n + lag:lag]) * lag
        if len(at):
            at = at[(words[at] == words[at + 2 * lag]) & (last[at] > at + 2 * lag) & (covered[at] <= at + 2 * lag)]
        for probe in {lag // 2, lag // 4, lag - lag // 4, 1, lag - 1, lag // 3, lag - lag // 3, lag // 5}:
            if not len(at):
                break
            at = at[words[at + probe] == words[at + lag + probe]]
        beyond = -1
        for here in at.tolist():
            if here < beyond:
                continue
            start, beyond = _stretch(words, here, lag, int(first[here]), int(last[here]))
            if beyond > here + lag and beyond + lag - start >= least:  # else another multiple stands for the stretch
                np.maximum(covered[start:beyond + lag], beyond + lag, out=covered[start:beyond + lag])
                found.append((start + int(moved[start]), beyond + lag - start, lag))
    return found


def _joined(packed: np.ndarray, lengths: np.ndarray, texts: np.ndarray, kept: np.ndarray, n_texts: int) -> pa.Array:
    """The kept words of each text, joined by one space."""
    own = lengths[kept]
    text = texts[kept]
    gap = np.ones(len(own), np.int64)
    gap[np.flatnonzero(np.diff(text, append=-1) != 0)] = 0  # none behind the last word of a text
    places = np.cumsum(own + gap) - own - gap
    out = np.full(int((own + gap).sum()), 32, np.uint8)
    bytes_kept = packed[np.repeat(kept, lengths)]
    out[np.repeat(places - (np.cumsum(own) - own), own) + np.arange(len(bytes_kept))] = bytes_kept
    sizes = np.bincount(text, weights=own + gap, minlength=n_texts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.Array.from_buffers(pa.large_string(), n_texts, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _scan(batches: Iterator[pa.RecordBatch], min_length: int, exponent: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        body, offsets = flat(batch.column("text"))
        starts, ends = word_bounds(body, offsets)
        ids, packed = word_ids(body, starts, ends)
        bounds = np.searchsorted(starts, offsets)
        low, high = frequent_segments(ids, bounds[:-1], bounds[1:], min_length, exponent)
        runs = np.array(lag_scan(ids, low, high, min_length, exponent), np.int64).reshape(-1, 3)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        texts = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        depth = np.zeros(len(ids) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        collapsed = _joined(packed, ends - starts, texts, np.cumsum(depth)[:-1] == 0, batch.num_rows)
        places = np.searchsorted(runs[:, 0], bounds)
        values = pa.StructArray.from_arrays(
            [pa.array(runs[:, 0] - bounds[np.searchsorted(places, np.arange(len(runs)), side="right") - 1]),
             pa.array(np.ascontiguousarray(runs[:, 1])), pa.array(np.ascontiguousarray(runs[:, 2]))],
            names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(np.diff(bounds)), list_array(values, places), collapsed],
            names=["key", "n_words", "runs", "collapsed"])


def periodic_runs(
    docs: DataFrame, text: Column | None = None, key: str = "doc_id", min_length: int = MIN_LENGTH, exponent: int = EXPONENT
) -> DataFrame:
    """(key, n_words, runs, collapsed) of each row of ``docs``.

    ``runs`` is ordered by start, then period, counted in words from 0; ``collapsed`` has the words that no run holds
    after its first period, joined by one space. ``text`` defaults to the column of that name.
    """
    if exponent < 3 or min_length < 1:
        raise ValueError("runs need an exponent of 3 or more and a positive length")
    own = F.coalesce(text.cast("string"), F.lit("")) if text is not None else text_or_empty()
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), own.alias("text")).mapInArrow(
        partial(_scan, min_length=min_length, exponent=exponent),
        f"key {kind}, n_words long, runs array<{RUN}>, collapsed string").withColumnRenamed("key", key)


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; the first of equal ones; null without runs."""
    better = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(better(best, run), run).otherwise(best))


def run_lines(runs: Column) -> Column:
    """Every run as one line ``start,length,period``."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
