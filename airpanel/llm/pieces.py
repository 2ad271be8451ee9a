"""SentencePiece encoding by suffix-array matching, and decoding; for merge (BPE) models with byte fallback.

A batch of texts is cut at spaces; its distinct words, each with the space mark before it, are one concatenated text. A suffix
array of that text, sorted as deep as the longest piece, is searched for the range of every piece at once, by
bisection; the ranges are all occurrences, that is, the edges of the lattice. Sorted by their end, the edges
are relaxed in one sweep: an edge is taken if its piece can follow the piece that ends where it begins.

For merge models that condition makes the result exact. A sequence of pieces is what the merges produce if and only if they
produce each neighbouring pair, so the encoding of a prefix determines that of the next. A pair is produced if no merge
across its seam comes before the merges that built its two sides; the sides' merge trees decide this, and
answers are kept per worker. Where two neighbouring characters stand together in no piece, the sweep starts anew.

The model file is read by the driver; tasks get arrays whose size is that of the vocabulary.

Defined results: null or empty text has no ids and decodes to an empty text; characters outside the vocabulary become their
UTF-8 bytes; the space mark itself (U+2581), where a text contains it, decodes to a space, as the model
defines; any other text decodes to itself; byte ids that form no valid UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airpanel.llm.batches import by_value, flat, list_array, slices, text_or_empty, unused

by_value(__name__)

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 2 << 20   # larger ones have fewer distinct words per text, but cost memory and gain no time
_START = -2     # what precedes the first piece
_OTHER = -3     # a character that is in no piece


class Vocabulary:
    """Pieces of a model with their merge trees."""

    def __init__(self, pieces: list[str], ranks: list[float], byte_ids: list[int], size: int):
        """``pieces`` and ``ranks`` of ordinary pieces by id ("" for others); ``byte_ids`` of the 256 bytes."""
        self.size, self.byte_ids = size, byte_ids
        self.text = list(pieces)
        self.rank = dict((p, r) for p, r in zip(pieces, ranks) if p)
        self.id = {p: i for i, p in enumerate(pieces) if p}
        for c in sorted({c for p in self.id for c in p} - set(self.id)):  # parts of pieces, but no pieces themselves
            self.id[c] = len(self.text)
            self.text.append(c)
        self.tree: list[tuple[int, int, float] | None] = [self._grown(p) if len(p) > 1 else None for p in self.text]
        self.usable = [i for i, p in enumerate(self.text) if len(p) == 1 or self.tree[i] is not None]
        self.pair_known: dict[int, bool] = {}
        self._lookup_arrays()

    def _grown(self, piece: str) -> tuple[int, int, float] | None:
        """(left, right, time) of the last merge that builds a piece from its characters; None if the merges do not."""
        parts, times = list(piece), [-math.inf] * len(piece)
        while len(parts) > 1:
            best, at = math.inf, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1], math.inf)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return None
            time = max(best, times[at], times[at + 1])
            if len(parts) == 2:
                return self.id[parts[0]], self.id[parts[1]], time
            parts[at:at + 2], times[at:at + 2] = [parts[at] + parts[at + 1]], [time]
        return None

    def _spine(self, piece: int, side: int) -> list[tuple[str, float]]:
        """Parts of a piece along one border, each with the time at which it is merged into the next larger one."""
        out, until = [(self.text[piece], math.inf)], math.inf
        while self.tree[piece] is not None:
            until, piece = self.tree[piece][2], self.tree[piece][side]
            out.append((self.text[piece], until))
        return out

    def follows(self, first: int, second: int) -> bool:
        """Whether the merges leave these two pieces side by side."""
        for left, left_until in self._spine(first, 1):
            for right, right_until in self._spine(second, 0):
                rank = self.rank.get(left + right)
                # At equal ranks the leftmost merge comes first: that in the left piece, then the one across the seam.
                if rank is not None and rank < left_until and rank <= right_until:
                    return False
        return True

    def _lookup_arrays(self) -> None:
        chars = sorted({c for i in self.usable for c in self.text[i]})
        self.chars = np.array([ord(c) for c in chars], np.uint32)       # code points by dense code - 1
        code = {c: k + 1 for k, c in enumerate(chars)}
        self.order = np.array(sorted(self.usable, key=lambda i: self.text[i]), np.int64)
        self.length = np.array([len(self.text[i]) for i in self.order], np.int64)
        self.longest = int(self.length.max(initial=1))
        self.spelled = np.zeros((len(self.order), self.longest), np.int64)
        for row, i in enumerate(self.order):
            self.spelled[row, :self.length[row]] = [code[c] for c in self.text[i]]
        self.width = np.zeros(len(self.text), np.int64)
        self.width[self.order] = self.length
        self.base = len(chars) + 1
        self.joined = np.array(sorted({code[a] * self.base + code[b] for i in self.usable
                                       for a, b in zip(self.text[i], self.text[i][1:])}), np.int64)
        shown = [self.text[i].replace(MARK, " ").encode() if i < len(self.text) and self.text[i] else b""
                 for i in range(len(self.text))]
        for byte, i in enumerate(self.byte_ids):
            shown[i] = bytes([byte])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_at = np.concatenate([[0], np.cumsum([len(s) for s in shown])]).astype(np.int64)

    def following(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys, back = np.unique(first * len(self.text) + second, return_inverse=True)
        known, answers = self.pair_known, np.empty(len(keys), bool)
        for n, key in enumerate(keys.tolist()):
            answer = known.get(key)
            if answer is None:
                answer = known[key] = self.follows(*divmod(key, len(self.text)))
            answers[n] = answer
        if len(known) > 4_000_000:  # a bound for the memory of long-lived workers; answers are found again
            known.clear()
        return answers[back]


def load(model_file: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
    pieces = ["" if s else model.id_to_piece(i) for i, s in enumerate(special)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if model.normalize(" Aﬁ　 b ") != f"{MARK}{MARK}Aﬁ　{MARK}b{MARK}":
        raise ValueError("only models without normalisation, with a leading space mark, are supported")
    if any(not model.is_byte(i) for i in byte_ids) or any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("only models with byte fallback and with space marks at the front of pieces are supported")
    return Vocabulary(pieces, [-model.get_score(i) for i in range(n)], byte_ids, n)


def suffix_array(codes: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Suffixes of ``codes`` (each below 2**bits) in the order of their first ``depth`` codes at least."""
    n = len(codes)
    pack = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(pack):
        key <<= bits
        key[:max(n - k, 0)] |= codes[k:]
    width = pack
    while width < depth:
        _, rank = np.unique(key, return_inverse=True)
        key = (rank.astype(np.int64) + 1) << 31
        key[:max(n - width, 0)] |= rank[width:] + 1
        width *= 2
    return np.argsort(key, kind="stable")


def occurrences(codes: np.ndarray, suffixes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """First and last place (exclusive) in the suffix array of every piece in ``vocabulary.order``."""
    n = len(suffixes)
    low, high = np.zeros(len(vocabulary.order), np.int64), np.full(len(vocabulary.order), n, np.int64)
    padded = np.concatenate([codes, np.zeros(vocabulary.longest + 1, np.int64)])

    def bisected(rows: np.ndarray, depth: int, wanted: np.ndarray, after: bool) -> np.ndarray:
        a, b = low[rows].copy(), high[rows].copy()
        while True:
            going = a < b
            if not going.any():
                return a
            mid = (a + b) >> 1
            found = padded[suffixes[np.minimum(mid, n - 1)] + depth]
            right = going & ((found <= wanted) if after else (found < wanted))
            a, b = np.where(right, mid + 1, a), np.where(going & ~right, mid, b)

    for depth in range(vocabulary.longest):
        rows = np.flatnonzero((vocabulary.length > depth) & (low < high))
        wanted = vocabulary.spelled[rows, depth]
        first, last = bisected(rows, depth, wanted, False), bisected(rows, depth, wanted, True)
        low[rows], high[rows] = first, last
    return low, high


def _repeated(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges start, start + 1, ... of each count."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def encode_units(units: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units, one after the other, and the offsets of the units."""
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    unit_at = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)
    n = len(points)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(units) + 1, np.int64)
    place = np.minimum(np.searchsorted(vocabulary.chars, points), len(vocabulary.chars) - 1)
    codes = np.where(vocabulary.chars[place] == points, place + 1, 0)

    # Where the sweep starts anew: at units, and between characters that no piece joins.
    pair = codes[:-1] * vocabulary.base + codes[1:]
    at = np.minimum(np.searchsorted(vocabulary.joined, pair), max(len(vocabulary.joined) - 1, 0))
    fresh = np.ones(n, bool)
    if len(vocabulary.joined):
        fresh[1:] = vocabulary.joined[at] != pair
    fresh[unit_at[:-1][np.diff(unit_at) > 0]] = True
    begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))

    suffixes = suffix_array(codes, vocabulary.longest, int(vocabulary.base).bit_length())
    low, high = occurrences(codes, suffixes, vocabulary)
    counts = np.maximum(high - low, 0)
    starts = suffixes[_repeated(low, counts)]
    piece, length = np.repeat(vocabulary.order, counts), np.repeat(vocabulary.length, counts)
    ends = starts + length - 1
    inside = begin[np.minimum(ends, n - 1)] <= starts
    starts, piece, ends = starts[inside], piece[inside], ends[inside]
    other = np.flatnonzero(codes == 0)  # stand alone: no piece joins them with anything
    last = np.full(n, -1, np.int64)
    last[other] = _OTHER

    depth = ends - begin[ends]
    order = np.argsort(depth, kind="stable")
    starts, piece, ends, depth = starts[order], piece[order], ends[order], depth[order]
    levels = np.flatnonzero(np.diff(depth, prepend=-1))
    for a, b in zip(levels, np.append(levels[1:], len(depth))):
        s, p, e = starts[a:b], piece[a:b], ends[a:b]
        before = np.where(s > begin[e], last[np.maximum(s, 1) - 1], _START)
        taken = before == _START
        linked = before >= 0
        taken[linked] = vocabulary.following(before[linked], p[linked])
        last[e[taken]] = p[taken]

    # Back from the ends of the sweeps.
    chosen = np.zeros(n, bool)
    at = np.flatnonzero(np.append(fresh[1:], True))
    width = np.where(last >= 0, vocabulary.width[np.maximum(last, 0)], 1)
    while len(at):
        chosen[at] = True
        first = begin[at]
        at = at - width[at]
        at = at[at >= first]
    at = np.flatnonzero(chosen)
    ids = last[at]
    if (ids == -1).any():
        raise ValueError("a text that the lattice of pieces does not reach")
    # Characters without an id of their own become bytes.
    raw = (ids == _OTHER) | (ids >= vocabulary.size)
    amount = np.ones(len(ids), np.int64)
    if raw.any():
        spelled = [chr(c).encode("utf-8", "replace") for c in points[at[raw]]]
        amount[raw] = [len(s) for s in spelled]
        out = np.repeat(ids, amount)
        out[np.repeat(raw, amount)] = np.array(vocabulary.byte_ids)[np.frombuffer(b"".join(spelled), np.uint8)]
        ids = out
    per_char = np.zeros(n + 1, np.int64)
    per_char[at + 1] = amount
    return ids.astype(np.int32), np.cumsum(per_char)[unit_at]


_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def encode_batch(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (strings without nulls), one after the other, and the offsets of the texts."""
    texts = texts.cast(pa.large_string())
    odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK)),
                 pc.or_(pc.starts_with(texts, " "), pc.equal(pc.binary_length(texts), 0)))
    odd = np.asarray(odd)
    words = pc.split_pattern(texts, " ")
    if odd.any():  # several spaces in a row belong to one unit
        plain = [[w[1:] if w.startswith(MARK) and MARK not in w[1:] else w for w in _UNIT.findall(MARK + t.replace(" ", MARK))] if t else []
                 for t in texts.filter(pa.array(odd)).to_pylist()]
        whole = words.to_pylist()
        for i, w in zip(np.flatnonzero(odd).tolist(), plain):
            whole[i] = w
        words = pa.array(whole, pa.large_list(pa.large_string()))
    counts = np.asarray(pc.list_value_length(words)).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    units = [w if w.startswith(MARK) else MARK + w for w in coded.dictionary.to_pylist()]
    ids, at = encode_units(units, vocabulary)
    unit = np.asarray(coded.indices).astype(np.int64)
    amount = np.diff(at)[unit]
    whole = ids[_repeated(at[:-1][unit], amount)]
    ends = np.concatenate([[0], np.cumsum(amount)])
    return whole, ends[np.concatenate([[0], np.cumsum(counts)])]


def decode_batch(ids: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all id lists, one after the other, and the offsets of the texts."""
    starts = vocabulary.shown_at[ids]
    amount = vocabulary.shown_at[ids + 1] - starts
    body = vocabulary.shown[_repeated(starts, amount)]
    at = np.concatenate([[0], np.cumsum(amount)])[offsets]
    first = at[:-1][np.diff(at) > 0]
    lead = first[body[first] == 32]  # the space that encoding put in front
    keep = np.ones(len(body), bool)
    keep[lead] = False
    return body[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, source: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, source, SLICE):
        ids, offsets = encode_batch(batch.column(source), vocabulary)
        kept = [c for c in batch.schema.names if c != source]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [list_array(pa.array(ids), offsets)], names=[*kept, name])


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, source: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(source)
        ids = np.asarray(column.flatten()).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(column)))]).astype(np.int64)
        body, at = decode_batch(ids, offsets, vocabulary)
        raw = body.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        kept = [c for c in batch.schema.names if c != source]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(texts, pa.string())], names=[*kept, name])


def _checked(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        ids, offsets = encode_batch(batch.column("text"), vocabulary)
        body, at = decode_batch(ids.astype(np.int64), offsets, vocabulary)
        original, places = flat(batch.column("text"))
        raw, ids_raw, own = body.tobytes(), ids.astype("<i4").tobytes(), original.tobytes()
        rows = zip(offsets[:-1].tolist(), offsets[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), places[:-1].tolist(), places[1:].tolist())
        digests, same = zip(*[(hashlib.sha256(ids_raw[4 * a:4 * b]).hexdigest(), raw[c:d] == own[e:f]) for a, b, c, d, e, f in rows])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(digests), pa.array(same)],
            names=["doc_id", "n_tokens", "ids_sha256", "round_trip"])


def encode(docs: DataFrame, text: str = "text", to: str = "ids", model_file: str = MODEL, drop_text: bool = False) -> DataFrame:
    """``docs`` with the ids of a text column, as array<int>."""
    kept = [c for c in docs.columns if c != to and not (drop_text and c == text)]
    schema = docs.select(*kept).schema.add(to, T.ArrayType(T.IntegerType()))
    (source,) = unused(docs, "own_text")
    return docs.select(*kept, text_or_empty(text).alias(source)).mapInArrow(
        partial(_encoded, vocabulary=load(model_file), source=source, name=to), schema)


def decode(docs: DataFrame, ids: str = "ids", to: str = "text", model_file: str = MODEL) -> DataFrame:
    """``docs`` with the text of an id column."""
    kept = [c for c in docs.columns if c != to]
    schema = docs.select(*kept).schema.add(to, T.StringType())
    (source,) = unused(docs, "own_ids")
    some = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))
    return docs.select(*kept, some.alias(source)).mapInArrow(
        partial(_decoded, vocabulary=load(model_file), source=source, name=to), schema)


def encoding_report(docs: DataFrame, model_file: str = MODEL) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the ids as little-endian int32) and round_trip (it decodes to itself)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        partial(_checked, vocabulary=load(model_file)), "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean")
