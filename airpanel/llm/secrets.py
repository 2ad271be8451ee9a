"""Secrets in texts: fixed patterns, and strings that a primed compressor finds novel.

Base spans follow three patterns (``assign``, ``access``, ``hex``). The method adds ``novel`` spans: a long token with a
sensitive word close before it is measured by its marginal compressed size, that is, the zstandard bytes of its
surroundings with the token less those without it, both primed with a dictionary of identifiers. Words and identifiers
repeat the dictionary or the text around them and cost little; random strings cost nearly their entropy. The value of
``name=value`` is a token of its own, and other copies of a token do not count as its surroundings.

Defined results: null text counts as empty and has no spans; positions are code points, ends exclusive; equal rows
get equal results; a token that overlaps a base span is not reported again; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, flat, slices, text_or_empty

by_value(__name__)

# The base patterns.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this drops exactly the runs that are shorter
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

CONTEXT = re.compile(
    r"(?:password|passwd|pwd|secret|token|api.?key|access.?key|private.?key|credential|authorization|bearer|auth|signature)"
    r"""[A-Za-z0-9_\-]*["'\]]*\s*(?:is|are|:|=|=>|->|,)?\s*["'(\[<]*$""", re.I | re.A)
CONTEXT_CHARS = 64       # how far before a token a sensitive word may begin
AROUND_CHARS = 400       # text on each side of a token that may explain it
NOVEL_CHARS = 16         # shortest token that is measured
BITS_PER_CHAR = 4.0      # marginal bits per character from which a token is novel
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % NOVEL_CHARS)
_PART = re.compile(r"[A-Za-z0-9+/_-]+(?:=+(?![A-Za-z0-9+/_=-]))?")  # between the '=' of a token, with the padding at its end

# Identifiers that code and prose about code are made of.
IDENTIFIERS = (
    "access account address admin algorithm allow application argument array async attribute authorization await base64 "
    "bearer boolean bucket buffer builder callback certificate channel character class client cluster column command "
    "component config configuration connection const constructor container content context controller cookie count create "
    "credential database dataset debug default delete deployment description destination directory document domain "
    "element email enable encode endpoint engine entity environment error event example exception execute export "
    "extension factory false feature field filename filter float folder format function generate global group handler "
    "header height hostname identifier image implement import index initialize input instance integer interface internal "
    "iterator javascript kernel language length library listener localhost location logger machine manager mapping memory "
    "message metadata method middleware migration model module monitor namespace network notification number object "
    "offset operation operator option output package parameter parent parse partition password payload permission pipeline "
    "placeholder platform plugin policy position prefix previous primary private process processor production profile "
    "project property protected protocol provider public python query queue random readonly receive record reference "
    "register release remote render replace repository request require resource response result return rotation runtime "
    "sandbox schedule schema scope script search secret section security select sequence serialize server service session "
    "setting signature simple snapshot source staging standard state static status storage stream string struct "
    "subscription success suffix super switch symbol system table target template terminal test thread throttle timeout "
    "timestamp token transaction transform trigger tuple undefined unique update upload username validate value variable "
    "vector version virtual visible volume warning websocket window workflow workspace wrapper your_api_key_here "
    "changeme 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
)


class Novelty:
    """Marginal compressed bytes of a string within its surroundings."""

    def __init__(self) -> None:
        words = IDENTIFIERS.split()
        primed = " ".join(words + [w.capitalize() for w in words] + [w.upper() for w in words]).encode()
        primed = zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(
            level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def bytes(self, before: str, token: str, after: str) -> int:
        without = (before + after).encode("utf-8", "surrogatepass")
        # At the end of the same surroundings, so that only the token itself differs.
        return len(self._compressor.compress(without + token.encode())) - len(self._compressor.compress(without))


def base_spans(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns; a pattern known to be absent may be left out."""
    found = []
    if assign:
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if access:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if hexes:
        found += [(2, *m.span()) for m in HEX.finditer(text)]
    return found


def _measured(text: str, start: int, end: int, base: list[tuple[int, int, int]], novelty: Novelty) -> bool:
    """Whether a string in sensitive context, apart from base spans, is novel."""
    if end - start < NOVEL_CHARS or not CONTEXT.search(text, max(0, start - CONTEXT_CHARS), start):
        return False
    if any(a < end and start < b for _, a, b in base):
        return False
    token = text[start:end]
    # Copies explain nothing; wider by one copy, so that none is cut at the border.
    copy, wide = token.rstrip("="), AROUND_CHARS + len(token)
    before = text[max(0, start - wide):start].replace(copy, "")[-AROUND_CHARS:]
    after = text[end:end + wide].replace(copy, "")[:AROUND_CHARS]
    return novelty.bytes(before, token, after) * 8 >= BITS_PER_CHAR * len(token)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    found = []
    for m in _TOKEN.finditer(text):
        # Values of name=value without blanks; the whole token if none is novel.
        parts = [p.span() for p in _PART.finditer(text, *m.span())]
        novel = [p for p in parts if _measured(text, *p, base, novelty)]
        if not novel and parts != [m.span()] and _measured(text, *m.span(), base, novelty):
            novel = [m.span()]
        found += [(3, *p) for p in novel]
    return found


def rendered(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0])))


def _members(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars.encode(), np.uint8)] = True
    return table


_HEX_BYTES = _members("0123456789abcdef")
_TOKEN_BYTES = _members("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")


def _rows_with_runs(body: np.ndarray, offsets: np.ndarray, member: np.ndarray, shortest: int) -> np.ndarray:
    """Which texts may hold a run of these bytes; a run over a text border only adds a text to look at."""
    edges = np.flatnonzero(np.diff(member[body], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    hit = np.zeros(len(offsets) - 1, bool)
    for a, b in zip(starts[long], ends[long]):
        first, last = np.searchsorted(offsets, [a, b - 1], side="right") - 1
        hit[first:last + 1] = True
    return hit


def _rows_with(haystack: bytes, needles: tuple[bytes, ...], offsets: np.ndarray) -> np.ndarray:
    hit = np.zeros(len(offsets) - 1, bool)
    for needle in needles:
        at = haystack.find(needle)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            hit[row] = True
            at = haystack.find(needle, max(at + 1, int(offsets[row + 1])))
    return hit


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    novelty = Novelty()
    for batch in slices(batches, "text"):
        body, offsets = flat(batch.column("text"))
        raw = body.tobytes()
        assign = _rows_with(raw.lower(), ASSIGN_WORDS, offsets)  # lowers A-Z only
        access = _rows_with(raw, (b"AKIA",), offsets)
        hexes = _rows_with_runs(body, offsets, _HEX_BYTES, 24)
        tokens = _rows_with_runs(body, offsets, _TOKEN_BYTES, NOVEL_CHARS)
        rows = []
        for i in range(batch.num_rows):
            spans: list[tuple[int, int, int]] = []
            added: list[tuple[int, int, int]] = []
            if assign[i] or access[i] or hexes[i] or tokens[i]:
                text = raw[offsets[i]:offsets[i + 1]].decode("utf-8", "replace")
                spans = base_spans(text, assign[i], access[i], hexes[i])
                added = novel_spans(text, spans, novelty) if tokens[i] else []
            counts = [sum(s[0] == k for s in spans) for k in range(3)]
            digest = hashlib.sha256(rendered(spans).encode()).hexdigest()
            rows.append((*counts, len(added), digest, rendered(spans + added)))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]],
             pa.array(columns[4], pa.string()), pa.array(columns[5], pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
