from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from airpanel.llm.pieces import MODEL, decode, encode, encode_batch, encoding_report, load, occurrences, suffix_array

pytestmark = pytest.mark.skipif(not Path(MODEL).exists(), reason="the model file is absent")
rng = random.Random(6)
TEXTS = [
    "", "a", "a  b", " a", "a ", "   ", "hello world\n\nfoo", "日本語テスト", "é́x\t\tq", "a" * 70, "-" * 50, "=" * 77, "\n" * 9,
    " " * 33, "    x    y", "<s></s><0x0A>", "0123456789" * 5, "def f(x):\n        return x\n", "\U0001F600\U0001F600a", "ſtraße naïve Ω",
    *["".join(rng.choice("abcdefgh      \n-=_/.012ABCÉé日") for _ in range(rng.randrange(200))) for _ in range(200)],
    "word " * 20_000, "x" * 5_000,
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return load()


def test_ids_equal_those_of_the_library(library, vocabulary):
    texts = TEXTS + ["a▁b▁▁", "▁"]
    ids, at = encode_batch(pa.array(texts), vocabulary)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library.encode(texts)


def test_random_sequences_of_pieces(library, vocabulary):
    pieces = [p for p in vocabulary.text if p]
    texts = ["".join(rng.choice(pieces) for _ in range(40)).replace("▁", " ") for _ in range(300)]
    ids, at = encode_batch(pa.array(texts), vocabulary)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library.encode(texts)


def test_suffix_array_and_occurrences(vocabulary):
    codes = np.array([rng.randrange(1, 4) for _ in range(300)])
    order = suffix_array(codes, 16, 2)
    keys = [tuple(codes[i:i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(300))
    text = "▁the▁theme▁of▁the▁other"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    codes = np.searchsorted(vocabulary.chars, points) + 1
    order = suffix_array(codes, vocabulary.longest, int(vocabulary.base).bit_length())
    low, high = occurrences(codes, order, vocabulary)
    for row, piece in enumerate(vocabulary.order.tolist()):
        spelled = vocabulary.text[piece]
        want = [i for i in range(len(text)) if text.startswith(spelled, i)]
        assert sorted(order[low[row]:max(low[row], high[row])].tolist()) == want


def test_round_trip_through_spark_keeps_rows_and_columns(documents, library):
    docs = documents([(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (0, TEXTS[0]), (7, TEXTS[7])])
    encoded = encode(docs)
    assert encoded.columns == [*docs.columns, "ids"]
    rows = encoded.collect()
    assert len(rows) == len(TEXTS) + 3 and all(r.ids == library.encode(r.text or "") for r in rows)
    for r in decode(encoded, to="again").collect():
        assert r.again == (r.text or "")
    report = encoding_report(docs).collect()
    assert all(r.round_trip for r in report) and {r.doc_id: r.n_tokens for r in report}[1] == 1


def test_marks_and_stray_bytes(spark, documents, library):
    report = encoding_report(documents([(1, "a▁b")])).collect()
    assert [r.round_trip for r in report] == [False]
    ids = spark.createDataFrame([(1, [library.piece_to_id("<0xE6>"), 5]), (2, None), (3, [])], "k long, ids array<int>")
    assert {r.k: r.text for r in decode(ids).collect()} == {1: "�\x02", 2: "", 3: ""}


def test_empty_table(documents):
    assert encode(documents([])).collect() == [] and encoding_report(documents([])).collect() == []
