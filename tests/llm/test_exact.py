from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from airpanel.llm.exact import CHUNK_BYTES, cuts, drop_exact_copies, exact_groups, normalised

random.seed(1)
LONG = " ".join(random.choice(["alpha", "beta", "gämma", "δ", "e"]) + str(random.random()) for _ in range(40_000))


def sample():
    return [
        (1, "a  b\tc"), (2, "a b c"), (3, "a b  c "), (4, None), (5, ""), (6, " "), (7, "\n\t"), (8, LONG), (9, LONG.replace(" ", "\n")),
        (10, LONG + "!"), (11, "x" * (3 * CHUNK_BYTES)), (12, "x" * (3 * CHUNK_BYTES)), (13, "x" * (3 * CHUNK_BYTES + 1)),
        (None, "only null"), (None, "a b c"), (2, "a b c"), (14, "a b c"), (15, "é"), (16, "é"),
    ]


def expected(rows):
    groups = defaultdict(list)
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (i, _), t in zip(rows, texts):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, texts):
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_equal_brute_force(documents, rows):
    assert rows(exact_groups(documents(sample()))) == expected(sample())


def test_shared_digests_are_told_apart_by_their_bytes(documents, rows):
    many = sample() + [(100 + i, f"text number {i} {LONG[i * 3000:i * 3000 + 9000]}") for i in range(40)]
    assert rows(exact_groups(documents(many), bits=3)) == expected(many)


def test_dropping_keeps_one_row_per_text_and_all_columns(documents):
    docs = documents(sample())
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    assert ids == [-1, 1, 3, 4, 6, 8, 10, 11, 13, 14, 15, 16]


def test_empty_table(documents):
    assert exact_groups(documents([])).collect() == [] and drop_exact_copies(documents([])).collect() == []


def test_cuts_follow_content_not_place():
    body = np.frombuffer(LONG.encode(), np.uint8)
    shifted = np.concatenate([np.frombuffer(b"some other beginning ", np.uint8), body])
    a = cuts(body, np.array([0, len(body)]))
    b = cuts(shifted, np.array([0, len(shifted)])) - 21
    assert len(a) > 100 and len(set(a.tolist()) & set(b.tolist())) > 0.95 * len(a)
    together = cuts(np.concatenate([body, body]), np.array([0, len(body), 2 * len(body)]))
    assert together.tolist() == a.tolist() + (a + len(body)).tolist()


def test_normalisation_stays_within_texts():
    body, at = normalised(np.frombuffer(b"a \t b  \n c ", np.uint8), np.array([0, 3, 7, 7, 11]))
    assert bytes(body) == b"a  b  c " and at.tolist() == [0, 2, 5, 5, 8]
