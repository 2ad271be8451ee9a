from __future__ import annotations

import random
import re
from collections import defaultdict
from math import comb

import numpy as np
import pytest

from airpanel.llm.components import components
from airpanel.llm.near import COORDINATES, MISS, drop_near_copies, near_duplicates, shingle_sets, threshold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")


def shingles(text, words):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def expected(rows, words, num, den):
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and den * both >= num * (len(sets[a]) + len(sets[b]) - both) and both:
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for x in range(len(rows)):
        groups[find(x)].append(rows[x][0])
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [g for g in groups[find(x)] if g is not None]
        label = min(ids) if ids else None
        out.append((i, len(sets[x]), label, i == label))
    return sorted(out, key=repr)


def group(rng, start, n, length, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            at = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[at] = f"e{rng.randrange(10 ** 6)}"
            elif kind == 1 and len(w) > 5:
                del w[at]
            else:
                w.insert(at, f"i{rng.randrange(10 ** 6)}")
        out.append((start + k, " ".join(w)))
    return out


def sample():
    rng = random.Random(5)
    rows = group(rng, 1000, 120, 130, 9) + group(rng, 2000, 40, 400, 40) + group(rng, 3000, 25, 12, 3)
    for k in range(60):
        rows += group(rng, 4000 + 10 * k, 3, rng.randrange(20, 300), 8)
    shared = " ".join(f"s{i}" for i in range(60))
    rows += [(6000 + i, shared + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(5, 60)))) for i in range(60)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "one two"), (7, "ONE\ttwo"), (8, "É x"), (9, "é x"),
             (None, "null id alone in its group of words"), (None, rows[0][1]), (rows[5][0], rows[5][1]), (10, "a b c d"), (11, "a b c d a b c d")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,num", [(3, 85), (5, 80)])
def test_components_equal_brute_force(documents, rows, words, num):
    assert rows(near_duplicates(documents(sample()), words, num, 100)) == expected(sample(), words, num, 100)


def test_dropping_keeps_one_row_of_each_group(documents):
    docs = documents(sample())
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    want = [i for i, n, _, k in {r: None for r in expected(sample(), 5, 80, 100)} if k]
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, want))


def test_dropping_goes_by_links_and_not_by_ids(documents):
    rng = random.Random(8)
    text = lambda n=60: " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(n))
    alone, pair, mixed = [text() for _ in range(6)], text(100), text(100)
    stay = [(None, t) for t in alone[:4]] + [(5, t) for t in alone[4:]] + [(None, " "), (None, " "), (None, None), (5, "")]
    groups = [[(None, pair), (None, pair + " end")], [(None, mixed), (6, mixed + " end"), (5, mixed + " stop")]]
    kept = [(r.doc_id, r.text) for r in drop_near_copies(documents(stay + sum(groups, []))).collect()]
    assert [len(set(g) & set(kept)) for g in groups] == [1, 1] and groups[1][2] in kept
    assert sorted(map(repr, (r for r in kept if r not in sum(groups, [])))) == sorted(map(repr, stay))


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == [] and drop_near_copies(documents([])).collect() == []


def test_sets_have_as_many_shingles_as_words_say():
    texts = [t or "" for _, t in sample()[:80]] + ["", "A", "a  B\tc\x0bd", "naïve Ünï 日本 語"]
    raw = [t.encode() for t in texts]
    got = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]), 3)
    by_hash = {}
    for t, s in zip(texts, got):
        assert len(s) == len(shingles(t, 3))
        assert by_hash.setdefault(s.tobytes(), shingles(t, 3)) == shingles(t, 3)


def test_threshold_is_the_largest_that_misses_rarely():
    for similarity in (0.8, 0.85, 0.95):
        t = threshold(similarity)
        tail = lambda n: sum(comb(COORDINATES, k) * similarity ** k * (1 - similarity) ** (COORDINATES - k) for k in range(n))
        assert tail(t) <= MISS < tail(t + 1)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 200), (301, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(31)) and all(found[x] == 100 for x in range(100, 160))
    assert found[200] == 200 and found[301] == 300 and len(found) == 31 + 60 + 1 + 2
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
