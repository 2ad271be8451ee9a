from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from airpanel.llm.mixing import mix_sources, mixed

rng = random.Random(3)


def sample(n=600):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(["w"] * rng.randrange(0, 60)), source))
    return rows + [(n, None, "s1"), (n + 1, "", None), (n + 2, "a b c", None), (n + 3, "", "empty"), (None, "x y", "s1"),
                   (5, "same id again", "s5"), (7, "t t", "s0"), (7, "t t", "s0"), (n + 4, "w " * 20_000, "s2")]


def expected_targets(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / weights for s in order}
        above = {s for s in order if s not in full and target[s] >= 2 * sizes[s]}
        if not above:
            return sizes, target
        full |= above


def test_targets_and_taken_words(documents):
    rows = sample()
    sizes, target = expected_targets(rows)
    found = mixed(documents(rows)).collect()
    assert len(found) == len(rows)
    taken, longest = Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
        longest[r.source] = max(longest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] + 1e-6


def test_reruns_and_layouts_agree(documents, rows):
    docs = documents(sample())
    assert rows(mixed(docs)) == rows(mixed(docs.repartition(7)))


def test_rows_are_emitted_as_often_as_the_mix_takes_them(documents):
    docs = documents(sample())
    want = Counter()
    for r in mixed(docs).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    emitted = mix_sources(docs)
    assert emitted.columns == docs.columns
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in emitted.collect())
    assert got == Counter({k: v for k, v in want.items() if v})


def test_empty_tables_and_texts_without_words(documents):
    assert mixed(documents([])).collect() == [] and mix_sources(documents([])).collect() == []
    rows = mixed(documents([(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target) for r in rows] == [(0, 0.0), (0, 0.0)]
