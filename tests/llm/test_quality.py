from __future__ import annotations

import random
import re
from collections import Counter

from airpanel.llm.quality import STOP_WORDS, quality

rng = random.Random(8)
CLEAN = " ".join(f"{rng.choice(['the', 'of', 'and', 'a'])} {''.join(rng.choice('abcdefgh') for _ in range(6))}" for _ in range(80))
TEXTS = [
    None, "", " \n\t", CLEAN, CLEAN.replace(" ", "\n"), "one two three", "a b c a b c d", "x x x x x", ("lorem ipsum dolor " * 60),
    CLEAN + " ### $$$" * 40, "the same line\n" * 40, "\n".join(["the of and line", "other line of the"] * 20 + [CLEAN]),
    "é日本 " * 60, " ".join(str(i) for i in range(20_000)), "word\r\n word\x0b\x0cword " * 30, "a b " * 55, "#*$%&|<>" * 20,
    *[" ".join(rng.choice("abcd") for _ in range(rng.randrange(120))) for _ in range(40)],
]


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + o for i, w in enumerate(windows) if counts[w] > 1 for o in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_stop_words": sum(w.lower() in STOP_WORDS for w in words),
        "n_repeat_words": len(covered), "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words)}


def test_counts_equal_brute_force(documents):
    docs = documents(list(enumerate(TEXTS)) + [(3, CLEAN), (None, CLEAN)])
    found = quality(docs).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        want = expected(CLEAN if r.doc_id is None else TEXTS[r.doc_id])
        assert {k: r[k] for k in want} == want, r
        assert not (r.base_failed and r.kept)


def test_verdicts(documents):
    kept = {r.doc_id: r.kept for r in quality(documents(list(enumerate(TEXTS)))).collect()}
    assert kept[3] and not any(kept[i] for i in (0, 1, 2, 5, 8, 9, 10, 16))


def test_plan_is_one_projection_without_python(documents):
    plan = quality(documents([(1, "a")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Aggregate" not in plan.replace("aggregate(", "")


def test_empty_table(documents):
    assert quality(documents([])).collect() == []
