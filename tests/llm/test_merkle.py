from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from airpanel.llm import catalog
from airpanel.llm.merkle import fold, manifest, proof_text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(hashes, arity):
    """The last node, and per leaf the (before, after) of every level."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for leaf, i in enumerate(at):
            first = i - i % arity
            paths[leaf].append(("".join(hashes[first:i]), "".join(hashes[i + 1:first + arity])))
        hashes = [sha("".join(hashes[i:i + arity])) for i in range(0, len(hashes), arity)]
        at = [i // arity for i in at]
    return hashes[0], paths


def expected(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops, below = [], {}
    for lang in langs:
        trees[lang].sort(key=lambda x: x[:3])
        top, paths = climb([x[2] for x in trees[lang]], arity)
        tops.append(top)
        below[lang] = paths
    if not tops:
        return []
    root, upper = climb(tops, arity)
    out = []
    for k, lang in enumerate(langs):
        for (_, _, leaf, row), path in zip(trees[lang], below[lang]):
            path = path + upper[k]
            start = leaf
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                start = leaf_of((*row[:3], row[3] + 1, row[4]))
            folded = start
            for before, after in path:
                folded = sha(before + folded + after)
            out.append((row[0], leaf, tops[k], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=repr)


def table(spark, path, rows):
    full = [(*r, "t", 1, "h") for r in rows]
    spark.createDataFrame(full, "doc_id long, source string, lang string, n_chars long, text string, tree string, idx int, hash string"
                          ).repartition(3).write.parquet(f"{path}/documents.parquet")


def sample(n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["s", None, "é"]), rng.choice(["en", "en", "en", "de", None, "", "ß"]),
             rng.choice([None, 5, i]), rng.choice(["", None, f"text {i}", "ü" * i])) for i in range(n)]
    if n > 5:
        rows += [rows[2], rows[2], (3, "other", rows[3][2], 1, "x"), (None, "s", "en", 2, "no id"), (None, None, None, None, None),
                 (n, "s", "only", 1, "y" * 300_000)]
    return rows


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 129])
def test_query_equals_brute_force(spark, tmp_path, n):
    table(spark, tmp_path, sample(n))
    out = catalog.QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == expected(sample(n))
    if n > 100:
        assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("arity", [3, 5])
def test_wider_trees(spark, tmp_path, arity):
    table(spark, tmp_path, sample(77))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    made = manifest(spark.read.parquet(f"{tmp_path}/documents.parquet"), fields, "lang", "doc_id", arity)
    got = made.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof"),
                      fold(F.col("leaf"), F.col("path")).alias("folded"))
    wanted = [r[:5] + (r[3],) for r in expected(sample(77), arity)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(wanted, key=repr)
    with pytest.raises(ValueError):
        manifest(made, [], "lang", "doc_id", arity=1)


def test_a_tree_over_many_groups_and_one_large_one(spark):
    rows = [(i, "s", f"l{i}" if i % 3 else "hot", i, str(i)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    fields = [F.col(c) for c in docs.columns[:4]] + [F.col("text")]
    made = manifest(docs, fields, "lang", "doc_id")
    got = sorted((r.doc_id, r.leaf, r.subroot, r.root) for r in made.collect())
    assert got == sorted(r[:4] for r in expected(rows))
