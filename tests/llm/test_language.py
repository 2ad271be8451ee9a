from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.llm.language import declared, fit, from_documents, from_pages, identify, languages_of, trigrams, visible

rng = random.Random(9)
PARTS = {"en": ["the", "ing", "tion", "er", "and"], "de": ["der", "sch", "ung", "keit", "ein"], "fr": ["le", "eau", "oux", "ment", "que"],
         "es": ["el", "ción", "ado", "mente", "los"]}


def text(lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, text(lang, 40), lang, f"src{i % 5}") for i, lang in enumerate(rng.choice(sorted(PARTS)) for _ in range(400))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def model(labelled):
    return fit(labelled)


def test_texts_outside_the_sample_get_their_language(spark, model):
    truth = {i: rng.choice(sorted(PARTS)) for i in range(200)}
    docs = spark.createDataFrame([(i, text(lang, 12), lang, "s") for i, lang in truth.items()], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in identify(from_documents(docs), model).collect()}
    assert sum(found[i].language == lang for i, lang in truth.items()) >= 196 and all(r.kept for r in found.values())


def test_evidence_beyond_the_text(spark, model):
    page = lambda body, lang=None: f"<html{f' lang={lang}' if lang else ''}><body>{body}</body></html>"
    rows = [(i, f"http://x.hote{i % 3}.fr/p", page(text("fr", 30), "fr")) for i in range(60)]
    rows += [(100 + i, "http://y.beispiel.de/p", page(text("de", 30), "de")) for i in range(60)]
    rows += [(1000, "http://y.beispiel.de/q", page("")), (1001, "http://x.hote1.fr/q", page("")), (1002, "http://new.beispiel.de/", page("")),
             (1003, "http://unknown.de/", page("")), (1004, "not a url", page("", "fr")), (1005, None, None), (1006, "http://z.fr/", page("", "xx")),
             (None, "http://y.beispiel.de/p", page(text("de", 30), "en")), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = identify(from_pages(pages), model).collect()
    assert len(found) == len(rows)
    best = {r.page_id: r.language for r in found}
    assert [best[i] for i in (1000, 1001, 1002, 1003, 1004)] == ["de", "fr", "de", "de", "fr"] and best[None] == "de"
    assert {r.text_language for r in found if r.page_id in (1000, 1005)} == {None}
    assert all(0.0 < r.posterior <= 1.0 for r in found)


def test_markup(spark):
    html = [("<!DOCTYPE html><HTML class=a LANG='fr-CA'><script>var t='</p>';x</script>A<!-- no --> &amp; <b>c</b>",), ("<p>plain",), ("<html lang>",)]
    rows = spark.createDataFrame(html, "html string").select(declared(F.col("html")).alias("d"), visible(F.col("html")).alias("v")).collect()
    assert [r.d for r in rows] == ["fr", None, None]
    assert rows[0].v.split() == ["A", "c"]


def test_empty_tables(spark, labelled, model):
    assert identify(from_documents(labelled.limit(0)), model).collect() == []
    assert fit(labelled.limit(0)).shape == model.shape


def test_languages_come_from_the_labels(spark, labelled):
    more = spark.createDataFrame([(1000 + i, "ja nein " * 9, "nl", "s") for i in range(20)] + [(2000, "x", "rare", "s"), (2001, "x", None, "s")],
                                 "doc_id long, text string, lang string, source string")
    docs = labelled.unionByName(more)
    names = languages_of(docs)
    assert names == ("de", "en", "es", "fr", "nl") and languages_of(docs.limit(0)) == ("und", "unk")
    found = {r.doc_id: r.language for r in identify(from_documents(more), fit(docs, names), names).collect()}
    assert all(found[1000 + i] == "nl" for i in range(20))
    one = languages_of(more)
    assert one == ("nl", "und") and identify(from_documents(more), fit(more, one), one).count() == 22


def posterior_by_hand(rows, logs, languages):
    """The fused posterior of each text by its definition, over plain rows with trigram log-likelihoods."""
    n, out = range(len(languages)), []
    soft = lambda s: [math.exp(x - max(s)) / sum(math.exp(y - max(s)) for y in s) for x in s]
    q = [[round(1000 * p) for p in soft(ls)] for ls, _ in logs]
    own = [q[k] if logs[k][1] > 0 else [0] * len(languages) for k in range(len(rows))]
    group = [r["declared"] if r["declared"] in languages else None if r["declared"] is None else "other" for r in rows]
    told = {}
    for k, g in enumerate(group):
        if g is not None and logs[k][1] > 0:
            for i in n:
                told[g, i] = told.get((g, i), 1000) + q[k][i]
    for k, r in enumerate(rows):
        alike = lambda *names: [j for j, o in enumerate(rows) if all(o[x] == r[x] for x in ("kind", *names))]
        whole = [sum(own[j][i] for j in alike()) - own[k][i] for i in n]
        prior = [(whole[i] + 1000) / (sum(whole) + 1000 * len(languages)) for i in n]
        for names in (("suffix",), ("suffix", "domain"), ("suffix", "domain", "host")):
            mine = [sum(own[j][i] for j in alike(*names)) - own[k][i] for i in n]
            prior = [(mine[i] + 10 * 1000 * prior[i]) / (sum(mine) + 10 * 1000) for i in n]
        kinds = [*languages, "other"]
        seen = lambda d, i: math.log(told.get((d, i), 1000) / sum(told.get((x, i), 1000) for x in kinds)) if d else 0.0
        out.append(soft([logs[k][0][i] + math.log(prior[i]) + seen(group[k], i) for i in n]))
    return out


def test_fused_posterior_equals_its_definition(spark, model):
    body = lambda lang, n: text(lang, n) if n else ""
    rows = [(i, f"http://h{i % 4}.d{i % 2}.{'fr' if i % 3 else 'de'}/x",
             f"<html{' lang=' + decl if decl else ''}>{body(lang, size)}</html>")
            for i, (lang, decl, size) in enumerate([(rng.choice(sorted(PARTS)), rng.choice([None, "de", "fr", "zz"]),
                                                     rng.choice([0, 1, 3, 20])) for _ in range(60)])]
    pages = from_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    plain = sorted((r.asDict() for r in pages.collect()), key=lambda r: r["page_id"])
    logs = []
    for r in plain:
        raw = np.frombuffer(r["text"].encode(), np.uint8)
        bucket, _ = trigrams(raw, np.array([0, len(raw)]))
        damping = 1 / (1 + len(bucket) / 200.0)
        logs.append(([float(line[bucket].astype(float).sum()) * damping for line in model], len(bucket)))
    wanted = posterior_by_hand(plain, logs, ("de", "en", "es", "fr"))
    found = {r.page_id: r for r in identify(pages, model).collect()}
    for r, p in zip(plain, wanted):
        got = found[r["page_id"]]
        assert got.posterior == pytest.approx(max(p), abs=2e-3)
        if sorted(p)[-1] - sorted(p)[-2] > 0.01:
            assert got.language == ("de", "en", "es", "fr")[int(np.argmax(p))]


def test_ties_long_texts_and_clashing_names(spark, model):
    docs = spark.createDataFrame([(1, text("en", 40_000), "en", "s", 1.0, "x"), (2, text("en", 40), "en", "s", 2.0, "y"), (2, None, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, l0 double, says string")
    found = sorted(identify(from_documents(docs), model).collect(), key=repr)
    assert len(found) == 3 and [r.language for r in found if r.text_language] == ["en", "en"]
    flat_model = np.zeros_like(model)
    tied = identify(from_documents(docs.select("doc_id", "text", "lang", "source")), flat_model).collect()
    assert len({r.text_language for r in tied} - {None}) == 1 and all(0 < r.posterior <= 1 for r in tied)
