"""Language identification by fusing evidence in Bayes' rule.

* Text: log-likelihoods of byte trigrams per language, fitted on a bounded sample of labelled documents and damped, since
  neighbouring trigrams are not independent: a text of n trigrams counts as n / (1 + n / ``FULL_TRIGRAMS``).
* Markup: the declared language of a page, as likely as declarations are for pages of each language over all pages.
* Address: a prior per host, smoothed to that of its registered domain, this to that of the address suffix, and this to
  the prior of all rows. The counts are grouped sums of the text evidence of all rows, in thousandths so that they
  are exact in any order; a row's own share is left out of its prior.

Documents have no address; their ``source`` takes the place of the host. Texts and pages are read once; what goes on is
a narrow row of numbers.

Bounds: ``PER_LANGUAGE`` sample documents, ``BUCKETS`` trigram buckets, and the given languages.

Defined results: null or empty texts and pages are judged by the other evidence, or by the prior alone; a missing or
malformed url gives the empty host; a declaration of another language counts as ``other``; repeated rows get
equal results; ``kept`` tells whether the best language reaches ``LEAST_POSTERIOR``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, flat, owner, slices, stored, text_or_empty
from airpanel.llm.sampling import labelled_ids

by_value(__name__)

LANGUAGES = ("de", "en", "es", "fr")
PER_LANGUAGE = 2_000
LEAST_LABELLED = 20      # rows that a label needs to be a language of the model
BUCKETS = 1 << 15
FULL_TRIGRAMS = 200.0
SMOOTHING = 10.0         # rows that the next wider prior counts as
LEAST_POSTERIOR = 0.5
_UNIT = 1000             # soft counts are whole thousandths


def trigrams(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram that is not white space alone, A-Z lowered, and the text it belongs to."""
    if len(body) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lower = np.where((body >= 65) & (body <= 90), body + np.uint8(32), body).astype(np.uint32)
    mixed = (lower[:-2] * np.uint32(0x9E3779B1)) ^ (lower[1:-1] * np.uint32(0x85EBCA77)) ^ (lower[2:] * np.uint32(0xC2B2AE3D))
    row = owner(offsets)
    ink = body > 32
    whole = (row[:-2] == row[2:]) & (ink[:-2] | ink[1:-1] | ink[2:])
    return ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1))[whole].astype(np.int64), row[:-2][whole]


def _counted(batches: Iterator[pa.RecordBatch], languages: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(languages) * BUCKETS, np.int64)
    code = {name: i for i, name in enumerate(languages)}
    for batch in slices(batches, "text"):
        bucket, row = trigrams(*flat(batch.column("text")))
        lang = np.array([code[x] for x in batch.column("lang").to_pylist()], np.int64)
        counts += np.bincount(lang[row] * BUCKETS + bucket, minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["place", "n"])


def languages_of(docs: DataFrame, least: int = LEAST_LABELLED) -> tuple[str, ...]:
    """The labels of ``docs`` that ``least`` rows or more have, in order; at least two names, "und" filling up."""
    counts = docs.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    found = sorted(r.lang for r in counts.where(F.col("lang").isNotNull() & (F.col("n") >= least)).collect())
    return tuple(found + ["und", "unk"][:max(0, 2 - len(found))])


def fit(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, per_language: int = PER_LANGUAGE) -> np.ndarray:
    """Log-probabilities of the trigram buckets, one row per language."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    sample = F.broadcast(labelled_ids(ids, "lang", languages, per_language))  # at most this many per language
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        text_or_empty().alias("text")).join(sample, ["doc_id", "lang"]).select("text", "lang")
    found = (texts.mapInArrow(partial(_counted, languages=languages), "place long, n long")
             .groupBy("place").agg(F.sum("n").alias("n")).toArrow())  # at most languages * buckets numbers
    counts = np.full(len(languages) * BUCKETS, 0.5)
    counts[np.asarray(found["place"])] += np.asarray(found["n"])
    counts = counts.reshape(len(languages), BUCKETS)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _likelihoods(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        bucket, row = trigrams(*flat(batch.column("text")))
        n = np.bincount(row, minlength=batch.num_rows)
        damping = 1 / (1 + n / FULL_TRIGRAMS)
        columns = [pa.array(np.bincount(row, weights=line[bucket], minlength=batch.num_rows) * damping) for line in model]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(n)] + columns, names=[*kept, "trigrams", *[f"l{i}" for i in range(len(model))]])


def visible(html: Column) -> Column:
    """Text of a page: without scripts, styles, comments, tags and entities."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?[A-Za-z0-9]{1,8};", " ")


def declared(html: Column) -> Column:
    """Primary subtag of the language that the markup declares, or null."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]{2,3})\b""", 1))
    return F.when(found != "", found)


def from_pages(pages: DataFrame) -> DataFrame:
    """Rows to judge: kind, doc_id, page_id, text, declared, host, domain, suffix."""
    html = text_or_empty("html")
    host = F.lower(F.regexp_extract(text_or_empty("url"), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    labels = F.split("host", r"\.")
    return (pages.select(F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"),
                         F.col("page_id").cast("long").alias("page_id"), visible(html).alias("text"),
                         declared(html).alias("declared"), host.alias("host"))
            .withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."))
            .withColumn("suffix", F.element_at(labels, -1)))


def from_documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.lit(None).cast("long").alias("page_id"), text_or_empty().alias("text"),
                       F.lit(None).cast("string").alias("declared"), text_or_empty("source").alias("host"),
                       F.lit("").alias("domain"), F.lit("").alias("suffix"))


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    total = reduce(lambda a, b: a + b, [F.exp(s - top) for s in scores])
    return [F.exp(s - top) / total for s in scores]


def identify(rows: DataFrame, model: np.ndarray, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``rows`` as from ``from_pages`` or ``from_documents``, judged: text_language, language, posterior, kept."""
    n = range(len(languages))
    fields = ", ".join(f"l{i} double" for i in n)
    soft = [F.round(_UNIT * p).cast("long").alias(f"q{i}") for i, p in enumerate(_softmax([F.col(f"l{i}") for i in n]))]
    group = F.when(F.col("declared").isin(*languages), F.col("declared")).when(F.col("declared").isNotNull(), "other")
    seen = stored(rows.mapInArrow(partial(_likelihoods, model=model), (
        f"kind string, doc_id long, page_id long, declared string, host string, domain string, suffix string, trigrams long, {fields}"))
        .select("*", *soft, group.alias("says")), "language-evidence")

    counted = seen.where("trigrams > 0")
    sums = [F.sum(f"q{i}").alias(f"q{i}") for i in n]
    # Hosts of texts without evidence are there too, so that they meet their domain and suffix.
    hosts = seen.groupBy("kind", "suffix", "domain", "host").agg(
        *[F.sum(F.when(F.col("trigrams") > 0, F.col(f"q{i}")).otherwise(0)).alias(f"q{i}") for i in n])
    levels = {}
    for level, keys in (("domain", ["kind", "suffix", "domain"]), ("suffix", ["kind", "suffix"])):
        totals = hosts.groupBy(*keys).agg(*[F.sum(f"q{i}").alias(f"{level}{i}") for i in n])
        hosts = hosts.join(totals, keys)
        levels[level] = keys
    named = hosts.select("kind", "suffix", "domain", "host", *[F.col(f"q{i}").alias(f"host{i}") for i in n],
                         *[f"{level}{i}" for level in levels for i in n])
    whole = {r.kind: r for r in counted.groupBy("kind").agg(*sums).collect()}                          # one row per kind
    says = counted.where("says IS NOT NULL").groupBy("says").agg(*sums).collect()                      # one row per language
    by_kind = lambda pick: reduce(lambda other, k: F.when(F.col("kind") == k, F.lit(float(pick(whole[k])))).otherwise(other),
                                  whole, F.lit(float(_UNIT)))
    joined = seen.join(named, ["kind", "suffix", "domain", "host"], "left")

    own = [F.when(F.col("trigrams") > 0, F.col(f"q{i}")).otherwise(0) for i in n]
    total = by_kind(lambda r: sum(r[f"q{i}"] for i in n)) - sum(own, F.lit(0)) + _UNIT * len(languages)
    prior = [(by_kind(lambda r, i=i: r[f"q{i}"]) - own[i] + _UNIT) / total for i in n]
    for level in ("suffix", "domain", "host"):
        mine = [F.coalesce(F.col(f"{level}{i}"), own[i]) - own[i] for i in n]
        weight = SMOOTHING * _UNIT
        prior = [(mine[i] + weight * prior[i]) / (sum(mine, F.lit(0)) + weight) for i in n]
        joined = joined.withColumns({f"p{i}": prior[i] for i in n})
        prior = [F.col(f"p{i}") for i in n]
    told = {(r.says, i): r[f"q{i}"] + _UNIT for r in says for i in n}
    kinds = [*languages, "other"]
    likely = lambda d, i: math.log(told.get((d, i), _UNIT) / sum(told.get((k, i), _UNIT) for k in kinds))
    evidence = [reduce(lambda other, d: F.when(F.col("says") == d, F.lit(likely(d, i))).otherwise(other), kinds, F.lit(0.0)) for i in n]
    fused = joined.withColumns({f"s{i}": F.col(f"l{i}") + F.log(prior[i]) + evidence[i] for i in n})
    fused = fused.withColumns({f"r{i}": p for i, p in enumerate(_softmax([F.col(f"s{i}") for i in n]))})
    best = lambda x: F.reverse(F.array_sort(F.array(*[F.struct(F.col(f"{x}{i}").alias("x"), F.lit(languages[i]).alias("name")) for i in n])))[0]["name"]
    posterior = F.greatest(*[F.col(f"r{i}") for i in n])
    return fused.select(
        "kind", "doc_id", "page_id", "host", "suffix", "declared",
        F.when(F.col("trigrams") > 0, best("l")).alias("text_language"), best("r").alias("language"),
        posterior.alias("posterior"), (posterior >= LEAST_POSTERIOR).alias("kept"))
