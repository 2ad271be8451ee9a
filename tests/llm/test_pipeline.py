from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from airpanel.llm.mixing import mixed
from airpanel.llm.pieces import MODEL
from airpanel.llm.toxicity import toxicity
from tests.llm.test_near import expected

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    return corpus_pipeline.run(spark, DATA).persist()


def test_rows_equal_a_brute_force_run(spark, result):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    toxic = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{DATA}/labels.parquet")).where("predicted = 1").collect()}
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text", "source").collect() if r.doc_id not in toxic)
    seen, unique = set(), []
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
        if key not in seen:
            seen.add(key)
            unique.append(r)
    kept = {i for i, _, _, k in expected([r[:2] for r in unique], 5, 80, 100) if k}
    stay = docs.where(docs.doc_id.isin(*kept))
    want = Counter()
    for r in mixed(stay).collect():
        want[r.doc_id] += r.copies
    found = result.collect()
    assert Counter(r.doc_id for r in found) == Counter({k: v for k, v in want.items() if v})
    text = {r[0]: r[1] for r in rows}
    for r in found:
        assert r.ids == library.encode(text[r.doc_id]) and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[3:4]:
        assert stage(spark, docs, DATA).columns == docs.columns, name


def test_entry_registers_the_pipeline_and_ten_operators():
    from __spark_entry__ import queries

    names = queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
