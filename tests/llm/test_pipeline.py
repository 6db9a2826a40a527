"""The pipeline's stages, one after another, on awkward rows and on the smallest tables."""

from __future__ import annotations

import re

import numpy as np

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from pitfeat.llm.bpe import vocabulary_path
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, sf_dir, odd, nothing):
    for start in (odd, nothing):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == start.columns
            assert all(r.n_chars == len(r.text or "") for r in docs.select("text", "n_chars").collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_pipeline_takes_near_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir)
    size = sum(len(WORD.findall(r.text)) for r in before.collect())
    mixed = docs.collect()
    assert abs(sum(len(WORD.findall(r.text)) for r in mixed) - 1.5 * size) < 0.01 * size
    whole = {r.doc_id: r.text for r in before.collect()}
    assert all(WORD.findall(r.text)[:1] and set(WORD.findall(r.text)) <= set(WORD.findall(whole[r.doc_id])) for r in mixed)


def test_pipeline_ids_decode_to_texts(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(len(np.frombuffer(r.ids, "<u4")) == r.n_tokens for r in rows)
    known = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} <= known
    assert library.decode(np.frombuffer(rows[0].ids, "<u4").tolist())


def test_registered():
    assert {"pipeline", *(n for n in queries() if re.match(r"op\d+_", n))} <= set(queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries() if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert {"op9_line_dedup", "op10_url_filter", "op12_collocations", "op13_conversation_trie"} <= set(oracle_sql())
    assert odd_rows()
