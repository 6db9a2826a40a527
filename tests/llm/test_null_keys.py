"""Rows without a key in the language model."""

from __future__ import annotations

from pitfeat.llm import pitman_yor


def test_null_keys_train(spark, tmp_path):
    rows = [(k, "some common words") for k in range(30)] + [(None, "nowhere else")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    alone, = pitman_yor.op7_pitman_yor(spark, str(tmp_path)).where("doc_id is null").collect()
    assert not alone.held_out and alone.n_known == alone.n_tokens == 3
