"""What reaches the driver for the classifier's fit is bounded, whatever repeats."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitfeat.llm import factorisation


@pytest.fixture
def seen(monkeypatch):
    rows = []
    fit = factorisation.fit
    monkeypatch.setattr(factorisation, "fit", lambda r, label: (rows.append(sorted(label.tolist())), fit(r, label))[1])
    return rows


def test_an_id_with_very_many_rows(spark, seen):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 500).cast("string")).alias("text"), F.lit(1).alias("h"), F.lit(1).alias("label"))
    docs = docs.unionAll(spark.createDataFrame([(k, f"other {k}", 1, 1) for k in range(20, 40)], "doc_id long, text string, h int, label int")).unionAll(spark.createDataFrame([(None, "x", 1, 1), (8, None, 1, 1)], "doc_id long, text string, h int, label int"))
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (None, 0), *((k, k % 2) for k in range(20, 40))], "doc_id long, quality int")
    factorisation.train(docs, labels, sample=15)
    assert len(seen[0]) == 15 + 11 and sum(seen[0]) == 15
    factorisation.train(docs, labels, sample=1000)
    assert sum(seen[1]) == 500 + 10 and len(seen[1]) == 500 + 10 + 11


def test_no_rows(spark, seen):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = factorisation.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert seen == [[]] and abs(model.score(["a"])[0] - 0.5) < 1e-9
