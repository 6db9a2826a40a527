"""Steps that read a table many times or order all of it move its rows as few times as they can."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from pitfeat.operators.aggregates import with_class_weight
from pitfeat.operators.ordered import time_index
from pitfeat.operators.staking import drawdown, max_drawdown
from tests.test_plans import plan


def test_class_weights_do_not_gather_classes(spark):
    rows = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(40)] + [(99, None)], "id int, label string")
    got = with_class_weight(rows, "label")
    assert "Exchange" not in plan(got) and "Join" not in plan(got)
    assert got.columns == ["label", "id", "weight"]
    assert {(r.label, r.weight) for r in got.collect()} == {("a", 40 / 60), ("b", 2.0), (None, None)}
    for kind in ("long", "short", "double", "boolean"):
        some = spark.createDataFrame([(0,), (1,), (1,), (None,)], "c int").select(F.col("c").cast(kind).alias("c"))
        assert sorted(r.weight for r in with_class_weight(some, "c").where("c is not null").collect()) == [0.75, 0.75, 1.5]
    assert with_class_weight(rows.where("id < 0"), "label").collect() == []


def test_time_index_moves_rows_once(spark):
    days = [random.Random(3).randrange(50) for _ in range(300)]
    rows = spark.createDataFrame([(i, d if d else None) for i, d in enumerate(days)], "id int, day int")
    got = time_index(rows, ["day", "id"])
    assert "Exchange" not in plan(got) and "Window" not in plan(got)
    want = sorted(range(300), key=lambda i: (days[i], i))
    assert [r.id for r in got.orderBy("idx").collect()] == want and [r.idx for r in got.orderBy("idx").collect()] == list(range(300))
    assert time_index(rows.where("id < 0"), ["day", "id"]).collect() == []


@pytest.mark.parametrize("odd", [None, math.nan])
def test_deepest_drop_from_blocks_is_that_of_the_rows(spark, odd):
    rng = random.Random(5)
    rows = [(k, i, odd if i < 3 or rng.random() < (0.2 if odd is None else 0.0) else rng.choice([-1.0, 0.5, 2.0]) * rng.random()) for k in ("a", "b", None) for i in range(200)]
    rows += [("lost", i, None) for i in range(60)] + [("small", i, float(-i)) for i in range(5)]
    if odd is not None:
        rows += [("late", i, odd if i == 150 else float((-1) ** i * i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, profit double").repartition(5)

    def figures(found):
        return {r.k: r.max_drawdown if r.max_drawdown is None or math.isnan(r.max_drawdown) else round(r.max_drawdown, 9) for r in found.collect()}

    def text(found):
        return {k: str(v) for k, v in figures(found).items()}

    want = text(drawdown(df, ["i"], by=["k"]).groupBy("k").agg(F.min("drawdown").alias("max_drawdown")))
    assert text(max_drawdown(df, ["i"], by=["k"])) == want
    assert text(max_drawdown(df, ["i"], by=["k"], hot_rows=20)) == want
    whole = drawdown(df, ["k", "i"]).agg(F.min("drawdown")).first()[0]
    got = max_drawdown(df, ["k", "i"]).first()[0]
    assert str(round(got, 9)) == str(round(whole, 9))


def test_deepest_drop_folds_blocks(spark):
    """Hot keys leave a row per block: the plan's last join of block figures onto rows is gone."""
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id", F.lit(-1.0).alias("profit"))
    assert "LeftOuter" not in plan(max_drawdown(df, ["id"], by=["k"], hot_rows=20))


def test_stored_labels(spark, sf_dir):
    """Fits read a stored table, not the join again."""
    from catalog.models import labelled

    text = plan(labelled(spark, sf_dir))
    assert "Join" not in text and "Exchange" not in text
