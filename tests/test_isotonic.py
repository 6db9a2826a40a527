"""The isotonic fit over ranges against plain pooling and against Spark ML's."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from pitfeat.operators.isotonic import fit_isotonic, pool


def frame(spark, p, y):
    return spark.createDataFrame(list(zip(map(float, p), map(int, y))), "p double, y int").repartition(4)


def plain(p, y):
    """Fitted value of every different score."""
    scores, at = np.unique(p, return_inverse=True)
    w, s = np.bincount(at).astype(float), np.bincount(at, y).astype(float)
    blocks = []
    for k in range(len(scores)):
        blocks.append([w[k], s[k], 1])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            a = blocks.pop()
            blocks[-1] = [x + z for x, z in zip(blocks[-1], a)]
    return scores, np.concatenate([[b[1] / b[0]] * b[2] for b in blocks])


SHAPES = {
    "rising": lambda rng, p: rng.random(len(p)) < p,
    "falling": lambda rng, p: rng.random(len(p)) < 1 - p,
    "waves": lambda rng, p: rng.random(len(p)) < (np.sin(p * 12) + 1) / 2,
    "flat": lambda rng, p: np.ones(len(p)),
    "step": lambda rng, p: p > 0.3,
}


@pytest.mark.parametrize("shape, ranges", [(s, r) for s in SHAPES for r in (1, 7)] + [("waves", 40)])
def test_equals_plain_pooling(spark, shape, ranges):
    rng = np.random.default_rng(len(shape))
    p = np.round(rng.random(10_000 if ranges == 40 else 1500), 5 if ranges == 40 else 3)
    y = SHAPES[shape](rng, p).astype(int)
    scores, want = plain(p, y)
    table = fit_isotonic(frame(spark, p, y), "p", "y", ranges).table.toPandas().sort_values("lo")
    assert (table.lo.values[1:] > table.hi.values[:-1]).all() and (np.diff(table.level) > 0).all()
    got = table.level.values[np.searchsorted(table.lo.values, scores, "right") - 1]
    assert np.allclose(got, want, atol=1e-12) and table.weight.sum() == len(p)


def test_apply(spark):
    rng = np.random.default_rng(4)
    p = np.round(rng.random(400), 2)
    y = (rng.random(400) < p).astype(int)
    df = frame(spark, p, y)
    fit = fit_isotonic(df, "p", "y", 5)
    other = IsotonicRegression(featuresCol="p", labelCol="y").fit(df)
    asked = spark.createDataFrame([(k, None if k == 50 else k / 40 - 0.5) for k in range(90)], "k int, p double")
    want = {r["k"]: r["prediction"] for r in other.transform(asked.where("p is not null")).collect()}
    for in_memory in (1000, 0):
        out = fit.apply(asked.withColumn("a", F.lit("kept")), "p", "cal", in_memory)
        assert out.columns == ["k", "p", "a", "cal"]
        got = {r["k"]: r["cal"] for r in out.collect()}
        assert got.pop(50) is None and len(got) == 89
        assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 1), (0.5, None), (0.2, 1), (-0.0, 0), (0.0, 1)], "p double, y int")
    fit = fit_isotonic(df, "p", "y", 3)
    assert sorted(tuple(r) for r in fit.table.collect()) == [(0.0, 0.0, 0.5, 2.0), (0.2, 0.2, 1.0, 1.0)]
    none = fit_isotonic(df.limit(0), "p", "y")
    assert [r["cal"] for r in none.apply(df, "p", "cal").collect()] == [None] * 6


def test_pool():
    w, s, lo, hi = pool(np.arange(5.0), np.array([1.0, 0, 0, 2, 2]), np.array([1.0, 1, 2, 2, 2]))
    assert w.tolist() == [4, 8] and s.tolist() == [1, 5] and lo.tolist() == [0, 3] and hi.tolist() == [2, 4]
