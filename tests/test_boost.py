"""Boosting over binned rows against Spark ML's, and that the queries run on the operators' own parameters."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, functions as F

from catalog import flows, models as queries_of_models
from pitfeat.operators import boost, models as m
from pitfeat.operators.staking import GRID

FEATURES = ["a", "b", "c"]


class Seen(Exception):
    """Ends a query at the call in question."""


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = [(float(a), float(b), float(rng.integers(0, 6)), int(a + 2 * b * b + rng.normal(0, 0.5) > 1), 1.0 + k % 3, k % 5 == 0) for k, (a, b) in enumerate(rng.normal(0, 1, (1500, 2)))]
    return spark.createDataFrame([*made, (0.0, 0.0, 0.0, None, 1.0, False)], "a double, b double, c double, y int, w double, v boolean").repartition(3).localCheckpoint()


def plain(rows: DataFrame, val: str | None, weight: str | None, **params):
    gbt = GBTClassifier(labelCol="y", featuresCol="_features", seed=42, **params)
    gbt = gbt.setValidationIndicatorCol(val) if val else gbt
    return m._pipeline(FEATURES, gbt.setWeightCol(weight) if weight else gbt).fit(rows.where("y is not null"))


@pytest.mark.parametrize("here", [boost.HERE, 0])
@pytest.mark.parametrize("val, weight, params", [(None, None, {"maxIter": 4, "maxDepth": 3, "stepSize": 0.1}), ("v", "w", {"maxIter": 18, "maxDepth": 2, "stepSize": 0.3}),
                                                 (None, "w", {"maxIter": 2, "maxDepth": 4, "stepSize": 0.1, "minInstancesPerNode": 60})])
def test_same_trees_as_spark_ml(rows, monkeypatch, here, val, weight, params):
    """In one task and in passes over all blocks; margins are stored after a few trees."""
    monkeypatch.setattr(boost, "HERE", here)
    monkeypatch.setattr(boost, "STORE", 3)
    want, got = plain(rows, val, weight, **params), m.fit_trees_binned(rows, FEATURES, "y", val, weight, **params)
    assert got.stages[-1].getNumTrees == want.stages[-1].getNumTrees
    off = m.with_prob(m.with_prob(rows, want, "p"), got, "q").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert off < 1e-9
    assert np.allclose(got.stages[-1].featureImportances.toArray(), want.stages[-1].featureImportances.toArray(), atol=1e-6)


def test_draws_of_rows_and_features(rows, monkeypatch):
    """Both ways draw alike, fewer rows than there are, and models that are only compared score as the stored ones do."""
    binned = boost.bin_rows(rows, FEATURES, "y", "v")
    given = {"maxIter": 5, "maxDepth": 3, "subsamplingRate": 0.6, "featureSubsetStrategy": "2"}
    one = boost.fit_binned(binned, 1, True, **given)
    assert 0.5 * 1200 < one.trees[0].stats[0][0] < 0.7 * 1200
    monkeypatch.setattr(boost, "HERE", 0)
    other = boost.fit_binned(binned, 1, True, **given)
    assert [t.text()[:3] for t in one.trees] == [t.text()[:3] for t in other.trees]
    scored = m.with_prob(one.with_prob(rows, "p"), one.model(), "q")
    assert scored.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-12


def test_missing_features_and_other_labels_are_errors(spark):
    for made in ([(1.0, 0), (None, 1)], [(1.0, 0), (2.0, 2)]):
        with pytest.raises(Exception, match="MUST NOT be N|class number"):
            m.fit_trees_binned(spark.createDataFrame(made, "a double, y int"), ["a"], "y")


@pytest.mark.parametrize("query, at, name, first, want", [
    ("tune_random", m, "random_search", 4, {}), ("fit_tasks", m, "fit_tasks", 4, {}), ("train_stack_query", queries_of_models, "train_stack", 8, {})])
def test_queries_run_on_the_parameters_of_their_operators(spark, sf_dir, monkeypatch, query, at, name, first, want):
    """These queries used to ask for 2 folds, 2 trials and 2 to 4 rounds."""
    def seen(*args, **given):
        assert len(args) == first and given == want
        raise Seen

    monkeypatch.setattr(at, name, seen)
    with pytest.raises(Seen):
        getattr(queries_of_models, query)(spark, sf_dir)


def test_back_test_runs_all_folds_policies_and_candidates(spark, sf_dir, monkeypatch):
    def seen(rows, cfg, calendar, **given):
        assert list(cfg.grid) == GRID and set(cfg.candidates) == {"logistic", "trees"} and not given
        assert len(calendar) > 12 and {(end - start).days for _, start, end in calendar} == {90} and calendar[-1][2] > dt.date(2001, 8, 1)
        raise Seen

    monkeypatch.setattr(flows, "walk_forward_backtest", seen)
    with pytest.raises(Seen):
        flows.backtest_walkforward(spark, sf_dir)
    fitted = []
    monkeypatch.setattr("pitfeat.plans.backtest.fit_trees_binned", lambda *a, **given: fitted.append(given))
    flows._setup().candidates["trees"](None, FEATURES, "y")
    assert fitted == [{}]
