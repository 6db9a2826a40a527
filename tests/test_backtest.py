"""Walk-forward back-test: what is stored, and that this does not depend on columns nobody reads."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from pitfeat.operators import ordered
from pitfeat.operators.models import fit_logistic
from pitfeat.operators.splits import fold_calendar
from pitfeat.operators.staking import Policy
from pitfeat.plans import backtest


def test_rows_are_stored_once_with_used_columns_only(spark, monkeypatch):
    """All columns used to be sorted, and the filled train rows were written again for each fold."""
    rng = np.random.default_rng(3)
    start = dt.datetime(2000, 1, 1)
    rows = [(f"k{k:04}", start + dt.timedelta(days=int(rng.integers(0, 400))), "ab"[k % 2], float(rng.random()), None if k % 7 == 0 else float(rng.random()),
             1.5 + float(rng.random()), 1.5 + float(rng.random()), int(rng.integers(0, 2)), "x" * 50) for k in range(600)]
    df = spark.createDataFrame(rows, "key string, day timestamp, seg string, a double, price_gap double, price_1 double, price_2 double, y int, unused string")
    cfg = backtest.Setup(["a", "price_gap"], "y", "day", "key", "day", "seg", candidates={"logistic": fit_logistic}, grid=[Policy(0.0, 0.05), Policy(0.04, 0.02)])
    stored, real = [], backtest.durable

    def noted(frame):
        stored.append(frame.columns)
        return real(frame)

    monkeypatch.setattr(backtest, "durable", noted)
    monkeypatch.setattr(ordered, "durable", noted)
    calendar = fold_calendar(dt.date(2000, 10, 1), dt.date(2000, 11, 30), 60)
    per_fold, bets, _ = backtest.walk_forward_backtest(df, cfg, calendar, min_train=100)
    assert not any("unused" in columns for columns in stored)
    assert sum({"a", "price_gap"} <= set(columns) for columns in stored) == 2  # before and after the rows are put in order
    assert per_fold.count() == 1
    inside = df.where((F.col("day") >= F.lit(calendar[0][1])) & (F.col("day") < F.lit(calendar[-1][2])))
    assert bets.count() == inside.count() and bets.where("fraction > 0").count() == per_fold.agg(F.sum("n_bets")).first()[0]
