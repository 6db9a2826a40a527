"""Probability and class metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from pitfeat.functions.numbers import argmax_index, clip
from pitfeat.operators.ordered import HOT_ROWS, running

EPS = float(np.finfo("float64").eps)
BINS = 10


def log_loss(p: Column, y: Column) -> Column:
    q = clip(p, EPS, 1.0 - EPS)
    return -F.when(y == 1, F.ln(q)).otherwise(F.ln(1.0 - q))


def auc(df: DataFrame, p: str, y: str, by: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """ROC area per group by the rank-sum rule, tied scores counted half.

    Rows are folded to one per distinct score, then negatives below each score are a running sum in score order.
    """
    scores = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(p).alias("_p")).agg(
        F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg"))
    ranked = running(scores, by, ["_p"], {"_upto": ("sum", F.col("_neg"))}, hot_rows)
    wins = F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2)
    return ranked.groupBy(*by).agg(F.try_divide(F.sum(wins), F.sum("_pos") * F.sum("_neg")).alias("roc_auc"))


def _threshold_metrics(p: Column, y: Column, threshold: float) -> dict[str, Column]:
    hit = p >= threshold
    tp, fp = F.count_if(hit & (y == 1)), F.count_if(hit & (y == 0))
    fn = F.count_if(~hit & (y == 1))
    zero = F.lit(0.0)
    return {
        "accuracy": F.avg((hit == (y == 1)).cast("double")),
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
    }


def bin_index(p: Column, bins: int = BINS) -> Column:
    """Bin of [0, 1] cut at the exact doubles of an even spacing; 1 belongs to the last bin."""
    edges = [float(e) for e in np.linspace(0, 1, bins + 1)[1:-1]]
    return reduce(lambda a, b: a + b, [(p >= e).cast("int") for e in edges])


def calibration_bins(df: DataFrame, p: str, y: str, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    rows = df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
    return rows.groupBy(*by, bin_index(F.col(p), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("mean_y"), F.avg(p).alias("mean_p"))


def ece(df: DataFrame, p: str, y: str, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    gap = F.col("n") * F.abs(F.col("mean_y") - F.col("mean_p"))
    return calibration_bins(df, p, y, by, bins).groupBy(*by).agg((F.sum(gap) / F.sum("n")).alias("expected_calibration_error"))


def brier(df: DataFrame, p: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("brier_score"))


def _side_by_side(results: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Figures of one row per group each, put next to each other by folding their union; no join, keyed or not."""
    names = [c for r in results for c in r.columns if c not in by]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    return both.groupBy(*by).agg(*[F.max(n).alias(n) for n in names])


def binary_metrics(df: DataFrame, p: str, y: str, threshold: float = 0.5, by: Sequence[str] = (), bins: int = BINS,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """log_loss, accuracy, roc_auc, precision, recall, f1, brier_score, expected_calibration_error per group.

    The scan folds rows to one per (group, bin) for everything but the ROC area, which needs the distinct scores.
    """
    rows = df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
    pc, yc = F.col(p), F.col(y)
    plain = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(log_loss(pc, yc)).alias("log_loss"),
        *[c.alias(n) for n, c in _threshold_metrics(pc, yc, threshold).items()],
        F.avg((pc - yc) * (pc - yc)).alias("brier_score"))
    area, gap = auc(rows, p, y, by, hot_rows), ece(rows, p, y, by, bins)
    return _side_by_side([plain, area, gap], by)


def metrics_table(scores: DataFrame, by: Sequence[str] = ("model", "split", "calibrated"), p: str = "p", y: str = "y") -> DataFrame:
    """A metrics row per (model, split, calibrated) of a long score table."""
    return binary_metrics(scores, p, y, by=by)


def multiclass_metrics(df: DataFrame, probs: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Log-loss and accuracy for a probability array and a zero-based class index."""
    vector, label = F.col(probs), F.col(y).cast("int")
    true_p = clip(F.get(vector, label), EPS, 1.0 - EPS)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(-F.ln(true_p)).alias("log_loss"),
                               F.avg((argmax_index(vector) == label).cast("double")).alias("accuracy"))


# Decision thresholds tried, and the one kept on ties.
THRESHOLDS = [float(t) for t in np.linspace(0.05, 0.95, 181)]
DEFAULT_THRESHOLD = 0.5


def thresholds_passed(p: Column, thresholds: Sequence[float]) -> Column:
    """How many of the evenly spaced ascending thresholds are <= p: a guess by arithmetic, then moved by one if needed."""
    n, step = len(thresholds), (thresholds[-1] - thresholds[0]) / (len(thresholds) - 1)
    table = F.array(*[F.lit(t) for t in thresholds])
    guess = clip(F.floor((p - thresholds[0]) / step) + 1, 0, n).cast("int")
    up = F.coalesce(p >= F.get(table, guess), F.lit(False)).cast("int")
    down = F.coalesce(p < F.get(table, guess - 1), F.lit(False)).cast("int")
    return guess + up - down


def threshold_scores(df: DataFrame, p: str, y: str, thresholds: Sequence[float] = tuple(THRESHOLDS)) -> DataFrame:
    """Accuracy per threshold.

    A row is not compared with every threshold: rows are counted by how many thresholds they pass, and the handful of
    counts is then summed per threshold.
    """
    rows = df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
    counts = rows.groupBy(thresholds_passed(F.col(p), thresholds).alias("passed")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    grid = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    each = counts.select("passed", "pos", "neg", F.explode(grid).alias("g"))
    right = F.when(F.col("passed") > F.col("g.pos"), F.col("pos")).otherwise(F.col("neg"))
    return each.groupBy(F.col("g.threshold").alias("threshold")).agg((F.sum(right) / F.sum(F.col("pos") + F.col("neg"))).alias("accuracy"))


def best_threshold(df: DataFrame, p: str, y: str, thresholds: Sequence[float] = tuple(THRESHOLDS), default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The first best threshold, or ``default`` unless one is strictly more accurate."""
    from pitfeat.operators.aggregates import best_by

    scores = threshold_scores(df, p, y, sorted({*thresholds}))
    best = best_by(scores, "accuracy", tie=["threshold"])
    base = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).agg(
        F.avg(((F.col(p) >= default) == (F.col(y) == 1)).cast("double")).alias("_base"))
    return _side_by_side([best, base], []).select(
        F.when(F.col("accuracy") > F.col("_base"), F.col("threshold")).otherwise(F.lit(default)).alias("threshold"),
        F.greatest("accuracy", "_base").alias("accuracy"))
