"""Isotonic fit over range partitions: each task pools its own scores, neighbours are bridged, nothing is pooled on the driver.

The fit's levels are the slopes of the greatest convex minorant of the points (cumulated weight, cumulated outcome) in score order. A task pools adjacent violators of its range, which
gives the minorant of its own points. Across ranges the minorant has one edge over every border between two of them. The edge over a border is found by steps that can only lower it: for the slope of the last edge,
every range names its own lowest point (a binary search in its levels); the lowest one left of the border and the lowest one right of it make the next edge. All borders take
their steps together, in a handful of small jobs, of which the driver sees two points per border. What lies under an edge is pooled into it; all other levels stay as their task found them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pitfeat.operators.joins import asof_backward
from pitfeat.session import durable

# Different scores of a range, levels up to which a fit is applied from memory, steps after which the edges count as failed.
RANGE_SCORES = 1_000_000
IN_MEMORY = 100_000
STEPS = 200

POOLED = "part int, weight binary, total binary, lo binary, hi binary"


def pool(scores: np.ndarray, totals: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Levels of one sorted range: cumulated weight and total at the end of each, first and last score."""
    w, s, first = [], [], []
    for k, (a, b) in enumerate(zip(weights.tolist(), totals.tolist())):
        at = k
        while w and s[-1] * a >= b * w[-1]:  # the level before is not lower
            a, b, at = a + w.pop(), b + s.pop(), first.pop()
        w.append(a)
        s.append(b)
        first.append(at)
    start = np.array(first, np.int64)
    end = np.r_[start[1:], len(scores)] - 1
    return np.cumsum(w), np.cumsum(s), scores[start], scores[end]


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    parts = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("p", "s", "w")] for b in batches if b.num_rows]
    if parts:
        levels = pool(*(np.concatenate(x) for x in zip(*parts)))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), *(pa.array([np.ascontiguousarray(x, np.float64).tobytes()], pa.binary()) for x in levels)],
                                         ["part", "weight", "total", "lo", "hi"])


class _Ranges:
    """What the driver knows: the points at which ranges begin, and for each border the points at both ends of the edge over it."""

    def __init__(self, heads: list[tuple[int, float, float]]) -> None:
        self.place = {part: k for k, (part, _, _) in enumerate(heads)}
        self.start = np.r_[[[0.0, 0.0]], np.cumsum([[w, s] for _, w, s in heads], axis=0).reshape(-1, 2)]
        n = len(heads) - 1
        self.left = np.tile(self.start[0], (n, 1))
        self.right = np.tile(self.start[-1], (n, 1))

    @property
    def slopes(self) -> np.ndarray:
        d = self.right - self.left
        return d[:, 1] / d[:, 0]


def _points(row: dict, ranges: _Ranges) -> tuple[int, np.ndarray, np.ndarray]:
    """Place of a range and its points, the first of which is the end of the range before."""
    k = ranges.place[row["part"]]
    w0, s0 = ranges.start[k]
    return k, w0 + np.r_[0.0, np.frombuffer(row["weight"])], s0 + np.r_[0.0, np.frombuffer(row["total"])]


def _lowest(ranges: _Ranges):
    """For each border the lowest point of a range in the direction of the border's edge: left of the border or right of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes = ranges.slopes
        for batch in batches:
            for row in batch.to_pylist():
                k, w, s = _points(row, ranges)
                border = np.arange(len(slopes))
                left = border >= k  # border b lies between ranges b and b + 1
                best = np.searchsorted(np.diff(s) / np.diff(w), slopes)
                best = np.where(left, best, np.maximum(best, 1))
                height = s[best] - slopes * w[best]
                yield pa.RecordBatch.from_arrays([pa.array(border), pa.array(left), pa.array(height), pa.array(w[best]), pa.array(s[best])], ["border", "left", "height", "w", "s"])

    return run


def _bridged(pooled: DataFrame, ranges: _Ranges) -> None:
    """Lowers the edges over all borders until none can be."""
    if not len(ranges.left):
        return
    for _ in range(STEPS):
        slopes, line = ranges.slopes, ranges.left[:, 1] - ranges.slopes * ranges.left[:, 0]
        # of equal heights the point farthest from the border: collinear levels are one level
        far = F.when(F.col("left"), F.col("w")).otherwise(-F.col("w"))
        best = pooled.mapInArrow(_lowest(ranges), "border long, left boolean, height double, w double, s double").groupBy("border", "left").agg(
            F.min(F.struct("height", far.alias("far"), "w", "s")).alias("x")).select("border", "left", "x.w", "x.s").collect()
        left, right = ranges.left.copy(), ranges.right.copy()
        for border, is_left, w, s in best:
            (left if is_left else right)[border] = w, s
        ranges.left, ranges.right = left, right
        below = [line - (x[:, 1] - slopes * x[:, 0]) > 1e-12 * (1 + np.abs(x[:, 1])) for x in (left, right)]
        if not np.any(below):  # no point lies under its edge's line
            return
    raise RuntimeError(f"the edges have not settled after {STEPS} steps")


def _final(ranges: _Ranges):
    """Levels that no edge covers, and for the edges their first score (from the range with the left end) and last score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(ranges.left)
        for batch in batches:
            for row in batch.to_pylist():
                k, w, s = _points(row, ranges)
                lo, hi = np.frombuffer(row["lo"]), np.frombuffer(row["hi"])
                low = ranges.right[k - 1, 0] if k else 0.0
                high = ranges.left[k, 0] if k < n else np.inf
                own = np.flatnonzero((w[:-1] >= low) & (w[1:] <= high))
                # an edge begins with the level after its left end and ends with the level of its right end
                first = [b for b in range(n) if w[0] <= ranges.left[b, 0] < w[-1]]
                last = [b for b in range(n) if w[0] < ranges.right[b, 0] <= w[-1]]
                rows = [(None, float(lo[i]), float(hi[i]), float((s[i + 1] - s[i]) / (w[i + 1] - w[i])), float(w[i + 1] - w[i])) for i in own]
                rows += [(b, float(lo[np.searchsorted(w, ranges.left[b, 0], "right") - 1]), None, None, None) for b in first]
                rows += [(b, None, float(hi[np.searchsorted(w, ranges.right[b, 0]) - 1]), float(ranges.slopes[b]), float(ranges.right[b, 0] - ranges.left[b, 0])) for b in last]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.float64()) for i, c in enumerate(cols)], ["border", "lo", "hi", "level", "weight"])

    return run


def levels(df: DataFrame, p: str, y: str, ranges: int | None = None) -> DataFrame:
    """lo, hi (first and last score), level and weight of every level of the fit, stored; rows without score or outcome do not count."""
    folded = df.where(F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double")) & F.col(y).isNotNull()).groupBy((F.col(p).cast("double") + 0.0).alias("p")).agg(
        F.sum(F.col(y).cast("double")).alias("s"), F.count(F.lit(1)).cast("double").alias("w"))
    folded = durable(folded)
    n = ranges or max(1, -(-folded.count() // RANGE_SCORES))
    pooled = durable(folded.repartitionByRange(n, "p").sortWithinPartitions("p").mapInArrow(_pooled, POOLED))

    def total(c: str):
        return F.unhex(F.substring(F.hex(c), -16, 16))

    # the last cumulated figures of a range: two numbers each
    heads = sorted((r["part"], *(np.frombuffer(bytes(r[c]))[0] for c in ("w", "s"))) for r in pooled.select("part", total("weight").alias("w"), total("total").alias("s")).collect())
    if not heads:
        return folded.sparkSession.createDataFrame([], "lo double, hi double, level double, weight double")
    borders = _Ranges([(part, float(w), float(s)) for part, w, s in heads])
    _bridged(pooled, borders)
    found = pooled.mapInArrow(_final(borders), "border long, lo double, hi double, level double, weight double")
    edges = found.where("border is not null").groupBy("border").agg(*[F.max(c).alias(c) for c in ("lo", "hi", "level", "weight")])
    once = edges.groupBy("lo", "hi").agg(F.max("level").alias("level"), F.max("weight").alias("weight"))  # an edge may lie over several borders
    return durable(found.where("border is null").drop("border").unionByName(once))


@dataclass(frozen=True)
class Isotonic:
    """``table``: the levels. Between two levels the fit is linear, beyond all it is constant."""

    table: DataFrame

    def apply(self, df: DataFrame, p: str, name: str, in_memory: int = IN_MEMORY) -> DataFrame:
        ends = self.table.select(F.explode(F.array(F.struct(F.col("lo").alias("at"), "level"), F.struct(F.col("hi").alias("at"), "level"))).alias("e")).select("e.*").distinct()
        if self.table.count() <= in_memory:
            known = sorted((r["at"], r["level"]) for r in ends.collect())
            at, level = (np.array([k[i] for k in known], np.float64) for i in (0, 1))

            @F.pandas_udf("double")
            def fitted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
                for x in batches:
                    yield pd.Series(np.interp(x, at, level)).where(x.notna().reset_index(drop=True)) if len(at) else pd.Series(np.full(len(x), np.nan))

            return df.withColumn(name, F.nanvl(fitted(F.col(p).cast("double")), F.lit(None).cast("double")))
        # many levels: the last end at or before a score and the first at or after it, each by a merge of both tables
        row = df.withColumn("_row", F.struct(*df.columns)).select("_row", F.lit(1).alias("_all"), F.col(p).cast("double").alias("_p"), (-F.col(p).cast("double")).alias("_q"))
        ends = ends.withColumns({"_all": F.lit(1), "_at": F.col("at"), "_ta": -F.col("at")})
        before = asof_backward(row, ends.select("_all", "_at", F.col("at").alias("a"), F.col("level").alias("va")), ["_all"], "_p", "_at", ["a", "va"])
        both = asof_backward(before, ends.select("_all", "_ta", F.col("at").alias("b"), F.col("level").alias("vb")), ["_all"], "_q", "_ta", ["b", "vb"])
        inside = F.col("va") + (F.col("vb") - F.col("va")) * (F.col("_p") - F.col("a")) / (F.col("b") - F.col("a"))
        fit = F.when(F.col("a").isNull(), F.col("vb")).when(F.col("b").isNull() | (F.col("a") >= F.col("b")), F.col("va")).otherwise(inside)
        return both.select("_row.*", F.when(F.col("_p").isNotNull() & ~F.isnan("_p"), fit).alias(name))


def fit_isotonic(df: DataFrame, p: str, y: str, ranges: int | None = None) -> Isotonic:
    """Non-decreasing fit of ``y`` on the score ``p``; ``ranges``: the number of range partitions, by default by the number of different scores."""
    return Isotonic(levels(df, p, y, ranges))
