"""Temporal splits, folds and calibration slices, as columns that travel with the row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pitfeat.operators.clean import between_dates
from pitfeat.operators.ordered import time_index

# Back-test calendar.
INITIAL_TRAIN_END = dt.date(2020, 12, 31)
FINAL_TEST_END = dt.date(2024, 12, 31)
TEST_DAYS = 90
STEP_DAYS = 30
MIN_TRAIN = 1000
KEEP_FOLDS = 12
SPLITS = ("train", "val", "test")


def temporal_split(df: DataFrame, ts: str, val_start, test_start, name: str = "split") -> DataFrame:
    """train < val_start <= val < test_start <= test; rows without a time belong to no split."""
    if not val_start < test_start:
        raise ValueError("val_start must be before test_start")
    t = F.col(ts)
    return df.withColumn(name, F.when(t < F.lit(val_start), "train").when(t < F.lit(test_start), "val").when(t.isNotNull(), "test"))


def fold_calendar(initial_train_end: dt.date = INITIAL_TRAIN_END, final_test_end: dt.date = FINAL_TEST_END,
                  test_days: int = TEST_DAYS, step_days: int | None = None) -> list[tuple[int, dt.date, dt.date]]:
    """(fold, start, end) of each test part; the step defaults to the window, so that parts do not overlap."""
    step = step_days or test_days
    folds = max(0, -(-(final_test_end - initial_train_end).days // step))
    starts = [initial_train_end + dt.timedelta(days=k * step) for k in range(folds)]
    return [(k, s, s + dt.timedelta(days=test_days)) for k, s in enumerate(starts, 1)]


def last_folds(calendar: Sequence[tuple], n: int = KEEP_FOLDS) -> list[tuple]:
    return sorted(calendar, key=lambda f: f[1])[-n:]


def fold_sizes(df: DataFrame, ts: str, calendar: Sequence[tuple]) -> DataFrame:
    """Train and test rows per fold, from one count per day; the table itself is read once and never copied."""
    days = df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    folds = F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(s).alias("start"), F.lit(e).alias("end")) for f, s, e in calendar])
    each = days.withColumn("f", F.explode(folds)).where(F.col("day") < F.col("f.end"))
    return each.groupBy(F.col("f.fold").alias("fold"), F.col("f.start").alias("start"), F.col("f.end").alias("end")).agg(
        F.sum(F.when(F.col("day") < F.col("f.start"), F.col("rows")).otherwise(0)).alias("n_train"),
        F.sum(F.when(F.col("day") >= F.col("f.start"), F.col("rows")).otherwise(0)).alias("n_test"))


def walk_forward(df: DataFrame, ts: str, calendar: Sequence[tuple], min_train: int = MIN_TRAIN) -> DataFrame:
    """Folds with enough train rows and a non-empty test part."""
    return fold_sizes(df, ts, calendar).where((F.col("n_train") >= min_train) & (F.col("n_test") > 0))


def usable_folds(df: DataFrame, ts: str, calendar: Sequence[tuple], min_train: int = MIN_TRAIN, keep: int | None = KEEP_FOLDS) -> list[tuple]:
    """The usable folds as a driver-side calendar (a row per fold)."""
    rows = walk_forward(df, ts, calendar, min_train).select("fold", "start", "end").collect()
    folds = sorted((r["fold"], r["start"], r["end"]) for r in rows)
    return last_folds(folds, keep) if keep else folds


def cv_splits(n: int, k: int) -> int:
    return max(2, min(k, n - 1))


def ts_cv(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """Time-ordered cross-validation: ``fold`` is the number of the fold whose test part holds the row.

    Fold j tests rows [n - (k-j+1)*m, n - (k-j)*m) with m = n // (k+1) and trains on all rows before; rows of the
    first block are never tested and carry fold 0. Training rows of fold j are those with ``fold < j``.
    """
    indexed = time_index(df, order, "_idx")
    n = indexed.count()
    k = cv_splits(n, k)
    size = max(1, n // (k + 1))
    first = n - k * size
    idx = F.col("_idx")
    fold = F.when(idx < first, 0).otherwise(F.floor((idx - first) / F.lit(size)) + 1).cast("int")
    return indexed.withColumn(name, fold).drop("_idx")


def calibration_tail(df: DataFrame, order: Sequence[str], share: float = 0.9, name: str = "is_tail") -> DataFrame:
    """True for the rows from position floor(n * share) on."""
    indexed = time_index(df, order, "_idx")
    cut = int(indexed.count() * share)
    return indexed.withColumn(name, F.col("_idx") >= cut).drop("_idx")


def year_window(df: DataFrame, ts: str, year: int, name: str = "split") -> DataFrame:
    """train before year-2, val the two years before ``year``, test the year itself; later rows are dropped."""
    start = dt.datetime(year, 1, 1)
    part = df.where(F.col(ts) < F.lit(dt.datetime(year + 1, 1, 1)))
    return temporal_split(part, ts, dt.datetime(year - 2, 1, 1), start, name)


def year_part(df: DataFrame, ts: str, year: int) -> DataFrame:
    return between_dates(df, ts, dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1))
