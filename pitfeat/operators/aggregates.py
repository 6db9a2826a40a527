"""Aggregations and one-row-per-key choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark pushes "row number = 1" below the shuffle, so each task sends at most one row per key
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order; no keys leaves the table as it is."""
    return _ranked(df, keys, [F.col(c).asc() for c in order]) if keys else df


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _ranked(df, keys, [F.col(c).desc() for c in order]) if keys else df


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First non-null value of each column per key, "first" meaning the given order."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class, n / (k * count), and the same scaled to mean 1 over classes."""
    counts = class_counts(df.where(F.col(label).isNotNull()), label)
    every = Window.partitionBy()  # one row per class only
    raw = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return counts.withColumn("weight", raw).withColumn("weight_mean_1", F.col("weight") / F.avg("weight").over(every))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """The rows with the balanced weight of their class, null without one. Weights are counted once and looked up in a literal map, since a join would gather the rows of a class in one task."""
    weights = {r[0]: r[1] for r in class_weights(df, label).select(label, "weight").collect()}
    known = F.create_map(*[x for c, w in weights.items() for x in (F.lit(c).cast(df.schema[label].dataType), F.lit(w))]) if weights else None
    return df.select(label, *[c for c in df.columns if c != label], (F.try_element_at(known, F.col(label)) if weights else F.lit(None).cast("double")).alias(name))


def summarise_folds(df: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(m).alias(m) for m in metrics], F.count(F.lit(1)).alias("folds"))


def coverage_by(df: DataFrame, group: str, present: Column) -> DataFrame:
    return df.groupBy(group).agg(F.avg(present.cast("double")).alias("coverage"), F.count(F.lit(1)).alias("n"))


def best_by(df: DataFrame, metric: str, by: Sequence[str] = (), largest: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the best metric (per group); equal metrics go to the smallest ``tie``. Null metrics lose."""
    rows = df.where(F.col(metric).isNotNull())
    if not by:
        return rows.orderBy(F.col(metric).desc() if largest else F.col(metric), *tie).limit(1)
    return _ranked(rows, by, [F.col(metric).desc() if largest else F.col(metric).asc(), *[F.col(c).asc() for c in tie]])


# Values of one column a task may hold to read off an exact order statistic: a few kilobytes, so that hundreds of columns fit.
EXACT_ROWS = 1_000


def exact_medians(df: DataFrame, columns: Sequence[str], exact_rows: int = EXACT_ROWS) -> dict[str, float | None]:
    """Exact median per column, nulls and NaN ignored.

    Each round finds, in one pass for all columns, an approximate bracket around the middle values among the rows
    still in question, together with how many rows lie below it. Brackets shrink by orders of magnitude per round;
    once few enough rows are left they are sorted. Only a few numbers per column reach the driver.
    """
    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    stats = df.agg(*[f for i, c in enumerate(columns) for f in (
        F.count(value(c)).alias(f"n{i}"), F.min(value(c)).alias(f"lo{i}"), F.max(value(c)).alias(f"hi{i}"))]).first()
    # column -> [rows, low, high, rows below low, rows within]
    state = {i: [stats[f"n{i}"], stats[f"lo{i}"], stats[f"hi{i}"], 0, stats[f"n{i}"]] for i in range(len(columns))}
    medians: dict[int, float | None] = {i: None for i, s in state.items() if s[0] == 0}

    def inside(i: int) -> Column:
        return F.when(value(columns[i]).between(state[i][1], state[i][2]), value(columns[i]))

    while len(medians) < len(columns):
        todo = [i for i in state if i not in medians]
        for i in list(todo):
            if state[i][1] == state[i][2]:
                medians[i] = state[i][1]
                todo.remove(i)
        small = [i for i in todo if state[i][4] <= exact_rows]
        if small:
            row = df.agg(*[F.sort_array(F.collect_list(inside(i))).alias(f"v{i}") for i in small]).select(*[
                ((F.get(f"v{i}", F.lit((state[i][0] - 1) // 2 - state[i][3])) + F.get(f"v{i}", F.lit(state[i][0] // 2 - state[i][3]))) / 2).alias(f"m{i}")
                for i in small]).first()
            medians.update({i: row[f"m{i}"] for i in small})
        large = [i for i in todo if i not in small]
        if not large:
            continue
        accuracy = 10_000
        guess = {}
        for i in large:
            n, _, _, below, within = state[i]
            lo_q = max(0.0, ((n - 1) // 2 - below) / within - 2 / accuracy)
            hi_q = min(1.0, (n // 2 - below + 1) / within + 2 / accuracy)
            guess[i] = F.percentile_approx(inside(i), [lo_q, hi_q], accuracy).alias(f"q{i}")
        cut = df.agg(*guess.values()).first()
        new = {i: tuple(cut[f"q{i}"]) for i in large}
        row = df.agg(*[f for i in large for f in (
            F.count_if(value(columns[i]) < new[i][0]).alias(f"b{i}"),
            F.count_if(value(columns[i]).between(*new[i])).alias(f"w{i}"))]).first()
        for i in large:
            n, lo, hi, below, within = state[i]
            b, w = row[f"b{i}"], row[f"w{i}"]
            k1, k2 = (n - 1) // 2, n // 2
            if not (b <= k1 and k2 < b + w) or w >= within:
                # the guess missed the middle or did not help: halve the bracket at an actual value instead
                new_lo, new_hi, b, w = _halve(df, value(columns[i]), lo, hi, below, k1, k2)
                if b is None:
                    medians[i] = (new_lo + new_hi) / 2
            else:
                new_lo, new_hi = new[i]
            state[i] = [n, new_lo, new_hi, b, w]
    return {c: medians[i] for i, c in enumerate(columns)}


def _halve(df: DataFrame, value: Column, lo: float, hi: float, below: int, k1: int, k2: int):
    mid = lo + (hi - lo) / 2
    left = value.between(lo, mid)
    right = (value > mid) & (value <= hi)
    r = df.agg(F.count_if(left).alias("n"), F.max(F.when(left, value)).alias("left_hi"),
               F.min(F.when(right, value)).alias("right_lo"), F.count_if(right).alias("m")).first()
    if k2 < below + r["n"]:
        return lo, r["left_hi"], below, r["n"]
    if k1 >= below + r["n"]:
        return r["right_lo"], hi, below + r["n"], r["m"]
    # the last value on the left and the first on the right are the two middle values
    return r["left_hi"], r["right_lo"], None, 0
