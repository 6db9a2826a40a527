"""Joins. Sides are never broadcast by hand: adaptive execution broadcasts a side once its measured size is small, and
splits the partitions of skewed keys otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pitfeat.operators.ordered import HOT_ROWS, running


def enrich(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left")


def enrich_sides(df: DataFrame, right: DataFrame, match: str, entity: str, values: Sequence[str],
                 sides: Mapping[str, str]) -> DataFrame:
    """Attach ``values`` of (match, entity) once per side; ``sides`` maps a prefix to the side's entity column."""
    for p, e in sides.items():
        side = right.select(match, F.col(entity).alias(e), *[F.col(v).alias(p + v) for v in values])
        df = df.join(side, [match, e], "left")
    return df


def attach_labels(features: DataFrame, labels: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join; a column present on both sides is taken from the features and, where null, from the labels."""
    both = [c for c in labels.columns if c in features.columns and c not in on]
    right = labels.withColumnsRenamed({c: f"_lab_{c}" for c in both})
    joined = features.join(right, list(on), "inner")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_lab_{c}")) for c in both}).drop(*[f"_lab_{c}" for c in both])


def keep_keys(df: DataFrame, keys: DataFrame | None, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is listed; no list keeps all."""
    return df if keys is None else df.join(keys, on, "left_semi")


def keep_ids(df: DataFrame, column: str, ids: Sequence | None) -> DataFrame:
    return df.where(F.col(column).isin(list(ids))) if ids else df


def new_keys(df: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(existing.select(*on), list(on), "left_anti")


def lookup_default(df: DataFrame, table: DataFrame, key: str, value: str, default: float = 0.5) -> DataFrame:
    """Value per key, ``default`` where the key is absent or its value null. Keys of ``table`` are unique."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def cross_grid(df: DataFrame, grid: Sequence[Mapping[str, float]], name: str = "grid") -> DataFrame:
    """Each row with each entry of a small fixed parameter grid, as one literal array that is exploded in place.

    Nothing is shuffled; aggregate the result straight away so that the copies end in the map-side combine.
    """
    entries = [F.struct(F.lit(i).alias("pos"), *[F.lit(v).alias(k) for k, v in entry.items()]) for i, entry in enumerate(grid)]
    return df.withColumn(name, F.explode(F.array(*entries)))


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str],
                  right_tie: Sequence[str] = (), left_key: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """The last right row with ``right_ts <= left_ts`` of the same key; null values of that row stay null.

    Both tables are merged into one history per key and the last right row is carried forward, so the cost is one
    shuffle and one sort of both, whatever the number of matches. Right rows without a time are dropped; left rows
    without a time or key get nulls. ``right_tie`` decides between right rows of one time, ``left_key`` makes the
    order of left rows total.
    """
    payload = F.struct(*[F.col(c) for c in values])
    rest = [c for c in left.columns if c not in by]
    r_cols = {f"_r{i}": F.col(c) for i, c in enumerate(right_tie)}
    probes = left.select(*by, F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.struct(*rest).alias("_left"),
                         *[F.lit(None).cast(right.schema[c].dataType).alias(n) for n, c in zip(r_cols, right_tie)],
                         *[F.col(c).alias(f"_l{i}") for i, c in enumerate(left_key)],
                         F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType).alias("_right"))
    known = right.where(F.col(right_ts).isNotNull()).select(
        *by, F.col(right_ts).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.select(F.struct(*rest).alias("p")).schema["p"].dataType).alias("_left"),
        *[c.alias(n) for n, c in r_cols.items()],
        *[F.lit(None).cast(left.schema[c].dataType).alias(f"_l{i}") for i, c in enumerate(left_key)],
        payload.alias("_right"))
    merged = known.unionByName(probes)
    order: list[str | Column] = ["_t", "_side", *r_cols, *[f"_l{i}" for i in range(len(left_key))]]
    found = running(merged, by, order, {"_found": ("last", F.col("_right"))}, hot_rows).where("_side = 1")
    known_key = F.col("_t").isNotNull()
    for c in by:
        known_key = known_key & F.col(c).isNotNull()
    return found.select(*[F.col(c) if c in by else F.col("_left")[c].alias(c) for c in left.columns],
                        *[F.when(known_key, F.col("_found")[c]).alias(c) for c in values])


def assign_folds(df: DataFrame, ts: str, calendar: Sequence[tuple]) -> DataFrame:
    """Rows with the folds whose test part [start, end) holds them (``fold``, ``role`` = test).

    ``calendar`` is a short driver-side list of (fold, start, end). Train membership needs no copies: it is the
    filter ``ts < start`` of :func:`train_part`.
    """
    folds = F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(s).alias("start"), F.lit(e).alias("end")) for f, s, e in calendar])
    hit = F.filter(folds, lambda x: (F.col(ts) >= x["start"]) & (F.col(ts) < x["end"]))
    return df.withColumn("_f", F.explode(hit)).select(*df.columns, F.col("_f.fold").alias("fold"), F.lit("test").alias("role"))


def train_part(df: DataFrame, ts: str, start) -> DataFrame:
    return df.where(F.col(ts) < F.lit(start))
