"""Ordered computations that stay parallel when one key holds a large share of the rows.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task. That is right for the usual key and wrong
for a key with billions of rows, or for no key at all. The operators here look at the row count per key first.
Keys below ``hot_rows`` take the plain window. Rows of the other keys are range-partitioned by (key, order), so that
each task holds one contiguous *block* of a key's history; totals of the earlier blocks are then joined onto the rows
of a block (running totals), or its last few rows are copied to the block that follows (bounded look-back).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitfeat.session import durable

# Rows of one key a single task may sort; larger keys are cut into blocks.
HOT_ROWS = 5_000_000

BLOCK = "_block"
BEFORE = "before"


def hot_keys(df: DataFrame, by: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most rows / hot_rows of them."""
    return df.groupBy(*by).count().where(F.col("count") > hot_rows).drop("count")


def no_hot_keys(frames: Sequence[DataFrame], by: Sequence[str], hot_rows: int) -> bool:
    """Whether no key is hot over several tables together."""
    return hot_keys(reduce(DataFrame.unionByName, [f.select(*by) for f in frames]), by, hot_rows).isEmpty()


def split_hot(df: DataFrame, by: Sequence[str], hot_rows: int | None) -> tuple[DataFrame | None, DataFrame | None]:
    """(usual rows, rows of hot keys); ``None`` for a part known to be empty. ``hot_rows=None`` vouches for no hot key."""
    if not by:
        return None, df
    if hot_rows is None:
        return df, None
    hot = hot_keys(df, by, hot_rows)
    if hot.isEmpty():
        return df, None
    hot = durable(hot)
    same = [df[c].eqNullSafe(hot[c]) for c in by]
    on = reduce(lambda a, b: a & b, same)
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def ordered_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], blocks: int | None = None, place: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Stamp rows with a block number that grows along (by, order) and never spans more than one task.

    The block number is the index of a range partition, so the result is written out: readers then agree on it. ``place`` adds the zero-based position of a row in its
    block, which stands for the order columns in what follows; ``keep`` names the columns that are written.
    """
    n = blocks or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n, *by, *order)
    stamps = [F.spark_partition_id().alias(BLOCK)]
    if place:
        ranged = ranged.sortWithinPartitions(*by, *order)
        stamps.append(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(place))
    return durable(ranged.select(*(df.columns if keep is None else keep), *stamps))


def _window(by: Sequence[str], order: Sequence[str | Column]):
    spec = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return spec.orderBy(*order)


def with_totals(blocked: DataFrame, totals: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join per-block figures onto the rows, null keys included."""
    keys = [*by, BLOCK]
    renamed = totals.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *[c for c in totals.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [blocked[c].eqNullSafe(renamed[f"_k_{c}"]) for c in keys])
    return blocked.join(renamed, on, how).drop(*[f"_k_{c}" for c in keys])


def _running(kind: str, value: Column, frame) -> Column:
    return {
        "count": lambda: F.count(value).over(frame),
        "sum": lambda: F.sum(value).over(frame),
        "max": lambda: F.max(value).over(frame),
        "min": lambda: F.min(value).over(frame),
        "product": lambda: F.product(value).over(frame),
        "last": lambda: F.last(value, ignorenulls=True).over(frame),
    }[kind]()


def _total(kind: str, value: Column) -> Column:
    # "last" needs an order inside the block, so its total is taken from the last row of the block
    return {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min, "product": F.product, "last": F.max}[kind](value)


def _combine(kind: str, before: Column, here: Column) -> Column:
    return {
        "count": lambda: F.coalesce(before, F.lit(0)) + here,
        "sum": lambda: F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here),
        "max": lambda: F.greatest(before, here),
        "min": lambda: F.least(before, here),
        "product": lambda: F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before * here),
        "last": lambda: F.coalesce(here, before),
    }[kind]()


def _rows(by: Sequence[str], order: Sequence[str | Column], end: int):
    return _window(by, order).rowsBetween(Window.unboundedPreceding, end)


def _inside(by: Sequence[str], order: Sequence[str | Column], totals: Mapping[str, tuple]) -> dict[str, Column]:
    # a third entry, BEFORE, leaves the current row out of the total
    return {n: _running(t[0], t[1], _rows(by, order, -1 if BEFORE in t[2:] else 0)) for n, t in totals.items()}


def running_in_blocks(blocked: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                      totals: Mapping[str, tuple]) -> DataFrame:
    """Running totals over rows already stamped by :func:`ordered_blocks`; the stamp is kept."""
    inside = _inside([*by, BLOCK], order, totals)
    totals = {n: t[:2] for n, t in totals.items()}
    here = blocked.select("*", *[c.alias(f"_here_{n}") for n, c in inside.items()])

    # the figure of a whole block: the running value on its last row, found with a bounded aggregate
    plain = {n: kv for n, kv in totals.items() if kv[0] != "last"}
    lasts = {n: kv for n, kv in totals.items() if kv[0] == "last"}
    aggs = [_total(kind, value).alias(f"_all_{n}") for n, (kind, value) in plain.items()]
    per_block = None
    if aggs:
        per_block = blocked.groupBy(*by, BLOCK).agg(*aggs)
    for n, (_, value) in lasts.items():
        backwards = [c.desc() if isinstance(c, Column) else F.col(c).desc() for c in order]
        one = (blocked.where(value.isNotNull())
               .withColumn("_rn", F.row_number().over(_window([*by, BLOCK], backwards)))
               .where("_rn = 1").select(*by, BLOCK, value.alias(f"_all_{n}")))
        base = per_block if per_block is not None else blocked.select(*by, BLOCK).distinct()
        per_block = with_totals(base, one, by)
    earlier = _window(by, [BLOCK]).rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select(
        *by, BLOCK,
        *[_running("sum" if kind == "count" else kind, F.col(f"_all_{n}"), earlier).alias(f"_before_{n}")
          for n, (kind, _) in totals.items()],
    )
    joined = with_totals(here, before, by)
    return joined.select(
        *blocked.columns,
        *[_combine(kind, F.col(f"_before_{n}"), F.col(f"_here_{n}")).alias(n) for n, (kind, _) in totals.items()],
    )


def running_small(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], totals: Mapping[str, tuple]) -> DataFrame:
    """Running totals of keys known to fit a task: the plain window."""
    return df.select("*", *[c.alias(n) for n, c in _inside(by, order, totals).items()])


def running(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], totals: Mapping[str, tuple],
            hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Running totals from the first row of a key up to the current row.

    ``totals`` maps a new column to (kind, value), kind being count, sum, max, min, product or last (last non-null).
    A third entry ``BEFORE`` leaves the current row out.
    ``order`` must order the rows of a key totally. With an empty ``by`` the whole table is one history.
    """
    usual, hot = split_hot(df, by, hot_rows)
    parts = []
    if usual is not None:
        parts.append(running_small(usual, by, order, totals))
    if hot is not None:
        parts.append(running_in_blocks(ordered_blocks(hot, by, order), by, order, totals).drop(BLOCK))
    return reduce(DataFrame.unionByName, parts)


def with_history(df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """Cut each key into blocks and give every block copies of the ``rows`` rows before it.

    Adds the block stamp, ``_copy`` (true for the copies) and ``_start`` (position in the key of the first row shown
    in the block, copies included). Windows that look back at most ``rows`` rows are then exact within a block.
    """
    blocked = ordered_blocks(df, by, order)
    sizes = blocked.groupBy(*by, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    along = _window(by, [BLOCK])
    spans = sizes.withColumn("_end", F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.withColumn("_first", F.col("_end") - F.col("_n"))
    # every block has a row, so at most ``rows`` later blocks can look back into this one
    later = F.collect_list(F.struct(F.col(BLOCK).alias("block"), F.col("_first").alias("first")))
    spans = spans.withColumn("_later", later.over(along.rowsBetween(1, rows)))
    spans = spans.withColumn("_later", F.filter("_later", lambda x: x["first"] - F.col("_end") < rows))

    backwards = [F.col(c).desc() for c in order]
    tails = (blocked.withColumn("_from_end", F.row_number().over(_window([*by, BLOCK], backwards)))
             .where(F.col("_from_end") <= rows))
    tails = with_totals(tails, spans.select(*by, BLOCK, "_end", "_later"), by, "inner")
    reach = F.filter("_later", lambda x: F.col("_from_end") + x["first"] - F.col("_end") <= rows)
    copies = (tails.withColumn("_to", F.explode(reach))
              .withColumn(BLOCK, F.col("_to.block"))
              .select(*blocked.columns, F.lit(True).alias("_copy")))
    both = blocked.withColumn("_copy", F.lit(False)).unionByName(copies)
    starts = spans.select(*by, BLOCK, (F.col("_first") - F.least(F.lit(rows), F.col("_first"))).alias("_start"))
    return with_totals(both, starts, by)


def time_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Zero-based position of each row in the total order of the whole table, without a single-task window.

    Rows move once: their places are taken while the blocks are written, and the driver adds up one count per block.
    """
    placed = ordered_blocks(df, [], order, place=name)
    sizes = {r[BLOCK]: r["count"] for r in placed.groupBy(BLOCK).count().collect()}
    firsts = [0, *accumulate(sizes.get(k, 0) for k in range(max(sizes, default=0)))]
    return placed.select(*df.columns, (F.get(F.array(*[F.lit(n).cast("long") for n in firsts]), F.col(BLOCK)) + F.col(name)).alias(name))


def ordinal(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "ordinal", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Zero-based position of each row within its key."""
    return running(df, by, order, {name: ("count", F.lit(1))}, hot_rows).withColumn(name, F.col(name) - 1)
