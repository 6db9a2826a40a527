"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The white space of all contracts here: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(c: Column | str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_mod(c: Column | str, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; 0 for null."""
    return F.coalesce(F.crc32(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")) % n, F.lit(0))


def numbered(df: DataFrame, keys: list[str], most: int, name: str = "copy") -> DataFrame:
    """The rows with their number, from 1, among those of equal ``keys``; ``most``: the largest such number, known from a narrow table.

    Where no keys repeat, no rows are moved for it.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) if most > 1 else F.lit(1))


def same(pairs: dict[str, str]) -> Column:
    """Join condition: equal, nulls included."""
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs.items()])


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that no more than a slice of texts is held as Python objects."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def pieces(df: DataFrame, each: int, least: int | None = None) -> int:
    """Partitions of about ``each`` bytes for a stored table, by the size its plan states; at least ``least``, or else the session's number, which also holds where the size is unknown."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return usual if size >= 1 << 60 else max(usual if least is None else least, -(-size // each))
