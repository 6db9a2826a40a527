"""Layer tables, text tables, snapshots and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pitfeat.operators.aggregates import dedupe_last
from pitfeat.operators.clean import valid_key
from pitfeat.session import durable

LAYERS = ("raw", "silver", "gold")


def not_there(error: AnalysisException) -> bool:
    """Whether the error says that the path does not exist; unreadable or half-written tables are another matter."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str, date_cols: Sequence[str] = ()) -> DataFrame:
    """Text table with a header and a given schema; the listed date columns are parsed, bad dates and numbers come out null.

    Columns are taken by name: those of the schema that the file lacks come out null, those that the schema lacks stay as text behind.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    text = spark.read.option("mode", "PERMISSIVE").csv(path, header=True)

    def column(f):
        if f.name not in text.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return (F.try_to_timestamp(F.col(f.name)) if f.name in date_cols else F.col(f.name).try_cast(f.dataType)).alias(f.name)

    return text.select(*[column(f) for f in wanted.fields], *[c for c in text.columns if c not in wanted.names])


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_layer(spark: SparkSession, root: str, layer: str, name: str, required: bool = True) -> DataFrame | None:
    """A layer table; an optional table that does not exist is ``None``."""
    try:
        return spark.read.parquet(layer_path(root, layer, name))
    except AnalysisException as e:
        if required or not not_there(e):
            raise
        return None


def write_layer(df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(layer_path(root, layer, name))


def write_csv(df: DataFrame, path: str, stamp: dt.datetime | None = None) -> str:
    """CSV export; with ``stamp`` the time becomes part of the name, so that earlier exports stay."""
    target = f"{path}_{stamp:%Y%m%d_%H%M%S}" if stamp else path
    df.write.mode("overwrite").csv(target, header=True)
    return target


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


# --- keyed updates: pure functions over tables -------------------------------------------------------------------

def upsert_last(existing: DataFrame | None, new: DataFrame, keys: Sequence[str], position: str, existing_unique: bool = False) -> DataFrame:
    """Stored rows with a new batch laid over them, the last row per key winning; rows without a proper key are dropped.

    ``position`` orders the rows of the batch. When stored keys are known to be unique, stored rows meet only the
    batch's keys in an anti-join, so a small batch does not shuffle the stored table.
    """
    batch = valid_key(new, *keys)
    if existing is None:
        return dedupe_last(batch, keys, [position])
    stored = valid_key(existing, *keys)
    if existing_unique:
        fresh = dedupe_last(batch, keys, [position])
        return stored.join(batch.select(*keys), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)
    both = (stored.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)), allowMissingColumns=True))
    return dedupe_last(both, keys, ["_batch", position]).drop("_batch")


def replace_table(new: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    return upsert_last(None, new, keys, position)


def insert_new(existing: DataFrame, new: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Only the batch rows whose key is not stored yet, one per key."""
    fresh = valid_key(new, *keys).join(existing.select(*keys), list(keys), "left_anti")
    return dedupe_last(fresh, keys, [position])


# --- stored snapshots --------------------------------------------------------------------------------------------

def save_snapshot(df: DataFrame, root: str, version: int) -> None:
    """Write a whole new version next to the older ones; readers move to it once the write has committed."""
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/version={version}")


def latest_version(spark: SparkSession, root: str) -> int | None:
    try:
        row = spark.read.parquet(root).agg(F.max("version").alias("v")).first()
    except AnalysisException as e:
        if not not_there(e):
            raise
        return None
    return row["v"]


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    version = latest_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root.rstrip('/')}/version={version}")


def upsert_table(spark: SparkSession, root: str, new: DataFrame, keys: Sequence[str], position: str) -> int:
    """Upsert a batch into a snapshot table and return the new version. Read errors are never taken for an empty table."""
    version = latest_version(spark, root)
    stored = None if version is None else spark.read.parquet(f"{root.rstrip('/')}/version={version}")
    out = upsert_last(stored, new, keys, position, existing_unique=True)
    save_snapshot(out.drop(position), root, (version or 0) + 1)
    return (version or 0) + 1


def append_new(spark: SparkSession, root: str, new: DataFrame, keys: Sequence[str], position: str) -> None:
    """Append rows with unseen keys. The rows are fixed first, since they depend on the table they are added to."""
    try:
        stored = spark.read.parquet(root)
    except AnalysisException as e:
        if not not_there(e):
            raise
        stored = new.limit(0)
    fresh = durable(insert_new(stored, new, keys, position))
    fresh.write.mode("append").parquet(root)


# --- run registry ------------------------------------------------------------------------------------------------

RUNS = "run_at timestamp, name string, path string, meta string"


def register_run(spark: SparkSession, registry: str, name: str, path: str, meta: str, run_at: dt.datetime) -> None:
    spark.createDataFrame([(run_at, name, path, meta)], RUNS).write.mode("append").parquet(registry)


def latest(df: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """The newest row per group."""
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.max_by(F.struct(*rest), at).alias("_r"))
    return best.select(*by, "_r.*")


def latest_run(spark: SparkSession, registry: str, name: str):
    return latest(spark.read.schema(RUNS).parquet(registry).where(F.col("name") == name), ["name"], "run_at").first()
