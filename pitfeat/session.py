"""Session helpers: the settings the operators rely on, and durable intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Time zone and adaptive execution settings every job of this package expects.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM leaves methods over 8000 bytes uncompiled; wide rows are faster operator by operator than in one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read, as the cluster names it in ``spark.checkpoint.dir``.

    A private folder is made only for a local master, where driver and executors are one process.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="pitfeat-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def step_dir(spark: SparkSession) -> str:
    """The folder of this application's stored steps."""
    return f"{shared_dir(spark)}/steps-{spark.sparkContext.applicationId}"


def drop_steps(spark: SparkSession) -> None:
    """Delete all steps that this application has stored. Results that still read them must have been written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(step_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, survives executor loss, and later readers still get column pruning.
    """
    spark = df.sparkSession
    path = f"{step_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
