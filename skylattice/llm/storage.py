"""Shared folders for intermediate tables.

Executors and the driver share only the folder named by
``spark.checkpoint.dir``.  Every intermediate result goes there, as a Parquet
table, so that a lost executor costs one task and never a whole job.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where a session on one machine names no shared folder, as in tests.
LOCAL_FALLBACK = "file:///tmp/skylattice-work"
#: With it, the shuffle files of a job are deleted when the job ends.
CLEAN_SHUFFLES = "spark.sql.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared folder; a cluster has to name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"{(base or LOCAL_FALLBACK).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def save(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Writes df to path and reads it back: what follows no longer depends on df's lineage, so its shuffle files go at once."""
    spark = df.sparkSession
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate folder that no later step reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def column_bytes(df: DataFrame, column: str) -> int:
    """Total bytes of a string column: sizes blocks and buckets by the data, not by a guess."""
    from pyspark.sql import functions as F

    row = df.agg(F.sum(F.octet_length(F.col(column)).cast("long")).alias("b")).head()
    return int(row["b"] or 0)
