"""Text tables for the personal-data jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Files below this size may sit in one Parquet row group, thus in one task.
SMALL_BYTES = 128 << 20


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table of texts, spread over all cores.

    Pattern search costs far more than reading. A large table has row groups
    enough; a small one is dealt out to the cores first. Its size is that of the files,
    which Spark knows without a job.
    """
    table = spark.read.parquet(path)
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(size) < SMALL_BYTES:
        return table.repartition(spark.sparkContext.defaultParallelism)
    return table
