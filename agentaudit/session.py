"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Audit times are UTC everywhere; day and hour truncation depend on it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more shuffle: one
    # trace may hold a large share of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows of a few megabytes reach a Python worker a few at a time.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # A look-up of up to a hundred ids reaches the Parquet reader, and so the Bloom filters.
    "spark.sql.parquet.pushdown.inFilterThreshold": "100",
    # Of repeated keys in a JSON payload the last one counts, as JSON readers commonly do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Spans of one session are merged before they meet their trace's task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; returns the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="agentaudit-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a reliable checkpoint.

    Used between rounds of iterative operators, so that plans stay small and a
    lost executor does not replay earlier rounds.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
