"""Span files as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import SPAN


def read_spans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Spans from Parquet or JSON files."""
    return spark.read.format(fmt).schema(SPAN).load(path)


def stream_spans(spark: SparkSession, path: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Spans from files as they arrive."""
    reader = spark.readStream.format(fmt).schema(SPAN)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
