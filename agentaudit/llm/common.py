"""Shared folders, stored tables and words, used by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Row groups of stored tables with large rows, so that a reader's batch stays small.
ROW_GROUP = 32 << 20


def folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str, row_group: int = ROW_GROUP, check_rows: int = 100) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there.

    The writer looks at the size of a row group every ``check_rows`` rows at the earliest;
    what it holds, and what a reader takes at once, may be that many rows.
    """
    path = folder(df.sparkSession, name)
    (df.write.option("compression", "zstd").option("parquet.block.size", row_group)
     .option("parquet.page.size.row.check.min", check_rows).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, name: str = "row") -> Column:
    """All columns of a row as one struct, safe from clashes with an operator's own names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def text_of(column: str) -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts, and how many each text has.

    ``lower`` maps A-Z to a-z first. Both run in Arrow, over whole batches.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)  # the split leaves empty ends
    starts = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(lists)))))
    kept = np.concatenate(([0], np.cumsum(np.asarray(real, dtype=np.int64))))
    return flat.filter(real), np.diff(kept[starts.astype(np.int64)])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = np.cumsum(np.asarray(size, dtype=np.int64)) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
