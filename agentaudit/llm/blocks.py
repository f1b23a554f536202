"""Texts as blocks of word numbers, each with a word list of its own.

A block holds consecutive documents of one input partition, about ``BLOCK_WORDS`` words
or one longer document. What concerns words is then done once per word and block, and
only (block, word) rows meet in shuffles, not the word occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW_GROUP, folder, slices, words

BLOCK_WORDS = 1 << 19
#: Blocks are rows of a few megabytes; a Python worker gets few of them at a time.
ARROW_BYTES = "16m"
SLICE = 4 << 20


def pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers as four byte planes, which compress far better than the numbers."""
    return np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def encode(rows: DataFrame, lower: bool, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``rows`` (id, text, held) as blocks.

    Columns: block, ids, held, lens (words per document), tokens (packed places in
    ``words``), words, train (occurrences of each word in documents not held).
    """
    id_type = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, parts, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            for part in slices(iter([batch]), "text", SLICE):
                flat, lens = words(part.column("text"), lower)
                parts.append((part.column("id"), part.column("held"), lens, flat))
                size += len(flat)
                if size >= block_words:
                    yield block(base + made, parts)
                    made, parts, size = made + 1, [], 0
        if parts:
            yield block(base + made, parts)

    def block(number: int, parts: list) -> pa.RecordBatch:
        ids, held = (pa.chunked_array([p[i] for p in parts]).combine_chunks() for i in (0, 1))
        lens = np.concatenate([p[2] for p in parts])
        coded = pa.chunked_array([p[3] for p in parts], pa.string()).combine_chunks().dictionary_encode()
        tokens = np.asarray(coded.indices, dtype=np.int64)
        counted = np.repeat(~np.asarray(held, dtype=bool), lens)
        train = np.bincount(tokens[counted], minlength=len(coded.dictionary))
        one = lambda array: pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one(ids), one(held), one(pa.array(lens, pa.int32())),
             pa.array([pack(tokens)], pa.binary()), one(coded.dictionary), one(pa.array(train, pa.int32()))],
            names=["block", "ids", "held", "lens", "tokens", "words", "train"])

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("lens", T.ArrayType(T.IntegerType())),
        T.StructField("tokens", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType())),
        T.StructField("train", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written once, dealt by ``key``, so that later joins on it move only the other side."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    name = f"blocks_{uuid4().hex}"
    (df.write.option("path", folder(spark, "blocks")).option("compression", "zstd")
     .option("parquet.block.size", ROW_GROUP)
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(name))
    return spark.table(name)


def repeated(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Of (keys, tag, out) rows those whose key occurs twice or more: block and ``out``.

    ``tag`` is twice the block, plus one if the key occurs several times there. A block
    sends a key once, so a key has at most as many rows as there are blocks.
    """
    n = f"count(1) over (partition by {', '.join(keys)})"
    return (rows.selectExpr("*", f"{n} as n").where("n > 1 or tag % 2 = 1")
            .select(F.expr("shiftright(tag, 1)").alias("block"), out))
