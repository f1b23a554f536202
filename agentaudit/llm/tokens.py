"""Token counts from flat token files without an index.

A flat file is a run of 16-bit token ids; every document ends in the end-of-document id.
``write_flat`` makes such files. ``count`` cuts them into blocks, finds the separators of
each block with one vectorised search, and stitches the documents that cross block ends
by a prefix scan (running sum and running maximum) over the blocks of a file.

Files are written one run per input partition, at most ``FILE_ROWS`` documents in a file,
so neither a task nor a prefix scan sees more than one partition. Defined results: a null
text is empty and has no tokens; tokens after the last separator form a last document
without end; an empty file has no documents; repeated rows are documents of their own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored

# -- Fixed values ---------------------------------------------------------------

#: How the byte-level vocabulary cuts a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50_256
# -------------------------------------------------------------------------------

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
FILE_ROWS = 10_000
BLOCK_TOKENS = 1 << 20


def encoder(lines: bytes):
    """A tokenizer from the lines of a rank file (base64 bytes and rank)."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_flat(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END,
               id_col: str = "doc_id", text_col: str = "text", plain_scan: bool = False) -> DataFrame:
    """Write the token files of ``docs`` under ``path``; gives (part, ordinal, id) of every document.

    The files carry no ids; a document is known by its partition and its place there.
    Both are read off ``docs`` again, which therefore must be a file scan without further
    steps (``plain_scan``); any other table is stored first.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if not plain_scan:
        docs = stored(docs, "texts")
    with open(vocabulary, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())  # the vocabulary, about a megabyte

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(lines.value).encode_ordinary
        for batch in slices(batches, "text", 4 << 20):
            data = [np.array(encode(t.as_py() or ""), "<u2").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["tokens"])

    # The text sink writes bytes as they are and ends each row in the separator, which
    # here is the end-of-document id itself.
    separator = int(end).to_bytes(2, "little").decode("latin-1")
    (docs.select("text").mapInArrow(tokenise, "tokens binary").select(F.col("tokens").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", separator)
     .option("maxRecordsPerFile", FILE_ROWS).text(path))
    return docs.select(
        F.spark_partition_id().cast("long").alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("ordinal"), "id")


def block_rows(end: int = END, block_tokens: int = BLOCK_TOKENS):
    """Per block: its tokens, separators, tokens before the first and after the last one, and between."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tokens = np.frombuffer(batch.column("content")[row].as_buffer(), "<u2")
                found = []
                for block, at in enumerate(range(0, len(tokens), block_tokens)):
                    part = tokens[at:at + block_tokens]
                    ends = np.flatnonzero(part == end)
                    head, tail = (ends[0], len(part) - 1 - ends[-1]) if len(ends) else (0, len(part))
                    found.append((block, len(part), len(ends), int(head), int(tail), np.diff(ends) - 1))
                if found:
                    number, n, seps, head, tail, inner = zip(*found)
                    part, file = (pa.array([batch.column(c)[row].as_py()] * len(found), pa.int64())
                                  for c in ("part", "file"))
                    yield pa.RecordBatch.from_arrays(
                        [part, file, *(pa.array(v, pa.int64()) for v in (number, n, seps, head, tail)),
                         pa.array(list(inner), pa.list_(pa.int64()))],
                        names=["part", "file", "block", "n", "ends", "head", "tail", "inner"])
    return run


def count(spark: SparkSession, path: str, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(part, ordinal, n_tokens) of every document in the flat files under ``path``.

    ``part`` is the number in a file's name, ``ordinal`` the document's place in the
    files of that part.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("part"),
        F.coalesce(F.regexp_extract("path", r"-c(\d+)[.]", 1).try_cast("long"), F.lit(0)).cast("long").alias("file"),
        "content")
    blocks = files.mapInArrow(block_rows(end, block_tokens), "part long, file long, block long, n long, ends long,"
                              " head long, tail long, inner array<bigint>")
    # Prefix scan: tokens before, documents before, and where the last document ended.
    order = "over (partition by part order by file, block rows between unbounded preceding and 1 preceding)"
    placed = blocks.selectExpr("*", f"coalesce(sum(n) {order}, 0) as begin", f"coalesce(sum(ends) {order}, 0) as before")
    scanned = placed.selectExpr(
        "*", f"coalesce(max(if(ends > 0, begin + n - tail, 0)) {order}, 0) as open",
        "max(struct(file, block)) over (partition by part) = struct(file, block) as is_last")
    whole = F.when(F.col("ends") > 0, F.concat(F.array(F.col("begin") + F.col("head") - F.col("open")), "inner")
                   ).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("begin") + F.col("n") - F.col("open"))
    sizes = F.when(F.col("is_last") & (rest > 0), F.concat(whole, F.array(rest))).otherwise(whole)
    return scanned.select("part", "before", F.posexplode(sizes).alias("at", "n_tokens")).select(
        "part", (F.col("before") + F.col("at")).alias("ordinal"), "n_tokens")


def named(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(id, n_tokens); fails if files and manifest disagree."""
    agree = F.col("n_tokens").isNotNull() & F.coalesce(F.col("known"), F.lit(False))
    both = counts.join(manifest.withColumn("known", F.lit(True)), ["part", "ordinal"], "full")
    return both.where(F.assert_true(agree, "files and manifest differ").isNull()).select("id", "n_tokens")
