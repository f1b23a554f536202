"""Benchmark decontamination by a broadcast set of hashed test n-grams.

Every benchmark item gives its windows of ``n`` consecutive words; a shorter item is
one window. The set of window hashes is broadcast when its row count is within
``broadcast_rows`` (about 200 bytes a row); a larger set goes through Spark's ordinary
join on the hash. All windows of every document are scanned against it, hits are
verified word by word, and spans or whole documents are removed.

All steps are DataFrame expressions. A document's windows are exploded, joined and
filtered inside one stage; only one row per document and its hits reach the shuffle.

Defined results: null or wordless texts have no words and no hits; an empty benchmark
marks nothing; equal items, also repeated rows of one item, are listed once by id; a null item id
counts as the text ``null``. Further columns of the documents are ignored by ``scan``
and kept by ``remove_documents`` and ``remove_spans``.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored, text_of

#: Characters between words, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(normalised(text), SEPARATORS), "")


def window_hash(words: Column, start: Column | int, length: int) -> Column:
    """Hash of ``length`` words from ``start``, without building the window."""
    return F.xxhash64(*[F.get(words, F.lit(start) + k if isinstance(start, int) else start + k)
                        for k in range(length)])


def grams(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the benchmark: words, length, and the items they occur in."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("item"),
        words_of(text_of(text_col)).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(n))
    windows = items.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1),
        lambda i: F.slice("words", i, size))).alias("gram"))
    return windows.groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def windows_of(words: Column, length: int) -> Column:
    """Hashes of all windows of one length."""
    starts = F.sequence(F.lit(0), F.size(words) - length)
    return F.when(F.size(words) >= length,
                  F.transform(starts, lambda i: window_hash(words, i, length))
                  ).otherwise(F.array().cast("array<bigint>"))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
         text_col: str = "text", keep: Column | None = None,
         broadcast_rows: int = 2_000_000) -> DataFrame:
    """One row per document: id, n_words, hits (start, length) and items.

    ``keep`` is a further column to carry along as ``kept``.
    """
    known = stored(grams(benchmark, n), "grams")
    lengths = sorted(r[0] for r in known.select(F.size("gram")).distinct().collect())  # 1 to n
    hashed = known.withColumn("hash", reduce(
        lambda rest, k: F.when(F.size("gram") == k, window_hash(F.col("gram"), 0, k)).otherwise(rest),
        lengths, F.lit(None).cast("bigint")))
    if known.count() <= broadcast_rows:
        hashed = F.broadcast(hashed)

    worded = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").alias("id"),
        (F.lit(None) if keep is None else keep).alias("kept"),
        words_of(text_of(text_col)).alias("words"))
    arrays = [windows_of(F.col("words"), k) for k in lengths] or [F.array().cast("array<bigint>")]
    exploded = worded.select("row_id", "id", "kept", "words", F.posexplode_outer(F.concat(*arrays)).alias("at", "hash"))

    # Windows of the first length come first, then those of the next.
    start, length, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for k in lengths:
        inside = F.col("at") >= before
        start, length = F.when(inside, F.col("at") - before).otherwise(start), F.when(inside, k).otherwise(length)
        before = before + F.greatest(F.size("words") - k + 1, F.lit(0))
    same = F.col("gram") == F.slice("words", F.col("start") + 1, F.col("length"))
    met = (
        exploded.join(hashed, "hash", "left")
        .where(F.col("gram").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))
        .withColumn("start", start).withColumn("length", length)
        .select("row_id", "id", F.size("words").alias("n_words"),
                # Once per document, not once per hit.
                F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, F.col("kept")).alias("kept"),
                F.when(same, F.struct("start", "length")).alias("hit"),
                F.when(same, F.col("items")).alias("items"))
    )
    return met.groupBy("row_id").agg(
        F.first("id").alias("id"), F.first("kept", ignorenulls=True).alias("kept"), F.first("n_words").alias("n_words"),
        F.sort_array(F.collect_set("hit")).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(hits: Column) -> Column:
    """Number of words under sorted (start, length) hits."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def step(acc, hit):
        end = F.greatest(acc["end"], hit["start"] + hit["length"])
        return F.struct(end.alias("end"),
                        (acc["total"] + end - F.greatest(acc["end"], hit["start"])).alias("total"))

    return F.aggregate(hits, state, step, lambda acc: acc["total"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    found = scan(docs, benchmark, n, keep=packed(docs), **options)
    return found.where(F.size("hits") == 0).select("kept.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Each row of ``docs`` as struct ``row``, and ``clean_words`` outside all benchmark windows."""
    found = scan(docs, benchmark, n, id_col, text_col, keep=packed(docs))
    words = words_of(F.coalesce(F.col(f"kept.`{text_col}`").cast("string"), F.lit("")))
    clean = F.filter(words, lambda w, i: ~F.exists(
        "hits", lambda h: (h["start"] <= i) & (i < h["start"] + h["length"])))
    return found.select(F.col("kept").alias("row"), clean.alias("clean_words"))
