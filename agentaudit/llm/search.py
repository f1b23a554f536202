"""Ranked lexical search of all documents for every item of a query set.

Documents are reduced to the items' vocabulary: the terms they share with it and how
often each occurs. Rows with the same terms, counts and length factor are one class:
grouped by hash and then by the values themselves, and scored once. A class keeps its k
smallest ids, since no more of them can be among an item's k best; the others are dropped
on the map side, so copies of one text never meet in one task. Tasks score classes in
numpy, against the items' postings, and hand on the k best classes of each item; their
members are expanded by ascending id and ranked.

Items come in blocks of at most ``ITEM_BYTES`` of text (one longer item stands alone);
only a block's terms and postings are broadcast, and documents are read once per block.

The weight of a term is floor(1000 * ln((2N + 2) / (2 df + 1))), its part in a document's
score weight * ((10**9 * tf) div (1000 * tf + SATURATION * m)), where m is
100 - LENGTH + (LENGTH * n * N) div L: integers throughout.

Defined results: a null text has no terms; a document or item without terms finds
nothing; every row of items is ranked for itself, repeated ones too; repeated documents
are documents of their own; null ids come after all others; of equal scores the smaller
id is first. Further columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored, words
from .wordcut import flat_bytes, from_offsets

ITEM_BYTES = 4 << 20
SLICE = 8 << 20
#: Scores and postings held at once.
CELLS = 2 << 20

# -- Fixed values ---------------------------------------------------------------
LENGTH = 75
SATURATION = 8
# -------------------------------------------------------------------------------

#: Digits, letters and all bytes beyond ASCII make terms; capitals of ASCII are lowered.
IN_TERM = np.full(256, 0x20, np.uint8)
for _c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    IN_TERM[_c] = _c
IN_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in order, and how many each text has."""
    data, offsets = flat_bytes(pc.fill_null(texts, ""))
    return words(from_offsets(IN_TERM[data], offsets, pa.string()), lower=False)


class Items:
    """Vocabulary and postings of one block of items."""

    def __init__(self, texts: list[str | None]):
        flat, per = terms(pa.array(texts, pa.string()))
        coded = flat.dictionary_encode()
        self.vocabulary, self.size = coded.dictionary, len(texts)
        codes = np.asarray(coded.indices, dtype=np.int64)
        key = codes * max(1, self.size) + np.repeat(np.arange(len(texts)), per)
        pairs, self.repeats = np.unique(key, return_counts=True)
        term, self.item = np.divmod(pairs, max(1, self.size))
        self.per_term = np.bincount(term, minlength=len(self.vocabulary))


def item_blocks(items: DataFrame, text_col: str, limit: int = ITEM_BYTES) -> tuple[DataFrame, int]:
    """``items`` with columns row (unique) and block, and the number of blocks."""
    rows = stored(items.select("*", F.monotonically_increasing_id().alias("__row")), "items")
    length = F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)).cast("long")
    blocks = 1
    while True:
        dealt = rows.withColumn("__block", F.pmod(F.xxhash64("__row"), F.lit(blocks)))
        most = dealt.groupBy("__block").agg(F.sum(length).alias("n"), F.count(F.lit(1)).alias("rows")).where(
            f"n > {limit} and rows > 1").limit(1).count()
        if not most:
            return dealt, blocks
        blocks *= 2


def bags(rows: DataFrame, vocabulary) -> DataFrame:
    """(id, n, terms, tfs): all terms of a row counted, those of the vocabulary listed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in slices(batches, "text", SLICE):
            flat, per = terms(batch.column("text"))
            codes = pc.index_in(flat, value_set=known)
            inside = np.asarray(codes.is_valid())
            row = np.repeat(np.arange(len(per)), per)[inside]
            keys, tfs = np.unique(row * len(known) + np.asarray(codes.drop_null(), dtype=np.int64), return_counts=True)
            row, term = np.divmod(keys, max(1, len(known)))
            ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(per)))), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (term, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(per, pa.int64()), *lists],
                                             names=["id", "n", "terms", "tfs"])

    ints = T.ArrayType(T.IntegerType())
    return rows.mapInArrow(run, T.StructType([
        rows.schema["id"], T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("tfs", ints)]))


def classes(found: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(m, terms, tfs, members) per class of equal bags; ``members`` are its k smallest ids in order."""
    m = F.expr(f"{100 - LENGTH}L + ({LENGTH}L * n * {n_docs}L) div {n_terms}L")
    rows = found.where("size(terms) > 0").select("id", m.alias("m"), "terms", "tfs").withColumn(
        "hash", F.xxhash64("m", "terms", "tfs"))
    same = ["hash", "m", "terms", "tfs"]
    rank = F.row_number().over(Window.partitionBy(same).orderBy(F.asc_nulls_last("id")))
    members = F.transform(F.sort_array(F.collect_list(F.struct("at", "id"))), lambda s: s["id"])
    return rows.withColumn("at", rank).where(F.col("at") <= k).groupBy(same).agg(members.alias("members")).drop("hash")


def best_classes(sent, weights, k: int):
    """The k best classes of every item among a task's rows: item, score, members."""

    def best(pool: pa.Table) -> pa.Table:
        first = pc.list_element(pool.column("members"), 0)
        order = np.lexsort((np.asarray(pc.rank(first, null_placement="at_end", tiebreaker="dense")),
                            -np.asarray(pool.column("score")), np.asarray(pool.column("item"))))
        item = np.asarray(pool.column("item"))[order]
        starts = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        return pool.take(pa.array(order[place < k]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value, np.asarray(weights.value)
        starts = np.cumsum(items.per_term) - items.per_term
        least, pool = np.zeros(items.size, np.int64), None
        for batch in batches:
            for part in _parts(batch, items):
                sizes = np.asarray(pc.list_value_length(part.column("terms")), dtype=np.int64)
                term, tf = (np.asarray(part.column(c).flatten(), dtype=np.int64) for c in ("terms", "tfs"))
                m = np.repeat(np.asarray(part.column("m")), sizes)
                value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m))
                row, many = np.repeat(np.arange(part.num_rows), sizes), items.per_term[term]
                at = np.arange(many.sum()) + np.repeat(starts[term] - (np.cumsum(many) - many), many)
                scores = np.zeros(part.num_rows * items.size, np.int64)
                np.add.at(scores, np.repeat(row * items.size, many) + items.item[at],
                          np.repeat(value, many) * items.repeats[at])
                scores = scores.reshape(part.num_rows, items.size)
                row, item = np.nonzero((scores >= least) & (scores > 0))
                if not len(row):
                    continue
                found = pa.table({"item": pa.array(item, pa.int32()), "score": pa.array(scores[row, item]),
                                  "members": part.column("members").take(pa.array(row))})
                pool = best(found if pool is None else pa.concat_tables([pool, found]))
                item, score = (np.asarray(pool.column(c)) for c in ("item", "score"))
                full = np.bincount(item, minlength=items.size) >= k
                lowest = np.full(items.size, np.iinfo(np.int64).max)
                np.minimum.at(lowest, item, score)
                least = np.where(full, lowest, 0)
        if pool is not None:
            yield from pool.combine_chunks().to_batches()

    return run


def _parts(batch: pa.RecordBatch, items: Items) -> Iterator[pa.RecordBatch]:
    """The batch cut so that neither scores nor postings of a part pass ``CELLS``; one row may."""
    ends = np.asarray(batch.column("terms").offsets, dtype=np.int64)
    term = np.asarray(batch.column("terms").flatten(), dtype=np.int64)
    postings = np.append(0, np.cumsum(items.per_term[term]))[ends - ends[0]]
    at, most = 0, max(1, CELLS // max(1, items.size))
    while at < batch.num_rows:
        fits = int(np.searchsorted(postings, postings[at] + CELLS, "right")) - 1
        end = min(batch.num_rows, at + most, max(fits, at + 1))
        yield batch.slice(at, end - at)
        at = end


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    dealt, blocks = item_blocks(asked, "text", item_bytes)
    parts = []
    for block in range(blocks):
        mine = dealt.where(F.col("__block") == block).select("__row", "text").orderBy("__row").collect()
        held = Items([r["text"] for r in mine])
        vocabulary = spark.sparkContext.broadcast(held.vocabulary)
        found = stored(bags(rows, vocabulary), "bags")
        n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs or not len(held.vocabulary):
            continue
        # One number per term of the block.
        df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))
                   for t in range(len(held.vocabulary))]
        scored = classes(found, n_docs, n_terms, k).mapInArrow(
            best_classes(spark.sparkContext.broadcast(held), spark.sparkContext.broadcast(weights), k),
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()),
                          T.StructField("members", T.ArrayType(rows.schema["id"].dataType))]))
        ranked = scored.select("item", "score", F.explode("members").alias("doc_id")).withColumn(
            "rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))
        names = spark.createDataFrame([(i, r["__row"]) for i, r in enumerate(mine)], "item int, __row long")
        parts.append(ranked.where(F.col("rank") <= k).join(F.broadcast(names), "item").drop("item"))
    if not parts:
        return rows.join(dealt, F.lit(False)).select("item_id", F.lit(1).alias("rank"), F.col("id").alias("doc_id"),
                                                      F.lit(0).cast("long").alias("score"))
    return reduce(DataFrame.unionAll, parts).join(dealt.select("__row", "item_id"), "__row").select(
        "item_id", "rank", "doc_id", "score")
