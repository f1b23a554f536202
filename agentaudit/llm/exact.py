"""Exact deduplication over a stream whose keyed state never expires.

Arriving rows are reduced to digest, stable identifier and content locator (file and
row). A streaming aggregation keeps one entry per digest in RocksDB state, without a
watermark, so nothing is ever forgotten; the state is checkpointed in the shared
folder and grows by one small entry per distinct text. A digest that was seen more
than once is a hit: the full texts are then compared with the text at the keeper's
locator, and rows that differ (digests that collide) are grouped by their whole text.

Only texts that may be hits are shuffled: the repeated digests set bits in a bitmap of
fixed size (``SIFT_BITS``, 8 MB), which is broadcast and sifts the rows while they are
read. Where there are too many repeated digests for it, it lets more rows pass, and the
join after it decides as before.

Skew: the aggregation combines before its shuffle, and the comparison is a plain
equi-join of two scans, which adaptive execution splits for a hot digest.

Defined results: a null text counts as empty; a null id is smaller than any other; of
rows with equal text and equal id the one later in (file, row) order stays; an empty
table gives an empty result. Other columns are carried in ``row`` untouched, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import folder, packed, stored

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share this much memory; the rest is on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Otherwise every store reserves megabytes of disk ahead, however little it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

#: Bits of the bitmap that tells which digests may be repeated; an eighth as many bytes are
#: broadcast. On 0.5 GB of documents it cuts the texts that are shuffled from 583 to 70 MB.
SIFT_BITS = 1 << 26


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(docs: DataFrame, plain_scan: bool) -> DataFrame:
    """Each row packed into ``row``, with its file and its place in that file.

    ``plain_scan`` says that ``docs`` is a file scan without further steps, whose file
    names and row numbers are the locators; any other table is landed first.
    """
    if not plain_scan or "_metadata" in docs.columns or not docs.inputFiles():
        docs = stored(docs.select(packed(docs)), "landed")
    else:
        docs = docs.select(packed(docs), "_metadata")
    return docs.select("row", F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("place"))


def remember(arrivals: DataFrame, checkpoint: str) -> None:
    """Take a stream of (digest, id, file, place) into the state under ``checkpoint``.

    Runs until all that has arrived is taken in; a later call goes on with the same
    state. The number of state partitions is fixed by the first call.
    """
    state = arrivals.groupBy("digest").agg(
        F.max(F.struct("id", "file", "place")).alias("keeper"), F.count(F.lit(1)).alias("n"))
    with _settings(arrivals.sparkSession, STATE):
        query = (state.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def recall(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state: one row per digest with its keeper and the number of rows seen."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.digest").alias("digest"), F.col("value.max").alias("keeper"),
                        F.col("value.count").alias("n"))


def sifted(rows: DataFrame, digests: DataFrame, bits: int = SIFT_BITS) -> DataFrame:
    """The rows whose ``digest`` may be among ``digests``; all that are, and few others."""
    place = F.pmod(F.xxhash64("digest"), F.lit(bits))
    bitmap = digests.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))  # bits / 8 bytes at most
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.join(F.broadcast(bitmap), F.col("part") == F.bitmap_bucket_number(place))
        .where(byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position("
                                      f"pmod(xxhash64(digest), {bits}L)) % 8 as int))")) != 0)
        .drop("part", "bitmap"))


def members(places: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            digest: Callable[[Column], Column] = sha256,
            files_per_batch: int | None = None) -> DataFrame:
    """One row per located row: file, place, id, digest, keep_id, group_size, kept.

    ``digest`` can be replaced, for instance to test collisions. ``files_per_batch``
    bounds what one micro-batch takes in.
    """
    spark = places.sparkSession
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    rows = places.select(F.col(f"row.`{id_col}`").alias("id"), "file", "place",
                         digest(text).alias("digest"), text.alias("text"))

    arrivals_path = folder(spark, "arrivals")
    rows.drop("text").write.parquet(arrivals_path)
    schema = rows.drop("text").schema
    arrivals = spark.read.schema(schema).parquet(arrivals_path)
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    checkpoint = folder(spark, "digests")
    remember(stream.parquet(arrivals_path), checkpoint)
    seen = recall(spark, checkpoint)

    # Hits: full texts beside the text at the keeper's locator.
    is_keeper = ((F.col("file") == F.col("keeper.file"))
                 & (F.col("place") == F.col("keeper.place")))
    repeated = stored(seen.where("n > 1"), "repeated")
    hits = stored(sifted(rows, repeated).join(repeated, "digest").withColumn("is_keeper", is_keeper), "hits")
    keepers = hits.where("is_keeper").select("digest", F.col("text").alias("keep_text"))
    odd = stored(
        hits.join(keepers, "digest").where(F.col("text") != F.col("keep_text"))
        .select("digest", "id", "file", "place", "text"), "odd")

    # Colliding digests: these rows form groups of their own, by whole text.
    classes = odd.groupBy("digest", "text").agg(
        F.max(F.struct("id", "file", "place")).alias("odd_keeper"), F.count(F.lit(1)).alias("odd_n"))
    odd_rows = stored(
        odd.join(classes, ["digest", "text"]).select("file", "place", "odd_keeper", "odd_n"),
        "odd-rows")
    odd_totals = stored(odd.groupBy("digest").agg(F.count(F.lit(1)).alias("away")), "odd-totals")

    found = (
        arrivals.join(seen, "digest")
        .join(odd_totals, "digest", "left")
        .join(odd_rows, ["file", "place"], "left")
        .withColumn("keeper", F.coalesce("odd_keeper", "keeper"))
    )
    return found.select(
        "file", "place", "id", "digest", F.col("keeper.id").alias("keep_id"),
        F.coalesce(F.col("odd_n"), F.col("n") - F.coalesce("away", F.lit(0))).alias("group_size"),
        is_keeper.alias("kept"),
    )


def without(places: DataFrame, dropped: DataFrame) -> DataFrame:
    """The located rows that are not among ``dropped``, with their own columns."""
    return places.join(stored(dropped.select("file", "place"), "dropped"),
                       ["file", "place"], "left_anti").select("row.*")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                plain_scan: bool = False, **options) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; columns unchanged."""
    places = located(docs, plain_scan)
    return without(places, members(places, id_col, text_col, **options).where("NOT kept"))
