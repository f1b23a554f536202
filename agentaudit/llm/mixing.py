"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed random order, are cut into blocks of equal
characters. With target share w/Q, block k (from 0) of a source is released at slot
floor(k*Q/w) and due by slot ceil((k+1)*Q/w). Every slot goes to the released block
with the earliest deadline, so that at any slot each source is less than one block away
from its target. The schedule repeats every Q slots; one period of it (Q is the sum of
the integer shares) places any number of blocks.

Every document keeps its place: after the first source runs out, the others go on in
their own slots; ``in_mix`` marks the slots up to there, where all targets hold.

Skew: documents are numbered inside (source, hash bucket) groups and shifted by the
totals of the buckets before, so that a source with a third of all rows is spread over
all buckets. Defined results: every source is a pool of its own, the missing one (null)
too, and one without a given share has the default share; a null text has no characters;
a source without rows takes no share; rows that agree in id and text are interchangeable;
an empty table stays empty. Shares that add up to more than ``MAX_PERIOD`` raise.
"""

from __future__ import annotations

import heapq
from math import ceil, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, stored

#: A source's target share can be as small as one part in this.
MAX_PERIOD = 1_000_000
#: Rows of a plan or of shares that are broadcast; longer ones are joined.
SENT_ROWS = 100_000
BUCKET_ROWS = 50_000
#: Shares by size: parts of the whole, and the power of a source's characters.
PARTS = 100
POWER = 0.5


def shares_by_size(docs: DataFrame, parts: int = PARTS, power: float = POWER, text_col: str = "text",
                   source_col: str = "source") -> dict[str | None, int]:
    """A target share for every source of ``docs``, in proportion to a power of its characters.

    A power below one gives small sources more than their part; each has one part at least.
    """
    chars = F.length(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    sizes = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("source")).agg(
        F.pow(F.sum(chars).cast("double"), F.lit(power)).alias("size"))
    found = [tuple(r) for r in sizes.limit(MAX_PERIOD + 1).collect()]  # a row per source
    if len(found) > MAX_PERIOD:
        raise ValueError(f"more than {MAX_PERIOD} sources")
    whole = sum(sorted(size for _, size in found)) or 1.0
    return {source: max(1, int(parts * size / whole + 0.5)) for source, size in found}


def period(shares: dict) -> list[tuple]:
    """(source, k, slot, release, deadline) for one period, earliest deadline first."""
    q = sum(shares.values())
    if q > MAX_PERIOD:
        raise ValueError(f"shares add up to {q}; at most {MAX_PERIOD}")
    order = sorted(shares, key=lambda s: (s is not None, s))
    weight = [shares[s] for s in order]

    def block(s: int, k: int) -> tuple[int, int, int, int]:
        return k * q // weight[s], -(-(k + 1) * q // weight[s]), s, k

    waiting, ready, out = [block(s, 0) for s in range(len(order))], [], []
    heapq.heapify(waiting)
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            release, deadline, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, k, release))
        deadline, s, k, release = heapq.heappop(ready)
        out.append((order[s], k, slot, release, deadline))
        heapq.heappush(waiting, block(s, k + 1))
    return out


def schedule(docs: DataFrame, shares: dict[str | None, int], default: int = 1, block_chars: int = 65_536,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             keep_rows: bool = False) -> DataFrame:
    """Per row: id, pool (its source), chars, block, release, deadline, slot, in_mix (and ``row``).

    ``shares`` are integers by source; a source it does not name has the share ``default``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    # A null source stays apart from any text.
    pool = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), pool.alias("pool"), F.length(text).cast("long").alias("chars"),
        key.alias("key"), *([packed(docs)] if keep_rows else []))

    totals = stored(rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n")), "pools")
    n_pools, n_rows = totals.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_pools > MAX_PERIOD:
        raise ValueError(f"more than {MAX_PERIOD} sources")
    digits = min(4, max(2, ceil(log(max(1, n_rows / BUCKET_ROWS), 16))))
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))

    # Characters in the buckets before: at most 16**digits rows for a source.
    sums = stored(rows.groupBy("pool", "bucket").agg(F.sum("chars").alias("sum")), "bucket-sums")
    offsets = stored(sums.selectExpr(
        "pool", "bucket", "sum(sum) over (partition by pool order by bucket) - sum as offset"), "offsets")
    numbered = rows.join(offsets, ["pool", "bucket"]).selectExpr(
        "*", "sum(chars) over (partition by pool, bucket order by key, chars rows unbounded preceding)"
        " - chars + offset as before")

    present = {}
    for (name,) in totals.select("pool").collect():  # a row per source
        present[name] = shares.get(name[1:] if name else None, default)
    one = [(source, present[source], *rest) for source, *rest in period(present)]
    q = max(1, len(one))
    plan = spark.createDataFrame(one, "pool string, share long, k long, place long, release0 long, deadline0 long")
    sent = F.broadcast if len(one) <= SENT_ROWS else (lambda df: df)
    weights = sent(plan.where("k = 0").select("pool", "share"))

    def on_plan(blocks: DataFrame) -> DataFrame:
        return (blocks.withColumn("block", F.expr(f"before div {block_chars}")).join(weights, "pool")
                .withColumns({"round": F.expr("block div share"), "k": F.expr("block % share")})
                .join(sent(plan.drop("share")), ["pool", "k"])
                .withColumn("slot", F.col("round") * q + F.col("place")))

    # The first source to run out ends the stretch in which all targets hold.
    last = stored(sums.groupBy("pool").agg(F.greatest(F.sum("sum") - 1, F.lit(0)).alias("before")), "last-blocks")
    end = on_plan(last).agg(F.min("slot")).first()[0]
    return on_plan(numbered).select(
        *(["row"] if keep_rows else []), "id",
        F.when(F.col("pool") != "", F.substring("pool", 2, 1 << 30)).alias("pool"), "chars", "block",
        (F.col("round") * q + F.col("release0")).alias("release"),
        (F.col("round") * q + F.col("deadline0")).alias("deadline"), "slot",
        (F.col("slot") <= F.lit(end)).alias("in_mix"))
