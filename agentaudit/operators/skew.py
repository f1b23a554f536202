"""Numbering and joins that stay exact when one key holds a large share of the rows.

A plain ``row_number`` window puts every group into one task, and a join does the
same with the rows of one key. That is right for ordinary traces and wrong for a
trace with billions of spans. ``hot_keys`` finds such keys with a fixed-size sketch,
once per table; the helpers treat ordinary keys the plain way and spread the hot ones
they are told of. Without a list nothing runs ahead of the query: joins then rely on
the adaptive planner, which splits what was shuffled for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Groups above this many rows are not handed to a single task.
HOT_ROWS = 2_000_000
#: Items the sketch tracks. A key above 3.5 / TRACKED of all rows is always among
#: them, so an unseen key has fewer rows than that.
TRACKED = 65_536
#: The part of a row id that counts the rows of its partition.
ROWS_MASK = (1 << 33) - 1
#: Most keys that can be reported; bounds what reaches the driver.
REPORTED = 4_096


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> list:
    """Values of ``key`` with more than ``hot_rows`` rows (``HOT_ROWS`` if not given).

    One pass over one column with a frequent-items sketch: no shuffle of keys,
    and at most ``REPORTED`` values come back. Keep the list beside the table and
    pass it to every operator that reads it.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    top = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key")
    ).agg(F.expr(f"approx_top_k(_key, {REPORTED}, {TRACKED})").alias("_top"))
    rows = top.select(F.inline("_top")).where(F.col("count") > hot_rows).collect()
    return [r["item"] for r in rows]


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: list | None = None,
) -> DataFrame:
    """Join to a right side that has one row per key, whatever the keys on the left.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. Left rows of a
    hot key meet the one right row of that key by broadcast (at most ``REPORTED``
    rows, since the right side has each key once); all other rows join as usual.
    ``hot`` lists hot keys (see ``hot_keys``; several key columns are joined by a NUL).
    """
    keys = list(keys)
    key = F.concat_ws("\0", *keys) if len(keys) > 1 else F.col(keys[0]).cast("string")
    if not hot:
        return left.join(right, keys, how)
    is_hot = F.coalesce(key.isin(hot), F.lit(False))
    few = F.broadcast(right.where(is_hot))
    return left.where(~is_hot).join(right, keys, how).unionByName(
        left.where(is_hot).join(few, keys, how)
    )


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    out: str,
    hot: list | None = None,
) -> DataFrame:
    """Add ``out``: 1, 2, 3 … inside each group in the given order.

    ``hot`` lists hot values of ``group[0]`` (see ``hot_keys``). ``order`` should be a
    full sort key.
    """
    group = list(group)
    by_group = Window.partitionBy(*group).orderBy(*order)
    if not hot:
        return df.withColumn(out, F.row_number().over(by_group).cast("long"))
    is_hot = F.coalesce(F.col(group[0]).isin(hot), F.lit(False))
    plain = df.where(~is_hot).withColumn(out, F.row_number().over(by_group).cast("long"))
    return plain.unionByName(_number_by_range(df.where(is_hot), group, order, out))


def _number_by_range(
    df: DataFrame, group: list[str], order: Sequence[Column], out: str
) -> DataFrame:
    """Number rows through a total sort: place in the range + rows before it.

    One range shuffle spreads a hot group over many partitions. The row id of a
    sorted partition counts its rows, so no window is needed; what comes before
    a range is worked out on one row per range and group.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, df.count() // HOT_ROWS + 1)
    # Exact copies share the whole sort key; the row id lets the sort split them.
    key = [*[F.col(c) for c in group], *order, F.col("_copy")]
    ranged = cut(
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(parts, *key)
        .sortWithinPartitions(*key)
        .drop("_copy")
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(ROWS_MASK)))
    )
    before = (
        Window.partitionBy(*group).orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per range and group, so at most `parts` rows in any window.
    offsets = (
        ranged.groupBy("_range", *group)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
        .select("_shift", *[F.col(c).alias(f"_of_{c}") for c in ["_range", *group]])
    )
    if len(group) == 1:
        # Ranges are contiguous, so there are at most `parts` + REPORTED offsets.
        offsets = F.broadcast(offsets)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ["_range", *group]]
    return ranged.join(offsets, on=same, how="inner").select(
        *df.columns, (F.col("_place") + F.col("_shift")).cast("long").alias(out)
    )
