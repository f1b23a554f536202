"""Percentiles that merge: latency sketches stored per short window.

A window's durations become a KLL sketch of bounded size. Sketches of windows, agents or
days are merged into any coarser group without reading a record again, and give every
percentile. Up to ``SIZE`` values a sketch holds them all and its percentiles are exact;
beyond that the rank of a percentile is off by about 1.65 / SIZE of the values
(``tests/test_sketches.py`` measures it). A percentile is the smallest value whose rank
reaches it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values a sketch holds exactly; its size in bytes is at most about 25 times that.
SIZE = 1024
KEYS = ("operation_name", "model_name")
PERCENTILES = (0.5, 0.95, 0.99)


def sketches(records: DataFrame, width: str = "30 seconds", keys: Sequence[str] = KEYS, value: str = "duration_ms",
             size: int = SIZE) -> DataFrame:
    """Per window and keys: ``calls`` (values that are not NULL), their sum, least, greatest and ``sketch``.

    Partial sketches are built before the shuffle, so a hot key costs one sketch per task.
    Also works on a stream that has a watermark on ``timestamp``.
    """
    number = F.col(value).cast("long")
    out = records.where(number.isNotNull()).groupBy(F.window("timestamp", width).alias("w"), *keys).agg(
        F.count(number).alias("calls"), F.sum(number).alias("total"), F.min(number).alias("least"),
        F.max(number).alias("greatest"), F.kll_sketch_agg_bigint(number, F.lit(size)).alias("sketch"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "calls", "total", "least", "greatest", "sketch")


def roll_up(windows: DataFrame, width: str | None = None, keys: Sequence[str] = KEYS, size: int = SIZE) -> DataFrame:
    """Windows of sketches merged into windows of ``width`` (or one, without times) and into ``keys``.

    A day is ``"1 day"``. Windows must fit into the coarser ones.
    """
    group = [F.window("window_start", width).alias("w")] if width else []
    out = windows.groupBy(*group, *keys).agg(
        F.sum("calls").alias("calls"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("sketch"))
    start = [F.col("w.start").alias("window_start")] if width else []
    return out.select(*start, *keys, "calls", "total", "least", "greatest", "sketch")


def percentile(sketch: Column, q: float) -> Column:
    """The percentile ``q`` of a sketch; NULL if it is empty."""
    return F.when(F.kll_sketch_get_n_bigint(sketch) > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(q)))


def share_within(sketch: Column, value: int) -> Column:
    """The share of a sketch's values up to ``value``; NULL if it is empty."""
    return F.when(F.kll_sketch_get_n_bigint(sketch) > 0,
                  F.kll_sketch_get_rank_bigint(sketch, F.lit(value).cast("long")))


def with_percentiles(windows: DataFrame, qs: Sequence[float] = PERCENTILES, unit: str = "ms") -> DataFrame:
    """Windows with their mean and percentiles (``p95_ms``) in place of the sketch."""
    named = {f"p{q * 100:g}_{unit}".replace(".", "_"): percentile(F.col("sketch"), q) for q in qs}
    return windows.withColumns({f"avg_{unit}": F.col("total") / F.col("calls"), **named}).drop("sketch", "total")


def latency_alerts(windows: DataFrame, limit_ms: float, q: float = 0.99, width: str | None = None,
                   keys: Sequence[str] = ("agent_id",), size: int = SIZE) -> DataFrame:
    """Groups whose percentile of latency is above a limit, from stored sketches alone."""
    merged = roll_up(windows, width, keys, size).withColumn("latency_ms", percentile(F.col("sketch"), q))
    return merged.where(F.col("latency_ms") > limit_ms).drop("sketch", "total")
