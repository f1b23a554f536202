"""Merged latency sketches against exact percentiles."""

import pytest
from pyspark.sql import functions as F

from agentaudit.operators import sketches
from agentaudit.plans import fixtures
from agentaudit.schema import RECORD
from agentaudit.sources import tables
from agentaudit.streaming import pipeline


def skewed(spark, n):
    """Durations over six orders of magnitude, with many ties and a hot key."""
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 7200).alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("op"), F.col("id") % 50)).alias("operation_name"),
        F.lit("m").alias("model_name"),
        F.floor(F.exp(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 72_000.0)).cast("int").alias("duration_ms"))


@pytest.mark.parametrize("size", [200, sketches.SIZE])
def test_rank_error_after_merging(spark, size):
    rows = skewed(spark, 1_000_000)
    merged = sketches.roll_up(sketches.sketches(rows, size=size), keys=["model_name"], size=size)
    qs = [0.01, 0.1, 0.5, 0.9, 0.95, 0.99, 0.999]
    found = merged.select("calls", "sketch", *[sketches.percentile(F.col("sketch"), q).alias(f"q{i}")
                                               for i, q in enumerate(qs)]).first()
    assert found.calls == 1_000_000 and len(found.sketch) < 25 * size
    # The exact ranks of what was found: at it, and just below it.
    exact = rows.agg(*[F.avg((F.col("duration_ms") <= found[f"q{i}"]).cast("int")).alias(f"to{i}") for i in range(len(qs))],
                     *[F.avg((F.col("duration_ms") < found[f"q{i}"]).cast("int")).alias(f"under{i}") for i in range(len(qs))]
                     ).first()
    bound = 3 * 1.65 / size
    for i, q in enumerate(qs):
        assert exact[f"under{i}"] - bound <= q <= exact[f"to{i}"] + bound


def test_small_groups_are_exact(spark, sf):
    records = fixtures.records(spark, sf)
    merged = sketches.with_percentiles(sketches.roll_up(sketches.sketches(records), "1 day"), qs=(0.25, 0.95))
    exact = records.where("duration_ms IS NOT NULL").groupBy(
        F.window("timestamp", "1 day").start.alias("window_start"), *sketches.KEYS).agg(
        F.count("duration_ms").alias("calls"), F.sort_array(F.collect_list("duration_ms")).alias("all"))
    rows = merged.join(exact, ["window_start", *sketches.KEYS]).collect()
    assert len(rows) == exact.count()
    for r in rows:
        at = lambda q: r.all[max(0, -int(-q * len(r.all) // 1) - 1)]  # noqa: B023,E731
        assert (r.p25_ms, r.p95_ms) == (at(0.25), at(0.95))
        assert (r.least, r.greatest) == (r.all[0], r.all[-1])
        assert abs(r.avg_ms - sum(r.all) / len(r.all)) < 1e-9


def test_levels_agree(spark):
    """Seconds into minutes into hours, or at once: the same counts, and percentiles within the bound."""
    windows = sketches.sketches(skewed(spark, 100_000), "10 seconds")
    steps = sketches.roll_up(sketches.roll_up(windows, "1 minute"), "1 hour", ["model_name"])
    once = sketches.roll_up(windows, "1 hour", ["model_name"])
    found = steps.select("window_start", "calls", sketches.percentile(F.col("sketch"), 0.9).alias("p")).collect()
    assert len(found) == 2
    for r in found:
        other = once.where(F.col("window_start") == r.window_start).select(
            "calls", sketches.share_within(F.col("sketch"), r.p).alias("share")).first()
        assert r.calls == other.calls and abs(other.share - 0.9) < 0.02


def test_nothing_gives_nothing(spark):
    records = skewed(spark, 10).withColumn("duration_ms", F.lit(None).cast("int"))
    windows = sketches.sketches(records)
    assert windows.count() == 0
    assert sketches.with_percentiles(sketches.roll_up(windows, "1 day")).count() == 0
    empty = sketches.roll_up(windows, keys=[]).select(sketches.percentile(F.col("sketch"), 0.5).alias("p"))
    assert [r.p for r in empty.collect()] == [None]


def test_stored_sketches_of_a_stream(spark, sf, tmp_path):
    path = str(tmp_path / "records")
    records = tables.conform(fixtures.records(spark, sf))
    later = records.limit(1).withColumn("timestamp", F.col("timestamp") + F.expr("interval 90 days"))
    records.unionByName(later).write.parquet(path)
    stream = spark.readStream.schema(RECORD).parquet(path).withWatermark("timestamp", "1 minute")
    query = pipeline.to_table(sketches.sketches(stream), str(tmp_path / "out"), str(tmp_path / "ck"), once=True)
    query.awaitTermination()
    assert query.exception() is None
    by_day = lambda windows: sorted(
        map(tuple, sketches.with_percentiles(sketches.roll_up(windows, "1 day")).collect()), key=repr)
    assert by_day(spark.read.parquet(str(tmp_path / "out"))) == by_day(sketches.sketches(records))
