"""Cost, latency and token aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import in_range


def tokens() -> F.Column:
    """Input plus output tokens; a missing count is 0."""
    return F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))


def _per_agent(*extra):
    return [
        F.count(F.lit(1)).alias("invocations"),
        F.sum("cost_usd").alias("total_cost"),
        F.avg("duration_ms").alias("avg_latency_ms"),
        *extra,
    ]


def cost_attribution(records: DataFrame, start, end) -> DataFrame:
    """Cost, calls, latency and tokens per agent name; costliest first."""
    return (
        in_range(records, start, end)
        .groupBy("agent_name")
        .agg(*_per_agent(F.sum(tokens()).alias("total_tokens")))
        .orderBy(F.desc_nulls_first("total_cost"), "agent_name")
    )


def cost_hourly(records: DataFrame) -> DataFrame:
    """Cost per agent and hour; a record that lacks a token count adds no tokens."""
    return (
        records.groupBy("agent_name", F.date_trunc("hour", "timestamp").alias("hour"))
        .agg(*_per_agent(F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens")))
        .orderBy(F.desc_nulls_first("total_cost"), "agent_name", "hour")
    )


def cost_since(records: DataFrame, now, hours: int = 24) -> DataFrame:
    """Cost and latency per agent over the last hours before ``now``."""
    until = F.lit(now).cast("timestamp")
    since = until - F.make_dt_interval(hours=F.lit(hours))
    recent = records.where((F.col("timestamp") > since) & (F.col("timestamp") <= until))
    if "date" in records.columns:
        recent = recent.where(F.col("date").between(since.cast("date"), until.cast("date")))
    return (
        recent.groupBy("agent_name").agg(*_per_agent())
        .orderBy(F.desc_nulls_first("total_cost"), "agent_name")
    )


def version_compare(records: DataFrame) -> DataFrame:
    """Cost, latency and error rate per agent version and configuration."""
    return records.groupBy("agent_name", "agent_version", "config_hash").agg(
        *_per_agent(
            F.count_if(F.col("status") == "error").alias("errors"),
            F.avg((F.col("status") == "error").cast("int")).alias("error_rate"),
        )
    )


def cost_spikes(records: DataFrame, hours: int = 24, sigmas: float = 2.0) -> DataFrame:
    """Hourly cost per agent against the hours before; flags unusual hours.

    Hours without calls between an agent's first and last one count as hours without
    cost. The windows run over hourly sums, so their input has one row per agent and hour.
    """
    hourly = records.groupBy(
        "agent_name", F.date_trunc("hour", "timestamp").alias("hour")
    ).agg(F.sum("cost_usd").alias("cost"))
    one = F.expr("interval 1 hour")
    following = F.lead("hour").over(Window.partitionBy("agent_name").orderBy("hour"))
    # Every hour is followed by the quiet ones up to the next.
    until = hourly.withColumn("called", F.col("hour")).withColumn("until", F.coalesce(following - one, "hour"))
    every = until.withColumn("hour", F.explode(F.sequence("called", "until", one))).drop("until")
    busy = F.col("hour") == F.col("called")
    cost = F.when(busy, F.col("cost").cast("double")).otherwise(0.0)
    before = Window.partitionBy("agent_name").orderBy("hour").rowsBetween(-hours, -1)
    return flag_spikes(every, cost, before, sigmas).where(busy).drop("called")


def error_spikes(records: DataFrame, hours: int = 24, sigmas: float = 2.0) -> DataFrame:
    """Hourly error rate per agent against the hours before; flags unusual hours.

    An hour without calls has no rate; the hours before are those on the clock.
    """
    failed = (F.col("status") == "error").cast("int")
    hourly = records.groupBy(
        "agent_name", F.date_trunc("hour", "timestamp").alias("hour")
    ).agg(F.count(F.lit(1)).alias("calls"), F.avg(failed).alias("error_rate"))
    before = (Window.partitionBy("agent_name").orderBy(F.col("hour").cast("long"))
              .rangeBetween(-hours * 3600, -3600))
    return flag_spikes(hourly, F.col("error_rate"), before, sigmas)


def flag_spikes(df: DataFrame, value, before, sigmas: float) -> DataFrame:
    """Add mean and spread over the window ``before``, and whether a row is above."""
    return df.withColumns({
        "baseline": F.avg(value).over(before),
        "spread": F.stddev_samp(value).over(before),
    }).withColumn(
        "is_spike",
        F.coalesce(value > F.col("baseline") + sigmas * F.col("spread"), F.lit(False)),
    )
