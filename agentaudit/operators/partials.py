"""Reports from daily partial results: a settled day is read once, a report reads no record.

``refresh`` writes, for each of some days, four small tables beside the record table, each
partitioned by day: sums by hour and agent, checks and sessions by hour, tools, and the
records with a human in the loop. A run replaces its days, so it can be repeated after
late records. Sums, counts and extremes add up exactly; distinct traces are kept as
sketches, whose union is off by about two percent.

The report functions have the shapes of those in ``cost`` and ``compliance`` and take
whole days, both included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from .compliance import percent_text, tool_calls
from .cost import tokens
from .lookup import flag


def _hour() -> Column:
    return F.date_trunc("hour", "timestamp").alias("hour")


def _agents(records: DataFrame) -> DataFrame:
    failed = F.col("status") == "error"
    return records.groupBy("date", _hour(), "agent_name").agg(
        F.count(F.lit(1)).alias("invocations"), F.sum("cost_usd").alias("cost"),
        F.sum(F.col("duration_ms").cast("long")).alias("latency_ms"), F.count("duration_ms").alias("timed"),
        F.sum(tokens()).alias("tokens"), F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("whole_tokens"),
        F.count_if(failed).alias("errors"), F.hll_sketch_agg("trace_id").alias("traces"))


def _checks(records: DataFrame) -> DataFrame:
    checked, passed = F.col("compliance").isNotNull(), flag("all_passed", records)
    root = F.col("parent_span_id").isNull()
    finish = F.col("timestamp") + F.make_dt_interval(
        secs=(F.coalesce("duration_ms", F.lit(0)) / 1000).cast("decimal(18,6)"))
    return records.groupBy("date", _hour()).agg(
        F.min("timestamp").alias("first_use"), F.max("timestamp").alias("last_use"),
        F.count(F.lit(1)).alias("operations"), F.count_if(checked).alias("checked"),
        F.count_if(checked & passed).alias("passed"), F.count_if(checked & ~passed).alias("failed"),
        F.min(F.when(root, F.col("timestamp"))).alias("first_start"), F.max(F.when(root, finish)).alias("last_end"),
        F.count_if(root).alias("sessions"))


def _tools(records: DataFrame) -> DataFrame:
    field = lambda key: F.try_element_at("call", F.lit(f"gen_ai.tool.{key}"))
    return tool_calls(records).groupBy("date", field("name").alias("tool_name"), field("type").alias("tool_type")).agg(
        F.count(F.lit(1)).alias("usage_count"))


def _oversight(records: DataFrame) -> DataFrame:
    return records.where(flag("human_in_loop", records)).select(
        "date", "trace_id", "span_id", "agent_name", "timestamp", "operation_name")


PARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "agents": _agents, "checks": _checks, "tools": _tools, "oversight": _oversight}


def refresh(records: DataFrame, root: str, days: Sequence) -> None:
    """Work out the partial results of ``days`` anew from the record table and put them in place.

    Other days are neither read nor written. A day without records loses its partial
    results only if another of ``days`` has some in the same table.
    """
    mine = records.where(F.col("date").isin([str(d) for d in days]))
    for name, part in PARTS.items():
        part(mine).repartition("date").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{root}/{name}")


def settle_days(landed: DataFrame, path: str, root: str, days: Sequence, layout: str = "agent") -> None:
    """Settle days of landed records and keep their partial results up with them."""
    tables.settle_days(landed, path, days, layout)
    refresh(tables.read(landed.sparkSession, path), root, days)


def _days(spark: SparkSession, root: str, name: str, first, last) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}").where(
        F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def _agent_sums(whole: bool) -> list[Column]:
    return [F.sum("invocations").alias("invocations"), F.sum("cost").alias("total_cost"),
            (F.sum("latency_ms") / F.sum("timed")).alias("avg_latency_ms"),
            F.sum("whole_tokens" if whole else "tokens").alias("total_tokens")]


def cost_attribution(spark: SparkSession, root: str, first, last) -> DataFrame:
    """Cost, calls, latency and tokens per agent name; costliest first."""
    return _days(spark, root, "agents", first, last).groupBy("agent_name").agg(*_agent_sums(False)).orderBy(
        F.desc_nulls_first("total_cost"), "agent_name")


def cost_hourly(spark: SparkSession, root: str, first, last) -> DataFrame:
    """Cost per agent and hour; a record that lacks a token count adds no tokens."""
    return _days(spark, root, "agents", first, last).groupBy("agent_name", "hour").agg(*_agent_sums(True)).orderBy(
        F.desc_nulls_first("total_cost"), "agent_name", "hour")


def distinct_traces(spark: SparkSession, root: str, first, last) -> DataFrame:
    """About how many traces each agent took part in; a trace over several days counts once."""
    return _days(spark, root, "agents", first, last).groupBy("agent_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("traces")).alias("traces"))


def usage_periods(spark: SparkSession, root: str, first, last) -> DataFrame:
    """First use, last use and number of operations per day."""
    return _days(spark, root, "checks", first, last).groupBy(F.date_trunc("day", "hour").alias("day")).agg(
        F.min("first_use").alias("first_use"), F.max("last_use").alias("last_use"),
        F.sum("operations").alias("total_operations")).orderBy("day")


def root_usage_periods(spark: SparkSession, root: str, first, last) -> DataFrame:
    """Sessions per day, a session being a root span with its duration."""
    return _days(spark, root, "checks", first, last).groupBy(F.date_trunc("day", "hour").alias("day")).agg(
        F.min("first_start").alias("first_start"), F.max("last_end").alias("last_end"),
        F.sum("sessions").alias("sessions")).where("sessions > 0").orderBy("day")


def reference_databases(spark: SparkSession, root: str, first, last) -> DataFrame:
    """Tools used and how often; calls in another shape group under NULL."""
    return _days(spark, root, "tools", first, last).groupBy("tool_name", "tool_type").agg(
        F.sum("usage_count").alias("usage_count")).orderBy(F.desc_nulls_first("usage_count"), "tool_name", "tool_type")


def guardrail_summary(spark: SparkSession, root: str, first, last) -> DataFrame:
    """Records with checks: total, passed, failed and pass rate (one row)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    rate = F.col("passed") / F.greatest(F.col("total_checked"), F.lit(1)) * 100
    return _days(spark, root, "checks", first, last).agg(
        total("checked").alias("total_checked"), total("passed").alias("passed"), total("failed").alias("failed")
    ).withColumn("pass_rate_pct", rate).withColumn("pass_rate", percent_text(rate))


def human_oversight(spark: SparkSession, root: str, first, last, ordered: bool = True) -> DataFrame:
    """Records with a human in the loop, oldest first."""
    seen = _days(spark, root, "oversight", first, last).select(
        "trace_id", "span_id", "agent_name", "timestamp", "operation_name")
    return seen.orderBy("timestamp", "span_id") if ordered else seen


def report(spark: SparkSession, root: str, first, last) -> dict[str, DataFrame]:
    """The sections of ``compliance.report``, without reading a record."""
    return {"usage_periods": usage_periods(spark, root, first, last),
            "reference_databases": reference_databases(spark, root, first, last),
            "human_oversight_events": human_oversight(spark, root, first, last),
            "guardrail_summary": guardrail_summary(spark, root, first, last)}
