"""Compliance evidence: usage periods, tools, oversight, checks, full report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fixed_text
from ..sources.tables import in_range
from .lookup import flag, human_oversight

SECTIONS = ["usage_periods", "reference_databases", "human_oversight_events", "guardrail_summary"]

# Domains that make an agent system high-risk.
HIGH_RISK_DOMAINS = [
    ("employment", "Employment & HR"),
    ("credit", "Credit & Finance"),
    ("healthcare", "Healthcare"),
    ("education", "Education"),
    ("law_enforcement", "Law Enforcement"),
    ("infrastructure", "Critical Infrastructure"),
    ("biometrics", "Biometrics"),
]


#: Report rows keep empty fields and microseconds.
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def usage_periods(records: DataFrame, start, end) -> DataFrame:
    """First use, last use and number of operations per day."""
    return (
        in_range(records, start, end)
        .groupBy(F.date_trunc("day", "timestamp").alias("day"))
        .agg(
            F.min("timestamp").alias("first_use"),
            F.max("timestamp").alias("last_use"),
            F.count(F.lit(1)).alias("total_operations"),
        )
        .orderBy("day")
    )


def root_usage_periods(records: DataFrame) -> DataFrame:
    """Sessions per day, a session being a root span with its duration."""
    finish = F.col("timestamp") + F.make_dt_interval(
        secs=(F.coalesce("duration_ms", F.lit(0)) / 1000).cast("decimal(18,6)")
    )
    return (
        records.where(F.col("parent_span_id").isNull())
        .groupBy(F.date_trunc("day", "timestamp").alias("day"))
        .agg(
            F.min("timestamp").alias("first_start"),
            F.max(finish).alias("last_end"),
            F.count(F.lit(1)).alias("sessions"),
        )
        .orderBy("day")
    )


def tool_calls(records: DataFrame) -> DataFrame:
    """One row per tool call: record columns plus ``call`` (map of its fields)."""
    calls = F.from_json("tool_calls", "array<map<string,string>>")
    return records.where(F.col("tool_calls").isNotNull()).withColumn("call", F.explode(calls))


def reference_databases(records: DataFrame, start, end) -> DataFrame:
    """Tools used and how often; calls in another shape group under NULL."""
    return (
        tool_calls(in_range(records, start, end).select("tool_calls"))
        .groupBy(
            F.try_element_at("call", F.lit("gen_ai.tool.name")).alias("tool_name"),
            F.try_element_at("call", F.lit("gen_ai.tool.type")).alias("tool_type"),
        )
        .agg(F.count(F.lit(1)).alias("usage_count"))
        .orderBy(F.desc_nulls_first("usage_count"), "tool_name", "tool_type")
    )


def percent_text(value: Column) -> Column:
    """A percentage with one decimal."""
    return F.concat(fixed_text(value, 1), F.lit("%"))


def guardrail_summary(records: DataFrame, start, end) -> DataFrame:
    """Records with checks: total, passed, failed and pass rate (one row)."""
    passed = flag("all_passed", records)
    checked = in_range(records, start, end).where(F.col("compliance").isNotNull())
    rate = F.col("passed") / F.greatest(F.col("total_checked"), F.lit(1)) * 100
    return (
        checked.agg(
            F.count(F.lit(1)).alias("total_checked"),
            F.count_if(passed).alias("passed"),
            F.count_if(~passed).alias("failed"),
        )
        .withColumn("pass_rate_pct", rate)
        .withColumn("pass_rate", percent_text(rate))
    )


def report(records: DataFrame, start, end, sections: Sequence[str] | None = None,
           end_inclusive_day: bool = False, ordered: bool = True) -> dict[str, DataFrame]:
    """The chosen report sections, each a DataFrame.

    No sections means all of them; unknown names are ignored. Each section is
    its own narrow scan of the table (column pruning, date pruning), which at
    scale costs less than caching the whole range.
    """
    chosen = list(sections or SECTIONS)
    if end_inclusive_day:
        records = in_range(records, start, end, end_inclusive_day=True)
        start, end = "0001-01-01", "9999-12-31"
    build = {
        "usage_periods": usage_periods,
        "reference_databases": reference_databases,
        "human_oversight_events": partial(human_oversight, ordered=ordered),
        "guardrail_summary": guardrail_summary,
    }
    return {name: build[name](records, start, end) for name in SECTIONS if name in chosen}


def report_long(records: DataFrame, start, end, sections: Sequence[str] | None = None) -> DataFrame:
    """The report as rows (section, row_json)."""
    parts = [
        df.select(
            F.lit(name).alias("section"),
            F.to_json(F.struct(*df.columns), JSON).alias("row_json"),
        )
        for name, df in report(records, start, end, sections, ordered=False).items()
    ]
    if not parts:
        return records.sparkSession.createDataFrame([], "section string, row_json string")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report_header(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Report date and period (one row)."""
    return spark.range(1).select(
        F.current_timestamp().alias("report_date"),
        F.lit(start).alias("period_start"), F.lit(end).alias("period_end"),
    )


def tag_risk(records: DataFrame, domain: Column, risk_level: Column) -> DataFrame:
    """Add risk level and whether the domain makes the record high-risk.

    Seven fixed domains become a literal map: no join at all.
    """
    names = F.create_map(*[F.lit(v) for pair in HIGH_RISK_DOMAINS for v in pair])
    label = F.try_element_at(names, domain)
    level = F.coalesce(risk_level, F.lit("standard"))
    return records.withColumns({
        "risk_level": level,
        "risk_domain": label,
        "is_high_risk": label.isNotNull() | level.isin("high", "critical"),
    })
