"""Tail sampling: keep or drop whole traces, decided on all their spans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .convert import guardrail_passed
from .skew import join_unique


@dataclass(frozen=True)
class Policy:
    """Keep rules, joined by OR."""

    latency_ms: int = 5000
    risk_levels: tuple[str, ...] = ("high", "critical")
    success_percent: float = 10.0


def lucky(trace_id: Column, percent: float) -> Column:
    """Keep a fixed share of traces, the same ones every time."""
    draw = F.conv(F.substring(F.sha2(trace_id, 256), 1, 8), 16, 10).cast("long") % 10_000
    return draw < round(percent * 100)


def span_flags(spans: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """What one span says about its trace: error, failed check, risk."""
    attr = lambda k: F.try_element_at("attributes", F.lit(k))
    checks = F.filter("events", lambda e: e["name"] == "guardrail_check")
    failed_event = F.exists(checks, lambda e: ~guardrail_passed(e["attributes"]))
    return spans.withColumns({
        "is_error": F.coalesce(
            F.upper("status_code").isin("2", "ERROR", "STATUS_CODE_ERROR"), F.lit(False)),
        "is_failed_check": F.coalesce(failed_event, F.lit(False))
        | F.coalesce(attr("guardrail.passed") == "false", F.lit(False)),
        "is_risky": F.coalesce(attr("agent.risk_level").isin(*policy.risk_levels), F.lit(False)),
    })


def flag_aggregates() -> list[Column]:
    """Aggregates over ``span_flags`` that decide a trace; all are map-side combined."""
    return [
        F.bool_or("is_error").alias("has_error"),
        F.min("start_time").alias("first_start"),
        F.max("start_time").alias("last_start"),
        F.max("end_time").alias("last_end"),
        F.bool_or("is_failed_check").alias("has_failed_check"),
        F.bool_or("is_risky").alias("has_risk"),
        F.count(F.lit(1)).alias("spans"),
    ]


def with_decision(flags: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Add ``is_slow``, ``is_lucky`` and the verdict ``keep``."""
    ms = (F.unix_micros("last_end") - F.unix_micros("first_start")) / 1000
    return flags.withColumns({
        "is_slow": F.coalesce(ms > policy.latency_ms, F.lit(False)),
        "is_lucky": lucky(F.col("trace_id"), policy.success_percent),
    }).withColumn(
        "keep",
        F.col("has_error") | F.col("is_slow") | F.col("has_failed_check")
        | F.col("has_risk") | F.col("is_lucky"),
    )


def decide(spans: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One row per trace with all flags and the verdict."""
    return with_decision(
        span_flags(spans, policy).groupBy("trace_id").agg(*flag_aggregates()), policy
    )


def sample(spans: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The spans of all traces that are kept."""
    kept = decide(spans, policy).where("keep").select("trace_id")
    return join_unique(spans, kept, ["trace_id"], "left_semi")
