"""The documented nested JSON record: read and flatten, nest and write back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import NESTED
from .tables import conform


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """Nested records from JSON lines, flattened to record columns."""
    return flatten(spark.read.schema(NESTED).json(path))


def _json(value: Column) -> Column:
    return F.to_json(value)


def flatten(nested: DataFrame) -> DataFrame:
    """Nested groups to flat record columns.

    Tool calls and check results take the names the span conversion uses, so
    that all queries read one shape.
    """
    calls = F.transform("tool_calls", lambda c: F.map_filter(
        F.create_map(
            F.lit("gen_ai.tool.name"), c["tool_name"],
            F.lit("gen_ai.tool.type"), c["tool_type"],
            F.lit("tool.call_id"), c["call_id"],
            F.lit("tool.parameters"), F.to_json(c["parameters"]),
            F.lit("tool.response_status"), c["response_status"].cast("string"),
            F.lit("tool.latency_ms"), c["latency_ms"].cast("string"),
            F.lit("tool.retry_count"), c["retry_count"].cast("string"),
        ),
        lambda _, v: v.isNotNull(),
    ))
    checks = F.transform(
        "compliance.guardrail_checks", lambda name: F.create_map(F.lit("guardrail.name"), name)
    )
    compliance = F.when(F.col("compliance").isNotNull(), F.struct(
        checks.alias("guardrail_checks"),
        F.col("compliance.guardrail_passed").alias("all_passed"),
        F.coalesce("compliance.human_in_loop", F.lit(False)).alias("human_in_loop"),
        F.col("compliance.pii_detected").alias("pii_detected"),
        F.col("compliance.pii_redacted_fields").alias("pii_redacted_fields"),
    ))
    model = F.coalesce(
        F.nullif("model.response_model", F.lit("")), F.nullif("model.request_model", F.lit(""))
    )
    return conform(nested.select(
        "trace_id", "span_id", "parent_span_id", "timestamp",
        F.col("agent.id").alias("agent_id"), F.col("agent.name").alias("agent_name"),
        F.col("agent.version").alias("agent_version"), "agent.config_hash",
        F.col("operation.name").alias("operation_name"), "duration_ms",
        model.alias("model_name"), "model.temperature", "model.max_tokens",
        F.col("tokens.input").alias("input_tokens"), F.col("tokens.output").alias("output_tokens"),
        F.col("tokens.cache_read").alias("cache_read_tokens"), "tokens.cost_usd",
        _json(F.col("reasoning")).alias("reasoning"),
        _json(calls).alias("tool_calls"),
        _json(F.col("inter_agent")).alias("inter_agent"),
        _json(F.col("state")).alias("state"),
        _json(F.col("outcome")).alias("outcome"),
        _json(compliance).alias("compliance"),
        F.col("operation.status").alias("status"),
        F.coalesce("error.type", F.try_variant_get("outcome", "$.error_code", "string")).alias("error_type"),
        F.col("error.message").alias("error_message"),
    ))


def nest(records: DataFrame) -> DataFrame:
    """Flat record columns back to the nested form."""
    calls = F.transform(
        F.from_json("tool_calls", "array<map<string,string>>"),
        lambda c: F.struct(
            F.try_element_at(c, F.lit("gen_ai.tool.name")).alias("tool_name"),
            F.try_element_at(c, F.lit("gen_ai.tool.type")).alias("tool_type"),
            F.try_element_at(c, F.lit("tool.call_id")).alias("call_id"),
            F.from_json(F.try_element_at(c, F.lit("tool.parameters")), "map<string,string>").alias("parameters"),
            F.try_element_at(c, F.lit("tool.response_status")).try_cast("int").alias("response_status"),
            F.try_element_at(c, F.lit("tool.latency_ms")).try_cast("int").alias("latency_ms"),
            F.try_element_at(c, F.lit("tool.retry_count")).try_cast("int").alias("retry_count"),
        ),
    )
    checks = F.from_json(
        "compliance",
        "guardrail_checks array<map<string,string>>, all_passed boolean, human_in_loop boolean, "
        "pii_detected boolean, pii_redacted_fields array<string>",
    )
    names = F.transform(
        checks["guardrail_checks"], lambda m: F.try_element_at(m, F.lit("guardrail.name"))
    )
    compliance = F.when(F.col("compliance").isNotNull(), F.struct(
        checks["pii_detected"].alias("pii_detected"),
        checks["pii_redacted_fields"].alias("pii_redacted_fields"),
        names.alias("guardrail_checks"),
        checks["all_passed"].alias("guardrail_passed"),
        checks["human_in_loop"].alias("human_in_loop"),
    ))
    columns = {
        "agent": F.struct(
            F.col("agent_id").alias("id"), F.col("agent_name").alias("name"),
            F.col("agent_version").alias("version"), "config_hash"),
        "operation": F.struct(
            F.col("operation_name").alias("name"), F.lit(None).cast("string").alias("type"), "status"),
        "model": F.struct(
            F.lit(None).cast("string").alias("request_model"),
            F.col("model_name").alias("response_model"), "temperature", "max_tokens"),
        "tokens": F.struct(
            F.col("input_tokens").alias("input"), F.col("output_tokens").alias("output"),
            F.col("cache_read_tokens").alias("cache_read"), "cost_usd"),
        "tool_calls": calls,
        "compliance": compliance,
        "error": F.when(F.coalesce("error_type", "error_message").isNotNull(), F.struct(
            F.col("error_type").alias("type"), F.col("error_message").alias("message"))),
        **{c: F.try_parse_json(F.col(c)) for c in ("reasoning", "inter_agent", "state", "outcome")},
    }
    return records.select(*[
        columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in NESTED
    ])
