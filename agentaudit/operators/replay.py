"""Replay of traces: numbered steps, timeline text, thought–action–observation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed_text
from .lookup import error_text
from .skew import number_rows


def agent_label() -> Column:
    """Agent name, or its id where the name is missing or empty."""
    return F.coalesce(F.nullif("agent_name", F.lit("")), "agent_id")


def steps(records: DataFrame, hot: list | None = None) -> DataFrame:
    """Numbered steps of every trace in time order, with defaults filled in."""
    filled = records.select(
        "trace_id", "timestamp", "span_id", "parent_span_id", "agent_id",
        agent_label().alias("agent_name"),
        F.coalesce(F.nullif("operation_name", F.lit("")), F.lit("unknown")).alias("operation"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"),
        "status",
        F.col("model_name").alias("model"),
        "input_tokens", "output_tokens",
        F.coalesce("cost_usd", F.lit(0).cast("decimal(10,6)")).alias("cost_usd"),
        F.get_json_object("reasoning", "$.rationale").alias("rationale"),
        F.get_json_object("reasoning", "$.confidence").cast("double").alias("confidence"),
        F.coalesce("tool_calls", F.lit("[]")).alias("tool_calls"),
        error_text().alias("error"),
    )
    return number_rows(
        filled, ["trace_id"], [F.col("timestamp"), F.col("span_id")], "sequence", hot
    )


def _tool_names() -> Column:
    calls = F.from_json("tool_calls", "array<map<string,string>>")
    name = lambda c: F.coalesce(F.try_element_at(c, F.lit("gen_ai.tool.name")), F.lit("?"))
    return F.array_join(F.transform(calls, name), ", ")


def timeline(step_rows: DataFrame) -> DataFrame:
    """One text block per step (column ``line``)."""
    total = F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))
    cost = F.when(
        F.col("cost_usd") != 0, F.concat(F.lit("$"), fixed_text(F.col("cost_usd"), 4))
    ).otherwise("—")
    icon = F.when(F.col("status") == "ok", "✅").otherwise("❌")
    present = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    lines = F.array_compact(F.array(
        F.format_string("  [%02d] %s %s", "sequence", icon, "agent_name"),
        F.format_string("       Operation: %s", "operation"),
        F.format_string("       Duration:  %dms | Cost: %s | %d tok", "duration_ms", cost, total),
        F.when(present("model"), F.format_string("       Model:     %s", "model")),
        F.when(present("rationale"),
               F.format_string("       Reasoning: %s...", F.substring("rationale", 1, 100))),
        F.when(F.col("tool_calls") != "[]",
               F.format_string("       Tools:     %s", _tool_names())),
        F.when(present("error"), F.format_string("       Error:     %s", F.substring("error", 1, 100))),
    ))
    return step_rows.select("trace_id", "sequence", F.array_join(lines, "\n").alias("line"))


def timeline_summary(analysis: DataFrame) -> DataFrame:
    """Closing text block per trace, from the trace analysis."""
    lines = F.array_compact(F.array(
        F.format_string(
            "  Total: %dms | $%s | %d tokens", "total_duration_ms",
            fixed_text(F.col("total_cost_usd"), 4), "total_tokens",
        ),
        F.format_string("  Agents: %d | Spans: %d | Errors: %d",
                        "agent_count", "span_count", "error_count"),
        F.when(F.col("bottleneck_agent") != "",
               F.format_string("  Bottleneck: %s", "bottleneck_agent")),
        F.when(F.col("costliest_agent") != "",
               F.format_string("  Costliest:  %s", "costliest_agent")),
    ))
    return analysis.select("trace_id", F.array_join(lines, "\n").alias("line"))


def tao_rows(records: DataFrame) -> DataFrame:
    """Thought, action and observation rows of every record, in that order.

    One pass: each record explodes into its phases.
    """
    calls = F.from_json("tool_calls", "array<map<string,string>>")
    kind = "array<struct<phase:int,kind:string,detail:string>>"

    def row(phase: int, name: str, detail: Column) -> Column:
        return F.struct(F.lit(phase).alias("phase"), F.lit(name).alias("kind"), detail.alias("detail"))

    thought = F.when(
        F.col("reasoning").isNotNull(), F.array(row(1, "thought", F.col("reasoning")))
    )
    tool = F.transform(calls, lambda c: row(2, "action", F.coalesce(
        F.try_element_at(c, F.lit("gen_ai.tool.name")), F.lit("?"))))
    message = F.when(
        F.col("inter_agent").isNotNull(), F.array(row(2, "action", F.col("inter_agent")))
    )
    seen = F.transform(
        F.filter(calls, lambda c: F.map_contains_key(c, "tool.response_status")),
        lambda c: row(3, "observation", F.try_element_at(c, F.lit("tool.response_status"))),
    )
    result = F.array(row(3, "observation", F.coalesce(error_text(), F.col("status"))))
    empty = F.array().cast(kind)
    phases = F.concat(*[
        F.coalesce(p.cast(kind), empty) for p in (thought, tool, message, seen, result)
    ])
    return records.select(
        "trace_id", "timestamp", "span_id", F.posexplode(phases).alias("pos", "p")
    ).select("trace_id", "timestamp", "span_id", "pos", "p.*")
