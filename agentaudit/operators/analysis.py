"""Per-trace analysis, comparison of traces, links between traces, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_traceparent
from .cost import tokens
from .lookup import flag
from .replay import agent_label
from .skew import join_unique
from .tree import critical_paths, span_nodes


def trace_totals(records: DataFrame) -> DataFrame:
    """Totals of every trace, with its slowest and its costliest agent."""
    duration = F.coalesce("duration_ms", F.lit(0)).cast("long")
    cost = F.coalesce("cost_usd", F.lit(0).cast("decimal(10,6)"))
    at = F.struct("timestamp", "span_id")
    totals = records.groupBy("trace_id").agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.max_by(duration, at).alias("last_ms"),
        F.sum(cost).alias("total_cost_usd"),
        F.sum(tokens()).alias("total_tokens"),
        F.count_distinct("agent_id").alias("agent_count"),
        F.count(F.lit(1)).alias("span_count"),
        F.count_if(F.col("status") == "error").alias("error_count"),
        F.sum(F.coalesce(F.json_array_length("tool_calls"), F.lit(0)).cast("long")).alias("tool_call_count"),
        F.count_if(~flag("all_passed", records)).alias("guardrail_failures"),
    )
    per_agent = records.groupBy("trace_id", agent_label().alias("agent")).agg(
        F.sum(duration).alias("ms"), F.sum(cost).alias("cost"), F.min(at).alias("seen")
    )
    leaders = per_agent.groupBy("trace_id").agg(
        F.min_by("agent", F.struct((-F.col("ms")).alias("v"), F.col("seen"))).alias("bottleneck_agent"),
        F.min_by("agent", F.struct((-F.col("cost")).alias("v"), F.col("seen"))).alias("costliest_agent"),
    )
    gap_ms = F.floor((F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1000)
    return totals.join(leaders, "trace_id").select(
        "trace_id",
        (gap_ms + F.col("last_ms")).cast("long").alias("total_duration_ms"),
        "total_cost_usd", "total_tokens", "agent_count", "span_count", "error_count",
        "tool_call_count", "guardrail_failures", "bottleneck_agent", "costliest_agent",
    )


def analyze(records: DataFrame) -> DataFrame:
    """Totals of every trace with length and duration of its critical path.

    The steps of the path are rows of ``tree.critical_path_steps``.
    """
    return trace_totals(records).join(critical_paths(records), "trace_id", "left").withColumns({
        "path_length": F.coalesce("path_length", F.lit(0)),
        "path_duration_ms": F.coalesce("path_duration_ms", F.lit(0)),
    })


def diff(analysis: DataFrame, pairs: DataFrame) -> DataFrame:
    """Compare pairs of traces (trace_a, trace_b): b minus a, and both summaries.

    A trace that does not exist counts as all zeros.
    """
    numbers = ["total_duration_ms", "total_cost_usd", "total_tokens", "agent_count",
               "span_count", "error_count"]

    def side(name: str) -> DataFrame:
        return analysis.select(
            F.col("trace_id").alias(f"trace_{name}"),
            *[F.col(c).alias(f"{c}_{name}") for c in numbers],
            *[F.col(c).alias(f"{c}_{name}") for c in ("bottleneck_agent", "costliest_agent")],
        )

    # One baseline may be compared with very many traces.
    both = join_unique(pairs.select("trace_a", "trace_b"), side("a"), ["trace_a"], "left")
    both = join_unique(both, side("b"), ["trace_b"], "left")
    zeros = {f"{c}_{s}": F.coalesce(f"{c}_{s}", F.lit(0)) for c in numbers for s in "ab"}
    minus = lambda c: F.col(f"{c}_b") - F.col(f"{c}_a")
    return both.withColumns(zeros).withColumns({
        "duration_diff_ms": minus("total_duration_ms"),
        "cost_diff_usd": minus("total_cost_usd"),
        "token_diff": minus("total_tokens"),
        "span_count_diff": minus("span_count"),
        "error_count_diff": minus("error_count"),
    })


def stitch(calls: DataFrame, records: DataFrame, header: str = "traceparent") -> DataFrame:
    """Link remote calls to the caller's span by the trace context header.

    ``calls`` has trace_id, span_id and the header column. ``link`` says whether
    the caller was found, is missing, or the header is malformed.
    """
    callers = span_nodes(records).select(
        F.col("trace_id").alias("caller_trace_id"), F.col("span_id").alias("caller_span_id"),
        F.col("agent_name").alias("caller_agent"),
    )
    parsed = calls.where(F.col(header).isNotNull()).withColumn("_h", parse_traceparent(F.col(header)))
    remote = parsed.select(
        "trace_id", "span_id", header,
        F.col("_h.trace_id").alias("caller_trace_id"), F.col("_h.span_id").alias("caller_span_id"),
    )
    link = (
        F.when(F.col("caller_trace_id").isNull(), "malformed")
        .when(F.col("caller_agent").isNull(), "missing").otherwise("linked")
    )
    linked = join_unique(remote, callers, ["caller_trace_id", "caller_span_id"], "left")
    return linked.withColumn("link", link)


def delegation_edges(records: DataFrame) -> DataFrame:
    """Who handed work to whom, by protocol, with counts.

    Parent and child spans of different agents count as protocol ``span``;
    recorded messages between agents count under their own protocol. Pairs are
    counted per (trace, parent, agent) first, so a parent with very many
    children meets its own record once per agent, not once per child.
    """
    agents = span_nodes(records.withColumn("agent_name", F.col("agent_id"))).select(
        "trace_id", F.col("span_id").alias("parent_span_id"), F.col("agent_name").alias("src")
    )
    children = records.where(F.col("parent_span_id").isNotNull()).groupBy(
        "trace_id", "parent_span_id", F.col("agent_id").alias("dst")
    ).agg(F.count(F.lit(1)).alias("n"))
    spans = children.join(agents, ["trace_id", "parent_span_id"]).where(
        F.col("src") != F.col("dst")
    ).select("src", "dst", F.lit("span").alias("protocol"), "n")
    reach = lambda key: F.get_json_object("inter_agent", f"$.{key}")
    messages = records.where(F.col("inter_agent").isNotNull()).select(
        F.col("agent_id").alias("src"), reach("target_agent").alias("dst"),
        F.coalesce(reach("protocol"), F.lit("unknown")).alias("protocol"),
        F.lit(1).cast("long").alias("n"),
    ).where(F.col("dst").isNotNull())
    return spans.unionByName(messages).groupBy("src", "dst", "protocol").agg(
        F.sum("n").alias("handoffs")
    )


def lineage_score(records: DataFrame) -> DataFrame:
    """How completely each trace can be reconstructed.

    Shares of spans with a resolvable parent (roots included), with reasoning,
    and of tool-calling spans with a result status on every call. Links are
    looked up once per (trace, parent), not per child.
    """
    calls = F.from_json("tool_calls", "array<map<string,string>>")
    with_status = F.forall(
        calls, lambda c: F.map_contains_key(c, "tool.response_status") | F.map_contains_key(c, "response_status")
    )
    has_tools = F.col("tool_calls").isNotNull()
    per_parent = records.groupBy(
        "trace_id", F.nullif("parent_span_id", F.lit("")).alias("parent")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("reasoning").isNotNull()).alias("reasoned"),
        F.count_if(has_tools).alias("tooled"),
        F.count_if(has_tools & with_status).alias("answered"),
    )
    known = records.select("trace_id", F.col("span_id").alias("parent")).distinct().withColumn(
        "known", F.lit(True)
    )
    joined = per_parent.join(known, ["trace_id", "parent"], "left")
    linked = F.when(F.col("parent").isNull() | F.col("known"), F.col("n")).otherwise(0)
    sums = joined.groupBy("trace_id").agg(
        F.sum("n").alias("spans"), F.sum(linked).alias("linked"),
        F.sum("reasoned").alias("reasoned"),
        F.sum("tooled").alias("tooled"), F.sum("answered").alias("answered"),
    )
    tool_share = F.when(F.col("tooled") > 0, F.col("answered") / F.col("tooled"))
    return sums.select(
        "trace_id", "spans",
        (F.col("linked") / F.col("spans")).alias("linked_share"),
        (F.col("reasoned") / F.col("spans")).alias("reasoning_share"),
        tool_share.alias("tool_status_share"),
        ((F.col("linked") == F.col("spans")) & (F.col("reasoned") == F.col("spans"))
         & (F.col("answered") == F.col("tooled"))).alias("is_complete"),
    )
