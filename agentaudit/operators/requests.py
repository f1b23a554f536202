"""One user request over several traces, joined by trace context headers.

A remote call starts a trace of its own whose root carries the header of the calling
span. ``joined`` puts such traces together: every span gets the id of its request, and a
root that names a known caller hangs under it, so that trees and critical paths go across
services. Links that lead round in a circle are ignored, all of them; malformed headers
and unknown callers leave a root a root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import tree
from .analysis import stitch
from .skew import join_unique

#: Stands between trace and span in the id of a joined span.
SIGN = "/"
#: What trees of spans are made of.
TREE_COLUMNS = ["trace_id", "span_id", "parent_span_id", "timestamp", "agent_id", "agent_name", "duration_ms"]


def links(records: DataFrame, header: str = "traceparent") -> DataFrame:
    """Root spans with a known caller: trace_id, span_id, caller_trace_id, caller_span_id.

    A span whose parent is in its own trace is no root. Of several callers the first by id counts.
    """
    spans = records.select("trace_id", F.col("span_id").alias("parent_span_id")).distinct()
    calls = records.where(F.col(header).isNotNull()).join(spans, ["trace_id", "parent_span_id"], "left_anti")
    caller = F.min(F.struct("caller_trace_id", "caller_span_id"))
    return stitch(calls.select("trace_id", "span_id", header), records, header).where("link = 'linked'").groupBy(
        "trace_id", "span_id").agg(caller.alias("c")).select("trace_id", "span_id", "c.*")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of an undirected graph that are not the least of their component.

    ``edges`` has columns a and b. Larger ends hang under the least neighbour of the smaller
    end, then a node's neighbours under the least of them, in turns, until only stars are left.
    """
    stars = cut(edges.where("a != b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    while True:
        above = cut(stars.groupBy(F.col("x").alias("y")).agg(F.min("y").alias("top")))
        raised = cut(join_unique(stars, above, ["y"], "left").select(
            "x", F.coalesce("top", "y").alias("y"), F.col("top").isNotNull().alias("moved")))
        if raised.where("moved").isEmpty() and raised.count() == raised.select("x").distinct().count():
            return stars.select(F.col("x").alias("node"), F.col("y").alias("root"))
        least = cut(raised.groupBy("x").agg(F.min("y").alias("low")))
        both = join_unique(raised, least, ["x"], "inner")
        stars = cut(both.where("y != low").select(F.col("y").alias("x"), F.col("low").alias("y"))
                    .unionByName(least.select("x", F.col("low").alias("y"))).distinct())


def _circular(steps: DataFrame) -> DataFrame:
    """The nodes on cycles of a graph in which every node (span_id) has one next node (ptr) or none.

    Jumping twice as far each round, the places reached shrink to the cycles; when a jump of
    double length reaches as many as before, only cycles are left.
    """
    pointers = cut(steps)
    reached = pointers.select("ptr").distinct().count()
    while reached:
        ahead = pointers.select(F.col("span_id").alias("ptr"), F.col("ptr").alias("then"))
        pointers = cut(pointers.join(ahead, "ptr").select("span_id", F.col("then").alias("ptr")))
        left = pointers.select("ptr").distinct().count()
        if left == reached:
            break
        reached = left
    return pointers.select(F.col("ptr").alias("span_id")).distinct()


def joined(records: DataFrame, header: str = "traceparent") -> DataFrame:
    """The records with their spans joined over traces.

    ``request_id`` is the smallest trace of the request. ``node`` and ``parent_node`` name a
    span and its parent across traces.
    """
    node = lambda t, s: F.concat(F.col(t), F.lit(SIGN), F.col(s))
    found = cut(links(records, header))
    # Every caller climbs to the top of its own trace; what is left is a graph of roots.
    tops = tree.span_tree(records).select(F.col("trace_id").alias("caller_trace_id"), F.col("span_id").alias("caller_span_id"),
                                          F.col("root_span_id").alias("top"))
    roots = join_unique(found, tops, ["caller_trace_id", "caller_span_id"], "left").select(
        node("trace_id", "span_id").alias("span_id"), node("caller_trace_id", "top").alias("ptr"))
    circular = _circular(roots.where("ptr IS NOT NULL"))
    parents = found.select("trace_id", "span_id", node("trace_id", "span_id").alias("node"),
                           node("caller_trace_id", "caller_span_id").alias("caller")).join(
        circular.withColumnRenamed("span_id", "node"), "node", "left_anti").drop("node")
    requests = connected(found.select(F.col("trace_id").alias("a"), F.col("caller_trace_id").alias("b"))).select(
        F.col("node").alias("trace_id"), F.col("root").alias("request_id"))
    out = join_unique(records, cut(parents), ["trace_id", "span_id"], "left")
    out = join_unique(out, cut(requests), ["trace_id"], "left")
    own = F.when(F.nullif("parent_span_id", F.lit("")).isNotNull(), node("trace_id", "parent_span_id"))
    return out.withColumns({
        "request_id": F.coalesce("request_id", "trace_id"), "node": node("trace_id", "span_id"),
        "parent_node": F.coalesce("caller", own)}).drop("caller")


def _as_trace(records: DataFrame, header: str) -> DataFrame:
    """Requests in the place of traces, joined spans in that of spans."""
    return cut(joined(records, header).withColumns({
        "trace_id": F.col("request_id"), "span_id": F.col("node"), "parent_span_id": F.col("parent_node")}
    ).drop("request_id", "node", "parent_node"))


def _split(column: str, trace: str, span: str) -> list:
    return [F.substring_index(column, SIGN, 1).alias(trace), F.substring_index(column, SIGN, -1).alias(span)]


def request_tree(records: DataFrame, header: str = "traceparent") -> DataFrame:
    """The forest of every request: request_id, trace, span, depth over all traces, and root."""
    narrow = records.select(*dict.fromkeys([*TREE_COLUMNS, header]))
    found = tree.span_tree(_as_trace(narrow, header))
    return found.select(F.col("trace_id").alias("request_id"), *_split("span_id", "trace_id", "span_id"), "depth",
                        *_split("root_span_id", "root_trace_id", "root_span_id"), "sibling_no", "child_count")


def request_paths(records: DataFrame, header: str = "traceparent") -> DataFrame:
    """The critical path of every request, one row per step, through all its traces."""
    steps = tree.critical_path_steps(_as_trace(records, header))
    return steps.select(F.col("trace_id").alias("request_id"), "position", *_split("span_id", "trace_id", "span_id"),
                        "agent_name", "duration_ms")


def request_sizes(records: DataFrame, header: str = "traceparent") -> DataFrame:
    """Traces, spans and linked roots of every request."""
    crossed = F.col("parent_node").isNotNull() & (F.substring_index("parent_node", SIGN, 1) != F.col("trace_id"))
    return joined(records, header).groupBy("request_id").agg(
        F.count_distinct("trace_id").alias("traces"), F.count(F.lit(1)).alias("spans"), F.count_if(crossed).alias("links"))
