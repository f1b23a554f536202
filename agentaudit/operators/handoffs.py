"""Hand-offs between agents: the chain behind every agent's work, and rounds it goes in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .skew import join_unique
from .tree import climb

#: Traces of up to this many ways between agents are one row: a bit of a number for every agent.
SMALL_EDGES = 62


def handoffs(records: DataFrame) -> DataFrame:
    """The spans at which work passes to another agent, linked to the hand-off before.

    One row per span that is a root or whose parent belongs to another agent: trace_id,
    span_id, agent, timestamp, ``parent`` (the hand-off before; NULL at an origin) and
    ``depth`` (hand-offs since the origin). A span whose parent is missing is an origin.
    Spans on or below a cycle of parents have no origin and do not appear. Of several
    records of a span the earliest counts.
    """
    nodes = cut(records.groupBy("trace_id", "span_id").agg(
        F.min(F.struct("timestamp", "agent_id", F.nullif("parent_span_id", F.lit("")).alias("parent"))).alias("n")
    ).select("trace_id", "span_id", "n.timestamp", F.col("n.agent_id").alias("agent"), "n.parent"))
    above = nodes.select("trace_id", F.col("span_id").alias("parent"), F.col("agent").alias("by"))
    linked = cut(join_unique(nodes, above, ["trace_id", "parent"], "left").select(
        "trace_id", "span_id", "timestamp", "agent",
        F.when(F.col("by").isNotNull(), F.col("parent")).alias("parent"),
        F.coalesce(F.col("by") != F.col("agent"), F.lit(True)).alias("taken")))
    # Within one agent's work every span climbs to the span where the work was taken over.
    own = linked.select("trace_id", "span_id", F.when(~F.col("taken"), F.col("parent")).alias("parent"),
                        F.lit(0).cast("long").alias("weight"))
    begun = climb(cut(own))[0].select("trace_id", F.col("span_id").alias("parent"), F.col("top").alias("before"))
    chain = join_unique(linked.where("taken"), begun, ["trace_id", "parent"], "left")
    # A parent that reached no top runs in a cycle.
    return chain.where("parent IS NULL OR before IS NOT NULL").select(
        "trace_id", "span_id", "agent", "timestamp", F.col("before").alias("parent"))


def chains(records: DataFrame) -> DataFrame:
    """From every agent of a trace back to the origin of its work, as rows.

    Starts at the first hand-off to the agent in the trace. ``hop`` counts back: 0 is the
    agent's own span, the highest the origin; ``by`` is the agent there. With the pointers
    of the doubled climb all distances are found in log2(hops) joins, each once.
    """
    links = cut(handoffs(records))
    reached, levels = climb(cut(links.select("trace_id", "span_id", "parent", F.lit(1).cast("long").alias("weight"))))
    first = links.join(reached.select("trace_id", "span_id"), ["trace_id", "span_id"], "left_semi").groupBy(
        "trace_id", "agent").agg(F.min_by("span_id", F.struct("timestamp", "span_id")).alias("span_id"))
    pairs = first.select("trace_id", "agent", "span_id", F.lit(0).alias("hop"))
    for k in reversed(range(len(levels))):
        up = pairs.join(levels[k], ["trace_id", "span_id"]).select(
            "trace_id", "agent", F.col("ptr").alias("span_id"), (F.col("hop") + 2 ** k).alias("hop"))
        pairs = pairs.unionByName(up)
    who = links.select("trace_id", "span_id", F.col("agent").alias("by"), "timestamp")
    return pairs.join(who, ["trace_id", "span_id"]).select("trace_id", "agent", "hop", "by", "span_id", "timestamp")


def chain_texts(records: DataFrame, sign: str = " -> ") -> DataFrame:
    """One row per agent of a trace: ``hops`` and the chain from the origin to the agent as text."""
    return chains(records).groupBy("trace_id", "agent").agg(
        F.max("hop").alias("hops"), F.sort_array(F.collect_list(F.struct(-F.col("hop"), "by"))).alias("c")
    ).select("trace_id", "agent", "hops", F.array_join(F.transform("c", lambda s: s["by"]), sign).alias("chain"))


def trace_edges(records: DataFrame) -> DataFrame:
    """Who handed work to whom inside each trace, once: trace_id, src, dst.

    Both parent and child spans of different agents and recorded messages count.
    """
    agents = records.groupBy("trace_id", F.col("span_id").alias("parent_span_id")).agg(
        F.min_by("agent_id", "timestamp").alias("src"))
    children = records.where(F.col("parent_span_id").isNotNull()).select(
        "trace_id", "parent_span_id", F.col("agent_id").alias("dst")).distinct()
    spans = children.join(agents, ["trace_id", "parent_span_id"]).select("trace_id", "src", "dst")
    messages = records.select("trace_id", F.col("agent_id").alias("src"),
                              F.get_json_object("inter_agent", "$.target_agent").alias("dst"))
    return spans.unionByName(messages).where("src != dst").distinct()


def cycles(records: DataFrame) -> DataFrame:
    """Agents of a trace that hand work round in circles.

    One row per agent in a circle: trace_id, agent, ``cycle`` (the smallest agent of the
    strongly connected component) and ``agents`` (its size).
    """
    members = cut(components(trace_edges(records)))
    sizes = members.groupBy("trace_id", "cycle").agg(F.count(F.lit(1)).alias("agents"))
    return members.join(sizes, ["trace_id", "cycle"]).select("trace_id", "agent", "cycle", "agents")


def components(edges: DataFrame, small: int = SMALL_EDGES) -> DataFrame:
    """Strongly connected components of two agents or more: trace_id, agent, cycle.

    ``edges`` are distinct (trace_id, src, dst) without loops. Traces of up to ``small`` of
    them (at most ``SMALL_EDGES``) are worked on as one row each, larger ones in rounds over rows.
    """
    edges = cut(edges)
    large = cut(edges.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > small).select("trace_id"))
    if large.isEmpty():
        return _small_components(edges)
    return _small_components(join_unique(edges, large, ["trace_id"], "left_anti")).unionByName(
        _large_components(join_unique(edges, large, ["trace_id"], "left_semi")))


def _small_components(edges: DataFrame) -> DataFrame:
    """Components of small traces: bit j of ``reach[i]`` says that a way leads from agent i to agent j."""
    ways = edges.where("trace_id IS NOT NULL").groupBy("trace_id").agg(
        F.collect_list(F.struct("src", "dst")).alias("e"))
    # Only who hands on can be in a circle.
    named = ways.withColumn("names", F.expr("array_sort(array_distinct(e.src))"))
    reach = named.selectExpr("trace_id", "names", """aggregate(sequence(0, size(names) - 1),
        transform(names, n -> aggregate(filter(e, x -> x.src = n AND array_contains(names, x.dst)), 0L,
            (m, x) -> m | shiftleft(1L, cast(array_position(names, x.dst) AS int) - 1))),
        (r, k) -> transform(r, m -> if(shiftright(m, k) & 1 = 1, m | r[k], m))) AS reach""")
    # Whoever is in a circle reaches itself; all of its circle reach the same agents.
    return reach.selectExpr("trace_id", """inline(transform(
        filter(sequence(0, size(names) - 1), i -> shiftright(reach[i], i) & 1 = 1), i -> struct(names[i] AS agent,
            filter(names, (o, j) -> reach[j] = reach[i] AND shiftright(reach[i], j) & 1 = 1)[0] AS cycle)))""")


def _large_components(edges: DataFrame) -> DataFrame:
    """Components of any traces, in rounds.

    Agents without a way in or out are peeled off. Then every agent takes the smallest name that reaches it, and
    whoever reaches that agent back inside its colour makes up its component; the rest
    starts again. All traces go at once; a round is a join and an aggregation over edges.
    """
    found, edges = [], _peeled(cut(edges))
    while not edges.isEmpty():
        colour = _spread(edges, edges.select("trace_id", F.col("src").alias("agent")).distinct()
                         .withColumn("cycle", F.col("agent")))
        # Edges inside one colour, turned round, lead from the colour's name to its component.
        mine = colour.select("trace_id", F.col("agent").alias("src"), "cycle")
        other = colour.select("trace_id", F.col("agent").alias("dst"), F.col("cycle").alias("into"))
        inside = cut(edges.join(mine, ["trace_id", "src"]).join(other, ["trace_id", "dst"]).where("cycle = into").select(
            "trace_id", "cycle", "src", "dst"))
        members = cut(inside.where("dst = cycle").select("trace_id", "cycle", F.col("dst").alias("agent")).distinct())
        size = 0
        while (grown := members.count()) > size:
            size = grown
            back = inside.join(members.withColumnRenamed("agent", "dst"), ["trace_id", "cycle", "dst"]).select(
                "trace_id", "cycle", F.col("src").alias("agent"))
            members = cut(members.unionByName(back).distinct())
        found.append(members)
        gone = members.select("trace_id", F.col("agent"))
        for end in ("src", "dst"):
            edges = edges.join(gone.withColumnRenamed("agent", end), ["trace_id", end], "left_anti")
        edges = _peeled(cut(edges))
    if not found:
        return edges.select("trace_id", F.col("src").alias("agent"), F.col("dst").alias("cycle")).where("false")
    return reduce(DataFrame.unionByName, found).select("trace_id", "agent", "cycle")


def _peeled(edges: DataFrame) -> DataFrame:
    """The edges whose start has a way in and whose end has a way out, again and again."""
    size = edges.count()
    while size:
        into = edges.select("trace_id", F.col("dst").alias("src")).distinct()
        out = edges.select("trace_id", F.col("src").alias("dst")).distinct()
        edges = cut(edges.join(into, ["trace_id", "src"], "left_semi").join(out, ["trace_id", "dst"], "left_semi"))
        left = edges.count()
        if left == size:
            break
        size = left
    return edges


def _spread(edges: DataFrame, colour: DataFrame) -> DataFrame:
    """The smallest name that reaches each agent along the edges."""
    colour = cut(colour)
    while True:
        sent = edges.join(colour.withColumnRenamed("agent", "src"), ["trace_id", "src"]).groupBy(
            "trace_id", F.col("dst").alias("agent")).agg(F.min("cycle").alias("seen"))
        changed = F.coalesce(F.col("seen") < F.col("cycle"), F.lit(False))
        new = cut(colour.join(sent, ["trace_id", "agent"], "left").select(
            "trace_id", "agent", F.least("cycle", "seen").alias("cycle"), changed.alias("changed")))
        colour = new.drop("changed")
        if new.where("changed").isEmpty():
            return colour
