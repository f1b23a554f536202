"""Span trees: parent links, depths, critical paths.

Ordinary traces are small: their spans are gathered into one row per trace, and
array expressions do the rest after a single shuffle. Traces of more than
``SMALL_TRACE`` spans, however large, are worked on as rows spread over the
cluster.

Both ways use pointer doubling: every span keeps a pointer to an ancestor and
what lies between, and each round replaces the pointer by the pointer of that
ancestor, so depth ``d`` takes about log2(d) rounds.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import cut
from . import skew
from .replay import agent_label
from .skew import join_unique, number_rows

#: Traces up to this many spans are handled as one array.
SMALL_TRACE = 512


def by_size(records: DataFrame, small: int = SMALL_TRACE) -> tuple[DataFrame, DataFrame | None]:
    """Split records into those of small traces and those of large ones (if any).

    The sizes are exact counts, combined on the map side. They also tell which
    traces are too large for one task; the ``REPORTED`` largest of them are spread.
    """
    sizes = records.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n"))
    large = cut(sizes.where(F.col("n") > small))
    if large.isEmpty():
        return records, None
    hottest = large.where(F.col("n") > skew.HOT_ROWS).orderBy(F.desc("n"), "trace_id").limit(skew.REPORTED)
    hot = [r.trace_id for r in hottest.select("trace_id").collect()]
    ids = large.select("trace_id")
    return tuple(
        join_unique(records, ids, ["trace_id"], how, hot) for how in ("left_anti", "left_semi")
    )


def span_nodes(records: DataFrame) -> DataFrame:
    """One node per (trace, span): parent, time, agent and duration.

    Of several records with one span id the longest stands for the span.
    """
    duration = F.coalesce("duration_ms", F.lit(0)).cast("long")
    # Ties go by the whole row, as in the arrays of small traces.
    node = F.struct(
        (-duration).alias("rank"), F.col("timestamp"),
        F.nullif("parent_span_id", F.lit("")).alias("parent"),
        agent_label().alias("agent_name"), duration.alias("duration_ms"),
    )
    rows = records.select("trace_id", "span_id", node.alias("node"))
    return rows.groupBy("trace_id", "span_id").agg(
        F.min("node").alias("node"), F.count(F.lit(1)).alias("copies")
    ).select("trace_id", "span_id", "node.parent", "node.timestamp", "node.agent_name", "node.duration_ms", "copies")


def _gather(records: DataFrame) -> DataFrame:
    """One row per small trace with ``rows``, sorted by span, longest copy first."""
    duration = F.coalesce("duration_ms", F.lit(0)).cast("long")
    row = F.struct(
        "span_id", (-duration).alias("rank"), "timestamp",
        F.nullif("parent_span_id", F.lit("")).alias("parent"),
        agent_label().alias("agent_name"), duration.alias("duration_ms"),
    )
    return records.groupBy("trace_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))


def _with_nodes(body: Callable[[Column, Column], Column]) -> Column:
    """``body(nodes, up)`` over the ``rows`` of a trace.

    ``nodes`` are its spans in time order, one per span id. ``up`` holds the
    position of the parent of each (from 1), 0 for a missing one, NULL for none.
    """
    fields = ["timestamp", "span_id", "parent", "agent_name", "duration_ms"]
    first_of_span = lambda x, i: (i == 0) | (F.get("rows", i - 1)["span_id"] != x["span_id"])
    nodes = F.array_sort(F.transform(
        F.filter("rows", first_of_span), lambda x: F.struct(*[x[f].alias(f) for f in fields])))

    def with_up(nodes: Column) -> Column:
        up = let(nodes["span_id"], lambda ids: F.transform(
            nodes, lambda x: F.array_position(ids, x["parent"])))
        return let(up, lambda up: body(nodes, up))

    return let(nodes, with_up)


def _double(start: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Rounds of pointer doubling over an array of structs with field ``ptr``.

    ``merge(node, ancestor)`` builds the next state of a node. Nodes in cycles
    still have a pointer above 0 at the end.
    """
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size("rows") + 1)).cast("int"))

    def step(state: Column, _: Column) -> Column:
        return F.transform(state, lambda x: F.when(
            x["ptr"] > 0, merge(x, F.get(state, x["ptr"].cast("int") - 1))).otherwise(x))

    return F.aggregate(rounds, start, step)


def _best_chain(nodes: Column, up: Column) -> Column:
    """Positions of the nodes on the best chain."""
    start = F.transform(nodes, lambda x, i: F.struct(
        F.get(up, i).alias("ptr"), x["duration_ms"].alias("total"),
        F.array((i + 1).cast("long")).alias("chain")))
    merge = lambda x, above: F.struct(
        above["ptr"].alias("ptr"), (x["total"] + above["total"]).alias("total"),
        F.concat(above["chain"], x["chain"]).alias("chain"))

    def pick(rooted: Column) -> Column:
        # The order of structs does the choice: greatest total, then earliest chain.
        best = F.array_min(F.transform(rooted, lambda e: F.struct(
            (-e["total"]).alias("neg"), e["chain"].alias("chain"))))
        return (
            F.when(F.size(rooted) == 0, F.array(F.lit(1).cast("long")))
            .otherwise(let(best, lambda b: F.when(b["neg"] < 0, b["chain"])
                           .otherwise(F.array().cast("array<long>"))))
        )

    return let(F.filter(_double(start, merge), lambda e: e["ptr"].isNull()), pick)


def _small_paths(records: DataFrame) -> DataFrame:
    """Per small trace: ``steps``, the best chain from the root down."""
    def steps(nodes: Column, up: Column) -> Column:
        return F.transform(_best_chain(nodes, up), lambda at, i: let(
            F.get(nodes, at.cast("int") - 1), lambda n: F.struct(
                i.cast("long").alias("position"), n["span_id"].alias("span_id"),
                n["agent_name"].alias("agent_name"), n["duration_ms"].alias("duration_ms"))))

    return _gather(records).select("trace_id", _with_nodes(steps).alias("steps"))


def _small_tree(records: DataFrame) -> DataFrame:
    """Tree rows of small traces."""
    def rows(nodes: Column, up: Column) -> Column:
        start = F.transform(nodes, lambda x, i: F.struct(
            F.nullif(F.get(up, i), F.lit(0)).alias("ptr"),
            F.when(F.get(up, i) > 0, 1).otherwise(0).cast("long").alias("depth"),
            x["span_id"].alias("top")))
        merge = lambda x, above: F.struct(
            above["ptr"].alias("ptr"), (x["depth"] + above["depth"]).alias("depth"),
            above["top"].alias("top"))
        links = F.transform(up, lambda u: F.coalesce(u, F.lit(0)))

        def row(ends: Column, links: Column, x: Column, i: Column) -> Column:
            own, end = F.get(links, i), F.get(ends, i)
            return F.struct(
                x["span_id"].alias("span_id"),
                F.when(own > 0, x["parent"]).alias("parent_span_id"),
                (own == 0).alias("is_root"),
                end["depth"].alias("depth"), end["top"].alias("root_span_id"),
                F.size(F.filter(F.slice(links, F.lit(1), i + 1), lambda u: u == own))
                 .cast("long").alias("sibling_no"),
                F.size(F.filter(links, lambda u: u == i + 1)).cast("long").alias("child_count"),
                F.size(F.filter("rows", lambda y: y["span_id"] == x["span_id"])).cast("long").alias("copies"),
                end["ptr"].isNull().alias("has_root"),
            )

        return let(_double(start, merge), lambda ends: let(links, lambda links: F.transform(
            nodes, lambda x, i: row(ends, links, x, i))))

    out = _gather(records).select("trace_id", F.explode(_with_nodes(rows)).alias("n"))
    return out.where("n.has_root").select("trace_id", "n.*").drop("has_root")


def forest_json(records: DataFrame, small: int = SMALL_TRACE) -> DataFrame:
    """The span forest of every trace as one nested JSON text.

    Children stand in time order under ``children``. Such a value has to fit into one
    row. ``forest_pieces`` has the same text as rows, for traces too large for that.
    """
    def build(nodes: Column, up: Column) -> Column:
        start = F.transform(nodes, lambda x, i: F.struct(
            F.nullif(F.get(up, i), F.lit(0)).alias("ptr"),
            F.when(F.get(up, i) > 0, 1).otherwise(0).cast("long").alias("depth")))
        merge = lambda x, above: F.struct(
            above["ptr"].alias("ptr"), (x["depth"] + above["depth"]).alias("depth"))
        # Deepest first, so that children are complete before their parent.
        order = lambda ends: F.array_sort(F.filter(
            F.transform(ends, lambda e, i: F.struct(
                (-e["depth"]).alias("level"), i.alias("i"), e["ptr"].alias("ptr"))),
            lambda o: o["ptr"].isNull()))
        # Slot 0 collects the roots, slot i the children of node i.
        empty = F.transform(F.sequence(F.lit(0), F.size(nodes)), lambda _: F.array().cast("array<string>"))

        def add(slots: Column, o: Column) -> Column:
            node = F.get(nodes, o["i"])
            fields = F.to_json(F.struct(*[node[c].alias(c) for c in ("span_id", "agent_name", "duration_ms")]))
            text = F.concat(
                F.regexp_replace(fields, r"\}$", ""), F.lit(',"children":['),
                F.array_join(F.get(slots, o["i"] + 1), ","), F.lit("]}"))
            home = F.coalesce(F.get(up, o["i"]), F.lit(0))
            return let(text, lambda t: F.transform(
                slots, lambda slot, j: F.when(j == home, F.array_append(slot, t)).otherwise(slot)))

        filled = F.aggregate(order(_double(start, merge)), empty, add)
        return F.concat(F.lit("["), F.array_join(F.get(filled, F.lit(0)), ","), F.lit("]"))

    ordinary, large = by_size(records, small)
    out = _gather(ordinary).select("trace_id", _with_nodes(build).alias("forest"))
    if large is None:
        return out
    return out.unionByName(_large_forests(large))


def _large_forests(records: DataFrame) -> DataFrame:
    """The texts of large traces, put together from their pieces."""
    piece = F.sort_array(F.collect_list(F.struct("position", "piece")))
    inside = F.array_join(F.transform(piece, lambda p: p["piece"]), "")
    texts = forest_pieces(records).groupBy("trace_id").agg(inside.alias("text"))
    # A trace whose spans all run in circles has an empty forest.
    return records.select("trace_id").distinct().join(texts, "trace_id", "left").select(
        "trace_id", F.concat(F.lit("["), F.coalesce("text", F.lit("")), F.lit("]")).alias("forest"))


def forest_pieces(records: DataFrame) -> DataFrame:
    """The nested JSON of every trace as rows: trace_id, position, depth, piece.

    Joined by position and put in brackets, the pieces of a trace are ``forest_json``; no
    text and no task holds a whole trace. A span stands before its children: its position
    is the sum, down from the root, of the spans that stand before it among its siblings'
    subtrees. Sizes of subtrees are summed up by doubled pointers, 2^k steps a round.
    """
    text = F.to_json(F.struct("span_id", "agent_name", "duration_ms"))
    nodes = cut(span_nodes(records).select("trace_id", "span_id", "parent", "timestamp", text.alias("text")))
    known = nodes.select("trace_id", F.col("span_id").alias("parent"), F.lit(True).alias("known"))
    linked = cut(join_unique(nodes, known, ["trace_id", "parent"], "left").withColumn(
        "parent", F.when(F.col("known"), F.col("parent"))).drop("known"))
    _, levels = climb(linked.withColumn("weight", F.lit(0).cast("long")))
    sizes = linked.select("trace_id", "span_id", F.lit(1).cast("long").alias("size"))
    for level in levels:
        # Below a span within twice the distance: what was counted, and that of the spans 2^k steps down.
        deeper = level.join(sizes, ["trace_id", "span_id"]).groupBy("trace_id", F.col("ptr").alias("span_id")).agg(
            F.sum("size").alias("more"))
        sizes = cut(sizes.join(deeper, ["trace_id", "span_id"], "left").select(
            "trace_id", "span_id", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
    siblings = Window.partitionBy("trace_id", "parent").orderBy("timestamp", "span_id")
    ahead = F.coalesce(F.sum("size").over(siblings.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cut(linked.join(sizes, ["trace_id", "span_id"]).withColumns({
        "nth": F.row_number().over(siblings), "weight": ahead + F.when(F.col("parent").isNull(), 0).otherwise(1)}))
    reached, _ = climb(placed.select("trace_id", "span_id", "parent", "weight"))
    ordered = cut(reached.select("trace_id", "span_id", F.col("total").alias("position"), "depth").join(
        placed.select("trace_id", "span_id", "nth", "text"), ["trace_id", "span_id"]))
    after = ordered.select("trace_id", (F.col("position") - 1).alias("position"), F.col("depth").alias("next"))
    closed = F.when(F.col("next").isNull(), F.col("depth") + 1).otherwise(F.col("depth") + 1 - F.col("next"))
    piece = F.concat(F.when(F.col("nth") > 1, ",").otherwise(""), F.regexp_replace("text", r"\}$", ""),
                     F.lit(',"children":['), F.repeat(F.lit("]}"), closed.cast("int")))
    return join_unique(ordered, after, ["trace_id", "position"], "left").select(
        "trace_id", "position", "depth", piece.alias("piece"))


def climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Follow ``parent`` of every node up to the top.

    ``nodes`` holds trace_id, span_id, parent (NULL at a root) and weight, and
    should be materialised, as every round reads it.
    Returns (reached, levels). ``reached`` has one row per node that ends at a
    root or at a missing parent: its parent and depth, the sum of weights from
    the top to the node, the top span and ``rooted`` (whether the top is a real
    root).
    Nodes on or below a cycle never end and are left out. ``levels[k]`` maps a
    node to its ancestor 2^k steps up.
    """
    start = nodes.select(
        "trace_id", "span_id", "parent",
        F.col("parent").alias("ptr"),
        F.col("weight").alias("total"),
        F.col("parent").isNotNull().cast("long").alias("depth"),
        F.col("span_id").alias("top"),
        F.lit(True).alias("rooted"),
    )
    done = [start.where(F.col("ptr").isNull())]
    moving = start.where(F.col("ptr").isNotNull())
    left = moving.count()
    levels = []
    while left:
        levels.append(moving.select("trace_id", "span_id", "ptr"))
        above = reduce(DataFrame.unionByName, [*done, moving]).select(
            "trace_id", F.col("span_id").alias("ptr"),
            F.struct("ptr", "total", "depth", "top", "rooted").alias("up"),
        )
        pending = Observation()
        moved = cut(join_unique(moving, above, ["trace_id", "ptr"], "left").select(
            "trace_id", "span_id", "parent",
            F.col("up.ptr").alias("ptr"),
            (F.col("total") + F.coalesce("up.total", F.lit(0))).alias("total"),
            # A missing parent ends the climb one step earlier, at the orphan.
            (F.col("depth") + F.coalesce("up.depth", F.lit(-1))).alias("depth"),
            F.coalesce("up.top", "top").alias("top"),
            F.coalesce("up.rooted", F.lit(False)).alias("rooted"),
        ).observe(pending, F.count("ptr").alias("n")))
        done.append(moved.where(F.col("ptr").isNull()))
        moving = moved.where(F.col("ptr").isNotNull())
        still = pending.get["n"]
        # No node arrived in this round: all that is left runs in cycles.
        left = 0 if still == left else still
    return reduce(DataFrame.unionByName, done).drop("ptr"), levels


def with_ancestors(picked: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The picked nodes (trace_id, span_id) and all nodes above them, once each.

    Going through the doubled pointers from the widest down adds every distance.
    """
    out = picked.select("trace_id", "span_id").distinct()
    both = F.array_compact(F.array("span_id", "ptr"))
    for level in reversed(levels):
        out = (
            out.join(level, ["trace_id", "span_id"], "left")
            .select("trace_id", F.explode(both).alias("span_id"))
            .distinct()
        )
    return out


def span_tree(records: DataFrame, small: int = SMALL_TRACE, hot: list | None = None) -> DataFrame:
    """The forest of every trace as rows: depth, root, place among siblings.

    A span whose parent is missing is a root. Spans in cycles have no root and
    do not appear. Children are numbered in time order; the number of children
    comes as a count, so that a wide parent never becomes one large value.
    ``copies`` says how many records have the span's id.
    """
    ordinary, large = by_size(records, small)
    out = _small_tree(ordinary)
    return out if large is None else out.unionByName(_large_tree(large, hot))


def _large_tree(records: DataFrame, hot: list | None) -> DataFrame:
    nodes = cut(span_nodes(records))
    known = nodes.select("trace_id", F.col("span_id").alias("parent"), F.lit(True).alias("known"))
    linked = join_unique(nodes, known, ["trace_id", "parent"], "left").withColumn(
        "parent", F.when(F.col("known"), F.col("parent"))
    ).drop("known")
    linked = cut(linked)
    reached, _ = climb(linked.withColumn("weight", F.lit(0).cast("long")))
    counts = linked.where(F.col("parent").isNotNull()).groupBy(
        "trace_id", F.col("parent").alias("span_id")
    ).agg(F.count(F.lit(1)).alias("child_count"))
    order = [F.col("timestamp"), F.col("span_id")]
    placed = number_rows(linked, ["trace_id", "parent"], order, "sibling_no", hot)
    return (
        placed.join(reached.select("trace_id", "span_id", "depth", "top"), ["trace_id", "span_id"])
        .join(counts, ["trace_id", "span_id"], "left")
        .select(
            "trace_id", "span_id", F.col("parent").alias("parent_span_id"),
            F.col("parent").isNull().alias("is_root"),
            "depth", F.col("top").alias("root_span_id"), "sibling_no",
            F.coalesce("child_count", F.lit(0)).alias("child_count"), "copies",
        )
    )


def critical_path_steps(records: DataFrame, small: int = SMALL_TRACE) -> DataFrame:
    """The root-to-node chain with the greatest summed duration, one row per step.

    Among equal chains the one that goes through earlier siblings wins, a chain
    before its own extension. A trace without any root yields its first step; a
    trace whose greatest sum is 0 yields nothing.
    """
    ordinary, large = by_size(records, small)
    steps = _small_paths(ordinary).select("trace_id", F.explode("steps").alias("n")).select(
        "trace_id", "n.*")
    return steps if large is None else steps.unionByName(_large_path_steps(large))


def critical_paths(records: DataFrame, small: int = SMALL_TRACE) -> DataFrame:
    """One row per trace that has a path: its length and duration.

    The path itself is ``critical_path_steps``, as rows whatever its length.
    """
    ordinary, large = by_size(records, small)
    total = F.aggregate("steps", F.lit(0).cast("long"), lambda s, n: s + n["duration_ms"])
    out = _small_paths(ordinary).where(F.size("steps") > 0).select(
        "trace_id", F.size("steps").cast("long").alias("path_length"),
        total.alias("path_duration_ms"),
    )
    if large is None:
        return out
    return out.unionByName(_large_path_steps(large).groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("path_length"), F.sum("duration_ms").alias("path_duration_ms")))


def _large_path_steps(records: DataFrame) -> DataFrame:
    nodes = cut(span_nodes(records))
    reached, levels = climb(nodes.withColumn("weight", F.col("duration_ms")))
    sums = reached.where("rooted").select("trace_id", "span_id", "parent", "total")
    best = sums.groupBy("trace_id").agg(F.max("total").alias("total")).where(F.col("total") > 0)
    ends = cut(join_unique(sums, best, ["trace_id", "total"], "left_semi").drop("total"))
    above = ends.select("trace_id", F.col("span_id").alias("parent"))
    # A chain that only lengthens another best chain loses against it.
    shortest = join_unique(ends, above, ["trace_id", "parent"], "left_anti")
    tied = shortest.groupBy("trace_id").count().where(F.col("count") > 1)
    tight = with_ancestors(shortest, levels).join(nodes, ["trace_id", "span_id"])
    if tied.isEmpty():
        path = tight.join(reached.select("trace_id", "span_id", "depth"), ["trace_id", "span_id"])
    else:
        path = _first_branches(tight, above)
    steps = path.select(
        "trace_id", F.col("depth").alias("position"), "span_id", "agent_name", "duration_ms"
    )
    first = F.min(F.struct("timestamp", "span_id", "agent_name", "duration_ms")).alias("first")
    rootless = (
        nodes.groupBy("trace_id")
        .agg(F.bool_or(F.col("parent").isNull()).alias("has_root"), first)
        .where(~F.col("has_root"))
        .select(
            "trace_id", F.lit(0).cast("long").alias("position"), "first.span_id",
            "first.agent_name", "first.duration_ms",
        )
    )
    return steps.unionByName(rootless)


def _first_branches(tight: DataFrame, ends_above: DataFrame) -> DataFrame:
    """Of all nodes on best chains, those on the chain through first siblings."""
    kept = join_unique(tight, ends_above, ["trace_id", "parent"], "left_anti")
    first = kept.groupBy("trace_id", "parent").agg(
        F.min(F.struct("timestamp", "span_id", "agent_name", "duration_ms")).alias("n")
    ).select("trace_id", "parent", "n.*")
    first = cut(first)
    # What still hangs on a real root through first siblings only is the answer.
    reached, _ = climb(first.withColumn("weight", F.lit(0).cast("long")))
    alive = reached.where("rooted").select("trace_id", "span_id", "depth")
    return first.join(alive, ["trace_id", "span_id"])
