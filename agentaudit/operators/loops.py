"""Detection of agents that repeat themselves inside a trace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .replay import agent_label
from .skew import join_unique, number_rows
from .tree import climb

#: Repeats after which an agent counts as caught in a loop.
LOOP_LIMIT = 5


def loops(records: DataFrame, limit: int = LOOP_LIMIT, hot: list | None = None) -> DataFrame:
    """Repeated work per trace, agent, operation and chosen action.

    Gives the number of repeats, the longest unbroken run, and when the limit
    was reached (NULL if it was not). Runs are found by the difference of two
    row numbers, which needs no frame over a whole trace in one task.
    """
    step = ["trace_id", "agent", "operation", "action"]
    rows = records.select(
        "trace_id", "timestamp", "span_id",
        agent_label().alias("agent"),
        F.coalesce("operation_name", F.lit("unknown")).alias("operation"),
        F.coalesce(F.get_json_object("reasoning", "$.selected_action"), F.lit("")).alias("action"),
    )
    order = [F.col("timestamp"), F.col("span_id")]
    placed = number_rows(number_rows(rows, ["trace_id"], order, "seq", hot), step, order, "nth", hot)
    runs = placed.groupBy(*step, (F.col("seq") - F.col("nth")).alias("island")).agg(
        F.count(F.lit(1)).alias("run"),
        F.min(F.when(F.col("nth") == limit, F.col("timestamp"))).alias("tripped_at"),
    )
    return runs.groupBy(*step).agg(
        F.sum("run").alias("repeats"),
        F.max("run").alias("longest_run"),
        F.min("tripped_at").alias("tripped_at"),
    )


def caught(records: DataFrame, limit: int = LOOP_LIMIT, hot: list | None = None) -> DataFrame:
    """Only the repeats that reached the limit."""
    return loops(records, limit, hot).where(F.col("repeats") >= limit)


def block_loops(records: DataFrame, limit: int = LOOP_LIMIT, longest: int = 32,
                hot: list | None = None) -> DataFrame:
    """Blocks of up to ``longest`` steps that a trace repeats without a break, ``limit`` times or more.

    One row per unbroken stretch and its smallest period: trace_id, period, turns (whole
    turns of the block), first_seq, last_seq, started_at and block (its steps). A step is
    agent, operation and chosen action; A B A B A B has period 2 and three turns. ``limit``
    is 3 at least.

    Blocks of m = 1, 2, 4, ... steps are known by a hash, that of m by two of m / 2. Inside
    a stretch of period p with p <= m <= 2p, a block comes next exactly p steps later, so a
    stretch is a run of places with one distance to the next equal block. That is a join
    on (trace, place) and a numbering per doubling, with as many rows as there are steps,
    whatever the period. Stretches found by hashes are compared step by step in the end.
    """
    if limit < 3:
        raise ValueError("a loop has three turns at least")
    label = F.concat_ws(
        "\0", agent_label(), F.coalesce("operation_name", F.lit("unknown")),
        F.coalesce(F.get_json_object("reasoning", "$.selected_action"), F.lit("")))
    rows = records.select("trace_id", "timestamp", "span_id", label.alias("step"))
    steps = cut(number_rows(rows, ["trace_id"], [F.col("timestamp"), F.col("span_id")], "seq", hot).drop("span_id"))
    blocks = steps.select("trace_id", "seq", F.xxhash64("step").alias("hash"))
    found, m = [], 1
    while True:
        found.append(_stretches(blocks, m, longest, hot))
        if m >= longest:
            break
        later = blocks.select("trace_id", (F.col("seq") - m).alias("seq"), F.col("hash").alias("then"))
        blocks = cut(blocks.join(later, ["trace_id", "seq"]).select(
            "trace_id", "seq", F.xxhash64("hash", "then").alias("hash")))
        m *= 2
    loops = reduce(DataFrame.unionByName, found).withColumn(
        "turns", F.expr("(last_seq - first_seq + 1) div period")).where(F.col("turns") >= limit)
    return _compared(cut(loops), steps)


def _stretches(blocks: DataFrame, m: int, longest: int, hot: list | None) -> DataFrame:
    """Runs of places whose block of m steps comes next after the same distance, m at most."""
    nth = number_rows(blocks, ["trace_id", "hash"], [F.col("seq")], "nth", hot)
    after = nth.select("trace_id", "hash", (F.col("nth") - 1).alias("nth"), F.col("seq").alias("then"))
    near = nth.join(after, ["trace_id", "hash", "nth"]).select(
        "trace_id", "seq", (F.col("then") - F.col("seq")).alias("period")
    ).where((F.col("period") <= min(m, longest)) & (F.col("period") > m // 2))
    runs = number_rows(near, ["trace_id", "period"], [F.col("seq")], "at", hot)
    return runs.groupBy("trace_id", "period", (F.col("seq") - F.col("at")).alias("run")).agg(
        F.min("seq").alias("first_seq"), (F.max("seq") + F.col("period") + (m - 1)).alias("last_seq")).drop("run")


def _compared(loops: DataFrame, steps: DataFrame) -> DataFrame:
    """The stretches in which every step equals the one a period later, with their blocks."""
    key = ["trace_id", "period", "first_seq"]
    places = loops.select("*", F.explode(F.sequence("first_seq", "last_seq")).alias("seq"))
    later = steps.select("trace_id", F.col("seq").alias("next"), F.col("step").alias("again"))
    both = places.join(steps, ["trace_id", "seq"]).withColumn("next", F.col("seq") + F.col("period")).join(
        later, ["trace_id", "next"], "left")
    inside = F.col("seq") + F.col("period") <= F.col("last_seq")
    first = F.col("seq") < F.col("first_seq") + F.col("period")
    return both.groupBy(*key, "turns", "last_seq").agg(
        F.bool_and(~inside | F.coalesce(F.col("step") == F.col("again"), F.lit(False))).alias("same"),
        F.min(F.when(F.col("seq") == F.col("first_seq"), F.col("timestamp"))).alias("started_at"),
        F.sort_array(F.collect_list(F.when(first, F.struct("seq", "step")))).alias("block"),
    ).where("same").select(
        "trace_id", "period", "turns", "first_seq", "last_seq", "started_at",
        F.transform("block", lambda s: F.regexp_replace(F.rtrim(F.translate(s["step"], "\0", " ")), " +", " ")).alias("block"))


def smallest_loops(records: DataFrame, limit: int = LOOP_LIMIT, longest: int = 32,
                   hot: list | None = None) -> DataFrame:
    """Of each trace the loop with the smallest period, of those the one with most turns, then the first."""
    order = F.struct(F.col("period"), -F.col("turns"), F.col("first_seq"))
    every = block_loops(records, limit, longest, hot)
    return every.groupBy("trace_id").agg(F.min_by(F.struct(*[c for c in every.columns if c != "trace_id"]), order).alias("l")
                                         ).select("trace_id", "l.*")


def recursion(records: DataFrame, limit: int = LOOP_LIMIT) -> DataFrame:
    """Chains of spans down the tree in which one agent repeats one operation.

    One row per chain of at least ``limit`` spans: its top span and its length.
    Only links between equal steps are followed, so the number of rounds depends
    on the length of these chains alone.
    """
    step = F.struct(agent_label().alias("agent"), F.coalesce("operation_name", F.lit("unknown")).alias("operation"))
    nodes = cut(
        records.groupBy("trace_id", "span_id").agg(
            F.min(F.struct(F.nullif("parent_span_id", F.lit("")).alias("parent"), step.alias("step"))).alias("n")
        ).select("trace_id", "span_id", "n.*")
    )
    above = nodes.select("trace_id", F.col("span_id").alias("parent"), F.col("step").alias("above"))
    linked = cut(join_unique(nodes, above, ["trace_id", "parent"], "left").select(
        "trace_id", "span_id", "step",
        F.when(F.col("above") == F.col("step"), F.col("parent")).alias("parent"),
        F.lit(0).cast("long").alias("weight"),
    ))
    reached, _ = climb(linked)
    chains = reached.groupBy("trace_id", F.col("top").alias("span_id")).agg(
        (F.max("depth") + 1).alias("length")
    ).where(F.col("length") >= limit)
    return chains.join(linked, ["trace_id", "span_id"]).select(
        "trace_id", "span_id", "step.agent", "step.operation", "length"
    )
