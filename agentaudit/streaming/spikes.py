"""Unusual hours as a live alert: each closed hour of an agent against the 24 before it.

Records are summed by agent and hour first, with partial sums before the shuffle, so a hot
agent is one row an hour by the time it meets its state. When the watermark closes an hour,
the row goes to keyed state that holds a ring of the last hours' values; the row is judged
against the ring and joins it. For costs, hours without calls close as hours without cost,
for error rates they have no value, and an agent that is quiet for longer than the ring
loses its state by a timer. Results are those of ``cost.cost_spikes`` and ``cost.error_spikes``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from .pipeline import DELAY

HOUR_MS = 3_600_000


def judge(value: float | None, before: list[float | None], sigmas: float) -> tuple[float | None, float | None, bool]:
    """Mean and sample deviation of the hours before, and whether the value is above."""
    n, total, mean, squares = 0, 0.0, 0.0, 0.0
    for x in before:
        if x is not None:
            n += 1
            total += x
            delta = x - mean
            mean += delta / n
            squares += delta * (delta - delta / n)
    if not n:
        return None, None, False
    baseline, spread = total / n, sqrt(squares / (n - 1)) if n > 1 else None
    return baseline, spread, value is not None and spread is not None and value > baseline + sigmas * spread


class Ring(StatefulProcessor):
    """Judges the hours of one agent in their order."""

    def __init__(self, hours: int, sigmas: float, quiet: float | None):
        self.hours, self.sigmas, self.quiet = hours, sigmas, quiet

    def init(self, handle) -> None:
        self.handle = handle
        #: The last hours in order, with their values, and the timer that clears them.
        self.ring = handle.getValueState("ring", "hours array<bigint>, amounts array<double>, timer_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.ring.get()
        ring = list(zip(known[0], known[1])) if known is not None else []
        for row in sorted(rows, key=lambda r: r.hour_no):
            if self.quiet is not None and ring:
                # Only the hours that can still be in the ring have to be closed.
                begin = max(ring[-1][0] + 1, row.hour_no - self.hours)
                ring += [(h, self.quiet) for h in range(begin, row.hour_no)]
            ring = [(h, v) for h, v in ring if h >= row.hour_no - self.hours]
            baseline, spread, is_spike = judge(row.amount, [v for _, v in ring], self.sigmas)
            yield Row(agent_name=row.agent_name, hour_no=row.hour_no, calls=row.calls, amount=row.amount,
                      baseline=baseline, spread=spread, is_spike=is_spike)
            ring.append((row.hour_no, row.amount))
        timer = (ring[-1][0] + self.hours + 1) * HOUR_MS
        if self.quiet is None:
            if known is not None:
                self.handle.deleteTimer(known[2])
            self.handle.registerTimer(timer)
        self.ring.update(([h for h, _ in ring], [v for _, v in ring], timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.ring.clear()
        return iter(())

    def close(self) -> None:
        pass


def _closed_hours(records: DataFrame, amount, delay: str) -> DataFrame:
    hours = records.withWatermark("timestamp", delay).groupBy(F.window("timestamp", "1 hour"), "agent_name").agg(
        F.count(F.lit(1)).alias("calls"), amount.cast("double").alias("amount"))
    return hours.select(
        # A null name is a group like any other; keys of state are texts.
        F.coalesce(F.concat(F.lit("="), "agent_name"), F.lit("")).alias("agent"), "agent_name",
        F.window_time("window").alias("closed_at"), F.floor(F.unix_seconds("window.start") / 3600).alias("hour_no"),
        "calls", "amount")


def _spikes(hours: DataFrame, ring: Ring) -> DataFrame:
    hours.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    found = hours.groupBy("agent").transformWithState(
        ring, "agent_name string, hour_no long, calls long, amount double, baseline double, spread double, is_spike boolean",
        "Append", "EventTime")
    return found.withColumn("hour", F.timestamp_seconds(F.col("hour_no") * 3600))


def error_spikes(records: DataFrame, hours: int = 24, sigmas: float = 2.0, delay: str = DELAY) -> DataFrame:
    """Hourly error rate per agent of a stream of records; a row per agent and closed hour."""
    failed = F.avg((F.col("status") == "error").cast("int"))
    return _spikes(_closed_hours(records, failed, delay), Ring(hours, sigmas, None)).select(
        "agent_name", "hour", "calls", F.col("amount").alias("error_rate"), "baseline", "spread", "is_spike")


def cost_spikes(records: DataFrame, hours: int = 24, sigmas: float = 2.0, delay: str = DELAY) -> DataFrame:
    """Hourly cost per agent of a stream of records; quiet hours count as hours without cost."""
    return _spikes(_closed_hours(records, F.sum("cost_usd"), delay), Ring(hours, sigmas, 0.0)).select(
        "agent_name", "hour", F.col("amount").alias("cost"), "baseline", "spread", "is_spike")
