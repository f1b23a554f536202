"""Tail sampling decided per trace inside the stream.

Every trace has state, kept with that of the other traces of its group. Its first span sets
a time by the event clock; until then, its spans wait in a list of the state store (on disk,
a few seconds of a trace).
Then the policy is judged on the spans that started within the wait, the spans of a kept
trace are sent on, and only the verdict stays. Later spans of the trace, after a pause of
any length, follow the verdict at once. The verdict itself is forgotten at a second time;
a span after that opens the trace anew. Nothing written before is read again, so a batch
costs what its own spans cost, however long the history is.

Spans that are later than the watermark are left out by the stream itself and counted
(``pipeline.LateRows``). Spans without trace id or start time are no part of a trace and
are left out as well.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..operators.convert import redact_attributes, truncate_long_text
from ..operators.sampling import Policy, lucky, span_flags
from ..schema import SPAN
from .pipeline import _start, split

#: Time from a trace's first span to its verdict.
WAIT_SECONDS = 10
#: How long a verdict is remembered after it was made.
REMEMBER_SECONDS = 3600
#: How late a span may come and still count for the verdict.
DELAY = "1 minute"

#: Traces are dealt to so many groups by hash; those of a group share one state, so that a
#: call to the state serves all of them. More groups: fewer traces to look through in each.
GROUPS = 1 << 14
#: Spans in one item of the state; item by item they cost far less than one by one.
CHUNK = 4096

#: JSON of a span keeps microseconds and empty values.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


class Verdicts(StatefulProcessor):
    """Judges the traces of a group; yields the payloads of the spans of kept ones, each once."""

    def __init__(self, wait_ms: int, remember_ms: int, latency_ms: int):
        self.wait_ms, self.remember_ms, self.latency_ms = wait_ms, remember_ms, latency_ms

    def init(self, handle) -> None:
        self.handle = handle
        #: What waits, as JSON of many spans each: trace, start, end, what a span says of its trace, and its text.
        self.waiting = handle.getListState("waiting", "spans string")
        #: The timer set for the group and its traces as JSON: start of the first span, when the
        #: trace is due (to be judged or forgotten), whether it is judged, and lucky or the verdict.
        self.group = handle.getValueState("group", "timer_ms long, traces string")

    def _read(self) -> tuple[int | None, dict[str, list]]:
        found = self.group.get()
        return (None, {}) if found is None else (found[0], json.loads(found[1]))

    def _waiting(self) -> Iterator[list]:
        for item in self.waiting.get():
            yield from json.loads(item[0])

    def _write(self, timer: int | None, traces: dict[str, list]) -> None:
        """Keep the traces, with one timer for the one that is due first."""
        due = min((trace[1] for trace in traces.values()), default=None)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if traces:
            self.group.update((due, json.dumps(traces)))
        else:
            self.group.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        timer, traces = self._read()
        came, changed = [], False
        for row in rows:
            trace = traces.get(row.trace_id)
            if trace is not None and trace[2]:
                if trace[3]:
                    yield Row(payload=row.payload)
                continue
            came.append((row.trace_id, row.start_us, row.end_us, row.flagged, row.payload))
            if len(came) == CHUNK:
                self.waiting.appendValue((json.dumps(came),))
                came = []
            if trace is None or row.start_us < trace[0]:
                traces[row.trace_id] = [row.start_us, -(-row.start_us // 1000) + self.wait_ms, False, row.is_lucky]
                changed = True
        if came:
            self.waiting.appendValue((json.dumps(came),))
        if changed:
            self._write(timer, traces)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, traces = self._read()
        fired, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        due = {name for name, trace in traces.items() if trace[1] <= fired or trace[1] < now}
        judged = {name: [False, traces[name][0]] for name in due if not traces[name][2]}
        if judged:
            for name, start_us, end_us, flagged, _ in self._waiting():
                if name in judged and start_us <= traces[name][0] + 1000 * self.wait_ms:
                    says = judged[name]
                    says[0] = says[0] or flagged
                    says[1] = max(says[1], end_us or says[1])
            for name, (flagged, last_end) in judged.items():
                first, at, _, lucky = traces[name]
                keep = bool(lucky or flagged or last_end - first > 1000 * self.latency_ms)
                traces[name] = [first, at + self.remember_ms, True, keep]
            left = []
            for span in self._waiting():
                if span[0] not in judged:
                    left.append(span)
                elif traces[span[0]][3]:
                    yield Row(payload=span[4])
            if left:
                self.waiting.put([(json.dumps(left[at:at + CHUNK]),) for at in range(0, len(left), CHUNK)])
            else:
                self.waiting.clear()
        for name in due - judged.keys():
            del traces[name]
        # The timer that fired is gone.
        self._write(None, traces)

    def close(self) -> None:
        pass


def kept_spans(spans: DataFrame, policy: Policy = Policy(), wait_seconds: float = WAIT_SECONDS,
               remember_seconds: float = REMEMBER_SECONDS, delay: str = DELAY) -> DataFrame:
    """The spans of kept traces, from a stream of spans; needs the RocksDB state store."""
    spans.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    flagged = F.col("is_error") | F.col("is_failed_check") | F.col("is_risky")
    rows = span_flags(spans.where("trace_id IS NOT NULL AND start_time IS NOT NULL"), policy).select(
        F.pmod(F.xxhash64("trace_id"), F.lit(GROUPS)).alias("trace_group"),
        "trace_id", "start_time", F.unix_micros("start_time").alias("start_us"),
        F.unix_micros("end_time").alias("end_us"), flagged.alias("flagged"),
        lucky(F.col("trace_id"), policy.success_percent).alias("is_lucky"),
        F.to_json(F.struct(*[f.name for f in SPAN]), JSON).alias("payload"))
    processor = Verdicts(round(1000 * wait_seconds), round(1000 * remember_seconds), policy.latency_ms)
    kept = rows.withWatermark("start_time", delay).groupBy("trace_group").transformWithState(
        processor, "payload string", "Append", "EventTime")
    return kept.select(F.from_json("payload", SPAN, JSON).alias("span")).select("span.*")


def sample(spans: DataFrame, path: str, quarantine_path: str, checkpoint: str, policy: Policy = Policy(),
           wait_seconds: float = WAIT_SECONDS, remember_seconds: float = REMEMBER_SECONDS, delay: str = DELAY,
           once: bool = False, capture_content: bool = False) -> StreamingQuery:
    """Write the records of kept traces as their traces are decided, and of late spans as they come.

    Spans are redacted before they wait in the state. A repeated batch replaces what it wrote.
    """
    clean = truncate_long_text(redact_attributes(spans, capture_content))
    kept = kept_spans(clean, policy, wait_seconds, remember_seconds, delay)
    writer = kept.writeStream.foreachBatch(
        lambda batch, batch_id: split(batch, path, quarantine_path, batch_id)
    ).outputMode("append").option("checkpointLocation", checkpoint)
    return _start(writer, once)


def decide(spans: DataFrame, policy: Policy = Policy(), wait_seconds: float = WAIT_SECONDS) -> DataFrame:
    """The verdicts in batch: one row per trace, judged on the spans that start within the wait."""
    placed = span_flags(spans.where("trace_id IS NOT NULL AND start_time IS NOT NULL"), policy).join(
        spans.groupBy("trace_id").agg(F.min("start_time").alias("first_start")), "trace_id")
    inside = F.unix_micros("start_time") - F.unix_micros("first_start") <= round(1e6 * wait_seconds)
    flags = placed.groupBy("trace_id", "first_start").agg(
        F.bool_or(inside & (F.col("is_error") | F.col("is_failed_check") | F.col("is_risky"))).alias("flagged"),
        F.max(F.when(inside, F.col("end_time"))).alias("last_end"), F.count_if(inside).alias("judged"),
        F.count(F.lit(1)).alias("spans"))
    slow = F.coalesce(F.unix_micros("last_end") - F.unix_micros("first_start") > 1000 * policy.latency_ms, F.lit(False))
    return flags.withColumn("keep", F.col("flagged") | slow | lucky(F.col("trace_id"), policy.success_percent))
