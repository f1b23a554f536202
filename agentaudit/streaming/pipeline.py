"""Streams: staging of spans, tail sampling, metrics, alerts.

Sampling works in two steps that both survive a restart. Spans are first staged
as they arrive. A second stream reads the staged spans and keeps, per trace, only
flags and times in a session window; when the window closes, the spans of kept
traces are copied from the staged table. No trace is ever buffered in state, so
a trace of any size costs a few bytes there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import hex_id
from ..operators import sketches
from ..operators.convert import checked_records, redact_attributes, truncate_long_text
from ..operators.cost import tokens
from ..operators.lookup import flag
from ..operators.sampling import Policy, flag_aggregates, span_flags, with_decision
from ..operators.skew import join_unique
from ..sources import otlp
from ..sources.export import export as export_lines
from ..sources.tables import BATCH_ROWS, BATCH_SECONDS

#: Quiet time after which a trace is decided.
DECISION_WAIT = "10 seconds"
#: How late a span may come and still count for the decision.
DELAY = "1 minute"


def _start(writer, once: bool) -> StreamingQuery:
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{BATCH_SECONDS} seconds").start()


def stage(spans: DataFrame, path: str, checkpoint: str, once: bool = False,
          capture_content: bool = False) -> StreamingQuery:
    """Append spans to the staged table, redacted for export; exactly once."""
    out = truncate_long_text(redact_attributes(spans, capture_content))
    writer = (
        out.withColumns({"date": F.to_date("start_time"), "hour": F.hour("start_time")})
        .writeStream.format("parquet").partitionBy("date", "hour")
        .option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", BATCH_ROWS * 1024)
        .outputMode("append")
    )
    return _start(writer, once)


def land(records: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of records by day; a repeated batch replaces its own rows."""
    (
        records.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(path)
    )


def split(spans: DataFrame, path: str, quarantine_path: str, batch_id: int) -> None:
    """Land the valid records of one batch of spans, and the others in quarantine."""
    checked = checked_records(spans).persist()
    land(checked.where(F.size("violations") == 0).drop("violations"), path, batch_id)
    checked.where(F.size("violations") > 0).write.mode("overwrite").parquet(
        f"{quarantine_path}/batch={batch_id}")
    checked.unpersist()


def ingest(spans: DataFrame, path: str, quarantine_path: str, checkpoint: str, once: bool = False,
           exporters: Sequence[Callable[[DataFrame, int], None]] = (),
           capture_content: bool = False) -> StreamingQuery:
    """Convert spans to records; valid ones to the table, others to quarantine.

    A repeated batch replaces what it wrote before, so a restart neither loses
    nor doubles rows. Prompts, answers and user ids are redacted before anything else
    happens; ``exporters`` get each redacted batch as well. ``tables.settle_day``
    moves finished days from here to the clustered record table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        split(batch, path, quarantine_path, batch_id)
        for export in exporters:
            export(batch, batch_id)

    writer = truncate_long_text(redact_attributes(spans, capture_content)).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, once)


def export(spans: DataFrame, path: str, checkpoint: str, once: bool = False,
           capture_content: bool = False, compression: str = "none") -> StreamingQuery:
    """Write redacted spans as lines of the trace protocol for another collector, each once.

    ``compression`` is ``none`` or ``gzip``. Unlike the ``exporters`` of ``ingest``, which see a repeated batch again, this sink
    commits its batches.
    """
    lines = otlp.span_lines(truncate_long_text(redact_attributes(spans, capture_content)))
    return export_lines(lines, path, checkpoint, lambda writer: _start(writer, once), compression)


def session_decisions(spans: DataFrame, policy: Policy = Policy(), wait: str = DECISION_WAIT,
                      delay: str = DELAY) -> DataFrame:
    """Flags and verdict per trace and session, once the session is over."""
    flags = span_flags(spans, policy).withWatermark("start_time", delay)
    sessions = flags.groupBy(
        "trace_id", F.session_window("start_time", wait)
    ).agg(*flag_aggregates())
    return with_decision(sessions, policy).drop("session_window")


def combine(decisions: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One verdict per trace from the flags of all its sessions."""
    whole = decisions.groupBy("trace_id").agg(
        F.bool_or("has_error").alias("has_error"),
        F.min("first_start").alias("first_start"),
        F.max("last_start").alias("last_start"),
        F.max("last_end").alias("last_end"),
        F.bool_or("has_failed_check").alias("has_failed_check"),
        F.bool_or("has_risk").alias("has_risk"),
        F.sum("spans").alias("spans"),
    )
    return with_decision(whole, policy)


def sample(staged_stream: DataFrame, staged_path: str, path: str, decisions_path: str,
           checkpoint: str, policy: Policy = Policy(), wait: str = DECISION_WAIT,
           delay: str = DELAY, once: bool = False, quarantine_path: str | None = None) -> StreamingQuery:
    """Write the records of kept traces as soon as each trace is decided.

    ``staged_stream`` reads the table at ``staged_path``, so whatever is decided
    has been staged before. Each batch reads only the hours in which its kept sessions
    have spans. A session is matched by the start times of its spans: the sessions of a
    trace are disjoint there, so that no span is written twice, however long its root
    lasts. Records that break the contract go to ``quarantine_path`` (beside ``path``
    if not given).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{decisions_path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        decided = spark.read.schema(batch.schema).parquet(target)
        kept = decided.where("keep")
        whole_hour = lambda c: F.date_trunc("hour", c)
        hours = kept.select(F.explode(F.sequence(
            whole_hour("first_start"), whole_hour("last_start"), F.expr("interval 1 hour"))).alias("h")
        ).distinct().select(F.to_date("h").alias("date"), F.hour("h").alias("hour"))
        # One row per hour of the batch's sessions; their days and hours prune the scan.
        read = [(r["date"], r["hour"]) for r in hours.collect()]
        if not read:
            return
        staged = spark.read.parquet(staged_path).where(
            F.col("date").isin(sorted({d for d, _ in read})) & F.col("hour").isin(sorted({h for _, h in read})))
        sessions = kept.select("trace_id", "first_start", "last_start")
        inside = F.col("start_time").between(F.col("first_start"), F.col("last_start"))
        mine = staged.join(sessions, "trace_id").where(inside).drop("first_start", "last_start", "date", "hour")
        split(mine, path, quarantine_path or f"{path.rstrip('/')}-quarantine", batch_id)

    writer = (
        session_decisions(staged_stream, policy, wait, delay).writeStream
        .foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    )
    return _start(writer, once)


def late_spans(staged: DataFrame, decisions: DataFrame, records: DataFrame,
               policy: Policy = Policy()) -> DataFrame:
    """Staged spans of kept traces that are not among the records yet.

    Covers spans that came after their trace was decided, and traces whose
    sessions are kept only when taken together. Run it as a batch job now and
    then, and append the result.
    """
    kept = combine(decisions, policy).where("keep").select("trace_id")
    mine = join_unique(staged, kept, ["trace_id"], "left_semi")
    have = records.select(F.col("trace_id").alias("_trace"), F.col("span_id").alias("_span"))
    same = (hex_id(F.col("trace_id"), 32) == F.col("_trace")) & (
        hex_id(F.col("span_id"), 16) == F.col("_span"))
    return mine.join(have, same, "left_anti")


class LateRows(StreamingQueryListener):
    """Counts the rows queries leave out because they came after the watermark.

    A query itself remembers its last progresses only; register this with
    ``spark.streams.addListener`` before the query starts. ``count`` is by query id.
    """

    def __init__(self):
        self.count: dict[str, int] = {}

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.count[key] = self.count.get(key, 0) + late

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def metric_windows(records: DataFrame, width: str = "30 seconds", delay: str = DELAY) -> DataFrame:
    """Latency with its 95th percentile, tokens and time per token by window, operation and model.

    ``sketch`` keeps the window's durations for coarser windows (``sketches.roll_up``).
    """
    seconds = F.col("duration_ms") / 1000
    per_token = seconds / F.nullif("output_tokens", F.lit(0))
    return (
        records.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", width), "operation_name", "model_name")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.avg(seconds).alias("avg_s"),
            F.sum(tokens()).alias("tokens"),
            F.avg(per_token).alias("avg_s_per_token"),
            F.kll_sketch_agg_bigint(F.col("duration_ms").cast("long"), F.lit(sketches.SIZE)).alias("sketch"),
        )
        .select(F.col("window.start").alias("window_start"), "operation_name", "model_name",
                "calls", "avg_s", "tokens", "avg_s_per_token",
                sketches.percentile(F.col("sketch"), 0.95).alias("p95_ms"), "sketch")
    )


def alert_windows(records: DataFrame, cost_usd: float, failure_rate: float, p99_ms: float,
                  width: str = "5 minutes", slide: str = "1 minute", delay: str = DELAY) -> DataFrame:
    """Sliding windows per agent that break a limit, with the limits they break."""
    passed = flag("all_passed", records)
    window = F.window("timestamp", width, slide)
    sums = (
        records.withWatermark("timestamp", delay).groupBy(window, "agent_id").agg(
            F.sum("cost_usd").cast("double").alias("cost"),
            F.avg(F.when(passed.isNotNull(), (~passed).cast("int"))).alias("failure_rate"),
            F.percentile_approx("duration_ms", F.lit(0.99), F.lit(1000)).alias("p99_ms"),
        )
    )
    broken = F.array_compact(F.array(
        F.when(F.col("cost") > cost_usd, "cost"),
        F.when(F.col("failure_rate") > failure_rate, "guardrail_failure_rate"),
        F.when(F.col("p99_ms") > p99_ms, "p99_latency"),
    ))
    return sums.withColumn("alerts", broken).where(F.size("alerts") > 0).select(
        F.col("window.start").alias("window_start"), "agent_id", "cost", "failure_rate", "p99_ms",
        F.array_join("alerts", ",").alias("alerts"),
    )


def trace_cost_windows(records: DataFrame, cost_usd: float, width: str = "1 hour",
                       delay: str = DELAY) -> DataFrame:
    """Traces whose records in a window cost more than a limit."""
    costs = (
        records.withWatermark("timestamp", delay).groupBy(F.window("timestamp", width), "trace_id")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("cost_usd").alias("cost"))
    )
    return costs.where(F.col("cost") > F.lit(cost_usd).cast("decimal(20,6)")).select(
        F.col("window.start").alias("window_start"), "trace_id", "records", "cost")


def to_table(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the finished windows of a stream to a Parquet table; exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "path", path).option("checkpointLocation", checkpoint)
    return _start(writer, once)
