from datetime import timedelta

from pyspark.sql import functions as F

from agentaudit.operators import metrics, sampling
from agentaudit.plans import catalog
from agentaudit.schema import RECORD
from agentaudit.sources import spans as span_files, tables
from agentaudit.streaming import pipeline

from helpers import T0, at, event, record, records, span, spans


def test_each_policy_keeps(spark):
    none = sampling.Policy(success_percent=0)
    df = spans(
        spark,
        span("plain", "1"), span("error", "1"), span("error", "2", status_code="ERROR"),
        span("slow", "1"), span("slow", "2", end_time=at(5001)),
        span("edge", "1"), span("edge", "2", end_time=at(5000)),
        span("check", "1", events=[event("guardrail_check", guardrail__passed="false")]),
        span("attr", "1", attributes={"guardrail.passed": "false"}),
        span("risk", "1", attributes={"agent.risk_level": "critical"}))
    kept = {r.trace_id for r in sampling.decide(df, none).where("keep").collect()}
    assert kept == {"error", "slow", "check", "attr", "risk"}
    assert sampling.sample(df, none).count() == 7


def test_share_of_lucky_traces(spark):
    df = spark.range(20_000).select(F.lpad(F.hex("id"), 32, "0").alias("t"))
    share = df.where(sampling.lucky(F.col("t"), 10)).count() / 20_000
    assert 0.09 < share < 0.11
    assert df.where(sampling.lucky(F.col("t"), 100)).count() == 20_000


def run_sample(spark, root, *batches, wait="10 seconds"):
    """Stage and sample the batches one by one, as if they arrived over time."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{root}/spans")
        pipeline.stage(span_files.stream_spans(spark, f"{root}/spans"), f"{root}/staged", f"{root}/ck1",
                       once=True).awaitTermination()
        query = pipeline.sample(
            span_files.stream_spans(spark, f"{root}/staged"), f"{root}/staged", f"{root}/kept",
            f"{root}/decisions", f"{root}/ck2", policy=sampling.Policy(success_percent=0), wait=wait, once=True)
        query.awaitTermination()
    return query


def test_stream_equals_batch(spark, sf):
    got = catalog.QUERIES["stream_sample"](spark, sf)
    want = catalog.QUERIES["tail_sample"](spark, sf)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_late_and_split_traces(spark, tmp_path):
    root = str(tmp_path)
    minute = lambda n: T0 + timedelta(minutes=n)
    first = spans(
        spark, span("late", "1", status_code="ERROR"), span("split", "1"),
        span("plain", "1"), span("clock", "1", start_time=minute(10), end_time=minute(10)))
    # A pause longer than the wait: two sessions, neither of them slow by itself.
    second = spans(
        spark, span("split", "2", start_time=minute(11), end_time=minute(11)),
        span("clock", "2", start_time=minute(20), end_time=minute(20)))
    # Comes when its trace was decided long ago.
    third = spans(
        spark, span("late", "2", start_time=at(500), end_time=at(600)),
        span("clock", "3", start_time=minute(40), end_time=minute(40)))
    fourth = spans(spark, span("clock", "4", start_time=minute(60), end_time=minute(60)))
    for batch in (first, second, third):
        run_sample(spark, root, batch)
    query = run_sample(spark, root, fourth)
    assert query.exception() is None
    records = spark.read.parquet(f"{root}/kept")
    assert [(r.trace_id.lstrip("0"), r.span_id[-1]) for r in records.collect()] == [("late", "1")]
    missing = pipeline.late_spans(
        spark.read.parquet(f"{root}/staged"), spark.read.parquet(f"{root}/decisions"), records,
        sampling.Policy(success_percent=0))
    assert {(r.trace_id, r.span_id) for r in missing.collect()} == {
        ("late", "2"), ("split", "1"), ("split", "2"), *[("clock", str(i)) for i in (1, 2, 3, 4)]}


def test_ingest_is_exactly_once_and_quarantines(spark, tmp_path):
    root = str(tmp_path)
    seen = []
    start = lambda: pipeline.ingest(
        span_files.stream_spans(spark, f"{root}/spans"), f"{root}/records", f"{root}/bad", f"{root}/ck",
        once=True, exporters=[lambda batch, i: seen.append((i, batch.count()))]).awaitTermination()
    spans(spark, span("a", "1"), span("b", "2", start_time=None)).coalesce(1).write.parquet(f"{root}/spans")
    start()
    start()
    spans(spark, span("c", "3")).coalesce(1).write.mode("append").parquet(f"{root}/spans")
    start()
    assert spark.read.parquet(f"{root}/records").count() == 2
    assert [list(r.violations) for r in spark.read.parquet(f"{root}/bad").collect()] == [["timestamp is null"]]
    assert seen == [(0, 2), (1, 1)]


def test_staged_spans_are_redacted(spark, tmp_path):
    root = str(tmp_path)
    spans(spark, span(attributes={"gen_ai.input.messages": "secret", "x": "y"})).write.parquet(f"{root}/spans")
    pipeline.stage(span_files.stream_spans(spark, f"{root}/spans"), f"{root}/staged", f"{root}/ck", once=True).awaitTermination()
    assert spark.read.parquet(f"{root}/staged").first().attributes == {"x": "y"}


def test_metric_windows_on_a_stream(spark, sf, tmp_path):
    root = str(tmp_path)
    stream = catalog._record_stream(spark, sf, root).withWatermark("timestamp", "1 minute")
    batch = tables.read(spark, f"{root}/records").where("agent_id <> 'closing'")
    for name, run in (("duration", metrics.operation_duration), ("tokens", metrics.token_histogram)):
        out = f"{root}/{name}"
        pipeline.to_table(run(stream), out, f"{root}/ck-{name}", once=True).awaitTermination()
        got = [tuple(r) for r in spark.read.parquet(out).collect()]
        assert sorted(got, key=str) == sorted((tuple(r) for r in run(batch).collect()), key=str)


def test_late_rows_are_left_out_and_counted(spark, tmp_path):
    root = str(tmp_path)
    late = pipeline.LateRows()
    spark.streams.addListener(late)
    rows = [record(span=str(i), timestamp=at(ms)) for i, ms in enumerate((0, 600_000, 1_000, 1_200_000))]
    for row in rows:
        records(spark, row).coalesce(1).write.mode("append").parquet(f"{root}/records")
        stream = spark.readStream.schema(RECORD).parquet(f"{root}/records")
        query = pipeline.to_table(pipeline.metric_windows(stream), f"{root}/m", f"{root}/ck", once=True)
        query.awaitTermination()
    for _ in range(100):  # events come a little later
        if sum(late.count.values()):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.count == {str(query.id): 1}
    assert [r.calls for r in spark.read.parquet(f"{root}/m").collect()] == [1, 1]


def test_a_root_longer_than_its_sessions_is_written_once(spark, tmp_path):
    """A root in error over half an hour, its child minutes later: two sessions, each with its own span."""
    root, minute = str(tmp_path), 60_000
    long_root = span(span_id="1", start_time=at(0), end_time=at(30 * minute), status_code="2")
    child = span(span_id="2", start_time=at(5 * minute), end_time=at(5 * minute + 10), status_code="2")
    other = span(trace_id="2", span_id="3", start_time=at(6 * minute), end_time=at(6 * minute), status_code="2", attributes={"gen_ai.cost_usd": "12345.5"})
    closing = span(trace_id="f", span_id="9", start_time=at(600 * minute), end_time=at(600 * minute))
    for row in (long_root, child, other, closing):
        spans(spark, row).coalesce(1).write.mode("append").parquet(f"{root}/spans")
        stream = span_files.stream_spans(spark, f"{root}/spans", max_files_per_trigger=1)
        pipeline.stage(stream, f"{root}/staged", f"{root}/ck1", once=True).awaitTermination()
        again = span_files.stream_spans(spark, f"{root}/staged", max_files_per_trigger=1)
        query = pipeline.sample(again, f"{root}/staged", f"{root}/kept", f"{root}/decisions", f"{root}/ck2", once=True)
        query.awaitTermination()
        assert query.exception() is None
    kept = spark.read.parquet(f"{root}/kept")
    assert sorted(r.span_id[-1] for r in kept.collect()) == ["1", "2"]
    # A cost that does not fit its column goes to quarantine, with a reason.
    bad = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/kept-quarantine").collect()
    assert [(r.span_id[-1], r.violations) for r in bad] == [("3", ["gen_ai.cost_usd is not decimal(10,6)"])]


def test_exporters_see_redacted_spans(spark, tmp_path):
    root, seen = str(tmp_path), []
    spans(spark, span(attributes={"gen_ai.input.messages": "words", "user.id": "u", "gen_ai.agent.id": "a"})).write.parquet(f"{root}/spans")
    stream = span_files.stream_spans(spark, f"{root}/spans")
    export = lambda batch, _: seen.extend(r.attributes for r in batch.collect())
    pipeline.ingest(stream, f"{root}/t", f"{root}/q", f"{root}/ck", once=True, exporters=[export]).awaitTermination()
    assert set(seen[0]) == {"user.id", "gen_ai.agent.id"} and seen[0]["user.id"] != "u"
