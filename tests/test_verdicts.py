"""Verdicts per trace in the stream: waits, late spans, forgetting, repeated batches."""

from datetime import timedelta
from types import SimpleNamespace

import pytest

from agentaudit.operators.sampling import Policy
from agentaudit.plans import catalog, fixtures
from agentaudit.sources import spans as span_files
from agentaudit.streaming import pipeline, verdicts

from helpers import T0, at, event, span, spans

NONE = Policy(success_percent=0)


def minute(n):
    return T0 + timedelta(minutes=n)


def clock(n):
    return span("clock", str(n), start_time=minute(n), end_time=minute(n))


def run(spark, root, *batches, **options):
    """The batches one by one, each in a run of its own; gives the kept spans in the end."""
    for batch in batches:
        spans(spark, *batch).write.mode("append").parquet(f"{root}/spans")
        query = verdicts.sample(span_files.stream_spans(spark, f"{root}/spans"), f"{root}/kept", f"{root}/bad",
                                f"{root}/ck", policy=NONE, once=True, **options)
        query.awaitTermination()
        assert query.exception() is None
    rows = spark.read.parquet(f"{root}/kept").collect()
    return sorted((r.trace_id.lstrip("0"), r.span_id.lstrip("0")) for r in rows)


def test_late_spans_follow_the_verdict(spark, tmp_path):
    late = lambda trace: span(trace, "2", start_time=minute(11), end_time=minute(11))
    got = run(
        spark, tmp_path,
        [span("bad", "1", status_code="ERROR"), span("good", "1"), clock(10)],
        # A pause far longer than the wait, after the verdict.
        [late("bad"), late("good"), clock(20)],
        # An error after the verdict does not change it.
        [span("good", "3", start_time=minute(21), end_time=minute(21), status_code="ERROR"), clock(30)])
    assert got == [("bad", "1"), ("bad", "2")]


def test_only_spans_within_the_wait_count(spark, tmp_path):
    got = run(
        spark, tmp_path,
        [span("in", "1"), span("in", "2", start_time=at(10_000), end_time=at(10_000), status_code="ERROR"),
         span("out", "1"), span("out", "2", start_time=at(10_001), end_time=at(90_000), status_code="ERROR"),
         span("slow", "1", end_time=at(5001)), span("edge", "1", end_time=at(5000)),
         span("check", "1", events=[event("guardrail_check", guardrail__passed="false")]),
         span("endless", "1", end_time=None)],
        [clock(10)], [clock(20)])
    assert got == [("check", "1"), ("in", "1"), ("in", "2"), ("slow", "1")]


def test_a_span_out_of_order_moves_the_wait(spark, tmp_path):
    got = run(
        spark, tmp_path,
        [span("t", "2", start_time=at(8000), end_time=at(8000)),
         span("u", "2", start_time=at(8000), end_time=at(8000), status_code="ERROR")],
        # The first spans come last; what started more than ten seconds after them no longer counts.
        [span("t", "1", status_code="ERROR"), span("u", "1", start_time=at(-3000), end_time=at(-3000))],
        [clock(10)], [clock(20)], delay="5 minutes")
    assert got == [("t", "1"), ("t", "2")]


def test_verdicts_are_forgotten(spark, tmp_path):
    got = run(
        spark, tmp_path,
        [span("t", "1", status_code="ERROR"), clock(10)],
        [clock(20)],
        # More than five minutes after its verdict the trace is judged anew.
        [span("t", "2", start_time=minute(21), end_time=minute(21)), clock(30)],
        [clock(40)], remember_seconds=300)
    assert got == [("t", "1")]


def test_too_late_spans_are_counted(spark, tmp_path):
    listener = pipeline.LateRows()
    spark.streams.addListener(listener)
    try:
        got = run(spark, tmp_path, [span("bad", "1", status_code="ERROR"), clock(10)],
                  [span("bad", "2", start_time=at(500), end_time=at(600)), clock(20)], [clock(30)])
    finally:
        spark.streams.removeListener(listener)
    assert got == [("bad", "1")]
    assert sum(listener.count.values()) >= 1


@pytest.mark.parametrize("column", ["trace_id", "start_time"])
def test_spans_without_trace_or_time_are_left_out(spark, tmp_path, column):
    row = dict(zip((f.name for f in verdicts.SPAN), span("bad", "1", status_code="ERROR")))
    row[column] = None
    got = run(spark, tmp_path, [tuple(row.values()), span("bad", "9", status_code="ERROR"), clock(10)], [clock(20)])
    assert got == [("bad", "9")]


def test_stream_equals_batch(spark, sf):
    kept = catalog.QUERIES["stream_late"](spark, sf).select("trace_id", "span_id")
    moved = fixtures.paused(fixtures.spans(spark, sf))
    want = moved.join(verdicts.decide(moved).where("keep"), "trace_id").select("trace_id", "span_id")
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()
    judged = verdicts.decide(moved).selectExpr("sum(judged)", "sum(spans)").first()
    assert judged[0] < judged[1]


def test_payloads_come_back_whole(spark, tmp_path):
    whole = span("t", "1", status_code="ERROR", start_time=at(0).replace(microsecond=123_456),
                 attributes={"a": 'quote " and \\ and é\n', "b": None}, resource={}, parent_span_id=None,
                 events=[event("x", k="v"), ("y", None, None)])
    spans(spark, whole, clock(10)).write.parquet(f"{tmp_path}/spans")
    kept = verdicts.kept_spans(span_files.stream_spans(spark, f"{tmp_path}/spans"), NONE)
    query = kept.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    want = spans(spark, whole).collect()
    assert spark.read.schema(verdicts.SPAN).parquet(f"{tmp_path}/out").collect() == want


class Counting:
    """A state's handle that keeps what it is told in lists and counts the calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getListState(self, *_):
        return Kept(self)

    getValueState = getListState

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.discard(ms)


class Kept:
    def __init__(self, handle):
        self.handle, self.items, self.value = handle, [], None

    def __getattr__(self, name):
        self.handle.calls += 1
        return getattr(self, f"_{name}")

    def _get(self):
        return self.value if self.value is not None else iter(self.items) if self.items else None

    def _update(self, value):
        self.value = value

    def _appendValue(self, value):
        self.items.append(value)

    def _appendList(self, values):
        self.items += values

    def _put(self, values):
        self.items = list(values)

    def _clear(self):
        self.items, self.value = [], None


def test_calls_to_the_state_do_not_grow_with_the_traces():
    """A thousand traces of one group, every tenth with an error, in two halves a minute apart."""
    handle, processor = Counting(), verdicts.Verdicts(10_000, 60_000, 5000)
    processor.init(handle)
    row = lambda n, us: SimpleNamespace(
        trace_id=f"t{n}", start_us=us, end_us=us, flagged=n % 10 == 0, is_lucky=False, payload=f"{n}/{us}")

    def fire(now_ms):
        out = []
        for _ in range(9):
            for ms in [t for t in sorted(handle.timers) if t < now_ms]:
                handle.timers.discard(ms)
                out += processor.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: now_ms),
                                                    SimpleNamespace(getExpiryTimeInMs=lambda: ms))
        return [r.payload for r in out]

    assert list(processor.handleInputRows((0,), iter([row(n, n) for n in range(500)]), None)) == []
    assert list(processor.handleInputRows((0,), iter([row(n, 60_000_000 + n) for n in range(500, 1000)]), None)) == []
    assert sorted(fire(30_000)) == sorted(f"{n}/{n}" for n in range(0, 500, 10))
    # Late spans follow their verdict; the other half still waits.
    late = processor.handleInputRows((0,), iter([row(n, 61_000_000) for n in (10, 11)]), None)
    assert [r.payload for r in late] == ["10/61000000"]
    assert sorted(fire(72_000)) == sorted(f"{n}/{60_000_000 + n}" for n in range(500, 1000, 10))
    fire(500_000)
    assert not handle.timers and processor.group.get() is None and processor.waiting.get() is None
    assert handle.calls < 60
