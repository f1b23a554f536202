"""Protocol lines: typed values, times, broken lines, round trips."""

import json
import time

from pyspark.sql import functions as F

from agentaudit.operators import convert
from agentaudit.plans import fixtures
from agentaudit.sources import otlp
from agentaudit.streaming import pipeline

from helpers import at, event, span, spans


def lines(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values], "value string")


def line(*made, resource=(), scope=None):
    return {"resourceSpans": [{"resource": {"attributes": list(resource)}, "scopeSpans": [{"scope": scope or {}, "spans": list(made)}]}]}


def pair(key, **value):
    return {"key": key, "value": value}


def test_typed_values_and_times(spark):
    made = {
        "traceId": "ABCD", "spanId": "EF", "parentSpanId": "", "name": "chat gpt", "kind": 3,
        "startTimeUnixNano": "1774622721000000999", "endTimeUnixNano": 1774622722500000000,
        "attributes": [
            pair("s", stringValue='quote " é'), pair("i", intValue="-7"), pair("j", intValue=9007199254740993),
            pair("d", doubleValue=0.0043), pair("b", boolValue=False), pair("y", bytesValue="AQI="), pair("none"),
            pair("l", arrayValue={"values": [{"stringValue": 'a"b'}, {"intValue": "1"}, {"doubleValue": 1.5}, {"boolValue": True}]}),
            pair("k", kvlistValue={"values": [pair("x", stringValue="y"), pair("n", intValue="2")]}),
            pair("deep", arrayValue={"values": [{"arrayValue": {"values": [{"intValue": "1"}]}}]}),
            pair("empty", arrayValue={"values": []}), pair("twice", stringValue="1"), pair("twice", stringValue="2")],
        "status": {"code": 2, "message": "m"},
        "events": [{"timeUnixNano": "1774622721000001000", "name": "e", "attributes": [pair("q", intValue=3)]}, {"name": "bare"}]}
    row = otlp.parse(lines(spark, line(
        made, resource=[pair("service.name", stringValue="svc")], scope={"name": "lib", "version": "1"}))).first()
    assert (row.trace_id, row.span_id, row.parent_span_id, row.status_code) == ("abcd", "ef", None, "2")
    assert row.start_time.microsecond == 0 and row.end_time.microsecond == 500_000
    assert (row.end_time - row.start_time).total_seconds() == 1.5
    deep = json.loads(row.attributes.pop("deep"))
    assert deep == [{"arrayValue": {"values": [{"intValue": "1"}]}}]
    assert row.attributes == {
        "s": 'quote " é', "i": "-7", "j": "9007199254740993", "d": "0.0043", "b": "false", "y": "AQI=",
        "l": '["a\\"b",1,1.5,true]', "k": '{"x":"y","n":2}', "empty": "[]", "twice": "2",
        "span.name": "chat gpt", "span.kind": "3"}
    assert row.resource == {"service.name": "svc", "otel.scope.name": "lib", "otel.scope.version": "1"}
    assert [(e.name, e.time and e.time.microsecond, e.attributes) for e in row.events] == [("e", 1, {"q": "3"}), ("bare", None, {})]


def test_sparse_spans_and_many_scopes(spark):
    whole = {"resourceSpans": [
        {"scopeSpans": [{"spans": [{"traceId": "a", "spanId": "1"}]}, {"spans": []}, {}]},
        {"resource": {"attributes": [pair("r", stringValue="2")]}, "scopeSpans": [
            {"spans": [{"traceId": "a", "spanId": "2", "startTimeUnixNano": "soon"}, {}]}]},
        {"resource": {}}]}
    rows = otlp.parse(lines(spark, whole, line())).collect()
    assert sorted((r.trace_id or "", r.span_id or "", r.start_time, r.status_code, r.attributes, r.resource.get("r"), r.events)
                  for r in rows) == [
        ("", "", None, "0", {}, "2", []), ("a", "1", None, "0", {}, None, []), ("a", "2", None, "0", {}, "2", [])]


def test_bad_lines(spark):
    df = lines(spark, line({"traceId": "a", "spanId": "1"}), '{"resourceSpans":[{"scope', "plain", "", "  ", None, {"resourceLogs": []},
               [1], {"resourceSpans": 5}, line())
    assert otlp.parse(df).count() == 1
    found = sorted((r.reason, r.line) for r in otlp.bad_lines(df).collect())
    assert found == [("no resourceSpans", "[1]"), ("no resourceSpans", '{"resourceLogs": []}'),
                     ("no resourceSpans", '{"resourceSpans": 5}'), ("not JSON", "plain"), ("not JSON", '{"resourceSpans":[{"scope')]


def test_round_trip(spark, sf):
    before = fixtures.spans(spark, sf)
    after = otlp.parse(otlp.to_lines(before))
    assert "Python" not in after._jdf.queryExecution().executedPlan().toString()
    # A number keeps its value, not its zeros: confidences are compared as numbers.
    get = lambda c, k: F.coalesce(F.get_json_object(c, k), F.lit(""))
    shape = lambda df: convert.spans_to_records(df).select(
        "*", get("reasoning", "$.rationale"), get("reasoning", "$.confidence").try_cast("double"),
        get("tool_calls", "$[0]['gen_ai.tool.name']"), F.json_array_length("tool_calls")
    ).drop("created_at", "reasoning", "tool_calls")
    a, b = shape(before), shape(after)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_round_trip_of_odd_spans(spark):
    odd = [span("t", "1", attributes={"k": 'a "b" \\ \n', "n": "007", "z": "-0", "t": "TRUE", "x": None, "e": ""},
                events=[event("e", a="1.50"), event("f")], resource={"r": "é"}, end_time=None, status_code=None),
           span(None, None, attributes=None, resource=None, events=None, start_time=None)]
    rows = sorted(otlp.parse(otlp.to_lines(spans(spark, *odd))).collect(), key=lambda r: r.trace_id or "")
    assert (rows[0].trace_id, rows[0].start_time, rows[0].attributes, rows[0].events) == (None, None, {}, [])
    assert rows[1].attributes == {"k": 'a "b" \\ \n', "n": "007", "z": "-0", "t": "TRUE", "e": ""}
    assert [(e.name, e.attributes) for e in rows[1].events] == [("e", {"a": "1.5"}), ("f", {})] or rows[1].events[0].attributes == {"a": "1.50"}
    assert rows[1].end_time is None and rows[1].resource == {"r": "é"} and rows[1].start_time == at(0)


def test_large_traces_become_many_lines(spark):
    many = spans(spark, *[span("big", str(i)) for i in range(500)], span("small", "1"))
    out = otlp.to_lines(many, per_line=50)
    assert 8 <= out.count() <= 12
    assert otlp.parse(out).count() == 501


def test_stream(spark, sf, tmp_path):
    otlp.to_lines(fixtures.spans(spark, sf)).write.text(f"{tmp_path}/in")
    lines(spark, "broken").write.mode("append").text(f"{tmp_path}/in")
    stream = otlp.stream_lines(spark, f"{tmp_path}/in")
    query = pipeline.ingest(otlp.parse(stream), f"{tmp_path}/records", f"{tmp_path}/bad", f"{tmp_path}/ck", once=True)
    query.awaitTermination()
    assert query.exception() is None
    assert spark.read.parquet(f"{tmp_path}/records").count() == fixtures.records(spark, sf).count()
    bad = pipeline.to_table(otlp.bad_lines(stream), f"{tmp_path}/lines", f"{tmp_path}/ck2", once=True)
    bad.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/lines").collect()] == [("broken", "not JSON")]


def test_a_span_with_very_many_attributes(spark):
    """The work per attribute does not grow with their number, and a line is parsed once for its reason."""
    many = [pair(f"k{i}", arrayValue={"values": [{"intValue": str(i)}]}) for i in range(3000)]
    start = time.perf_counter()
    row = otlp.parse(lines(spark, line({"traceId": "a", "spanId": "1", "attributes": many}))).first()
    assert time.perf_counter() - start < 20  # minutes, when every attribute went through all of them again
    assert row.attributes == {f"k{i}": f"[{i}]" for i in range(3000)}
    bad = otlp.bad_lines(lines(spark, "plain", line())).groupBy("reason").count()
    assert bad._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_small_traces_become_lines_without_a_join(spark):
    few = spans(spark, *[span(f"t{i % 5}", str(i)) for i in range(40)], span(None, "x"), span(None, "y"))
    out = otlp.to_lines(few)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 6 and otlp.parse(out).count() == 42
    mixed = spans(spark, *[span(None, str(i)) for i in range(300)], *[span("t", str(i)) for i in range(9)])
    out = otlp.to_lines(mixed, per_line=50)
    assert 5 <= out.count() <= 8 and otlp.parse(out).count() == 309


def test_texts_in_json(spark):
    texts = ["", "plain é", 'a "quote"', "back\\slash", "line\n", "\t", "end\n\n", "\x7f", " ", None, "0", "-", "/usr", ".5", "9x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in df.select("t", otlp._quoted(F.col("t")).alias("quoted"), otlp._typed(F.col("t")).alias("typed")).collect():
        assert json.loads(row.quoted) == (row.t or "")
        if row.t is not None:
            assert json.loads(row.typed) == ({"intValue": "0"} if row.t == "0" else {"stringValue": row.t})


def test_a_line_is_parsed_once(spark, tmp_path):
    """No filter that Spark makes of an explode parses the lines before the parse itself."""
    spark.createDataFrame([("x",)], "value string").write.text(f"{tmp_path}/lines")
    found = otlp.parse(otlp.read_lines(spark, f"{tmp_path}/lines")).groupBy("status_code").count()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_lines_without_spans_give_no_row(spark):
    span_text = '{"traceId":"a","spanId":"b"}'
    whole = lambda scopes: '{"resourceSpans":[{"scopeSpans":[%s]}]}' % scopes
    empty = ["x", "{}", "[]", "null", '{"resourceSpans":null}', '{"resourceSpans":[]}', '{"resourceSpans":[null,{}]}', whole(""),
             whole("null"), whole("{}"), whole('{"spans":null}'), whole('{"spans":[]}')]
    some = [whole('{"spans":[]},null,{"spans":[%s,%s]}' % (span_text, span_text)), None]
    lines = spark.createDataFrame([(line,) for line in empty + some], "value string")
    assert [(r.trace_id, r.span_id) for r in otlp.parse(lines).collect()] == [("a", "b")] * 2


def test_values_with_and_without_escapes(spark):
    """A map whose texts are all plain and one with a text to escape give the same pairs."""
    plain = {"n": "1", "d": "-0.50", "e": "1.1234567", "big": "9" * 19, "t": "true", "f": "TRUE", "empty": "", "none": None, "v": "1.0.0", "c": ":"}
    odd = {"quote": 'a"b', "back": "a\\b", "é": "ü", "control": "\x01\x7f"}
    rows = [span(span_id="1", attributes=plain), span(span_id="2", attributes=plain | odd), span(span_id="3", attributes=None)]
    lines = [json.loads(r.value) for r in otlp.span_lines(spans(spark, *rows)).collect()]
    found = {p["spanId"]: {a["key"]: a["value"] for a in p["attributes"]} for line in lines
             for p in line["resourceSpans"][0]["scopeSpans"][0]["spans"]}
    want = {"n": {"intValue": "1"}, "d": {"doubleValue": -0.5}, "t": {"boolValue": True}}
    want |= {k: {"stringValue": v} for k, v in plain.items() if k not in want and v is not None}
    assert found == {"1": want, "2": want | {k: {"stringValue": v} for k, v in odd.items()}, "3": {}}
