import hashlib
import json

from pyspark.sql import functions as F

from agentaudit.functions import text
from agentaudit.operators import convert

from helpers import event, span, spans


def test_span_becomes_record(spark):
    row = convert.spans_to_records(spans(spark, span(
        trace="AB", span_id="C", parent_span_id="D",
        status_code="ERROR",
        attributes={
            "gen_ai.agent.name": "Planner", "duration_ms": "847", "gen_ai.cost_usd": "0.0043",
            "gen_ai.usage.input_tokens": "12", "gen_ai.request.model": "gpt-4o", "gen_ai.response.model": "",
            "reasoning.strategy": "cot", "reasoning.confidence": "0.87",
            "error.type": "ValueError", "error.message": "x" * 600,
            "compliance.human_in_loop": "True"},
        events=[
            event("tool_call", gen_ai__tool__name="a", tool__parameters='{"q": [1, "two"]}'),
            event("tool_call", gen_ai__tool__name='say "hi"', tool__parameters="not json"),
            event("guardrail_check", guardrail__name="x"),
            event("guardrail_check", guardrail__name="y", guardrail__passed="false"),
        ]))).first()
    assert row.trace_id == "ab".rjust(32, "0") and row.span_id == "c".rjust(16, "0")
    assert row.parent_span_id == "d".rjust(16, "0")
    assert row.agent_id == "unknown" and row.duration_ms == 847 and row.model_name == "gpt-4o"
    assert json.loads(row.reasoning) == {"strategy": "cot", "confidence": "0.87"}
    calls = json.loads(row.tool_calls)
    assert calls[0]["tool.parameters"] == {"q": [1, "two"]}
    assert calls[1] == {"gen_ai.tool.name": 'say "hi"', "tool.parameters": "not json"}
    compliance = json.loads(row.compliance)
    assert compliance["all_passed"] is False and compliance["human_in_loop"] is True
    assert len(compliance["guardrail_checks"]) == 2
    assert row.status == "error" and len(row.error_message) == 500


def test_plain_span_has_no_payloads(spark):
    row = convert.spans_to_records(spans(spark, span())).first()
    assert row.reasoning is None and row.tool_calls is None and row.compliance is None
    assert row.status == "ok" and row.parent_span_id is None and row.cost_usd is None


def test_check_without_verdict_passes(spark):
    row = convert.spans_to_records(spans(spark, span(
        events=[event("guardrail_check", guardrail__name="x")]))).first()
    assert row.all_passed is True


def test_oversight_without_checks(spark):
    df = spans(spark, span(attributes={"compliance.human_in_loop": "true"}))
    assert convert.spans_to_records(df).first().compliance is None
    kept = json.loads(convert.spans_to_records(df, keep_oversight_only=True).first().compliance)
    assert kept == {"guardrail_checks": [], "all_passed": None, "human_in_loop": True}


def test_status_codes(spark):
    rows = [span(span_id=str(i), status_code=c) for i, c in enumerate(["2", "error", "STATUS_CODE_ERROR", "1", "OK"])]
    out = convert.spans_to_records(spans(spark, *rows)).orderBy("span_id").collect()
    assert [r.status for r in out] == ["error"] * 3 + ["ok"] * 2


def test_export_redaction(spark):
    df = spans(spark, span(attributes={
        "user.id": "u1", "gen_ai.input.messages": "hello", "gen_ai.system_instructions": "s", "x": "y"}))
    hashed = hashlib.sha256(b"u1").hexdigest()
    assert convert.redact_attributes(df).first().attributes == {"user.id": hashed, "x": "y"}
    kept = convert.redact_attributes(df, capture_content=True).first().attributes
    assert kept["gen_ai.input.messages"] == "hello" and kept["user.id"] == hashed


def test_long_text_is_cut(spark):
    df = spans(spark, span(
        attributes={"reasoning.rationale": "é" * 1500, "x": "x" * 1500},
        events=[event("tool_call", tool__parameters="p" * 1500),
                event("guardrail_check", guardrail__details="d" * 1500)]))
    row = convert.truncate_long_text(df).first()
    assert row.attributes["reasoning.rationale"] == "é" * 1000 and len(row.attributes["x"]) == 1500
    assert len(row.events[0].attributes["tool.parameters"]) == 1000
    assert len(row.events[1].attributes["guardrail.details"]) == 500


def test_usage_in_both_spellings(spark):
    cases = [
        {"tokens": {"input": 50, "output": 20, "cache_read": 7}, "cost_usd": 0.0002, "model": "m"},
        {"usage": {"input_tokens": 5, "output_tokens": 6}, "cost": 0.5, "response_model": "r"},
        {"tokens": {"input": 0, "input_tokens": 9}},
        {"tokens": {}, "usage": {"output": 0}, "cost_usd": 0, "cost": 0.1, "model": ""},
        {},
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "i int, result string")
    got = [
        (r.input_tokens, r.output_tokens, r.cache_read_tokens, r.cost_usd, r.response_model)
        for r in convert.normalise_usage(df).orderBy("i").collect()
    ]
    assert got == [
        (50, 20, 7, 0.0002, "m"), (5, 6, None, 0.5, "r"), (9, None, None, None, None),
        (None, 0, None, 0.1, None), (None, None, None, None, None),
    ]


def test_text_helpers(spark):
    trace, parent = "ab" * 16, "cd" * 8
    row = spark.range(1).select(
        text.config_hash(F.lit("a"), F.lit("1"), F.lit("f")).alias("hash"),
        text.span_name(F.lit("chat"), F.lit("A"), F.lit("gpt-4o"), F.lit("t")).alias("chat"),
        text.span_name(F.lit("execute_tool"), F.lit("A"), F.lit("m"), F.lit("t")).alias("tool"),
        text.parse_traceparent(text.traceparent(F.lit(trace), F.lit(parent))).alias("good"),
        text.parse_traceparent(F.lit("00-xyz")).alias("bad"),
    ).first()
    assert row.hash == "sha256:" + hashlib.sha256(b"a:1:f").hexdigest()[:16]
    assert row.chat == "chat gpt-4o" and row.tool == "execute_tool t"
    assert (row.good.trace_id, row.good.span_id, row.good.flags) == (trace, parent, "01")
    assert row.bad is None


def test_fixed_text_prints_like_python(spark):
    values = [0.01275, 0.08735, 0.0, 1.00005, 12345.67895, 0.31925, -0.01275, 2.5e-5, 7e-5, 0.99995]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(text.fixed_text(F.col("v"), 4)).collect()] == [f"{v:.4f}" for v in values]
