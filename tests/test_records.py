import json
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from agentaudit.operators import compliance, convert, cost, lookup, metrics
from agentaudit.schema import RECORD
from agentaudit.sources import nested, tables
from agentaudit.streaming import pipeline

from helpers import T0, at, record, records, span, spans


def test_minimal_record_gets_defaults(spark):
    row = tables.conform(spark.createDataFrame(
        [("t" * 32 + "  ", "s" * 16, T0, "agent-1")], "trace_id string, span_id string, timestamp timestamp, agent_id string"
    )).first()
    assert row.status == "ok" and row.trace_id == "t" * 32 and row.created_at is not None
    assert row.parent_span_id is None and str(row.date) == "2026-03-27"


def test_full_record_survives_the_table(spark, tmp_path):
    full = record(
        trace="7" * 32, span="e" * 16, agent_id="clerk-11", agent_name="Clerk",
        agent_version="11.0", operation_name="chat", duration_ms=61, cost_usd="1.5",
        input_tokens=17, output_tokens=4, model_name="m-1",
        reasoning=json.dumps({"strategy": "table look-up", "confidence": 0.25}),
        tool_calls=json.dumps([{"tool_name": "ledger"}]),
        compliance=json.dumps({"all_passed": True, "human_in_loop": True}))
    path = str(tmp_path / "table")
    tables.append(records(spark, full), path)
    tables.append(records(spark, full), path)
    tables.append(records(spark), path)
    rows = tables.read(spark, path).collect()
    assert len(rows) == 2  # append only: nothing is replaced, copies stay
    assert str(rows[0].cost_usd) == "1.500000" and rows[0].all_passed is True
    assert json.loads(rows[0].reasoning)["confidence"] == 0.25


def test_named_table_sees_appended_rows(spark, tmp_path):
    tables.create_table(spark, "audit_named", str(tmp_path / "t"))
    tables.append(records(spark, record(span="1"), record(span="2", timestamp=at(86_400_000))), "audit_named")
    tables.append(records(spark, record(span="3")), "audit_named")
    assert sorted(r.span_id for r in spark.table("audit_named").collect()) == ["1", "2", "3"]
    assert tables.read(spark, str(tmp_path / "t")).count() == 3
    spark.sql("DROP TABLE audit_named")


def test_settling_keeps_what_came_another_way(spark, tmp_path):
    path, landing = str(tmp_path / "table"), str(tmp_path / "landing")
    day = datetime(2026, 3, 1, 5)
    tables.append(records(spark, record(span="late", timestamp=day)), path)
    pipeline.land(records(spark, record(span="1", timestamp=day)), landing, 0)
    for _ in range(2):
        tables.settle_day(spark.read.parquet(landing), path, "2026-03-01")
    assert sorted(r.span_id for r in tables.read(spark, path).collect()) == ["1", "late"]


def test_contract_sees_ids_and_numbers_before_they_are_cast(spark):
    rows = [span(trace_id="a" * 40, span_id="1"), span(trace_id="", span_id="2"), span(span_id="b" * 20),
            span(span_id="4", attributes={"gen_ai.cost_usd": "12345.5", "duration_ms": "12.7x"}), span(span_id="5")]
    found = {r.span_id: r.violations for r in convert.checked_records(spans(spark, *rows)).collect()}
    assert found == {
        "1".rjust(16, "0"): ["trace_id longer than 32"], "2".rjust(16, "0"): ["trace_id is null"],
        "b" * 20: ["span_id longer than 16"], "5".rjust(16, "0"): [],
        "4".rjust(16, "0"): ["duration_ms is not int", "gen_ai.cost_usd is not decimal(10,6)"]}
    dear = records(spark, record()).withColumn("cost_usd", F.lit(10_000.0))
    assert tables.validate(dear)[1].first().violations == ["cost_usd out of range"]

def test_settling_a_day_replaces_only_that_day(spark, tmp_path):
    path, landing = str(tmp_path / "table"), str(tmp_path / "landing")
    day1, day2 = datetime(2026, 3, 1, 5), datetime(2026, 3, 2, 5)
    pipeline.land(records(spark, record(span="1", timestamp=day1), record(span="2", timestamp=day2)), landing, 0)
    pipeline.land(records(spark, record(span="3", timestamp=day1)), landing, 1)
    pipeline.land(records(spark, record(span="3", timestamp=day1)), landing, 1)  # a repeated batch
    for _ in range(2):
        for day in ("2026-03-01", "2026-03-02"):
            tables.settle_day(spark.read.parquet(landing), path, day)
    assert sorted(r.span_id for r in tables.read(spark, path).collect()) == ["1", "2", "3"]


def test_create_table_is_idempotent(spark, tmp_path):
    for _ in range(2):
        tables.create_table(spark, "audit_records", str(tmp_path / "t"))
    columns = spark.table("audit_records").columns
    assert columns[-1] == "date" and "compliance" in columns
    spark.sql("DROP TABLE audit_records")


def test_empty_payloads_are_null(spark):
    row = records(spark, record(reasoning="{}", tool_calls="[]", outcome=" {} ")).first()
    assert row.reasoning is None and row.tool_calls is None and row.outcome is None


def test_contract_splits_rows(spark):
    good, long_id, no_agent = record(span="1"), record(span="2" * 17), record(span="3", agent_id="x")
    df = records(spark, good, long_id, no_agent).withColumn(
        "agent_id", F.when(F.col("span_id") != "3", F.col("agent_id")))
    valid, bad = tables.validate(df)
    assert [r.span_id for r in valid.collect()] == ["1"]
    found = {r.span_id: r.violations for r in bad.collect()}
    assert found == {"2" * 17: ["span_id longer than 16"], "3": ["agent_id is null"]}


def test_range_is_inclusive_and_ends_at_midnight(spark):
    df = records(spark, record(span="1", timestamp=datetime(2026, 3, 1)),
                 record(span="2", timestamp=datetime(2026, 3, 31)),
                 record(span="3", timestamp=datetime(2026, 3, 31, 12)))
    ids = lambda d: sorted(r.span_id for r in d.collect())
    assert ids(tables.in_range(df, "2026-03-01", "2026-03-31")) == ["1", "2"]
    assert ids(tables.in_range(df, "2026-03-01", "2026-03-31", True)) == ["1", "2", "3"]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(records(spark, record(compliance='{"all_passed":false}')), path)
    df = lookup.guardrail_failures(tables.read(spark, path), "2026-01-01", "2026-12-31").select("trace_id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "EqualTo(all_passed,false)" in plan or "Not(EqualTo(all_passed,true))" in plan
    assert "tool_calls" not in plan


def test_tiers_by_age(spark, tmp_path):
    now = datetime(2026, 6, 1)
    ages = {"1": 0, "2": 6, "3": 7, "4": 89, "5": 90}
    df = records(spark, *[record(span=s, timestamp=now - timedelta(days=d)) for s, d in ages.items()])
    tiers = {r.span_id: r.tier for r in tables.with_tier(df, "2026-06-01").collect()}
    assert tiers == {"1": "hot", "2": "hot", "3": "warm", "4": "warm", "5": "cold"}
    tables.export_tiers(df, str(tmp_path / "x"), "2026-06-01")
    back = spark.read.json(str(tmp_path / "x"))
    assert back.count() == 3 and list((tmp_path / "x").rglob("*.json.gz"))


def test_retention(spark):
    days = [datetime(2026, 1, d) for d in (1, 2, 5, 9)]
    df = records(spark, *[record(span=str(i), timestamp=d) for i, d in enumerate(days)])
    gaps = [(str(r.gap_start), str(r.gap_end), r.days) for r in tables.retention_gaps(df).orderBy("gap_start").collect()]
    assert gaps == [("2026-01-03", "2026-01-04", 2), ("2026-01-06", "2026-01-08", 3)]
    assert tables.retention_audit(df, "2026-07-02").first().covers_period
    assert not tables.retention_audit(df, "2026-06-30").first().covers_period


def test_report_sections(spark):
    df = records(
        spark,
        record(span="1", compliance='{"all_passed":true,"human_in_loop":true}',
               tool_calls='[{"gen_ai.tool.name":"a"},{"tool_name":"b"}]'),
        record(span="2", compliance='{"all_passed":false}'),
        record(span="3", compliance='{"human_in_loop":false}'))
    report = compliance.report(df, "2026-01-01", "2026-12-31")
    assert list(report) == compliance.SECTIONS
    summary = report["guardrail_summary"].first()
    assert (summary.total_checked, summary.passed, summary.failed, summary.pass_rate) == (3, 1, 1, "33.3%")
    tools = [(r.tool_name, r.usage_count) for r in report["reference_databases"].collect()]
    assert tools == [(None, 1), ("a", 1)]
    chosen = compliance.report(df, "2026-01-01", "2026-12-31", ["usage_periods", "no such section"])
    assert list(chosen) == ["usage_periods"]
    assert list(compliance.report(df, "2026-01-01", "2026-12-31", [])) == compliance.SECTIONS


def test_pass_rate_text_rounds_like_python(spark):
    values = [6.25, 6.35, 0.05, 33.333, 100.0, 0.0, 66.65, 12.45]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(compliance.percent_text(F.col("v"))).collect()]
    assert got == [f"{v:.1f}%" for v in values]


def test_cost_puts_unknown_cost_first(spark):
    df = records(spark, record(span="1", agent_name="A", cost_usd="0.5", duration_ms=10, input_tokens=3),
                 record(span="2", agent_name="B"), record(span="3", cost_usd="0.7"))
    rows = cost.cost_attribution(df, "2026-01-01", "2026-12-31").collect()
    assert [r.agent_name for r in rows] == ["B", None, "A"]
    assert rows[2].total_tokens == 3 and rows[0].total_tokens == 0


def test_token_buckets(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (5,), (10 ** 9,)], "n long")
    assert [r[0] for r in df.select(metrics.token_bucket(F.col("n"))).collect()] == [0, 1, 1, 2, 14]


def test_nested_record_from_documented_json(spark, tmp_path):
    doc = {
        "trace_id": "5" * 32, "span_id": "6" * 16,
        "parent_span_id": "7" * 16, "timestamp": "2024-02-29T23:59:59.5Z", "duration_ms": 12,
        "agent": {"id": "porter", "name": "Porter", "version": "0.9", "config_hash": "sha256:00"},
        "operation": {"name": "execute_tool", "type": "lookup", "status": "error"},
        "model": {"request_model": "m-small", "response_model": "m-small-7", "temperature": 1.5, "max_tokens": 64},
        "tokens": {"input": 31, "output": 8, "cache_read": 2, "cost_usd": 0.75},
        "reasoning": {"strategy": "retry", "confidence": 0.5, "rationale": "why not", "mood": "calm", "steps": [1, 2]},
        "tool_calls": [{"tool_name": "scales", "tool_type": "mcp", "parameters": {"unit": "kg"},
                        "response_status": 503, "latency_ms": 9, "retry_count": 2}],
        "outcome": {"task_result": "partial", "error_code": "E7", "eval_scores": {"brevity": 0.125}, "note": "n"},
        "error": {"type": "E7", "message": "scales are busy"},
        "state": {"memory_reads": ["a"], "shelf": 3},
        "compliance": {"guardrail_checks": ["weight_limit", "hours"], "guardrail_passed": False},
    }
    (tmp_path / "r.json").write_text(json.dumps(doc))
    flat = nested.read_nested(spark, str(tmp_path / "r.json"))
    row = flat.first()
    assert row.agent_name == "Porter" and row.model_name == "m-small-7" and row.max_tokens == 64
    assert str(row.cost_usd) == "0.750000" and row.timestamp == datetime(2024, 2, 29, 23, 59, 59, 500000)
    assert (row.error_type, row.error_message) == ("E7", "scales are busy")
    assert row.all_passed is False and row.human_in_loop is False
    call = json.loads(row.tool_calls)[0]
    assert call["gen_ai.tool.name"] == "scales" and call["tool.response_status"] == "503"
    again = nested.nest(flat)
    back = again.first()
    assert back.tool_calls[0].tool_name == "scales" and back.tool_calls[0].parameters == {"unit": "kg"}
    assert back.compliance.guardrail_checks == ["weight_limit", "hours"] and back.model.response_model == "m-small-7"
    # Groups with keys of their own come back whole.
    for name in ("reasoning", "outcome", "state", "error"):
        assert json.loads(again.select(F.to_json(name)).first()[0]) == doc[name]
    drop = ["created_at"]
    assert nested.flatten(again).drop(*drop).collect() == flat.drop(*drop).collect()


def test_spike_needs_history(spark):
    hours = [record(span=str(i), agent_name="A", cost_usd=c, timestamp=at(3_600_000 * i))
             for i, c in enumerate(["1", "1.1", "1", "0.9", "5"])]
    rows = cost.cost_spikes(records(spark, *hours)).orderBy("hour").collect()
    assert [r.is_spike for r in rows] == [False, False, False, False, True]


def test_settling_keeps_all_days_of_the_table(spark, sf, tmp_path):
    from agentaudit.plans import catalog

    by_day = lambda df: sorted(map(tuple, catalog._by_day_and_agent(df).collect()), key=repr)
    every = tables.conform(catalog.fixtures.records(spark, sf))
    path, landing, days = str(tmp_path / "table"), str(tmp_path / "landing"), ["2024-01-05", "2024-01-06"]
    came = F.col("duration_ms") % 3 == 0
    tables.append(every.where(~came), path)
    pipeline.land(every.where(came), landing, 0)
    for _ in range(2):
        tables.settle_days(spark.read.parquet(landing), path, days)
    settled = F.col("date").cast("string").isin(*days)
    want = by_day(every.where(settled | ~came))  # other days have what was appended
    assert len({r[0] for r in want}) > len(days)
    assert by_day(tables.read(spark, path)) == want


def many_traces(spark, traces, spans):
    """Traces whose spans have agents of their own, so that agents scatter a trace."""
    rows = spark.range(traces * spans).selectExpr(
        f"sha2(cast(id div {spans} as string), 256) as long_id", f"id % {spans} as nth", "id")
    return tables.conform(rows.select(
        F.substring("long_id", 1, 32).alias("trace_id"), F.lpad(F.hex("id"), 16, "0").alias("span_id"),
        F.timestamp_seconds(F.lit(1_772_000_000) + F.col("id") % 3600).alias("timestamp"),
        F.concat(F.lit("agent-"), F.col("nth")).alias("agent_id"),
        F.repeat(F.sha2(F.col("span_id"), 256), 4).alias("error_message")))


def rows_read(df):
    """What the file scan gave to the filter, and the rows found."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = []

    def walk(node):
        children = node.children()
        if children.isEmpty() and hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())
        elif children.isEmpty():
            leaves.append(node)
        for i in range(children.size()):
            walk(children.apply(i) if not node.getClass().getSimpleName().endswith("StageExec") else node.plan())

    walk(plan)
    return leaves[0].metrics().get("numOutputRows").get().value(), found


@pytest.mark.parametrize(("layout", "groups"), [("trace", 1), ("agent", 4)])
def test_a_trace_is_found_through_bloom_filters(spark, tmp_path, monkeypatch, layout, groups):
    path = str(tmp_path / "t")
    monkeypatch.setitem(tables.TRACE_INDEX, "parquet.block.size", str(128 << 10))
    # The first pages are not to be left out by their statistics: only row groups count here.
    tables.append(many_traces(spark, 5000, 4).coalesce(1), path, layout=layout)
    sizes = [pq.ParquetFile(f).metadata.row_group(g).num_rows for f in Path(path).rglob("*.parquet")
             for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(sizes) > 30
    stored = spark.read.schema(RECORD).option("parquet.filter.columnindex.enabled", "false")
    ids = [r[0] for r in stored.parquet(path).select("trace_id").distinct().orderBy(
        F.xxhash64("trace_id")).limit(3).collect()]  # from anywhere, so that least and greatest ids do not tell
    read, found = rows_read(tables.find_traces(stored.parquet(path), ids[:1]))
    assert len(found) == 4
    # The groups that hold the trace, and a few that the filter lets through.
    assert 4 <= read <= max(sizes) * (groups + 8)
    read, found = rows_read(tables.find_traces(stored.parquet(path), ids + [None, "unknown"]))
    assert len(found) == 12 and read <= max(sizes) * (3 * groups + 14)
    without = stored.option("parquet.filter.bloom.enabled", "false").option("parquet.filter.dictionary.enabled", "false")
    if layout == "agent":
        assert rows_read(tables.find_traces(without.parquet(path), ids[:1]))[0] > 0.9 * sum(sizes)


def test_days_limit_a_look_up(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [record(span=str(d), timestamp=datetime(2026, 3, d, 5)) for d in (1, 2, 3)]
    tables.append(records(spark, *rows), path, layout="trace")
    found = tables.find_traces(tables.read(spark, path), ["t"], "2026-03-02", "2026-03-03")
    assert [r.span_id for r in found.collect()] == ["2", "3"]
    assert "PartitionFilters: [isnotnull(date" in found._jdf.queryExecution().executedPlan().toString()
    assert tables.find_traces(tables.read(spark, path), []).count() == 0
    with pytest.raises(ValueError):
        tables.find_traces(tables.read(spark, path), [str(i) for i in range(101)])


def test_named_tables_have_bloom_filters(spark, tmp_path):
    tables.create_table(spark, "audit_bloom", str(tmp_path / "t"))
    tables.append(many_traces(spark, 500, 4), "audit_bloom")
    spark.sql("DROP TABLE audit_bloom")
    files = list((tmp_path / "t").rglob("*.parquet"))
    columns = pq.ParquetFile(files[0]).schema_arrow.names
    chunk = pq.ParquetFile(files[0]).metadata.row_group(0).column(columns.index("trace_id"))
    assert "RLE_DICTIONARY" in chunk.encodings or bloom_bytes(files[0]) > 0


def bloom_bytes(file):
    """Bytes of a file that belong to no column chunk and no footer: the filters and page indexes."""
    meta = pq.ParquetFile(file).metadata
    chunks = sum(meta.row_group(g).column(c).total_compressed_size
                 for g in range(meta.num_row_groups) for c in range(meta.num_columns))
    return file.stat().st_size - chunks - meta.serialized_size
