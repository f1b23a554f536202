"""Audit records and spans derived from the ``events`` test table.

Eight neighbouring events form one trace, shaped as a binary heap; some rows are
orphans, ties in time, zero durations or NULLs. ``RECORDS_SQL`` is the same
derivation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.texts import read_texts

#: A time range around all derived records.
START, END = "2024-01-01", "2025-01-01"
#: A state payload of some records, in the words of both engines.
STATE = """case when input_tokens % 70 = 0
 then concat('{"memory_reads":["m', cast(input_tokens as string), '@example.org","none"],"shelf":"10.0.0.7"}') end"""
#: "Now" for queries that look back.
NOW = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_texts(spark, f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type",
        "cast(get_json_object(props, '$.k') as int) as k",
        "cast(round(value * 100) as bigint) as cents",
        "cast(event_id % 8 as int) as pos",
        "event_id - event_id % 8 as b0",
        "cast(ts as timestamp) as ts",
    )
    # The same shuffle serves the window and spreads the one row group.
    return events.repartition("b0").withColumn("t0", F.expr("min(ts) over (partition by b0)"))


_COLUMNS = {
    "trace_id": "lower(lpad(hex(b0 div 8), 32, '0'))",
    "span_id": "lower(lpad(hex(event_id + 1), 16, '0'))",
    "parent_span_id": """case when pos = 0 then null
        when event_id % 97 = 5 then 'ffffffffffffffff'
        else lower(lpad(hex(b0 + (pos - 1) div 2 + 1), 16, '0')) end""",
    "timestamp": "timestampadd(MILLISECOND, (pos - pos % 2) * 250, t0)",
    "agent_id": "concat('agent-', user_id % 20)",
    "agent_name": "case when user_id % 25 = 0 then null else concat('Agent', user_id % 20) end",
    "agent_version": "concat(1 + k % 3, '.0.0')",
    "config_hash": "concat('sha256:', substring(sha2(concat('agent-', user_id % 20, ':', 1 + k % 3, '.0.0:run'), 256), 1, 16))",
    "operation_name": """case when event_type = 'click' then 'execute_tool'
        when event_type = 'signup' then 'chat' else 'invoke_agent' end""",
    "duration_ms": "case when k % 13 = 0 then 0 else cast(cents % 3000 as int) end",
    "model_name": "case when k % 4 = 0 then 'gpt-4o' else 'gpt-4o-mini' end",
    "input_tokens": "k * 10",
    "output_tokens": "case when k % 11 = 0 then null else k end",
    "cost_usd": "case when user_id % 20 = 7 then null else cast(cast(cents as decimal(10,0)) / 100000 as decimal(10,6)) end",
    "reasoning": """case when event_type = 'view' then concat(
        '{"strategy":"s', k % 4, '","confidence":"0.', lpad(k, 2, '0'),
        '","rationale":"r', k, case when k % 7 = 0 then concat(' for user', user_id, '@mail.example.com') else '' end,
        '","selected_action":"act', k % 3, '"}') end""",
    "tool_calls": """case when event_type = 'click' then concat(
        '[{"gen_ai.tool.name":"tool', k % 5, '","gen_ai.tool.type":"function","tool.response_status":"',
        case when k % 8 = 0 then '500' else '200' end, '","tool.latency_ms":"', k * 3,
        '","tool.retry_count":"', k % 3, '"},{"tool_name":"x"}]')
        when event_type = 'purchase' then '[{"gen_ai.tool.name":"pay","gen_ai.tool.type":"mcp"}]' end""",
    "inter_agent": """case when k % 9 = 0 then concat(
        '{"delegation_type":"handoff","target_agent":"agent-', (k + 3) % 20, '","protocol":"',
        case when k % 2 = 0 then 'A2A' else 'MCP' end, '"}') end""",
    "outcome": """case when k % 6 = 0 then concat(
        '{"task_result":"success","eval_scores":{"relevance":0.', lpad(k, 2, '0'),
        ',"faithfulness":0.', lpad(99 - k, 2, '0'), '}}') end""",
    "compliance": """case when event_type in ('click', 'purchase') then concat(
        '{"all_passed":', case when k % 10 = 0 then 'false' else 'true' end,
        ',"human_in_loop":', case when event_type = 'purchase' then 'true' else 'false' end, '}') end""",
    "all_passed": "case when event_type in ('click', 'purchase') then k % 10 <> 0 end",
    "human_in_loop": "case when event_type in ('click', 'purchase') then event_type = 'purchase' end",
    "status": "case when event_type = 'error' and k % 5 = 0 then 'error' else 'ok' end",
    "error_type": "case when event_type = 'error' and k % 5 = 0 then 'ValueError' end",
    "error_message": "case when event_type = 'error' and k % 5 = 0 and k % 2 = 0 then concat('bad value ', k) end",
    "risk_level": "case when k % 20 = 0 and event_type = 'signup' then 'high' else 'standard' end",
    "traceparent": """case when pos = 0 and b0 > 0 then case when k % 10 = 3 then 'broken'
        else concat('00-', lower(lpad(hex(b0 div 8 - 1), 32, '0')), '-',
             lower(lpad(hex(case when k % 10 = 4 then 0 else b0 - 4 end), 16, '0')), '-01') end end""",
}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived audit records; two extra columns: risk_level, traceparent."""
    base = _base(spark, sf_dir)
    out = base.selectExpr(*[f"{sql} as {name}" for name, sql in _COLUMNS.items()])
    return out.withColumn("date", F.to_date("timestamp"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived spans that convert to the derived records."""
    return as_spans(records(spark, sf_dir).withColumn(
        "request_model",
        F.when(F.get_json_object("outcome", "$.task_result").isNotNull(), "gpt-4o")
        .otherwise(F.col("model_name")),
    ))


#: Headers of the derived records, of which some lead to the trace after and so round in a circle.
CIRCULAR = """case when traceparent is not null and {trace} % 50 = 7 then concat(
 '00-', lower(lpad({hex}({trace} + 1), 32, '0')), '-', lower(lpad({hex}(({trace} + 1) * 8 + 1), 16, '0')), '-01')
 else traceparent end"""


def circular(records: DataFrame) -> DataFrame:
    """The records with a few circles of remote calls."""
    trace = "cast(conv(substring(trace_id, 17), 16, 10) as bigint)"
    return records.withColumn("traceparent", F.expr(CIRCULAR.format(trace=trace, hex="hex")))


#: How much later spans of some traces come, by the number of the trace and the place in it.
PAUSE = """case when {trace} % 3 = 0 and {pos} >= 5 then {seconds25}
 when {trace} % 3 = 1 and {pos} = 7 then {hours36} else {none} end"""


def paused(spans: DataFrame) -> DataFrame:
    """The spans with pauses inside two thirds of the traces."""
    shift = F.expr(PAUSE.format(
        trace="cast(conv(substring(trace_id, 17), 16, 10) as bigint)",
        pos="((cast(conv(span_id, 16, 10) as bigint) - 1) % 8)",
        seconds25="interval '25' second", hours36="interval '36' hour", none="interval '0' second"))
    return spans.withColumns({c: F.col(c) + shift for c in ("start_time", "end_time")})


def as_spans(rows: DataFrame) -> DataFrame:
    """Put record columns back into span attributes and span events."""
    text = lambda c: F.col(c).cast("string")
    keys = {
        "gen_ai.agent.id": text("agent_id"),
        "gen_ai.agent.name": text("agent_name"),
        "gen_ai.agent.version": text("agent_version"),
        "gen_ai.operation.name": text("operation_name"),
        "agent.config_hash": text("config_hash"),
        "agent.risk_level": text("risk_level"),
        "duration_ms": text("duration_ms"),
        "gen_ai.request.model": text("request_model"),
        "gen_ai.response.model": F.when(F.col("input_tokens") % 20 == 0, "").otherwise(text("model_name")),
        "gen_ai.usage.input_tokens": text("input_tokens"),
        "gen_ai.usage.output_tokens": text("output_tokens"),
        "gen_ai.cost_usd": text("cost_usd"),
        "error.type": text("error_type"),
        "error.message": text("error_message"),
        "user.id": F.concat(F.lit("u-"), text("agent_id")),
        "gen_ai.input.messages": F.concat(F.lit("hello from "), text("agent_id")),
        "compliance.human_in_loop": F.when(F.col("human_in_loop"), "true"),
    }
    plain = F.create_map(*[x for k, v in keys.items() for x in (F.lit(k), v)])
    thought = F.transform_keys(
        F.from_json("reasoning", "map<string,string>"), lambda k, _: F.concat(F.lit("reasoning."), k)
    )
    no_thought = F.create_map().cast("map<string,string>")
    attributes = F.map_filter(
        F.map_concat(plain, F.coalesce(thought, no_thought)), lambda _, v: v.isNotNull()
    )
    event = "struct<name:string,time:timestamp,attributes:map<string,string>>"
    none = F.array().cast(f"array<{event}>")
    calls = F.transform(
        F.from_json("tool_calls", "array<map<string,string>>"),
        lambda c: F.struct(F.lit("tool_call").alias("name"), F.col("timestamp").alias("time"),
                           c.alias("attributes")),
    )
    check = F.array(F.struct(
        F.lit("guardrail_check").alias("name"), F.col("timestamp").alias("time"),
        F.create_map(
            F.lit("guardrail.name"), F.lit("policy"),
            F.lit("guardrail.passed"), text("all_passed"),
        ).alias("attributes"),
    ))
    return rows.select(
        "trace_id", "span_id", "parent_span_id",
        F.col("timestamp").alias("start_time"),
        F.expr("timestampadd(MILLISECOND, duration_ms, timestamp)").alias("end_time"),
        F.when(F.col("status") == "error", "STATUS_CODE_ERROR").otherwise("STATUS_CODE_OK").alias("status_code"),
        attributes.alias("attributes"),
        F.create_map(F.lit("service.name"), F.lit("test")).alias("resource"),
        F.concat(
            F.coalesce(calls, none), F.when(F.col("all_passed").isNotNull(), check).otherwise(none)
        ).alias("events"),
    )


#: DuckDB spelling of the Spark expressions above.
_DIALECT = [
    ("(b0 div 8 - 1)", "(b0 // 8 - 1)"),
    ("b0 div 8", "b0 // 8"),
    ("(pos - 1) div 2", "(pos - 1) // 2"),
    ("hex(", "to_hex("),
    ("timestampadd(MILLISECOND, (pos - pos % 2) * 250, t0)", "t0 + to_milliseconds((pos - pos % 2) * 250)"),
    ("sha2(concat(", "sha256(concat("),
    (", ':', 1 + k % 3, '.0.0:run'), 256)", ", ':', 1 + k % 3, '.0.0:run'))"),
    ("lpad(k, 2, '0')", "lpad(cast(k as varchar), 2, '0')"),
    ("lpad(99 - k, 2, '0')", "lpad(cast(99 - k as varchar), 2, '0')"),
]


def _duckdb(sql: str) -> str:
    for spark_form, duck_form in _DIALECT:
        sql = sql.replace(spark_form, duck_form)
    return sql


CIRCULAR_SQL = CIRCULAR.format(trace="cast('0x' || substring(trace_id, 17) as bigint)", hex="to_hex")
PAUSE_SQL = PAUSE.format(
    trace="cast('0x' || substring(trace_id, 17) as bigint)", pos="((cast('0x' || span_id as bigint) - 1) % 8)",
    seconds25="interval 25 second", hours36="interval 36 hour", none="interval 0 second")

RECORDS_SQL = """b as (
 select event_id, user_id, event_type,
        cast(json_extract_string(props, '$.k') as int) as k,
        cast(round(value * 100) as bigint) as cents,
        cast(event_id % 8 as int) as pos, event_id - event_id % 8 as b0,
        min(ts) over (partition by event_id - event_id % 8) as t0
 from events),
records as (
 select """ + ",\n        ".join(f"{_duckdb(sql)} as {name}" for name, sql in _COLUMNS.items()) + """
 from b)"""
