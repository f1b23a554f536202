"""Fixed schemas of spans, flat records and nested records."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.MapType(T.StringType(), T.StringType())

#: A finished span as the exporter writes it; attribute values are text.
SPAN = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("parent_span_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("status_code", T.StringType()),
    T.StructField("attributes", _STRINGS),
    T.StructField("resource", _STRINGS),
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("attributes", _STRINGS),
    ]))),
])

#: The six payload columns are JSON text in the table.
JSON_COLUMNS = ["reasoning", "tool_calls", "inter_agent", "state", "outcome", "compliance"]

#: One audit record. ``date`` is the partition column of the table; the two
#: booleans repeat compliance fields as plain columns, so that filters on them
#: reach the Parquet reader.
RECORD = T.StructType([
    T.StructField("trace_id", T.StringType(), False),
    T.StructField("span_id", T.StringType(), False),
    T.StructField("parent_span_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("agent_id", T.StringType(), False),
    T.StructField("agent_name", T.StringType()),
    T.StructField("agent_version", T.StringType()),
    T.StructField("config_hash", T.StringType()),
    T.StructField("operation_name", T.StringType()),
    T.StructField("duration_ms", T.IntegerType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("temperature", T.FloatType()),
    T.StructField("max_tokens", T.IntegerType()),
    T.StructField("input_tokens", T.IntegerType()),
    T.StructField("output_tokens", T.IntegerType()),
    T.StructField("cache_read_tokens", T.IntegerType()),
    T.StructField("cost_usd", T.DecimalType(10, 6)),
    *[T.StructField(c, T.StringType()) for c in JSON_COLUMNS],
    T.StructField("status", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("all_passed", T.BooleanType()),
    T.StructField("human_in_loop", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("date", T.DateType()),
])

# Fixed values.
#: Longest text each column may hold.
MAX_LENGTH = {
    "trace_id": 32, "span_id": 16, "parent_span_id": 16, "agent_id": 128,
    "agent_name": 256, "agent_version": 64, "config_hash": 80,
    "operation_name": 64, "model_name": 128, "status": 16, "error_type": 128,
}

REQUIRED = ["trace_id", "span_id", "timestamp", "agent_id"]

def _group(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: Groups to which users add keys of their own; nothing of them may get lost.
_FREE = T.VariantType()
_S, _I, _B, _LIST = T.StringType(), T.IntegerType(), T.BooleanType(), T.ArrayType(T.StringType())

#: The nested record, one JSON object per event. ``error`` holds what the flat record
#: says of an error; records without it give their error code in ``outcome``.
NESTED = _group(
    trace_id=_S, span_id=_S, parent_span_id=_S, timestamp=T.TimestampType(), duration_ms=_I,
    agent=_group(id=_S, name=_S, version=_S, config_hash=_S),
    operation=_group(name=_S, type=_S, status=_S),
    model=_group(request_model=_S, response_model=_S, temperature=T.FloatType(), max_tokens=_I),
    tokens=_group(input=_I, output=_I, cache_read=_I, cost_usd=T.DecimalType(10, 6)),
    reasoning=_FREE,
    tool_calls=T.ArrayType(_group(
        tool_name=_S, tool_type=_S, call_id=_S, parameters=_STRINGS, response_status=_I,
        latency_ms=_I, retry_count=_I)),
    inter_agent=_FREE, state=_FREE, outcome=_FREE,
    error=_group(type=_S, message=_S),
    compliance=_group(pii_detected=_B, pii_redacted_fields=_LIST, guardrail_checks=_LIST,
                      guardrail_passed=_B, human_in_loop=_B),
)
