"""Spans to audit records, as one narrow projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schema import RECORD
from ..sources.tables import violations

# Fixed values.
#: Attributes that hold prompt or answer text; exported only on request.
CONTENT_KEYS = ["gen_ai.system_instructions", "gen_ai.input.messages", "gen_ai.output.messages"]
#: Attributes replaced by their hash on export.
HASHED_KEYS = ["user.id"]


def _attr(key: str) -> Column:
    return F.try_element_at("attributes", F.lit(key))


def _events(name: str) -> Column:
    return F.transform(
        F.filter(F.col("events"), lambda e: e["name"] == name),
        lambda e: F.coalesce(e["attributes"], F.create_map().cast("map<string,string>")),
    )


def reasoning(attributes: Column) -> Column:
    """All ``reasoning.`` attributes without the prefix; NULL if there are none."""
    own = F.map_filter(attributes, lambda k, _: k.startswith("reasoning."))
    named = F.transform_keys(own, lambda k, _: F.replace(k, F.lit("reasoning."), F.lit("")))
    return F.when(F.size(own) > 0, named)


def guardrail_passed(check: Column) -> Column:
    """A check without a verdict counts as passed."""
    verdict = F.try_element_at(check, F.lit("guardrail.passed"))
    return F.coalesce(F.lower(verdict).try_cast("boolean"), F.lit(True))


def tool_call_json(call: Column) -> Column:
    """JSON object of one tool call.

    Parameters that are valid JSON are put in as JSON, other text as text.
    """
    fields = F.transform(F.map_entries(call), _json_field)
    return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))


def _quoted(value: Column) -> Column:
    """The text as a JSON string, taken from the one-field object ``{"v":…}``."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def _json_field(entry: Column) -> Column:
    key, value = entry["key"], entry["value"]
    parsed = F.when(key == "tool.parameters", F.to_json(F.try_parse_json(value)))
    shown = F.when(value.isNull(), "null").otherwise(F.coalesce(parsed, _quoted(value)))
    return F.concat(_quoted(key), F.lit(":"), shown)


def spans_to_records(spans: DataFrame, keep_oversight_only: bool = False,
                     extra: dict[str, Column] | None = None) -> DataFrame:
    """Convert spans to flat audit records.

    ``timestamp`` is the start of the span. With ``keep_oversight_only`` a span
    that records human oversight but no check still gets a compliance value.
    ``extra`` are further columns over the spans.
    """
    checks = _events("guardrail_check")
    calls = _events("tool_call")
    oversight = F.coalesce(
        F.lower(_attr("compliance.human_in_loop")).try_cast("boolean"), F.lit(False)
    )
    has_checks = F.coalesce(F.size(checks) > 0, F.lit(False))
    all_passed = F.when(has_checks, F.forall(checks, guardrail_passed))
    has_compliance = (has_checks | oversight) if keep_oversight_only else has_checks
    compliance = F.when(
        has_compliance,
        F.to_json(
            F.struct(
                F.coalesce(checks, F.array().cast("array<map<string,string>>")).alias("guardrail_checks"),
                all_passed.alias("all_passed"),
                oversight.alias("human_in_loop"),
            ),
            {"ignoreNullFields": "false"},
        ),
    )
    code = F.upper("status_code")
    model = F.coalesce(
        text.nonempty(_attr("gen_ai.response.model")), text.nonempty(_attr("gen_ai.request.model"))
    )
    values = {
        "trace_id": text.hex_id(F.col("trace_id"), 32),
        "span_id": text.hex_id(F.col("span_id"), 16),
        "parent_span_id": text.hex_id(text.nonempty(F.col("parent_span_id")), 16),
        "timestamp": F.col("start_time"),
        "agent_id": F.coalesce(_attr("gen_ai.agent.id"), F.lit("unknown")),
        "agent_name": _attr("gen_ai.agent.name"),
        "agent_version": _attr("gen_ai.agent.version"),
        "config_hash": _attr("agent.config_hash"),
        "operation_name": _attr("gen_ai.operation.name"),
        "duration_ms": _attr("duration_ms").try_cast("int"),
        "model_name": model,
        "input_tokens": _attr("gen_ai.usage.input_tokens").try_cast("int"),
        "output_tokens": _attr("gen_ai.usage.output_tokens").try_cast("int"),
        "cache_read_tokens": _attr("gen_ai.usage.cache_read.input_tokens").try_cast("int"),
        "cost_usd": _attr("gen_ai.cost_usd").try_cast("decimal(10,6)"),
        "reasoning": F.to_json(reasoning(F.col("attributes"))),
        "tool_calls": F.when(
            F.size(calls) > 0,
            F.concat(F.lit("["), F.array_join(F.transform(calls, tool_call_json), ","), F.lit("]")),
        ),
        "compliance": compliance,
        "status": F.when(code.isin("2", "ERROR", "STATUS_CODE_ERROR"), "error").otherwise("ok"),
        "error_type": _attr("error.type"),
        "error_message": text.truncate(_attr("error.message"), text.LIMITS["error.message"]),
        "all_passed": F.when(has_compliance, all_passed),
        "human_in_loop": F.when(has_compliance, oversight),
        "created_at": F.current_timestamp(),
        "date": F.to_date("start_time"),
    }
    return spans.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD
    ], *[c.alias(name) for name, c in (extra or {}).items()])


#: Attributes that become numbers of a record, and their types there.
NUMBERS = {
    "duration_ms": "int", "gen_ai.usage.input_tokens": "int", "gen_ai.usage.output_tokens": "int",
    "gen_ai.usage.cache_read.input_tokens": "int", "gen_ai.cost_usd": "decimal(10,6)",
}


def checked_records(spans: DataFrame, keep_oversight_only: bool = False) -> DataFrame:
    """Records with ``violations``, which also names attributes that are not the numbers they should be.

    Such an attribute is NULL in the record; without this check it would get lost.
    """
    def wrong(key: str, kind: str) -> Column:
        value = F.nullif(_attr(key), F.lit(""))
        return F.when(value.isNotNull() & value.try_cast(kind).isNull(), F.lit(f"{key} is not {kind}"))

    unread = F.array_compact(F.array(*[wrong(k, t) for k, t in NUMBERS.items()]))
    # The two columns travel beside the record columns through one projection.
    records = spans_to_records(spans, keep_oversight_only, {"_unread": unread})
    return records.withColumn("violations", F.concat(violations(), "_unread")).drop("_unread")


def redact_attributes(spans: DataFrame, capture_content: bool = False) -> DataFrame:
    """Export form of spans: content attributes removed, user ids hashed."""
    attributes = F.col("attributes")
    if not capture_content:
        attributes = F.map_filter(attributes, lambda k, _: ~k.isin(*CONTENT_KEYS))
    attributes = F.transform_values(
        attributes, lambda k, v: F.when(k.isin(*HASHED_KEYS), F.sha2(v, 256)).otherwise(v)
    )
    return spans.withColumn("attributes", attributes)


def truncate_long_text(spans: DataFrame) -> DataFrame:
    """Cut the free-text attributes of spans and span events to their limits."""
    def cut_map(m: Column) -> Column:
        def value(k: Column, v: Column) -> Column:
            out = v
            for key, limit in text.LIMITS.items():
                out = F.when(k == key, text.truncate(v, limit)).otherwise(out)
            return out
        # A text of no more bytes than the least limit is not cut; most maps have no longer one.
        is_long = lambda v: F.octet_length(v) > min(text.LIMITS.values())
        return text.let(m, lambda m: F.when(
            F.exists(F.map_values(m), is_long), F.transform_values(m, value)).otherwise(m))

    cut_events = F.transform(
        "events", lambda e: e.withField("attributes", cut_map(e["attributes"]))
    )
    return spans.withColumns({"attributes": cut_map(F.col("attributes")), "events": cut_events})


def normalise_usage(results: DataFrame, column: str = "result") -> DataFrame:
    """Token and cost columns from the JSON result of an agent call.

    Both key spellings are read. Zero and empty count as missing and fall
    through to the second spelling; a key that is there but holds nothing gives
    0, an absent one NULL.
    """
    doc = F.col(column)

    def at(path: str) -> Column:
        return F.get_json_object(doc, path)

    def usable(path: str) -> Column:
        value = at(path)
        return F.when(~value.isin("{}", "[]", "", "null"), value)

    tokens = F.coalesce(usable("$.tokens"), usable("$.usage"))

    def count(short: str, long: str) -> Column:
        first = F.get_json_object(F.col("_tokens"), f"$.{short}").try_cast("int")
        second = F.get_json_object(F.col("_tokens"), f"$.{long}").try_cast("int")
        keys = F.json_object_keys("_tokens")
        there = F.array_contains(keys, short) | F.array_contains(keys, long)
        return F.when(there, F.coalesce(F.nullif(first, F.lit(0)), second, F.lit(0)))

    cost = F.coalesce(
        F.nullif(at("$.cost_usd").try_cast("double"), F.lit(0.0)), at("$.cost").try_cast("double")
    )
    model = F.coalesce(text.nonempty(at("$.model")), text.nonempty(at("$.response_model")))
    return results.withColumn("_tokens", tokens).withColumns({
        "input_tokens": count("input", "input_tokens"),
        "output_tokens": count("output", "output_tokens"),
        "cache_read_tokens": F.get_json_object("_tokens", "$.cache_read").try_cast("int"),
        "cost_usd": cost,
        "response_model": model,
    }).drop("_tokens")
