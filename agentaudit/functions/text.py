"""Small text expressions: truncation, hashes, span names, trace headers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest text kept per field.
LIMITS = {
    "tool.parameters": 1000,
    "reasoning.rationale": 1000,
    "error.message": 500,
    "guardrail.details": 500,
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Text that stands in JSON as it is.
PLAIN_JSON = r"^[ !#-\[\]-~]*\z"


def json_string(value: Column) -> Column:
    """The text as a JSON string; what needs escapes is taken from the one-field object ``{"v":…}``."""
    escaped = F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    return F.when(value.rlike(PLAIN_JSON), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(escaped)


def truncate(value: Column, limit: int) -> Column:
    """First ``limit`` characters (code points)."""
    return F.substring(value, 1, limit)


def config_hash(agent_id: Column, version: Column, function: Column) -> Column:
    """Short fingerprint of an agent configuration."""
    digest = F.sha2(F.concat_ws(":", agent_id, version, function), 256)
    return F.concat(F.lit("sha256:"), F.substring(digest, 1, 16))


def span_name(operation: Column, agent: Column, model: Column, tool: Column) -> Column:
    """``{operation} {subject}``; the subject depends on the kind of operation."""
    subject = (
        F.when(operation.isin("chat", "text_completion", "embeddings"), model)
        .when(operation == "execute_tool", tool)
        .otherwise(agent)
    )
    return F.concat_ws(" ", operation, subject)


def valid_span_name(name: Column) -> Column:
    """Whether a span name has a known operation followed by a subject."""
    known = "chat|text_completion|embeddings|invoke_agent|create_agent|execute_tool"
    return name.rlike(rf"^({known}) \S")


def hex_id(value: Column, width: int) -> Column:
    """Lower-case hexadecimal id, padded with zeros to ``width``.

    An empty id is none (NULL); one that is too long stays as it is, for the record
    contract to find.
    """
    short = (F.length(value) > 0) & (F.length(value) < width)
    return F.lower(F.when(short, F.lpad(value, width, "0")).otherwise(nonempty(value)))


#: W3C trace context header: version, trace id, span id, flags.
TRACEPARENT = r"^00-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"


def traceparent(trace_id: Column, span_id: Column, flags: str = "01") -> Column:
    """Build a trace context header."""
    return F.concat_ws("-", F.lit("00"), trace_id, span_id, F.lit(flags))


def parse_traceparent(header: Column) -> Column:
    """Struct (trace_id, span_id, flags) of a header; NULL if it is malformed."""
    part = lambda i: F.regexp_extract(header, TRACEPARENT, i)
    return F.when(
        header.rlike(TRACEPARENT),
        F.struct(part(1).alias("trace_id"), part(2).alias("span_id"), part(3).alias("flags")),
    )


def nonempty(value: Column) -> Column:
    """The text, or NULL when it is empty."""
    return F.nullif(value, F.lit(""))


def fixed_text(value: Column, places: int) -> Column:
    """A number with a fixed number of decimals, as C and Python print it.

    They round the exact binary value, so 0.01275 (a little less in binary)
    gives 0.0127, while Java rounds the shortest decimal text and gives 0.0128.
    The scaled value is therefore taken as product plus rounding error, split
    the classic way into high and low parts, and compared with the half exactly.
    """
    scale = float(10 ** places)
    x = F.abs(value.cast("double"))
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    product = x * F.lit(scale)
    error = (high * F.lit(scale) - product) + (x - high) * F.lit(scale)
    whole = F.floor(product)
    over = (product - whole - F.lit(0.5)) + error
    up = F.when(over > 0, 1).when(over < 0, 0).otherwise(whole % 2)
    rounded = (whole + up).cast("decimal(20,0)") / F.lit(10 ** places).cast("decimal(10,0)")
    digits = F.format_string("%s", rounded.cast(f"decimal(30,{places})"))
    return F.concat(F.when(value < 0, "-").otherwise(""), digits)
