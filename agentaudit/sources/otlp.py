"""Spans in the JSON form of the trace protocol: resource -> scope -> spans, one object a line.

Lines are read as text, in batch or as a stream, and taken apart by JVM expressions.
Attribute values are typed there (text, integer, double, boolean, bytes, list, key-value
list); here they become text, lists and key-value lists of plain values JSON text. Values
nested more deeply keep the protocol's own JSON. Times are in nanoseconds and are cut to
microseconds; 0 and what is no number count as no time. Scope name and version join the
resource (``otel.scope.name``), name and kind of a span its attributes (``span.name``).

A line that is no JSON, or holds no spans, is no part of the result: ``bad_lines`` gives
it with the reason. Empty lines are skipped. Whether a span itself is valid is judged
later, by the record contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PLAIN_JSON, json_string, let
from ..schema import SPAN
from ..session import cut

_PLAIN = "stringValue:string,intValue:string,doubleValue:string,boolValue:string,bytesValue:string"
_VALUE = (f"struct<{_PLAIN},arrayValue:struct<values:array<variant>>,kvlistValue:struct<values:array<struct<key:string,value:variant>>>>")
_PAIRS = f"array<struct<key:string,value:{_VALUE}>>"
_SPAN = (f"struct<traceId:string,spanId:string,parentSpanId:string,name:string,kind:string,startTimeUnixNano:string,"
         f"endTimeUnixNano:string,attributes:{_PAIRS},status:struct<code:string,message:string>,"
         f"events:array<struct<timeUnixNano:string,name:string,attributes:{_PAIRS}>>>")
#: What a line holds.
LINE = (f"struct<resourceSpans:array<struct<resource:struct<attributes:{_PAIRS}>,scopeSpans:array<struct<"
        f"scope:struct<name:string,version:string>,spans:array<{_SPAN}>>>>>>")
#: The typed values of the protocol that stand for one plain value.
_KINDS = ("stringValue", "intValue", "doubleValue", "boolValue", "bytesValue")


def _quoted(text: Column) -> Column:
    """Text as a JSON string; ``""`` for NULL."""
    return json_string(F.coalesce(text, F.lit("")))


def _json_of(value: Column) -> Column:
    """JSON of a typed value inside a list: plain values as such, deeper ones as they are."""
    got = lambda kind: F.try_variant_get(value, f"$.{kind}", "string")
    shown = lambda kind: F.when(got(kind).isNotNull(), _quoted(got(kind)))
    return F.coalesce(shown("stringValue"), got("intValue"), got("doubleValue"), got("boolValue"), shown("bytesValue"),
                      F.to_json(value))


def _text(value: Column) -> Column:
    """A typed value as text; NULL if it is empty."""
    listed = F.concat(F.lit("["), F.array_join(F.transform(value["arrayValue"]["values"], _json_of), ","), F.lit("]"))
    pairs = F.transform(value["kvlistValue"]["values"], lambda p: F.concat(
        _quoted(p["key"]), F.lit(":"), _json_of(p["value"])))
    return F.coalesce(*[value[k] for k in _KINDS], listed, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def _map(pairs: Column, *more: tuple[str, Column]) -> Column:
    """Key-value pairs as a map of text; of repeated keys the last counts, empty values are left out."""
    own = F.transform(pairs, lambda p: F.struct(p["key"].alias("key"), _text(p["value"]).alias("value")))
    every = F.coalesce(own, F.array().cast("array<struct<key:string,value:string>>"))
    if more:
        every = F.concat(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in more]), every)
    kept = F.filter(every, lambda e: e["key"].isNotNull() & e["value"].isNotNull())

    def last(kept: Column) -> Column:
        # The last of equal keys: those that come again later are left out.
        return F.when(F.size(F.array_distinct(kept["key"])) == F.size(kept), kept).otherwise(F.filter(
            kept, lambda e, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda later: later["key"] == e["key"])))

    return F.map_from_entries(let(kept, last))


def _time(nanos: Column) -> Column:
    number = nanos.try_cast("bigint")
    return F.timestamp_micros(F.when(number > 0, F.floor(number / F.lit(1000).cast("decimal(4,0)")).cast("bigint")))


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """The spans in a column of lines, with the columns of ``schema.SPAN``; works on streams."""
    parsed = lines.select(F.from_json(column, LINE).alias("l"))
    # Outer up to the spans: of a plain explode Spark makes a filter on its input, which parses every line once
    # more. What has no spans is left out by the last explode all the same.
    resources = parsed.select(F.explode_outer("l.resourceSpans").alias("r"))
    scopes = resources.select(F.col("r.resource.attributes").alias("resource"), F.explode_outer("r.scopeSpans").alias("s"))
    spans = scopes.select("resource", F.col("s.scope").alias("scope"), F.explode("s.spans").alias("p"))
    empty = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    events = F.transform(F.coalesce("p.events", F.array()), lambda e: F.struct(
        e["name"].alias("name"), _time(e["timeUnixNano"]).alias("time"), _map(e["attributes"]).alias("attributes")))
    return spans.select(
        empty("p.traceId").alias("trace_id"), empty("p.spanId").alias("span_id"),
        empty("p.parentSpanId").alias("parent_span_id"), _time(F.col("p.startTimeUnixNano")).alias("start_time"),
        _time(F.col("p.endTimeUnixNano")).alias("end_time"), F.coalesce("p.status.code", F.lit("0")).alias("status_code"),
        _map(F.col("p.attributes"), ("span.name", F.nullif("p.name", F.lit(""))), ("span.kind", F.col("p.kind"))).alias("attributes"),
        _map(F.col("resource"), ("otel.scope.name", F.nullif("scope.name", F.lit(""))),
             ("otel.scope.version", F.nullif("scope.version", F.lit("")))).alias("resource"),
        events.alias("events")).to(SPAN)


def bad_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines without spans: ``line`` and ``reason``; works on streams."""
    value = F.try_parse_json(column)
    reason = let(value, lambda v: F.when(v.isNull(), "not JSON").when(
        F.try_variant_get(v, "$.resourceSpans", "array<variant>").isNull(), "no resourceSpans"))
    # Exploded, a line is parsed once for both the filter and the reason.
    found = F.filter(F.array(F.struct(F.col(column).alias("line"), reason.alias("reason"))), lambda r: r["reason"].isNotNull())
    return lines.where(F.trim(column) != "").select(F.inline(found))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files, for ``parse`` and ``bad_lines``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of files as they arrive."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def _typed(value: Column, quoted: Callable[[Column], Column] = _quoted) -> Column:
    """Text as a typed value: whole numbers, decimals and truth values by their looks."""
    text = F.concat(F.lit('{"stringValue":'), quoted(value), F.lit("}"))
    number = (F.when(value.rlike(r"^-?(0|[1-9]\d{0,17})$"), F.concat(F.lit('{"intValue":"'), value, F.lit('"}')))
              .when(value.rlike(r"^-?(0|[1-9]\d{0,8})\.\d{1,6}$"), F.concat(F.lit('{"doubleValue":'), value, F.lit("}")))
              .otherwise(text))
    # What does not begin like a number is not matched as one: ":" follows "9".
    return (F.when((value < ":") & (value >= "-"), number)
            .when((value == "true") | (value == "false"), F.concat(F.lit('{"boolValue":'), value, F.lit("}"))).otherwise(text))


def _pairs(values: Column) -> Column:
    """A map as the protocol's key-value pairs; NULL values are left out."""
    def joined(known: Column, quoted: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(F.map_entries(known), lambda e: F.concat(
            F.lit('{"key":'), quoted(e["key"]), F.lit(',"value":'), _typed(e["value"], quoted), F.lit("}"))), ",")

    def either(known: Column) -> Column:
        # Whether anything needs escapes is asked once for all texts of a map. A plain pair without a value is
        # NULL, which array_join passes over.
        every = F.concat(F.array_join(F.map_keys(known), ""), F.array_join(F.map_values(known), ""))
        return F.when(every.rlike(PLAIN_JSON), joined(known, lambda c: F.concat(F.lit('"'), c, F.lit('"')))).otherwise(
            joined(F.map_filter(known, lambda _, v: v.isNotNull()), _quoted))

    known = F.coalesce(values, F.create_map().cast("map<string,string>"))
    return F.concat(F.lit("["), let(known, either), F.lit("]"))


def _nanos(time: Column) -> Column:
    return F.concat(F.lit('"'), F.coalesce(F.unix_micros(time) * 1000, F.lit(0)).cast("string"), F.lit('"'))


def span_json() -> Column:
    """JSON of a span in the protocol's form."""
    event = lambda e: F.concat(
        F.lit('{"timeUnixNano":'), _nanos(e["time"]), F.lit(',"name":'), _quoted(e["name"]), F.lit(',"attributes":'),
        _pairs(e["attributes"]), F.lit("}"))
    return F.concat(
        F.lit('{"traceId":'), _quoted(F.col("trace_id")), F.lit(',"spanId":'), _quoted(F.col("span_id")),
        F.lit(',"parentSpanId":'), _quoted(F.col("parent_span_id")), F.lit(',"startTimeUnixNano":'),
        _nanos(F.col("start_time")), F.lit(',"endTimeUnixNano":'), _nanos(F.col("end_time")), F.lit(',"attributes":'),
        _pairs(F.col("attributes")), F.lit(',"events":['),
        F.coalesce(F.array_join(F.transform("events", event), ","), F.lit("")),
        F.lit('],"status":{"code":'), _quoted(F.col("status_code")), F.lit("}}"))


def span_lines(spans: DataFrame) -> DataFrame:
    """One line of the protocol per span (column ``value``), without a shuffle; works on streams."""
    return spans.select(F.concat(
        F.lit('{"resourceSpans":[{"resource":{"attributes":'), _pairs(F.col("resource")),
        F.lit('},"scopeSpans":[{"scope":{},"spans":['), span_json(), F.lit("]}]}]}")).alias("value"))


def to_lines(spans: DataFrame, per_line: int = 64) -> DataFrame:
    """Spans as lines of the protocol (column ``value``), for files or another collector.

    Spans of one trace and resource share lines of about ``per_line`` spans, dealt by span id,
    so that a large trace becomes many lines.
    """
    rows = spans.select("trace_id", "span_id", _pairs(F.col("resource")).alias("resource"), span_json().alias("span"))
    # Only traces that fill more than a line are looked up; without any, no span is moved for a join.
    sizes = cut(spans.groupBy(F.col("trace_id").alias("of_trace")).agg(
        (F.count(F.lit(1)) / per_line).cast("long").alias("parts")).where("parts > 0"))
    if sizes.isEmpty():
        dealt = rows.withColumn("part", F.lit(0))
    else:
        dealt = rows.join(sizes, F.col("trace_id").eqNullSafe(F.col("of_trace")), "left").withColumn(
            "part", F.pmod(F.xxhash64("span_id"), F.coalesce("parts", F.lit(0)) + 1))
    return dealt.groupBy("trace_id", "resource", "part").agg(F.sort_array(F.collect_list("span")).alias("spans")).select(
        F.concat(F.lit('{"resourceSpans":[{"resource":{"attributes":'), F.col("resource"),
                 F.lit('},"scopeSpans":[{"scope":{},"spans":['), F.array_join("spans", ","), F.lit("]}]}]}")).alias("value"))
