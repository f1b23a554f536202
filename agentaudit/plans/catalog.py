"""The query catalogue: one entry per operator, over the derived tables.

Each entry takes (spark, sf_dir) and returns a DataFrame. Results are shaped for
comparison with SQL: decimals become doubles, averages are rounded to nine places,
arrays become text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..functions import text
from ..functions.payload import redact_json
from ..functions.pii import Redactor, add_strategy
from ..operators import (analysis, compliance, convert, cost, handoffs, lookup, loops, metrics, partials, privacy,
                         replay, requests, sampling, sketches, tree)
from ..schema import JSON_COLUMNS, RECORD
from ..sources import export, nested, otlp, spans as span_files, tables
from ..streaming import pipeline, spikes, verdicts
from . import fixtures
from .fixtures import END, NOW, START

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _shape(df: DataFrame) -> DataFrame:
    """Types both engines agree on."""
    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return F.round(c.cast("double"), 9).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(c, 9).alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return c.cast("long").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def query(fn: Callable) -> Query:
    """Register a query under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.configure(spark)
        return _shape(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors can reach."""
    return f"{session.checkpoint_dir(spark).rstrip('/')}/scratch-{uuid4().hex}"


# -- look-ups -------------------------------------------------------------------


@query
def trace_scan(spark, sf):
    """The trace with the most errors, all its records in time order, from a table laid out by trace."""
    path = _scratch(spark)
    tables.append(fixtures.records(spark, sf), path, layout="trace")
    records = tables.read(spark, path)
    worst = (
        records.groupBy("trace_id").agg(F.count_if(F.col("status") == "error").alias("n"))
        .orderBy(F.desc("n"), "trace_id").limit(1)
    )
    return tables.find_traces(records, [r["trace_id"] for r in worst.collect()]).select(
        "trace_id", "span_id", "timestamp", "agent_id", "operation_name", "duration_ms", "status"
    )


@query
def agent_records(spark, sf):
    return lookup.agent_records(fixtures.records(spark, sf), "agent-3", START, END).select(
        "trace_id", "span_id", "timestamp", "operation_name", "duration_ms", "cost_usd"
    )


@query
def errors_recent(spark, sf):
    out = lookup.errors(fixtures.records(spark, sf), START, END)
    return out.select("trace_id", "span_id", "timestamp", "agent_id", lookup.error_text().alias("error"))


@query
def guardrail_failures(spark, sf):
    out = lookup.guardrail_failures(fixtures.records(spark, sf), START, END)
    return out.select("trace_id", "span_id", "timestamp", "agent_id", "operation_name")


@query
def human_oversight(spark, sf):
    return lookup.human_oversight(fixtures.records(spark, sf), START, END)


@query
def reasoning_trail(spark, sf):
    return lookup.reasoning_trail(fixtures.records(spark, sf))


# -- cost -----------------------------------------------------------------------


@query
def cost_attribution(spark, sf):
    return cost.cost_attribution(fixtures.records(spark, sf), START, END)


@query
def cost_hourly(spark, sf):
    out = cost.cost_hourly(fixtures.records(spark, sf))
    return out.withColumn("total_tokens", F.col("total_tokens").cast("double"))


@query
def cost_last_24h(spark, sf):
    return cost.cost_since(fixtures.records(spark, sf), NOW, 24)


@query
def version_compare(spark, sf):
    return cost.version_compare(fixtures.records(spark, sf))


@query
def cost_spikes(spark, sf):
    out = cost.cost_spikes(fixtures.records(spark, sf))
    return out.select("agent_name", "hour", "cost", "baseline", "spread", "is_spike")


@query
def error_spikes(spark, sf):
    out = cost.error_spikes(fixtures.records(spark, sf))
    return out.select("agent_name", "hour", "calls", "error_rate", "baseline", "spread", "is_spike")


# -- compliance -----------------------------------------------------------------


@query
def usage_periods(spark, sf):
    return compliance.usage_periods(fixtures.records(spark, sf), START, END)


@query
def root_usage_periods(spark, sf):
    return compliance.root_usage_periods(fixtures.records(spark, sf))


@query
def reference_databases(spark, sf):
    return compliance.reference_databases(fixtures.records(spark, sf), START, END)


@query
def guardrail_summary(spark, sf):
    return compliance.guardrail_summary(fixtures.records(spark, sf), START, END)


@query
def compliance_report_long(spark, sf):
    """All report sections as rows; every field of their JSON is read back for comparison."""
    rows = compliance.report_long(fixtures.records(spark, sf), START, END)
    get = lambda key: F.get_json_object("row_json", f"$.{key}")
    text = [F.coalesce(get(k), F.lit("")).alias(k) for k in (
        "tool_name", "tool_type", "trace_id", "span_id", "agent_name", "operation_name", "pass_rate")]
    number = [get(k).cast("long").alias(k) for k in ("total_operations", "usage_count", "total_checked", "passed", "failed")]
    time = [get(k).cast("timestamp").alias(f"at_{k}") for k in ("day", "first_use", "last_use", "timestamp")]
    return rows.select("section", *text, *number, *time, get("pass_rate_pct").cast("double").alias("pass_rate_pct"))


@query
def partial_report(spark, sf):
    """Costs and report sections of the whole range, from daily partial results alone."""
    root = _scratch(spark)
    tables.append(fixtures.records(spark, sf), f"{root}/table")
    stored = tables.read(spark, f"{root}/table")
    days = [r["date"] for r in stored.select("date").distinct().collect()]  # a row per day
    partials.refresh(stored, f"{root}/partials", days)
    args = spark, f"{root}/partials", START, END
    row = lambda df, section, label, n, x=F.lit(None), y=F.lit(None): df.select(
        F.lit(section).alias("section"), label.cast("string").alias("label"), n.cast("long").alias("n"),
        x.cast("double").alias("x"), y.cast("timestamp").alias("y"))
    c, costs, checks = F.col, partials.cost_attribution(*args), partials.guardrail_summary(*args)
    hourly = partials.cost_hourly(*args)
    parts = [
        row(costs, "cost", c("agent_name"), c("invocations"), c("total_cost")),
        row(costs, "tokens", c("agent_name"), c("total_tokens"), c("avg_latency_ms")),
        row(hourly, "hour", F.concat_ws("|", "agent_name", F.date_format("hour", "yyyy-MM-dd HH")), c("total_tokens"), c("total_cost")),
        row(partials.reference_databases(*args), "tool", F.concat_ws("/", "tool_name", "tool_type"), c("usage_count")),
        row(partials.usage_periods(*args), "use", c("day").cast("date"), c("total_operations"), y=c("last_use")),
        row(partials.root_usage_periods(*args), "session", c("day").cast("date"), c("sessions"), y=c("last_end")),
        row(checks, "checks", c("pass_rate"), c("total_checked"), c("failed")),
        row(partials.human_oversight(*args, ordered=False), "oversight", c("span_id"), F.lit(1), y=c("timestamp"))]
    return reduce(DataFrame.unionByName, parts)


@query
def risk_tags(spark, sf):
    """Risk level and domain of every record, counted per agent."""
    keys = [F.lit(k) for k, _ in compliance.HIGH_RISK_DOMAINS] + [F.lit("other")]
    records = fixtures.records(spark, sf)
    domain = F.element_at(F.array(*keys), (F.pmod("input_tokens", F.lit(80)) / 10 + 1).cast("int"))
    tagged = compliance.tag_risk(records, domain, F.col("risk_level"))
    return tagged.groupBy("risk_level", "risk_domain", "is_high_risk").agg(
        F.count(F.lit(1)).alias("records"))


# -- replay and trees -----------------------------------------------------------


@query
def replay_steps(spark, sf):
    out = replay.steps(fixtures.records(spark, sf))
    return out.withColumn("output_tokens", F.col("output_tokens").cast("double"))


@query
def timeline_lines(spark, sf):
    return replay.timeline(replay.steps(fixtures.records(spark, sf)))


@query
def timeline_summary(spark, sf):
    return replay.timeline_summary(analysis.trace_totals(fixtures.records(spark, sf)))


@query
def tao_rows(spark, sf):
    return replay.tao_rows(fixtures.records(spark, sf))


@query
def span_tree(spark, sf):
    return tree.span_tree(fixtures.records(spark, sf))


@query
def span_forest_json(spark, sf):
    """Nested JSON per trace, with the number of spans found in it."""
    out = tree.forest_json(fixtures.records(spark, sf))
    spans = F.regexp_count("forest", F.lit('"span_id"'))
    leaves = F.regexp_count("forest", F.lit(r'"children":\[\]'))
    return out.select("trace_id", "forest", spans.alias("spans"), leaves.alias("leaves"))


@query
def span_forest_pieces(spark, sf):
    """The nested JSON of every trace as rows in order."""
    return tree.forest_pieces(fixtures.records(spark, sf))


@query
def critical_path(spark, sf):
    return tree.critical_path_steps(fixtures.records(spark, sf))


@query
def trace_analysis(spark, sf):
    return analysis.analyze(fixtures.records(spark, sf))


@query
def trace_diff(spark, sf):
    """Every trace against the one after it; the last has no partner."""
    records = fixtures.records(spark, sf)
    following = F.lower(F.lpad(F.hex(F.conv("trace_id", 16, 10).cast("long") + 1), 32, "0"))
    pairs = records.where(F.col("parent_span_id").isNull()).select(
        F.col("trace_id").alias("trace_a"), following.alias("trace_b"))
    return analysis.diff(analysis.trace_totals(records), pairs).select(
        "trace_a", "trace_b", "duration_diff_ms", "cost_diff_usd", "token_diff",
        "span_count_diff", "error_count_diff", "total_duration_ms_a", "total_duration_ms_b",
        "bottleneck_agent_a", "bottleneck_agent_b")


@query
def trace_stitch(spark, sf):
    records = fixtures.records(spark, sf)
    return analysis.stitch(records, records)


@query
def delegation_edges(spark, sf):
    return analysis.delegation_edges(fixtures.records(spark, sf))


@query
def delegation_chains(spark, sf):
    """From every agent of every trace back to the origin of its work."""
    return handoffs.chains(fixtures.records(spark, sf))


@query
def delegation_cycles(spark, sf):
    """Agents that hand work round in circles, per trace."""
    return handoffs.cycles(fixtures.records(spark, sf))


@query
def request_tree(spark, sf):
    """Spans of requests over several traces, with broken and circular links among them."""
    return requests.request_tree(fixtures.circular(fixtures.records(spark, sf))).select(
        "request_id", "trace_id", "span_id", "depth", "root_trace_id", "root_span_id")


@query
def lineage_score(spark, sf):
    return analysis.lineage_score(fixtures.records(spark, sf))


@query
def loop_repeats(spark, sf):
    """Repeats of a step inside a trace; three repeats count as a loop here."""
    return loops.loops(fixtures.records(spark, sf), limit=3)


@query
def loop_blocks(spark, sf):
    """Of every agent's day the smallest block of operations it repeats at least three times on end."""
    days = fixtures.records(spark, sf).withColumns({
        "trace_id": F.concat_ws("/", "agent_id", "date"), "agent_name": F.lit("all"), "reasoning": F.lit(None)})
    return loops.smallest_loops(days, limit=3, longest=4).withColumn("block", F.array_join("block", ","))


@query
def recursion(spark, sf):
    """Agents whose operation calls itself at least once."""
    return loops.recursion(fixtures.records(spark, sf), limit=2)


# -- personal data --------------------------------------------------------------


def _redacted(strategy: str) -> Query:
    def run(spark, sf):
        docs = fixtures.texts(spark, sf, "documents").select("doc_id", "text")
        return privacy.redact_text(docs, "text", Redactor(strategy=strategy))

    return run


for _strategy in ("hash", "mask", "remove"):
    _run = _redacted(_strategy)
    _run.__name__ = f"pii_redact_{_strategy}"
    query(_run)


@query
def pii_redact_longest(spark, sf):
    docs = fixtures.texts(spark, sf, "documents").select("doc_id", "text")
    return privacy.redact_text(docs, "text", Redactor(), mode="longest")


@query
def pii_own_strategy(spark, sf):
    """A replacement of one's own, in texts and in JSON payloads made of them."""
    add_strategy("angle", lambda match, kind: F.lit(f"<{kind}>"), lambda match, kind: f"<{kind}>")
    redactor = Redactor(patterns=("email",), strategy="angle")
    docs = fixtures.texts(spark, sf, "documents")
    payload = redact_json(F.to_json(F.struct("text")), redactor)
    return docs.select("doc_id", redactor.redact(F.col("text")).alias("text"),
                       F.get_json_object(payload, "$.text").alias("payload_text"))


@query
def pii_scan(spark, sf):
    docs = fixtures.texts(spark, sf, "documents").select("doc_id", "text")
    return privacy.scan_text(docs, "text", Redactor()).select(
        "doc_id", "scan.original_length", "scan.redacted_length", "scan.pii_detected",
        F.size("scan.detections").alias("detections"),
        F.array_join(F.array_sort("scan.pii_types_found"), ",").alias("types"))


@query
def pii_detections(spark, sf):
    docs = fixtures.texts(spark, sf, "documents")
    return privacy.detections(docs, ["doc_id"], "text", Redactor())


@query
def pii_custom_allowlist(spark, sf):
    """A pattern of one's own beside two built-in ones, with an allowed address."""
    talk = fixtures.texts(spark, sf, "documents").select("doc_id", "text")
    redactor = Redactor(patterns=("email", "ip_address"), strategy="remove",
                        custom={"marker": r"\*{3}"}, allowlist=frozenset({"19@mail5.example.com"}))
    return privacy.redact_text(talk, "text", redactor)


@query
def pii_payload_paths(spark, sf):
    records = fixtures.records(spark, sf).withColumn("state", F.expr(fixtures.STATE))
    return privacy.payload_detections(records, ["span_id"], JSON_COLUMNS, Redactor())


@query
def pii_summary(spark, sf):
    records = fixtures.records(spark, sf).withColumn("state", F.expr(fixtures.STATE))
    return privacy.summary(privacy.payload_detections(records, ["span_id"], JSON_COLUMNS, Redactor()))


@query
def pii_payload_redact(spark, sf):
    """All payload columns redacted with all patterns: every string that is left in them."""
    records = fixtures.records(spark, sf).withColumn("state", F.expr(fixtures.STATE))
    clean = records.withColumns({c: redact_json(F.col(c), Redactor()) for c in JSON_COLUMNS})
    return privacy.payload_leaves(clean, ["span_id"], JSON_COLUMNS).select(
        "span_id", privacy.field_path().alias("field_path"), "value")


@query
def pii_conversations(spark, sf):
    """Turns with personal data, per role."""
    talk = fixtures.texts(spark, sf, "conversations")
    found = F.size(Redactor().detect(F.col("text")))
    return talk.groupBy("role").agg(
        F.count(F.lit(1)).alias("turns"), F.count_if(found > 0).alias("with_pii"),
        F.sum(found).alias("detections"))


@query
def intent_routing(spark, sf):
    talk = fixtures.texts(spark, sf, "conversations")
    return privacy.route_intent(talk, "text").select("conv_id", "turn", "route", "confidence")


@query
def text_guardrails(spark, sf):
    docs = fixtures.texts(spark, sf, "documents")
    score = F.col("n_chars") % 100 / 200
    out = privacy.text_guardrails(docs, "text", Redactor(("email", "phone", "credit_card")), score)
    return out.select(
        "doc_id", "all_passed",
        F.try_element_at("checks", F.lit(1))["passed"].alias("pii_passed"),
        F.try_element_at("checks", F.lit(1))["score"].cast("double").alias("pii_score"),
        F.try_element_at("checks", F.lit(1))["details"].alias("details"),
        F.try_element_at("checks", F.lit(2))["passed"].alias("score_passed"),
        F.md5("clean").alias("clean_md5"))


# -- spans ----------------------------------------------------------------------


@query
def spans_to_records(spark, sf):
    out = convert.spans_to_records(fixtures.spans(spark, sf))
    at = lambda c, k: F.coalesce(F.get_json_object(c, k), F.lit(""))
    return out.select(
        "trace_id", "span_id", "parent_span_id", "timestamp", "agent_id", "agent_name",
        "agent_version", "config_hash", "operation_name", "duration_ms", "model_name",
        "input_tokens", F.col("output_tokens").cast("double").alias("output_tokens"), "cost_usd",
        at("reasoning", "$.rationale").alias("rationale"),
        at("reasoning", "$.confidence").alias("confidence"),
        F.coalesce(F.json_array_length("tool_calls"), F.lit(0)).alias("tool_calls"),
        at("tool_calls", "$[0]['gen_ai.tool.name']").alias("first_tool"),
        F.coalesce(F.col("all_passed").cast("string"), F.lit("")).alias("all_passed"),
        F.coalesce(F.col("human_in_loop").cast("string"), F.lit("")).alias("human_in_loop"),
        "status", "error_type", "error_message")


@query
def usage_normalise(spark, sf):
    """Agent results in both key spellings, brought to one set of columns."""
    results = fixtures.records(spark, sf).selectExpr(
        "span_id",
        """case when input_tokens % 30 = 0
             then to_json(named_struct('tokens', named_struct('input', input_tokens, 'output', output_tokens),
                          'cost_usd', cast(cost_usd as double), 'model', model_name))
             else to_json(named_struct('usage', named_struct('input_tokens', input_tokens, 'output_tokens', output_tokens,
                          'cache_read', 5), 'cost', cast(cost_usd as double), 'response_model', model_name)) end as result""")
    out = convert.normalise_usage(results).drop("result")
    return out.withColumns({
        "output_tokens": F.col("output_tokens").cast("double"),
        "cache_read_tokens": F.col("cache_read_tokens").cast("double")})


@query
def nested_roundtrip(spark, sf):
    """Flat to nested to flat; what comes back is compared with the start."""
    back = nested.flatten(nested.nest(tables.conform(fixtures.records(spark, sf))))
    at = lambda c, k: F.coalesce(F.get_json_object(c, k), F.lit(""))
    return back.select(
        "trace_id", "span_id", "timestamp", "agent_id", "operation_name", "duration_ms", "cost_usd",
        at("reasoning", "$.rationale").alias("rationale"),
        F.coalesce(F.json_array_length("tool_calls"), F.lit(0)).alias("tool_calls"),
        at("inter_agent", "$.target_agent").alias("target_agent"),
        at("reasoning", "$.confidence").alias("confidence"), at("reasoning", "$.strategy").alias("strategy"),
        "status", "error_type", "error_message", "agent_name", "agent_version", "model_name", "parent_span_id",
        F.coalesce(F.col("all_passed").cast("string"), F.lit("")).alias("all_passed"))


@query
def export_redacted(spark, sf):
    """Exported attributes: content gone, user ids hashed."""
    out = convert.redact_attributes(fixtures.spans(spark, sf))
    attr = lambda k: F.try_element_at("attributes", F.lit(k))
    return out.select(
        "span_id", attr("user.id").alias("user_hash"),
        F.coalesce(attr("gen_ai.input.messages"), F.lit("")).alias("content"),
        attr("gen_ai.agent.id").alias("agent_id"))


@query
def export_captured(spark, sf):
    """Exported attributes with content on request; user ids stay hashed."""
    out = convert.redact_attributes(fixtures.spans(spark, sf), capture_content=True)
    attr = lambda k: F.try_element_at("attributes", F.lit(k))
    return out.select("span_id", attr("user.id").alias("user_hash"),
                      F.coalesce(attr("gen_ai.input.messages"), F.lit("")).alias("content"))


@query
def spans_from_json(spark, sf):
    """Spans as JSON files, read back and converted, per agent."""
    path = _scratch(spark)
    fixtures.spans(spark, sf).write.json(path)
    records = convert.spans_to_records(span_files.read_spans(spark, path, "json"))
    return records.groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("cost_usd").alias("cost"),
        F.count_if(F.col("status") == "error").alias("errors"))


@query
def spans_from_otlp(spark, sf):
    """Spans as protocol lines, some of them broken, read back and converted, per agent; bad lines by reason."""
    path = _scratch(spark)
    lines = otlp.to_lines(fixtures.spans(spark, sf))
    number = F.conv(F.regexp_extract("value", '"traceId":"([0-9a-f]*)"', 1), 16, 10).cast("long") % 40
    lines.select(F.explode(F.when(number == 3, F.array(F.expr("left(value, length(value) div 2)")))
                           .when(number == 4, F.array("value", F.lit('{"resourceLogs":[]}'), F.lit("")))
                           .otherwise(F.array("value"))).alias("value")).write.text(path)
    read = otlp.read_lines(spark, path)
    records = convert.spans_to_records(otlp.parse(read)).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("cost_usd").alias("cost"),
        F.count_if(F.col("status") == "error").alias("errors"))
    bad = otlp.bad_lines(read).groupBy(F.concat(F.lit("bad: "), F.col("reason")).alias("agent_id")).agg(
        F.count(F.lit(1)).alias("records"))
    return records.unionByName(bad, allowMissingColumns=True)


@query
def span_names(spark, sf):
    """Span names, configuration fingerprints and cut error text."""
    records = fixtures.records(spark, sf)
    tool = F.get_json_object("tool_calls", "$[0]['gen_ai.tool.name']")
    name = text.span_name(F.col("operation_name"), F.coalesce("agent_name", F.lit("")), F.col("model_name"), tool)
    return records.select(
        "span_id", name.alias("span_name"), text.valid_span_name(name).alias("is_valid"),
        text.config_hash(F.col("agent_id"), F.col("agent_version"), F.lit("run")).alias("fingerprint"),
        F.coalesce(text.truncate(F.col("error_message"), 8), F.lit("")).alias("short_error"))


@query
def tail_decisions(spark, sf):
    return sampling.decide(fixtures.spans(spark, sf))


@query
def tail_sample(spark, sf):
    return sampling.sample(fixtures.spans(spark, sf)).select("trace_id", "span_id", "start_time")


# -- metrics and alerts ---------------------------------------------------------


@query
def operation_duration(spark, sf):
    return metrics.operation_duration(fixtures.records(spark, sf), exact=True)


@query
def latency_rollup(spark, sf):
    """Latency by hour and by day, merged from stored sketches of 30 seconds."""
    path = _scratch(spark)
    sketches.sketches(fixtures.records(spark, sf)).write.parquet(path)
    windows = spark.read.parquet(path)
    by = {level: sketches.with_percentiles(sketches.roll_up(windows, f"1 {level}")) for level in ("hour", "day")}
    return by["hour"].withColumn("level", F.lit("hour")).unionByName(by["day"].withColumn("level", F.lit("day")))


@query
def latency_sketch_alerts(spark, sf):
    """Agents whose 99th percentile of a day's latency is above a limit, from stored sketches."""
    path = _scratch(spark)
    sketches.sketches(fixtures.records(spark, sf), "1 hour", ["agent_id"]).write.parquet(path)
    return sketches.latency_alerts(spark.read.parquet(path), 2500, width="1 day")


@query
def token_histogram(spark, sf):
    return metrics.token_histogram(fixtures.records(spark, sf), "1 hour")


@query
def time_per_token(spark, sf):
    return metrics.time_per_token(fixtures.records(spark, sf))


@query
def cost_alerts(spark, sf):
    return metrics.trace_cost_alerts(fixtures.records(spark, sf), 0.1)


@query
def guardrail_rate_alerts(spark, sf):
    records = fixtures.records(spark, sf)
    return metrics.guardrail_rate_alerts(records, ["agent_id"], F.col("all_passed"), 0.05)


@query
def latency_alerts(spark, sf):
    return metrics.latency_alerts(fixtures.records(spark, sf), 1000)


@query
def model_provenance(spark, sf):
    out = metrics.model_provenance(fixtures.spans(spark, sf))
    return out


@query
def eval_scores(spark, sf):
    return metrics.eval_scores(fixtures.records(spark, sf))


@query
def low_confidence(spark, sf):
    return metrics.low_confidence(fixtures.records(spark, sf), 0.3)


@query
def tool_reliability(spark, sf):
    out = metrics.tool_reliability(fixtures.records(spark, sf))
    return out.withColumn("retries", F.col("retries").cast("double"))


# -- storage --------------------------------------------------------------------


@query
def storage_tiers(spark, sf):
    return tables.tier_summary(fixtures.records(spark, sf), NOW).select(
        "tier", "records", F.col("first_day").cast("string").alias("first_day"),
        F.col("last_day").cast("string").alias("last_day"))


@query
def retention_audit(spark, sf):
    out = tables.retention_audit(
        fixtures.records(spark, sf), "2024-07-15", 6, "operation_name", {"chat": 84})
    return out.select("tag", "records", "months_required", "covers_period",
                      F.col("first_day").cast("string").alias("first_day"),
                      F.col("keep_from").cast("string").alias("keep_from"))


@query
def retention_gaps(spark, sf):
    """Days without any record, over the whole table with every fifth day taken out of it."""
    records = fixtures.records(spark, sf)
    moved = F.when(F.dayofmonth("timestamp") % 5 == 0, F.col("timestamp") - F.expr("interval 1 day")
                   ).otherwise(F.col("timestamp"))
    return tables.retention_gaps(records.withColumn("timestamp", moved)).select(
        F.col("gap_start").cast("string").alias("gap_start"),
        F.col("gap_end").cast("string").alias("gap_end"), "days")


@query
def quarantine(spark, sf):
    """Records that break the contract, with the rules they break."""
    broken = fixtures.records(spark, sf).withColumns({
        "agent_id": F.when(F.col("duration_ms") % 50 != 7, F.col("agent_id")),
        "agent_version": F.when(F.col("duration_ms") % 40 == 3, F.repeat("agent_version", 20))
        .otherwise(F.col("agent_version")),
        "trace_id": F.when(F.col("duration_ms") % 30 == 4, F.concat("trace_id", F.lit("0")))
        .otherwise(F.col("trace_id")),
        "cost_usd": F.when(F.col("duration_ms") % 60 == 9, F.lit(12_345.5)).otherwise(F.col("cost_usd")),
    })
    _, bad = tables.validate(broken)
    return bad.select("span_id", F.array_join("violations", "; ").alias("violations"))


@query
def table_roundtrip(spark, sf):
    """Append to the table, read it back, aggregate by day and agent."""
    path = _scratch(spark)
    tables.append(fixtures.records(spark, sf), path)
    stored = tables.in_range(tables.read(spark, path), START, END)
    return _by_day_and_agent(stored)


def _by_day_and_agent(stored: DataFrame) -> DataFrame:
    return stored.groupBy(F.col("date").cast("string").alias("date"), "agent_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("cost_usd").alias("cost"),
        F.count_if(F.col("compliance").isNotNull()).alias("checked"))


@query
def table_by_name(spark, sf):
    """Create a table, append to it by name in two parts, read it by name."""
    name = f"audit_{uuid4().hex}"
    tables.create_table(spark, name, _scratch(spark))
    records = fixtures.records(spark, sf)
    for even in (True, False):
        tables.append(records.where((F.col("duration_ms") % 2 == 0) == even), name)
    return _by_day_and_agent(tables.in_range(spark.table(name), START, END))


@query
def settle_roundtrip(spark, sf):
    """All days, of which one part was appended and the other landed by a stream, settled twice."""
    root = _scratch(spark)
    records = tables.conform(fixtures.records(spark, sf))
    from_stream = F.col("duration_ms") % 3 == 0
    tables.append(records.where(~from_stream), f"{root}/table")
    pipeline.land(records.where(from_stream), f"{root}/landing", 0)
    landed = spark.read.parquet(f"{root}/landing")
    days = [r["date"] for r in landed.select("date").distinct().collect()]  # a row per day
    for _ in range(2):
        tables.settle_days(landed, f"{root}/table", days)
    return _by_day_and_agent(tables.read(spark, f"{root}/table"))


@query
def tier_export(spark, sf):
    """Compressed JSON of the records past the hot tier, read back."""
    path = _scratch(spark)
    tables.export_tiers(fixtures.records(spark, sf), path, NOW)
    back = spark.read.schema("trace_id string, duration_ms int, tier string, date date").json(path)
    return back.groupBy("tier").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("trace_id").alias("traces"),
        F.sum("duration_ms").alias("duration_ms"))


# -- streams --------------------------------------------------------------------


def _span_files(spark: SparkSession, sf: str, root: str) -> None:
    """Spans as files, then one later span that closes all windows."""
    fixtures.spans(spark, sf).write.parquet(f"{root}/spans")
    _closing_span(spark, f"{root}/spans")


def _closing_span(spark: SparkSession, path: str) -> None:
    """Append a span a day after the last one, which closes all windows."""
    written = span_files.read_spans(spark, path)
    later = written.agg((F.max("start_time") + F.expr("interval 1 day")).alias("start_time"))
    closing = later.select(
        F.lit("f" * 32).alias("trace_id"), F.lit("f" * 16).alias("span_id"),
        "start_time", F.col("start_time").alias("end_time"))
    closing.write.mode("append").parquet(path)


def _finish(started) -> None:
    started.awaitTermination()
    if started.exception():
        raise started.exception()


def _record_stream(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Records as files, with one later record that closes all windows, as a stream."""
    path = f"{root}/records"
    tables.conform(fixtures.records(spark, sf)).write.parquet(path)
    later = tables.read(spark, path).agg(
        (F.max("timestamp") + F.expr("interval 1 day")).alias("timestamp"))
    closing = later.select(
        F.lit("f" * 32).alias("trace_id"), F.lit("f" * 16).alias("span_id"), "timestamp",
        F.lit("closing").alias("agent_id"))
    tables.conform(closing).write.mode("append").parquet(path)
    return spark.readStream.schema(RECORD).parquet(path)


@query
def stream_ingest(spark, sf):
    """Spans through the ingest stream, aggregated per agent."""
    root = _scratch(spark)
    _span_files(spark, sf, root)
    stream = span_files.stream_spans(spark, f"{root}/spans")
    _finish(pipeline.ingest(stream, f"{root}/records", f"{root}/bad", f"{root}/ck", once=True))
    records = spark.read.parquet(f"{root}/records")
    return records.where(F.col("trace_id") != "f" * 32).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("cost_usd").alias("cost"),
        F.count_if(F.col("status") == "error").alias("errors"))


@query
def stream_export(spark, sf):
    """Redacted spans through the export stream as protocol lines, read back and counted per agent."""
    root = _scratch(spark)
    fixtures.spans(spark, sf).write.parquet(f"{root}/spans")
    stream = span_files.stream_spans(spark, f"{root}/spans")
    _finish(pipeline.export(stream, f"{root}/lines", f"{root}/ck", once=True, compression="gzip"))
    records = otlp.parse(export.read_lines(spark, f"{root}/lines"))
    attr = lambda k: F.try_element_at("attributes", F.lit(k))
    return records.groupBy(attr("gen_ai.agent.id").alias("agent_id")).agg(
        F.count(F.lit(1)).alias("spans"), F.count_distinct(attr("user.id")).alias("users"),
        F.count(attr("gen_ai.input.messages")).alias("with_content"),
        F.count_if(F.col("status_code") == "STATUS_CODE_ERROR").alias("errors"))


@query
def stream_sample(spark, sf):
    """Spans through the sampling stream, decided per trace: spans of kept traces."""
    root = _scratch(spark)
    _span_files(spark, sf, root)
    stream = span_files.stream_spans(spark, f"{root}/spans")
    _finish(verdicts.sample(stream, f"{root}/kept", f"{root}/bad", f"{root}/ck", once=True))
    return spark.read.parquet(f"{root}/kept").where(F.col("trace_id") != "f" * 32).select(
        "trace_id", "span_id", F.col("timestamp").alias("start_time"))


@query
def stream_late(spark, sf):
    """Traces with pauses far longer than the wait, over several runs of the sampling stream.

    In a third of the traces the last spans come after 25 seconds, in another third the
    last one after 36 hours, often in a later run than its trace's verdict.
    """
    root = _scratch(spark)
    spans = fixtures.paused(fixtures.spans(spark, sf))
    part = F.floor(F.datediff("start_time", F.lit(START)) / 10)
    spans.withColumn("part", part.cast("int")).write.partitionBy("part").parquet(f"{root}/parts")
    parts = span_files.read_spans(spark, f"{root}/parts")
    for number in range(4):
        mine = parts.where(F.col("part") == number).drop("part") if number < 3 else parts.where(
            F.col("part") >= number).drop("part")
        mine.write.mode("append").parquet(f"{root}/spans")
        if number == 3:
            _closing_span(spark, f"{root}/spans")
        _finish(verdicts.sample(span_files.stream_spans(spark, f"{root}/spans"), f"{root}/kept", f"{root}/bad",
                                f"{root}/ck", remember_seconds=7 * 86_400, once=True))
    return spark.read.parquet(f"{root}/kept").where(F.col("trace_id") != "f" * 32).select(
        "trace_id", "span_id", F.col("timestamp").alias("start_time"))


@query
def stream_metrics(spark, sf):
    """30-second metric windows from a stream of records."""
    root = _scratch(spark)
    windows = pipeline.metric_windows(_record_stream(spark, sf, root))
    _finish(pipeline.to_table(windows, f"{root}/metrics", f"{root}/ck", once=True))
    return spark.read.parquet(f"{root}/metrics").withColumn(
        "avg_ms_per_token", F.col("avg_s_per_token") * 1000).drop("avg_s_per_token", "sketch")


@query
def stream_alerts(spark, sf):
    """Sliding alert windows from a stream of records."""
    root = _scratch(spark)
    alerts = pipeline.alert_windows(_record_stream(spark, sf, root), 0.05, 0.5, 2500)
    _finish(pipeline.to_table(alerts, f"{root}/alerts", f"{root}/ck", once=True))
    return spark.read.parquet(f"{root}/alerts")


@query
def stream_trace_costs(spark, sf):
    """Traces above a cost limit, per hour, from a stream of records."""
    root = _scratch(spark)
    dear = pipeline.trace_cost_windows(_record_stream(spark, sf, root), 0.1)
    _finish(pipeline.to_table(dear, f"{root}/dear", f"{root}/ck", once=True))
    return spark.read.parquet(f"{root}/dear")


@query
def stream_spikes(spark, sf):
    """Hourly error rates of a stream of records against the day before, all columns."""
    root = _scratch(spark)
    found = spikes.error_spikes(_record_stream(spark, sf, root))
    _finish(pipeline.to_table(found, f"{root}/spikes", f"{root}/ck", once=True))
    return spark.read.parquet(f"{root}/spikes")


@query
def stream_cost_spikes(spark, sf):
    """Hourly costs of a stream of records against the day before, quiet hours included."""
    root = _scratch(spark)
    found = spikes.cost_spikes(_record_stream(spark, sf, root))
    _finish(pipeline.to_table(found, f"{root}/spikes", f"{root}/ck", once=True))
    return spark.read.parquet(f"{root}/spikes")


@query
def stream_sample_batches(spark, sf):
    """The sampling stream fed in several runs, in time order."""
    root = _scratch(spark)
    third = F.floor(F.dayofmonth("start_time") / 11)  # the spans lie within one month
    fixtures.spans(spark, sf).withColumn("third", third.cast("int")).write.partitionBy("third").parquet(f"{root}/parts")
    parts = spark.read.parquet(f"{root}/parts")
    staged, kept = f"{root}/staged", f"{root}/kept"
    for part in (0, 1, 2, None):
        if part is None:
            _closing_span(spark, f"{root}/spans")
        else:
            parts.where(F.col("third") == part).drop("third").write.mode("append").parquet(f"{root}/spans")
        stream = span_files.stream_spans(spark, f"{root}/spans")
        _finish(pipeline.stage(stream, staged, f"{root}/ck-stage", once=True))
        _finish(pipeline.sample(span_files.stream_spans(spark, staged), staged, kept, f"{root}/decisions",
                                f"{root}/ck-sample", once=True))
    return spark.read.parquet(kept).select("trace_id", "span_id", F.col("timestamp").alias("start_time"))
