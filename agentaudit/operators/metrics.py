"""Metrics over records: latency, tokens, tools, models, evaluation scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .compliance import tool_calls

#: Upper bounds of the token histogram: powers of four.
TOKEN_BUCKETS = [4 ** i for i in range(14)]


def _windows(df: DataFrame, width: str, keys: list, aggregates: list[Column]) -> DataFrame:
    """Aggregates per tumbling window and keys; also works on a stream with a watermark."""
    out = df.groupBy(F.window("timestamp", width).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("window_start"), *[c for c in out.columns if c != "w"])


def operation_duration(records: DataFrame, width: str = "30 seconds", exact: bool = False) -> DataFrame:
    """Duration in seconds per window, operation and model.

    The 95th percentile comes from a sketch of fixed size unless ``exact``.
    """
    seconds = F.col("duration_ms") / 1000
    return _windows(records, width, ["operation_name", "model_name"], [
        F.count("duration_ms").alias("calls"),
        F.avg(seconds).alias("avg_s"),
        F.max(seconds).alias("max_s"),
        (F.percentile(seconds, F.lit(0.95)) if exact
         else F.percentile_approx(seconds, F.lit(0.95), F.lit(1000))).alias("p95_s"),
    ])


def token_bucket(tokens: Column) -> Column:
    """Number of the histogram bucket: how many bounds lie below the value."""
    bounds = F.array(*[F.lit(b).cast("long") for b in TOKEN_BUCKETS])
    return F.size(F.filter(bounds, lambda b: b < tokens))


def token_histogram(records: DataFrame, width: str = "30 seconds") -> DataFrame:
    """Token counts by window, kind of token and bucket."""
    kinds = F.map_filter(
        F.create_map(
            F.lit("input"), F.col("input_tokens"), F.lit("output"), F.col("output_tokens")
        ),
        lambda _, v: v.isNotNull(),
    )
    exploded = records.select("timestamp", F.explode(kinds).alias("token_type", "tokens"))
    return _windows(
        exploded.withColumn("bucket", token_bucket(F.col("tokens"))), width, ["token_type", "bucket"],
        [F.count(F.lit(1)).alias("records"), F.sum("tokens").alias("tokens")],
    )


def time_per_token(records: DataFrame) -> DataFrame:
    """Seconds per output token, by model."""
    per_token = F.col("duration_ms") / 1000 / F.nullif("output_tokens", F.lit(0))
    return records.groupBy("model_name").agg(
        F.count(per_token).alias("records"),
        F.avg(per_token).alias("avg_s_per_token"),
        F.max(per_token).alias("max_s_per_token"),
    )


def percentile_by(records: DataFrame, keys: list[str], value: str, q: float, out: str) -> DataFrame:
    """Exact percentile per group.

    Equal values are counted first, so what meets in one group is its distinct
    values with frequencies, not its rows.
    """
    counted = records.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counted.groupBy(*keys).agg(
        F.sum("_n").alias("records"),
        F.percentile(F.col(value), F.lit(q), F.col("_n")).alias(out),
    )


def trace_cost_alerts(records: DataFrame, limit_usd) -> DataFrame:
    """Traces that cost more than a limit."""
    costs = records.groupBy("trace_id").agg(F.sum("cost_usd").alias("total_cost"))
    return costs.where(F.col("total_cost") > F.lit(limit_usd).cast("decimal(20,6)"))


def guardrail_rate(records: DataFrame, keys: list[Column | str], passed: Column) -> DataFrame:
    """Checked records, failures and failure rate per group."""
    checked = records.where(F.col("compliance").isNotNull())
    return checked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(~passed).alias("failed"),
        F.avg(F.coalesce(~passed, F.lit(False)).cast("int")).alias("failure_rate"),
    )


def guardrail_rate_alerts(records: DataFrame, keys, passed: Column, limit: float) -> DataFrame:
    """Groups whose checks fail more often than a limit."""
    return guardrail_rate(records, keys, passed).where(F.col("failure_rate") > limit)


def latency_alerts(records: DataFrame, limit_ms: float) -> DataFrame:
    """Agents whose 99th percentile of latency is above a limit."""
    return percentile_by(records, ["agent_id"], "duration_ms", 0.99, "p99_ms").where(
        F.col("p99_ms") > limit_ms
    )


def model_provenance(spans: DataFrame) -> DataFrame:
    """Requested against answering model, counted."""
    attr = lambda k: F.try_element_at("attributes", F.lit(k))
    models = spans.select(
        attr("gen_ai.request.model").alias("request_model"),
        attr("gen_ai.response.model").alias("response_model"),
    )
    return models.groupBy("request_model", "response_model").agg(
        F.count(F.lit(1)).alias("calls")
    ).withColumn("same_model", F.coalesce(
        F.col("request_model") == F.col("response_model"), F.lit(False)))


def eval_scores(records: DataFrame) -> DataFrame:
    """Evaluation scores per agent and kind of score."""
    scores = F.from_json(
        F.get_json_object("outcome", "$.eval_scores"), "map<string,double>"
    )
    rows = records.where(F.col("outcome").isNotNull()).select(
        "agent_id", F.explode(scores).alias("score_name", "score")
    )
    return rows.groupBy("agent_id", "score_name").agg(
        F.count("score").alias("scored"), F.avg("score").alias("avg_score"),
        F.min("score").alias("min_score"),
    )


def low_confidence(records: DataFrame, below: float) -> DataFrame:
    """Per agent: decisions with a confidence, and how many are below a bound."""
    confidence = F.get_json_object("reasoning", "$.confidence").cast("double")
    return records.where(F.col("reasoning").isNotNull()).groupBy("agent_id").agg(
        F.count(confidence).alias("decisions"),
        F.avg(confidence).alias("avg_confidence"),
        F.count_if(confidence < below).alias("low_confidence"),
    )


def tool_reliability(records: DataFrame) -> DataFrame:
    """Per tool: calls, share with status 400 and above, latency, retries."""
    field = lambda k: F.try_element_at("call", F.lit(k))
    status = field("tool.response_status").try_cast("int")
    return tool_calls(records.select("tool_calls")).groupBy(
        field("gen_ai.tool.name").alias("tool_name")
    ).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(status >= 400).alias("failed"),
        F.avg((status >= 400).cast("int")).alias("failure_rate"),
        F.avg(field("tool.latency_ms").try_cast("double")).alias("avg_latency_ms"),
        F.sum(field("tool.retry_count").try_cast("long")).alias("retries"),
    )
