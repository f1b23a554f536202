"""Personal-data jobs over text columns and record payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import json_leaves
from ..functions.pii import Redactor
from ..functions.text import LIMITS, truncate


def redact_text(df: DataFrame, column: str, redactor: Redactor, mode: str = "sequential") -> DataFrame:
    """Replace personal data in a text column.

    ``mode="longest"`` searches the original text only and lets the longest
    match win; the default runs the patterns one after another.
    """
    text = F.col(column)
    clean = redactor.redact_longest(text) if mode == "longest" else redactor.redact(text)
    return df.withColumn(column, clean)


def scan_text(df: DataFrame, column: str, redactor: Redactor) -> DataFrame:
    """Add ``scan``: lengths, matches, flag and types."""
    return df.withColumn("scan", redactor.scan(F.col(column)))


def detections(df: DataFrame, keys: Sequence[str], column: str, redactor: Redactor) -> DataFrame:
    """One row per match: keys, type, start, end, length."""
    found = df.select(*keys, F.explode(redactor.detect(F.col(column))).alias("d"))
    return found.select(*keys, "d.*")


def payload_leaves(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per string inside JSON payload columns: keys, column, path, value."""
    stacked = df.select(*keys, F.explode(F.map_filter(
        F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))]),
        lambda _, v: v.isNotNull(),
    )).alias("field", "payload"))
    return json_leaves(stacked, "payload")


def field_path() -> Column:
    """Column and path of a string in one, such as ``state.a.b[0]``."""
    return F.concat(F.col("field"), F.when(F.col("path").startswith("["), "")
                    .when(F.col("path") == "", "").otherwise("."), F.col("path"))


def payload_detections(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                       redactor: Redactor) -> DataFrame:
    """One row per match inside JSON payload columns, with its path.

    Payloads without a digit or ``@`` (or an escape that may hide one) are
    dropped before they are parsed, unless there are patterns of one's own.
    """
    if not redactor.custom:
        worth = lambda c: F.when(F.col(c).rlike(r"(?U)[@\d\\]"), F.col(c)).alias(c)
        df = df.select(*keys, *[worth(c) for c in columns])
    values = payload_leaves(df, keys, columns)
    return detections(values.withColumn("field_path", field_path()), [*keys, "field_path"], "value", redactor)


def summary(found: DataFrame) -> DataFrame:
    """Matches per type and field, with list positions folded together."""
    field = F.regexp_replace("field_path", r"\[\d+\]", "[]")
    return found.groupBy("type", field.alias("field_path")).agg(
        F.count(F.lit(1)).alias("detections"), F.sum("length").alias("characters")
    )


# Words that decide the route of a request, with confidence.
ROUTES = [
    ("weather_agent", 0.95, ["weather", "temperature", "forecast"]),
    ("research_agent", 0.88, ["search", "find", "research", "what is"]),
]
DEFAULT_ROUTE = ("general_agent", 0.72)


def route_intent(df: DataFrame, column: str) -> DataFrame:
    """Add ``route`` and ``confidence`` by the words a text contains."""
    text = F.lower(F.col(column))

    def chain(position: int, default) -> Column:
        out = F.lit(default)
        for row in reversed(ROUTES):
            hit = text.rlike("|".join(row[2]))
            out = F.when(hit, F.lit(row[position])).otherwise(out)
        return out

    return df.withColumns({
        "route": chain(0, DEFAULT_ROUTE[0]), "confidence": chain(1, DEFAULT_ROUTE[1]),
    })


def text_guardrails(df: DataFrame, column: str, redactor: Redactor, score: Column | None = None,
                    threshold: float = 0.3) -> DataFrame:
    """Check every text: ``checks`` (one struct per check), ``all_passed``, ``clean``.

    The personal-data check passes when nothing is found; its score is the
    number of matches. With ``score`` a second check passes below ``threshold``.
    Only texts that fail the first check are redacted.
    """
    scanned = df.withColumn("_found", redactor.detect(F.coalesce(column, F.lit(""))))
    hits = F.size("_found")
    types = F.array_join(F.array_distinct(F.transform("_found", lambda d: d["type"])), ", ")
    details = F.when(hits > 0, F.concat(F.lit("PII types found: "), types)).otherwise("Clean")
    checks = [F.struct(
        F.lit("pii_scanner").alias("name"), (hits == 0).alias("passed"),
        hits.cast("double").alias("score"), F.lit(0.0).alias("threshold"),
        truncate(details, LIMITS["guardrail.details"]).alias("details"),
    )]
    if score is not None:
        checks.append(F.struct(
            F.lit("hallucination_detector").alias("name"), (score < threshold).alias("passed"),
            score.cast("double").alias("score"), F.lit(threshold).alias("threshold"),
            F.lit("").alias("details"),
        ))
    return scanned.withColumns({
        "checks": F.array(*checks),
        "all_passed": F.forall(F.array(*checks), lambda c: F.coalesce(c["passed"], F.lit(True))),
        "clean": F.when(hits > 0, redactor.redact(F.col(column))).otherwise(F.col(column)),
    }).drop("_found")
