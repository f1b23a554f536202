"""Free-form JSON payloads, whose shape differs from row to row.

Their strings are listed by variants on the JVM. Only redaction needs Python: an
Arrow-batched function that writes the changed payload.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .pii import Redactor


def _walk(value, change: Callable[[str], str], depth: int, max_depth: int):
    if depth > max_depth:
        return value
    if isinstance(value, str):
        return change(value)
    if isinstance(value, dict):
        return {k: _walk(v, change, depth + 1, max_depth) for k, v in value.items()}
    if isinstance(value, list):
        return [_walk(v, change, depth + 1, max_depth) for v in value]
    return value


def redact_json(payload: Column, redactor: Redactor, max_depth: int = 10) -> Column:
    """Redact all strings of a JSON payload up to ``max_depth`` levels down.

    Payloads that hold nothing a pattern could match stay on the JVM side. Text
    that is not JSON, or nested too deeply to be parsed, is redacted as text.
    """
    change = redactor.redactor()

    def run(text: str) -> str:
        try:
            value = json.loads(text)
            new = _walk(value, change, 0, max_depth)
            return text if new == value else json.dumps(new, ensure_ascii=False)
        except (ValueError, RecursionError):
            return change(text)

    @F.pandas_udf("string")
    def redact_payload(texts: pd.Series) -> pd.Series:
        return texts.map(run, na_action="ignore")

    if redactor.custom:
        return redact_payload(payload)
    # Escaped characters may hide what a pattern looks for, so they count too.
    worth = payload.rlike(r"(?U)[@\d\\]")
    return F.when(worth, redact_payload(F.when(worth, payload))).otherwise(payload)


#: How far down the strings of a payload are listed one by one.
LEAF_DEPTH = 16
#: One level down: path and value of what a container holds; anything else stays as it is.
_PATH = """CASE WHEN pos IS NULL THEN path WHEN key IS NULL THEN concat(path, '[', pos, ']')
 WHEN path = '' THEN key ELSE concat(path, '.', key) END"""
_VALUE = "CASE WHEN pos IS NULL THEN part ELSE value END"
_START = "coalesce(try_parse_json({0}), CAST({0} AS VARIANT))"
_TEXT = """CASE WHEN schema_of_variant(part) = 'STRING' THEN variant_get(part, '$', 'string')
 WHEN schema_of_variant(part) RLIKE '^(OBJECT|ARRAY)' AND to_json(part) NOT IN ('{}', '[]') THEN to_json(part) END"""


def json_leaves(df: DataFrame, payload: str, max_depth: int = LEAF_DEPTH) -> DataFrame:
    """One row per string of a JSON column: the other columns, ``path`` (``a.b[0].c``) and ``value``.

    Payloads are parsed once into variants and opened level by level, all in one stage on
    the JVM. Text that is not JSON, or nested so deeply that it cannot be parsed, is one
    string with an empty path; NULL has none. What lies below ``max_depth`` levels is one
    string as well: its JSON, at the path where it begins. Of repeated keys the last counts;
    what follows a complete JSON value is ignored.
    """
    spark = df.sparkSession
    others = [F.col(f"`{c}`") for c in df.columns if c != payload]
    rows = df.where(F.col(f"`{payload}`").isNotNull()).select(
        F.struct(*others).alias("row") if others else F.lit(None).alias("row"),
        F.lit("").alias("path"), F.expr(_START.format(f"`{payload}`")).alias("part"))
    for _ in range(max_depth):
        inside = spark.tvf.variant_explode_outer(F.col("part").outer())
        rows = rows.lateralJoin(inside).select("row", F.expr(_PATH).alias("path"), F.expr(_VALUE).alias("part"))
    return rows.select(*(["row.*"] if others else []), "path", F.expr(_TEXT).alias("value")).where("value IS NOT NULL")


def register(spark: SparkSession, max_depth: int = LEAF_DEPTH) -> None:
    """Make ``json_leaves(payload)`` available to SQL, as a table function (path, value)."""
    query = f"SELECT '' AS path, {_START.format('payload')} AS part"
    for _ in range(max_depth):
        query = (f"SELECT {_PATH} AS path, {_VALUE} AS part FROM ({query}) AS above,"
                 " LATERAL variant_explode_outer(above.part)")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION json_leaves(payload STRING)
 RETURNS TABLE (path STRING, value STRING) RETURN SELECT path, value FROM (
 SELECT path, {_TEXT} AS value FROM ({query})) WHERE value IS NOT NULL AND payload IS NOT NULL""")
