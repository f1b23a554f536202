"""Look-ups over the record table: by trace, agent, error, check, oversight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import in_range
from .skew import join_unique


def flag(name: str, records: DataFrame) -> Column:
    """A compliance flag: the plain column if the table has it, else from JSON."""
    if name in records.columns:
        return F.col(name)
    return F.get_json_object("compliance", f"$.{name}").cast("boolean")


def trace(records: DataFrame, trace_id: str) -> DataFrame:
    """All records of one trace in time order."""
    return records.where(F.col("trace_id") == trace_id).orderBy("timestamp", "span_id")


def traces(records: DataFrame, ids: DataFrame) -> DataFrame:
    """All records of the traces in ``ids`` (column ``trace_id``), in time order."""
    picked = join_unique(records, ids.select("trace_id").distinct(), ["trace_id"], "left_semi")
    return picked.orderBy("trace_id", "timestamp", "span_id")


def agent_records(records: DataFrame, agent_id: str, start, end, limit: int = 1000) -> DataFrame:
    """Records of one agent in a time range, oldest first."""
    own = in_range(records, start, end).where(F.col("agent_id") == agent_id)
    return own.orderBy("timestamp", "span_id").limit(limit)


def errors(records: DataFrame, start, end, limit: int = 500) -> DataFrame:
    """Failed records in a time range, newest first."""
    failed = in_range(records, start, end).where(F.col("status") == "error")
    return failed.orderBy(F.desc("timestamp"), "span_id").limit(limit)


def guardrail_failures(records: DataFrame, start, end) -> DataFrame:
    """Records with a failed check in a time range, newest first."""
    failed = in_range(records, start, end).where(~flag("all_passed", records))
    return failed.orderBy(F.desc("timestamp"), "span_id")


def human_oversight(records: DataFrame, start, end, ordered: bool = True) -> DataFrame:
    """Records with a human in the loop in a time range, oldest first."""
    seen = in_range(records, start, end).where(flag("human_in_loop", records)).select(
        "trace_id", "span_id", "agent_name", "timestamp", "operation_name"
    )
    return seen.orderBy("timestamp", "span_id") if ordered else seen


def reasoning_trail(records: DataFrame) -> DataFrame:
    """Why each agent acted, per trace in time order."""
    return records.select(
        "trace_id", "timestamp", "span_id", "agent_name",
        F.get_json_object("reasoning", "$.rationale").alias("rationale"),
        F.get_json_object("reasoning", "$.confidence").cast("double").alias("confidence"),
    ).orderBy("trace_id", "timestamp", "span_id")


def error_text() -> Column:
    """``type: message`` of a failed record, NULL otherwise."""
    return F.when(
        F.col("status") == "error",
        F.concat(
            F.coalesce("error_type", F.lit("None")), F.lit(": "),
            F.coalesce("error_message", F.lit("None")),
        ),
    )
