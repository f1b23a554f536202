"""Hand-made records and spans for tests."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from agentaudit.schema import RECORD, SPAN
from agentaudit.sources.tables import conform

T0 = datetime(2026, 3, 27, 14, 32, 1)


def at(ms: int) -> datetime:
    return T0 + timedelta(milliseconds=ms)


def record(trace="t", span="s", **values):
    row = {f.name: None for f in RECORD}
    row.update(trace_id=trace, span_id=span, agent_id="a1", timestamp=T0, status="ok",
               created_at=T0, date=T0.date())
    row.update(values)
    if isinstance(row["cost_usd"], str):
        row["cost_usd"] = Decimal(row["cost_usd"])
    return tuple(row[f.name] for f in RECORD)


def records(spark, *rows):
    df = spark.createDataFrame(list(rows), RECORD)
    return conform(df.drop("all_passed", "human_in_loop")).withColumn("date", F.to_date("timestamp"))


def span(trace="1", span_id="1", **values):
    row = {f.name: None for f in SPAN}
    row.update(trace_id=trace, span_id=span_id, start_time=T0, end_time=T0, status_code="1",
               attributes={}, resource={}, events=[])
    row.update(values)
    return tuple(row[f.name] for f in SPAN)


def spans(spark, *rows):
    return spark.createDataFrame(list(rows), SPAN)


def event(name, **attributes):
    return (name, T0, {k.replace("__", "."): v for k, v in attributes.items()})
