"""The record table: create, append, read, storage tiers and retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MAX_LENGTH, RECORD, REQUIRED
from ..session import cut

#: Largest number of rows in one small-batch output file.
BATCH_ROWS = 1024
#: How often a stream writes a batch.
BATCH_SECONDS = 5
#: Written into every row group: a Bloom filter of its trace ids, as large as it needs to be.
TRACE_INDEX = {
    "parquet.bloom.filter.enabled#trace_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}
#: How rows lie inside a day: by agent and time, or all rows of a trace together.
LAYOUTS = {
    "agent": ["agent_id", "timestamp", "span_id"],
    "trace": ["trace_hash", "trace_id", "timestamp", "span_id"],
}
#: Most trace ids of one look-up; session.SETTINGS lets the reader push as many.
LOOKUP_IDS = 100


def create_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Create the append-only record table if it does not exist.

    Instead of indexes: partitions by ``date`` serve the time filters, rows sorted by
    agent and time inside each file serve agent and error look-ups through Parquet
    statistics, and Bloom filters of the trace ids serve look-ups of traces.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RECORD)
    location = f" LOCATION '{path}'" if path else ""
    options = ", ".join(f"'{k}' '{v}'" for k, v in TRACE_INDEX.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) "
        f"USING parquet OPTIONS ({options}) PARTITIONED BY (date){location}"
    )


def conform(records: DataFrame) -> DataFrame:
    """Bring records to the table schema: all columns, types, order, defaults.

    Empty JSON payloads become NULL, text ids lose padding, ``status`` defaults
    to ``ok`` and ``date`` follows ``timestamp``.
    """
    have = set(records.columns)

    def column(field: T.StructField):
        name, kind = field.name, field.dataType
        value = F.col(name) if name in have else F.lit(None)
        if name in ("trace_id", "span_id"):
            value = F.trim(value)
        elif name == "parent_span_id":
            value = F.nullif(F.trim(value), F.lit(""))
        elif name == "status":
            value = F.coalesce(value, F.lit("ok"))
        elif name == "date":
            value = F.to_date("timestamp")
        elif name == "created_at" and name not in have:
            value = F.current_timestamp()
        elif name in ("all_passed", "human_in_loop") and name not in have:
            value = (
                F.get_json_object("compliance", f"$.{name}")
                if "compliance" in have else F.lit(None)
            )
        elif name in ("reasoning", "inter_agent", "state", "outcome", "compliance", "tool_calls"):
            value = F.when(~F.trim(value).isin("{}", "[]", "", "null"), value)
        return value.cast(kind).alias(name)

    return records.select(*[column(f) for f in RECORD])


def _clustered(records: DataFrame, layout: str = "agent") -> DataFrame:
    """Records in table form, range-partitioned and sorted by day and the layout's columns."""
    order = [F.xxhash64("trace_id") if c == "trace_hash" else F.col(c) for c in ["date", *LAYOUTS[layout]]]
    return conform(records).repartitionByRange(*order).sortWithinPartitions(*order)


def append(records: DataFrame, target: str, max_rows_per_file: int | None = None, layout: str = "agent") -> None:
    """Append records to the table ``target``, a path or the name of a created table.

    An empty input adds no rows. New days of a named table are registered with it.

    The rows are range-partitioned by day and the columns of the ``layout``. By agent and
    time, a hot day or agent is spread over many tasks, and each file covers a narrow range
    of agents and times, which its Parquet statistics let later scans skip. By trace, the
    rows of a trace lie together, so that a look-up reads one or two row groups a day; a
    hot trace is still spread, since the range goes on by time.
    """
    writer = _clustered(records, layout).write.mode("append").options(**TRACE_INDEX)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if "/" in target:
        writer.partitionBy("date").parquet(target)
    else:
        writer.insertInto(target)


def settle_day(landed: DataFrame, path: str, day, layout: str = "agent") -> None:
    """Write one day of landed stream output to the table; see ``settle_days``."""
    settle_days(landed, path, [day], layout)


def settle_days(landed: DataFrame, path: str, days: Sequence, layout: str = "agent") -> None:
    """Write days of landed stream output to the table, in large clustered files.

    Streams leave many small files. This replaces the days in the table by all that has
    landed for them and by what else the table holds: records that came another way, such
    as appended ones, stay. It can run again after late spans came in. Other days are
    neither read nor written.
    """
    these = F.col("date").isin([str(d) for d in days])
    rows = conform(landed.where(these))
    spark = landed.sparkSession
    if _exists(spark, path):
        # Read before the days are replaced, and cut off from the files that go.
        others = read(spark, path).where(these).join(
            rows.select("trace_id", "span_id"), ["trace_id", "span_id"], "left_anti")
        rows = rows.unionByName(cut(others.select(*rows.columns)))
    _clustered(rows, layout).write.mode("overwrite").options(**TRACE_INDEX).option(
        "partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(RECORD).parquet(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def read(spark: SparkSession, path: str) -> DataFrame:
    """Read the record table with its fixed schema (nothing is inferred)."""
    return spark.read.schema(RECORD).parquet(path)


def find_traces(records: DataFrame, trace_ids: Sequence[str], first_day=None, last_day=None) -> DataFrame:
    """All records of a few traces of the stored table, read through its Bloom filters.

    Row groups without any of the ids are not read; ``first_day`` and ``last_day`` leave
    out whole days, both included. For more than ``LOOKUP_IDS`` ids join with a table of
    them instead (``lookup.traces``). Unknown ids find nothing; null ids are ignored.
    """
    ids = sorted({i for i in trace_ids if i is not None})
    if len(ids) > LOOKUP_IDS:
        raise ValueError(f"a look-up takes up to {LOOKUP_IDS} trace ids")
    keep = F.col("trace_id").isin(ids)
    if first_day is not None:
        keep &= F.col("date") >= F.lit(first_day).cast("date")
    if last_day is not None:
        keep &= F.col("date") <= F.lit(last_day).cast("date")
    return records.where(keep).orderBy("trace_id", "timestamp", "span_id")


def in_range(records: DataFrame, start, end, end_inclusive_day: bool = False) -> DataFrame:
    """Records with ``timestamp`` between two bounds, both included.

    A date given as text means its midnight, so the last day of a range drops
    out unless ``end_inclusive_day`` is set. Where the input has a ``date``
    column the same bounds are put on it, which prunes partitions.
    """
    lo = F.lit(start).cast("timestamp")
    hi = F.lit(end).cast("timestamp")
    if end_inclusive_day:
        day_after = F.date_add(hi.cast("date"), 1)
        keep = (F.col("timestamp") >= lo) & (F.col("timestamp") < day_after.cast("timestamp"))
    else:
        keep = F.col("timestamp").between(lo, hi)
    if "date" in records.columns:
        keep = F.col("date").between(lo.cast("date"), hi.cast("date")) & keep
    return records.where(keep)


def violations() -> F.Column:
    """Names of the record rules a row breaks, as an array (empty: valid).

    Meant for rows before ``conform``: a column that is already cut to its type can no
    longer be too long or too large. An empty required text counts as missing.
    """
    missing = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    rules = [F.when(missing(c), F.lit(f"{c} is null")) for c in REQUIRED]
    rules += [
        F.when(F.length(c) > n, F.lit(f"{c} longer than {n}")) for c, n in MAX_LENGTH.items()
    ]
    limit = F.lit(10_000).cast("decimal(20,6)")
    rules.append(F.when(F.abs("cost_usd") >= limit, F.lit("cost_usd out of range")))
    return F.array_compact(F.array(*rules))


def validate(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split records into (valid, quarantined with ``violations``)."""
    checked = records.withColumn("violations", violations())
    valid = checked.where(F.size("violations") == 0).drop("violations")
    return valid, checked.where(F.size("violations") > 0)


def with_tier(records: DataFrame, now: datetime | date | str) -> DataFrame:
    """Add the storage tier by age in days: hot 0–7, warm 7–90, cold from 90."""
    age = F.datediff(F.lit(now).cast("date"), F.to_date("timestamp"))
    tier = F.when(age < 7, "hot").when(age < 90, "warm").otherwise("cold")
    return records.withColumn("tier", tier)


def tier_summary(records: DataFrame, now) -> DataFrame:
    """Rows and first/last day per tier."""
    return with_tier(records, now).groupBy("tier").agg(
        F.count(F.lit(1)).alias("records"),
        F.min(F.to_date("timestamp")).alias("first_day"),
        F.max(F.to_date("timestamp")).alias("last_day"),
    )


def export_tiers(records: DataFrame, path: str, now) -> None:
    """Write records as gzip JSON lines by tier and day (for tiers past hot)."""
    out = with_tier(records, now)
    if "date" not in out.columns:
        out = out.withColumn("date", F.to_date("timestamp"))
    out = out.where(F.col("tier") != "hot")
    out.write.mode("append").partitionBy("tier", "date").option("compression", "gzip").json(path)


def retention_audit(records: DataFrame, now, months: int = 6, tag: str | None = None,
                    months_by_tag: dict[str, int] | None = None) -> DataFrame:
    """How far back records reach, per tag, against the months they must be kept.

    ``tag`` names a column; ``months_by_tag`` overrides the minimum for some of
    its values (84 for financial records).
    """
    label = F.col(tag) if tag else F.lit("all")
    needed = F.lit(months)
    for value, n in (months_by_tag or {}).items():
        needed = F.when(F.col("tag") == value, F.lit(n)).otherwise(needed)
    today = F.lit(now).cast("date")
    return (
        records.groupBy(label.alias("tag"))
        .agg(
            F.min(F.to_date("timestamp")).alias("first_day"),
            F.max(F.to_date("timestamp")).alias("last_day"),
            F.count(F.lit(1)).alias("records"),
        )
        .withColumn("months_required", needed.cast("int"))
        .withColumn("keep_from", F.add_months(today, -F.col("months_required")))
        .withColumn("covers_period", F.col("first_day") <= F.col("keep_from"))
    )


def retention_gaps(records: DataFrame) -> DataFrame:
    """Stretches of days without any record, between the first and the last day.

    Works on one row per day, so the window sees at most the number of days.
    """
    days = records.select(F.to_date("timestamp").alias("day")).distinct()
    following = F.lead("day").over(Window.orderBy("day"))
    return (
        days.withColumn("next_day", following)
        .where(F.datediff("next_day", "day") > 1)
        .select(
            F.date_add("day", 1).alias("gap_start"),
            F.date_sub("next_day", 1).alias("gap_end"),
            (F.datediff("next_day", "day") - 1).alias("days"),
        )
    )
