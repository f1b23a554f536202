"""Reports from daily partial results against reports from the records."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from agentaudit.operators import compliance, cost, partials
from agentaudit.plans import fixtures
from agentaudit.sources import tables
from agentaudit.streaming import pipeline

from helpers import T0, record, records

SECTIONS = ["cost_attribution", "cost_hourly", "usage_periods", "root_usage_periods", "reference_databases",
            "guardrail_summary", "human_oversight"]


def plain(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(float(v), 9) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
                         for v in (r[c] for c in sorted(df.columns))))
    return sorted(out, key=repr)


def from_records(rows, name, first, last):
    mine = rows.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    wide = "0001-01-01", "9999-12-31"
    return {
        "cost_attribution": lambda: cost.cost_attribution(mine, *wide), "cost_hourly": lambda: cost.cost_hourly(mine),
        "usage_periods": lambda: compliance.usage_periods(mine, *wide),
        "root_usage_periods": lambda: compliance.root_usage_periods(mine),
        "reference_databases": lambda: compliance.reference_databases(mine, *wide),
        "guardrail_summary": lambda: compliance.guardrail_summary(mine, *wide),
        "human_oversight": lambda: compliance.human_oversight(mine, *wide, ordered=False)}[name]()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("partials"))
    tables.append(fixtures.records(spark, sf), f"{root}/table")
    rows = tables.read(spark, f"{root}/table")
    days = sorted(r["date"] for r in rows.select("date").distinct().collect())
    partials.refresh(rows, f"{root}/partials", days[:10])
    partials.refresh(rows, f"{root}/partials", days[10:])
    return root, rows, days


@pytest.mark.parametrize("name", SECTIONS)
def test_any_range_equals_the_scan(spark, stored, name):
    root, rows, days = stored
    rng = random.Random(name)
    ranges = [(days[0], days[-1]), ("2030-01-01", "2030-02-01")] + [
        tuple(sorted(rng.sample(days, 2))) for _ in range(3)] + [(days[4], days[4])]
    for first, last in ranges:
        got = getattr(partials, name)(spark, f"{root}/partials", first, last)
        assert plain(got) == plain(from_records(rows, name, first, last))


def test_only_partial_results_of_the_days_are_read(spark, stored):
    root, _, days = stored
    for name, section in partials.report(spark, f"{root}/partials", days[3], days[5]).items():
        plan = section._jdf.queryExecution().executedPlan().toString()
        assert f"{root}/table" not in plan and "PartitionFilters: [isnotnull(date" in plan, name
    size = lambda path: spark.read.parquet(path).count()
    assert size(f"{root}/partials/checks") <= 24 * len(days)


def test_distinct_traces_merge(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "sha2(cast(id % 20000 as string), 256) as trace_id", "hex(id) as span_id", "'a' as agent_id",
        "timestamp'2026-03-01' + make_interval(0, 0, 0, cast(id % 3 as int)) as timestamp",
        "if(id % 2 = 0, 'x', 'y') as agent_name")
    tables.append(rows.withColumn("trace_id", F.substring("trace_id", 1, 32)), f"{tmp_path}/t")
    records = tables.read(spark, f"{tmp_path}/t")
    partials.refresh(records, f"{tmp_path}/p", ["2026-03-01", "2026-03-02", "2026-03-03"])
    found = {r.agent_name: r.traces for r in partials.distinct_traces(spark, f"{tmp_path}/p", "2026-03-01", "2026-03-03").collect()}
    exact = {r.agent_name: r.n for r in records.groupBy("agent_name").agg(F.count_distinct("trace_id").alias("n")).collect()}
    assert found.keys() == exact.keys() and all(abs(found[a] / exact[a] - 1) < 0.05 for a in exact)


def test_settling_keeps_partial_results_up(spark, tmp_path):
    path, landing, root = (f"{tmp_path}/{n}" for n in ("table", "landing", "partials"))
    day = lambda n: T0 + timedelta(days=n)
    pipeline.land(records(spark, record(span="1", timestamp=day(0)), record(span="2", timestamp=day(1))), landing, 0)
    days = [str(day(n).date()) for n in (0, 1)]
    partials.settle_days(spark.read.parquet(landing), path, root, days)
    pipeline.land(records(spark, record(span="3", timestamp=day(0))), landing, 1)  # late
    for _ in range(2):
        partials.settle_days(spark.read.parquet(landing), path, root, days[:1])
    uses = partials.usage_periods(spark, root, *days).collect()
    assert [r.total_operations for r in uses] == [2, 1]
