"""Live spikes against the batch, over several runs and with quiet stretches."""

import random
from datetime import timedelta

import pytest

from agentaudit.operators import cost
from agentaudit.schema import RECORD
from agentaudit.sources import tables
from agentaudit.streaming import pipeline, spikes

from helpers import T0, record, records


def calls(rng, hours, agents=("a", "b", None)):
    """Hours with many, few and no calls, stretches of two days without any, failing bursts."""
    rows, quiet = [], {}
    for h in range(hours):
        for agent in agents:
            if quiet.get(agent, 0) > h or rng.random() < 0.3:
                continue
            if rng.random() < 0.03:
                quiet[agent] = h + rng.choice([5, 23, 24, 25, 60])
            burst = rng.random() < 0.05
            for i in range(rng.randrange(1, 5)):
                rows.append((h, record(
                    "t", f"{h}-{i}", timestamp=T0 + timedelta(hours=h, minutes=i), agent_name=agent,
                    status="error" if rng.random() < (0.9 if burst else 0.1) else "ok",
                    cost_usd=None if rng.random() < 0.1 else f"{rng.randrange(1, 100) * (50 if burst else 1)}.25")))
    return rows


@pytest.mark.parametrize("kind", ["error", "cost"])
def test_stream_equals_batch(spark, tmp_path, kind):
    rows = calls(random.Random(kind), 300)
    last = record("t", "end", timestamp=T0 + timedelta(hours=400), agent_name="end")
    parts = [[r for h, r in rows if lo <= h < lo + 100] for lo in (0, 100, 200)] + [[last]]
    live = {"error": spikes.error_spikes, "cost": spikes.cost_spikes}[kind]
    for part in parts:
        tables.conform(records(spark, *part)).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(RECORD).parquet(f"{tmp_path}/in")
        query = pipeline.to_table(live(stream), f"{tmp_path}/out", f"{tmp_path}/ck", once=True)
        query.awaitTermination()
        assert query.exception() is None
    batch = {"error": cost.error_spikes, "cost": cost.cost_spikes}[kind](records(spark, *[r for _, r in rows]))
    found = spark.read.parquet(f"{tmp_path}/out").select(*batch.columns)
    shape = lambda df: sorted((tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r)
                               for r in df.collect()), key=repr)
    got, want = shape(found), shape(batch)
    assert len(got) == len(want) and [r[:2] for r in got] == [r[:2] for r in want]
    for a, b in zip(got, want):
        assert [x is None for x in a] == [x is None for x in b]
        assert [x for x in a[2:] if x is not None] == pytest.approx([x for x in b[2:] if x is not None], rel=1e-9, abs=1e-9)
    assert any(r[-1] for r in want)


def test_judging():
    assert spikes.judge(1.0, [], 2.0) == (None, None, False)
    assert spikes.judge(1.0, [0.5], 2.0) == (0.5, None, False)
    assert spikes.judge(9.0, [1.0, None, 3.0], 2.0) == (2.0, pytest.approx(2 ** 0.5), True)
    assert spikes.judge(None, [1.0, 3.0], 2.0)[2] is False
