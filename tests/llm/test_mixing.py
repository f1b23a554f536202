"""Pfair schedules: less than one block of deviation, and whole tables."""

import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from agentaudit.llm import mixing


@pytest.mark.parametrize("seed", range(20))
def test_less_than_one_block_from_target(seed):
    rng = random.Random(seed)
    shares = {f"s{i}": rng.choice([1, 1, 2, 3, 7, 40]) for i in range(rng.randrange(1, 12))}
    q, one = sum(shares.values()), mixing.period(shares)
    assert [slot for _, _, slot, _, _ in one] == list(range(q))
    given = Counter()
    for source, k, slot, release, deadline in one:
        assert k == given[source] and release <= slot < deadline
        given[source] += 1
        for s, w in shares.items():
            assert abs(given[s] - Fraction(w * (slot + 1), q)) < 1
    assert given == shares


def test_period_is_bounded():
    with pytest.raises(ValueError):
        mixing.period({"a": mixing.MAX_PERIOD, "b": 1})


def test_the_schedule_is_the_plain_one():
    rng = random.Random(3)
    for _ in range(50):
        shares = {f"s{i}": rng.randrange(1, 9) for i in range(rng.randrange(1, 9))}
        q, done, want = sum(shares.values()), dict.fromkeys(shares, 0), []
        for slot in range(q):
            deadline, source, k = min((-(-(k + 1) * q // shares[s]), s, k) for s, k in done.items()
                                      if k * q // shares[s] <= slot)
            want.append((source, k, slot, k * q // shares[source], deadline))
            done[source] += 1
        assert mixing.period(shares) == want


def test_many_sources_have_a_plan():
    one = mixing.period({f"s{i}": 1 + i % 3 for i in range(20_000)})
    assert all(release <= slot < deadline for _, _, slot, release, deadline in one)


@pytest.mark.parametrize("sent", [mixing.SENT_ROWS, 0])
def test_every_source_keeps_its_own_target(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT_ROWS", sent)
    rng = random.Random(1)
    rows = [(i, "x" * rng.choice([0, 1, 50, 50, 900]), rng.choice(["a", "a", "a", "b", "c", None, "zz", "", "null"]))
            for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shares = {"a": 3, "b": 2, None: 2, "absent": 5}
    got = mixing.schedule(docs, shares, block_chars=500).collect()
    assert sorted(r["id"] for r in got) == list(range(2000))
    pools = {"a": 3, "b": 2, None: 2, "c": 1, "zz": 1, "": 1, "null": 1}
    assert {r["pool"] for r in got} == set(pools)
    assert {r["id"]: (r["pool"], r["chars"]) for r in got} == {i: (s, len(t)) for i, t, s in rows}
    last = {p: max(r["slot"] for r in got if r["pool"] == p) for p in pools}
    assert all(r["in_mix"] == (r["slot"] <= min(last.values())) for r in got)
    # Up to any slot in the mix a source is less than a block, and one text, off its share.
    for slot in range(1, min(last.values())):
        for pool, w in pools.items():
            sent = sum(r["chars"] for r in got if r["pool"] == pool and r["slot"] < slot)
            assert abs(sent - Fraction(w, 11) * slot * 500) < 500 + 900
    for p in pools:
        own = sorted((r["block"], r["slot"]) for r in got if r["pool"] == p)
        assert [s for _, s in own] == sorted(s for _, s in own)


def test_shares_by_size(spark):
    rows = [("a", "x" * 900), ("b", "x" * 100), (None, "x" * 100), ("c", ""), ("d", None)]
    docs = spark.createDataFrame(rows, "source string, text string")
    assert mixing.shares_by_size(docs) == {"a": 60, "b": 20, None: 20, "c": 1, "d": 1}
    assert mixing.shares_by_size(docs, parts=11, power=1) == {"a": 9, "b": 1, None: 1, "c": 1, "d": 1}
    assert mixing.shares_by_size(docs.where("false")) == {}


def test_all_sources_of_the_documents(spark, sf):
    """No source of the table is more than a block, and one text, off its share, whatever its name."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    shares = mixing.shares_by_size(docs)
    assert set(shares) == {r[0] for r in docs.select("source").distinct().collect()}
    got = mixing.schedule(docs, shares, block_chars=2000).collect()
    q, longest = sum(shares.values()), max(r["chars"] for r in got)
    end = max(r["slot"] for r in got if r["in_mix"])
    for slot in range(1, end, 7):
        for pool, w in shares.items():
            sent = sum(r["chars"] for r in got if r["pool"] == pool and r["slot"] < slot)
            assert abs(sent - Fraction(w, q) * slot * 2000) < 2000 + longest


def test_edges(spark):
    schema = "doc_id long, text string, source string, slot string, block int, mix int"
    assert mixing.schedule(spark.createDataFrame([], schema), {"a": 1}, keep_rows=True).count() == 0
    docs = spark.createDataFrame([(None, None, None, "s", 1, 1), (1, "", "a", None, 1, 1), (1, "", "a", None, 1, 1),
                                  (2, "y" * 200_000, "a", "s", None, 2)], schema)
    got = mixing.schedule(docs, {"a": 1}, keep_rows=True)
    assert sorted((r["row"]["doc_id"] or 0, r["pool"], r["chars"]) for r in got.collect()) == [
        (0, None, 0), (1, "a", 0), (1, "a", 0), (2, "a", 200_000)]


def test_null_ids_spread_over_the_buckets(spark):
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", "cast(id as string) as text", "'hot' as source")
    plan = mixing.schedule(docs, {})
    assert plan.count() == 3000
    key = F.md5(F.concat(F.lit(":"), F.md5("text")))
    assert docs.select(F.substring(key, 1, 2)).distinct().count() > 200
