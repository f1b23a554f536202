"""Exact deduplication: defined results, collisions, state across batches."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from agentaudit.llm import exact
from agentaudit.llm.common import folder


def groups(rows):
    """Brute force: (keep_id, group_size, kept) by unique id."""
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    return sorted((i, max(by_text[t or ""]), len(by_text[t or ""]), i == max(by_text[t or ""])) for i, t in rows)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = exact.members(exact.located(docs, plain_scan=False), **options)
    return sorted(tuple(r) for r in found.select("id", "keep_id", "group_size", "kept").collect())


def sample(n=300, seed=1):
    rng = random.Random(seed)
    texts = [None, "", " ", "a", "A", "x" * 50_000, "x" * 50_000 + "y"] + [f"t{i}" for i in range(40)]
    return [(i, rng.choice(texts)) for i in rng.sample(range(10_000), n)]


def test_groups(spark):
    rows = sample()
    assert run(spark, rows) == groups(rows)


@pytest.mark.parametrize("digits", [0, 1])
def test_colliding_digests_are_told_apart_by_full_text(spark, digits):
    rows = sample(120, 2)
    weak = lambda text: F.substring(F.sha2(text, 256), 1, digits)
    assert run(spark, rows, digest=weak) == groups(rows)


def test_state_goes_on_over_batches(spark):
    rows = sample(200, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert run(spark, rows, files_per_batch=1) == groups(rows)
    # A second call with the same checkpoint remembers the first one's digests.
    places = exact.located(docs, plain_scan=False)
    arrivals = places.select(exact.sha256(F.coalesce("row.text", F.lit(""))).alias("digest"),
                             F.col("row.doc_id").alias("id"), "file", "place")
    path, checkpoint = folder(spark, "in"), folder(spark, "state")
    for part in arrivals.randomSplit([0.5, 0.5], 4):
        part.write.mode("append").parquet(path)
        exact.remember(spark.readStream.schema(arrivals.schema).parquet(path), checkpoint)
    seen = {r["digest"]: (r["keeper"]["id"], r["n"]) for r in exact.recall(spark, checkpoint).collect()}
    want = {}
    for i, t in rows:
        d = hashlib.sha256((t or "").encode()).hexdigest()
        best, n = want.get(d, (-1, 0))
        want[d] = (max(best, i), n + 1)
    assert seen == want


def test_ties_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (None, "a"), (1, "a"), (1, "a"), (None, "b"), (2, "c")]
    got = run_any(spark, rows)
    assert [r[1:3] for r in got if r[4] == "a"] == [(1, 4)] * 4
    assert sum(r[3] for r in got if r[4] == "a") == 1
    assert [r[1:4] for r in got if r[4] == "b"] == [(None, 1, True)]


def run_any(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = exact.located(docs, plain_scan=False)
    found = exact.members(places).join(places, ["file", "place"])
    return [tuple(r) for r in found.select("id", "keep_id", "group_size", "kept", "row.text").collect()]


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, kept string, digest int, file string, place long, row int, _metadata string"
    assert exact.deduplicate(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "a", None, 1, "f", 2, 3, "m"), (2, "a", "k", 1, "f", 2, 3, None)], schema)
    got = exact.deduplicate(docs)
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.collect()] == [(2, "a", "k", 1, "f", 2, 3, None)]


def test_plain_scan_and_landed_table_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    assert ids(exact.deduplicate(docs, plain_scan=True)) == ids(exact.deduplicate(docs.where("doc_id >= 0")))


def test_sift_lets_all_wanted_pass(spark):
    rows = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    wanted = rows.where("id % 10 = 0")
    for bits in (1 << 10, 1 << 26):
        passed = {r["id"] for r in exact.sifted(rows, wanted, bits).collect()}
        assert set(range(0, 2000, 10)) <= passed
    assert len(passed) < 210
