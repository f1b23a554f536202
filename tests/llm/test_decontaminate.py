"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import pytest

from agentaudit.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add("null" if item is None else str(item))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for at in range(len(w) - k + 1):
                if (key := tuple(w[at:at + k])) in windows:
                    hit |= set(range(at, at + k))
                    found |= windows[key]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = dc.scan(d, b, **options).select("id", "n_words", dc.covered("hits"), "items")
    return sorted((tuple(r[:3]) + (list(r[3]),) for r in found.collect()), key=repr)


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "And", "éa", "É", "x9", "日本", "a"] + [f"w{i}" for i in range(12)]
    text = lambda n: rng.choice([" ", "-", ", "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(3, 20)]
    items += [(7, items[5][1]), (None, "null item of the benchmark"), (99, None), (100, "!!")]
    docs = [(i, text(rng.randrange(30)) + " " + (items[rng.randrange(17)][1] or "").upper() + " " + text(20))
            for i in range(80)]
    return docs + [(None, None), (81, ""), (81, ""), (82, "?! ."), (83, items[6][1] * 3)], items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("broadcast_rows", [0, 10_000])
def test_random(spark, seed, broadcast_rows):
    docs, items = sample(seed)
    assert run(spark, docs, items, broadcast_rows=broadcast_rows) == brute(docs, items)


def test_long_items_only(spark):
    docs, items = sample(5)
    items = [(i, t) for i, t in items if len(words(t)) >= 10]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_benchmark_and_empty_documents(spark):
    docs, items = sample(6)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_removal_keeps_other_columns(spark):
    schema = "doc_id long, text string, words string, hits int, kept int, hash long"
    text = " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "a " + text + " b", "w", 1, 2, 3), (2, "clean", None, 1, 2, 3),
                                  (3, None, "w", None, 2, 3)], schema)
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    left = dc.remove_documents(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    spans = {r["row"]["doc_id"]: r["clean_words"] for r in dc.remove_spans(docs, bench).collect()}
    assert spans == {1: ["a", "b"], 2: ["clean"], 3: []}


def test_no_python_in_the_plan(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = dc.scan(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan


def test_digest_of_items(spark, sf):
    from agentaudit.llm.queries import QUERIES

    row = QUERIES["op4_decontamination"](spark, sf).where("contaminated").orderBy("doc_id").first()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = next(w for w in brute([d for d in docs if d[0] == row["doc_id"]], items))
    assert row["items_sha256"] == hashlib.sha256(",".join(want[3]).encode()).hexdigest()
