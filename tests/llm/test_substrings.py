"""Removal of repeated word windows against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from agentaudit.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def run(spark, texts, window=35, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.remove_repeats(docs.repartition(3, "doc_id"), window, **options).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_cover_has_every_difference():
    shifts = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert shifts == set(range(substrings.PERIOD))


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_with_shared_passages(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["É", "a\x1cb", "."]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (34, 35, 36, 60, 200)]
    texts = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        for p in rng.sample(passages, rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = p
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    texts += [texts[0], texts[0], None, "", " \n", "one", "a " * 40, "x y " * 40, " ".join(passages[3] * 2)]
    assert run(spark, texts) == brute(texts, 35)


def test_each_alignment(spark):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(35)]
    texts = [" ".join([f"d{d}x{i}" for i in range(d)] + passage + [f"e{d}"]) for d in range(45)]
    assert run(spark, texts) == brute(texts, 35)
    almost = [" ".join([f"f{d}"] * d + passage[:34] + [f"g{d}"]) for d in range(2, 20)]
    assert all(gone == 0 for _, gone, _ in run(spark, almost))
    assert rng


def test_empty_table_null_ids_and_other_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(docs).count() == 0
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(None, text, "b", 1), (None, text, "c", 2), (3, "x", None, 3)],
                                 "doc_id long, text string, words string, block int")
    got = sorted((r["id"] or 0, r["n_removed"]) for r in substrings.remove_repeats(docs).collect())
    assert got == [(0, 50), (0, 50), (3, 0)]


def test_query_against_brute_force(spark, sf):
    from agentaudit.llm.queries import QUERIES

    docs = sorted(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest())
            for (d, _), (n, gone, kept) in zip(docs, brute([t for _, t in docs], 35))]
    assert sorted(map(tuple, QUERIES["op9_substring_dedup"](spark, sf).select(
        "doc_id", "n_words", "n_removed", F.col("kept_sha256")).collect())) == want
