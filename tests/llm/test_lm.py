"""Language model: the base by brute force, normalisation, gains on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from agentaudit.llm import blocks, lm
from agentaudit.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = "\n"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low) + [END]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(docs):
    c = Counter(t for i, text in docs if not held(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for i, text in docs:
        ts = tokens(text)
        out.append((i, held(i), len(ts), sum(c[t] > 0 for t in ts), n,
                    sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)))
    return out


def same(got, want):
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [tuple(r) for r in QUERIES["op2_lm_score"](spark, sf).collect()]
    same([r[:6] for r in rows], brute(docs))


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = QUERIES["op2_lm_score"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / n > sum(r["base_score"] for r in rows) / n + 0.3
    # On texts of known words only, too.
    known = [r for r in rows if r["n_known"] == r["n_tokens"]]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)


def test_blocks_of_any_size_agree(spark, monkeypatch):
    docs = [(i, " ".join(f"W{(i * j) % 23}" for j in range(i % 30))) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    encode = blocks.encode
    monkeypatch.setattr(lm, "encode", lambda rows, lower: encode(rows, lower, 50))
    small = sorted(tuple(r)[:6] for r in lm.score(df).collect())
    same(small, brute(docs))


def counted():
    """Five words: two heads, two endings, one in the rest."""
    total = np.array([50.0, 30, 12, 8, 5, 20])
    discount = np.array([0, 0, 0.5, 0.4, 0.9, 0])
    words = np.array([1, 1, 3, 2, 4, 1])
    unknown = np.where(discount > 0, discount * words / total, 0)
    return lm.Counts(125, 11, 20, {"the": 0, "of": 1}, {"on": 2, "er": 3}, total, discount, unknown)


def test_probabilities_add_up_to_one():
    counts = counted()
    model = lm.Model.fresh(counts.total)
    words = ["the", "of", "on", "ion", "tion", "er", "her", "a", "b", "c", "d", "unseen"]
    c = np.array([50, 30, 6, 4, 2, 5, 3, 2, 1, 1, 1, 0])
    for context in ([], [0], [2, 7], [11, 1]):
        total = 0.0
        for w in range(len(words)):
            stream = np.array([*context, w])
            whole = lm.block_scores(counts, model, words, c, stream, np.array([len(stream)]))[2][0]
            # The probability of the last word: everything but the end and the words before.
            both = lm.block_scores(counts, model, words, c, np.concatenate((stream, stream[:-1])),
                                   np.array([len(stream), len(stream) - 1]))[2]
            ends = np.log10(np.exp([_end(counts, model, words, s) for s in (stream, stream[:-1])]))
            total += 10 ** ((whole - ends[0]) - (both[1] - ends[1]))
        total += np.exp(_end(counts, model, words, np.array(context, int)))
        assert total == pytest.approx(1, abs=1e-4)


def _end(counts, model, words, stream):
    _, c1, c2, _ = lm.positions(counts.symbol(words)[stream], np.array([len(stream)]), counts.end)
    return model.log_probabilities(c1[-1:], c2[-1:])[0, counts.end]


def test_training_learns_a_bigram():
    rng = np.random.default_rng(0)
    total = np.array([1000.0, 1000, 1000, 1000])
    model = lm.Model.fresh(total)
    # 0 is followed by 1, 2 by 3.
    stream = np.repeat(rng.integers(0, 2, 60_000) * 2, 2) + np.tile([0, 1], 60_000)
    target = stream
    c1 = np.concatenate(([4], target[:-1]))
    c2 = np.concatenate(([4, 4], target[:-2]))
    squares = np.zeros_like(model.flat)
    model.train(c1, c2, target, total, squares, rng)
    p = np.exp(model.log_probabilities(np.array([0, 2]), np.array([1, 3])))
    assert p[0, 1] > 0.9 and p[1, 3] > 0.9


def test_edges(spark):
    schema = "doc_id long, text string, held int, score string, block long"
    assert lm.score(spark.createDataFrame([], schema)).count() == 0
    docs = [(None, None), (None, "a"), (1, ""), (1, ""), (2, "A a \x1cb É é"), (4, "x" * 100_000 + " y")]
    df = spark.createDataFrame([(*d, 1, "s", 2) for d in docs], schema)
    rows = [tuple(r) for r in lm.score(df).collect()]
    same([r[:6] for r in rows], brute(docs))
    assert all(math.isfinite(r[6]) and r[6] <= 1e-6 for r in rows)
    # Nothing to learn from: only held-out rows.
    alone = [d for d in docs if held(d[0])]
    rows = [tuple(r) for r in lm.score(spark.createDataFrame(alone, "doc_id long, text string")).collect()]
    same([r[:6] for r in rows], brute(alone))
    assert all(math.isfinite(r[6]) for r in rows)
