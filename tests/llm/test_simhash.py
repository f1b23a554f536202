"""Fingerprints, the trie join and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from agentaudit.llm import simhash
from agentaudit.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text, k=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), seed=42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=2):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unique = sorted(root)
    for i, a in enumerate(unique):
        for b in unique[i + 1:]:
            if (a ^ b).bit_count() <= budget:
                root[find(b)] = find(a)
    return {p: find(p) for p in unique}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "A b C d", "É a\x1cb x x x x", "w " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def crowded(rng, n):
    """Fingerprints in a few tight balls, with chains, ties and far-off ones."""
    out = [0, (1 << 64) - 1, 1 << 63]
    for _ in range(n):
        base = rng.choice(out) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randrange(5)):
            base ^= 1 << rng.randrange(64)
        out.append(base)
    return out


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_walk_finds_all_links(budget):
    rng = random.Random(budget)
    for depth in (0, 4):
        values = np.array(sorted(set(crowded(rng, 150))), np.uint64)
        if depth:
            a, b = (values[values >> np.uint64(60) == np.uint64(v)] for v in (0, 8))
        else:
            a = b = values
        if not len(a) or not len(b):
            continue
        got = {(int(a[i]), int(b[j])) for x, y in simhash.walk(a, b, not depth, depth, budget, small=2, chunk=50)
               for i, j in zip(x, y)}
        want = {(int(x), int(y)) for x in a for y in b if (int(x) ^ int(y)).bit_count() <= budget and (depth or x < y)}
        assert got == want


@pytest.mark.parametrize("group", [8, 64, 4096])
def test_links_span_every_component(spark, group):
    prints = set(crowded(random.Random(group), 400))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    fps = spark.createDataFrame(signed, "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(fps, 2, group)).collect()}
    want = brute_components(prints)
    got = {}
    for (p,) in signed:
        got.setdefault(roots.get(p, p), set()).add(p % (1 << 64))
    classes = {}
    for p, r in want.items():
        classes.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(5, 5), (300, 301), (301, 300)]
    rng.shuffle(edges)
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(200, 240)}, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_query(docs):
    prints = {i: brute_print(t) for i, t in docs}
    roots = brute_components(prints.values())
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(least.get(roots[p], i), i)
    return sorted((i, f"{p:016x}", least[roots[p]]) for i, p in prints.items())


def test_query_against_brute_force(spark, sf):
    from agentaudit.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op7_simhash"](spark, sf).collect())) == brute_query(docs)


def test_defined_results(spark):
    schema = "doc_id long, text string, fp string, file int, head string"
    rows = [(5, None, "a", 1, ""), (3, "", None, 1, ""), (9, "a b c d", "x", 1, ""), (9, "A  B C\nD", "y", 1, ""),
            (None, "a b c d", "z", 1, ""), (7, "quite another text here", "q", 1, "")]
    docs = spark.createDataFrame(rows, schema)
    _, found = simhash.near_duplicates(docs)
    got = sorted(((r["id"] or -1), r["component_id"]) for r in found.collect())
    assert got == [(-1, 9), (3, 3), (5, 3), (7, 7), (9, 9), (9, 9)]
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 7, 9]
    assert simhash.deduplicate(spark.createDataFrame([], schema)).count() == 0
