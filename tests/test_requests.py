"""Requests over several traces against plain walks."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from agentaudit.operators import requests, tree

from helpers import T0, record, records


def hexed(n, width):
    return f"{n:0{width}x}"


def header(trace, span):
    return f"00-{hexed(trace, 32)}-{hexed(span, 16)}-01"


def with_headers(spark, rows):
    """Records from (trace, span, parent or None, header or None), all numbers."""
    made = [record(hexed(t, 32), hexed(s, 16), parent_span_id=None if p is None else hexed(p, 16),
                   timestamp=T0 + timedelta(seconds=s), duration_ms=s % 7 + 1, agent_id=f"a{t % 3}") for t, s, p, _ in rows]
    df = records(spark, *made)
    heads = spark.createDataFrame([(hexed(t, 32), hexed(s, 16), h) for t, s, _, h in rows],
                                  "trace_id string, span_id string, traceparent string")
    return df.join(heads, ["trace_id", "span_id"])


def brute(rows):
    """Per span: request, depth, root; spans in a circle of their own trace are missing."""
    nodes = {(t, s) for t, s, _, _ in rows}
    local = {(t, s): (t, p) if (t, p) in nodes else None for t, s, p, _ in rows}
    remote = {}
    for t, s, _, h in rows:
        parts = (h or "").split("-")
        if local[t, s] is None and len(parts) == 4:
            caller = int(parts[1], 16), int(parts[2], 16)
            if caller in nodes:
                remote[t, s] = caller
    up = {n: local[n] or remote.get(n) for n in nodes}

    def on_circle(n):
        at, seen = up[n], set()
        while at is not None and at not in seen:
            if at == n:
                return True
            seen.add(at)
            at = up[at]
        return False

    cut = {n: None if n in remote and on_circle(n) else up[n] for n in nodes}
    group = {t: t for t, *_ in rows}

    def find(t):
        while group[t] != t:
            t = group[t]
        return t

    for (t, _), (c, _) in remote.items():
        a, b = sorted((find(t), find(c)))
        group[b] = a
    out = {}
    for n in nodes:
        at, depth, seen = n, 0, set()
        while cut[at] is not None and at not in seen:
            seen.add(at)
            at, depth = cut[at], depth + 1
        if cut[at] is None:
            out[n] = find(n[0]), depth, at
    return out


def any_rows(rng, traces):
    rows = []
    for t in range(traces):
        size = rng.randrange(1, 8)
        for s in range(size):
            parent = None if s == 0 or rng.random() < 0.1 else rng.randrange(s) if rng.random() < 0.95 else rng.randrange(size)
            head = None
            if rng.random() < (0.7 if parent is None else 0.1):
                head = rng.choice(["broken", header(rng.randrange(traces + 2), rng.randrange(6)),
                                   header(rng.randrange(traces), 0), header(max(0, t - 1), 0)])
            rows.append((t, s, parent, head))
    return rows


def test_against_plain_walks(spark):
    for seed in range(4):
        rows = any_rows(random.Random(seed), 40)
        df = with_headers(spark, rows)
        got = {(int(r.trace_id, 16), int(r.span_id, 16)): (
            int(r.request_id, 16), r.depth, (int(r.root_trace_id, 16), int(r.root_span_id, 16)))
            for r in requests.request_tree(df).collect()}
        assert got == brute(rows)


def test_circles_of_traces_stand_apart(spark):
    rows = [(1, 0, None, header(2, 1)), (1, 1, 0, None), (2, 0, None, header(3, 0)), (2, 1, 0, None), (3, 0, None, header(1, 1)),
            (4, 0, None, header(1, 0)), (5, 0, None, header(5, 0)), (6, 0, None, header(4, 0))]
    found = {(int(r.trace_id, 16), int(r.span_id, 16)): (int(r.request_id, 16), r.depth)
             for r in requests.request_tree(with_headers(spark, rows)).collect()}
    assert found == {(1, 0): (1, 0), (1, 1): (1, 1), (2, 0): (1, 0), (2, 1): (1, 1), (3, 0): (1, 0), (4, 0): (1, 1),
                     (5, 0): (5, 0), (6, 0): (1, 2)}


def test_a_long_way_over_traces(spark):
    rows = [(t, s, 0 if s else None, header(t - 1, 1) if t and not s else None) for t in range(70) for s in (0, 1)]
    df = with_headers(spark, rows)
    deepest = requests.request_tree(df).orderBy(F.desc("depth")).first()
    assert (deepest.depth, int(deepest.request_id, 16), int(deepest.root_trace_id, 16)) == (139, 0, 0)
    assert [tuple(r)[1:] for r in requests.request_sizes(df).collect()] == [(70, 140, 69)]
    path = requests.request_paths(df).orderBy("position").collect()
    assert [(int(r.trace_id, 16), int(r.span_id, 16)) for r in path] == [(t, s) for t in range(70) for s in (0, 1)]


def test_without_links_requests_are_traces(spark, sf):
    from agentaudit.plans import fixtures

    plain = fixtures.records(spark, sf).withColumn("traceparent", F.lit(None).cast("string"))
    got = requests.request_tree(plain).select("trace_id", "span_id", "depth", "root_span_id")
    want = tree.span_tree(plain).select("trace_id", "span_id", "depth", "root_span_id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert requests.request_tree(plain.where("false")).count() == 0


def test_connected(spark):
    rng = random.Random(1)
    edges = [(f"{rng.randrange(80):02d}", f"{rng.randrange(80):02d}") for _ in range(60)] + [
        (f"x{i:03d}", f"x{i + 1:03d}") for i in range(100)]
    group = {n: n for e in edges for n in e}

    def find(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        group[b] = a
    got = {r.node: r.root for r in requests.connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {n: find(n) for n in group if find(n) != n}
