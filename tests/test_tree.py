"""Trees and critical paths against brute force over random forests."""

import json
import random

import pytest

from agentaudit.operators import skew, tree

from helpers import at, record, records


def random_trace(rnd, trace):
    n = rnd.randrange(1, 10)
    ids = [f"{i:02d}" for i in range(n)]
    rows = []
    for i, span in enumerate(ids):
        kind = rnd.random()
        if kind < 0.2:
            parent = None
        elif kind < 0.3:
            parent = "missing"
        else:
            parent = rnd.choice(ids)  # may be itself or close a cycle
        rows.append({"span": span, "parent": parent, "ms": rnd.choice([0, 0, 1, 1, 2, 3]),
                     "ts": rnd.randrange(5), "agent": f"a{rnd.randrange(4)}", "trace": trace})
    return rows


def chains(rows):
    """All chains that start at a span without parent, as tuples of positions."""
    ordered = sorted(rows, key=lambda r: (r["ts"], r["span"]))
    found = [(i,) for i, r in enumerate(ordered) if r["parent"] is None]
    for chain in found:
        last = ordered[chain[-1]]["span"]
        found.extend(chain + (i,) for i, r in enumerate(ordered) if r["parent"] == last)
    return ordered, found


def best_path(rows):
    ordered, found = chains(rows)
    if not found:
        return [ordered[0]["agent"]]
    total = lambda c: sum(ordered[i]["ms"] for i in c)
    winner = min(found, key=lambda c: (-total(c), c))
    return [ordered[i]["agent"] for i in winner] if total(winner) > 0 else []


def forest(rows):
    """Brute-force tree rows: span -> (parent, depth, root, place, children)."""
    known = {r["span"] for r in rows}
    parent = {r["span"]: r["parent"] if r["parent"] in known else None for r in rows}
    order = [r["span"] for r in sorted(rows, key=lambda r: (r["ts"], r["span"]))]
    out = {}
    for span in order:
        up, seen = [span], set()
        while parent[up[-1]] is not None and up[-1] not in seen:
            seen.add(up[-1])
            up.append(parent[up[-1]])
        if parent[up[-1]] is None:
            siblings = [s for s in order if parent[s] == parent[span]]
            out[span] = (parent[span], len(up) - 1, up[-1], siblings.index(span) + 1,
                         sum(parent[s] == span for s in order))
    return out


def as_records(spark, traces):
    return records(spark, *[
        record(r["trace"], r["span"], parent_span_id=r["parent"], duration_ms=r["ms"],
               timestamp=at(r["ts"]), agent_id=r["agent"])
        for rows in traces for r in rows])


@pytest.mark.parametrize("small, hot_rows", [(tree.SMALL_TRACE, 10 ** 6), (0, 10 ** 6), (4, 8), (0, 40)])
def test_critical_paths_match_brute_force(spark, monkeypatch, small, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    rnd = random.Random(11)
    traces = [random_trace(rnd, f"t{i:04d}") for i in range(400)]
    df = as_records(spark, traces)
    steps = tree.critical_path_steps(df, small).collect()
    got = {rows[0]["trace"]: [] for rows in traces}
    for r in sorted(steps, key=lambda r: r.position):
        got[r.trace_id].append(r.agent_name)
    want = {rows[0]["trace"]: best_path(rows) for rows in traces}
    assert got == want
    lengths = {r.trace_id: r.path_length for r in tree.critical_paths(df, small).collect()}
    assert lengths == {k: len(v) for k, v in want.items() if v}


def test_span_trees_match_brute_force(spark):
    rnd = random.Random(5)
    traces = [random_trace(rnd, f"t{i:04d}") for i in range(200)]
    df = as_records(spark, traces)
    for small, hot in ((tree.SMALL_TRACE, []), (0, []), (0, ["t0000", "t0001", "t0002"]), (5, [])):
        got = {}
        for r in tree.span_tree(df, small, hot).collect():
            got.setdefault(r.trace_id, {})[r.span_id] = (
                r.parent_span_id, r.depth, r.root_span_id, r.sibling_no, r.child_count)
        want = {rows[0]["trace"]: forest(rows) for rows in traces}
        assert got == {k: v for k, v in want.items() if v}


def test_deep_chain(spark):
    n = 300
    rows = [record(span=f"{i:04d}", parent_span_id=f"{i - 1:04d}" if i else None, duration_ms=1, timestamp=at(i))
            for i in range(n)]
    for small in (tree.SMALL_TRACE, 0):
        steps = tree.critical_path_steps(records(spark, *rows), small)
        assert sorted(r.position for r in steps.collect()) == list(range(n))


def test_wide_parent_of_equal_children(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    rows = [record(span="root", duration_ms=1)] + [
        record(span=f"{i:04d}", parent_span_id="root", duration_ms=5, timestamp=at(1 + i // 10)) for i in range(500)]
    for small in (tree.SMALL_TRACE, 0):
        steps = tree.critical_path_steps(records(spark, *rows), small).orderBy("position").collect()
        assert [r.span_id for r in steps] == ["root", "0000"]


def test_copies_of_a_span_count_once(spark):
    rows = [record(span="r", duration_ms=3), record(span="r", duration_ms=4), record(span="c", parent_span_id="r", duration_ms=1, timestamp=at(1))]
    for small in (tree.SMALL_TRACE, 0):
        steps = tree.critical_path_steps(records(spark, *rows), small).orderBy("position").collect()
        assert [(r.span_id, r.duration_ms) for r in steps] == [("r", 4), ("c", 1)]
        placed = tree.span_tree(records(spark, *rows), small).orderBy("span_id").collect()
        assert [(r.span_id, r.copies, r.child_count) for r in placed] == [("c", 1, 0), ("r", 2, 1)]


def nested(rows):
    """The forest as nested lists, children in time order."""
    tree_of = forest(rows)
    agents = {r["span"]: (r["agent"], r["ms"]) for r in rows}
    order = [r["span"] for r in sorted(rows, key=lambda r: (r["ts"], r["span"])) if r["span"] in tree_of]
    build = lambda parent: [
        {"span_id": s, "agent_name": agents[s][0], "duration_ms": agents[s][1], "children": build(s)}
        for s in order if tree_of[s][0] == parent]
    return build(None)


def test_nested_json_matches_brute_force(spark):
    rnd = random.Random(23)
    traces = [random_trace(rnd, f"t{i:04d}") for i in range(150)]
    df = as_records(spark, traces)
    got = {r.trace_id: json.loads(r.forest) for r in tree.forest_json(df).collect()}
    assert got == {rows[0]["trace"]: nested(rows) for rows in traces}
    # Large traces are put together another way, to the same text.
    assert {r.trace_id: r.forest for r in tree.forest_json(df, small=5).collect()} == {
        r.trace_id: r.forest for r in tree.forest_json(df).collect()}


def test_pieces_make_up_the_forest(spark):
    """Wide, deep and broken traces: pieces in order, joined, are the nested text."""
    rng = random.Random(5)
    rows = []
    for t in range(12):
        n = rng.randrange(1, 60)
        for i in range(n):
            parent = None if rng.random() < 0.1 else f"s{rng.randrange(n)}" if rng.random() < 0.1 else f"s{rng.randrange(i)}" if i else "gone"
            rows.append(record(f"t{t}", f"s{i}", parent_span_id=parent, timestamp=at(rng.randrange(20)), duration_ms=i))
    rows += [record("wide", f"s{i}", parent_span_id="s0" if i else None, timestamp=at(i)) for i in range(200)]
    rows += [record("deep", f"s{i}", parent_span_id=f"s{i - 1}" if i else None, timestamp=at(i)) for i in range(200)]
    df = records(spark, *rows)
    joined = {}
    for r in sorted(tree.forest_pieces(df).collect(), key=lambda r: (r.trace_id, r.position)):
        joined.setdefault(r.trace_id, []).append(r.piece)
        assert r.position == len(joined[r.trace_id]) - 1
    whole = {r.trace_id: r.forest for r in tree.forest_json(df, small=10_000).collect()}
    assert {t: "[" + "".join(p) + "]" for t, p in joined.items()} == {t: f for t, f in whole.items() if f != "[]"}
    assert {r.trace_id: r.forest for r in tree.forest_json(df, small=3).collect()} == whole
