"""Hand-off chains and circles against plain walks."""

import random
from datetime import timedelta

from agentaudit.operators import handoffs

from helpers import T0, record, records


def forest(rng, trace, n, agents):
    """Records with parents before or after them, orphans, and a few cycles."""
    rows = []
    for i in range(n):
        kind = rng.random()
        parent = None if i == 0 or kind < 0.1 else "gone" if kind < 0.15 else f"s{rng.randrange(i)}"
        if kind > 0.97:
            parent = f"s{rng.randrange(n)}"
        target = rng.choice("abcdef") if rng.random() < 0.2 else None
        rows.append(record(
            trace, f"s{i}", parent_span_id=parent, agent_id=rng.choice(agents),
            timestamp=T0 + timedelta(seconds=rng.randrange(40)),
            inter_agent=f'{{"target_agent":"{target}"}}' if target else None))
    return rows


def field(row, name):
    from agentaudit.schema import RECORD

    return row[RECORD.fieldNames().index(name)]


def brute_chains(rows):
    """Per agent: (agent, span) pairs from its first hand-off back to the origin."""
    nodes = {field(r, "span_id"): r for r in rows}
    by = lambda s: field(nodes[s], "agent_id")
    up = {s: p if (p := field(r, "parent_span_id")) in nodes else None for s, r in nodes.items()}

    def rooted(s):
        seen = set()
        while s is not None and s not in seen:
            seen.add(s)
            s = up[s]
        return s is None

    taken = [s for s in nodes if rooted(s) and (up[s] is None or by(up[s]) != by(s))]
    out = {}
    for agent in {by(s) for s in taken}:
        s = min((s for s in taken if by(s) == agent), key=lambda s: (field(nodes[s], "timestamp"), s))
        chain = []
        while s is not None:
            if up[s] is None or by(up[s]) != by(s):
                chain.append((by(s), s))
            s = up[s]
        out[agent] = chain
    return out


def brute_cycles(rows):
    nodes = {field(r, "span_id"): field(r, "agent_id") for r in rows}
    edges = {(nodes[p], field(r, "agent_id")) for r in rows if (p := field(r, "parent_span_id")) in nodes}
    for r in rows:
        if field(r, "inter_agent"):
            edges.add((field(r, "agent_id"), field(r, "inter_agent").split('"')[3]))
    names = {n for e in edges for n in e}
    reach = {n: set() for n in names}
    for n in names:
        todo = [n]
        while todo:
            a = todo.pop()
            for x, y in edges:
                if x == a and y not in reach[n]:
                    reach[n].add(y)
                    todo.append(y)
    out = {}
    for n in names:
        circle = {m for m in names if m != n and m in reach[n] and n in reach[m]} | {n}
        if len(circle) > 1:
            out[n] = (min(circle), len(circle))
    return out


def test_against_plain_walks(spark):
    rng = random.Random(6)
    traces = {f"t{i}": forest(rng, f"t{i}", rng.randrange(1, 40), "abcdef"[:rng.randrange(1, 7)]) for i in range(40)}
    df = records(spark, *[r for rows in traces.values() for r in rows])
    got = {}
    for r in handoffs.chains(df).collect():
        got.setdefault(r.trace_id, {}).setdefault(r.agent, []).append((r.hop, r.by, r.span_id))
    want = {t: c for t, rows in traces.items() if (c := brute_chains(rows))}
    assert {t: {a: [h[1:] for h in sorted(hops)] for a, hops in agents.items()} for t, agents in got.items()} == want
    assert all([h[0] for h in sorted(hops)] == list(range(len(hops))) for a in got.values() for hops in a.values())
    circles = {}
    for r in handoffs.cycles(df).collect():
        circles.setdefault(r.trace_id, {})[r.agent] = (r.cycle, r.agents)
    assert circles == {t: c for t, rows in traces.items() if (c := brute_cycles(rows))}
    texts = {(r.trace_id, r.agent): (r.hops, r.chain) for r in handoffs.chain_texts(df).collect()}
    assert texts == {(t, a): (len(c) - 1, " -> ".join(x for x, _ in reversed(c))) for t, agents in want.items()
                     for a, c in agents.items()}


def test_a_long_chain(spark):
    rows = [record("t", f"{i:04d}", parent_span_id=f"{i - 1:04d}" if i else None, agent_id=f"a{i // 2:03d}",
                   timestamp=T0 + timedelta(seconds=i)) for i in range(300)]
    found = handoffs.chain_texts(records(spark, *rows)).where("agent = 'a149'").first()
    assert found.hops == 149 and found.chain == " -> ".join(f"a{i:03d}" for i in range(150))
    assert handoffs.cycles(records(spark, *rows)).count() == 0


def test_two_circles_joined_by_a_way(spark):
    edges = ["ab", "ba", "bc", "cd", "dc", "de", "xy", "yz", "zx", "ef"]
    df = spark.createDataFrame([("t", *e) for e in edges] + [("u", "a", "b")], "trace_id string, src string, dst string")
    found = {(r.trace_id, r.agent): r.cycle for r in handoffs.components(df).collect()}
    assert found == {("t", a): c for a, c in zip("abcdxyz", "aaccxxx")}


def test_nothing(spark):
    empty = records(spark, record()).where("false")
    assert handoffs.chains(empty).count() == 0 and handoffs.cycles(empty).count() == 0
    one = records(spark, record("t", "1", agent_id="a"))
    assert [(r.agent, r.hop, r.by) for r in handoffs.chains(one).collect()] == [("a", 0, "a")]


def test_small_and_large_traces_have_the_same_components(spark):
    rng = random.Random(7)
    edges = {(f"t{t}", f"a{rng.randrange(n)}", f"a{rng.randrange(n)}") for t, n in enumerate([2, 3, 5, 8, 12] * 6)
             for _ in range(rng.randrange(1, 2 * n))}
    # A circle of as many agents as a small trace can hold, and edges of no trace.
    edges = {e for e in edges if e[1] != e[2]} | {(None, "a", "b"), (None, "b", "a")}
    ring = [("ring", f"a{i:02d}", f"a{(i + 1) % 62:02d}") for i in range(62)]
    frame = lambda rows: spark.createDataFrame(rows, "trace_id string, src string, dst string")
    rows = lambda found: sorted(map(tuple, found.collect()))
    assert rows(handoffs.components(frame(sorted(edges, key=str)))) == rows(handoffs.components(frame(sorted(edges, key=str)), small=6))
    assert rows(handoffs.components(frame(ring))) == [("ring", f"a{i:02d}", "a00") for i in range(62)]


def test_small_traces_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(handoffs, "_large_components", None)
    df = spark.createDataFrame([("t", "a", "b"), ("t", "b", "a"), ("t", "b", "c")], "trace_id string, src string, dst string")
    assert sorted(map(tuple, handoffs.components(df).collect())) == [("t", "a", "a"), ("t", "b", "a")]
