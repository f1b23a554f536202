"""Loops of several steps against trying every period at every place."""

import random
from datetime import timedelta

import pytest

from agentaudit.operators import loops

from helpers import T0, record, records


def trace(name, steps, agent="a"):
    return [record(name, f"{i:04d}", timestamp=T0 + timedelta(seconds=i), agent_name=agent, operation_name=s)
            for i, s in enumerate(steps)]


def brute(steps, limit, longest):
    """Unbroken stretches of every period, without those that a smaller period explains."""
    out = []
    for p in range(1, min(longest, len(steps)) + 1):
        i = 0
        while i + p < len(steps):
            if steps[i] != steps[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(steps) and steps[j] == steps[j + p]:
                j += 1
            end = j + p
            root = steps[i:i + p]
            primitive = not any(p % q == 0 and root == root[:q] * (p // q) for q in range(1, p))
            if (end - i) // p >= limit and primitive:
                out.append((p, (end - i) // p, i + 1, end))
            i = j
    return sorted(out)


def looping(rng, n):
    """Random steps with planted loops, partial turns and loops inside loops."""
    out = []
    while len(out) < n:
        block = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        if rng.random() < 0.3:
            block = block * 2 + [rng.choice("abc")]
        turns = rng.choice([1, 2, 3, 4, 7])
        out += (block * turns)[:len(block) * turns - rng.randrange(len(block))]
    return out[:n]


@pytest.mark.parametrize(("limit", "longest"), [(3, 32), (5, 32), (3, 5)])
def test_against_brute_force(spark, limit, longest):
    rng = random.Random(limit * 100 + longest)
    traces = {f"t{i}": looping(rng, rng.randrange(1, 70)) for i in range(60)}
    traces |= {"same": ["a"] * 50, "none": list("abcdefgh"), "one": ["a"]}
    rows = [r for name, steps in traces.items() for r in trace(name, steps)]
    got = {}
    for r in loops.block_loops(records(spark, *rows), limit, longest).collect():
        got.setdefault(r.trace_id, []).append((r.period, r.turns, r.first_seq, r.last_seq))
        steps = traces[r.trace_id]
        assert r.block == [f"a {s}" for s in steps[r.first_seq - 1:r.first_seq - 1 + r.period]]
        assert r.started_at == T0 + timedelta(seconds=r.first_seq - 1)
    want = {name: brute(steps, limit, longest) for name, steps in traces.items()}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    smallest = {r.trace_id: (r.period, r.turns, r.first_seq) for r in
                loops.smallest_loops(records(spark, *rows), limit, longest).collect()}
    assert smallest == {k: min((p, -t, a) for p, t, a, _ in v)[:1] + max((t, -a) for p, t, a, _ in v if p == min(
        x[0] for x in v))[:1] + (min(a for p, t, a, _ in v if (p, -t) == min((x[0], -x[1]) for x in v)),)
        for k, v in want.items() if v}


def test_a_hot_trace_is_the_same(spark):
    rows = trace("hot", list("abcab" * 30 + "xy" * 9)) + trace("cold", list("xyxyxyxy"))
    df = records(spark, *rows)
    plain = sorted(map(repr, loops.block_loops(df, 3).collect()))
    assert plain == sorted(map(repr, loops.block_loops(df, 3, hot=["hot"]).collect()))
    assert len(plain) >= 3


def test_agents_and_actions_tell_steps_apart(spark):
    rows = [record("t", f"{i:02d}", timestamp=T0 + timedelta(seconds=i), agent_name="ab"[i % 2], operation_name="op",
                   reasoning=f'{{"selected_action":"x{i % 4}"}}') for i in range(12)]
    found = loops.block_loops(records(spark, *rows), 3).collect()
    assert [(r.period, r.turns, r.block) for r in found] == [(4, 3, ["a op x0", "b op x1", "a op x2", "b op x3"])]


def test_edges(spark):
    empty = records(spark, record()).where("false")
    assert loops.block_loops(empty, 3).count() == 0
    with pytest.raises(ValueError):
        loops.block_loops(empty, 2)
