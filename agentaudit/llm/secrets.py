"""Secret scan by one deterministic automaton for all rules.

The rules' regexes are compiled together, by subset construction and minimisation, into
one transition array; every text is scanned once, byte by byte, for all rules at a
time. Only a text in which some rule fires is looked at again, with the small
automata of the rules that fired, to find leftmost, longest, non-overlapping matches: one
pass backwards marks where matches begin, and each is then read once from there. So every
byte is read a fixed number of times, in texts of any kind.

A rule is a head, a body, the least length of the body in characters, and maybe a tail. A
match is the longest head, then the longest body, then the longest tail; a match whose
body is too short is dropped but its head and body stay used. Heads must be such that the
longest one is the right one. A private key goes on to its END line or, without one,
through the words of sixteen or more base64 characters that follow.

Defined results: null and empty texts have no spans; offsets count code points, the end
is exclusive; spans are ordered by start, then by the order of the rules. Further
columns are ignored. No shuffle takes place, so a frequent secret or source is no
matter; memory is one batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import getitem

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import DEAD, Automaton, compile_rules
from .common import slices


@dataclass(frozen=True)
class Rule:
    name: str
    head: str
    body: str  # one character set, or more, repeated by +
    least: int
    fold_head: bool = False
    #: Body characters that make the rule fire; more keeps common texts from a second look.
    fires: int = 1
    #: What belongs to a match after its body.
    tail: str = ""


BASE = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?",
         "[A-Za-z0-9+/_.=-]", 12, fold_head=True),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16, fires=16),
)
MORE = (
    Rule("github", "gh[oprsu]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY", "-", 5,
         tail="([^-]|-{1,4}[^-])*-----END [A-Z ]*PRIVATE KEY-----|([\\x09-\\x0D\\x20]+[A-Za-z0-9+/=]{16,})*"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.", "[A-Za-z0-9_-]", 16),
)
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


class Scanner:
    """Compiled rules; holds numpy arrays only, so that it travels to the tasks as they are."""

    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE):
        self.rules = rules
        # Heads alone may fold, so head and body are parsed apart and joined by their sets.
        self.combined = compile_rules([(_joined(r), False) for r in rules], anywhere=True)
        self.heads = [compile_rules([(r.head, r.fold_head)]) for r in rules]
        self.bodies = [compile_rules([(f"{r.body}+", False)]) for r in rules]
        self.tails = [compile_rules([(r.tail, False)]) if r.tail else None for r in rules]
        self.starts = [compile_rules([(_joined(r, 1), False)], anywhere=True, backwards=True) for r in rules]
        self._start = None

    def __getstate__(self):
        return self.__dict__ | {"_start": None}

    def _rows(self):
        """The combined table as lists of lists, where a byte leads from row to row.

        An accepting state leads to the sink, a row that leads to itself.
        """
        if self._start is None:
            table, accepts = self.combined.table, self.combined.accepts
            self._sink: list = []
            self._sink += [self._sink] * 256
            rows: list[list] = [self._sink if a else [] for a in accepts]
            for row, targets, a in zip(rows, table.tolist(), accepts):
                if not a:
                    row.extend(rows[t] for t in targets)
            self._start = rows[self.combined.start]
        return self._start, self._sink

    def fired(self, data: bytes) -> int:
        """A bit for every rule that may match in ``data``."""
        start, sink = self._rows()
        if reduce(getitem, data, start) is not sink:
            return 0
        table, accepts, state, found = self.combined.table, self.combined.accepts.tolist(), self.combined.start, 0
        steps = table.tolist()
        for byte in data:
            state = steps[state][byte]
            found |= accepts[state]
        return found

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        data = (text or "").encode("utf-8", "surrogatepass")
        rules = self.fired(data)
        if not rules:
            return []
        found = []
        for k, rule in enumerate(self.rules):
            if rules >> k & 1:
                automata = self.starts[k], self.heads[k], self.bodies[k], self.tails[k]
                found += [(a, k, b) for a, b in _matches(data, *automata, rule.least)]
        if not data.isascii():
            chars = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
            found = [(int(chars[a]), k, int(chars[b])) for a, k, b in found]
        return [(self.rules[k].name, a, b) for a, k, b in sorted(found)]


def _joined(rule: Rule, body: int | None = None) -> str:
    """Head and ``body`` body characters (those that fire), in one pattern."""
    head = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() and rule.fold_head and plain else c
                   for c, plain in _plain(rule.head))
    return head + rule.body + f"{{{rule.fires if body is None else body}}}"


def _plain(pattern: str) -> Iterator[tuple[str, bool]]:
    """Each character, and whether it is a literal outside sets and escapes."""
    inside, skip = False, 0
    for i, c in enumerate(pattern):
        if c == "[":
            inside = True
        yield c, not inside and not skip
        if c == "]":
            inside = False
        if skip:
            skip -= 1
        elif c == "\\":
            skip = 3 if pattern[i + 1] == "x" else 1


def _longest(data: bytes, at: int, automaton: Automaton, steps: list, accepts: list) -> int:
    """End of the longest match that begins at ``at``, or -1."""
    state, end = automaton.start, at if accepts[automaton.start] else -1
    for i in range(at, len(data)):
        state = steps[state][data[i]]
        if state == DEAD:
            break
        if accepts[state]:
            end = i + 1
    return end


def _begins(data: bytes, automaton: Automaton) -> list[int]:
    """Where a head and a body character begin, in order; one pass from the end."""
    steps, accepts, state, found = automaton.table.tolist(), automaton.accepts.tolist(), automaton.start, []
    for i in range(len(data) - 1, -1, -1):
        state = steps[state][data[i]]
        if accepts[state]:
            found.append(i)
    return found[::-1]


def _matches(data: bytes, starts: Automaton, head: Automaton, body: Automaton, tail: Automaton | None,
             least: int) -> Iterator[tuple[int, int]]:
    parts = [(x, x.table.tolist(), x.accepts.tolist()) if x else None for x in (head, body, tail)]
    used = 0
    for at in _begins(data, starts):
        if at < used:
            continue
        middle = _longest(data, at, *parts[0])
        used = _longest(data, middle, *parts[1])
        if used - middle >= least:
            if parts[2]:
                used = max(used, _longest(data, used, *parts[2]))
            yield at, used


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """One row per document: id and its spans (kind, start, end)."""
    scanner = Scanner(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t.as_py())]
                     for t in batch.column("text")]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, kind)], names=["id", "spans"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(scan, T.StructType([rows.schema["id"], T.StructField("spans", SPANS)]))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
