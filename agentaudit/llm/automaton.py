"""Byte automata: regexes to a minimal deterministic automaton in transition arrays.

Supported: literals, escapes, ``.``-free character sets, groups, ``|``, ``?``, ``*``,
``+``, ``{m}``, ``{m,}``, ``{m,n}``; ``fold`` takes letters in either case.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEAD = 0


def _fold(chars: set[int], fold: bool) -> frozenset[int]:
    if fold:
        chars = chars | {c ^ 32 for c in chars if chr(c).isalpha() and c < 128}
    return frozenset(chars)


class _Parser:
    """Recursive descent: alternatives of sequences of repeated atoms."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, node):
        while self.peek() and self.peek() in "?*+{":
            mark = self.take()
            if mark == "{":
                inside = self.text[self.at:self.text.index("}", self.at)]
                self.at += len(inside) + 1
                low, comma, high = inside.partition(",")
                bounds = (int(low), int(high) if high else None if comma else int(low))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
            node = ("rep", node, *bounds)
        return node

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alternatives()
            self.take()
            return node
        if c == "[":
            return ("set", self.chars())
        return ("set", _fold({self.escaped() if c == "\\" else ord(c)}, self.fold))

    def chars(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escaped() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
            found |= set(range(low, high + 1))
        self.take()
        return frozenset(range(256)) - _fold(found, self.fold) if negated else _fold(found, self.fold)


def _reversed(node):
    """The pattern of all matches read backwards."""
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    inner = [_reversed(n) for n in node[1]]
    return (kind, inner[::-1] if kind == "cat" else inner)


@dataclass
class _Nfa:
    empty: list[list[int]] = field(default_factory=list)
    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Append ``node`` behind ``start``; returns its last state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "alt":
            for option in node[1]:
                self.empty[self.add(option, start)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start)
        if high is None:
            loop = self.state()
            self.empty[start] += [loop]
            self.empty[self.add(inner, loop)].append(loop)
            self.empty[loop].append(end)
        else:
            self.empty[start].append(end)
            for _ in range(high - low):
                start = self.add(inner, start)
                self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Automaton:
    """``table[state, byte]`` is the next state, ``accepts[state]`` a bit per rule.

    State 0 is dead: nothing can match any more.
    """

    table: np.ndarray
    accepts: np.ndarray
    start: int


def compile_rules(patterns: list[tuple[str, bool]], anywhere: bool = False, backwards: bool = False) -> Automaton:
    """One minimal automaton for all (pattern, fold) rules.

    ``anywhere`` lets a match begin at every byte; otherwise it begins at the first.
    ``backwards`` reads matches from their last byte to their first.
    """
    nfa = _Nfa()
    root = nfa.state()
    parsed = [_Parser(p, fold).alternatives() for p, fold in patterns]
    ends = [nfa.add(_reversed(node) if backwards else node, root) for node in parsed]
    begin = nfa.closure([root])

    # Bytes that no rule tells apart share a column.
    sets = {chars for moves in nfa.moves for chars, _ in moves}
    marks = {b: frozenset(s for s in sets if b in s) for b in range(256)}
    kinds = {m: i for i, m in enumerate(dict.fromkeys(marks.values()))}
    column = np.array([kinds[marks[b]] for b in range(256)])
    sample = [int(np.flatnonzero(column == k)[0]) for k in range(len(kinds))]

    # Subset construction.
    index: dict[frozenset[int], int] = {frozenset(): DEAD}
    first = index.setdefault(begin, len(index))
    rows, todo = {DEAD: [DEAD] * len(kinds)}, [begin]
    if anywhere:
        rows, todo = {}, [frozenset(), begin]
    while todo:
        states = todo.pop()
        row = []
        for b in sample:
            step = {t for s in states for chars, t in nfa.moves[s] if b in chars}
            target = nfa.closure(step) | (begin if anywhere else frozenset())
            if target not in index:
                index[target] = len(index)
                todo.append(target)
            row.append(index[target])
        rows[index[states]] = row
    steps = np.array([rows[i] for i in range(len(index))])
    accepts = np.zeros(len(index), np.int64)
    for states, i in index.items():
        for rule, end in enumerate(ends):
            accepts[i] |= (end in states) << rule

    # Minimisation: states stay together while no byte leads them apart.
    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([block[:, None], block[steps]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    # The dead state keeps number 0.
    order = np.concatenate(([block[DEAD]], np.setdiff1d(np.arange(block.max() + 1), [block[DEAD]])))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    block = number[block]
    table = np.zeros((len(order), len(kinds)), np.int32)
    table[block] = block[steps]
    merged = np.zeros(len(order), np.int64)
    merged[block] = accepts
    return Automaton(table[:, column], merged, int(block[first]))
