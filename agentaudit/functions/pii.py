"""Personal-data patterns as column expressions.

Everything here is a pure expression over a text column, so scans and redaction
run inside the scan stage. Patterns run one after another on the text as the
pattern before left it; the order of the patterns is therefore part of the
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import let

# The built-in patterns, in the order in which they run.
PATTERNS: dict[str, str] = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"(?:\+?\d{1,3}[-.\s]?)?\(?\d{2,4}\)?[-.\s]?\d{3,4}[-.\s]?\d{3,4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b(?:\d{4}[-\s]?){3}\d{4}\b",
    "ip_address": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "aadhaar": r"\b\d{4}\s?\d{4}\s?\d{4}\b",
    "pan_india": r"\b[A-Z]{5}\d{4}[A-Z]\b",
}

#: What a text must contain for any built-in pattern to match, and for one of
#: them: cheap tests that spare most texts the costly patterns.
_ANY_NEEDS = r"[@\p{Nd}]"
_NEEDS = {name: "@" if name == "email" else r"\p{Nd}" for name in PATTERNS}

DETECTION = "struct<type:string,start:int,end:int,length:int>"
DETECTIONS = f"array<{DETECTION}>"
RESULT = (
    f"struct<original_length:int,redacted_length:int,detections:{DETECTIONS},"
    "pii_detected:boolean,pii_types_found:array<string>>"
)


def _mask(match: Column, kind: str) -> Column:
    if kind == "email":
        return F.regexp_replace(match, "[^@]", "*")
    stars = F.repeat(F.lit("*"), F.least(F.length(match), F.lit(12)))
    return F.concat(stars, F.lit(f"[{kind}]"))


def _hash(match: Column, kind: str) -> Column:
    digest = F.substring(F.sha2(match, 256), 1, 12)
    return F.concat(F.lit(f"[{kind}:sha256:"), digest, F.lit("]"))


def _remove(match: Column, kind: str) -> Column:
    return F.lit(f"[{kind}:REDACTED]")


# The forms of the replacements.
#: How a match is replaced: name -> (match, type) -> replacement. ``add_strategy`` adds more.
STRATEGIES: dict[str, Callable[[Column, str], Column]] = {
    "mask": _mask,
    "hash": _hash,
    "remove": _remove,
}


def add_strategy(name: str, column: Callable[[Column, str], Column],
                 plain: Callable[[str, str], str] | None = None) -> None:
    """A replacement of one's own, as an expression and as a plain function.

    The plain form serves free-form payloads and patterns that can match nothing; using
    the strategy there without it is an error.
    """
    STRATEGIES[name] = column
    if plain is None:
        _PYTHON.pop(name, None)
    else:
        _PYTHON[name] = plain


@dataclass(frozen=True)
class Redactor:
    """Which patterns to look for and how to replace what they find.

    ``patterns`` names built-in patterns (none given: all; unknown names are
    ignored). ``custom`` adds patterns of one's own, which run last or replace a
    built-in of the same name. Texts in ``allowlist`` are left alone. An unknown
    strategy means ``hash``.
    """

    patterns: tuple[str, ...] = ()
    strategy: str = "hash"
    custom: Mapping[str, str] = field(default_factory=dict)
    allowlist: frozenset[str] = frozenset()

    @property
    def active(self) -> dict[str, str]:
        names = [n for n in self.patterns if n in PATTERNS] if self.patterns else list(PATTERNS)
        return {**{n: PATTERNS[n] for n in names}, **self.custom}

    @property
    def expressible(self) -> bool:
        """Whether all patterns can run as expressions (none matches nothing)."""
        return not any(re.compile(p).search("") for p in self.active.values())

    def _replacement(self, match: Column, kind: str) -> Column:
        new = STRATEGIES.get(self.strategy, _hash)(match, kind)
        if self.allowlist:
            return F.when(match.isin(*sorted(self.allowlist)), match).otherwise(new)
        return new

    def _worth_trying(self, text: Column, kind: str) -> Column:
        needs = _NEEDS.get(kind) if kind not in self.custom else None
        if needs is None:
            return F.lit(True)
        return text.contains("@") if needs == "@" else text.rlike(needs)

    def _worth_it(self, text: Column) -> Column:
        return F.lit(True) if self.custom else text.rlike(_ANY_NEEDS)

    def _redact_kind(self, kind: str, pattern: str, text: Column) -> Column:
        if not self.allowlist and self.strategy == "remove":
            done = F.regexp_replace(text, _java(pattern), F.lit(f"[{kind}:REDACTED]"))
        else:
            gaps, found = _pieces(text, pattern)
            new = F.transform(found, lambda m: self._replacement(m, kind))
            done = F.array_join(
                F.zip_with(gaps, new, lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), ""
            )
        return F.when(self._worth_trying(text, kind), done).otherwise(text)

    def redact(self, text: Column) -> Column:
        """The text with every match replaced."""
        if not self.expressible:
            return self._redact_udf()(text)
        def run_all(text: Column) -> Column:
            done = text
            for kind, pattern in self.active.items():
                done = let(done, partial(self._redact_kind, kind, pattern))
            return F.when(self._worth_it(text), done).otherwise(text)

        return let(text, run_all)

    def detect(self, text: Column) -> Column:
        """All matches on the original text, pattern by pattern."""
        if not self.expressible:
            return self._detect_udf()(text)
        return let(text, self._detect_all)

    def _detect_all(self, text: Column) -> Column:
        parts = []
        for kind, pattern in self.active.items():
            found = F.when(
                self._worth_trying(text, kind), _detections(text, kind, pattern)
            )
            if self.allowlist:
                allowed = F.array(*[F.lit(a) for a in sorted(self.allowlist)])
                found = F.filter(found, lambda d: ~F.array_contains(
                    allowed, F.substr(text, d["start"] + 1, d["length"])))
            parts.append(F.coalesce(found, F.array().cast(DETECTIONS)))
        none = F.array().cast(DETECTIONS)
        return F.when(self._worth_it(text), F.concat(*parts)).otherwise(none)

    def scan(self, text: Column) -> Column:
        """Struct of lengths before and after, matches, flag and types found."""
        def result(t: Column) -> Column:
            return let(self.detect(t), lambda d: F.struct(
                F.length(t).alias("original_length"),
                F.when(F.size(d) > 0, F.length(self.redact(t)))
                 .otherwise(F.length(t)).alias("redacted_length"),
                d.alias("detections"),
                (F.size(d) > 0).alias("pii_detected"),
                F.array_distinct(F.transform(d, lambda x: x["type"])).alias("pii_types_found"),
            ).cast(RESULT))

        return let(F.coalesce(text, F.lit("")), result)

    def redact_longest(self, text: Column) -> Column:
        """Redact on the original text only: the longest match wins an overlap.

        Matches are taken by length (earlier start, then earlier pattern on
        ties) as long as they do not overlap one already taken. No replacement
        is ever searched again.
        """
        order = {kind: i for i, kind in enumerate(self.active)}

        def build(t: Column, taken: Column) -> Column:
            ordered = F.array_sort(F.transform(taken, lambda d: F.struct(
                d["start"].alias("start"), d["end"].alias("end"), d["type"].alias("type"))))
            zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

            def step(acc: Column, d: Column) -> Column:
                match = F.substr(t, d["start"] + 1, d["end"] - d["start"])
                new = match
                for kind in order:
                    new = F.when(d["type"] == kind, self._replacement(match, kind)).otherwise(new)
                gap = F.substr(t, acc["at"] + 1, d["start"] - acc["at"])
                return F.struct(F.concat(acc["out"], gap, new).alias("out"), d["end"].alias("at"))

            rest = lambda acc: F.concat(acc["out"], F.substr(t, acc["at"] + 1, F.length(t)))
            return F.aggregate(ordered, zero, step, rest)

        def whole(t: Column) -> Column:
            rank = F.create_map(*[F.lit(v) for kv in order.items() for v in kv])
            by_length = F.array_sort(F.transform(self.detect(t), lambda d: F.struct(
                (-d["length"]).alias("neg"), d["start"].alias("start"),
                F.try_element_at(rank, d["type"]).alias("rank"), d["end"].alias("end"),
                d["type"].alias("type"), d["length"].alias("length"))))
            taken = F.aggregate(by_length, F.array().cast(DETECTIONS), _take_if_free)
            return F.when(F.size(taken) > 0, build(t, taken)).otherwise(t)

        return let(text, whole)

    # -- patterns that can match nothing, and free-form payloads ---------------

    def _python(self) -> tuple[dict[str, re.Pattern], Callable[[str, str], str]]:
        if self.strategy in STRATEGIES and self.strategy not in _PYTHON:
            raise ValueError(f"strategy {self.strategy!r} has no plain form; see add_strategy")
        return {k: re.compile(p) for k, p in self.active.items()}, _PYTHON.get(self.strategy, _PYTHON["hash"])

    def redactor(self) -> Callable[[str], str]:
        """The same redaction as a plain function, for use inside tasks."""
        patterns, replace = self._python()
        allow = self.allowlist

        def run(text: str) -> str:
            for kind, pattern in patterns.items():
                text = pattern.sub(
                    lambda m, k=kind: m.group() if m.group() in allow else replace(m.group(), k), text
                )
            return text

        return run

    def _redact_udf(self):
        run = self.redactor()

        @F.pandas_udf("string")
        def redact_text(texts: pd.Series) -> pd.Series:
            return texts.map(run, na_action="ignore")

        return redact_text

    def _detect_udf(self):
        patterns = {k: re.compile(p) for k, p in self.active.items()}
        allow = self.allowlist

        def run(text: str | None) -> list[dict]:
            return [
                {"type": k, "start": m.start(), "end": m.end(), "length": len(m.group())}
                for k, p in patterns.items() for m in p.finditer(text or "")
                if m.group() not in allow
            ]

        @F.pandas_udf(DETECTIONS)
        def detect_text(texts: pd.Series) -> pd.Series:
            return texts.map(run)

        return detect_text


def _sha(match: str, kind: str) -> str:
    return f"[{kind}:sha256:{hashlib.sha256(match.encode()).hexdigest()[:12]}]"


_PYTHON: dict[str, Callable[[str, str], str]] = {
    "hash": _sha,
    "remove": lambda match, kind: f"[{kind}:REDACTED]",
    "mask": lambda match, kind: (
        re.sub("[^@]", "*", match) if kind == "email" else "*" * min(len(match), 12) + f"[{kind}]"
    ),
}


def _java(pattern: str) -> Column:
    """The pattern with Unicode classes, which Python text patterns imply."""
    return F.lit("(?U)" + pattern)


def _pieces(text: Column, pattern: str) -> tuple[Column, Column]:
    """The text between the matches (n + 1 pieces) and the n matches."""
    return (
        F.split(text, "(?U)" + pattern, -1),
        F.regexp_extract_all(text, _java(pattern), F.lit(0)),
    )


def _detections(text: Column, kind: str, pattern: str) -> Column:
    gaps, found = _pieces(text, pattern)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found,
        lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len")),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(DETECTIONS).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + pair["len"]
        hit = F.struct(
            F.lit(kind).alias("type"), start.alias("start"), end.alias("end"),
            pair["len"].alias("length"),
        ).cast(DETECTION)
        return F.struct(end.alias("at"), F.array_append(acc["out"], hit).alias("out"))

    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def _take_if_free(taken: Column, d: Column) -> Column:
    clash = F.exists(taken, lambda t: (t["start"] < d["end"]) & (d["start"] < t["end"]))
    hit = F.struct(*[d[c].alias(c) for c in ("type", "start", "end", "length")]).cast(DETECTION)
    return F.when(clash, taken).otherwise(F.array_append(taken, hit))


# -- nested payloads with a known schema ---------------------------------------


def redact_nested(value: Column, kind: T.DataType, redactor: Redactor,
                  max_depth: int = 10, depth: int = 0) -> Column:
    """Redact all strings of a nested value, walking its schema at plan time.

    Keys and other types stay as they are, and so do strings more than
    ``max_depth`` levels below the root.
    """
    if depth > max_depth:
        return value
    down = lambda v, k: redact_nested(v, k, redactor, max_depth, depth + 1)
    if isinstance(kind, T.StringType):
        return redactor.redact(value)
    if isinstance(kind, T.StructType):
        fields = [down(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: down(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: down(v, kind.valueType))
    return value


def leaves(value: Column, kind: T.DataType, path: Column | None = None) -> Column:
    """All strings of a nested value as array<struct<path, value>>."""
    path = F.lit("") if path is None else path
    none = F.array().cast("array<struct<path:string,value:string>>")

    def under(key: Column) -> Column:
        return F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key))

    if isinstance(kind, T.StringType):
        leaf = F.array(F.struct(path.alias("path"), value.alias("value")))
        return F.when(value.isNotNull(), leaf).otherwise(none)
    if isinstance(kind, T.StructType):
        parts = [leaves(value[f.name], f.dataType, under(F.lit(f.name))) for f in kind.fields]
        return F.concat(*parts) if parts else none
    if isinstance(kind, T.ArrayType):
        nested = F.transform(value, lambda x, i: leaves(
            x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.coalesce(F.flatten(nested), none)
    if isinstance(kind, T.MapType):
        nested = F.transform(F.map_entries(value), lambda e: leaves(
            e["value"], kind.valueType, under(e["key"].cast("string"))))
        return F.coalesce(F.flatten(nested), none)
    return none
