"""Scores of texts under a log-bilinear language model.

Tokens are lower-cased words and one end per text. The frequent words are symbols of
their own; every other word belongs to the symbol of its ending (its last two
characters). The model predicts a symbol from the two symbols before it,

    score(s | c1, c2) = (A1 * r[c1] + A2 * r[c2]) . q[s] + b[s],

and is trained in numpy with noise-contrastive estimation: each task trains on all its
training tokens, and the tasks' parameters are averaged by number of tokens, in a tree.
Scoring normalises over all symbols, by one matrix product per distinct context of a
block; within a symbol, a word has its discounted share of the symbol's occurrences, and
the discounts make up the probability of the one unknown word. So the probabilities of
all known words, the end and the unknown word add up to one.

The word counts come from all training texts. The vocabulary grows with the corpus, so
it is never broadcast: (block, word) rows are summed by word, and each block gets back
the counts of its own words. Only ``HEADS`` words and ``ENDINGS`` endings and the
parameters (under a megabyte) pass through the driver.

Defined results: null and empty texts consist of their end; without training texts the
base is that of an empty model; rows are scored each for itself, repeated ones too;
a null id is held out, like one whose checksum is 0. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import bucketed, encode, unpack
from .common import stored

HEADS = 256
ENDINGS = 254
WIDTH = 32
NOISE = 64
BATCH = 2048
RATE = 0.15


@dataclass(frozen=True)
class Counts:
    """What all training tokens add up to: n, v, and the symbols with their totals."""

    n: int
    v: int
    ends: int
    heads: dict[str, int]  # word -> symbol
    endings: dict[str, int]  # last two characters -> symbol
    total: np.ndarray  # occurrences per symbol
    discount: np.ndarray  # taken from every word of a symbol; 0 for heads
    unknown: np.ndarray  # share of a symbol that unknown words have

    @property
    def symbols(self) -> int:
        return len(self.total)

    def symbol(self, words: list[str]) -> np.ndarray:
        rest = self.symbols - 2
        return np.fromiter(
            (self.heads.get(w) if w in self.heads else self.endings.get(w[-2:], rest) for w in words),
            np.int64, len(words))

    @property
    def end(self) -> int:
        return self.symbols - 1


def gather(located: DataFrame, ends: int, heads: int = HEADS, endings: int = ENDINGS) -> Counts:
    """Totals of the training words; ``located`` has every word once with a non-null ``word``."""
    counts = located.where("word is not null").select("word", "c")
    top = counts.orderBy(F.desc("c"), "word").limit(heads).collect()
    tail = counts.where(~F.col("word").isin([r["word"] for r in top])) if top else counts
    sums = [F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("n1"),
            F.count_if(F.col("c") == 2).alias("n2")]
    by_ending = tail.groupBy(F.expr("right(word, 2)").alias("ending")).agg(*sums)
    common = by_ending.orderBy(F.desc("n"), "ending").limit(endings).collect()
    everything = tail.agg(*sums).first()
    groups = [tuple(r[k] for k in ("n", "v", "n1", "n2")) for r in common]
    groups.append(tuple((everything[k] or 0) - sum(g[i] for g in groups) for i, k in enumerate(("n", "v", "n1", "n2"))))
    total = np.array([*(r["c"] for r in top), *(g[0] for g in groups), ends], float)
    discount, unknown = np.zeros(len(total)), np.zeros(len(total))
    for i, (n, v, n1, n2) in enumerate(groups, len(top)):
        discount[i] = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
        unknown[i] = discount[i] * v / n if n else 1.0
    words = sum(r["c"] for r in top) + (everything["n"] or 0)
    return Counts(
        words + ends, len(top) + everything["v"] + (ends > 0), ends,
        {r["word"]: i for i, r in enumerate(top)}, {r["ending"]: len(top) + i for i, r in enumerate(common)},
        total, discount, unknown)


class Model:
    """Parameters as one flat array: inputs, outputs, biases and the two position weights."""

    def __init__(self, symbols: int, width: int = WIDTH, flat: np.ndarray | None = None):
        self.shapes = [(symbols + 1, width), (symbols, width), (symbols,), (2, width)]
        sizes = [int(np.prod(s)) for s in self.shapes]
        self.flat = np.zeros(sum(sizes), np.float32) if flat is None else flat
        cuts = np.cumsum(sizes)[:-1]
        self.r, self.q, self.b, self.a = (p.reshape(s) for p, s in zip(np.split(self.flat, cuts), self.shapes))

    @classmethod
    def fresh(cls, total: np.ndarray, width: int = WIDTH, seed: int = 7) -> Model:
        model = cls(len(total), width)
        rng = np.random.default_rng(seed)
        model.r[:] = rng.normal(0, 0.3, model.r.shape)
        model.q[:] = rng.normal(0, 0.3, model.q.shape)
        model.b[:] = np.log((total + 0.5) / (total + 0.5).sum())
        model.a[:] = 0.5
        return model

    def train(self, c1: np.ndarray, c2: np.ndarray, target: np.ndarray, total: np.ndarray,
              squares: np.ndarray, rng: np.random.Generator) -> None:
        """Noise-contrastive steps over all positions; ``squares`` is the AdaGrad state."""
        noise_p = (total + 0.5) / (total + 0.5).sum()
        shift = np.log(NOISE * noise_p).astype(np.float32)
        cumulated = np.cumsum(noise_p)
        grads = Model(len(total), self.r.shape[1])
        for at in range(0, len(target), BATCH):
            x1, x2, t = (v[at:at + BATCH] for v in (c1, c2, target))
            noise = np.minimum(np.searchsorted(cumulated, rng.random(NOISE)), len(total) - 1)
            r1, r2 = self.r[x1], self.r[x2]
            context = self.a[0] * r1 + self.a[1] * r2
            qt, qn = self.q[t], self.q[noise]
            real = 1 / (1 + np.exp((context * qt).sum(axis=1) + self.b[t] - shift[t]))  # 1 - P(data)
            false = -1 / (1 + np.exp(-(context @ qn.T + self.b[noise] - shift[noise])))
            back = real[:, None] * qt + false @ qn
            grads.flat[:] = 0
            _add(grads.q, t, real[:, None] * context)
            np.add.at(grads.q, noise, false.T @ context)
            grads.b[:] = np.bincount(t, real, len(total))
            np.add.at(grads.b, noise, false.sum(axis=0))
            _add(grads.r, x1, back * self.a[0])
            _add(grads.r, x2, back * self.a[1])
            grads.a[0], grads.a[1] = (back * r1).sum(axis=0), (back * r2).sum(axis=0)
            grads.flat /= len(t)
            squares += grads.flat ** 2
            self.flat += RATE * grads.flat / np.sqrt(squares + 1e-8)

    def log_probabilities(self, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities of all symbols, a row per context."""
        scores = (self.a[0] * self.r[c1] + self.a[1] * self.r[c2]) @ self.q.T + self.b
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _add(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(ordered)) + 1))
    into[ordered[starts]] += np.add.reduceat(values[order], starts, axis=0)


def positions(symbols: np.ndarray, lens: np.ndarray, end: int) -> tuple[np.ndarray, ...]:
    """Targets (the words of each document, then its end) and their two contexts.

    Before its first word a document has the symbol after ``end``. Also gives the first
    target of each document.
    """
    begin, starts = end + 1, np.concatenate(([0], np.cumsum(lens + 1)))
    target = np.full(int(starts[-1]), end, np.int64)
    inside = np.ones(len(target), bool)
    inside[starts[1:] - 1] = False
    target[inside] = symbols
    c1, c2 = np.full((2, len(target)), begin, np.int64)
    c1[1:], c2[2:] = target[:-1], target[:-2]
    c1[starts[:-1]] = begin
    c2[starts[:-1]] = begin
    second = starts[:-1][lens > 0] + 1
    c2[second] = begin
    return target, c1, c2, starts[:-1]


def fit(blocks: DataFrame, counts: Counts, width: int = WIDTH) -> np.ndarray:
    """Parameters after each task has trained on its blocks, averaged by tokens."""
    start = Model.fresh(counts.total, width).flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Model(counts.symbols, width, start.copy()), 0
        squares = np.zeros_like(model.flat)
        for batch in batches:
            for row in range(batch.num_rows):
                words = counts.symbol(batch.column("words")[row].values.to_pylist())
                lens = np.asarray(batch.column("lens")[row].values, dtype=np.int64)
                held = np.asarray(batch.column("held")[row].values, dtype=bool)
                tokens = words[unpack(batch.column("tokens")[row].as_py())][np.repeat(~held, lens)]
                target, c1, c2, _ = positions(tokens, lens[~held], counts.end)
                rng = np.random.default_rng(batch.column("block")[row].as_py())
                model.train(c1, c2, target, counts.total, squares, rng)
                seen += len(target)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.flat.tobytes()], pa.binary()), pa.array([seen], pa.int64())], names=["flat", "seen"])

    trained = blocks.select("block", "words", "lens", "held", "tokens").mapInArrow(run, "flat binary, seen long")
    sums = trained.rdd.map(lambda r: (np.frombuffer(r["flat"], np.float32).astype(float) * r["seen"], r["seen"]))
    # One fixed-size array per task, added up in a tree.
    nothing = (np.zeros(len(start)), 0)
    flat, seen = sums.treeAggregate(nothing, lambda x, y: (x[0] + y[0], x[1] + y[1]),
                                    lambda x, y: (x[0] + y[0], x[1] + y[1]), depth=3)
    return (flat / seen).astype(np.float32) if seen else start


def block_scores(counts: Counts, model: Model, words: list[str], c: np.ndarray, tokens: np.ndarray,
                 lens: np.ndarray) -> tuple[np.ndarray, ...]:
    """n_known, base_score and score per document of a block; ``c`` has the counts of its words."""
    symbol = counts.symbol(words)
    target, c1, c2, starts = positions(symbol[tokens], lens, counts.end)
    # Occurrences of each target in training; the end is a word like any other.
    seen = np.full(len(target), counts.ends, np.int64)
    is_word = np.ones(len(target), bool)
    is_word[starts + lens] = False
    seen[is_word] = c[tokens]
    base = np.log10(seen + 0.1) - np.log10(counts.n + 0.1 * (counts.v + 1))

    contexts, which = np.unique(c1 * (counts.symbols + 1) + c2, return_inverse=True)
    order = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[order], np.arange(0, len(contexts) + BATCH, BATCH))
    score = np.empty(len(target))
    known = seen > 0
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        part = contexts[i * BATCH:(i + 1) * BATCH]
        logs = model.log_probabilities(part // (counts.symbols + 1), part % (counts.symbols + 1))
        at = order[a:b]
        row = which[at] - i * BATCH
        unknown = np.log(np.exp(logs) @ counts.unknown.astype(np.float32) + 1e-30)
        score[at] = np.where(known[at], logs[row, target[at]], unknown[row])
    # The word's share of its symbol.
    d, total = counts.discount[target], counts.total[target]
    shared = known & (d > 0)
    score[shared] += np.log((seen[shared] - d[shared]) / total[shared])
    add = lambda v: np.add.reduceat(v, starts) if len(starts) else v
    return add(known.astype(np.int64)), add(base), add(score / np.log(10))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    id_text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       (F.crc32(id_text.cast("binary")) % 10 == 0).alias("held"))
    blocks = bucketed(encode(rows, lower=True), "block")
    ends = blocks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    each = blocks.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("at", "pair"))
    located = stored(
        each.selectExpr("block", "at", "pair.words as word", "pair.train as train")
        .selectExpr("*", "sum(train) over (partition by word) as c", "min(block) over (partition by word) as first")
        .where("c > 0").selectExpr("block", "at", "c", "if(block = first, word, null) as word"), "located")
    counts = gather(located, ends)
    flat = fit(blocks, counts)
    back = located.groupBy("block").agg(F.collect_list(F.struct("at", "c")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(counts.symbols, WIDTH, flat)
        for batch in batches:
            for row in range(batch.num_rows):
                words = batch.column("words")[row].values.to_pylist()
                lens = np.asarray(batch.column("lens")[row].values, dtype=np.int64)
                c, known = np.zeros(len(words), np.int64), batch.column("known")[row]
                if known.is_valid:
                    c[np.asarray(known.values.field("at"))] = np.asarray(known.values.field("c"))
                found = block_scores(counts, model, words, c, unpack(batch.column("tokens")[row].as_py()), lens)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, batch.column("held")[row].values, pa.array(lens + 1),
                     pa.array(found[0]), pa.array(np.full(len(lens), counts.n)), pa.array(found[1]), pa.array(found[2])],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    whole = blocks.select("block", "ids", "held", "lens", "tokens", "words").join(
        back.hint("merge"), "block", "left")  # the counts of its words grow with the corpus: no broadcast
    long, double = T.LongType(), T.DoubleType()
    return whole.mapInArrow(run, T.StructType([
        T.StructField("id", blocks.schema["ids"].dataType.elementType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", long), T.StructField("n_known", long), T.StructField("train_tokens", long),
        T.StructField("base_score", double), T.StructField("score", double)]))
