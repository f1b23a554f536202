"""Removal of word sequences that occur twice, found by difference-cover anchors.

A window of 35 words that occurs at two places, in one document or in two, is removed at
every place. Short sub-windows (anchors) are hashed only where their position in the
document, modulo 21, lies in a difference cover: whatever the two positions are, one of
the first 21 shifts puts both into the cover. So two equal windows always share an anchor
at the same shift, and 5 of 21 positions are enough to look at. Windows that hold a
repeated anchor are then extended to their full length, compared by 128-bit hashes of
their word sequence, and those that occur twice are removed.

Documents travel as blocks of word numbers; a block sends every hash once, however often
it occurs there, and the blocks themselves are dealt out once. A passage in a third of
all documents is one row per block, never a pair of documents.

Defined results: null and empty texts have no words; copies remove each other; windows
are judged on the input; a text of fewer words than the window loses nothing. Repeated
rows count as further occurrences. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import bucketed, encode, repeated, unpack

PERIOD = 21
#: Every difference modulo 21 is one between two of these.
COVER = (0, 1, 4, 14, 16)
#: Odd multipliers of the two polynomial hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
OUT_CHARS = 8 << 20


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two independent 64-bit hashes per word."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), "<u8").reshape(-1, 2)


class Sequence:
    """Hashes of windows of a block's words; equal sequences have equal hashes in any block."""

    def __init__(self, tokens: np.ndarray, lens: np.ndarray, words: pa.Array):
        self.ends = np.cumsum(lens)
        self.first = np.repeat(self.ends - lens, lens)  # of the document a word lies in
        self.last = np.repeat(self.ends, lens)
        self.hashes = word_hashes(words.cast(pa.binary()).to_pylist())
        self.tokens, self.lens = tokens, lens

    def windows(self, starts: np.ndarray, length: int, which: int) -> np.ndarray:
        n, factor = len(self.tokens), np.uint64(FACTORS[which])
        inverse = np.uint64(pow(FACTORS[which], -1, 1 << 64))
        power = np.full(n, factor)
        power[:1] = 1
        power = np.multiply.accumulate(power)
        total = np.concatenate(([np.uint64(0)], np.cumsum(self.hashes[self.tokens, which] * power)))
        back = np.full(n, inverse)
        back[:1] = 1
        back = np.multiply.accumulate(back)
        found = (total[starts + length] - total[starts]) * back[starts]
        found ^= found >> np.uint64(31)
        return found * np.uint64(0xBF58476D1CE4E5B9)

    def starts(self, length: int, window: int) -> np.ndarray:
        """Where ``length`` words lie in one document of at least ``window`` words."""
        at = np.arange(len(self.tokens))
        return at[(at + length <= self.last) & (self.last - self.first >= window)]

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        length = window - PERIOD + 1
        at = self.starts(length, window)
        in_cover = np.zeros(PERIOD, bool)
        in_cover[list(COVER)] = True
        at = at[in_cover[(at - self.first[at]) % PERIOD]]
        return at, self.windows(at, length, 0)


def _sequence(batch: pa.RecordBatch, row: int) -> Sequence:
    value = lambda name: batch.column(name)[row]
    return Sequence(unpack(value("tokens").as_py()), np.asarray(value("lens").values, dtype=np.int64),
                    value("words").values)


def _tags(counts: np.ndarray, block: int) -> pa.Array:
    return pa.array(2 * block + (counts > 1), pa.int64())


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found, counts = np.unique(_sequence(batch, row).anchors(window)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), _tags(counts, batch.column("block")[row].as_py())],
                    names=["hash", "tag"])
    return run


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                seq = _sequence(batch, row)
                known = np.asarray(batch.column("hashes")[row].values, dtype=np.int64).view(np.uint64)
                at, hashes = seq.anchors(window)
                marked = np.zeros(len(seq.tokens) + PERIOD + 1, np.int64)
                marked[at[np.isin(hashes, known)]] = 1
                before = np.concatenate(([0], np.cumsum(marked)))
                starts = seq.starts(window, window)
                # The window holds a repeated anchor at one of its first shifts.
                starts = starts[before[starts + PERIOD] > before[starts]]
                pairs = np.empty(len(starts), [("a", np.uint64), ("b", np.uint64)])
                pairs["a"], pairs["b"] = (seq.windows(starts, window, i) for i in (0, 1))
                found, first, counts = np.unique(pairs, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found["a"].copy().view(np.int64)), pa.array(found["b"].copy().view(np.int64)),
                     _tags(counts, batch.column("block")[row].as_py()), pa.array(starts[first], pa.int32())],
                    names=["a", "b", "tag", "at"])
    return run


def _same(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) equal one of those at the places ``at``."""
    # Few pairs agree in their first half only, so that half sifts first.
    maybe = np.flatnonzero(np.isin(a, a[at]))
    pairs = np.empty(len(maybe) + len(at), [("a", np.uint64), ("b", np.uint64)])
    pairs["a"], pairs["b"] = a[np.concatenate((maybe, at))], b[np.concatenate((maybe, at))]
    found = np.zeros(len(a), bool)
    found[maybe] = np.isin(pairs[:len(maybe)], pairs[len(maybe):])
    return found


def _removed(window: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                seq = _sequence(batch, row)
                gone = np.zeros(len(seq.tokens), bool)
                twice = batch.column("twice")[row]
                if twice.is_valid and len(twice.values):
                    starts = seq.starts(window, window)
                    at = np.searchsorted(starts, np.asarray(twice.values, dtype=np.int64))
                    hit = starts[_same(seq.windows(starts, window, 0), seq.windows(starts, window, 1), at)]
                    change = np.zeros(len(seq.tokens) + 1, np.int64)
                    np.add.at(change, hit, 1)
                    np.add.at(change, hit + window, -1)
                    gone = np.cumsum(change[:-1]) > 0
                yield from _documents(seq, gone, batch.column("words")[row].values, batch.column("ids")[row].values)
    return run


def _documents(seq: Sequence, gone: np.ndarray, words: pa.Array, ids: pa.Array) -> Iterator[pa.RecordBatch]:
    spelled = np.array(words.to_pylist(), object)
    removed = np.concatenate(([0], np.cumsum(gone)))
    from_doc, texts, chars = 0, [], 0
    for doc, (end, size) in enumerate(zip(seq.ends.tolist(), seq.lens.tolist())):
        part = slice(end - size, end)
        texts.append(" ".join(spelled[seq.tokens[part][~gone[part]]].tolist()))
        chars += len(texts[-1])
        if chars > OUT_CHARS or doc + 1 == len(seq.lens):
            span = slice(from_doc, doc + 1)
            ends, lens = seq.ends[span], seq.lens[span]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(from_doc, doc + 1 - from_doc), pa.array(lens, pa.int64()),
                 pa.array(removed[ends] - removed[ends - lens], pa.int64()), pa.array(texts, pa.string())],
                names=["id", "n_words", "n_removed", "kept_text"])
            from_doc, texts, chars = doc + 1, [], 0


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed and the kept words as ``kept_text``."""
    if window <= PERIOD:
        raise ValueError(f"the window must be longer than {PERIOD} words")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.lit(False).alias("held"))
    blocks = bucketed(encode(rows, lower=False).drop("held", "train"), "block")
    # Sizes of Arrow stages are guesses to the optimiser; the lists sent back to the blocks
    # grow with the corpus and must not be broadcast on such a guess.
    anchors = blocks.select("block", "lens", "tokens", "words").mapInArrow(
        _anchor_rows(window), "hash long, tag long")
    shared = repeated(anchors, ["hash"], "hash").groupBy("block").agg(F.collect_list("hash").alias("hashes"))
    windows = blocks.select("block", "lens", "tokens", "words").join(
        shared.hint("merge"), "block").mapInArrow(
        _window_rows(window), "a long, b long, tag long, at int")
    # A block hears where a repeated window stands first in it, and finds the others itself.
    twice = repeated(windows, ["a", "b"], "at").groupBy("block").agg(F.collect_list("at").alias("twice"))
    id_type = blocks.schema["ids"].dataType.elementType
    return blocks.join(twice.hint("merge"), "block", "left").mapInArrow(
        _removed(window, id_type),
        T.StructType([T.StructField("id", id_type), T.StructField("n_words", T.LongType()),
                      T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]))
