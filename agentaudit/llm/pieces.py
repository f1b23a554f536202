"""Encoding and decoding with a SentencePiece model of the merge kind, in numpy.

Texts are cut at spaces that follow another character, which no piece of the model
crosses, and every distinct word of a slice is encoded once. The words lie in flat symbol
arrays. In each round every word finds the best rank among its pairs (a segmented
minimum) and merges all pairs of that rank at once, from the left and without overlap;
then the arrays are compacted, and words without a pair leave. A word where a merge makes
a pair of the same or a better rank would go on there before its other merges; such words
(runs of blanks, whose pieces all have one rank) are finished one merge at a time.

Supported are models with byte fallback and without normalisation rules; others raise.

Defined results: a null or empty text has no ids and decodes to the empty text; rows are
encoded each for itself, repeated ones too; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .wordcut import after_other, cut, flat_bytes, from_offsets, prefixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text encoded at once; distinct words are listed per slice.
SLICE = 6 << 20
BLANK = "▁"
NEVER = np.iinfo(np.int32).max
#: Symbols that are characters outside the model start here.
OUTSIDE = 1 << 21


class Pairs:
    """A hash table from pairs of numbers below 2**22 to a number; absent pairs give -1."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        keys = self.key(left, right)
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        slot, rest = self.slot(keys), np.arange(len(keys))
        while len(rest):  # linear probing, all keys a step at a time
            free = rest[self.keys[slot[rest]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            self.keys[slot[free[first]]], self.values[slot[free[first]]] = keys[free[first]], value[free[first]]
            rest = rest[self.keys[slot[rest]] != keys[rest]]
            slot[rest] = (slot[rest] + 1) & (size - 1)

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 22 | right.astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self.key(left, right)
        slot = self.slot(keys)
        found = self.keys[slot]
        value = np.where(found == keys, self.values[slot], -1)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[rest]]
            hit = found == keys[rest]
            value[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return value


class Pieces:
    """Tables of a model: characters, mergeable pairs, ranks, bytes of every piece."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        kinds = proto.ModelProto.SentencePiece
        rules, train = spec.normalizer_spec, spec.trainer_spec
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        if (train.model_type != train.BPE or not train.byte_fallback or not plain or not rules.add_dummy_prefix
                or train.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces)):
            raise ValueError("only merge models with byte fallback and no normalisation are supported")
        normal = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        if any(BLANK in piece.lstrip(BLANK) for piece in normal):
            raise ValueError("a piece crosses a word start")
        self.size = len(spec.pieces)
        self.spelling = [p.piece for p in spec.pieces]
        self.control = np.array([p.type == kinds.CONTROL for p in spec.pieces])
        self.is_byte = np.array([p.type == kinds.BYTE for p in spec.pieces])
        self.byte_ids = np.zeros(256, np.int32)
        surface = []
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.CONTROL:
                surface.append(b"")
            elif p.type == kinds.UNKNOWN:
                surface.append(train.unk_surface.encode())
            else:
                surface.append(p.piece.replace(BLANK, " ").encode())
        self.surface = surface
        #: Surfaces, and again without the blank a text's first piece loses.
        shorn = [s[1:] if p.type == kinds.NORMAL and s[:1] == b" " else s for s, p in zip(surface, spec.pieces)]
        self.surfaces = pa.array(surface + shorn, pa.binary())
        scores = -np.array([p.score for p in spec.pieces], np.float32)
        self.rank = np.append(np.unique(scores, return_inverse=True)[1].astype(np.int32), NEVER)
        self.symbol = np.arange(OUTSIDE, OUTSIDE + 0x110000, dtype=np.int32)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        # Symbols are characters to begin with, of the model or not, and merged pieces.
        known = {**{chr(c): c + OUTSIDE for piece in normal for c in map(ord, piece)}, **normal}
        left, right, merged = [], [], []
        for piece, i in normal.items():
            for at in range(1, len(piece)):
                if piece[:at] in known and piece[at:] in known:
                    left.append(known[piece[:at]])
                    right.append(known[piece[at:]])
                    merged.append(i)
        self.pairs = Pairs(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int32))
        self.single = dict(zip(self.pairs.keys.tolist(), self.pairs.values.tolist()))
        near = sorted({(ord(a), ord(b)) for piece in normal for a, b in zip(piece, piece[1:])})
        self.near = Pairs(*np.array(near, np.int64).reshape(-1, 2).T, np.ones(len(near), np.int32))

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` (spaces stand for blanks), and how many each word has."""
        lens = np.asarray(pc.utf8_length(words), dtype=np.int64)
        chars = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
        chars = np.where(chars == 0x20, np.uint32(ord(BLANK)), chars).astype(np.int64)
        if not len(chars):
            return np.zeros(0, np.int64), lens
        # Two characters that no piece holds side by side never merge: parts between such
        # places are merged each for itself.
        starts = np.ones(len(chars), bool)
        starts[1:] = self.near.find(chars[:-1], chars[1:]) < 0
        starts[(np.cumsum(lens) - lens)[lens > 0]] = True
        edges = np.append(np.flatnonzero(starts), len(chars))
        symbols, sizes = self.merge(self.symbol[chars].astype(np.int64), np.diff(edges))
        part_of = np.searchsorted(np.cumsum(lens), edges[:-1], "right")
        ids, per_symbol = self.fallback(symbols)
        of_word = np.repeat(part_of, sizes)
        return ids, np.bincount(of_word, per_symbol, len(lens)).astype(np.int64)

    def fallback(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols: characters outside the model become the ids of their bytes."""
        per = np.ones(len(symbols), np.int64)
        outside = np.flatnonzero(symbols >= OUTSIDE)
        if not len(outside):
            return symbols, per
        spelled = [chr(c).encode() for c in (symbols[outside] - OUTSIDE).tolist()]
        per[outside] = [len(s) for s in spelled]
        ids = np.repeat(symbols, per)
        ends = np.cumsum(per)
        at = np.repeat(ends[outside] - per[outside], per[outside])
        inside = np.arange(len(at)) - np.repeat(np.cumsum(per[outside]) - per[outside], per[outside])
        ids[at + inside] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return ids, per

    def merge(self, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of words given as symbols ``s`` and lengths ``n``, and their lengths."""
        word, out = np.arange(len(n)), []
        last = np.zeros(len(s), bool)
        last[np.cumsum(n) - 1] = True
        pair = np.full(len(s), -1, np.int64)
        inner = np.flatnonzero(~last)
        pair[inner] = self.pairs.find(s[inner], s[inner + 1])
        while len(n):
            rank = self.rank[pair]  # of no pair: the last entry
            best = np.minimum.reduceat(rank, np.cumsum(n) - n)
            done = best == NEVER
            if done.any():
                mine = np.repeat(done, n)
                out.append((word[done], n[done], s[mine]))
                rest = ~mine
                s, pair, rank, last = s[rest], pair[rest], rank[rest], last[rest]
                n, word, best = n[~done], word[~done], best[~done]
                if not len(n):
                    break
            of_symbol = np.repeat(np.arange(len(n)), n)
            at = np.flatnonzero(rank == best[of_symbol])
            # Overlapping pairs stand side by side; of such a run every second one goes.
            order = np.arange(len(at))
            apart = np.diff(at, prepend=-2) != 1
            at = at[(order - np.maximum.accumulate(np.where(apart, order, 0))) % 2 == 0]
            made = pair[at]
            touching = np.diff(at, prepend=-3) == 2  # the pair before ends where this one starts
            touching[1:] &= ~last[at[1:] - 1]
            has_left = np.append(True, last)[at] == 0
            has_right = ~last[at + 1]
            before = np.where(touching, np.roll(made, 1), s[at - 1])
            left, right = np.full(len(at), -1, np.int64), np.full(len(at), -1, np.int64)
            left[has_left] = self.pairs.find(before[has_left], made[has_left])
            right[has_right] = self.pairs.find(made[has_right], s[(at + 2)[has_right]])
            limit = best[of_symbol[at]]
            early = (self.rank[left] <= limit) | (self.rank[right] <= limit)
            keep = np.ones(len(s), bool)
            if early.any():
                alone = np.zeros(len(n), bool)
                alone[of_symbol[at[early]]] = True
                ends = np.cumsum(n)
                for w in np.flatnonzero(alone).tolist():
                    merged = self.one_by_one(s[ends[w] - n[w]:ends[w]].tolist())
                    out.append((word[w:w + 1], np.array([len(merged)]), np.array(merged, np.int64)))
                mine = alone[of_symbol]
                keep &= ~mine
                go = ~mine[at]
                at, made, left, right, touching = at[go], made[go], left[go], right[go], touching[go]
            s[at] = made
            pair[at] = right
            # The pair's own end is now that of the symbol after it.
            last[at] = last[at + 1]
            free = ~touching & (left >= -1) & (at > 0)
            spot = at[free] - 1
            inside = ~last[spot]
            pair[spot[inside]] = left[free][inside]
            pair[at[touching] - 2] = left[touching]
            keep[at + 1] = False
            n = np.bincount(of_symbol[keep], minlength=len(n))
            s, pair, last = s[keep], pair[keep], last[keep]
            n, word = n[n > 0], word[n > 0]
        return in_order(out)

    def one_by_one(self, s: list[int]) -> list[int]:
        """The best pair first, of equal ones the leftmost, one after the other."""
        after, before = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        heap: list[tuple[int, int, int, int, int]] = []
        ranks = self.rank.tolist()

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(s):
                made = self.single.get(s[i] << 22 | s[after[i]])
                if made is not None:
                    heapq.heappush(heap, (ranks[made], i, made, s[i], s[after[i]]))

        for i in range(len(s)):
            offer(i)
        while heap:
            _, i, made, left, right = heapq.heappop(heap)
            j = after[i]
            if s[i] != left or j >= len(s) or s[j] != right:
                continue
            s[i], s[j], after[i] = made, -1, after[j]
            if after[j] < len(s):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in s if x >= 0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each text has."""
        plain = pc.replace_substring(prefixed(texts), BLANK, " ")
        words, codes, per_text = cut(plain, after_other)
        ids, lens = self.words(words)
        return gather(ids, lens, codes), _sums(lens[codes], per_text)

    def decode(self, ids: np.ndarray, lens: np.ndarray) -> pa.Array:
        """The texts of ids given flat with their number per text."""
        starts = np.cumsum(lens) - lens
        first = ids.copy()
        heads = starts[lens > 0]
        lead = self.control[ids[heads]]
        while lead.any():  # ids without text do not count as a text's first
            heads = heads + lead
            ends = (starts + lens)[lens > 0]
            lead = lead & (heads < ends)
            lead[lead] = self.control[ids[heads[lead]]]
        heads = heads[heads < (starts + lens)[lens > 0]]
        first[heads] += self.size
        data, offsets = flat_bytes(self.surfaces.take(pa.array(first)))
        edges = offsets[np.append(starts, lens.sum())]
        held = np.append(0, np.cumsum(self.is_byte[ids]))
        texts = None
        for row in np.flatnonzero(held[starts + lens] > held[starts]).tolist():
            mine = ids[starts[row]:starts[row] + lens[row]]
            try:
                data[edges[row]:edges[row + 1]].tobytes().decode()
                broken = self.control[mine].any()  # it ends a run of bytes, without a trace in the data
            except UnicodeDecodeError:
                broken = True
            if broken:
                texts = texts or {}
                texts[row] = self.repaired(mine)
        if texts is None:
            return from_offsets(data, edges, pa.string())
        return pa.array([texts[i] if i in texts else data[a:b].tobytes().decode()
                         for i, (a, b) in enumerate(zip(edges, edges[1:]))], pa.string())

    def repaired(self, ids: np.ndarray) -> str:
        """The text of ids whose byte runs are no UTF-8: each stray byte is U+FFFD."""
        out, run, begun = [], b"", False

        def spell(run: bytes) -> str:
            found = []
            while run:
                size = next((k for k in (1, 2, 3, 4) if _is_char(run[:k])), 0)
                found.append(run[:size].decode() if size else "�")
                run = run[size or 1:]
            return "".join(found)

        for i in ids.tolist():
            if self.is_byte[i]:
                run += self.surface[i]
                continue
            out.append(spell(run))
            begun, run = begun or bool(out[-1]), b""
            piece = self.surface[i].decode()
            out.append(piece[1:] if not begun and piece[:1] == " " and self.spelling[i][:1] == BLANK else piece)
            begun = begun or bool(piece)
        return "".join(out) + spell(run)


def _is_char(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def _sums(values: np.ndarray, per: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(per)
    return total[ends] - total[ends - per]


def gather(values: np.ndarray, lens: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs number ``codes`` of ``values``, whose runs have the lengths ``lens``, end to end."""
    sizes = lens[codes]
    starts = (np.cumsum(lens) - lens)[codes]
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return values[np.arange(len(shift)) + shift]


def in_order(out: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, n, s = (np.concatenate(v) for v in zip(*out))
    order = np.argsort(word)
    return gather(s, n, order), n[order]


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """The tables of a model, built once in each worker."""
    return Pieces(model)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id, ids) of every row, without begin or end; with ``decoded`` also the text of the ids."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    data = rows.sparkSession.sparkContext.broadcast(_read(model))  # a vocabulary, half a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(data.value)
        for batch in slices(batches, "text", SLICE):
            ids, lens = table.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)), pa.int32()), pa.array(ids, pa.int32()))
            columns = {"id": batch.column("id"), "ids": lists}
            if decoded:
                columns["decoded"] = table.decode(ids, lens)
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema.add("decoded", T.StringType()) if decoded else schema)


def decode(rows: DataFrame, model: str = MODEL, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of ids; null counts as no ids."""
    rows = rows.select(F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{ids_col}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    data = rows.sparkSession.sparkContext.broadcast(_read(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(data.value)
        for batch in batches:
            ids = batch.column("ids")
            lens = np.asarray(pc.list_value_length(ids), dtype=np.int64)
            texts = table.decode(np.asarray(ids.flatten(), dtype=np.int64), lens)
            yield pa.RecordBatch.from_arrays([batch.column("id"), texts], names=["id", "text"])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("text", T.StringType())]))
