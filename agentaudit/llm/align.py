"""Alignment of two tokenizers' tokens over a corpus, with the counts of linked id pairs.

A is a byte-level vocabulary, B a SentencePiece model. Both encode a space and the text.
Byte offsets where tokens of A and of B both end cut the tokens into groups; an A and a B
token whose byte ranges overlap are linked. A single space between two words is a token
start in both, so a text's alignment is that of its words, end to end, and every distinct
word of a block is tokenised and aligned once, in runs of words that bound the arrays.

An array gives each A id the B id with the same bytes. Groups of one A and one B token
that agree with it are counted in one vector per task, of the length of A's vocabulary;
only the pairs of all other groups are shuffled, summed up per task, to be summed by pair.
Up to ``SENT_PAIRS`` sums are counted and broadcast; beyond that each block gets back the
sums of its own pairs by joins. The vectors, and the highest count of every B id, are as
long as a vocabulary and pass through the driver.

Defined results: texts that are null or empty, or whose tokens' bytes are not those of
the space and the text (B writes U+2581 as a space), have no tokens and count nowhere.
Rows are aligned each for itself, repeated ones too; further columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import pack, unpack
from .common import slices, stored
from .pieces import MODEL, _read, _sums, gather, in_order, pieces
from .tokens import PATTERN
from .wordcut import between_words, blank, cut, flat_bytes, from_offsets, prefixed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
SLICE = 2 << 20
#: Bytes of distinct words that are tokenised, and tokens that are aligned, at once.
WORD_BYTES = 256 << 10
TOKENS = 1 << 17
#: A row group of blocks, which are rows of a few megabytes: a task that writes or reads them holds one.
BLOCK_GROUP = 4 << 20
#: Two slices, or two blocks, go to a Python worker at a time.
ARROW_BYTES = "4m"
#: Vectors of direct links that one task adds up.
ADDED = 16
#: Pairs a task sums up before it hands them on.
HELD_PAIRS = 1 << 20
#: Sums of pairs that are broadcast, 16 bytes each; more of them are joined to the blocks.
SENT_PAIRS = 2 << 20


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others for the characters from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Tables:
    """Both tokenizers, the lengths of their tokens, and the identity map from A to B."""

    def __init__(self, vocabulary: bytes, model: bytes):
        import tiktoken

        spec, alphabet = json.loads(vocabulary), byte_alphabet()
        self.b, ids = pieces(model), spec["model"]["vocab"]
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        level = spec["pre_tokenizer"]
        plain = spec["normalizer"] is None and level["type"] == "ByteLevel" and not level["add_prefix_space"]
        if not plain or not all(ids[a] < ids[b] for a, b in zip(merged, merged[1:])):
            raise ValueError("only byte-level vocabularies whose ids are in the order of their merges are supported")
        special = {t["content"] for t in spec["added_tokens"]}
        self.a_bytes = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        # The merges of this vocabulary are its ids in order, which the library takes as ranks.
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for token, i in ids.items() if token not in special})
        self.b_bytes = self.b.surface
        self.a_len = np.array([len(t) for t in self.a_bytes])
        self.b_len = np.array([len(t) for t in self.b_bytes])
        # Of B ids with the same bytes a piece comes before the id of a single byte.
        of_bytes = {t: i for whole in (False, True) for i, t in enumerate(self.b_bytes)
                    if t and whole != self.b.is_byte[i]}
        self.identity = np.array([of_bytes.get(t, -1) for t in self.a_bytes])
        self.spellings = [pa.array(t, pa.binary()) for t in (self.a_bytes, self.b_bytes)]

    @cached_property
    def signs(self) -> pa.Array:
        """A ids with each sign that may follow them, B ids with theirs, and B ids alone."""
        sizes = len(self.a_len), len(self.b_len)
        numbers = [str(i) for i in range(max(sizes))]
        return pa.array([n + s for size, ends in zip(sizes, (",|", ",;")) for s in ends for n in numbers[:size]]
                        + numbers[:sizes[1]], pa.binary())

    def tokens(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids and B ids of all ``words``, each with the number per word, and which words these spell."""
        sizes = np.asarray(pc.binary_length(words), dtype=np.int64)
        found = []
        for at in _runs(sizes, WORD_BYTES):
            part = words[at]
            ids = *self.a_tokens(part), *self.b.words(part)
            found.append((*ids, self.spelled(part, *ids)))
        return tuple(np.concatenate(v) for v in zip(*found))

    def a_tokens(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = flat_bytes(words)
        sizes = np.diff(offsets)
        # Words between single spaces are tokenised as one text, whose tokens end where they end.
        whole = (sizes > 1) & ~blank(data, offsets[:-1], False) & ~blank(data, offsets[1:], True)
        ids = np.array(self.a.encode_ordinary("".join(words.filter(pa.array(whole)).to_pylist())), np.int64)
        ends = np.searchsorted(np.cumsum(self.a_len[ids]), np.cumsum(sizes[whole])) + 1
        out = [(np.flatnonzero(whole), np.diff(ends, prepend=0), ids)]
        for at in np.flatnonzero(~whole).tolist():
            found = self.a.encode_ordinary(words[at].as_py())
            out.append((np.array([at]), np.array([len(found)]), np.array(found, np.int64)))
        return in_order(out)

    def spelled(self, words: pa.Array, a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> np.ndarray:
        """Which words are the bytes of their A tokens and of their B tokens."""
        same = np.ones(len(words), bool)
        wanted = words.cast(pa.binary())
        for table, ids, n in zip(self.spellings, (a, b), (a_n, b_n)):
            data, offsets = flat_bytes(table.take(pa.array(ids)))
            joined = from_offsets(data, offsets[np.append(0, np.cumsum(n))], pa.binary())
            same &= np.asarray(pc.equal(joined, wanted))
        return same


@lru_cache(maxsize=2)
def tables(vocabulary: bytes, model: bytes) -> Tables:
    return Tables(vocabulary, model)


def _runs(sizes: np.ndarray, limit: int) -> list[slice]:
    """Runs of values, one run at least, of about ``limit`` together or up to one value more."""
    edges = (np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1).tolist()
    return [slice(*edge) for edge in zip([0, *edges], [*edges, len(sizes)])]


def _parts(a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> Iterator[tuple]:
    """Runs of words, each with its own A and B ids and their numbers per word."""
    a_ends, b_ends = (np.append(0, np.cumsum(n)) for n in (a_n, b_n))
    for at in _runs(a_n + b_n, TOKENS):
        yield (at, a[a_ends[at.start]:a_ends[at.stop]], a_n[at], b[b_ends[at.start]:b_ends[at.stop]], b_n[at])


class Links:
    """Links and groups of words given by their A and B ids.

    Between two neighbouring token ends, of whichever side, one A and one B token overlap:
    these stretches are the links.
    """

    def __init__(self, table: Tables, a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray):
        a_ends, b_ends = np.cumsum(table.a_len[a]), np.cumsum(table.b_len[b])
        ends = np.union1d(a_ends, b_ends)
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        self.a_group, self.b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        group = np.searchsorted(shared, ends)
        single = (np.bincount(self.a_group, minlength=len(shared)) == 1) & (
            np.bincount(self.b_group, minlength=len(shared)) == 1)
        self.a, self.b = a[at_a], b[at_b]
        self.direct = single[group] & (table.identity[self.a] == self.b)
        self.pair = self.a << 32 | self.b
        word_ends = np.append(-1, a_ends)[np.cumsum(a_n)]
        self.word = np.searchsorted(word_ends, ends)
        self.n_links = np.bincount(self.word, minlength=len(a_n))
        self.n_groups = np.bincount(np.searchsorted(word_ends, shared), minlength=len(a_n))

    def text(self, a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray, table: Tables) -> pa.Array:
        """Per word its groups, ``a1,a2|b1;`` and so on, and the words again without the last sign."""
        sizes = len(table.a_len), len(table.b_len)
        a_last = np.append(np.diff(self.a_group), 1) > 0
        b_last = np.append(np.diff(self.b_group), 1) > 0
        # A's tokens of a group come before B's.
        order = np.argsort(np.concatenate((2 * self.a_group, 2 * self.b_group + 1)), kind="stable")
        each = np.concatenate((a + sizes[0] * a_last, 2 * sizes[0] + b + sizes[1] * b_last))[order]
        ends = np.cumsum(a_n + b_n)
        last = np.concatenate((np.zeros(len(each), bool), np.zeros(len(each), bool)))
        last[len(each) + ends[ends > 0] - 1] = True
        each = np.concatenate((each, each))
        each[last] += sizes[1]
        data, offsets = flat_bytes(table.signs.take(pa.array(each)))
        return from_offsets(data, offsets[np.concatenate(([0], ends, ends[-1:] + ends))], pa.binary())


def _pack(numbers: np.ndarray) -> bytes:
    """The number of byte planes that are not all zero, and these: ids and counts take two or one of the four."""
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([width]) + pack(numbers)[:width * len(numbers)]


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1) if len(data) > 1 else np.zeros(0, np.uint8)
    return unpack(np.concatenate((planes, np.zeros((4 - data[0]) * (len(planes) // data[0]), np.uint8))))


def _one(array: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)


class Sums:
    """Counts of id pairs so far, sorted by pair."""

    def __init__(self):
        self.pairs, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.pairs, which = np.unique(np.concatenate((self.pairs, pairs)), return_inverse=True)
        total = np.zeros(len(self.pairs), np.int64)
        np.add.at(total, which, np.concatenate((self.counts, counts)))
        self.counts = total


def _blocks(rows: DataFrame, vocabulary, model) -> DataFrame:
    """A row per slice of text; and, per task, rows with the pairs and the vector of direct links."""
    id_type = rows.schema["id"].dataType
    parts = ("codes", "a", "a_n", "b", "b_n")
    names = ["block", "ids", "lens", *parts, "pairs", "counts", "direct"]
    longs, blob = pa.list_(pa.int64()), pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables(vocabulary.value, model.value)
        direct, sums, number, id_list = np.zeros(len(table.a_len), np.int64), Sums(), TaskContext.get().partitionId() << 32, None

        def summary(vector: pa.Array) -> pa.RecordBatch:
            empty = [pa.nulls(1, kind) for kind in (pa.int64(), id_list, pa.list_(pa.int32()), *[blob] * len(parts))]
            return pa.RecordBatch.from_arrays(
                [*empty, _one(pa.array(sums.pairs)), _one(pa.array(sums.counts)), vector], names=names)

        for batch in slices(batches, "text", SLICE):
            words, codes, lens = cut(prefixed(batch.column("text")), between_words)
            a, a_n, b, b_n, good = table.tokens(words)
            whole = _sums((~good[codes]).astype(np.int64), lens) == 0
            # Texts that do not come out of their tokens lose their words here.
            codes, lens = codes[np.repeat(whole, lens)], np.where(whole, lens, 0)
            used = np.bincount(codes, minlength=len(words))
            kept = np.flatnonzero(used)
            a, b, a_n, b_n = gather(a, a_n, kept), gather(b, b_n, kept), a_n[kept], b_n[kept]
            renumber = np.zeros(len(words), np.int64)
            renumber[kept] = np.arange(len(kept))
            used, others = used[kept], []
            for at, *part in _parts(a, a_n, b, b_n):
                links = Links(table, *part)
                weight = used[at][links.word]
                np.add.at(direct, links.a[links.direct], weight[links.direct])
                others.append((links.pair[~links.direct], weight[~links.direct]))
            sums.add(*map(np.concatenate, zip(*others)))
            ids = _one(batch.column("id"))
            id_list = ids.type
            packed = [pa.array([_pack(v)], blob) for v in (renumber[codes], a, a_n, b, b_n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), ids, _one(pa.array(lens, pa.int32())), *packed,
                 pa.nulls(1, longs), pa.nulls(1, longs), pa.nulls(1, blob)], names=names)
            number += 1
            if len(sums.pairs) > HELD_PAIRS:
                yield summary(pa.nulls(1, blob))
                sums = Sums()
        if id_list is not None:
            yield summary(pa.array([direct.tobytes()], blob))

    long, binary = T.LongType(), T.BinaryType()
    return rows.mapInArrow(run, T.StructType([
        T.StructField("block", long), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("lens", T.ArrayType(T.IntegerType())), *(T.StructField(c, binary) for c in parts),
        T.StructField("pairs", T.ArrayType(long)), T.StructField("counts", T.ArrayType(long)),
        T.StructField("direct", binary)]))


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of all vectors of direct links, added up in a tree."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for one in batch.column("direct"):
                total += np.frombuffer(one.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["direct"])

    vectors = rows.where("direct IS NOT NULL").select("direct")
    left = vectors.rdd.getNumPartitions()
    while left > ADDED:
        left = -(-left // ADDED)
        vectors = vectors.mapInArrow(add, "direct binary").repartition(left)
    found = vectors.mapInArrow(add, "direct binary").toArrow().column("direct")
    return sum((np.frombuffer(one.as_buffer(), np.int64) for one in found), np.zeros(size, np.int64))


def _block(batch: pa.RecordBatch, row: int) -> tuple:
    value = lambda name: batch.column(name)[row]
    codes, *tokens = (_unpack(value(c).as_py()) for c in ("codes", "a", "a_n", "b", "b_n"))
    return codes, tokens


def _own_counts(blocks: DataFrame, totals: DataFrame, sent) -> DataFrame:
    """``blocks`` with the sums of their own pairs, for sums too many to broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables(*(f.value for f in sent))
        for batch in batches:
            for row in range(batch.num_rows):
                parts = (Links(table, *part) for _, *part in _parts(*_block(batch, row)[1]))
                pairs = np.unique(np.concatenate([links.pair[~links.direct] for links in parts]))
                block = np.full(len(pairs), batch.column("block")[row].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(pairs)], names=["block", "pair"])

    each = blocks.drop("ids", "lens", "pairs", "n").mapInArrow(run, "block long, pair long")
    back = each.join(totals.hint("merge"), "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pair", "n"))).alias("own"))
    return blocks.join(back.hint("merge"), "block", "left").withColumns({
        "pairs": F.col("own.pair"), "n": F.col("own.n")}).drop("own")


def align(docs: DataFrame, vocabulary: str = VOCABULARY, model: str = MODEL, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: the documents' alignments, and the counts of linked id pairs.

    The first has id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest
    count of its B id), count_sum (over links) and groups (``a1,a2|b1;a3|b2,b3``); the second
    a, b and n, one row per pair.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    # Two vocabularies, about two megabytes.
    files = [_read(path) for path in (vocabulary, model)]
    sent = [spark.sparkContext.broadcast(f) for f in files]
    table = tables(*files)
    made = stored(_blocks(rows, *sent), "aligned", BLOCK_GROUP, 1)
    vector = _vector(made, len(table.a_len))
    own = np.flatnonzero(vector)
    direct = spark.createDataFrame(pa.table({
        "pair": pa.array(own << 32 | table.identity[own]), "n": pa.array(vector[own])}), "pair long, n long")
    each = made.where("block IS NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("one")).select(
        F.col("one.pairs").alias("pair"), F.col("one.counts").alias("n"))
    totals = stored(each.unionByName(direct).groupBy("pair").agg(F.sum("n").alias("n")), "pairs")

    # One number per id of a vocabulary each.
    best = np.zeros(len(table.b_len), np.int64)
    for b, n in totals.groupBy(F.expr("cast(pair & 4294967295L as int)").alias("b")).agg(F.max("n")).collect():
        best[b] = n
    identical = np.zeros(len(table.a_len), np.int64)
    for pair, n in totals.join(F.broadcast(direct.select("pair")), "pair").collect():
        identical[pair >> 32] = n
    blocks = made.where("block IS NOT NULL").select(
        "block", "ids", "lens", "codes", "a", "a_n", "b", "b_n", F.lit(None).cast("array<bigint>").alias("pairs"),
        F.lit(None).cast("array<bigint>").alias("n"))
    if totals.count() <= SENT_PAIRS:
        found = totals.orderBy("pair").toArrow()
        every = [found.column(c).combine_chunks().to_numpy() for c in ("pair", "n")]
    else:
        every = [np.zeros(0, np.int64)] * 2
        blocks = _own_counts(blocks, totals, sent)
    sums = spark.sparkContext.broadcast((best, identical, *every))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, (best, identical, *every) = tables(*(f.value for f in sent)), sums.value
        for batch in batches:
            for row in range(batch.num_rows):
                value = lambda name: batch.column(name)[row]  # noqa: B023,E731
                lens = np.asarray(value("lens").values, dtype=np.int64)
                codes, tokens = _block(batch, row)
                pairs, counts = (np.asarray(value(c).values, dtype=np.int64) for c in ("pairs", "n")) if value(
                    "pairs").is_valid else every
                found, texts = [], []
                for _, *part in _parts(*tokens):
                    links = Links(table, *part)
                    other, n = ~links.direct, identical[links.a]
                    if other.any():
                        n[other] = counts[np.searchsorted(pairs, links.pair[other])]
                    total, top = np.zeros(len(part[1]), np.int64), np.zeros(len(part[1]), np.int64)
                    np.add.at(total, links.word, n)
                    np.add.at(top, links.word, (n == best[links.b]).astype(np.int64))
                    found.append((links.n_groups, links.n_links, top, total))
                    texts.append(links.text(*part, table))
                of_word = (tokens[1], tokens[3], *map(np.concatenate, zip(*found)))
                numbers = [_sums(v[codes], lens) for v in of_word]
                yield pa.RecordBatch.from_arrays(
                    [value("ids").values, *map(pa.array, numbers), _groups(texts, codes, lens)],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    found = blocks.mapInArrow(run, T.StructType([
        rows.schema["id"], *(T.StructField(c, T.LongType()) for c in (
            "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), T.StructField("groups", T.StringType())]))
    return found, totals.selectExpr("cast(shiftright(pair, 32) as int) as a", "cast(pair & 4294967295L as int) as b", "n")


def _groups(texts: list[pa.Array], codes: np.ndarray, lens: np.ndarray) -> pa.Array:
    """Per text the groups of its words, given as the ``Links.text`` of each run of words."""
    ends = np.cumsum(lens)
    if not len(codes):
        return pa.array([""] * len(lens), pa.string())
    each = codes.copy()
    each[ends[lens > 0] - 1] += sum(map(len, texts)) // 2  # a text's last word has no sign at its end
    halves = [t[k * len(t) // 2:(k + 1) * len(t) // 2] for k in (0, 1) for t in texts]
    data, offsets = flat_bytes(pa.concat_arrays(halves).take(pa.array(each)))
    return from_offsets(data, offsets[np.append(0, ends)], pa.string())
