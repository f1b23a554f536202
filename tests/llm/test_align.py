"""Token alignment against a plain walk over the tokens of whole texts."""

import bisect
import random
import tracemalloc
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agentaudit.llm import align
from agentaudit.llm import queries

A = Tokenizer.from_file(align.VOCABULARY)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=align.MODEL)
PARTS = ["a", "b", " ", "  ", "the", "ing", "▁", "é", "日本", "😀", "\n", "er", "0", " t", "h", "...", "==", "\t", "\x80", "ß",
         "на", "<0x0A>", "don't", "\xa0", "　", "<|endoftext|>", "<s>", "\x1c", "\x00", " the", " of", " and"]


def b_bytes(i):
    return bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()


def spans(tokens):
    at = 0
    for i, data in tokens:
        yield i, at, at + len(data)
        at += len(data)


def brute(rows):
    alphabet = align.byte_alphabet()
    pairs, found = Counter(), []
    for doc, text in rows:
        a = b = []
        if text:
            whole = (" " + text).encode()
            a = [(i, bytes(alphabet[c] for c in A.id_to_token(i))) for i in A.encode(" " + text).ids]
            b = [(i, b_bytes(i)) for i in B.encode(text)]
            if any(b"".join(d for _, d in side) != whole for side in (a, b)):
                a = b = []
        a, b = list(spans(a)), list(spans(b))
        links, at = [], 0
        for i, start, end in a:
            while at < len(b) and b[at][2] <= start:
                at += 1
            to = at
            while to < len(b) and b[to][1] < end:
                links.append((i, b[to][0]))
                to += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([], []) for _ in ends]
        for side, tokens in enumerate((a, b)):
            for i, _, end in tokens:
                groups[bisect.bisect_left(ends, end)][side].append(str(i))
        pairs.update(links)
        text = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        found.append((doc, len(a), len(b), len(ends), links, text))
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return [(doc, n_a, n_b, n_groups, len(links), sum(pairs[x] == best[x[1]] for x in links),
             sum(pairs[x] for x in links), text) for doc, n_a, n_b, n_groups, links, text in found], pairs


@pytest.mark.parametrize("sent", [align.SENT_PAIRS, 0])
def test_against_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(align, "SLICE", 2000)  # many blocks
    monkeypatch.setattr(align, "HELD_PAIRS", 300)
    monkeypatch.setattr(align, "SENT_PAIRS", sent)
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " "), (3, "x"), (3, "x"), (None, "the end"), (4, "ab " * 3000)]
    rows += [(i + 10, "".join(rng.choices(PARTS, k=rng.randrange(30)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"pair": F.lit(1), "block": F.lit("x"), "n_a": F.lit(0)}).repartition(5)
    found, pairs = align.align(docs)
    want, counts = brute(rows)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == dict(counts)


def test_nothing_to_align(spark):
    docs = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    for rows, n in ((docs, 2), (docs.where("false"), 0)):
        found, pairs = align.align(rows)
        assert [tuple(r)[1:] for r in found.collect()] == [(0, 0, 0, 0, 0, 0, "")] * n
        assert pairs.count() == 0


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_token_alignment"](spark, sf).collect()}
    from hashlib import sha256

    for doc, n_a, n_b, n_groups, n_links, n_best, total, text in brute(map(tuple, rows))[0]:
        digest = sha256(text.encode()).hexdigest() if n_a else ""
        row = got[doc]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["n_best"], row["count_sum"],
                row["groups_sha256"]) == (n_a, n_b, n_groups, n_links, n_best, total, digest)


def test_ids_are_those_of_the_vocabulary_file():
    table = align.Tables(align._read(align.VOCABULARY), align._read(align.MODEL))
    rng = random.Random(8)
    texts = [" " + "".join(rng.choices(PARTS, k=rng.randrange(1, 12))) for _ in range(3000)]
    texts += [f" a{chr(c)}b {chr(c)} 1{chr(c)}." for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 37 == 0]
    ids, n = table.a_tokens(pa.array(texts))
    ends = n.cumsum()
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [
        e.ids for e in A.encode_batch(texts, add_special_tokens=False)]


def test_other_vocabularies_are_refused():
    import json

    spec = json.loads(align._read(align.VOCABULARY))
    spec["model"]["merges"].reverse()
    with pytest.raises(ValueError):
        align.Tables(json.dumps(spec).encode(), align._read(align.MODEL))


def random_words(rng, size):
    return " ".join(f"{rng.getrandbits(48):x}" for _ in range(size // 13))


def test_blocks_are_written_and_read_a_few_at_a_time(spark, monkeypatch):
    made, keep = [], align.stored
    monkeypatch.setattr(align, "stored", lambda *args: made.append(keep(*args)) or made[-1])
    monkeypatch.setattr(align, "SLICE", 100_000)
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, random_words(rng, 100_000)) for i in range(60)], "doc_id long, text string")
    assert align.align(docs.coalesce(1))[0].count() == 60
    groups = []
    for path in made[0].inputFiles():
        found = pq.ParquetFile(urlparse(path).path).metadata
        groups += [found.row_group(k).total_byte_size for k in range(found.num_row_groups)]
    assert sum(groups) > 12 << 20  # so it is not one group for want of rows
    assert max(groups) < 6 << 20


def test_tokens_of_a_slice_take_little_memory():
    table = align.Tables(align._read(align.VOCABULARY), align._read(align.MODEL))
    words = pa.array([f" {w}" for w in random_words(random.Random(6), align.SLICE).split()])
    table.tokens(words[:10])
    tracemalloc.start()
    table.tokens(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 110 << 20


def test_runs_of_words_are_aligned_as_all_words_at_once(monkeypatch):
    table = align.Tables(align._read(align.VOCABULARY), align._read(align.MODEL))
    rng = random.Random(9)
    parts = [p for p in PARTS if p != "▁"]  # so that tokens spell every word
    texts = pa.array(["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(300)])
    words, codes, lens = align.cut(align.prefixed(texts), align.between_words)

    def result():
        *tokens, good = table.tokens(words)
        parts = [(align.Links(table, *part), part) for _, *part in align._parts(*tokens)]
        groups = align._groups([links.text(*part, table) for links, part in parts], codes, lens)
        per_word = [sum((getattr(links, c).tolist() for links, _ in parts), []) for c in ("pair", "n_links", "n_groups")]
        return len(parts), [v.tolist() for v in (*tokens, good)], per_word, groups.to_pylist()

    n, *whole = result()
    monkeypatch.setattr(align, "WORD_BYTES", 40)
    monkeypatch.setattr(align, "TOKENS", 30)
    many, *runs = result()
    assert n == 1 and many > 50 and runs == whole


def test_vectors_added_up_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(align, "ADDED", 2)
    rows = [(i, f"the end of {i} and the rest") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    assert {(r["a"], r["b"]): r["n"] for r in align.align(docs)[1].collect()} == dict(brute(rows)[1])


@pytest.mark.parametrize("largest", [0, 255, 256, 65_535, 65_536, (1 << 32) - 1])
def test_packed_numbers_come_back(largest):
    for numbers in ([], [0], [largest, 3, 0]):
        packed = align._pack(np.array(numbers, np.int64))
        assert align._unpack(packed).tolist() == numbers and packed[0] <= max(1, (largest.bit_length() + 7) // 8)
