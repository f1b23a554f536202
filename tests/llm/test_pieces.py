"""Piece encoding and decoding against the sentencepiece library."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agentaudit.llm import pieces
from agentaudit.llm.pieces import MODEL, Pieces, _read
from agentaudit.llm.wordcut import after_other, between_words, cut

TABLE = Pieces(_read(MODEL))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PARTS = ["a", "b", " ", "  ", "the", "ing", "▁", "▁▁", "é", "日本", "😀", "\n", "er", "09", " t", "h", "e", "...", "==",
         "\t", "xxx", "l", "oo", "\x80", "ß", "на", "<0x0A>", "<s>", "\x00", "　"]


def agree(texts):
    ids, lens = TABLE.encode(pa.array(texts, pa.string()))
    texts = [t or "" for t in texts]
    want = LIBRARY.encode(texts, num_threads=1)
    ends = np.cumsum(lens)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, lens)] == want
    assert TABLE.decode(ids, lens).to_pylist() == [LIBRARY.decode(w) for w in want]


def test_hard_texts():
    agree([None, "", " ", "   ", "a  b", " " * 40 + "x" + " " * 77, "▁x", "a▁▁b ▁", "<s> </s> <0x41> <unk>",
           "日本語テキスト", "😀 é\x00\n\t", "1234567", "a" * 25, "ab" * 60, "th" * 31 + "er"])


def test_long_texts_end_in_time():
    agree([" " * 50_000 + "ab" * 30_000, "日" * 50_000, "the " * 50_000])


def test_random_texts():
    rng = random.Random(4)
    agree(["".join(rng.choices(PARTS, k=rng.randrange(60))) for _ in range(3000)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    agree(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12), max_size=6))
def test_decode_any_ids(rows):
    flat = np.array([i for ids in rows for i in ids], np.int64)
    got = TABLE.decode(flat, np.array([len(ids) for ids in rows], np.int64)).to_pylist()
    assert got == [LIBRARY.decode(ids) for ids in rows]


def test_one_by_one_is_the_same():
    rng = random.Random(9)
    for _ in range(300):
        word = "".join(rng.choices("abeht inrs▁", k=rng.randrange(1, 30)))
        symbols = TABLE.symbol[[ord(c) for c in word]].astype(np.int64)
        merged, _ = TABLE.merge(symbols.copy(), np.array([len(symbols)]))
        assert merged.tolist() == TABLE.one_by_one(symbols.tolist())


@pytest.mark.parametrize("rule", [after_other, between_words])
def test_words_make_up_the_text(rule):
    rng = random.Random(2)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(20))) for _ in range(200)]
    words, codes, per = cut(pa.array(texts), rule)
    spelled, at = words.to_pylist(), 0
    for text, n in zip(texts, per):
        assert "".join(spelled[c] for c in codes[at:at + n]) == text
        at += n


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(_read(MODEL))
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        Pieces(spec.SerializeToString())


def test_tables(spark):
    rows = [(1, None, 5), (1, "", 5), (2, "the same", 5), (2, "the same", 5), (None, "x\ny", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = pieces.encode(docs, decoded=True)
    got = sorted(map(tuple, found.collect()), key=repr)
    want = sorted(((i, LIBRARY.encode(t or ""), t or "") for i, t, _ in rows), key=repr)
    assert got == want
    back = pieces.decode(found.select("id", F.when(F.size("ids") > 0, F.col("ids")).alias("ids")))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    assert pieces.encode(docs.where("false")).count() == 0
    assert pieces.decode(found.where("false")).count() == 0
