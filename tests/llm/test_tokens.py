"""Flat token files: round trips, blocks of any size, stitching."""

import random

import numpy as np
import pyarrow as pa
import pytest

from agentaudit.llm import tokens
from agentaudit.llm.common import folder
from agentaudit.llm.queries import QUERIES


def encode():
    with open(tokens.VOCABULARY, "rb") as file:
        return tokens.encoder(file.read()).encode_ordinary


def test_query_equals_single_texts(spark, sf):
    lengths, one = {}, encode()
    for i, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        lengths[i] = len(one(text or ""))
    assert {r["doc_id"]: r["n_tokens"] for r in QUERIES["op3_token_counts"](spark, sf).collect()} == lengths


def test_files_hold_tokens_and_separators_only(spark):
    texts = ["Hello there", None, "", "é 日本 " * 50, "x" * 20_000, "\n\n", "tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    path = folder(spark, "flat")
    manifest = tokens.write_flat(docs, path)
    where = {(r["part"], r["ordinal"]): r["id"] for r in manifest.collect()}
    one, found = encode(), {}
    for row in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        part = int(row["path"].split("part-")[1][:5])
        flat = np.frombuffer(row["content"], "<u2")
        ends = np.flatnonzero(flat == tokens.END)
        assert len(flat) == 0 or ends[-1] == len(flat) - 1
        for k, (a, b) in enumerate(zip(np.concatenate(([0], ends[:-1] + 1)), ends)):
            found[where[part, k]] = flat[a:b].tolist()
    assert found == {i: one(t or "") for i, t in enumerate(texts)}
    got = {r["id"]: r["n_tokens"] for r in tokens.named(tokens.count(spark, path), manifest).collect()}
    assert got == {i: len(v) for i, v in found.items()}


def flat_files(spark, streams):
    """Files of raw tokens, written through the text sink."""
    path = folder(spark, "raw")
    rows = [(bytes(np.array(s, "<u2").tobytes()),) for s in streams]
    (spark.createDataFrame(rows, "value binary").repartition(len(rows)).selectExpr("cast(value as string) as value")
     .write.option("encoding", "ISO-8859-1").option("lineSep", "\x07\x00").text(path))
    return path


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_stitching_over_blocks(spark, block):
    rng = random.Random(block)
    stream = [rng.choice([0, 0, 5, 6, 9]) for _ in range(200)]
    path = flat_files(spark, [stream])
    whole = np.array([*stream, 7])
    ends = np.flatnonzero(whole == 0)
    want = np.diff(np.concatenate(([-1], ends))) - 1
    rest = len(whole) - 1 - ends[-1]  # an open end: tokens after the last separator
    got = sorted((r["ordinal"], r["n_tokens"]) for r in tokens.count(spark, path, 0, block).collect())
    assert got == list(enumerate([*want.tolist(), rest]))


def test_a_document_longer_than_many_blocks(spark):
    path = flat_files(spark, [[5] * 1000 + [0] + [6] * 10 + [0]])
    got = sorted((r["ordinal"], r["n_tokens"]) for r in tokens.count(spark, path, 0, 16).collect())
    assert got == [(0, 1000), (1, 10), (2, 1)]


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, part int, tokens string, value int"
    path = folder(spark, "none")
    manifest = tokens.write_flat(spark.createDataFrame([], schema), path)
    assert tokens.named(tokens.count(spark, path), manifest).count() == 0
    path = folder(spark, "some")
    manifest = tokens.write_flat(spark.createDataFrame([(None, None, 1, "", 2), (None, None, 1, "", 2), (3, "a b", 1, None, 2)], schema), path)
    assert sorted((r["id"] or 0, r["n_tokens"]) for r in tokens.named(tokens.count(spark, path), manifest).collect()) == [
        (0, 0), (0, 0), (3, 2)]


def test_disagreement_is_an_error(spark):
    path = folder(spark, "flat")
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1)
    manifest = tokens.write_flat(docs, path)
    with pytest.raises(Exception, match="differ"):
        tokens.named(tokens.count(spark, path), manifest.where("id = 1")).collect()


def test_pattern_is_the_vocabularys():
    public = pytest.importorskip("public_tokenizers")
    assert tokens.PATTERN == public.PATTERN and pa is not None
