"""The corpus pipeline, stage by stage, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from agentaudit.llm import mixing
from agentaudit.llm.common import folder
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_simhash import brute_query as components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, as (doc_id, text) dictionaries."""
    sf = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    read = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    before = read(docs)
    for name, stage in pipeline.STAGES:
        path = folder(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        after = read(docs)
        out.append((name, before, after, docs))
        before = after
    return out


def test_stages_are_named_and_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["language id", "exact dedup", "near dedup", "decontamination", "mixing"]


def test_columns(stages):
    for name, _, _, docs in stages[:-1]:
        assert docs.columns == COLUMNS, name
    assert stages[-1][3].columns == [*COLUMNS, "mix"]


def test_language_keeps_clean_documents(stages):
    _, before, after, _ = stages[0]
    gone = [before[i] for i in before.keys() - after.keys()]
    # What goes has hardly a letter between its other characters.
    assert len(gone) <= 0.02 * len(before)
    assert all(sum(c.isalpha() for c in t) < 0.7 * len(t) or len(t) < 40 for t in gone)


def test_exact_dedup(stages):
    _, before, after, _ = stages[1]
    latest = {}
    for i, t in before.items():
        latest[t] = max(i, latest.get(t, i))
    assert after == {i: t for t, i in latest.items()}


def test_near_dedup(stages):
    _, before, after, _ = stages[2]
    assert set(after) == {i for i, _, head in components(before.items()) if i == head}


def test_decontamination(stages, spark):
    _, before, after, _ = stages[3]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    assert set(after) == {i for i, _, hit, _ in leaks(before.items(), items) if not hit}


def test_mixing_keeps_all_rows_in_schedule(stages):
    _, before, after, docs = stages[4]
    assert before == after
    got = docs.select("mix.*").distinct().collect()
    present = mixing.shares_by_size(stages[3][3])
    assert set(present) == {r["pool"] for r in got}
    place = {(s, k): slot for s, k, slot, _, _ in mixing.period(present)}
    q = sum(present.values())
    for r in got:
        w = present[r["pool"]]
        assert r["slot"] == r["block"] // w * q + place[r["pool"], r["block"] % w]


def test_run_equals_its_stages(stages, spark):
    got = {tuple(r) for r in pipeline.run(spark, "/root/testdata/sf0.01").select("doc_id", "mix.slot").collect()}
    assert got == {tuple(r) for r in stages[-1][3].select("doc_id", "mix.slot").collect()}


@pytest.mark.parametrize("rows", [0, 6])
def test_stages_take_nulls_ties_and_further_columns(spark, sf, rows):
    text = "The words of the and to that is with this from there and then the others are with us."
    data = [(None, None, None, None, None, "m", 1), (1, text, "en", "src0", 5, None, 2), (1, text, "en", "src0", 5, None, 2),
            (1, text + " More of the words.", None, None, None, "m", None), (2, "", "de", "", 0, "m", 3),
            (3, text * 500, "en", "src1", None, None, None)][:rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, mix string, file int"
    docs = spark.createDataFrame(data, schema)
    for _, stage in pipeline.STAGES:
        columns = docs.columns
        path = folder(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.columns == [*columns, "mix_"]
    left = sorted(docs.select("doc_id", F.length("text")).collect())
    if rows:
        assert [tuple(r) for r in left if r[1] < 1000] in ([(1, len(text))], [(1, len(text)), (1, len(text) + 19)])
        assert sum(r[0] == 3 for r in left) == 1
    else:
        assert left == []
