"""Language identification: accuracy, evidence, defined results."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agentaudit.llm import language


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents.where("doc_id % 2 = 0"))


def rows(df):
    return df.select(F.col("doc_id").alias("id"), "text", F.lit(None).cast("string").alias("declared"),
                     F.lit(None).cast("string").alias("host"))


def test_trigrams_stay_inside_their_text():
    code, bounds = language.trigrams(pa.array(["Ab", None, "", "ab", "!!", "a b, c"]))
    parts = [code[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert parts[0] == parts[3] and len(parts[0]) == 2 and parts[1] == parts[2] == parts[4] == []
    assert len(parts[5]) == 5
    again, bounds = language.trigrams(pa.array(["a b, c"]))
    assert again.tolist() == parts[5]


def test_held_out_accuracy(documents, model):
    held = documents.where("doc_id % 2 = 1")
    found = language.identify(rows(held), model).join(held.select(F.col("doc_id").alias("id"), "lang"), "id")
    good, n, accepted = found.agg(F.avg((F.col("language") == F.col("lang")).cast("double")), F.count("*"),
                                  F.avg(F.col("accepted").cast("double"))).first()
    assert n == 500 and good > 0.97 and accepted > 0.97


def test_weak_text_follows_declaration_and_host(spark, documents, model):
    spoken = documents.where("lang IN ('de', 'fr')").select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"),
        F.concat(F.lit("www.site-"), "lang", F.lit(".example.com")).alias("host"))
    probe = spark.createDataFrame(
        [(-1, "xq", "de", "a.b"), (-2, "xq", "fr", "a.b"), (-3, "xq", None, "www.site-fr.example.com"),
         (-4, "xq", None, "WWW.site-de.example.com")], "id long, text string, declared string, host string")
    got = {r["id"]: r["language"] for r in language.identify(spoken.unionByName(probe), model).where("id < 0").collect()}
    assert got == {-1: "de", -2: "fr", -3: "fr", -4: "de"}


def test_posterior_by_hand(spark):
    """Two languages, one host: the whole formula again in numpy."""
    weights = np.log(np.full((2, language.BUCKETS), 1 / language.BUCKETS))
    code, _ = language.trigrams(pa.array(["aaa"]))
    weights[1, code] += 0.5
    model = language.Model(("l0", "l1"), weights)
    data = spark.createDataFrame([(1, "aaa", "l0", "h.x"), (2, "bbb", "", "h.x"), (3, "bbb", "zz", "k.x")],
                                 "id long, text string, declared string, host string")
    got = {r["id"]: r for r in language.identify(data, model).collect()}
    # Row 1 votes l1; rows 2 and 3 tie, the first language wins.
    best = [1, 0, 0]
    base = np.array([2 + 1, 1 + 1]) / 5
    declared = {("l0", 1): 1, ("?", 0): 1}
    values = ["l0", "l1", "?"]
    own = np.array([0.0, 1.0])
    p = base
    for votes in (np.array([2, 1]), np.array([1, 1]), np.array([1, 1])):  # suffix x, domain h.x, host h.x
        p = (votes - own + language.STRENGTH * p) / (votes.sum() - 1 + language.STRENGTH)
    n = 3
    damp = 1 + n / language.ENOUGH
    text = np.array([weights[k, code].sum() for k in (0, 1)]) / damp
    says = np.log([(declared.get(("l0", k), 0) + 1) / (sum(declared.get((v, k), 0) for v in values) + 3) for k in (0, 1)])
    scores = np.concatenate((text + says + np.log(p), [-n * np.log(language.BUCKETS) / damp + np.log(1 / 3) + np.log(0.01)]))
    assert got[1]["posterior"] == pytest.approx(1 / np.exp(scores - scores.max()).sum(), rel=1e-9)
    assert got[1]["language"] == ("l0", "l1", "und")[scores.argmax()] and best[0] == 1


def test_defined_results(spark, model):
    schema = "id long, text string, declared string, host string, best int, evidence string"
    data = spark.createDataFrame([(1, None, "de", "a.com", 1, ""), (2, "", "fr", None, 1, ""), (3, "!!! 123", None, "", 1, ""),
                                  (None, "the the and the of the", "garbage", "::", None, None)] * 2, schema)
    got = sorted((r["id"] or 0, r["language"], r["accepted"]) for r in language.identify(data, model).collect())
    assert got == [(0, "en", True)] * 2 + [(i, "und", False) for i in (1, 1, 2, 2, 3, 3)]
    assert language.identify(spark.createDataFrame([], schema), model).count() == 0
    nothing = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["language"] for r in language.identify(data, nothing).collect()} == {"und"}


def test_page_parts(spark):
    html = '<!doctype html><HTML class="x" LANG = "de-AT"><style>p{}</style><p>Ein &amp; Wort</p><script>var t="</p>"</script><!-- no -->'
    row = spark.range(1).select(
        language.declared_in(F.lit(html)).alias("d"), F.trim(F.regexp_replace(language.text_in(F.lit(html)), r"\s+", " ")).alias("t"),
        *[language.host_of(F.lit(u)).alias(f"h{i}") for i, u in enumerate(
            ["https://User:pw@WWW.Example.org:8080/a?b", "ftp://x", "no url", "http:///p"])]).first()
    assert tuple(row) == ("de", "Ein Wort", "www.example.org", "x", "", "")


def test_query_is_right_about_pages(spark):
    from agentaudit.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", language.declared_in(F.col("html")).alias("declared"))
    found = QUERIES["op6_language_id"](spark, sf).join(pages, "page_id")
    assert found.count() == pages.count()
    assert found.where("language != declared").count() <= 0.02 * pages.count()


def test_rare_labels_and_many_labels_have_models(spark):
    """A script of its own in 20 of 20,020 rows, and 80 further scripts."""
    text = lambda first, i: " ".join(chr(first + (i * 7 + j * j) % 20) * 3 for j in range(12))
    data = [(i, "the words of the and to that is with this from there", "en") for i in range(20_000)]
    data += [(20_000 + i, text(0x3B1, i), "el") for i in range(20)]
    data += [(30_000 + 5 * m + i, text(0x4E00 + 32 * m, i), f"l{m:02}") for m in range(80) for i in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(8)
    model = language.fit(docs)
    assert set(model.languages) == {"en", "el", *(f"l{m:02}" for m in range(80))}
    found = language.identify(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"),
                                          F.lit(None).cast("string").alias("host")), model)
    wrong = found.join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").where("language != lang OR NOT accepted")
    assert wrong.count() == 0


def test_sample_stays_whole_among_empty_labels_and_repeated_ids(spark):
    """Labelled rows are few among all; all ids are equal, and most rows are copies."""
    text = lambda first, i: " ".join(chr(first + (i * 7 + j * j) % 20) * 3 for j in range(12))
    unlabelled = spark.range(400_000).selectExpr("id as doc_id", "'words' as text", "'' as lang")
    few = spark.createDataFrame([(i, text(0x3B1, i), "el") for i in range(10)], "doc_id long, text string, lang string")
    assert language.fit(unlabelled.unionByName(few)).languages == ("el",)
    for same in range(4):
        copies = spark.range(60_000).selectExpr(f"{same}L as doc_id", "'the same words' as text", "'en' as lang")
        others = spark.range(50).selectExpr(f"{same}L as doc_id", "concat('zebra ', repeat('q', int(id))) as text", "'en' as lang")
        model = language.fit(copies.unionByName(others))
        assert model.languages == ("en",)
        # 'zeb' is in 50 of 51 distinct texts.
        code, _ = language.trigrams(pa.array(["zeb"]))
        rest, _ = language.trigrams(pa.array(["sam"]))
        assert model.weights[0, code].sum() > model.weights[0, rest].sum()
