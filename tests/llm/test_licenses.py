"""Canonical forms and whole-text digests."""

import textwrap

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agentaudit.llm import licenses
from agentaudit.llm.queries import ORACLES


def scan(spark, texts, known=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(docs, licenses.known_digests(spark) if known is None else known)
    return [(r["whole"], r["lines"]) for r in found.orderBy("id").collect()]


def test_variants_of_one_license(spark):
    mit = licenses.MIT
    variants = [mit, "MIT License\r\n\r\nCopyright (c) 2020 Some Body\r\n\r\n" + mit.replace("\n", "\r\n"),
                "(c) 1999 X\n" + mit.upper().replace(".", " . "), mit.replace("sublicense", "sublicence").replace("\n", " \n\t"),
                mit.replace('"Software"', "``Software''"), "© 2001 A\nAll rights reserved.\n" + mit]
    assert scan(spark, variants) == [(["MIT"], [])] * len(variants)
    changed = [mit.replace("without restriction", "with restriction"), mit + "\nMore.", mit[:-10], "x " + mit]
    assert scan(spark, changed) == [([], [])] * len(changed)
    assert scan(spark, [licenses.ISC, "zlib license\n" + licenses.ZLIB]) == [(["ISC"], []), (["Zlib"], [])]


def test_lines_and_whole_texts(spark):
    notice = "Licensed under the Apache Licence, version 2.0!"
    texts = ["Some text.\n" + notice + "\nMore text.\n" + notice, notice, "Released under the MIT License.\rLicensed under CC BY-NC 4.0",
             "was Licensed under the Apache License, Version 2.0 by us"]
    assert scan(spark, texts) == [([], ["Apache-2.0"]), (["Apache-2.0"], ["Apache-2.0"]), ([], ["CC-BY-NC-4.0", "MIT"]), ([], [])]


@pytest.mark.parametrize("text", [None, "", "\n\n", "!!!", "Copyright 2020 A", "x" * 300_000, "a\n" * 50_000])
def test_nothing_found(spark, text):
    assert scan(spark, [text]) == [([], [])]


def test_own_table_several_names_and_edges(spark):
    known = licenses.known_digests(spark, [("A", "some terms"), ("B", "Some  terms."), ("A", "some terms")])
    assert scan(spark, ["SOME TERMS"], known) == [(["A", "B"], ["A", "B"])]
    assert scan(spark, ["SOME TERMS"], known.limit(0)) == [([], [])]
    schema = "doc_id long, text string, license string, digest int, at int"
    docs = spark.createDataFrame([(None, "some terms", "l", 1, 2)] * 2, schema)
    assert [tuple(r) for r in licenses.scan(docs, known, broadcast_rows=0).select("id", "whole").collect()] == [(None, ["A", "B"])] * 2
    assert licenses.scan(spark.createDataFrame([], schema), known).count() == 0


def test_spellings_are_canonical(spark):
    kept = set(licenses.SPELLINGS.values())
    assert not kept & set(licenses.SPELLINGS)
    row = spark.range(1).select(licenses.canonical(F.lit("The LICENCE, whilst organisation-wide")).alias("c")).first()
    assert row["c"] == "the license while organization wide"


NOTICES = ["", "Copyright (c) 2020 Some Body and a Company of a Long Name", "copyright jane doe", "© 1999-2003 A. B.",
           "(c) 2001 X. All rights reserved.", "Copyright 2011 " + ", ".join(f"Author Number {i} of Some Place" for i in range(40))]
WIDTHS = [20, 40, 50, 60, 68, 72, 76, 80, 100, 100_000]
TEXTS = [("MIT", licenses.MIT), ("ISC", licenses.ISC), ("Zlib", licenses.ZLIB), ("BSD-2-Clause", licenses.BSD_2),
         ("BSD-3-Clause", licenses.BSD_3)]


def wrapped(text):
    """The text at any width, after a notice on lines of its own or on the licence's lines."""
    filled = lambda t, w: textwrap.fill(" ".join(t.split()), w)
    return ([filled(f"{n} {text}", w) for n in NOTICES for w in WIDTHS]
            + [f"{n}\n{filled(text, w)}" for n in NOTICES for w in WIDTHS]
            + [f"{filled(n, w)}\n\n{text}" for n in NOTICES for w in (30, 60)])


@pytest.mark.parametrize("name, text", TEXTS)
def test_known_texts_at_any_width(spark, name, text):
    texts = wrapped(text)
    assert [whole for whole, _ in scan(spark, texts)] == [[name]] * len(texts)


def test_the_twin_follows_the_same_rule(spark):
    texts = [t for _, text in TEXTS for t in wrapped(text)]
    texts += [licenses.MIT + "\ncopyright holders must be paid.", "Copyright Some Body\n" + licenses.MIT,
              "Copyright Notice\n" + licenses.MIT, "All rights reserved\n" + licenses.ZLIB, "x " + licenses.ISC, "c d", "",
              "The MIT License (MIT) Copyright (c) 2020 X " + licenses.MIT, "Licensed under CC BY-NC 4.0\n© x"]
    con = duckdb.connect()
    table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    con.register("documents", table)
    want = con.sql(f"select doc_id, whole_text, line_notices from ({ORACLES['op10_license_scan']}) order by 1").fetchall()
    got = scan(spark, texts)
    assert [(",".join(whole), ",".join(lines)) for whole, lines in got] == [tuple(r[1:]) for r in want]


def test_body_lines_that_begin_with_copyright_stay(spark):
    changed = licenses.MIT + "\ncopyright holders must be paid."
    assert scan(spark, [changed, "Copyright Some Body\n" + licenses.MIT]) == [([], []), (["MIT"], [])]


def test_texts_from_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("Own licence.\nDo as you like.")
    known = licenses.known_digests(spark, licenses.from_folder(str(tmp_path)))
    assert scan(spark, ["OWN LICENSE: do as you like", licenses.MIT], known) == [(["Own-1.0"], ["Own-1.0"]), ([], [])]
