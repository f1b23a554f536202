"""Corpus preparation: language, copies, near copies, benchmark leaks, mixing.

Each stage reads what its predecessor kept, and its decisions take effect. Rows of any
further columns are carried along, whatever their names; the last stage adds one struct
column ``mix``. Defined results are those of the operators: see their docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentaudit.llm import decontaminate, exact, language, mixing, simhash
from agentaudit.llm.common import folder
from agentaudit.session import configure


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus; texts in none of them go.

    The source stands for the host, the ``lang`` column for the declared language.
    """
    model = language.fit(docs)
    places = exact.located(docs, plain_scan=True)
    rows = places.select(F.struct("file", "place").alias("id"), "row.text",
                         F.col("row.lang").alias("declared"), F.col("row.source").alias("host"))
    return exact.without(places, language.identify(rows, model).where("NOT accepted").select("id.*"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.deduplicate(docs, plain_scan=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their SimHash the row with the smallest doc_id stays."""
    return simhash.deduplicate(docs, plain_scan=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix of the sources."""
    placed = mixing.schedule(docs, mixing.shares_by_size(docs), keep_rows=True)
    name = "mix"
    while name in docs.columns:
        name += "_"
    return placed.select("row.*", F.struct("pool", "block", "slot", "in_mix").alias(name))


STAGES = [("language id", language_id), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mix)]

#: A trained model, a graph of fingerprints and a schedule don't fit SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next one."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
