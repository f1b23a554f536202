"""Language identification by Bayesian evidence fusion.

Four kinds of evidence give one posterior per text: the likelihood of its letters
(hashed byte trigrams, naive Bayes), the language its markup declares, and a prior for
its address: counts of languages per host, smoothed towards those of the domain, which
are smoothed towards those of the address suffix, and these towards all rows. The
counts come from grouped aggregation over the text's own verdicts; a row's own verdict
is taken out of its prior, so that no evidence counts twice.

Every label of the table is a language with a trigram model, however rare. The model is
fitted on a bounded sample per label (about twice its part of ``SAMPLE`` rows, or twice
``LEAST`` where that is more; the smallest hashes of id and text, copies once); every
other count covers all rows.
A model takes 128 KB per language, in the driver and in every task.

Skew: counts combine before the shuffle, and the one join of rows with hosts has plain
scans on both sides, which adaptive execution splits for a hot host.

Defined results: a text without letters is ``und`` (undetermined) and rejected, whatever
else is known of it; null texts are such; missing or unknown declarations and addresses
are values of their own; without labelled rows everything is ``und``. Repeated rows are
judged each for itself. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored

BUCKETS = 1 << 14
#: Rows that the labels share as a sample, and what each label may take however many there are.
SAMPLE = 8_000
LEAST = 2_000
UND = "und"
#: Beyond this many trigrams more text adds little: neighbouring trigrams are not independent.
ENOUGH = 100.0
#: Share of a text's trigrams that may come from no language, so that a rare one costs little.
NOISE = 0.1
#: Pseudo-rows that each level of the address prior takes from the level above.
STRENGTH = 10.0
#: Rows times languages that are judged at a time.
CELLS = 1 << 20


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts on end, and where each text's begin (one more at the end).

    Letters are lowered; everything else becomes one space.
    """
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    plain = pc.utf8_trim(pc.replace_substring_regex(low, r"\P{L}+", " "), " ")
    padded = pc.binary_join_element_wise("", plain, "", " ")
    size = np.asarray(pc.binary_length(padded), dtype=np.int64)
    raw = np.frombuffer(b"".join(padded.cast(pa.binary()).to_pylist()), np.uint8).astype(np.uint32)
    ends = np.cumsum(size)
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(len(size) + 1, np.int64)
    code = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761) >> np.uint32(18)
    # A trigram belongs to the text it lies in as a whole.
    inside = np.ones(len(code), bool)
    for back in (1, 2):
        cut = ends - back
        inside[cut[(cut >= 0) & (cut < len(code))]] = False
    kept = np.concatenate(([0], np.cumsum(inside)))
    bounds = np.concatenate(([0], np.minimum(ends, len(code))))
    return code[inside].astype(np.int64), kept[bounds]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # languages x BUCKETS, log probabilities

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood per text and language (with ``und`` last), and trigrams per text."""
        code, bounds = trigrams(texts)
        n = np.diff(bounds)
        found = np.zeros((len(n), len(self.languages) + 1))
        full = n > 0
        for k, w in enumerate(self.weights):
            if full.any():
                found[full, k] = np.add.reduceat(w[code], bounds[:-1][full])
        found[:, -1] = -n * np.log(BUCKETS)
        return found, n


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        sample: int = SAMPLE) -> Model:
    """Trigram model of every label, from its rows with the smallest hashes."""
    label = F.lower(F.trim(F.col(f"`{label_col}`").cast("string")))
    rows = labelled.select(
        label.alias("label"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")).alias("order"),
    ).where("label IS NOT NULL AND label != '' AND text IS NOT NULL")
    held = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # a row per language
    each = max(sample // max(1, len(held)), LEAST)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows_in: dict[str, int] = {}
        for batch in slices(batches, "text", 4 << 20):
            code, bounds = trigrams(batch.column("text"))
            for name, a, b in zip(batch.column("label").to_pylist(), bounds[:-1], bounds[1:]):
                totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                totals[name] += np.bincount(code[a:b], minlength=BUCKETS)
                rows_in[name] = rows_in.get(name, 0) + 1
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(at) + 1), pa.string()), pa.array([-1, *at], pa.int32()),
                 pa.array([rows_in[name], *total[at]], pa.int64())], names=["label", "code", "n"])

    # Only about twice the sample of a label leaves the scan, from however many partitions. A
    # label that gives less than its sample, because many rows are copies, is taken again from
    # a larger share.
    shares = {k: min(1.0, 2 * each / n) for k, n in held.items()}
    found: dict[str, np.ndarray] = {}
    while shares:
        limits = labelled.sparkSession.createDataFrame(
            [(k, int(share * (1 << 40))) for k, share in shares.items()], "label string, limit long")
        picked = (rows.join(F.broadcast(limits), "label").where(F.shiftrightunsigned("order", 24) < F.col("limit"))
                  .groupBy("label", "order").agg(F.first("text").alias("text")))  # copies count once
        part = picked.select("label", "text").mapInArrow(count, "label string, code int, n long").groupBy(
            "label", "code").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS + 1 rows per label
        names = pa.array(list(shares), pa.string())
        dense = np.zeros((len(shares), BUCKETS + 1))
        dense[np.asarray(pc.index_in(part["label"], value_set=names)), np.asarray(part["code"])] = np.asarray(part["n"])
        found |= {k: v[:-1] for k, v in zip(shares, dense)}
        # The last place holds the number of rows (code -1).
        shares = {k: min(1.0, 8 * shares[k]) for k, v in zip(shares, dense)
                  if shares[k] < 1 and v[-1] < min(each, held[k])}
    languages = tuple(sorted(k for k, v in found.items() if v.any()))
    counts = np.array([found[k] for k in languages]).reshape(len(languages), BUCKETS)
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return Model(languages, np.log((1 - NOISE) * share + NOISE / BUCKETS))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def declared_in(html: Column) -> Column:
    """Primary subtag of the document's ``lang`` attribute."""
    return F.lower(F.regexp_extract(html, r"""(?i)<html[^>]*?\slang\s*=\s*["']?([A-Za-z]+)""", 1))


def text_in(html: Column) -> Column:
    """The text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&[a-zA-Z0-9#]+;", " ")


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """Language and posterior per row.

    ``rows`` has ``id`` (of any type), ``text``, ``declared`` and ``host``. Gives id,
    language, posterior, text_language, n_trigrams, accepted.
    """
    languages, k = model.languages, len(model.languages)
    known = F.coalesce(F.lower(F.col("declared").cast("string")), F.lit(""))
    ready = rows.select(
        "id", F.col("text").cast("string").alias("text"),
        F.when(known.isin(list(languages)) | (known == ""), known).otherwise("?").alias("declared"),
        F.coalesce(F.lower(F.col("host").cast("string")), F.lit("")).alias("host"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            found, n = model.scores(batch.column("text"))
            damped = found / (1.0 + n / ENOUGH)[:, None]
            best = np.where(n > 0, found.argmax(axis=1), k)
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(damped.tolist(), pa.list_(pa.float64())),
                 pa.array(best, pa.int32()), pa.array(n, pa.int64())],
                names=[*rest, "evidence", "best", "n_trigrams"])

    schema = T.StructType([*[f for f in ready.schema.fields if f.name != "text"],
                           T.StructField("evidence", T.ArrayType(T.DoubleType())),
                           T.StructField("best", T.IntegerType()), T.StructField("n_trigrams", T.LongType())])
    scored = stored(ready.mapInArrow(score, schema), "language-scores")

    # Verdicts by text alone, counted at every level of the address: a row per verdict that occurs.
    votes = stored(
        scored.groupBy("host", "best").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
        .withColumn("domain", F.when(F.col("domain") == "", F.col("host")).otherwise(F.col("domain")))
        .withColumn("suffix", F.substring_index("host", ".", -1)), "votes")

    def level(name: str, *more: str) -> DataFrame:
        each = votes.groupBy(name, *more, "best").agg(F.sum("n").alias("n"))
        return stored(each.groupBy(name, *more).agg(
            F.collect_list(F.struct("best", "n")).alias(f"{name}_votes")), f"{name}-votes")

    addresses = stored(
        level("host", "domain", "suffix").join(level("domain"), "domain").join(level("suffix"), "suffix")
        .select("host", "host_votes", "domain_votes", "suffix_votes"), "addresses")
    overall = np.zeros(k + 1)
    for r in votes.groupBy("best").agg(F.sum("n").alias("n")).collect():  # one number per language
        overall[r["best"]] = r["n"]
    base = (overall[:k] + 1) / (overall[:k].sum() + k)
    # P(declared | language), add-one smoothed; (languages + 1) squared numbers. A missing
    # declaration says nothing.
    values = [*languages, "?"]
    row_of = {v: i for i, v in enumerate(values)}
    table = np.ones((len(values), k + 1))
    for r in scored.where("declared != ''").groupBy("declared", "best").agg(F.count(F.lit(1)).alias("n")).collect():
        table[row_of[r["declared"]], r["best"]] += r["n"]
    declared_log = np.concatenate((np.zeros((1, k)), np.log(table / table.sum(axis=0))[:, :k]))
    labels = np.array([*languages, UND], object)

    def counted(lists: pa.Array) -> np.ndarray:
        """Votes per row and language from lists of (best, n)."""
        best, n = lists.flatten().flatten()
        dense = np.zeros((len(lists), k + 1))
        at = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
        dense[at, np.asarray(best)] = np.asarray(n)
        return dense[:, :k]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // (k + 1))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                size, best = batch.num_rows, np.asarray(batch.column("best"))
                own = np.zeros((size, k + 1))
                own[np.arange(size), best] = 1
                own = own[:, :k]
                # Prior: host over domain over suffix over all rows, without the row's own vote.
                p = np.tile(base, (size, 1))
                for name in ("suffix_votes", "domain_votes", "host_votes"):
                    held = counted(batch.column(name)) - own
                    p = (held + STRENGTH * p) / (held.sum(axis=1, keepdims=True) + STRENGTH)
                says = np.asarray(pc.index_in(batch.column("declared"), value_set=pa.array(["", *values])))
                scores = np.asarray(batch.column("evidence").flatten()).reshape(size, k + 1).copy()
                scores[:, :k] += declared_log[says] + np.log(p)
                # A text in no language: any declaration is as likely, and such texts are rare.
                scores[:, k] += np.where(says == 0, 0.0, np.log(1.0 / len(values))) + np.log(0.01)
                n = np.asarray(batch.column("n_trigrams"))
                top = np.where(n > 0, scores.argmax(axis=1), k)
                spread = np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
                posterior = np.where(n > 0, 1.0 / spread, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(labels[top], pa.string()), pa.array(posterior),
                     pa.array(labels[best], pa.string()), batch.column("n_trigrams"),
                     pa.array((top < k) & (posterior >= 0.5))],
                    names=["id", "language", "posterior", "text_language", "n_trigrams", "accepted"])

    return scored.join(addresses, "host").select(
        "id", "declared", "best", "n_trigrams", "evidence", "host_votes", "domain_votes", "suffix_votes",
    ).mapInArrow(judge, T.StructType([
        scored.schema["id"], T.StructField("language", T.StringType()), T.StructField("posterior", T.DoubleType()),
        T.StructField("text_language", T.StringType()), T.StructField("n_trigrams", T.LongType()),
        T.StructField("accepted", T.BooleanType())]))
