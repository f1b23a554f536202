"""One query per operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import (align, decontaminate, exact, language, licenses, lm, mixing, pieces, search, secrets, simhash,
               substrings, tokens)
from .common import folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark, sf_dir):
    """Every document with the copy that stays for its text."""
    places = exact.located(table(spark, sf_dir, "documents"), plain_scan=True)
    return exact.members(places).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        "kept", F.col("digest").alias("text_sha256"))


ORACLES["op1_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""


@query
def op2_lm_score(spark, sf_dir):
    """Scores of every document under the word-count base and the trained model."""
    return lm.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_token_counts(spark, sf_dir):
    """Tokens of every document, counted in flat token files."""
    path = folder(spark, "flat")
    manifest = tokens.write_flat(table(spark, sf_dir, "documents"), path, plain_scan=True)
    return tokens.named(tokens.count(spark, path), manifest).withColumnRenamed("id", "doc_id")


@query
def op4_decontamination(spark, sf_dir):
    """Words and items of the benchmark found in every document."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
        decontaminate.covered(F.col("hits")).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


ORACLES["op4_decontamination"] = """
with docs as (
 select doc_id, row_number() over () as r, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
 from documents),
items as (
 select coalesce(cast(item_id as varchar), 'null') as item, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
 from benchmark),
starts as (
 select item, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
 from items where len(w) > 0),
grams as (select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as gram from starts),
lengths as (select distinct n from grams),
places as (
 select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, lengths where len(w) >= n),
hits as (
 select r, i, p.n, item from (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as gram from places) p
 join grams using (gram) where p.n = grams.n),
words as (select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + n)) as k from hits) group by r),
found as (select r, count(*) as n_items, string_agg(item, ',' order by item) as list
          from (select distinct r, item from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join found using (r)
"""


@query
def op5_secrets(spark, sf_dir):
    """Secrets in every document: counts of the base kinds, and all spans."""
    base = [r.name for r in secrets.BASE]
    found = secrets.find(table(spark, sf_dir, "documents"))
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        F.col("id").alias("doc_id"),
        *[secrets.count(F.col("spans"), k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.listed(of_base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query
def op6_language_id(spark, sf_dir):
    """Language of every page from its text, declaration and address."""
    model = language.fit(table(spark, sf_dir, "documents"))
    html = F.coalesce("html", F.lit(""))
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), language.text_in(html).alias("text"),
        language.declared_in(html).alias("declared"), language.host_of(F.col("url")).alias("host"))
    found = language.identify(pages, model)
    return found.withColumnRenamed("id", "page_id").withColumn("posterior", F.round("posterior", 6))


@query
def op7_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    _, found = simhash.near_duplicates(table(spark, sf_dir, "documents"), plain_scan=True)
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_mixing(spark, sf_dir):
    """Block and slot of every document in a mix of all sources, with shares by their sizes."""
    docs = table(spark, sf_dir, "documents")
    return mixing.schedule(docs, mixing.shares_by_size(docs)).withColumnRenamed("id", "doc_id")


@query
def op9_substring_dedup(spark, sf_dir):
    """Every document without the 35-word windows that occur twice."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op10_license_scan(spark, sf_dir):
    """Licences that are a document's entire text, and licences of single lines."""
    found = licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))
    return found.select(F.col("id").alias("doc_id"), F.array_join("whole", ",").alias("whole_text"),
                        F.array_join("lines", ",").alias("line_notices"))


@query
def op11_token_alignment(spark, sf_dir):
    """Tokens of two vocabularies aligned in every document, with the counts of their pairs."""
    found, _ = align.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        digest.alias("groups_sha256"))


@query
def op12_piece_encoding(spark, sf_dir):
    """Pieces of every document and the text they decode to."""
    found = pieces.encode(table(spark, sf_dir, "documents"), decoded=True)
    return found.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_lexical_search(spark, sf_dir):
    """The ten best documents for every item of the benchmark."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

ORACLES["op13_lexical_search"] = f"""
with docs as (select doc_id, row_number() over () as r, {_TERMS} as w from documents),
totals as (select count(*) filter (where len(w) > 0) as n_docs, cast(sum(len(w)) as bigint) as n_terms from docs),
sizes as (select r, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms as m from docs, totals where len(w) > 0),
tfs as (select r, term, count(*) as tf from (select r, unnest(w) as term from docs) group by r, term),
weights as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as weight
            from tfs, totals group by term, n_docs),
items as (select q, item_id, term, count(*) as repeats
          from (select row_number() over () as q, item_id, unnest({_TERMS}) as term from benchmark)
          group by q, item_id, term),
scores as (select q, item_id, r, cast(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
           from items join weights using (term) join tfs using (term) join sizes using (r) group by q, item_id, r)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select item_id, doc_id, score,
             row_number() over (partition by q order by score desc, doc_id nulls last) as rank
      from scores join sizes using (r) where score > 0)
where rank <= 10
"""


def _values(rows) -> str:
    quoted = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


# The schedule is built slot by slot: of the released blocks the one due first.
ORACLES["op8_mixing"] = f"""
with recursive src as (
 select doc_id, source as pool, length(coalesce(text, '')) as chars,
        md5(concat(coalesce(cast(doc_id as varchar), ''), ':', md5(coalesce(text, '')))) as key
 from documents),
numbered as (
 select *, cast(sum(chars) over (partition by pool order by key, chars rows unbounded preceding)
               - chars as bigint) // 65536 as block
 from src),
sizes as (select pool, pow(cast(sum(chars) as double), {mixing.POWER}) as size from src group by pool),
shares as (select pool, greatest(1, cast(floor({mixing.PARTS} * size / (select sum(size order by size) from sizes) + 0.5) as bigint)) as w from sizes),
all_shares as (select list(pool order by pool nulls first) as p, list(w order by pool nulls first) as w, cast(sum(w) as bigint) as q from shares),
plan as (
 select cast(-1 as bigint) as slot, cast(null as struct(d bigint, i bigint, k bigint, r bigint)) as c, list_transform(w, lambda x: cast(0 as bigint)) as ks from all_shares
 union all
 select slot + 1, c, list_transform(ks, lambda x, j: x + cast(j = c.i as bigint))
 from (select slot, ks, list_min(list_filter(
   list_transform(range(1, len(p) + 1), lambda i: {{'d': ((ks[i] + 1) * q + w[i] - 1) // w[i], 'i': i, 'k': ks[i], 'r': ks[i] * q // w[i]}}),
   lambda s: s.r <= slot + 1)) as c from plan, all_shares where slot + 1 < q)),
places as (select p[c.i] as pool, c.k as k, slot as place, c.r as r, c.d as d from plan, all_shares where slot >= 0),
placed as (
 select n.*, n.block // w as round, q, place, r, d
 from numbered n join shares s on s.pool is not distinct from n.pool
 join places x on x.pool is not distinct from n.pool and x.k = n.block % s.w, all_shares a(p0, w0, q)),
lasts as (select pool, greatest(sum(chars) - 1, 0) // 65536 as block from src group by pool),
ends as (select min((l.block // s.w) * q + place) as e from lasts l join shares s on s.pool is not distinct from l.pool
         join places x on x.pool is not distinct from l.pool and x.k = l.block % s.w, all_shares a(p0, w0, q))
select doc_id, pool, chars, block, round * q + r as release, round * q + d as deadline,
       round * q + place as slot, round * q + place <= (select e from ends) as in_mix
from placed
"""


def _canonical(text: str) -> str:
    out = f"trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for spelling, kept in licenses.SPELLINGS.items():
        out = f"regexp_replace({out}, '\\b{spelling}\\b', '{kept}', 'g')"
    return out


_NOTICE = (f"(regexp_matches(line, '{licenses.SIGNED}') or (regexp_matches(line, '{licenses.NAMED}')"
           f" and not regexp_matches(line, '{licenses.UNNAMED}')))")

ORACLES["op10_license_scan"] = f"""
with texts as (
 select 'doc' as kind, row_number() over () as r, coalesce(text, '') as text, doc_id, null as license from documents
 union all
 select 'known', row_number() over (), text, null, license from (values {_values(licenses.KNOWN)}) t(license, text)),
cut as (select *, regexp_split_to_array(text, '\r\n|\r|\n') as l from texts),
raw as (select kind, r, i, l[i] as line from (select kind, r, l, unnest(range(1, len(l) + 1)) as i from cut)),
lines as (select * from (select kind, r, i, case when {_NOTICE} then '' else {_canonical("line")} end as form from raw)
          where form != ''),
wholes as (select kind, r, string_agg(form, ' ' order by i) as form from lines group by kind, r),
opened as (select kind, r, regexp_replace({_canonical("text")}, '{licenses.LEADING}', '\\1\\2') as form from texts
           where kind = 'doc' and regexp_matches(text, '{licenses.opened()}') and regexp_matches(text, '{licenses.MARKED}')),
known as (select distinct license, form from wholes join texts using (kind, r) where kind = 'known'),
whole as (select r, string_agg(license, ',' order by license) as names
          from (select distinct r, license from (select * from wholes union all select * from opened) join known using (form)
                where kind = 'doc') group by r),
notes as (select r, string_agg(license, ',' order by license) as names
          from (select distinct r, license from lines join known using (form) where kind = 'doc') group by r)
select t.doc_id, coalesce(whole.names, '') as whole_text, coalesce(notes.names, '') as line_notices
from texts t left join whole using (r) left join notes using (r)
where t.kind = 'doc'
"""
