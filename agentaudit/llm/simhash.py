"""Near duplicates by 64-bit SimHash and a self-join of the binary trie of fingerprints.

Fingerprints come from one pass over the texts. The trie of the distinct fingerprints
is joined with itself by going down node pairs: the differing bits of the two prefixes
add up, and a pair is dropped as soon as they exceed the budget. Spark does the upper
levels, four bits a round, on node counts alone: pairs with more fingerprints than
``group`` are split further, so a crowded corner of the trie becomes many small pairs.
Each remaining pair is one group of at most ``group`` fingerprints, whose sub-tries are
walked in numpy; it returns a spanning forest of its links, not the links themselves.
Components follow from those edges.

Copies share one fingerprint and enter the trie once. Defined results: a null text is
empty; texts without words have fingerprint zero, linked like any other; a text of
fewer words than a shingle is one shingle; the smallest id ignores nulls; repeated rows
count as rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored
from .components import components
from .exact import located, without

SEED = 42
BITS = 64
STRIDE = 4
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit by bit the majority of the shingles' XXH64, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        raw = b"".join([digest(joined[a:b], SEED)
                        for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(rows: DataFrame, shingle: int = 3) -> DataFrame:
    """``rows`` with column ``text`` replaced by ``fp``, the fingerprint as a signed long."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")),
                                np.uint64, batch.num_rows).view(np.int64)
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(found)], names=[*rest, "fp"])

    fields = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(scan, T.StructType([*fields, T.StructField("fp", T.LongType())]))


def prefix(column: str, depth: int) -> Column:
    return F.shiftrightunsigned(column, BITS - depth) if depth else F.lit(0).cast("long")


def node_pairs(nodes_at, budget: int, group: int) -> DataFrame:
    """Pairs of trie nodes within the budget, each with at most ``group`` fingerprints.

    ``nodes_at(depth)`` gives (node, n). A node may be paired with itself.
    """
    root = nodes_at(0)
    pairs = root.select(F.lit(0).alias("depth"), F.col("node").alias("a"), F.col("node").alias("b"),
                        F.col("n").alias("size"))
    done = None
    for depth in range(0, BITS + 1, STRIDE):
        # A single fingerprint with itself has no link to offer.
        pairs = stored(pairs.where("a != b OR size > 1"), "node-pairs")
        few = pairs.where(F.col("size") <= group) if depth < BITS else pairs
        done = few if done is None else done.unionByName(few)
        if depth == BITS or pairs.where(F.col("size") > group).isEmpty():
            return done
        below = nodes_at(depth + STRIDE)
        left = below.select(F.shiftrightunsigned("node", STRIDE).alias("a"), F.col("node").alias("x"),
                            F.col("n").alias("nx"))
        right = left.toDF("b", "y", "ny")
        pairs = (
            pairs.where(F.col("size") > group).join(left, "a").join(right, "b")
            .where((F.col("a") != F.col("b")) | (F.col("x") <= F.col("y")))
            .where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= budget)
            .select(F.lit(depth + STRIDE).alias("depth"), F.col("x").alias("a"), F.col("y").alias("b"),
                    F.when(F.col("x") == F.col("y"), F.col("nx")).otherwise(F.col("nx") + F.col("ny")).alias("size"))
        )
    return done


def _pairs(alo, ahi, blo, bhi):
    """All index pairs of the given range pairs."""
    wide, high = bhi - blo, ahi - alo
    per = wide * high
    owner = np.repeat(np.arange(len(per)), per)
    step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return alo[owner] + step // wide[owner], blo[owner] + step % wide[owner]


def walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, budget: int,
         small: int = 32, chunk: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted ``a`` and ``b`` within ``budget`` bits; below ``depth`` all agree but for the two prefixes."""
    shift = np.uint64(BITS - depth)
    start = bin(int(a[0]) >> int(shift) ^ int(b[0]) >> int(shift)).count("1") if depth else 0
    ones = {}

    def cumulated(bit):
        if bit not in ones:
            at = np.uint64(BITS - 1 - bit)
            ones[bit] = [np.concatenate(([0], np.cumsum((v >> at & np.uint64(1)).astype(np.int64)))) for v in (a, b)]
        return ones[bit]

    stack = [(depth, *(np.array([v]) for v in (0, len(a), 0, len(b), start)))]
    while stack:
        bit, alo, ahi, blo, bhi, dist = stack.pop()
        if len(alo) > chunk:
            half = len(alo) // 2
            stack += [(bit, *(v[:half] for v in (alo, ahi, blo, bhi, dist))),
                      (bit, *(v[half:] for v in (alo, ahi, blo, bhi, dist)))]
            continue
        little = (ahi - alo) * (bhi - blo) <= small
        if bit == BITS:
            little[:] = True
        if little.any():
            i, j = _pairs(alo[little], ahi[little], blo[little], bhi[little])
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            yield i[near], j[near]
            alo, ahi, blo, bhi, dist = (v[~little] for v in (alo, ahi, blo, bhi, dist))
        if not len(alo):
            continue
        ca, cb = cumulated(bit)
        amid, bmid = ahi - (ca[ahi] - ca[alo]), bhi - (cb[bhi] - cb[blo])
        twin = (alo == blo) & (ahi == bhi) if same else np.zeros(len(alo), bool)
        parts = [(alo, amid, blo, bmid, dist, None), (amid, ahi, bmid, bhi, dist, None),
                 (alo, amid, bmid, bhi, dist + 1, None), (amid, ahi, blo, bmid, dist + 1, ~twin)]
        kept = []
        for p0, p1, q0, q1, d, extra in parts:
            ok = (p1 > p0) & (q1 > q0) & (d <= budget)
            if extra is not None:
                ok &= extra
            kept.append([v[ok] for v in (p0, p1, q0, q1, d)])
        merged = [np.concatenate(v) for v in zip(*kept)]
        if len(merged[0]):
            stack.append((bit + 1, *merged))


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes."""
    label = np.arange(n)
    for u, v in links:
        while len(u):
            x, y = label[u], label[v]
            apart = x != y
            if not apart.any():
                break
            u, v, x, y = u[apart], v[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    return label


def links(fps: DataFrame, budget: int = 2, group: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that span every component."""
    def nodes_at(depth: int) -> DataFrame:
        return stored(fps.groupBy(prefix("fp", depth).alias("node")).agg(F.count(F.lit(1)).alias("n")), "nodes")

    pairs = stored(node_pairs(nodes_at, budget, group), "pairs")
    depths = [r[0] for r in pairs.select("depth").distinct().collect()]  # 17 values at most
    routed = None
    for depth in depths:
        here = pairs.where(F.col("depth") == depth).select("depth", "a", "b")
        sides = here.select("depth", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
        part = fps.select("fp", prefix("fp", depth).alias("node")).join(sides, "node").select("depth", "a", "b", "fp")
        routed = part if routed is None else routed.unionByName(part)
    schema = "a long, b long"
    if routed is None:
        return fps.sparkSession.createDataFrame([], schema)

    def join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        depth, left, right = (k.as_py() for k in key)
        values = np.sort(table.column("fp").to_numpy().view(np.uint64))
        if left == right:
            a = b = values
        else:
            mine = values >> np.uint64(BITS - depth) == np.uint64(left)
            a, b = values[mine], values[~mine]
        if left == right:
            found = forest(len(a), walk(a, b, True, depth, budget))
        else:
            shifted = ((i, j + len(a)) for i, j in walk(a, b, False, depth, budget))
            found = forest(len(a) + len(b), shifted)
        both = a if left == right else np.concatenate((a, b))
        linked = np.flatnonzero(found != np.arange(len(found)))
        return pa.table({"a": both[linked].view(np.int64), "b": both[found[linked]].view(np.int64)})

    return routed.groupBy("depth", "a", "b").applyInArrow(join, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, budget: int = 2, plain_scan: bool = False,
                    group: int = 4096) -> tuple[DataFrame, DataFrame]:
    """The located rows, and per row: file, place, id, fp, component_id, kept.

    Of each component the row with the smallest id stays, of equal ids the first one.
    """
    places = located(docs, plain_scan)
    prints = stored(fingerprints(places.select(
        F.col(f"row.`{id_col}`").alias("id"), "file", "place",
        F.col(f"row.`{text_col}`").cast("string").alias("text")), shingle), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "place"))
    nodes = stored(prints.groupBy("fp").agg(first.alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), budget, group))
    rooted = stored(
        nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    heads = stored(rooted.groupBy("root").agg(F.min("first").alias("head")), "heads")
    named = stored(rooted.join(heads, "root").select("fp", "head"), "named")
    found = prints.join(named, "fp").select(
        "file", "place", "id", "fp", F.col("head.id").alias("component_id"),
        ((F.col("file") == F.col("head.file")) & (F.col("place") == F.col("head.place"))).alias("kept"))
    return places, found


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component of near duplicates; columns unchanged."""
    places, found = near_duplicates(docs, **options)
    return without(places, found.where("NOT kept"))
