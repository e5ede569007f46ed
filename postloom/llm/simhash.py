"""SimHash fingerprints and their links within a few bits, by vantage-point trees.

Two fingerprints that differ in at most ``radius`` bits differ in at most ``radius // 2`` bits of one half. So there
is one tree for each half, over the Hamming distance of that half. A node has a vantage point ``v`` and a bound
``m``: what lies at most ``m`` from ``v`` goes inside, what lies more than ``m - r`` from it goes outside. By the
triangle inequality a pair within ``r`` that straddles the bound then meets outside, so only the points in that
boundary go to both sides and each pair within ``r`` shares a leaf. The trees' upper levels are built on the driver
from a bounded sample and deal the distinct fingerprints out to shards, points of a boundary to several; each shard
goes on splitting and compares whole 64-bit fingerprints in small leaves. Shards give spanning links of what is
linked in them, not pairs, so a dense group costs no more than its size. Components come from star contraction over
written tables.

Equal fingerprints are joined before anything else, so exact copies, however many, are one point.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked like any other;
a null doc_id names no component: its row belongs to its fingerprint's component, null if no row with an id is
reachable; rows with one doc_id count as one document, so its texts are linked whatever their fingerprints; links pass
through fingerprints that only rows without an id have; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from postloom.llm.common import fresh, small_batches, text_or_empty, written

SAMPLE = 1 << 16
SHARD_ROWS = 50_000
LEAF = 256
SEED = 42
HALVES = (0x00000000FFFFFFFF, 0xFFFFFFFF00000000)
FP_NODE = 1 << 65
NODE = "decimal(38,0)"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of a text: bit b is set if over half of the shingles' hashes have it."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), "<u8")
    counts = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype="i8")
    set_bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed bigint."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t.as_py(), shingle) for t in texts], "u8")
        return pa.array(values.view("i8"))

    return docs.withColumn(out, of(text_or_empty(text)))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def distance(points: np.ndarray, vantage: np.uint64, mask: int) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & np.uint64(mask))


def best_split(points: np.ndarray, mask: int, radius: int, rng: np.random.Generator, tries: int = 6):
    """The vantage point and bound whose larger side, boundary included, is smallest: (size, vantage, bound)."""
    best = (len(points) + 1, None, 0)
    some = points if len(points) <= 4096 else rng.choice(points, 4096)
    for vantage in rng.choice(points, tries):
        counts = np.bincount(distance(some, vantage, mask), minlength=65)
        within = np.cumsum(counts)
        for m in range(64):
            out = len(some) - (within[m - radius] if m >= radius else 0)
            size = max(int(within[m]), int(out)) * len(points) / len(some)
            if size < best[0]:
                best = (size, vantage, m)
    return best


def sides(points: np.ndarray, vantage: np.uint64, bound: int, mask: int, radius: int):
    d = distance(points, vantage, mask).astype("i2")
    return np.flatnonzero(d <= bound), np.flatnonzero(d > bound - radius)


def shard_tree(sample: np.ndarray, mask: int, radius: int, shards: int, rng: np.random.Generator):
    """A tree of ``(vantage, bound, inside, outside)`` with shard numbers at its leaves, for about ``shards`` shards."""
    count = 0

    def grow(points: np.ndarray, wanted: float):
        nonlocal count
        if wanted > 1 and len(points) >= 2 * LEAF:
            size, vantage, bound = best_split(points, mask, radius, rng)
            if size < 0.85 * len(points):
                inside, outside = sides(points, vantage, bound, mask, radius)
                return vantage, bound, grow(points[inside], wanted / 2), grow(points[outside], wanted / 2)
        count += 1
        return count - 1

    return grow(sample, shards)


def route(tree, points: np.ndarray, mask: int, radius: int):
    """(shard, places of its points) for each shard that gets any."""
    stack = [(tree, np.arange(len(points)))]
    while stack:
        node, at = stack.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            yield node, at
        else:
            vantage, bound, inside, outside = node
            a, b = sides(points[at], vantage, bound, mask, radius)
            stack += [(inside, at[a]), (outside, at[b])]


def leaf_links(points: np.ndarray, at: np.ndarray, radius: int) -> list[np.ndarray]:
    """Spanning links within a leaf, as places in ``points``."""
    p = points[at]
    if len(p) <= 4 * LEAF:
        near = np.bitwise_count(p[:, None] ^ p[None, :]) <= radius
        if near.sum() == len(p):
            return []
        label = np.arange(len(p))
        while True:
            least = np.where(near, label, len(p)).min(1)
            if (least == label).all():
                break
            label = least
        linked = np.flatnonzero(label != np.arange(len(p)))
        return [np.stack([at[linked], at[label[linked]]])]
    links, rest = [], np.arange(len(p))  # alike in one half: take whole components out, one frontier at a time
    while len(rest):
        first, frontier, rest = rest[0], rest[:1], rest[1:]
        while len(frontier) and len(rest):
            near = np.zeros(len(rest), bool)
            for q in p[frontier]:
                near |= np.bitwise_count(p[rest] ^ q) <= radius
            frontier, rest = rest[near], rest[~near]
            links.append(np.stack([at[frontier], np.full(len(frontier), at[first])]))
    return links


def shard_links(points: np.ndarray, mask: int, radius: int) -> np.ndarray:
    """Spanning links (2 x n places) of what is linked within a shard."""
    rng = np.random.default_rng(SEED)
    found, stack = [], [np.arange(len(points))]
    part = radius // len(HALVES)
    whole = (1 << 64) - 1
    while stack:
        at = stack.pop()
        if len(at) > LEAF:
            for m, r in ((mask, part), (whole, radius)):
                size, vantage, bound = best_split(points[at], m, r, rng)
                if size < 0.85 * len(at):
                    stack += [at[x] for x in sides(points[at], vantage, bound, m, r)]
                    break
            else:
                found += leaf_links(points, at, radius)
        elif len(at) > 1:
            found += leaf_links(points, at, radius)
    return np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), "i8")


def links(groups: DataFrame, radius: int = 3) -> DataFrame:
    """Spanning links ``(a, b)`` between the ids of distinct fingerprints ``(fp, rep)`` within ``radius`` bits."""
    spark = groups.sparkSession
    n = groups.count()
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_ROWS))
    picked = groups.select("fp").orderBy(F.xxhash64("fp", F.lit(SEED)), "fp").limit(SAMPLE).toArrow()
    sample = picked.column("fp").to_numpy().view("u8")
    rng = np.random.default_rng(SEED)
    part = radius // len(HALVES)
    trees = [shard_tree(sample, mask, part, shards, rng) for mask in HALVES]
    shared = spark.sparkContext.broadcast(trees)

    def deal(batches):
        for batch in batches:
            points = batch.column(0).to_numpy().view("u8")
            for k, mask in enumerate(HALVES):
                for shard, at in route(shared.value[k], points, mask, part):
                    chosen = batch.take(pa.array(at))
                    key = pa.array(np.full(len(at), shard * len(HALVES) + k, "i8"))
                    yield pa.RecordBatch.from_arrays([key, *chosen.columns], names=["shard", "fp", "rep"])

    def link(key: tuple, rows: pa.Table) -> pa.Table:
        fps, reps = (rows.column(c).to_numpy() for c in ("fp", "rep"))
        order = np.argsort(reps)
        fps, reps = fps[order], reps[order]
        a, b = shard_links(fps.view("u8"), HALVES[key[0].as_py() % len(HALVES)], radius)
        return pa.table({"a": reps[a], "b": reps[b]})

    dealt = groups.select("fp", "rep").mapInArrow(deal, "shard bigint, fp bigint, rep bigint")
    return dealt.groupBy("shard").applyInArrow(link, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with an edge: the smallest node it reaches, by star contraction."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "llm-links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        edges = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "llm-stars")
        seen = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if seen == state:
            break
        state = seen
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def graph(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Per row of ``prints`` (``doc_id``, ``fp``): its ``node`` and the smallest ``component`` node it reaches.

    A document's node is its doc_id and a fingerprint's node is ``FP_NODE + fp``, as decimals, so that every doc_id is
    smaller than every fingerprint's node. Edges join each document to each of its fingerprints and fingerprints within
    ``radius`` bits; so texts of one doc_id are joined, and so are chains through fingerprints that only rows without an
    id have. A row's component is a doc_id unless no row with an id is reachable; an unlinked row without an id has none.
    """
    groups = written(prints.select("fp").distinct().withColumn("rep", F.col("fp")), "llm-groups")
    near = links(groups, radius)
    near = near.select(fp_node(F.col("a")).alias("a"), fp_node(F.col("b")).alias("b"))
    member = prints.where("doc_id is not null").select(F.col("doc_id").cast(NODE).alias("a"), fp_node(F.col("fp")).alias("b"))
    found = components(near.unionByName(member))
    rows = prints.withColumn("node", F.coalesce(F.col("doc_id").cast(NODE), fp_node(F.col("fp"))))
    return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", F.when(F.col("doc_id").isNotNull(), F.col("node"))))


def fp_node(fp: Column) -> Column:
    return (F.expr(f"CAST({FP_NODE} AS {NODE})") + fp.cast(NODE)).cast(NODE)


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest doc_id that links reach."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    prints = written(fingerprints(ids, shingle).select("doc_id", "fp"), "llm-fingerprints")
    found = graph(prints, radius)
    component = F.when(F.col("component") < F.expr(f"CAST({FP_NODE} AS {NODE})"), F.col("component").cast("bigint"))
    return found.select("doc_id", "fp", component.alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: one row of its smallest doc_id, or, where no row of a component has an
    id, one row of its smallest fingerprint. Rows of one doc_id are one document; the row kept of it is any of them."""
    fp, node = fresh(docs, "kept_fp", "kept_node")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    prints = written(fingerprints(ids, shingle).select("doc_id", "fp"), "llm-fingerprints")
    found = written(graph(prints, radius), "llm-kept")
    kept = found.where("doc_id = component").select(F.col("doc_id").alias(node)).distinct()
    keyed = docs.join(kept, docs["doc_id"].cast("bigint") == kept[node], "left_semi").dropDuplicates(["doc_id"])
    lone = found.where("doc_id is null and (component is null or component = node)").select(F.col("fp").alias(node)).distinct()
    bare = fingerprints(docs.where("doc_id is null"), shingle, out=fp)
    bare = bare.join(lone, bare[fp] == lone[node], "left_semi").dropDuplicates([fp])
    return keyed.unionByName(bare.select(docs.columns))


def digests(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
