"""Near duplicates by the Jaccard similarity of five-word shingles, checked exactly on candidates from MinHash.

Candidates: texts with one set of shingles are one node. Each node gets ``BANDS * ROWS`` minima; nodes that share all
minima of a band meet in its bucket, so a pair of similarity 0.8 shares none with a probability of 5e-8. Buckets give
pairs in rounds, each pair checked by the exact similarity of both whole sets before it links, and only pairs between
different components of the links so far are of use:

* ``CHAINS`` rounds in which a bucket gives its neighbours in an order by component, a row of pairs as long as itself,
  so that a dense group is linked by about its size of pairs;
* one round in which it gives every pair left between components, but those whose estimate from all minima is under
  ``DOUBT`` (at similarity 0.8 an estimate is as low with a probability of about 1e-7).

Components come from star contraction over the checked links.

Defined results: words and letter case as in ``simhash``; a text of fewer words than a shingle has one shingle, all of
it; a null text counts as empty, and texts without words are alike; rows with one doc_id count as one document; a
component without any doc_id keeps one row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from postloom.llm.common import fresh, small_batches, text_or_empty, written
from postloom.llm.simhash import LOWER, SEED, components
from postloom.plans.spread import lookup

SHINGLE = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 4
DOUBT = 0.6
CHAINS = 2
SHARD_ROWS = 200_000
BLOCK = 1 << 18
_RNG = np.random.default_rng(SEED)
FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype="u8") * np.uint64(2) + np.uint64(1)
PRINT = "struct<node bigint, bands array<bigint>, sketch binary>"


def shingles(text: str) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order."""
    words = text.encode().translate(LOWER).split()
    if len(words) <= SHINGLE:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in parts), "u8"))


def node_of(hashes: np.ndarray) -> int:
    """A signed digest of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)).view("i8"))


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The bands' keys, and a byte of each minimum."""
    least = np.full(len(FACTORS), (1 << 64) - 1, "u8")
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[at : at + 1024, None] * FACTORS).min(0))
    bands = least.reshape(BANDS, ROWS)
    keys = np.array([xxhash.xxh3_64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], "u8").view("i8")
    # The minima themselves are small numbers; their low bits are not.
    return keys, (least & np.uint64(255)).astype("u1").tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities as the sketches tell, row by row; other minima share a byte once in 256 times."""
    return ((a == b).mean(-1) - 1 / 256) / (1 - 1 / 256)


def runs(keys: np.ndarray):
    """(start, end) of each run of two or more equal keys."""
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    for a, b in zip(at[:-1], at[1:]):
        if b - a > 1:
            yield a, b


def bucket_pairs(labels: np.ndarray, sketches: np.ndarray, chain: bool):
    """Pairs of different components within a bucket, as two arrays of places."""
    order = np.argsort(labels, kind="stable")
    if chain:
        a, b = order[:-1], order[1:]
        if len(order) > 2:  # components alternate by a second order: the k-th of one with the k-th of the next
            rank = np.arange(len(order)) - np.searchsorted(labels[order], labels[order])
            woven = order[np.argsort(rank, kind="stable")]
            a, b = np.r_[a, woven[:-1]], np.r_[b, woven[1:]]
        keep = (labels[a] != labels[b]) & (estimates(sketches[a], sketches[b]) >= DOUBT)
        yield a[keep], b[keep]
        return
    common, sizes = np.unique(labels, return_counts=True)
    if len(common) < 2:
        return
    main = labels == common[sizes.argmax()]
    order = np.r_[np.flatnonzero(main), np.flatnonzero(~main)]  # the largest component is met by the others only
    for i in range(int(main.sum()), len(order)):
        for at in range(0, i, BLOCK):
            b = order[at : min(i, at + BLOCK)]
            b = b[labels[b] != labels[order[i]]]
            b = b[estimates(sketches[b], sketches[order[i]]) >= DOUBT]
            yield np.full(len(b), order[i]), b


def pairs(members: DataFrame, chain: bool, shards: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` of nodes that buckets of ``(key, node, sketch, label)`` give."""

    def find(rows: pa.Table) -> pa.Table:
        keys, nodes, labels = (rows.column(c).to_numpy() for c in ("key", "node", "label"))
        order = np.lexsort((nodes, keys))
        keys, nodes, labels = keys[order], nodes[order], labels[order]
        whole = rows.column("sketch").combine_chunks()
        sketches = np.frombuffer(b"".join(whole.take(pa.array(order)).to_pylist()), "u1").reshape(len(keys), -1)
        left, right = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        for start, end in runs(keys):
            for a, b in bucket_pairs(labels[start:end], sketches[start:end], chain):
                left.append(nodes[start + a])
                right.append(nodes[start + b])
        a, b = np.concatenate(left), np.concatenate(right)
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        return pa.table({"a": both[0], "b": both[1]})

    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    return members.select("key", "node", "sketch", "label", shard).groupBy("shard").applyInArrow(find, "a bigint, b bigint").distinct()


def crowded(keys: DataFrame, shards: int) -> DataFrame:
    """The rows ``(key, node)`` whose key is met more than once."""

    def keep(rows: pa.Table) -> pa.Table:
        k, n = rows.column("key").to_numpy(), rows.column("node").to_numpy()
        order = np.argsort(k, kind="stable")
        k, n = k[order], n[order]
        same = k[1:] == k[:-1]
        more = np.r_[False, same] | np.r_[same, False]
        return pa.table({"key": k[more], "node": n[more]})

    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    return keys.select("key", "node", shard).groupBy("shard").applyInArrow(keep, "key bigint, node bigint")


def linked(found: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough, written."""

    @F.arrow_udf("boolean")
    def alike(x: pa.Array, y: pa.Array) -> pa.Array:
        each = zip(x, y)
        return pa.array([similarity(*(np.frombuffer(s.as_py(), "u8") for s in both)) >= SIMILAR for both in each], pa.bool_())

    both = lookup(found, sets.toDF("a", "x"), ["a"], ["b"], "inner")
    both = lookup(both, sets.toDF("b", "y"), ["b"], ["a"], "inner")
    return written(both.where(alike("x", "y")).select("a", "b"), "llm-near")


def nodes(docs: DataFrame, text: str = "text", out: str = "print") -> DataFrame:
    """``docs`` with the node of ``text``, its bands and its sketch."""
    small_batches(docs.sparkSession)

    @F.arrow_udf(PRINT)
    def of(texts: pa.Array) -> pa.Array:
        made = []
        for t in texts:
            hashes = shingles(t.as_py())
            keys, s = sketch(hashes)
            made.append({"node": node_of(hashes), "bands": keys.tolist(), "sketch": s})
        return pa.array(made, pa.struct([("node", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]))

    return docs.withColumn(out, of(text_or_empty(text)))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, set)`` for the nodes of ``wanted`` ``(node, rep)``, written; ``rep`` is a doc_id of the node, if any has one."""

    @F.arrow_udf("struct<n bigint, s binary>")
    def of(texts: pa.Array) -> pa.Array:
        made = [shingles(t.as_py()) for t in texts]
        return pa.array([{"n": node_of(h), "s": h.tobytes()} for h in made], pa.struct([("n", pa.int64()), ("s", pa.binary())]))

    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), text_or_empty("text").alias("t"))
    named = texts.join(wanted.where("rep is not null"), "rep").select("node", of("t").alias("p"))
    named = named.where("p.n = node").select("node", F.col("p.s").alias("set"))
    bare = texts.where("rep is null").select(of("t").alias("p")).select(F.col("p.n").alias("node"), F.col("p.s").alias("set"))
    bare = bare.join(wanted.where("rep is null").select("node"), "node", "left_semi")
    return written(written(named.unionByName(bare), "llm-sets").groupBy("node").agg(F.min("set").alias("set")), "llm-sets")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, node, component)``, distinct, of the rows of ``docs``."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = written(nodes(ids).select("doc_id", "print.*"), "llm-prints")
    groups = prints.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max(F.struct("bands", "sketch")).alias("p"))
    groups = written(groups.select("node", "rep", "p.bands", "p.sketch"), "llm-groups")
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-groups.count() * BANDS // SHARD_ROWS))
    rows = crowded(groups.select("node", F.explode("bands").alias("key")), shards)
    rows = written(rows.join(groups.select("node", "sketch"), "node").select("key", "node", "sketch"), "llm-buckets")
    sets = sets_of(docs, groups.select("node", "rep").join(rows.select("node").distinct(), "node"))
    # Nodes that share a doc_id are one document.
    shared = prints.where("doc_id is not null").select("doc_id", "node").distinct()
    least = shared.groupBy("doc_id").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1")
    links = written(shared.join(least, "doc_id").select(F.col("node").alias("a"), "b").where("a <> b"), "llm-near")
    tried, labels = None, components(links)
    for chain in [True] * CHAINS + [False]:
        known = labels.toDF("node", "component")
        state = rows.join(known, "node", "left").select("key", "node", "sketch", F.coalesce("component", "node").alias("label"))
        found = pairs(state, chain, shards)
        found = written(found if tried is None else found.join(tried, ["a", "b"], "left_anti"), "llm-pairs")
        tried = found if tried is None else tried.union(found)
        links = links.union(linked(found, sets))
        labels = components(links)
    known = prints.select("doc_id", "node").distinct().join(labels.toDF("node", "component"), "node", "left")
    return known.select("doc_id", "node", F.coalesce("component", "node").alias("component"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id, or any if it has none."""
    doc_id, node, made = fresh(docs, "kept_id", "kept_node", "kept_print")
    found = written(near_duplicates(docs), "llm-found")
    kept = written(found.groupBy("component").agg(F.min("doc_id").alias(doc_id), F.min("node").alias(node)), "llm-kept")
    named = kept.where(F.col(doc_id).isNotNull()).select(doc_id).distinct()
    keyed = docs.join(named, docs["doc_id"].cast("bigint") == named[doc_id], "left_semi").dropDuplicates(["doc_id"])
    lone = kept.where(F.col(doc_id).isNull()).select(F.col(node).alias(doc_id))
    bare = nodes(docs.where("doc_id is null"), out=made).withColumn(node, F.col(f"{made}.node")).drop(made).dropDuplicates([node])
    return keyed.unionByName(bare.join(lone, bare[node] == lone[doc_id], "left_semi").select(docs.columns))
