"""Nearest vectors by cosine, over multi-index hashing of learned binary codes.

Codes: vectors are scaled to length 1, projected on their principal axes and rotated so that their signs lose least
(iterative quantisation); several rotations, from different starts, make up ``BITS`` bits. Axes and rotations come
from a bounded sample (``SAMPLE`` rows with the smallest hashes of their ids). Every row is indexed: rows go to
shards by a hash of their id, and a shard indexes each 16-bit substring of its codes.

Search: by the pigeonhole principle, codes within ``16 * (t + 1) - 1`` bits of a query (for 16 substrings) agree with
it in some substring up to ``t`` bits, so the buckets within ``t`` bits hold all of them. ``t`` grows until the
query's k-th best cosine is one at which codes stay within that radius (a line fitted to the sample's nearest pairs,
with ``SPREAD`` standard deviations to spare), or until every code is within it. What lies within the radius is
ranked by the cosine of the original vectors in double precision.

Queries go to the shards in blocks, so a task holds one block and one shard, and returns k rows for each query.

Defined results: vectors that are null, zero, or hold null or non-finite components, or whose length isn't the
commonest one (the smaller of equals), take no part, as queries or candidates; so do rows without an id; queries with
fewer than k candidates get them all; rows equal in id and vector count once, as a query and as a candidate; different
vectors of one id are rows of their own, each query with its own k ranks under that id, and none is another's
neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.llm.common import written

BITS = 256
SUB = 16
SAMPLE = 8_192
SHARD_ROWS = 32_768
BLOCK_ROWS = 4_096
SPREAD = 2.0
ROUNDS = 12


class Codes:
    """Learned rotations; ``of`` gives the codes of vectors."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.mean = unit.mean(0)
        centred = unit - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        self.axes = axes[:, ::-1][:, :64]
        v = centred @ self.axes
        width = v.shape[1]
        self.rotations = []
        for _ in range(-(-BITS // width)):
            r, _ = np.linalg.qr(rng.standard_normal((width, width)))
            for _ in range(ROUNDS):
                u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
                r = (u @ w).T
            self.rotations.append(r)
        near = unit[:512]
        cosines = near @ unit.T
        cosines[np.arange(len(near)), np.arange(len(near))] = -2
        best = np.argpartition(-cosines, min(10, len(unit) - 1), axis=1)[:, :10]
        c = np.take_along_axis(cosines, best, 1).ravel()
        codes = self.of(unit)
        apart = bits_apart(codes[np.repeat(np.arange(len(near)), best.shape[1])], codes[best.ravel()])
        angle = np.arccos(np.clip(c[c > -2], -1, 1))
        self.slope, self.start, self.spread = 0.0, float(BITS), 0.0
        if len(angle) > 16 and np.ptp(angle) > 1e-6:
            apart = apart[c > -2]
            # Bits differ in proportion to the angle, and not at all for equal vectors.
            self.slope = float((apart * angle).sum() / (angle * angle).sum())
            self.start, self.spread = 0.0, float((apart - self.slope * angle).std())

    def of(self, vectors: np.ndarray) -> np.ndarray:
        v = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True) - self.mean) @ self.axes
        bits = np.concatenate([v @ r > 0 for r in self.rotations], axis=1)[:, :BITS]
        return np.packbits(bits, axis=1).view("<u2")

    def safe(self, cosine: np.ndarray, radius: int) -> np.ndarray:
        """Whether vectors of at least this cosine have codes within ``radius``."""
        apart = self.start + self.slope * np.arccos(np.clip(cosine, -1, 1)) + SPREAD * self.spread
        return (apart <= radius) & (cosine > -2)


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view("<u8") ^ b.view("<u8")).sum(-1, dtype="i8")


class Index:
    """Buckets of a shard's codes, by each of their substrings; all substrings' buckets stand side by side."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.subs = codes.shape[1]
        values, sizes, self.rows = [], [], np.argsort(codes, axis=0, kind="stable").T.ravel()
        for s in range(self.subs):
            v, n = np.unique(codes[:, s], return_counts=True)
            values.append(v)
            sizes.append(n)
        self.sub = np.repeat(np.arange(self.subs), [len(v) for v in values])
        self.values, self.sizes = np.concatenate(values), np.concatenate(sizes)
        self.ends = np.cumsum(self.sizes)

    def probes(self, code: np.ndarray) -> np.ndarray:
        """How many bits each bucket is away from the code's substring."""
        return np.bitwise_count(self.values ^ code[self.sub])

    def within(self, code: np.ndarray, t: int, probes: np.ndarray | None = None) -> np.ndarray:
        """Every row whose code is within ``subs * (t + 1) - 1`` bits: some substring of it is within ``t``."""
        near = (self.probes(code) if probes is None else probes) <= t
        hits = near.nonzero()[0]
        if len(hits) < 64:
            found = [self.rows[self.ends[b] - self.sizes[b] : self.ends[b]] for b in hits]
            rows = np.unique(np.concatenate(found)) if found else hits
        else:
            seen = np.zeros(len(self.codes), bool)
            seen[self.rows[np.repeat(near, self.sizes)]] = True
            rows = seen.nonzero()[0]
        return rows[bits_apart(self.codes[rows], code[None, :]) <= self.subs * (t + 1) - 1]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal results."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, model: Codes, k: int, twins: np.ndarray | None = None) -> pd.DataFrame:
    """The k nearest rows of a shard for each query of a block; ``twins`` tell queries of one id apart."""
    codes, wanted = model.of(vectors), model.of(queries)
    index = Index(codes)
    found, scores, counts = [], [], []
    for q in range(len(queries)):
        probes = index.probes(wanted[q])
        for t in range(SUB + 1):
            radius = index.subs * (t + 1) - 1
            rows = index.within(wanted[q], t, probes)
            rows = rows[ids[rows] != query_ids[q]]
            if len(rows) < k and radius < BITS:
                continue
            score = cosines(vectors[rows], np.broadcast_to(queries[q], (len(rows), queries.shape[1])))
            best = np.lexsort((ids[rows], -score))[:k]
            if radius >= BITS or model.safe(score[best[-1:]], radius).all():
                break
        found.append(ids[rows[best]])
        scores.append(score[best])
        counts.append(len(best))
    twins = np.zeros(len(queries), "i8") if twins is None else twins
    return pd.DataFrame({"query_id": np.repeat(query_ids, counts), "twin": np.repeat(twins, counts), "vec_id": np.concatenate(found), "score": np.concatenate(scores)})


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), v.alias("v"), F.size(v).alias("width"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    rows = written(rows.where(F.forall("v", lambda x: x.isNotNull())).dropDuplicates(["vec_id", "v"]), "llm-vectors")
    common = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    return rows.where(F.col("width") == (common.width if common else 0)).select("vec_id", "v")


def each(n: int) -> Column:
    """A row for each number from 0 below ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def nearest(vectors: DataFrame, query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows for each row that ``query`` marks."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    schema = "query_id bigint, twin bigint, vec_id bigint, score double"
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    shared = spark.sparkContext.broadcast(Codes(sample.column("v").combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)))
    asked = rows.where(query)
    shards = max(1, -(-n // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    # Small tables are cut finer, so that every core gets a part.
    shards = max(shards, min(-(-n // 2048), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shard = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks))
    twin = F.xxhash64("v", F.lit(3)).alias("twin")
    index = rows.select("vec_id", "v", twin, shard.alias("shard"), each(blocks).alias("block"))
    asked = asked.select("vec_id", "v", twin, each(shards).alias("shard"), block.alias("block"))
    both = index.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy(dtype=bool)
        ids, v = rows["vec_id"].to_numpy(), np.array(rows["v"].tolist(), "f8")
        if not asks.any() or asks.all():
            return pd.DataFrame({c: [] for c in ("query_id", "twin", "vec_id", "score")})
        return search(ids[~asks], v[~asks], ids[asks], v[asks], shared.value, k, rows["twin"].to_numpy()[asks])

    found = both.groupBy("shard", "block").applyInPandas(find, schema)
    order = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
