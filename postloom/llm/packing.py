"""Best-fit decreasing packing of documents into token sequences.

Best fit treats documents of one length alike, so the packing depends only on how many pieces each length has. The
histogram of lengths (at most ``capacity`` rows, whatever the corpus) is packed on the driver, longest length
first: a segment tree over the remaining capacities gives the tightest open bins that fit, and as many documents of
that length as those bins hold go in together. The plan that comes out is a list of runs of equal pieces; its
length is bounded by the capacity, not by the corpus. Each piece then looks up its run by its rank among the pieces
of its length; ranks come from counts per (length, bucket) and a window within such a pair, so a common length is
never ranked in one task.

Defined results: a null text is packed like the empty one; every document ends with the separator id, so an empty
document is one piece of length 1; an empty table gives no rows; repeated rows are packed once for each row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from postloom.llm.bpe import PATTERN, Codec, shared_vocabulary
from postloom.llm.common import text_or_empty, written

ROWS_PER_BUCKET = 100_000
MAX_RUNS = 1 << 18


class Tokenizer:
    """Ids of whole texts by the merges of a ``tokenizers`` JSON file (its ids ascend in merge order)."""

    def __init__(self, content: bytes):
        self.content, self.codec = content, None
        codec = Codec(content)
        added = {t: int(np.frombuffer(i, "<u4")[0]) for t, i in codec.added.items()}
        ranks = {b: i for i, b in codec.bytes_of.items() if i not in added.values()}
        self.quick = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.quick.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        except Exception:  # its regular expressions give up on some very long runs of white space
            self.codec = self.codec or Codec(self.content)
            return np.frombuffer(self.codec.encode(text), "<u4")


_tokenizers: dict[int, Tokenizer] = {}


def tokenizer(content: bytes) -> Tokenizer:
    key = hash(content)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = Tokenizer(content)
    return _tokenizers[key]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, separator: int = 0, keep_ids: bool = False) -> DataFrame:
    """Token pieces of at most ``capacity`` ids; of a longer document only the first piece may be shorter."""
    shared = shared_vocabulary(docs.sparkSession, path)
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(shared.value)
        end = np.array([separator], "<u4")
        for batch in batches:
            rows, number, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                tokens = np.concatenate([encode(text.as_py()), end])
                n = len(tokens)
                at = 0
                for k in range(-(-n // capacity)):
                    to = at + (n - 1) % capacity + 1 if k == 0 else at + capacity
                    rows.append(row)
                    number.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(tokens[at:to].tobytes()))
                    if keep_ids:
                        ids.append(tokens[at:to].astype("i4"))
                    at = to
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(cut, schema)


class Capacities:
    """Segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.width)

    def add(self, remaining: int, bins: int) -> None:
        i = remaining + self.width
        while i:
            self.tree[i] += bins
            i >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` with an open bin."""
        i = least + self.width
        if self.tree[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.width
            i >>= 1
        return None


def best_fit_runs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts of lengths.

    A run ``(length, first, n, bin, offset, per_bin)`` says: of the pieces of ``length``, number ``first + j`` for
    ``j < n`` goes to bin ``bin + j // per_bin`` at ``offset + j % per_bin * length``.
    """
    tree, open_bins = Capacities(capacity), {}
    runs, bins = [], 0

    def put(remaining: int, first: int, n: int) -> None:
        if remaining and n:  # full bins close
            open_bins.setdefault(remaining, []).append((first, n))
            tree.add(remaining, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining = capacity
                first, n = bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[remaining].pop()
                tree.add(remaining, -n)
            fit = remaining // length
            full = min(n, left // fit)
            some = left - full * fit if full < n else 0  # at most one bin takes fewer than it could
            for at, count, per_bin in ((first, full, fit), (first + full, int(some > 0), some)):
                if count:
                    runs.append((length, rank, count * per_bin, at, capacity - remaining, per_bin))
                    put(remaining - per_bin * length, at, count)
                    rank, left = rank + count * per_bin, left - count * per_bin
            put(remaining, first + full + (some > 0), n - full - (some > 0))
    return runs


def pack(docs: DataFrame, path: str, capacity: int = 2048, separator: int = 0, keep_ids: bool = False) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; offsets of a sequence are gapless from 0."""
    spark = docs.sparkSession
    cut = written(pieces(docs, path, capacity, separator, keep_ids), "llm-pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = best_fit_runs(counts, capacity)
    if len(runs) > MAX_RUNS:
        raise ValueError("the packing plan is too long to broadcast")
    plan = spark.createDataFrame(runs, "length bigint, first bigint, n bigint, bin bigint, base bigint, per_bin bigint")
    buckets = max(8, -(-sum(counts.values()) // ROWS_PER_BUCKET))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n_bucket"))
    before = before.select(
        "length", "bucket",
        (F.sum("n_bucket").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n_bucket")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = dealt.withColumn("place", place).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("place"))
    on = (ranked["length"] == plan["length"]) & (ranked["rank"] >= plan["first"]) & (ranked["rank"] < plan["first"] + plan["n"])
    nth = ranked["rank"] - plan["first"]
    return ranked.join(F.broadcast(plan), on).select(
        *(ranked[c] for c in cut.columns),
        (plan["bin"] + (nth / plan["per_bin"]).cast("bigint")).alias("sequence_id"),
        (plan["base"] + nth % plan["per_bin"] * ranked["length"]).alias("offset"),
    )
