"""Removal of byte strings that occur more than once, by suffix arrays of shards.

Every place where ``width`` bytes start is keyed by the least hash of the 32-byte strings in those bytes. Equal
strings have equal keys, so all that has to meet are places with one key. Neighbouring places mostly share their
key: such a run, with the text that its strings cover, is a segment. Segments are counted by key and digest, in
partial sums, before anything else moves:

* a segment that occurs twice is repeated as a whole, without sorting;
* a key with one segment that occurs once, in which the key's string is met once, has no repeats;
* all other segments go, one copy of each, to the shard of their key, where their suffix array (induced sorting) and
  its common prefixes tell which places start a repeated string.

A key with very many different segments is not given to one shard: each of its places is counted by a digest of its
``width`` bytes instead. Either way decides every place exactly. Texts that occur several times are taken once and
are repeated as a whole.

Defined results: a null text counts as empty; texts shorter than ``width`` lose nothing; repeated rows count as
copies and each gets its result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from postloom.llm.common import fresh, small_batches, text_or_empty, tidy, written
from postloom.llm.suffix import repeated
from postloom.session import shared_dir

WIDTH = 200
GRAM = 32
BLOCK = 1 << 16
PLACE = (1 << 17) - 1  # the low bits of a hash hold its place, so that equal hashes in a window are told apart
SHARD_BYTES = 2 << 20
STEP = 16
SLICE_BYTES = 4 << 20
HOT_SEGMENTS = 4096
FACTOR = 0x9E3779B97F4A7C15


def window_keys(raw: np.ndarray, width: int) -> np.ndarray:
    """For each place where ``width`` bytes start: the least (hash, place) of the 32-byte strings in them."""
    h = raw.astype("u8") + np.uint64(1)
    step, factor = 1, FACTOR
    while step < GRAM:
        h = h[..., :-step] * np.uint64(factor) + h[..., step:]
        factor = factor * factor % (1 << 64)
        step *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(FACTOR)
    h &= np.uint64(~PLACE & (1 << 64) - 1)
    h |= np.arange(h.shape[-1], dtype="u8")
    span, n = 1, width - GRAM + 1
    while 2 * span <= n:
        h = np.minimum(h[..., :-span], h[..., span:])
        span *= 2
    return np.minimum(h[..., : h.shape[-1] - (n - span)], h[..., n - span :]) if n > span else h


def segments_of(raw: np.ndarray, offsets: np.ndarray, width: int):
    """(text, first place, places, key, whether its string is met again) of all segments of the texts in ``raw``."""
    out = []
    ends = offsets[1:] - width  # last place of each text
    for at in range(int(offsets[0]), max(int(offsets[0]), int(offsets[-1]) - width + 1), BLOCK):
        least = window_keys(raw[at : at + BLOCK + width - 1], width)
        key = least >> np.uint64(17)
        heads = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(key))] - at
        breaks = np.unique(np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, heads]))
        moved = np.concatenate([[0], np.cumsum(least[1:] != least[:-1])])
        last = np.append(breaks[1:], len(key)) - 1
        text = np.searchsorted(offsets, breaks + at, side="right") - 1
        last = np.minimum(last, ends[text] - at)
        ok = last >= breaks
        first, last, text = breaks[ok], last[ok], text[ok]
        out.append((text, first + at - offsets[text], last - first + 1, key[first].view("i8"), moved[last] != moved[first]))
    if not out:
        out = [tuple(np.zeros(0, kind) for kind in ("i8", "i8", "i8", "i8", "?"))]
    return [np.concatenate(x) for x in zip(*out)]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], "i8")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, "u1") if data is not None and data.size else np.zeros(0, "u1")
    return raw[: offsets[-1]], offsets  # of a slice, the buffer holds what follows too


def sliced(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``SLICE_BYTES`` of a string or binary column, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def segment_rows(texts: DataFrame, width: int) -> DataFrame:
    """Segments of each text ``(tid, text, copies)``: tid, copies, at, n, key, digest, again."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raw, offsets = buffers(batch.column(1))
            text, at, n, key, again = segments_of(raw, offsets, width)
            view = memoryview(raw)
            start = offsets[text] + at
            digest = xxhash.xxh3_64_intdigest
            digests = np.fromiter((digest(view[a:b]) for a, b in zip(start.tolist(), (start + n + width - 1).tolist())), "u8", len(n))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(text)) for c in (batch.column(0), batch.column(2))), *map(pa.array, (at.astype("i4"), n.astype("i4"), key, digests.view("i8"), again))],
                names=["tid", "copies", "at", "n", "key", "digest", "again"],
            )

    return texts.select("tid", "text", "copies").mapInArrow(cut, "tid binary, copies bigint, at int, n int, key bigint, digest bigint, again boolean")


def fetch(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``wanted`` segments (tid, at, n, key, mark, again) with their bytes."""
    lists = wanted.groupBy("tid").agg(F.collect_list(F.struct("at", "n", "key", "mark", "again")).alias("parts"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raw, offsets = buffers(batch.column(1))
            lists = batch.column(2)
            parts = lists.flatten()
            text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            at, n = (parts.field(i).to_numpy() for i in (0, 1))
            start = offsets[text] + at
            view = memoryview(raw)
            content = pa.array([bytes(view[a:b]) for a, b in zip(start.tolist(), (start + n + width - 1).tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), *(parts.field(i) for i in (0, 2, 3)), content, parts.field(4)],
                names=["tid", "at", "key", "mark", "bytes", "again"],
            )

    schema = "tid binary, at int, key bigint, mark boolean, bytes binary, again boolean"
    return texts.join(lists, "tid").select("tid", "text", "parts").mapInArrow(take, schema)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype("i1"), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def possible(rows: list[tuple], width: int) -> Iterator[tuple[int, int, int]]:
    """(row, first place, last place) of the runs of places that may start a repeated string.

    Places are taken in steps relative to the key's string. All strings of a step hold the same middle bytes; where
    no other segment has these bytes, none of them is repeated and the suffix array needn't hold them. Keys with a
    segment that meets the key's string again are taken whole: there is more than one such place to start from.
    """
    loose = {r[2] for r in rows if r[5]}
    row, block, digests = [], [], []
    for at in range(0, len(rows), 4096):
        some = rows[at : at + 4096]
        heads = np.frombuffer(b"".join(r[4][:width] for r in some), "u1").reshape(-1, width)
        anchors = (window_keys(heads, width)[:, 0] & np.uint64(PLACE)).tolist()
        for k, (r, q) in enumerate(zip(some, anchors), at):
            if r[2] in loose:
                continue
            places = len(r[4]) - width + 1
            content = memoryview(r[4])
            for j in range((q - places + 1) // STEP, q // STEP + 1):
                core = q - STEP * j
                row.append(k)
                block.append(core)
                digests.append(xxhash.xxh3_64_intdigest(content[core : core - STEP + 1 + width]))
    _, at, counts = np.unique(np.array(digests, "u8"), return_inverse=True, return_counts=True)
    keep = counts[at] > 1
    run = None
    for k, core in zip(np.array(row)[keep].tolist(), np.array(block)[keep].tolist()):
        first, last = max(0, core - STEP + 1), min(core, len(rows[k][4]) - width)
        if run and run[0] == k and first <= run[2] + 1 and last + 1 >= run[1]:
            run = (k, min(run[1], first), max(run[2], last))
        else:
            if run:
                yield run
            run = (k, first, last)
    if run:
        yield run
    yield from ((k, 0, len(r[4]) - width) for k, r in enumerate(rows) if r[2] in loose)


def sorted_repeats(segments: DataFrame, width: int) -> DataFrame:
    """(tid, first, last) places of marked segments that start a repeated string: a suffix array for each shard."""
    schema = "tid binary, first int, last int"

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        pieces, starts, ends, of, size = [], [], [], [], 0
        for k, first, last in possible(rows, width):
            pieces += [rows[k][4][first : last + width], b"\xff"]  # no byte of UTF-8
            of.append((k, first))
            starts.append(size)
            size += last - first + width + 1
            ends.append(size - 1)
        t = np.frombuffer(b"".join(pieces), "u1")
        hit = repeated(t, np.repeat(np.array(ends, "i8"), np.diff(np.append(starts, size).astype("i8"))), width)
        tids, firsts, lasts = [], [], []
        for (k, first), a, b in zip(of, starts, ends):
            tid, at, _, mark, *_ = rows[k]
            if mark:
                for x, y in zip(*runs_of(hit[a:b])):
                    tids.append(tid)
                    firsts.append(at + first + int(x))
                    lasts.append(at + first + int(y))
        yield pa.RecordBatch.from_arrays([pa.array(tids, pa.binary()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], names=["tid", "first", "last"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, key = [], 0, None
        for batch in sliced(batches, 4):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SHARD_BYTES and row[2] != key:
                    yield from shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
                key = row[2]
        if rows:
            yield from shard(rows)

    return segments.repartition("key").sortWithinPartitions("key").mapInArrow(sort, schema)


def counted_repeats(segments: DataFrame, width: int) -> DataFrame:
    """Like ``sorted_repeats``, for keys with very many segments: places are counted by a digest of their bytes."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in sliced(batches, 4):
            contents = batch.column(4).to_pylist()
            counts = np.array([len(c) - width + 1 for c in contents], "i8")
            row = np.repeat(np.arange(len(counts)), counts)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            digests = pa.array([digest(c[i : i + width]) for c, n in zip(contents, counts) for i in range(n)], pa.binary())
            place = pa.array((batch.column(1).to_numpy()[row] + nth).astype("i4"))
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), place, batch.column(3).take(row), digests], names=["tid", "place", "mark", "digest"])

    found = segments.mapInArrow(places, "tid binary, place int, mark boolean, digest binary")
    twice = found.groupBy("digest").agg(F.count("*").alias("k")).where("k > 1").select("digest")
    return found.where("mark").join(twice, "digest", "left_semi").select("tid", F.col("place").alias("first"), F.col("place").alias("last"))


def text_table(docs: DataFrame) -> DataFrame:
    """Each different text once, with its id and number of copies, bucketed by id so that later joins don't move it."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(text_or_empty("text").alias("text")).withColumn("tid", tid_of(F.col("text")))
    texts = texts.groupBy("tid").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    path = shared_dir(spark, "llm-texts")
    name = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    with tidy(spark):
        texts.write.bucketBy(width, "tid").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def tid_of(text):
    return F.unhex(F.md5(text.cast("binary")))


def repeated_places(texts: DataFrame, width: int) -> DataFrame:
    """(tid, first, last) runs of places that start a string met elsewhere, in texts that occur once."""
    segments = written(segment_rows(texts.where(F.octet_length("text") >= width), width), "llm-segments")
    groups = segments.groupBy("key", "digest").agg(F.sum("copies").alias("k"), F.max("again").alias("again"))
    groups = written(groups, "llm-segment-groups")
    met_again = F.max((F.col("k") == 1) & F.col("again"))
    several = groups.groupBy("key").agg(F.count("*").alias("different"), met_again.alias("alone"), F.min("k").alias("least"))
    several = several.where("(different > 1 and least = 1) or alone").select("key", (F.col("different") > HOT_SEGMENTS).alias("hot"))
    groups = groups.join(several, "key", "left").where("k > 1 or hot is not null").select("key", "digest", "k", "hot")
    found = written(segments.join(groups, ["key", "digest"]), "llm-found")
    one = found.where("hot is not null and k > 1").groupBy("key", "digest").agg(F.min(F.struct("tid", "at", "n", "key", "again", "hot")).alias("one"))
    wanted = found.where("hot is not null and k = 1").select("tid", "at", "n", "key", "again", "hot", F.lit(True).alias("mark"))
    wanted = wanted.unionByName(one.select("one.*", F.lit(False).alias("mark")))
    near = fetch(texts, wanted.where("not hot"), width)
    hot = fetch(texts, wanted.where("hot"), width)
    whole = found.where("copies = 1 and k > 1").select("tid", F.col("at").alias("first"), (F.col("at") + F.col("n") - 1).alias("last"))
    return whole.unionByName(sorted_repeats(near, width)).unionByName(counted_repeats(hot, width))


def without_repeats(docs: DataFrame, width: int = WIDTH, keep_text: bool = False) -> DataFrame:
    """Per different text of ``docs``: tid, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, what is kept.

    ``kept`` is null where nothing is removed; parts of characters at the edges of what is removed go too.
    """
    small_batches(docs.sparkSession)
    texts = text_table(docs)
    lists = repeated_places(texts, width).groupBy("tid").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    schema = "tid binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raw, offsets = buffers(batch.column(1))
            sizes, removed, spans, hashes, kept = [], [], [], [], []
            for row, (copies, runs) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                part = raw[offsets[row] : offsets[row + 1]]
                n = len(part)
                gone = np.zeros(n + 1, "i4")
                if copies > 1:
                    gone[: n if n >= width else 0] = 1
                elif runs.is_valid:
                    first, last = (runs.values.field(i).to_numpy() for i in (0, 1))
                    np.add.at(gone, first, 1)
                    np.add.at(gone, last + width, -1)
                    gone = np.cumsum(gone)
                gone = gone[:n] > 0
                left = part[~gone].tobytes()
                sizes.append(n)
                removed.append(int(gone.sum()))
                spans.append(len(runs_of(gone)[0]))
                hashes.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "ignore") if keep_text and removed[-1] else None)
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(hashes), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["tid", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.join(lists, "tid", "left").select("tid", "text", "copies", "runs").mapInArrow(cut, schema)


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = without_repeats(docs, width).drop("kept")
    ids = docs.select("doc_id", tid_of(text_or_empty("text")).alias("tid"))
    return ids.join(found, "tid").drop("tid")


def removed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with texts cut (and ``n_chars``, where there is one, counted anew)."""
    tid, kept = fresh(docs, "tid", "kept")
    found = written(without_repeats(docs, width, keep_text=True).where("n_removed > 0"), "llm-kept").select(F.col("tid").alias(tid), F.col("kept").alias(kept))
    both = docs.withColumn(tid, tid_of(text_or_empty("text"))).join(found, tid, "left")
    new = {"text": F.coalesce(F.col(kept), F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept).cast(docs.schema["n_chars"].dataType))
    return both.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))
