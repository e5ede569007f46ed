"""Byte-level BPE by a segment tree over the ranks of adjacent pairs.

A pre-token starts as one symbol per byte. Leaf ``i`` of the tree holds ``rank * width + i`` of the pair that
begins at symbol ``i``, so the root is the lowest rank and, of equal ranks, the leftmost place. A merge changes
three leaves; every change climbs one path. The work stops when the root is empty.

Pre-tokens repeat, so each Python worker keeps the ids of those it has met, up to a bounded number of bytes.

Defined results: a null text is encoded like the empty one (no ids); null ids decode to the empty text; ids that
the vocabulary doesn't have are skipped in decoding; bytes that aren't UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import json
import struct
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from postloom.llm.common import file_bytes, fresh, small_batches, text_or_empty

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_BYTES = 128 << 20
CACHED_WORD = 64  # longer pre-tokens seldom repeat


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible in Latin-1, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


NEW_SYMBOL = (1 << 20) - 1  # a merge is rank << 20 | new symbol, so that merges compare by rank
NONE = 1 << 62
SHORT = 48


def merge_short(symbols: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """Like ``merge``, with one level of leaves below the root: quicker for the few bytes of a word."""
    get = merges.get
    leaves = [get(p, NONE) for p in zip(symbols, symbols[1:])]
    while leaves:
        root = min(leaves)
        if root == NONE:
            break
        i = leaves.index(root)
        symbols[i : i + 2] = [root & NEW_SYMBOL]
        del leaves[i]
        if i:
            leaves[i - 1] = get((symbols[i - 1], symbols[i]), NONE)
        if i < len(leaves):
            leaves[i] = get((symbols[i], symbols[i + 1]), NONE)
    return symbols


def merge(symbols: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """``symbols`` after all merges, by the segment tree."""
    n = len(symbols)
    if n < 2:
        return symbols
    width = 1 << (n - 1).bit_length()
    symbols = symbols[:]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def leaf(i: int) -> int:
        hit = merges.get((symbols[i], symbols[after[i]]), NONE) if after[i] < n else NONE
        return hit if hit == NONE else hit * width + i

    tree = [NONE] * width + [leaf(i) for i in range(n - 1)]
    tree += [NONE] * (2 * width - len(tree))
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(i: int, value: int) -> None:
        i += width
        tree[i] = value
        while i > 1:
            least = min(tree[i], tree[i ^ 1])
            i >>= 1
            if tree[i] == least:
                break
            tree[i] = least

    while (root := tree[1]) != NONE:
        i, gone = root % width, after[root % width]
        symbols[i] = root // width & NEW_SYMBOL
        after[i] = after[gone]
        if after[gone] < n:
            before[after[gone]] = i
        put(gone, NONE)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(symbols[i])
        i = after[i]
    return out


class Codec:
    """A byte-level BPE vocabulary in the ``tokenizers`` JSON format."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [vocab[c] for c in letters]
        self.merges = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[a], vocab[b]] = rank << 20 | vocab[a + b]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(of_letter[c] for c in t) for t, i in vocab.items()}
        self.bytes_of.update({i: t.encode() for t, i in added.items()})
        self.added = {t: np.uint32(i).tobytes() for t, i in added.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(PATTERN).findall
        self.cache: dict[str, bytes] = {}
        self.room = CACHE_BYTES

    def word(self, word: str) -> bytes:
        """Ids of a pre-token as little-endian 32-bit numbers."""
        symbols = [self.byte_ids[b] for b in word.encode()]
        symbols = (merge_short if len(symbols) <= SHORT else merge)(symbols, self.merges)
        ids = struct.pack(f"<{len(symbols)}I", *symbols)
        if len(word) <= CACHED_WORD:
            self.room -= 150 + len(ids) + len(word)
            if self.room < 0:
                self.cache.clear()
                self.room = CACHE_BYTES
            self.cache[word] = ids
        return ids

    def plain(self, text: str) -> bytes:
        words = self.words(text)
        got = list(map(self.cache.get, words))
        if None in got:
            cache, word = self.cache, self.word
            got = [g if g is not None else (cache.get(w) or word(w)) for g, w in zip(got, words)]
        return b"".join(got)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers; texts of added tokens become their ids."""
        if self.split and self.split.search(text):
            return b"".join(self.added[t] if t in self.added else self.plain(t) for t in self.split.split(text) if t)
        return self.plain(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


_codecs: dict[int, Codec] = {}


def codec(shared) -> Codec:
    """The worker's codec for a broadcast vocabulary."""
    content = shared.value
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def shared_vocabulary(spark, path: str):
    small_batches(spark)
    return spark.sparkContext.broadcast(file_bytes(path))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as array<int>."""
    shared = shared_vocabulary(df.sparkSession, path)

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        c = codec(shared)
        parts = [c.encode(t.as_py() or "") for t in texts]
        offsets = np.fromiter(accumulate((len(p) // 4 for p in parts), initial=0), "int32", len(parts) + 1)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))

    ids_of = ids_of.asNondeterministic()  # else a later UDF over the ids would make them once more
    return df.withColumn(ids, ids_of(text_or_empty(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for."""
    shared = shared_vocabulary(df.sparkSession, path)

    @F.arrow_udf("string")
    def text_of(lists: pa.Array) -> pa.Array:
        c = codec(shared)
        ids, at, n = lists.flatten().to_numpy(zero_copy_only=False), 0, lists.value_lengths().fill_null(0).to_pylist()
        return pa.array([c.decode(ids[(at := at + k) - k : at].tolist()) for k in n], pa.string())

    return df.withColumn(text, text_of(F.col(f"`{ids}`")))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and SHA-256 of the ids and of the decoded text."""
    ids, decoded = fresh(docs, "ids", "decoded")
    both = decode(encode(docs.select("doc_id", "text"), path, ids=ids), path, ids, decoded)
    return both.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
