"""Bounded-space online packing of token pieces into fixed-size sequences.

Each task keeps ``open_windows`` open windows of ``capacity`` tokens and reads its documents once, in order. A
document (its ids, then the separator) goes whole into the tightest open window that holds it (best fit; ties to
the window opened first). If none holds it and a window slot is free, a new window is opened for it. If all slots
are taken, the fullest window is emitted: first it is filled up with the head of the document, which is cut there,
and the rest of the document is placed in the same way. Documents longer than a window are cut into whole windows
on the way. Emitted windows are therefore always full. The windows still open when a task ends are the leftovers;
they are merged in a fixed order (task, then window) by prefix sums of their fills and cut into full sequences,
the last one excepted, so that all sequences but one hold ``capacity`` tokens.

Ids are those of the ``tokenizers`` library. Its normaliser and pre-tokenizer are simple over the characters of
``SAFE``: there Arrow cuts a slice of texts into words and finds the different ones, each of which is encoded once for
the slice by a library with the same merges; numpy lays the ids of the words out again. A word ends with the only id
whose token has the end mark, which tells the words' ids apart. Texts with other characters or with texts of added
tokens, and vocabularies with other rules, go through the ``tokenizers`` library whole.

Memory of a task is its open windows and one slice of texts; the merge of leftovers orders one row per leftover window
(at most ``open_windows`` per input partition) in one task, and moves the leftover pieces themselves in parallel.
Checksums of finished windows are taken in the task; those of cut leftover pieces by Spark's ``crc32`` on their bytes.

Defined results: a null text is empty, so its document is the separator alone; a null doc_id is packed like any
other; repeated rows are packed once each; an empty table gives no rows; extra columns are ignored. ``start`` counts
the document's ids before the piece, ``doc_tokens`` all its ids, separator included; ``sequence_id`` is
``partition * 2**32 + window`` for windows filled in a task and negative for merged leftovers; ``offset`` is the
piece's place in its sequence, gapless from 0.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from postloom.llm.bpe import byte_letters
from postloom.llm.common import file_bytes, small_batches, text_or_empty, written

CAPACITY = 4096
OPEN_WINDOWS = 8
SEPARATOR = 2


class Windows:
    """Open windows of one task; ``place`` returns the windows it emits, each a list of pieces."""

    def __init__(self, capacity: int, slots: int):
        self.capacity, self.slots = capacity, slots
        self.open: list[list] = []  # [serial, fill, pieces]
        self.serial = 0

    def _new(self) -> list:
        self.serial += 1
        window = [self.serial - 1, 0, []]
        self.open.append(window)
        return window

    def _put(self, window: list, piece: tuple, length: int) -> None:
        window[1] += length
        window[2].append((window[1] - length, length, piece))

    def place(self, n: int, payload) -> list[tuple[int, list]]:
        """Place a document of ``n`` ids; ``payload`` is handed back with ``(start, length)`` of each piece."""
        done, start, rest = [], 0, n
        while rest > 0:
            free = [(self.capacity - w[1], w[0], w) for w in self.open if self.capacity - w[1] >= rest]
            if free:
                window, take = min(free, key=lambda f: (f[0], f[1]))[2], rest
            elif len(self.open) < self.slots:
                window = self._new()
                take = min(rest, self.capacity)
            else:
                window = max(self.open, key=lambda w: (w[1], -w[0]))
                take = self.capacity - window[1]
            self._put(window, (payload, start), take)
            start, rest = start + take, rest - take
            if window[1] == self.capacity:
                self.open.remove(window)
                done.append((window[0], window[2]))
        return done


# Rules of the vocabulary file that ``Encoder`` follows by itself over SAFE characters.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
END = "</w>"
# ASCII, Latin, Cyrillic and punctuation: unchanged by NFC, no combining marks, lower-cased one by one.
RANGES = ((0x09, 0x0E), (0x20, 0x7F), (0xA0, 0x130), (0x131, 0x250), (0x400, 0x483), (0x48A, 0x530), (0x2010, 0x2028), (0x2030, 0x205F))
SAFE = "".join(chr(c) for a, b in RANGES for c in range(a, b))
SLICE_CHARS = 1 << 22  # texts that are split at once


def _class(kinds: str) -> str:
    """The lower-cased safe characters of these Unicode categories, for a class of an RE2 pattern."""
    chars = sorted(c for c in set(SAFE.lower()) if unicodedata.category(c)[0] in kinds and not c.isspace())
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


UNSAFE_RE = re.compile(f"[^{re.escape(SAFE)}]")
# Whatever is neither white space nor a run of letters, as the vocabulary's rules cut it.
MARKS = f"('(?:s|t|re|ve|m|ll|d)|[{_class('N')}]|[{_class('PSCM')}]+)"


class Encoder:
    """Ids of texts as the ``tokenizers`` library gives them, each word encoded once for all its places in a slice."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(content)
        model = spec["model"]
        self.added = [t["content"] for t in spec["added_tokens"]]
        rules = (spec["normalizer"] or {}).get("normalizers"), (spec["pre_tokenizer"] or {}).get("pretokenizers")
        known = rules == (NORMALIZERS, PRETOKENIZERS) and all(not t["normalized"] for t in spec["added_tokens"])
        usual = model["type"] == "BPE" and model["end_of_word_suffix"] == END and not model["dropout"] and not model["ignore_merges"]
        letters = byte_letters()
        self.by_words = known and usual and all(c in model["vocab"] and c + END in model["vocab"] for c in letters)
        if self.by_words:
            self._words(model, letters)

    def _words(self, model: dict, letters: list[str]) -> None:
        """The vocabulary over bytes, a blank for the end mark, its ranks in merge order."""
        import tiktoken

        of_letter = {c: b for b, c in enumerate(letters)}
        merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
        ranks, ids, final = {}, [], []
        for token in [*letters, *(c + END for c in letters), *merged]:
            last = token.endswith(END)
            key = bytes(of_letter[c] for c in token.removesuffix(END)) + b" " * last
            if key in ranks:  # two tokens of the same bytes
                self.by_words = False
                return
            ranks[key] = len(ids)
            ids.append(model["vocab"][token])
            final.append(last)
        self.ids, self.final = np.array(ids, "<u4"), np.array(final)
        self.quick = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def plain(self, text: str) -> bool:
        """Whether the text's words can be told here."""
        return self.by_words and UNSAFE_RE.search(text) is None and not any(t in text for t in self.added)

    def slice(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts."""
        lower = pa.array([t.lower().replace("\xa0", " ") for t in texts], pa.string())
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, MARKS, r" \1 "))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py() + " "
        ranks = self.quick.encode_to_numpy(joined, disallowed_special=())
        sizes = np.zeros(len(words), np.int64)
        real = pc.binary_length(words).to_numpy() > 0
        sizes[real] = np.diff(np.flatnonzero(self.final[ranks]), prepend=-1)
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[ranks[np.repeat(starts[codes] - ends[:-1], lengths) + np.arange(ends[-1])]]
        bounds = ends[split.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def each(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order; slices of plain texts are encoded together."""
        held, chars = [], 0
        for text in texts:
            plain = self.plain(text)
            if plain:
                held.append(text)
                chars += len(text)
            if held and (not plain or chars >= SLICE_CHARS):
                yield from self.slice(held)
                held, chars = [], 0
            if not plain:
                yield self.whole(text)
        if held:
            yield from self.slice(held)


_encoders: dict[int, Encoder] = {}


def encoder(content: bytes) -> Encoder:
    key = hash(content)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(content)
    return _encoders[key]


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, separator: int = SEPARATOR) -> DataFrame:
    """Pieces of ``docs`` (``doc_id``, ``text``): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(file_bytes(path))
    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint, ids binary, window bigint, offset bigint, leftover boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value)
        windows = Windows(capacity, open_windows)
        base = TaskContext.get().partitionId() << 32
        tail = np.array([separator], "<u4")
        cols: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids", "window", "offset", "leftover")}

        def emit(serial: int, pieces: list, leftover: bool) -> None:
            for offset, length, ((doc_id, ids), start) in pieces:
                chunk = ids[start : start + length].tobytes()
                for k, v in (("doc_id", doc_id), ("start", start), ("length", length), ("doc_tokens", len(ids)), ("window", base + serial), ("offset", offset)):
                    cols[k].append(v)
                cols["ids_crc32"].append(None if leftover else zlib.crc32(chunk))
                cols["ids"].append(chunk if leftover else None)
                cols["leftover"].append(leftover)

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict(
                cols,
                schema=pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                                  ("ids", pa.binary()), ("window", pa.int64()), ("offset", pa.int64()), ("leftover", pa.bool_())]),
            )
            for v in cols.values():
                v.clear()
            return out

        for batch in batches:
            # In this thread: a task has one core, and no pool of threads holds memory.
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.each(t.as_py() for t in batch.column("text"))):
                ids = np.concatenate([ids, tail])
                for serial, pieces in windows.place(len(ids), (doc_id, ids)):
                    emit(serial, pieces, False)
            yield flush()
        for serial, _, pieces in windows.open:
            emit(serial, pieces, True)
        yield flush()

    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text")).mapInArrow(run, schema)
    made = written(made, "llm-windows")
    full = made.where("not leftover").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("window").alias("sequence_id"), "offset")
    return full.unionByName(merged(made.where("leftover"), capacity))


def merged(left: DataFrame, capacity: int) -> DataFrame:
    """Leftover pieces laid end to end, window after window, and cut into sequences of ``capacity`` tokens."""
    fills = left.groupBy("window").agg(F.sum("length").alias("fill"))
    # One row for each leftover window: at most the open windows of each input partition.
    order = Window.orderBy("window").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bases = fills.select("window", (F.sum("fill").over(order) - F.col("fill")).alias("base"))
    placed = left.join(F.broadcast(bases), "window").withColumn("g", F.col("base") + F.col("offset"))
    first, last = F.floor(F.col("g") / capacity), F.floor((F.col("g") + F.col("length") - 1) / capacity)
    cut = placed.withColumn("k", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("g"), F.col("k") * capacity)
    hi = F.least(F.col("g") + F.col("length"), (F.col("k") + 1) * capacity)
    skip = lo - F.col("g")
    piece = F.substring(F.col("ids"), (skip * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int"))
    return cut.select(
        "doc_id",
        (F.col("start") + skip).alias("start"),
        (hi - lo).alias("length"),
        F.crc32(piece).alias("ids_crc32"),
        "doc_tokens",
        (-1 - F.col("k")).cast("bigint").alias("sequence_id"),
        (lo - F.col("k") * capacity).cast("bigint").alias("offset"),
    )
