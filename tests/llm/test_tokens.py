"""Token counts, byte-level BPE and packing against the tokenizers library."""

import hashlib
import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers

from llm.helpers import EDGES, docs, syllables
from postloom.llm import bpe, counts, packing
from postloom.llm.queries import BPE, PIECES

ODD = ["a", "B", "é", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "᠎", "　", "﻿", "'s", "'ll", "1", "²", "漢", "😀", "<|endoftext|>", "<|endo", "!", "́", "aaaa", "The", " the"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BPE)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return EDGES + [syllables(rng, rng.randint(1, 90)) for _ in range(30)] + ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(300)]


def test_codec_encodes_and_decodes_as_the_library(library, texts):
    codec = bpe.Codec(open(BPE, "rb").read())
    for t in filter(None, texts):
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 9))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode([60_000]) == ""


def test_segment_tree_and_short_form_agree():
    rng = random.Random(7)
    merges = {(a, b): r << 20 | 4 + r for r, (a, b) in enumerate(sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(40)}, key=lambda _: rng.random()))}
    for _ in range(800):
        symbols = [rng.randrange(5) for _ in range(rng.randint(0, 40))]
        assert bpe.merge(symbols[:], merges) == bpe.merge_short(symbols[:], merges)


def test_bpe_digests(spark, library, texts):
    got = {r.doc_id: r for r in bpe.digests(docs(spark, enumerate(texts)).withColumn("ids", F.lit(1)), BPE).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digests(docs(spark, []), BPE).count() == 0


@pytest.mark.parametrize("fallback", [True, False])
def test_token_counts_as_the_library(spark, texts, fallback):
    if fallback:
        pieces, _ = counts.vocabulary(open(PIECES, "rb").read())
    else:
        pieces = [("a", -1.0), ("aa", -2.0), ("ab", -2.0), ("b", -1.0), ("aab", -3.0), ("▁", -1.0), ("▁a", -2.0), ("b▁a", -1.5)]
    first = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] * fallback
    t = Tokenizer(models.Unigram(first + pieces, unk_id=0, byte_fallback=fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    counter = counts.Counter(pieces, fallback)
    rng = random.Random(2)
    small = ["".join(rng.choice(["a", "b", "c", "d", " ", "▁"]) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    for x in filter(None, texts + small):
        assert counter.count(x) == len(t.encode(x, add_special_tokens=False).ids)
    assert counter.count("") == 0


def test_token_count_query(spark):
    got = {r.doc_id: r.n_tokens for r in counts.report(docs(spark, enumerate(EDGES)), PIECES).collect()}
    counter = counts.counter(open(PIECES, "rb").read())
    assert got == {i: counter.count(t or "") for i, t in enumerate(EDGES)}


def plain_best_fit(histogram, capacity):
    left, bins = [], 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect_left(left, length)
            room = left.pop(at) if at < len(left) else capacity
            bins += room == capacity
            if room > length:
                insort(left, room - length)
    return bins


def test_runs_pack_like_plain_best_fit():
    rng = random.Random(4)
    for _ in range(600):
        capacity = rng.choice([7, 20, 64, 100])
        h = {rng.randint(1, capacity): rng.randint(1, rng.choice([3, 40])) for _ in range(rng.randint(0, 20))}
        bins, ranks = {}, {}
        for length, first, n, at, offset, per in packing.best_fit_runs(h, capacity):
            assert first == ranks.get(length, 0)
            ranks[length] = first + n
            for j in range(n):
                bins.setdefault(at + j // per, []).append((offset + j % per * length, length))
        assert ranks == h
        for places in bins.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(bins) == plain_best_fit(h, capacity)


def test_pack(spark, library, texts):
    rows = list(enumerate(texts)) + [(0, texts[5]), (None, "x")]
    made = packing.pack(docs(spark, rows), BPE, capacity=64, keep_ids=True).collect()
    of = {}
    for r in made:
        of.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for parts in of.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0] + [r.length for r in parts[:-1]]).tolist()
        assert sum(r.length for r in parts) <= 64
    for i in range(1, len(texts)):
        parts = sorted((r for r in made if r.doc_id == i), key=lambda r: r.piece)
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        assert sum((r.ids for r in parts), []) == ids
        assert [r.length for r in parts][1:] == [64] * (len(parts) - 1)
        assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts[:-1]]).tolist()
    assert packing.pack(docs(spark, []), BPE).count() == 0
    assert path("byte_bpe_50k.json") == BPE
