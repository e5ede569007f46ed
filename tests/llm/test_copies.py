"""Near copies, repeated strings and nearest vectors against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm.helpers import EDGES, docs, syllables
from postloom.llm import ann, repeats, simhash, suffix


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode()
    words = [w for w in words.replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    label = {}
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                group[root(i)] = root(j)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            label[root(i)] = min(label.get(root(i), d), d)
    return sorted(((d, f"{p:016x}", label.get(root(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def near_copies(rng, n):
    base = [syllables(rng, rng.randint(40, 150)).split() for _ in range(12)]
    out = []
    for _ in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = syllables(rng, 1)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("leaf", [4, 256])
def test_simhash_components(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rng = random.Random(leaf)
    texts = EDGES + near_copies(rng, 150) + [syllables(rng, rng.randint(1, 5)) for _ in range(60)]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(None, texts[12]), (None, "only here, without an id")]
    got = simhash.digests(docs(spark, rows).withColumn("fp", F.lit("clash"))).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(rows)
    assert simhash.digests(docs(spark, [])).count() == 0


def test_texts_of_one_id_and_chains_through_rows_without_one(spark):
    rng = random.Random(4)
    a, b, c = (syllables(rng, 200) for _ in range(3))
    far = dict(enumerate(c.split()))
    bridge = " ".join(far.get(i, w) if i % 40 else w for i, w in enumerate(a.split()))
    rows = [(3, a), (5, a), (5, b), (7, b), (None, bridge), (11, bridge + " x"), (None, "alone"), (None, "alone")]
    got = simhash.digests(docs(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(rows)
    assert {r.component_id for r in got if r.doc_id in (3, 5, 7)} == {3}
    kept = simhash.keep_one(docs(spark, rows))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({c for _, _, c in plain_components(rows) if c is not None})
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["alone"]


def test_keep_one_keeps_the_smallest_of_each_component(spark):
    rng = random.Random(9)
    rows = list(enumerate(near_copies(rng, 60))) + [(None, "no id"), (None, "no id"), (7, "seven again")]
    kept = simhash.keep_one(docs(spark, rows[:-1]))
    want = {d for d, _, c in plain_components(rows[:60]) if d == c}
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(want)
    assert kept.where("doc_id is null").count() == 1


def test_shard_links_in_dense_groups():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype="u8")
    points = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))) for c in centres for _ in range(60)]
    points = np.unique(np.array(points + [np.uint64(i) for i in range(3000)], "u8"))  # the last differ in few bits
    found = np.concatenate([simhash.shard_links(points, m, 3) for m in simhash.HALVES], axis=1)
    label = np.arange(len(points))
    want = label.copy()

    def spread(label, a, b):
        while True:
            least = label.copy()
            np.minimum.at(least, a, label[b])
            np.minimum.at(least, b, label[a])
            if (least == label).all():
                return label
            label = least

    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    assert (spread(label, *found) == spread(want, *np.nonzero(near))).all()


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(1200):
        k = rng.choice([1, 2, 3, 5, 200])
        s = bytes(rng.randrange(k) for _ in range(rng.randint(0, 60)))
        s = s + s[: rng.randint(0, 60)] * rng.randint(0, 2)
        order = sorted(range(len(s)), key=lambda i: s[i:])
        t = np.frombuffer(s, "u1")
        sa = suffix.suffix_array(t)
        assert sa.tolist() == order
        if s:
            before, after = suffix.common_prefixes(t, sa)
            for a, b in zip(order, order[1:]):
                n = next((i for i, (x, y) in enumerate(zip(s[a:], s[b:])) if x != y), min(len(s) - a, len(s) - b))
                assert before[b] == n == after[a]


def plain_repeats(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + width] for b in texts for i in range(len(b) - width + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 9_000)
    rng = random.Random(hot)
    base = [syllables(rng, rng.randint(5, 90)) for _ in range(30)]
    texts = list(EDGES)
    for _ in range(140):
        a, b = rng.choice(base), rng.choice(base)
        x, y = rng.randint(0, len(a)), rng.randint(0, len(b))
        texts.append(rng.choice([a, syllables(rng, 1) + a[x : x + rng.randint(0, 400)] + syllables(rng, 1) + b[y:], "ab" * rng.randint(1, 400), "a" * rng.randint(0, 600), a * 2 + b, syllables(rng, 60)]))
    rows = list(enumerate(texts)) + [(3, texts[40]), (None, "x" * 500)]
    got = repeats.digests(docs(spark, rows).withColumn("tid", F.lit(0))).collect()
    assert sorted(map(tuple, got), key=repr) == plain_repeats(rows, 200)
    assert repeats.digests(docs(spark, [])).count() == 0
    cut = repeats.removed(docs(spark, rows))
    assert cut.count() == len(rows) and cut.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    plain = {r[0]: r for r in plain_repeats(rows, 200)}
    for r in cut.where("doc_id > 3").collect():
        _, n, removed, _, digest = plain[r.doc_id]
        assert r.n_chars == len(r.text or "")
        if removed == 0 or (texts[r.doc_id] or "").isascii():
            assert hashlib.sha256((r.text or "").encode()).hexdigest() == digest


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 24)).astype("f4")
    x[100:160] = x[100]  # one very common vector
    x[200:260] = x[200] + rng.standard_normal((60, 24)) * 0.05
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(1000, None, 0), (1050, [0.0] * 24, 0), (1100, [float("nan")] * 24, 0), (1150, [1.0, None] * 12, 0), (1200, [1.0, 2.0], 0), (None, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("shard", F.lit(1))
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 50))
    v = x.astype("f8")
    hits = 0
    for q, found in got.items():
        score = ann.cosines(v, np.broadcast_to(v[q], v.shape))
        order = [i for i in np.lexsort((np.arange(900), -score)) if i != q][:5]
        hits += len({i for i, _ in found} & set(order))
        assert len(found) == 5 and all(abs(s - score[i]) < 1e-12 for i, s in found)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
    assert hits >= 0.9 * 5 * len(got)
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105]
    few = df.where("vec_id in (0, 1, 2)")
    assert ann.nearest(few, F.col("vec_id") % 50 == 0).count() == 2
    assert ann.nearest(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (500, 16), dtype="u2")
    codes[:100] = codes[0] ^ (rng.random((100, 16)) < 0.3).astype("u2")
    index = ann.Index(codes)
    for t in range(17):
        near = np.flatnonzero(ann.bits_apart(codes, codes[:1]) <= 16 * (t + 1) - 1)
        assert index.within(codes[0], t).tolist() == near.tolist()
