"""Deduplication, resume and lookup operators against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from postloom.functions.text import with_keys
from postloom.operators import dedup, enrich, pending, postings as post
from postloom.plans import spread
from postloom.plans.spread import hot_keys, lookup
from postloom.schema import AI_COLUMNS


@pytest.fixture(autouse=True)
def small_hot_keys(monkeypatch):
    """Let the hot-key path run on small tables."""
    monkeypatch.setattr(spread, "HOT_PART", 0.01)


def skewed(seed, n=300):
    """(id, key, flag): a third of the rows share the key 'hot', some have none."""
    rnd = random.Random(seed)
    keys = lambda: "hot" if rnd.random() < 0.34 else (None if rnd.random() < 0.1 else f"k{rnd.randrange(60)}")
    return [(i, keys(), rnd.random() < 0.5) for i in range(n)]


def test_hot_keys(spark):
    df = spark.createDataFrame(skewed(1), "i long, k string, f boolean")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, ["k"], 0.2 * width).collect()
    assert [r._hot for r in hot] == [spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]]
    assert hot_keys(df, ["k"], 0.01 * width).count() <= 100
    assert hot_keys(df, ["k"], 2.0 * width).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("part", [0.0004, 0.04, 0.8, 8.0])
def test_lookup_is_a_join(spark, how, part):
    left = spark.createDataFrame(skewed(2), "i long, k string, f boolean")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("absent", 4), (None, 5)], "k string, v int")
    got = lookup(left, right, ["k"], ["i"], how, part)
    want = left.join(right, "k", how)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_lookup_spreads_the_hot_key(spark):
    left = spark.createDataFrame([(i, "hot") for i in range(4000)], "i long, k string")
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = lookup(left, right, ["k"], ["i"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in parts) == 4000
    assert len(parts) > 1 and max(r["count"] for r in parts) < 4000


def test_keep_first(spark):
    rows = skewed(3)
    df = spark.createDataFrame(rows, "i long, k string, f boolean").repartition(5)
    first = {}
    for i, k, _ in rows:
        first.setdefault(k, i)
    kept = dedup.keep_first(df, ["k"], ["i"])
    assert sorted(r.i for r in kept.collect()) == sorted(first.values())
    assert dedup.keep_first(kept, ["k"], ["i"]).count() == len(first)
    counts = dedup.dedup_counts(df, ["k"]).first()
    assert tuple(counts) == (len(rows), len(first), len(rows) - len(first))


def test_keep_first_flagged(spark):
    for seed in range(3):
        rows = [(i, k or "", f) for i, k, f in skewed(seed)]
        seen, want = set(), []
        for i, k, f in rows:
            if f and k in seen:
                continue
            seen.add(k)
            want.append(i)
        df = spark.createDataFrame(rows, "i long, k string, f boolean").repartition(5)
        assert sorted(r.i for r in dedup.keep_first_flagged(df, ["k"], ["i"], "f").collect()) == want


def test_suppress_repeats(spark):
    rows = [(i, k or "", f) for i, k, f in skewed(4)]
    done, want = set(), []
    for i, k, ok in rows:
        if k in done:
            continue
        want.append(i)
        if ok:
            done.add(k)
    df = spark.createDataFrame(rows, "i long, k string, ok boolean")
    got = dedup.suppress_repeats(df, F.col("k"), "i", F.col("ok"), ["i"])
    assert sorted(r.i for r in got.collect()) == want


def test_cross_platform(spark):
    new = with_keys(spark.createDataFrame([("f", 1, "A b", "C"), ("f", 2, "x", ""), ("f", 3, "Z", "c")], "source_file string, row_index long, title string, company string").withColumn("location", F.lit("")))
    prior = with_keys(spark.createDataFrame([(" a  B ", "c "), ("x", "")], "title string, company string").withColumn("location", F.lit("q")))
    got = {r.row_index: r.is_duplicate for r in dedup.cross_platform_duplicates(new, prior).collect()}
    assert got == {1: True, 2: False, 3: False}


def postings(spark):
    rows = [
        ("a.csv", 0, "1", "T1", "", None), ("a.csv", 1, "", "T2", "", None), ("a.csv", 2, None, "T3", "", " "),
        ("b.csv", 0, "4", "T4", "", "Other"), ("b.csv", 1, "5", "T2", "", ""), ("b.csv", 2, "6", None, None, None),
    ]
    df = spark.createDataFrame(rows, "source_file string, row_index long, job_id string, title string, company string, AI_job_category string")
    return post.with_ai_columns(with_keys(df.withColumn("location", F.lit("x"))))


def test_pending_by_id_and_by_key(spark):
    df = postings(spark)
    key = {r.row_index if r.source_file == "a.csv" else r.row_index + 3: r.dedup_key for r in df.collect()}

    def left(*keys):
        done = spark.createDataFrame([(k,) for k in keys], "row_key string")
        return sorted((r.source_file[0], r.row_index) for r in pending.pending_rows(df, done).collect())

    every = [("a", 0), ("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert left() == every
    assert left("1") == every[1:]
    assert left(key[1]) == [("a", 0), ("a", 2), ("b", 2)]
    assert left("5") == [("a", 0), ("a", 1), ("a", 2), ("b", 2)]
    assert left("", None) == every
    assert left(*key.values()) == []
    done = spark.createDataFrame([(key[1],), ("elsewhere",)], "row_key string")
    p = pending.progress(df, done).first()
    assert (p.processed, p.total, p.remaining, p.percent) == (3, 6, 3, 50.0)


def test_pending_and_processed_make_up_the_input(spark):
    df = postings(spark).where("AI_job_category is null or trim(AI_job_category) = ''")
    done = pending.processed_keys(df.where("row_index < 2"))
    left = pending.pending_rows(df, done)
    gone = df.join(left.select("source_file", "row_index"), ["source_file", "row_index"], "left_anti")
    assert left.count() + gone.count() == df.count()
    assert pending.pending_rows(df, pending.processed_keys(df)).count() == 0


def test_progress_of_nothing(spark):
    df = postings(spark).limit(0)
    row = pending.progress(df, spark.createDataFrame([], "row_key string")).first()
    assert (row.total, row.processed, row.percent) == (0, 0, None)


def test_admission(spark):
    df = postings(spark)
    assert pending.admit(df, 0).count() == 0
    assert pending.admit(df, 99).count() == 6
    got = pending.admit(df, 4, span=2).orderBy("seq").collect()
    assert [(r.seq, r.source_file, r.row_index) for r in got] == [(1, "a.csv", 0), (2, "a.csv", 1), (3, "a.csv", 2), (4, "b.csv", 0)]


def test_bag_union_and_position(spark):
    df = postings(spark)
    assert post.bag_union(df, df.drop("title")).count() == 12
    assert post.row_at(df, "b.csv", 1).first().job_id == "5"
    assert [r.row_index for r in post.in_order(df).collect()] == [0, 1, 2, 0, 1, 2]


def test_scatter_and_alignment(spark):
    df = postings(spark)
    results = spark.createDataFrame(
        [
            ("a.csv", 0, '{"job_category": ["X", "Y"], "remote_policy": 1}', None, "direct", True),
            ("a.csv", 1, None, "words", "raw", True), ("a.csv", 2, None, None, "empty", False),
            ("none.csv", 7, '{"job_category": "lost"}', None, "direct", True),
        ],
        "source_file string, row_index long, result_json string, raw_response string, parse_status string, usable boolean",
    )
    out = {(r.source_file, r.row_index): r for r in enrich.scatter(df, results).collect()}
    assert len(out) == 6 and list(enrich.scatter(df, results).columns)[: len(df.columns)] == df.columns
    assert out["a.csv", 0].AI_job_category == "X, Y" and out["a.csv", 0].AI_remote_policy == "1"
    assert out["a.csv", 1].parse_status == "raw" and out["a.csv", 1].raw_response == "words"
    assert all(out["a.csv", 2][c] == "" or c == "AI_job_category" for c in AI_COLUMNS)
    assert out["b.csv", 0].AI_job_category == "Other"
    aligned = enrich.aligned_results(df, results)
    assert aligned.count() == 6 and aligned.where("parse_status is null").count() == 4
