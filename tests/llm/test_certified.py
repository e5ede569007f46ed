"""What the certified rules reject, in the pipeline and in small strata."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from llm.helpers import DOCS, syllables
from postloom.llm import rules


def junk(rng, n):
    return " ".join(w + rng.choice(["#", "$", "|", "%"]) for w in syllables(rng, n).split())


def labelled(spark, sizes, seed=3):
    """Documents and labels: of each language so many clean ones, and a quarter as many full of symbols."""
    rng = random.Random(seed)
    rows = [(lang, syllables(rng, rng.randint(60, 90)), 1) for lang, n in sizes.items() for _ in range(n)]
    rows += [(lang, junk(rng, rng.randint(60, 90)), 0) for lang, n in sizes.items() for _ in range(n // 4)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, lang, "src", len(t)) for i, (lang, t, _) in enumerate(rows)], DOCS)
    return docs, spark.createDataFrame([(i, y, 0) for i, (*_, y) in enumerate(rows)], "doc_id bigint, quality int, toxic int")


def test_stage_rejects_what_the_classifier_let_pass(spark, tmp_path):
    docs, labels = labelled(spark, {"en": 1600})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rng = random.Random(6)
    passed = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    passed = passed.unionByName(spark.createDataFrame([(10**6, junk(rng, 80), "en", "src", 1), (10**6 + 1, syllables(rng, 80), "en", "src", 1)], DOCS))
    kept = {r.doc_id for r in corpus_pipeline.within_rules(spark, passed, str(tmp_path)).select("doc_id").collect()}
    assert 10**6 not in kept and 10**6 + 1 in kept and len(kept) > 0.95 * 1600


def test_small_strata_have_cutoffs(spark):
    docs, labels = labelled(spark, {"en": 1500, "de": 340, "fr": 370, "es": 226, "rare": 8})
    rows = rules.report(docs, labels).join(docs.select("doc_id", "lang"), "doc_id").join(labels, "doc_id")
    got = rows.groupBy("lang", "quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {(r.lang, r.quality): r.kept for r in got}
    for lang in ("en", "de", "fr", "es"):
        assert kept[lang, 0] < 0.05 and kept[lang, 1] > 1 - rules.RATE
    assert kept["rare", 1] == 1


def test_no_stratum_loses_more_than_the_rate(spark):
    """Ratios that tell nothing, at sizes at which luck on one half chooses cutoffs."""
    rng = random.Random(11)
    lost = 0
    for _ in range(3):
        rows = [(i, rng.choice(["a", "b", None]), 100, 500, int(rng.paretovariate(1)), 10, rng.randint(0, 3), rng.randint(0, 40), int(rng.random() < 0.2)) for i in range(1500)]
        df = spark.createDataFrame(rows, "doc_id bigint, lang string, " + ", ".join(f"{c} bigint" for c in rules.COUNTS) + ", quality int")
        chosen = rules.certified_unions(df.drop("quality"), df.select("doc_id", "quality"))
        made = rules.with_verdicts(df.drop("quality"), chosen).join(df.select("doc_id", "quality"), "doc_id").where("quality = 1")
        lost += sum(r.share > 1.5 * rules.RATE for r in made.groupBy("lang").agg(F.avg(1 - F.col("kept").cast("int")).alias("share")).collect())
    assert lost == 0


def test_repeated_rows_count_once(spark):
    """Three labelled documents repeated ten times are three documents to the binomial bound, not thirty."""
    from postloom.llm import rules

    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(i % 3, text + f" {i % 3}", "en", "s") for i in range(30)], "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(d, 1, 0) for d in range(3)], "doc_id bigint, quality int, toxic int")
    known = rules.known_rows(rules.counts(docs), labels, "quality", "lang")
    assert known.count() == sum(1 for d in range(3) if not rules_held(spark, d))


def rules_held(spark, d):
    from postloom.llm.quality import held_out

    return spark.createDataFrame([(d,)], "doc_id bigint").select(held_out().alias("h")).first().h
