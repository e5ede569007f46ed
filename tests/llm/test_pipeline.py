"""Each stage of the pipeline against a plain version on its own input."""

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from llm.test_copies import plain_components, plain_repeats
from postloom.llm import quality, rules
from postloom.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    inputs, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = (inputs, written(stage(spark, inputs, SF), "test-stage"))
        inputs = seen[name][1]
        if name != "best_fit_packing":
            assert inputs.columns == docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = seen["quality_classifier"]
    scored = quality.predictions(before, labels)
    assert ids(after) == ids(scored.where("predicted = 1"))
    before, after = seen["quality_rules"]
    chosen = rules.cutoffs(docs, labels)[1]  # certified on all labelled documents of the table
    assert ids(after) == sorted(r.doc_id for r in rules.with_verdicts(rules.counts(before), chosen).where("kept").collect())
    before, after = seen["simhash_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted(d for d, _, c in plain_components(rows) if d == c)
    before, after = seen["suffix_array_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    left = {d: n - gone for d, n, gone, *_ in plain_repeats(rows, 200)}
    assert ids(after) == ids(before)
    for r in after.collect():
        assert left[r.doc_id] - 6 <= len(r.text.encode()) <= left[r.doc_id]
    before, after = seen["best_fit_packing"]
    made = after.collect()
    assert {r.doc_id for r in made} == set(ids(before))
    used = {}
    for r in made:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048
    assert len(used) <= 1.02 * np.ceil(sum(used.values()) / 2048) + 1
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(whole.columns) == sorted(after.columns) and whole.count() == len(made)


def test_every_operator_is_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages_on_empty_and_clashing_tables(spark):
    """Each stage takes an empty table, and extra columns with the names its own work uses, without crashing."""
    from pyspark.sql import functions as F

    docs = table(spark, SF, "documents").limit(60)
    clashing = docs.withColumns({c: F.lit(1) for c in ("score", "y", "label_id", "kept_fp", "kept_node", "tid", "kept", "row", "stratum")})
    for inputs in (docs.limit(0), clashing):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, inputs, SF), "test-edge")
            if name != "best_fit_packing":
                assert out.columns == inputs.columns
            inputs = out
        assert out.count() == 0 or out.where("length > 0").count() == out.count()
