"""Plan shapes that decide whether a query survives large, skewed tables."""

import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.queries import QUERIES
from postloom.operators import attempts as att
from postloom.operators import pending

SF = "/root/testdata/sf0.001"
LAZY = sorted(
    set(QUERIES)
    - {
        "posting_scan", "text_row_numbers", "raw_ingest", "record_rehydrate", "resume_listing", "resume_load", "enriched_write",
        "ordered_commit", "resume_retention", "enrich_table", "enrich_rows", "generate_with_fallback", "observed_progress",
        "stream_ingest", "stream_dedup", "stream_daily_usage", "stream_enrich",
    }
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_no_products(spark, no_auto_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    # With automatic broadcasts off, what is left are the hot-key lists.
    assert text.count("BroadcastExchange") <= 2 * text.count("_fan")


def test_keep_first_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["dedup_keep_first"](spark, SF))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text


def test_windows_are_split_by_slice(spark, no_auto_broadcast):
    df = fx.attempts(spark, SF)
    for out in (
        att.circuit_breaker(df, ["batch_id"], "seq", F.col("ok")),
        att.commit_marks(df, ["batch_id"], "seq", F.col("ok")),
    ):
        lines = plan(out).split("\n")
        assert not any("SinglePartition" in line for line in lines)
        # Rows are shuffled by batch and slice; by batch alone only once they are sums per slice.
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line and "_slice" not in line:
                assert any("Aggregate(keys=[batch_id" in below and "_slice" in below for below in lines[i : i + 4])


def test_file_ranks_meet_in_no_single_task(spark):
    text = plan(pending.admit(fx.keyed(spark, SF), 10))
    assert text.count("SinglePartition") == 0


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["dedup_keep_first"](spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string>" in text
    assert "text:string" not in text


def test_resume_state_is_pruned_by_batch(spark, tmp_path):
    from postloom.sources import resume

    path = f"{tmp_path}/processed"
    df = spark.createDataFrame([("k", "b1"), ("k", "b2")], "row_key string, batch_id string")
    df.withColumns({"run": F.lit("r"), "wave": F.lit(0), "done_at": F.current_timestamp()}).write.partitionBy(
        "batch_id", "run", "wave"
    ).parquet(path)
    text = plan(resume.load_batch(resume.read_processed(spark, path), "b1"))
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id", text)


def test_position_filter_is_pushed(spark, tmp_path):
    from postloom.operators.postings import row_at

    path = f"{tmp_path}/p"
    fx.postings(spark, SF).select("source_file", "row_index", "title").write.parquet(path)
    text = plan(row_at(spark.read.parquet(path), "f3.csv", 43))
    assert "EqualTo(row_index,43)" in text and "EqualTo(source_file,f3.csv)" in text
