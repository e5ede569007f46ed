"""Sources, sinks and streams."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from postloom import runs
from postloom.functions.text import with_keys
from postloom.operators.pending import done_keys
from postloom.schema import ROW_ID, HEADINGS, POSTING_SCHEMA
from postloom.session import shared_dir
from postloom.sources import postings as src
from postloom.sources import resume, sinks, templates
from postloom.streaming import streams


def headed(spark, n, start=0):
    rows = [
        (f"Title {i}", "Line one\nsaid \"two\", three" if i % 2 else " padded ", "2024-01-02", str(1000.5 + i), f"j{i}")
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(
        rows, "`Job Title` string, `Job Description` string, `Posted Date` string, `Estimated Annual Salary` string, `Job Link` string"
    )


OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_scan(spark, fmt):
    path = shared_dir(spark, "scan")
    out = headed(spark, 40).repartition(3).write
    (out.options(**OPTIONS) if fmt == "csv" else out).format(fmt).save(path)
    rows = src.scan_postings(spark, path, fmt, multiline=True).collect()
    assert len(rows) == 40
    per_file = {}
    for r in rows:
        per_file.setdefault(r.source_file, []).append(r.row_index)
        assert r.job_id == str(r.row_index)
        i = int(r.title.split()[1])
        assert r.description == ('Line one\nsaid "two", three' if i % 2 else " padded ")
        assert (r.estimated_annual, str(r.posted_date), r.job_status, r.currency) == (1000.5 + i, "2024-01-02 00:00:00", "Active", "USD")
        assert r.location is None and r.AI_job_category is None
    assert all(sorted(v) == list(range(len(v))) for v in per_file.values())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_columns_go_by_name_in_each_file(spark, fmt):
    path = shared_dir(spark, "headers")
    headers = [["Job Title", "Company Name"], ["Company Name", "Job Title", "AI_job_category"], ["AI_remote_policy", "Job Title"]]
    for k, names in enumerate(headers):
        rows = spark.createDataFrame([tuple(f"{n} {k}" for n in names)], ", ".join(f"`{n}` string" for n in names)).coalesce(1)
        (rows.write.options(header=True) if fmt == "csv" else rows.write).mode("append").format(fmt).save(path)
    got = sorted((r.title, r.company, r.AI_job_category, r.AI_remote_policy) for r in src.scan_postings(spark, path, fmt).collect())
    assert got == [
        ("Job Title 0", "Company Name 0", None, None),
        ("Job Title 1", "Company Name 1", "AI_job_category 1", None),
        ("Job Title 2", None, None, "AI_remote_policy 2"),
    ]


def test_files_of_one_name_keep_apart(spark):
    """A partitioned table is scanned, enriched and written back; two inputs with one stem both stay."""
    path, work = shared_dir(spark, "partitioned"), shared_dir(spark, "work")
    rows = spark.createDataFrame([(f"t{i}", "ab"[i % 2]) for i in range(8)], "`Job Title` string, country string")
    rows.coalesce(1).write.partitionBy("country").parquet(path)

    def echo(prompts):
        return [{"text": json.dumps({"job_category": p}), "input_tokens": 1, "output_tokens": 1} for p in prompts]

    scan = src.scan_postings(spark, path)
    ids = [tuple(r) for r in scan.select("source_file", "row_index").collect()]
    assert len(set(ids)) == 8 and {i.split("/")[0] for i, _ in ids} == {"country=a", "country=b"}
    scan = scan.withColumn("job_id", F.concat_ws("#", *ROW_ID))  # positions are ids within one file only
    report = runs.enrich_table(scan, echo, work, "all", "{title}")
    assert (report.processed, report.stop_reason) == (8, "complete")
    runs.write_table(scan, work, "all", f"{work}/table")
    assert sorted((r.title, r.AI_job_category) for r in spark.read.parquet(f"{work}/table").collect()) == [(f"t{i}", f"t{i}") for i in range(8)]
    twins = spark.createDataFrame([("in/jobs.csv", 0), ("in/jobs.json", 0), ("other/jobs.csv", 0)], "source_file string, row_index long")
    sinks.write_enriched(twins.where("source_file <> 'in/jobs.json'"), f"{work}/twins")
    sinks.write_enriched(twins.where("source_file = 'in/jobs.json'"), f"{work}/twins")
    assert sorted(r.source_file for r in spark.read.parquet(f"{work}/twins").collect()) == ["in/jobs.csv", "in/jobs.json", "other/jobs.csv"]


def test_raw_and_stored_records_can_be_enriched(spark):
    path, work = shared_dir(spark, "raw-in"), shared_dir(spark, "raw-work")
    spark.createDataFrame([('{"title": "a", "company": "c"}',), ('{"title": "b", "company": "c"}',), ('{"title": "a", "company": "c"}',)], "value string").coalesce(1).write.text(f"{path}/raw")
    spark.createDataFrame([('{"job_id": "1", "title": "a", "ai_analyzed": true}',), ('{"job_id": "2", "title": "b"}',)], "value string").coalesce(1).write.text(f"{path}/stored")
    count = lambda prompts: [{"text": '{"job_category": "x"}', "input_tokens": 1, "output_tokens": 1} for _ in prompts]
    # Of two rows with one key and no id the second is not sent; a row marked as analysed neither.
    assert runs.enrich_table(src.from_raw(src.read_raw(spark, f"{path}/raw")), count, work, "raw", "{title}").processed == 2
    assert runs.enrich_table(src.read_records(spark, f"{path}/stored"), count, work, "stored", "{title}").processed == 1


def test_row_numbers_across_splits(spark):
    path = shared_dir(spark, "splits")
    spark.createDataFrame([(f"Title {i:05d}",) for i in range(5000)], "`Job Title` string").coalesce(1).write.json(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        scan = src.scan_postings(spark, path, "json")
        assert scan.rdd.getNumPartitions() > 3
        assert all(int(r.title.split()[1]) == r.row_index for r in scan.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_folder(spark):
    path = shared_dir(spark, "folder")
    os.makedirs(path)
    for name in ("jobs1.csv", "jobs2.csv", "~$jobs1.csv", "old_ai_gemini.csv", "notes.txt"):
        with open(f"{path}/{name}", "w") as f:
            f.write("Job Title,Company Name\na,b\nc,d\n")
    finished = spark.createDataFrame([("jobs2_ai_gemini.csv",)], "file_name string")
    assert {r.file_name for r in src.pending_files(spark, path, ".csv").collect()} == {"jobs1.csv", "jobs2.csv"}
    rows = src.scan_folder(spark, path, "csv", finished).collect()
    assert [(r.source_file, r.row_index, r.title) for r in sorted(rows, key=lambda r: r.row_index)] == [("jobs1.csv", 0, "a"), ("jobs1.csv", 1, "c")]
    done = spark.createDataFrame([("jobs1_ai_gemini.csv",), ("jobs2_ai_gemini.csv",)], "file_name string")
    none = src.scan_folder(spark, path, "csv", done)
    assert none.count() == 0 and none.columns == src.scan_folder(spark, path, "csv").columns


def test_raw_records(spark):
    path = shared_dir(spark, "raw")
    docs = [
        {"id": "x1", "title": "A", "min_amount": 1.5, "currency": "", "date_posted": "2024-02-03", "extra": [1]},
        {"id": "x2", "company": "C", "max_amount": 9, "currency": "SGD", "interval": "hourly", "date_posted": "soon"},
    ]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(path)
    rows = {r.job_id: r for r in src.from_raw(src.read_raw(spark, path), "linkedin").collect()}
    assert (rows["x1"].min_amount, rows["x1"].currency, rows["x1"].interval, rows["x1"].platform) == (1.5, "USD", "yearly", "linkedin")
    assert str(rows["x1"].posted_date) == "2024-02-03 00:00:00" and rows["x2"].posted_date is None
    assert (rows["x2"].max_amount, rows["x2"].currency, rows["x2"].interval, rows["x2"].title) == (9.0, "SGD", "hourly", None)
    nan = spark.createDataFrame([("n", float("nan"))], "id string, min_amount double")
    assert src.from_raw(src.with_missing(nan, src.RAW_SCHEMA)).first().min_amount is None


def test_records(spark):
    path = shared_dir(spark, "records")
    docs = [{"job_id": "1", "posted_date": "2024-02-03T04:05:06", "ai_analysis": {"a": [1]}, "ai_analyzed": True, "zzz": 1}, {"posted_date": "Feb 3, 2024"}]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1).write.text(path)
    one, two = sorted(src.read_records(spark, path).collect(), key=lambda r: r.job_id, reverse=True)
    assert (str(one.posted_date), json.loads(one.ai_analysis), one.ai_analyzed) == ("2024-02-03 04:05:06", {"a": [1]}, True)
    assert (two.job_id, two.posted_date, two.ai_analyzed, two.job_status, two.title) == ("", None, False, "Active", "")
    assert two.asDict().keys() == {*POSTING_SCHEMA.fieldNames(), "source_file", "row_index"}


def test_templates(spark):
    path = shared_dir(spark, "templates")
    os.makedirs(path)
    for name, text in (("default", "D {title}\nline two\n"), ("other", "O")):
        with open(f"{path}/{name}.txt", "w") as f:
            f.write(text)
    found = templates.read_templates(spark, path)
    assert [r.name for r in templates.template_names(found).collect()] == ["default", "other"]
    assert templates.template_text(found, "other") == "O"
    assert templates.template_text(found, "absent") == "D {title}\nline two\n"
    assert "{title}" in templates.template_text(found.where("name = 'other'"), "absent")
    versions = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "x", 1)], "name string, content string, modified_at long")
    assert {(r.name, r.content) for r in templates.latest_templates(versions).collect()} == {("a", "new"), ("b", "x")}


def test_states(spark):
    path = shared_dir(spark, "states")
    os.makedirs(path)
    good = {"processed_count": 2, "total_count": 5, "last_job_id": "b", "processed_ids": ["a", "b"], "timestamp": "2024-01-01 00:00:00"}
    for name, text in (("jobs_checkpoint.json", json.dumps(good, indent=2)), ("bad_checkpoint.json", "{not json"), ("else.json", "{}")):
        with open(f"{path}/{name}", "w") as f:
            f.write(text)
    states = resume.list_states(spark, path)
    assert [(r.batch_id, r.processed_count, r.processed_ids) for r in states.collect()] == [("jobs", 2, ["a", "b"])]
    assert {r.row_key for r in resume.state_keys(states, "jobs").collect()} == {"a", "b"}
    assert resume.state_keys(states, "absent").count() == 0
    assert resume.read_processed(spark, f"{path}/nowhere").count() == 0


def test_write_replaces_only_its_sources(spark):
    path = shared_dir(spark, "written")
    df = spark.createDataFrame([("a.csv", i, "x\x01y") for i in range(10)] + [("b.csv", 0, "z")], "source_file string, row_index long, t string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_enriched(df, path, rows_per_file=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # One source, written by several tasks.
    (folder,) = [f for f in os.listdir(path) if f.startswith("source_id=a-")]
    assert len([f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]) > 1
    sinks.write_enriched(df.where("source_file = 'b.csv'").withColumn("t", F.lit("new")), path)
    got = {(r.source_stem, r.row_index): r.t for r in spark.read.parquet(path).collect()}
    assert got == {**{("a", i): "xy" for i in range(10)}, ("b", 0): "new"}


def test_commit_order(spark):
    base = shared_dir(spark, "commit")
    data = spark.createDataFrame([("k1", True), ("k2", False)], "row_key string, usable boolean")
    for _ in range(2):
        assert sinks.commit(data, done_keys, f"{base}/d", f"{base}/s")
    assert [r.row_key for r in spark.read.parquet(f"{base}/s").collect()] == ["k1"]
    assert not sinks.commit(data, done_keys, f"{base}/d2", f"{base}/s2", lambda _: False)
    assert resume.path_exists(spark, f"{base}/d2") and not resume.path_exists(spark, f"{base}/s2")
    broken = data.withColumn("row_key", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        sinks.commit(broken, done_keys, f"{base}/d3", f"{base}/s3")
    assert not resume.path_exists(spark, f"{base}/s3")


def test_retention(spark):
    rows = spark.createDataFrame([("b1", "x"), ("b2", "y"), ("b2", "z"), ("b3", "w")], "batch_id string, row_key string")
    live = spark.createDataFrame([("b2",), ("b2",), ("b9",)], "batch_id string")
    assert {r.row_key for r in sinks.live_batches(rows, live).collect()} == {"y", "z"}
    assert {r.row_key for r in sinks.keep_batches(rows, ["b1"]).collect()} == {"x"}
    assert {r.row_key for r in sinks.drop_batch(rows, "b2").collect()} == {"x", "w"}
    path = shared_dir(spark, "kept")
    sinks.rewrite_processed(sinks.drop_batch(rows, "b2"), path)
    assert spark.read.parquet(path).count() == 2


def test_retention_of_many_batches_writes_few_files(spark):
    rows = spark.range(900).selectExpr("concat('b', id div 3) AS batch_id", "cast(id AS string) AS row_key", "timestamp_seconds(id) AS done_at")
    rows = rows.unionByName(spark.sql("SELECT '' AS batch_id, 'e' AS row_key, timestamp_seconds(1) AS done_at UNION ALL SELECT NULL, 'n', NULL"))
    path = shared_dir(spark, "kept")
    sinks.rewrite_processed(rows, path, 1)
    assert len(glob.glob(f"{path}/**/*.parquet", recursive=True)) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = resume.read_processed(spark, path)
    key = lambda r: (r.batch_id or "", r.row_key)
    assert sorted(kept.select("batch_id", "row_key", "done_at").collect(), key=key) == sorted(rows.collect(), key=key)
    one = resume.load_batch(kept, "b7")
    assert sorted(r.row_key for r in one.collect()) == ["21", "22", "23"]
    assert "EqualTo(batch_id,b7)" in one._jdf.queryExecution().toString()
    empty = shared_dir(spark, "kept")
    sinks.rewrite_processed(rows.limit(0), empty)
    assert resume.read_processed(spark, empty).count() == 0


def test_stream_ingest_takes_each_file_once(spark):
    base = shared_dir(spark, "ingest")
    schema = "v long"

    def pull():
        streams.drain(streams.ingest(spark, f"{base}/in", spark.createDataFrame([], schema).schema, "json"), f"{base}/out", f"{base}/state")
        return sorted(r.v for r in spark.read.parquet(f"{base}/out").collect())

    os.makedirs(f"{base}/in")
    for name, v in (("a.json", 1), ("~$a.json", 2), ("a_ai_gemini.json", 3)):
        with open(f"{base}/in/{name}", "w") as f:
            f.write(json.dumps({"v": v}) + "\n")
    assert pull() == [1]
    with open(f"{base}/in/b.json", "w") as f:
        f.write('{"v": 4}\n')
    assert pull() == [1, 4]
    assert pull() == [1, 4]


def test_stream_dedup_across_batches(spark):
    base = shared_dir(spark, "dedup")
    schema = "id long, k string, at timestamp"

    def pull(rows):
        df = spark.createDataFrame(rows, "id long, k string, at string").withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(2).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        streams.drain(streams.dedup(stream, ["k"], "at", "1 hour"), f"{base}/out", f"{base}/state")
        return sorted(r.k for r in spark.read.parquet(f"{base}/out").collect())

    assert pull([(i, "hot", "2024-01-01 00:00:00") for i in range(50)] + [(99, "a", "2024-01-01 00:10:00")]) == ["a", "hot"]
    assert pull([(100, "hot", "2024-01-01 00:20:00"), (101, "b", "2024-01-01 00:20:00")]) == ["a", "b", "hot"]


def test_stream_usage_updates(spark):
    base = shared_dir(spark, "usage")
    schema = "at timestamp, ok boolean, response_text string, input_tokens long, output_tokens long"

    def pull(*rows):
        df = spark.createDataFrame(list(rows), "at string, ok boolean, response_text string, input_tokens long, output_tokens long")
        df.withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(f"{base}/in")
        usage = streams.daily_usage(spark.readStream.schema(schema).parquet(f"{base}/in"), "at")
        streams.drain_updates(usage, f"{base}/out", f"{base}/state")
        return {r.day: (r.request_count, r.input_tokens) for r in streams.latest(spark, f"{base}/out", ["day"]).collect()}

    assert pull(("2024-01-01 10:00:00", True, "x", 5, 1), ("2024-01-01 11:00:00", False, None, 7, 1)) == {"2024-01-01": (1, 5)}
    assert pull(("2024-01-01 12:00:00", True, "y", 6, 1), ("2024-01-02 00:00:00", False, "", 1, 1)) == {"2024-01-01": (2, 11), "2024-01-02": (1, 1)}


def test_stream_enrich_resumes(spark):
    base = shared_dir(spark, "enrich")
    schema = with_keys(postings(spark, [])).schema

    def model(prompts):
        return [{"error": "boom"} if p == "bad" else {"text": json.dumps({"job_category": p})} for p in prompts]

    def pull(titles):
        with_keys(postings(spark, titles)).write.mode("append").parquet(f"{base}/in")
        streams.enrich(spark.readStream.schema(schema).parquet(f"{base}/in"), model, "{title}", f"{base}/run", "b")
        return sorted(r.row_key for r in resume.read_processed(spark, f"{base}/run/processed").collect())

    assert pull([(0, "t0"), (1, "bad")]) == ["0"]
    # Row 0 comes again and is not sent again; row 1 failed, so it is.
    assert pull([(0, "t0"), (1, "good"), (2, "t2")]) == ["0", "1", "2"]
    calls = spark.read.parquet(f"{base}/run/attempts/batch_id=b")
    assert calls.where("row_index = 0").count() == 1
    assert calls.where("row_index = 1").count() == 4


def postings(spark, titles):
    df = spark.createDataFrame([("s", i, str(i), t) for i, t in titles], "source_file string, row_index long, job_id string, title string")
    return df.withColumns({c: F.lit("").cast("string") for c in ("company", "salary_range", "description")} | {"location": F.col("job_id")})


def test_headings_cover_the_posting(spark):
    assert len(HEADINGS) == 13 and set(HEADINGS.values()) <= set(POSTING_SCHEMA.fieldNames())
