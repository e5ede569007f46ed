"""One query per operator, over whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from checks.model import answers_by_length, second_choice
from postloom import runs
from postloom.functions.attempts import backoff_seconds, error_class, total_tokens
from postloom.functions.cells import decode_cell, encode_cell
from postloom.functions.dates import lenient_timestamp, print_date
from postloom.functions.prompts import DESCRIPTION_CHARS, prompt_inputs
from postloom.functions.responses import parse_response, with_result_cells
from postloom.functions.text import (
    batch_of_checkpoint,
    cross_platform_key,
    dedup_key,
    file_stem,
    normalise,
    result_file,
    result_folder,
    strip_control_all,
    with_keys,
)
from postloom.operators import attempts as att
from postloom.operators import dedup, enrich, pending, postings as post, quality
from postloom.plans.ordered import rank_in_files
from postloom.schema import AI_COLUMNS, ROW_ID
from postloom.session import shared_dir
from postloom.sources import postings as src
from postloom.sources import resume, sinks, templates
from postloom.streaming import streams

TEMPLATE = (
    "Title: {title}\nAt: {company}, {location}\nPay: {salary_range}\n{{literal}}\n{description}\nAnswer {{\"job_category\": ..}}"
)
BY_FIELDS = ["batch_id"]


# --- sources -----------------------------------------------------------------


def posting_scan(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "posting-scan")
    fx.headed(fx.postings(spark, d)).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    rows = src.scan_postings(spark, path, "csv", multiline=True)
    return rows.select(
        "title",
        "company",
        "location",
        F.md5("description").alias("description_md5"),
        "salary_range",
        "estimated_annual",
        "currency",
        "interval",
        "job_status",
        "platform",
        "job_url",
        print_date(F.col("posted_date")).alias("posted"),
        (F.col("job_id") == F.col("row_index").cast("string")).alias("id_is_position"),
        "AI_job_category",
        "AI_remote_policy",
    )


def text_row_numbers(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "text-rows")
    fx.headed(fx.postings(spark, d)).select("Job Title", "Job Link").write.json(path)
    rows = src.scan_postings(spark, path, "json")
    files = rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("row_index").alias("last"),
        F.min("row_index").alias("first"),
        F.sum("row_index").alias("total"),
    )
    dense = (F.col("first") == 0) & (F.col("last") == F.col("n") - 1) & (F.col("total") * 2 == F.col("n") * (F.col("n") - 1))
    return files.agg(F.sum("n").alias("n_rows"), F.count_if(~dense).alias("n_bad_files"))


def folder_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.postings(spark, d)
    finished = rows.where(F.col("row_index") % 8 == 1).select(result_file(F.col("source_file")).alias("file_name"))
    left = src.pending_sources(rows, finished)
    return left.select("source_file", "row_index", file_stem(F.col("source_file")).alias("batch_id"))


def raw_ingest(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "raw")
    e = fx.table(spark, d, "events")
    raw = e.select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("id"),
                F.col("event_type").alias("title"),
                F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("company "), F.col("user_id"))).alias("company"),
                F.get_json_object("props", "$.k").alias("location"),
                F.col("value").alias("min_amount"),
                F.when(F.col("event_id") % 2 == 0, "EUR").when(F.col("event_id") % 2 == 1, "").alias("currency"),
                F.date_format("ts", "yyyy-MM-dd").alias("date_posted"),
                F.lit(1).alias("not_in_schema"),
            )
        ).alias("value")
    )
    raw.write.text(path)
    return src.from_raw(src.read_raw(spark, path)).select(
        "job_id", "title", "company", "location", "min_amount", "max_amount", "currency", "interval", "platform",
        "job_status", print_date(F.col("posted_date")).alias("posted"),
    )


def record_rehydrate(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "records")
    p = fx.postings(spark, d)
    docs = p.select(
        F.to_json(
            F.struct(
                "job_id", "title", "company", "currency", "max_amount", "job_status",
                F.col("posted_text").alias("posted_date"), F.lit("x").alias("unknown_key"),
                F.struct(F.col("AI_job_category").alias("job_category")).alias("ai_analysis"),
                F.when(F.col("row_index") % 2 == 0, F.lit(True)).alias("ai_analyzed"),
                "job_url",
            )
        ).alias("value")
    )
    docs.write.text(path)
    return src.read_records(spark, path).select(
        "job_id", "title", "company", "location", "currency", "interval", "max_amount", "job_status", "job_url",
        "ai_analyzed", F.get_json_object("ai_analysis", "$.job_category").alias("category"),
        print_date(F.col("posted_date")).alias("posted"),
    )


def _template_versions(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents")
    return docs.select(
        F.concat_ws("-", "lang", "source").alias("name"), F.col("text").alias("content"), F.col("doc_id").alias("modified_at")
    )


def template_latest(spark: SparkSession, d: str) -> DataFrame:
    latest = templates.latest_templates(_template_versions(spark, d))
    return latest.select("name", "modified_at", F.md5("content").alias("content_md5"), F.length("content").alias("n_chars"))


def template_names(spark: SparkSession, d: str) -> DataFrame:
    return templates.template_names(_template_versions(spark, d))


def _state_docs(spark: SparkSession, d: str) -> DataFrame:
    """State documents of up to a hundred keys as JSON lines; every fifth one is cut off."""
    path = shared_dir(spark, "states")
    docs = (
        fx.processed(spark, d)
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("processed_count"),
            F.max("row_key").alias("last_job_id"),
            F.sort_array(F.collect_list("row_key")).alias("processed_ids"),
        )
        .withColumn("total_count", F.lit(100))
    )
    text = F.to_json(F.struct("*"))
    n = F.substring("batch_id", 2, 20).cast("long")
    docs.select(F.when(n % 5 == 4, F.expr("substring(to_json(struct(*)), 1, 40)")).otherwise(text).alias("value")).write.text(path)
    return resume.list_state_lines(spark, path)


def resume_listing(spark: SparkSession, d: str) -> DataFrame:
    return _state_docs(spark, d).select(
        "batch_id", "processed_count", "total_count", "last_job_id", F.size("processed_ids").cast("long").alias("n_ids")
    )


def resume_load(spark: SparkSession, d: str) -> DataFrame:
    return resume.state_keys(_state_docs(spark, d), "b3")


def resume_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = resume.batch_summary(fx.processed(spark, d))
    return rows.select("batch_id", "processed_count", "last_job_id", F.unix_seconds("done_at").alias("done_second"))


# --- sinks -------------------------------------------------------------------


def enriched_write(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "enriched")
    rows = fx.postings(spark, d).select(*ROW_ID, "title", "company", *AI_COLUMNS)
    sinks.write_enriched(rows, path)
    # A second write of some sources replaces these and leaves the others.
    again = rows.where(F.col("row_index") % 8 < 2).withColumn("title", F.concat(F.lit("\x07v2 "), "title"))
    sinks.write_enriched(again, path)
    return spark.read.parquet(path).select("source_stem", "row_index", "title", "company", "AI_job_category")


def ordered_commit(spark: SparkSession, d: str) -> DataFrame:
    base = shared_dir(spark, "commit")
    rows = fx.keyed(spark, d).select(*ROW_ID, pending.row_key().alias("row_key"))
    saved = {0: True, 1: False, 2: True}
    for part, ok in saved.items():
        piece = rows.where(F.col("row_index") % 3 == part)
        sinks.commit(
            piece, lambda rows: rows.select("row_key"), f"{base}/data/wave={part}", f"{base}/state/wave={part}", lambda _, ok=ok: ok
        )
    data = spark.read.parquet(f"{base}/data").groupBy("wave").agg(F.count(F.lit(1)).alias("n_data"))
    state = spark.read.parquet(f"{base}/state").groupBy("wave").agg(F.count(F.lit(1)).alias("n_state"))
    joined = data.join(state, "wave", "left")
    return joined.select(F.col("wave").cast("int").alias("wave"), "n_data", F.coalesce("n_state", F.lit(0)).alias("n_state"))


def resume_retention(spark: SparkSession, d: str) -> DataFrame:
    live = fx.table(spark, d, "part").where(F.col("p_size") > 45).select(
        F.concat(F.lit("b"), F.floor(F.col("p_partkey") / 100).cast("string")).alias("batch_id")
    )
    path = shared_dir(spark, "retained")
    kept = sinks.drop_batch(sinks.live_batches(fx.processed(spark, d), live), "b1")
    sinks.rewrite_processed(kept, path, 1)
    return spark.read.schema("row_key string, done_at timestamp, batch_id string").parquet(path).select("batch_id", "row_key")


def export_projection(spark: SparkSession, d: str) -> DataFrame:
    p = fx.postings(spark, d)
    p = p.withColumn("platform", F.concat(F.col("platform"), F.lit("_via-o'brien 2nd")))
    return post.export_projection(p)


def full_record(spark: SparkSession, d: str) -> DataFrame:
    p = post.with_defaults(post.with_missing(fx.keyed(spark, d)))
    full = post.full_record(p)
    return full.select(
        *[c for c in full.columns if c not in ("description", "posted_date")],
        F.md5("description").alias("description_md5"),
        print_date(F.col("posted_date")).alias("posted"),
    )


def record_json(spark: SparkSession, d: str) -> DataFrame:
    p = fx.keyed(spark, d).select("job_id", "title", "company", "location", "currency", "interval", "job_url", "platform", "description", "dedup_key")
    return post.record_json(p)


# --- projections -------------------------------------------------------------


def normalised_keys(spark: SparkSession, d: str) -> DataFrame:
    p = fx.postings(spark, d)
    t, c, loc = F.col("title"), F.col("company"), F.col("location")
    return p.select(
        "row_index", normalise(t).alias("title"), dedup_key(t, c, loc).alias("dedup_key"), cross_platform_key(t, c).alias("xp_key")
    )


def control_strip(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents")
    dirty = docs.select(
        "doc_id",
        F.concat(F.lit("\x00a\x07\tb\x1f"), F.replace("text", F.lit(" "), F.lit(" \x0b"))).alias("text"),
        F.concat(F.col("lang"), F.lit("\x0c\n\r\x0e")).alias("lang"),
    )
    return strip_control_all(dirty).select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "lang")


def date_parse(spark: SparkSession, d: str) -> DataFrame:
    o, k = fx.table(spark, d, "orders"), F.col("o_orderkey")
    text = (
        F.when(k % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k % 5 == 1, F.date_format("o_orderdate", "MMM d, yyyy"))
        .when(k % 5 == 2, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(k % 5 == 3, F.date_format("o_orderdate", " yyyyMMdd "))
        .otherwise("bad")
    )
    return o.select("o_orderkey", print_date(lenient_timestamp(text)).alias("posted"))


def name_derivation(spark: SparkSession, d: str) -> DataFrame:
    pages = fx.table(spark, d, "pages")
    name = F.concat(F.lit("in/"), F.regexp_replace("url", "[^a-z0-9.]+", "-"), F.lit(".xlsx"))
    state = F.concat(file_stem(name), F.lit("_checkpoint.json"))
    return pages.select(
        "page_id",
        file_stem(name).alias("batch_id"),
        result_folder(file_stem(name)).alias("folder"),
        result_file(name).alias("file"),
        batch_of_checkpoint(state).alias("state_batch"),
    )


def prompt_inputs_query(spark: SparkSession, d: str) -> DataFrame:
    p = fx.postings(spark, d).select("row_index", *[c.alias(n) for n, c in prompt_inputs(DESCRIPTION_CHARS).items()])
    return p.select(
        "row_index", "title", "company", "location", "salary_range",
        F.length("description").alias("n_chars"), F.md5("description").alias("description_md5"),
    )


def prompt_render(spark: SparkSession, d: str) -> DataFrame:
    p = enrich.with_prompt(fx.postings(spark, d), TEMPLATE)
    p = enrich.with_prompt(p.withColumnRenamed("prompt", "good"), "{title} {no_such_field}").withColumnRenamed("prompt", "bad")
    return p.select("row_index", F.md5("good").alias("prompt_md5"), F.length("good").alias("n_chars"), "bad")


def ai_cell_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    e, k = fx.table(spark, d, "events"), F.col("event_id") % 7
    t, u = F.col("event_type"), F.col("user_id").cast("string")
    cell = (
        F.when(k == 0, t)
        .when(k == 1, F.concat(t, F.lit(" ,  "), u))
        .when(k == 2, F.concat(F.lit('["'), t, F.lit('", "'), u, F.lit('"]')))
        .when(k == 3, F.concat(F.lit("["), t, F.lit(", "), u, F.lit("]")))
        .when(k == 4, F.concat(F.lit("["), u, F.lit(", 7]")))
        .when(k == 5, "")
    )
    rows = e.select("event_id", cell.alias("cell")).withColumn("c", decode_cell(F.col("cell")))
    return rows.select(
        "event_id", F.col("c.is_list").alias("is_list"), F.size("c.items").cast("long").alias("n_items"), encode_cell(F.col("c")).alias("text")
    )


def response_parse(spark: SparkSession, d: str) -> DataFrame:
    parsed = with_result_cells(parse_response(fx.responses(spark, d)))
    return parsed.select("event_id", "parse_status", "usable", "raw_response", *AI_COLUMNS)


def vocab_conformance(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.postings(spark, d).select("source_file", "row_index", *AI_COLUMNS)
    return quality.vocabulary_violations(rows)


def vocab_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.vocabulary_report(fx.postings(spark, d))


def error_class_backoff(spark: SparkSession, d: str) -> DataFrame:
    a = fx.attempts(spark, d)
    return a.select(
        "seq",
        error_class(F.col("error_msg")).alias("error_class"),
        backoff_seconds(F.col("error_msg"), F.col("attempt_no")).alias("wait_seconds"),
        total_tokens(F.col("input_tokens"), F.col("output_tokens")).alias("total_tokens"),
    )


# --- pending, joins ----------------------------------------------------------


def pending_rows(spark: SparkSession, d: str) -> DataFrame:
    return pending.pending_rows(fx.keyed(spark, d), fx.processed(spark, d)).select("row_index", "job_id", "dedup_key")


def enrichment_split(spark: SparkSession, d: str) -> DataFrame:
    return pending.enrichment_split(fx.postings(spark, d))


def known_keys(spark: SparkSession, d: str) -> DataFrame:
    p = fx.keyed(spark, d)
    return pending.known_keys(p.where(post.enriched_already()), fx.processed(spark, d))


def cross_platform_dups(spark: SparkSession, d: str) -> DataFrame:
    p = fx.keyed(spark, d)
    flagged = dedup.cross_platform_duplicates(p.where("platform = 'indeed'"), p.where("platform = 'linkedin'"))
    return flagged.select("row_index", "xp_key", "is_duplicate")


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Answers for every second posting, and for rows that are in no table."""
    e = fx.responses(spark, d)
    k = F.col("event_id") * 2
    file = fx.postings(spark, d).select("source_file", "row_index")
    known = parse_response(e.withColumn("row_index", k)).join(file, "row_index", "left")
    return known.withColumn("source_file", F.coalesce("source_file", F.lit("none.csv")))


def result_scatter(spark: SparkSession, d: str) -> DataFrame:
    out = enrich.scatter(fx.postings(spark, d), _results(spark, d))
    return out.select(*ROW_ID, *AI_COLUMNS, "parse_status", "raw_response")


def aligned_results(spark: SparkSession, d: str) -> DataFrame:
    out = enrich.aligned_results(fx.postings(spark, d), _results(spark, d))
    return out.select(*ROW_ID, "parse_status", F.md5("result_json").alias("result_md5"), "raw_response")


def quota_admission(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.keyed(spark, d).where(~post.enriched_already())
    return pending.admit(rows, 700).select("source_file", "row_index", F.col("seq").cast("long").alias("seq"))


def row_at(spark: SparkSession, d: str) -> DataFrame:
    return post.row_at(fx.postings(spark, d), "f3.csv", 43).select("source_file", "row_index", "title", "company")


def ordered_rows(spark: SparkSession, d: str) -> DataFrame:
    p = fx.postings(spark, d).select("source_file", "row_index", "title")
    return post.in_order(rank_in_files(p, "source_file", "row_index", "place")).select(
        F.col("place").cast("long").alias("place"), "source_file", "row_index", "title"
    )


def bag_union(spark: SparkSession, d: str) -> DataFrame:
    p = fx.postings(spark, d).select("row_index", "title", "company")
    return post.bag_union(p, p.select("row_index", "title"))


# --- deduplication -----------------------------------------------------------


def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    kept = dedup.keep_first(fx.keyed(spark, d), ["dedup_key"], ["row_index"])
    return kept.select("row_index", "dedup_key", "xp_key")


def dedup_flagged(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.keyed(spark, d).withColumn("dedup", F.col("row_index") % 4 != 1)
    return dedup.keep_first_flagged(rows, ["dedup_key"], ["row_index"], "dedup").select("row_index", "dedup", "dedup_key")


def dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_counts(fx.keyed(spark, d), ["dedup_key"])


def key_suppression(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.keyed(spark, d).withColumn("job_id", F.when(F.col("row_index") % 2 == 0, "").otherwise(F.col("job_id")))
    ok = F.col("row_index") % 3 != 0
    return dedup.suppress_repeats(rows, pending.row_key(), "row_index", ok).select("row_index", "job_id", "dedup_key")


# --- attempts ----------------------------------------------------------------


def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    kept = att.circuit_breaker(fx.attempts(spark, d), BY_FIELDS, "seq", F.col("ok"))
    return kept.select("batch_id", "seq", "ok")


def trailing_requests(spark: SparkSession, d: str) -> DataFrame:
    return att.trailing_requests(fx.attempts(spark, d), BY_FIELDS, "requested_at", 60, 1)


def attempt_resolution(spark: SparkSession, d: str) -> DataFrame:
    return att.resolve_attempts(fx.attempts(spark, d), ["row_key"])


def commit_marks(spark: SparkSession, d: str) -> DataFrame:
    marks = att.commit_marks(fx.attempts(spark, d), BY_FIELDS, "seq", F.col("ok"))
    return marks.select("batch_id", "seq", "n_success", "reason")


def throughput_blocks(spark: SparkSession, d: str) -> DataFrame:
    blocks = att.throughput_blocks(fx.attempts(spark, d), BY_FIELDS, "seq", "requested_at", F.col("ok"))
    return blocks.withColumn("per_second", F.round("per_second", 9))


def usage_cost(spark: SparkSession, d: str) -> DataFrame:
    return att.usage_stats(fx.attempts(spark, d), BY_FIELDS).withColumn("cost_usd", F.round("cost_usd", 12))


def usage_by_model(spark: SparkSession, d: str) -> DataFrame:
    """Requests, tokens and cost of each batch by the model that answered."""
    return att.usage_stats(fx.attempts(spark, d), [*BY_FIELDS, "model"]).withColumn("cost_usd", F.round("cost_usd", 12))


def daily_usage(spark: SparkSession, d: str) -> DataFrame:
    return att.daily_usage(fx.attempts(spark, d), "requested_at", 200).withColumn("cost_usd", F.round("cost_usd", 12))


def progress_summary(spark: SparkSession, d: str) -> DataFrame:
    return pending.progress(fx.keyed(spark, d), fx.processed(spark, d))


# --- enrichment --------------------------------------------------------------


def _enriched(spark: SparkSession, d: str, label: str) -> DataFrame:
    """A run without prior state: pending rows in waves, the whole table written and read back."""
    folder = shared_dir(spark, label)
    rows = fx.keyed(spark, d)
    runs.enrich_table(
        rows, answers_by_length(), folder, "all", TEMPLATE, max_failures=1 << 30, call_rows=256
    )
    runs.write_table(rows, folder, "all", f"{folder}/table")
    return spark.read.parquet(f"{folder}/table")


def enrich_table(spark: SparkSession, d: str) -> DataFrame:
    return _enriched(spark, d, "enrich").select(*ROW_ID, *AI_COLUMNS, "parse_status", "raw_response")


def enrich_rows(spark: SparkSession, d: str) -> DataFrame:
    """Attempts over an ad-hoc selection, written before they are read."""
    path = shared_dir(spark, "attempts")
    rows = enrich.with_prompt(fx.postings(spark, d), TEMPLATE)
    enrich.call_model(rows, answers_by_length(), ROW_ID, 256).write.parquet(path)
    results = enrich.results_of(spark.read.parquet(path))
    return results.select(*ROW_ID, "n_attempts", "outcome", "parse_status", "usable", "last_error")


def generate_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "generated")
    rows = enrich.with_prompt(fx.postings(spark, d), TEMPLATE)
    model = enrich.with_fallback(answers_by_length(), second_choice())
    enrich.call_model(rows, model, ROW_ID, 256).write.parquet(path)
    return enrich.generated_text(spark.read.parquet(path))


def observed_progress(spark: SparkSession, d: str) -> DataFrame:
    rows, watch = enrich.observed(parse_response(fx.responses(spark, d)))
    rows.write.format("noop").mode("overwrite").save()
    seen = watch.get
    return spark.createDataFrame([(seen["total"], seen["processed"], seen["failed"])], "total long, processed long, failed long")


# --- streams -----------------------------------------------------------------


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Stream of a driver table. The pattern keeps a table that is a single file readable as one."""
    return spark.readStream.schema(fx.table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    base = shared_dir(spark, "ingest")
    rows = fx.postings(spark, d).select("row_index", "title", "company")
    rows.where("row_index % 2 = 0").write.json(f"{base}/in/first")
    schema = rows.schema

    def pull():
        stream = streams.ingest(spark, f"{base}/in/*", schema, "json")
        streams.drain(stream.select("row_index", "title", "company"), f"{base}/out", f"{base}/state")

    pull()
    rows.where("row_index % 2 = 1").write.json(f"{base}/in/second")
    pull()
    pull()
    return spark.read.parquet(f"{base}/out")


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    base = shared_dir(spark, "dedup")
    events = _stream(spark, d, "events").withColumn("key", F.concat_ws("|||", "user_id", "event_type"))
    streams.dedup_into(events.select("key", "ts"), ["key"], "ts", 60 * 86400, f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("key")


def stream_daily_usage(spark: SparkSession, d: str) -> DataFrame:
    base = shared_dir(spark, "usage")
    e = _stream(spark, d, "events")
    ok = ~F.col("event_type").isin("error", "click")
    rows = e.select(
        F.col("user_id").alias("batch_id"),
        F.col("ts").alias("requested_at"),
        ok.alias("ok"),
        F.when(ok, F.col("props")).alias("response_text"),
        F.round(F.col("value") * 100).cast("long").alias("input_tokens"),
        F.round(F.col("value") * 10).cast("long").alias("output_tokens"),
    )
    streams.drain_updates(streams.daily_usage(rows, "requested_at", BY_FIELDS), f"{base}/out", f"{base}/state")
    out = streams.latest(spark, f"{base}/out", ["day", *BY_FIELDS])
    return out.withColumn("cost_usd", F.round("cost_usd", 12))


def stream_enrich(spark: SparkSession, d: str) -> DataFrame:
    """Postings made of documents as they arrive; the second pull finds nothing new."""
    base = shared_dir(spark, "stream-enrich")
    docs = _stream(spark, d, "documents")
    rows = with_keys(
        docs.select(
            F.lit("documents").alias("source_file"),
            F.col("doc_id").alias("row_index"),
            F.col("doc_id").cast("string").alias("job_id"),
            F.concat_ws(" ", "lang", "source").alias("title"),
            F.col("source").alias("company"),
            F.col("lang").alias("location"),
            F.lit(None).cast("string").alias("salary_range"),
            F.col("text").alias("description"),
        )
    )
    for _ in range(2):
        streams.enrich(rows, answers_by_length(), TEMPLATE, base, "docs", 256)
    done = resume.load_batch(resume.read_processed(spark, f"{base}/processed"), "docs")
    results = spark.read.parquet(f"{base}/results/batch_id=docs").where("usable")
    return results.join(done.select("row_key"), "row_key", "left_semi").select("row_index", "parse_status", "decided_by")


QUERIES = {
    "posting_scan": posting_scan,
    "text_row_numbers": text_row_numbers,
    "folder_scan": folder_scan,
    "raw_ingest": raw_ingest,
    "record_rehydrate": record_rehydrate,
    "template_latest": template_latest,
    "template_names": template_names,
    "resume_listing": resume_listing,
    "resume_load": resume_load,
    "resume_summary": resume_summary,
    "enriched_write": enriched_write,
    "ordered_commit": ordered_commit,
    "resume_retention": resume_retention,
    "export_projection": export_projection,
    "full_record": full_record,
    "record_json": record_json,
    "normalised_keys": normalised_keys,
    "control_strip": control_strip,
    "date_parse": date_parse,
    "name_derivation": name_derivation,
    "prompt_inputs": prompt_inputs_query,
    "prompt_render": prompt_render,
    "ai_cell_roundtrip": ai_cell_roundtrip,
    "response_parse": response_parse,
    "vocab_conformance": vocab_conformance,
    "vocab_report": vocab_report,
    "error_class_backoff": error_class_backoff,
    "pending_rows": pending_rows,
    "enrichment_split": enrichment_split,
    "known_keys": known_keys,
    "cross_platform_dups": cross_platform_dups,
    "result_scatter": result_scatter,
    "aligned_results": aligned_results,
    "quota_admission": quota_admission,
    "row_at": row_at,
    "ordered_rows": ordered_rows,
    "bag_union": bag_union,
    "dedup_keep_first": dedup_keep_first,
    "dedup_flagged": dedup_flagged,
    "dedup_counts": dedup_counts,
    "key_suppression": key_suppression,
    "circuit_breaker": circuit_breaker,
    "trailing_requests": trailing_requests,
    "attempt_resolution": attempt_resolution,
    "commit_marks": commit_marks,
    "throughput_blocks": throughput_blocks,
    "usage_cost": usage_cost,
    "usage_by_model": usage_by_model,
    "daily_usage": daily_usage,
    "progress_summary": progress_summary,
    "enrich_table": enrich_table,
    "enrich_rows": enrich_rows,
    "generate_with_fallback": generate_with_fallback,
    "observed_progress": observed_progress,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_daily_usage": stream_daily_usage,
    "stream_enrich": stream_enrich,
}
