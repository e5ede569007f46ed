"""Posting-shaped tables derived from the driver tables; ``oracle.py`` derives the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.functions.text import with_keys
from postloom.schema import HEADINGS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per part, described by the document of the same number, labelled ones enriched."""
    part = table(spark, sf_dir, "part")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    k = F.col("p_partkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size"))
    rows = part.join(docs, k == F.col("doc_id"), "left").drop("doc_id")
    rows = rows.join(labels, k == F.col("doc_id"), "left").drop("doc_id")
    return rows.select(
        F.when(k % 8 == 6, "f6_ai_gemini.csv")
        .when(k % 8 == 7, "~$f7.csv")
        .otherwise(F.concat(F.lit("f"), (k % 8).cast("string"), F.lit(".csv")))
        .alias("source_file"),
        k.alias("row_index"),
        F.when(k % 11 == 0, "").otherwise(k.cast("string")).alias("job_id"),
        F.when(k % 97 == 0, F.lit(None))
        .when(k % 3 == 0, F.upper(F.replace("p_name", F.lit(" "), F.lit("  "))))
        .otherwise(F.col("p_name"))
        .alias("title"),
        F.when(k % 5 == 0, F.concat(F.lit("  "), "p_brand", F.lit(" "))).otherwise(F.col("p_brand")).alias("company"),
        F.col("p_type").alias("location"),
        F.col("text").alias("description"),
        F.when(k % 13 == 0, F.lit(float("nan"))).otherwise(F.col("p_size") * 1000.0).alias("min_amount"),
        F.when(k % 2 == 0, F.col("p_size") * 2000.0).alias("max_amount"),
        F.when(k % 3 == 0, "EUR").when(k % 3 == 1, "").alias("currency"),
        F.when(k % 4 == 0, "monthly").alias("interval"),
        F.when(k % 4 != 0, F.concat(F.lit("$"), F.col("p_size").cast("string"), F.lit("k"))).alias("salary_range"),
        F.col("p_retailprice").alias("estimated_annual"),
        F.when(k % 2 == 0, F.col("p_retailprice")).alias("estimated_annual_usd"),
        F.when(k % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(k % 3 == 1, F.date_format(day, "MMM d, yyyy"))
        .otherwise("bad")
        .alias("posted_text"),
        F.when(k % 7 != 0, day.cast("timestamp")).alias("posted_date"),
        F.concat(F.lit("https://jobs.example.com/"), k.cast("string")).alias("job_url"),
        F.when(k % 2 == 0, "linkedin").otherwise("indeed").alias("platform"),
        F.when(k % 6 == 0, F.lit("SQL, Python")).alias("requirements"),
        F.when(k % 6 == 1, F.lit("51-200")).alias("company_size"),
        F.when(k % 10 == 0, "Closed").alias("job_status"),
        F.when(F.col("toxic") == 1, "Unknown role")
        .when(F.col("quality") == 1, "Data Engineer")
        .when(F.col("quality") == 0, "")
        .alias("AI_job_category"),
        F.when(F.col("quality") == 1, F.when(k % 2 == 0, "Senior").otherwise("Senior,Lead")).alias("AI_seniority_level"),
        F.when(F.col("quality").isNotNull(), "").alias("AI_years_experience_required"),
        F.lit(None).cast("string").alias("AI_education_required"),
        F.when(F.col("quality") == 1, '["Remote", "Hybrid"]').alias("AI_remote_policy"),
        F.lit(None).cast("string").alias("AI_company_stage"),
    )


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keys(postings(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh posting is recorded as done, in batches of up to a hundred part keys."""
    rows = keyed(spark, sf_dir).where(F.col("row_index") % 7 == 0)
    return rows.select(
        F.concat(F.lit("b"), F.floor(F.col("row_index") / 100).cast("string")).alias("batch_id"),
        F.coalesce(F.nullif("job_id", F.lit("")), F.col("dedup_key")).alias("row_key"),
        F.timestamp_micros(F.col("row_index") * 60_000_000).alias("done_at"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attempt per event; errors and clicks are failed ones, every ninth answer is empty."""
    e = table(spark, sf_dir, "events")
    ok = ~F.col("event_type").isin("error", "click")
    return e.select(
        F.col("user_id").alias("batch_id"),
        F.col("event_id").alias("seq"),
        F.floor(F.col("event_id") / 3).cast("long").alias("row_key"),
        (F.col("event_id") % 3).cast("int").alias("attempt_no"),
        F.col("ts").alias("requested_at"),
        ok.alias("ok"),
        F.when(F.col("event_type") == "error", "429 quota").when(F.col("event_type") == "click", "timeout").alias("error_msg"),
        F.when(ok, F.when(F.col("event_id") % 9 == 0, "").otherwise(F.col("props"))).alias("response_text"),
        F.round(F.col("value") * 100).cast("long").alias("input_tokens"),
        F.round(F.col("value") * 10).cast("long").alias("output_tokens"),
        F.when(F.col("event_id") % 4 == 0, "fallback-model").otherwise("main-model").alias("model"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model answer per event, in ten shapes."""
    e = table(spark, sf_dir, "events")
    i, json = F.col("event_id") % 10, _answer()
    return e.select(
        "event_id",
        F.when(i == 0, json)
        .when(i == 1, F.concat(F.lit("Sure:\n```json\n"), json, F.lit("\n```\nDone.")))
        .when(i == 2, F.concat(F.lit("```\n"), json, F.lit("\n```")))
        .when(i == 3, F.concat(F.lit("The answer is "), json, F.lit(" as asked.")))
        .when(i == 4, F.concat(F.lit("I cannot tell about "), F.col("event_type")))
        .when(i == 5, F.concat(json, F.lit(" "), json))
        .when(i == 6, "")
        .when(i == 7, F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(", 2]")))
        .when(i == 8, "{}")
        .otherwise(F.concat(F.lit("```json\nnot json\n```\n"), json))
        .alias("response_text"),
    )


def _answer():
    return F.concat(
        F.lit('{"job_category": "'),
        F.col("event_type"),
        F.lit('", "seniority_level": ["Mid", "'),
        F.col("user_id").cast("string"),
        F.lit('"], "remote_policy": '),
        F.round(F.col("value") * 100).cast("long").cast("string"),
        F.lit(', "company_stage": null}'),
    )


def headed(rows: DataFrame) -> DataFrame:
    """Postings as a table with display headings and result columns."""
    names = {field: head for head, field in HEADINGS.items() if field != "posted_date"}
    return rows.select(
        *[F.col(f).alias(h) for f, h in names.items() if f != "job_status"],
        F.col("posted_text").alias("Posted Date"),
        *[c for c in rows.columns if c.startswith("AI_")],
    )
