"""Streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from postloom.functions.attempts import cost_usd
from postloom.functions.text import is_source_file
from postloom.operators.enrich import CALL_ROWS, ModelFn, call_model, results_of, with_prompt
from postloom.operators.pending import done_keys, pending_rows, row_key
from postloom.operators.postings import with_ai_columns
from postloom.schema import ROW_ID
from postloom.sources.postings import file_identity
from postloom.sources.resume import read_processed
from postloom.sources.sinks import commit


def ingest(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Stream of the rows of every input file of a folder, each file once per checkpoint.

    ``source_file`` is the file's path in the folder; Parquet rows have their ``row_index`` too.
    """
    rows = spark.readStream.format(fmt).schema(schema).options(**options).load(folder)
    ids = [file_identity([folder]).alias("source_file")]
    if fmt == "parquet" and "row_index" not in schema.fieldNames():
        ids.append(F.col("_metadata.row_index").alias("row_index"))
    named = rows.select("*", *ids)
    return named.where(is_source_file(F.col("source_file")))


def drain(df: DataFrame, path: str, state: str) -> StreamingQuery:
    """Append what is available now to ``path`` and stop; a later call continues."""
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def dedup(df: DataFrame, key: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival per key; state is bounded by the watermark, outside of which a repeat passes.

    There is one state, by key alone: a second one by (key, place) in front of it
    would outlive it and drop rows that this one lets pass. A common key's rows of
    a micro-batch therefore meet in one task, as many as the micro-batch holds;
    ``dedup_into`` cuts them to one row per key and task before the shuffle.
    """
    timed = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def dedup_into(
    df: DataFrame, key: Sequence[str], event_time: str, delay_seconds: int, path: str, state: str, trigger: dict | None = None
) -> StreamingQuery:
    """First arrival per key into ``path``, with the watermark rules of ``dropDuplicatesWithinWatermark``.

    Each micro-batch is first cut to one row per key, the earliest by ``event_time``, which Spark does before the
    shuffle, so a key with a third of the rows moves as one row per task. The state is a written table of keys with
    the time they expire (event time plus ``delay_seconds``), one folder per micro-batch, and the largest event time
    of each: a batch drops rows older than the watermark (largest earlier event time less the delay) and rows whose
    key holds a state row that had not expired when the previous batch ended. A micro-batch that runs again reads
    only the folders of the batches before it and overwrites its own, so it gives the same rows. Rows without an
    event time are never late; null keys are equal to each other; of equal earliest rows of a key, any one is kept.
    """
    key = list(key)
    key_fields = [df.schema[k] for k in key]

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _folders(spark, f"{state}/marks", T.StructType([T.StructField("seen", T.TimestampType())]), batch_id)
        tops = marks.groupBy().agg(
            F.max("seen").alias("now"), F.max(F.when(F.col("batch") < batch_id - 1, F.col("seen"))).alias("before")
        ).first()
        shift = F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
        timed = batch.withColumn(event_time, F.col(event_time).cast("timestamp"))
        if tops.now is not None:
            timed = timed.where(F.col(event_time).isNull() | (F.col(event_time) >= F.lit(tops.now) - shift))
        first = F.min_by(F.struct(*timed.columns), F.coalesce(F.col(event_time), F.lit("9999-12-31").cast("timestamp")))
        firsts = timed.groupBy(*key).agg(first.alias("_r")).select("_r.*")
        schema = T.StructType([*key_fields, T.StructField("until", T.TimestampType())])
        live = _folders(spark, f"{state}/keys", schema, batch_id)
        if tops.before is not None:
            live = live.where(F.col("until") > F.lit(tops.before) - shift)
        live = live.select(*(F.col(k).alias(f"_s_{k}") for k in key)).distinct()
        same = F.lit(True)
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        kept = firsts.join(live, same, "left_anti")
        kept.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        kept = spark.read.parquet(f"{path}/batch={batch_id}")
        until = kept.select(*key, (F.col(event_time) + shift).alias("until"))
        until.write.mode("overwrite").parquet(f"{state}/keys/batch={batch_id}")
        timed.agg(F.max(event_time).alias("seen")).write.mode("overwrite").parquet(f"{state}/marks/batch={batch_id}")

    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", f"{state}/checkpoint")
    query = writer.trigger(**(trigger or {"availableNow": True})).start()
    query.awaitTermination()
    return query


def _folders(spark: SparkSession, path: str, schema: T.StructType, before: int) -> DataFrame:
    """The rows that batches before ``before`` wrote under ``path``, one folder ``batch=N`` each, with ``batch``."""
    from postloom.sources.resume import path_exists

    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path).where(F.col("batch") < before)


def daily_usage(df: DataFrame, at: str, by: Sequence[str] = (), delay: str = "1 day") -> DataFrame:
    """Answered requests, tokens and cost per day; counts combine before the shuffle."""
    when = F.col(at).cast("timestamp")
    rows = df.where(F.col("ok") | F.col("response_text").isNotNull()).withColumn("_at", when).withWatermark("_at", delay)
    sums = rows.groupBy(F.window("_at", "1 day").alias("day"), *by).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )
    return sums.select(
        F.date_format("day.start", "yyyy-MM-dd").alias("day"),
        *by,
        "request_count",
        "input_tokens",
        "output_tokens",
        cost_usd(F.col("input_tokens"), F.col("output_tokens")).alias("cost_usd"),
    )


def drain_updates(df: DataFrame, path: str, state: str) -> StreamingQuery:
    """Write each epoch's changed rows to a folder of its own; a repeated epoch replaces it."""

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    query = (
        df.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def latest(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """Newest version of every row written by :func:`drain_updates`."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*key, "epoch")]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*values), "epoch").alias("_v"))
    return newest.select(*key, "_v.*")


def enrich(
    df: DataFrame,
    model: ModelFn,
    template: str,
    folder: str,
    batch_id: str,
    call_rows: int = CALL_ROWS,
) -> StreamingQuery:
    """Enrich arriving postings: attempts, results, then keys, per micro-batch.

    A replayed epoch overwrites its own folders, and its own earlier keys do not
    count as processed, so nothing is lost or written twice.
    """
    spark = df.sparkSession
    width = spark.sparkContext.defaultParallelism

    def step(rows: DataFrame, epoch: int) -> None:
        place = f"batch_id={batch_id}/run=stream/wave={epoch}"
        known = read_processed(spark, f"{folder}/processed").where(
            (F.col("batch_id") == batch_id) & ~((F.col("run") == "stream") & (F.col("wave") == epoch))
        )
        todo = with_prompt(pending_rows(with_ai_columns(rows), known), template).select(
            *ROW_ID, row_key().alias("row_key"), "prompt"
        )
        call_model(todo.repartition(width, *ROW_ID), model, [*ROW_ID, "row_key"], call_rows).write.mode(
            "overwrite"
        ).parquet(f"{folder}/attempts/{place}")
        results = results_of(spark.read.parquet(f"{folder}/attempts/{place}"), [*ROW_ID, "row_key"])
        commit(results, done_keys, f"{folder}/results/{place}", f"{folder}/processed/{place}")

    query = (
        df.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{folder}/stream/{batch_id}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
