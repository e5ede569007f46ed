"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postloom.session import shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"
MAX_VOCABULARY_BYTES = 64 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches that stay small when each row holds a whole text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


@contextmanager
def tidy(spark: SparkSession):
    """Queries that end within it leave no shuffle files behind."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` through Parquet in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` changed, if need be, so that none clashes with a column of ``df`` (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver; its size is checked before it is sent to the tasks."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has over {MAX_VOCABULARY_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()
