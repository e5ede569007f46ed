"""Shared-folder lookup for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the session must name: a folder every executor can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir, when the session is built, to a folder every executor can reach")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    """How many ways a hot key can usefully be spread."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


# Rows that Python gets at once when each of them holds a whole text.
TEXT_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Hand at most ``rows`` rows at once to Python from now on; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= rows:
        spark.conf.set(name, rows)


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles_removed(run: Callable) -> Callable:
    """While ``run`` (its first argument a DataFrame) lasts, each query's shuffle files go when that query ends.

    Spark otherwise keeps them until the driver collects garbage, so a run of many writes keeps all its shuffles.
    """

    @wraps(run)
    def inner(postings: DataFrame, *args, **options):
        conf = postings.sparkSession.conf
        old = conf.get(CLEAN_SHUFFLES, None)
        conf.set(CLEAN_SHUFFLES, "true")
        try:
            return run(postings, *args, **options)
        finally:
            conf.unset(CLEAN_SHUFFLES) if old is None else conf.set(CLEAN_SHUFFLES, old)

    return inner
