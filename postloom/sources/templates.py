"""Prompt templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.functions.prompts import builtin_template
from postloom.functions.text import file_stem


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ``*.txt`` file: name, content, modified_at."""
    return (
        spark.read.option("pathGlobFilter", "*.txt")
        .text(folder, wholetext=True)
        .select(
            file_stem(F.col("_metadata.file_name")).alias("name"),
            F.col("value").alias("content"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    )


def latest_templates(df: DataFrame) -> DataFrame:
    """Newest version per name."""
    return df.groupBy("name").agg(
        F.max_by("content", "modified_at").alias("content"), F.max("modified_at").alias("modified_at")
    )


def template_names(df: DataFrame) -> DataFrame:
    return df.select("name").distinct().orderBy("name")


def template_text(df: DataFrame, name: str = "default") -> str:
    """Text by name, else the ``default`` one, else the built-in one. Reads at most two rows to the driver."""
    wanted = latest_templates(df.where(F.col("name").isin(name, "default")))
    found = {r.name: r.content for r in wanted.collect() if r.content}
    return found.get(name) or found.get("default") or builtin_template()
