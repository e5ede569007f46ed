"""Closed-vocabulary conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postloom.schema import RESULT_FIELDS, VOCABULARY


def vocabulary_violations(df: DataFrame, prefix: str = "AI_") -> DataFrame:
    """One row per filled result cell whose value is not allowed. A scan with literal lists, no shuffle."""
    checks = [
        F.when(
            (F.col(prefix + f) != "") & ~F.col(prefix + f).isin(*VOCABULARY[f]),
            F.struct(F.lit(f).alias("field"), F.col(prefix + f).alias("value")),
        )
        for f in RESULT_FIELDS
    ]
    keep = [c for c in df.columns if not c.startswith(prefix)]
    return (
        df.withColumn("_bad", F.explode(F.array_compact(F.array(*checks))))
        .select(*keep, F.col("_bad.field").alias("field"), F.col("_bad.value").alias("value"))
    )


def vocabulary_report(df: DataFrame, prefix: str = "AI_") -> DataFrame:
    """Violations counted by field and value."""
    bad = vocabulary_violations(df.select(*[prefix + f for f in RESULT_FIELDS]), prefix)
    return bad.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n_rows"))
