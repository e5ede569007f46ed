"""Posting-shaped projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from postloom.functions.dates import print_date
from postloom.functions.text import or_default, title_case
from postloom.schema import AI_COLUMNS, HEADINGS, POSTING_DEFAULTS, POSTING_SCHEMA


def with_missing(df: DataFrame, schema: T.StructType = POSTING_SCHEMA) -> DataFrame:
    """Add absent columns as typed NULLs and cast present ones to the schema."""
    have = set(df.columns)
    return df.withColumns(
        {
            f.name: F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
            for f in schema.fields
        }
    )


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill currency, interval and status; NaN amounts become NULL."""
    fills = {c: or_default(F.col(c), d) for c, d in POSTING_DEFAULTS.items()}
    nans = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in POSTING_SCHEMA.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns({**fills, **nans})


def export_projection(df: DataFrame) -> DataFrame:
    """The 13 display columns in their fixed order."""
    special = {
        "posted_date": print_date(F.col("posted_date")),
        "platform": title_case(F.coalesce(F.col("platform"), F.lit(""))),
    }
    return df.select(*[special.get(field, F.col(field)).alias(head) for head, field in HEADINGS.items()])


def full_record(df: DataFrame) -> DataFrame:
    """Every posting field and the dedup key."""
    return df.select(*POSTING_SCHEMA.fieldNames(), "dedup_key")


def record_json(df: DataFrame) -> DataFrame:
    """One JSON document per posting, NULL fields included."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def with_ai_columns(df: DataFrame) -> DataFrame:
    """Make sure the six result columns exist."""
    return df.withColumns({c: F.lit(None).cast("string") for c in AI_COLUMNS if c not in df.columns})


def enriched_already(analysed: str | None = None):
    """True where a row is marked as analysed or any result column is non-empty."""
    cond = F.lit(False)
    if analysed is not None:
        cond = F.coalesce(F.col(analysed), F.lit(False))
    for c in AI_COLUMNS:
        cond = cond | (F.coalesce(F.trim(F.col(c)), F.lit("")) != "")
    return cond


def row_at(df: DataFrame, source_file: str, index: int) -> DataFrame:
    """The row at a position of a file; a pushed-down filter, not a scan in order."""
    return df.where((F.col("source_file") == source_file) & (F.col("row_index") == index))


def in_order(df: DataFrame) -> DataFrame:
    """Rows by file and position (a range-partitioned sort)."""
    return df.orderBy("source_file", "row_index")


def bag_union(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates kept; absent columns become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
