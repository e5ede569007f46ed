"""Reading posting tables, raw scraper records and stored records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from postloom.functions.dates import iso_timestamp, lenient_timestamp
from postloom.functions.text import is_source_file, result_file
from postloom.operators.postings import with_defaults, with_missing
from postloom.plans.spread import lookup
from postloom.schema import AI_COLUMNS, HEADINGS, POSTING_SCHEMA, ROW_ID

_TEXT_HEADINGS = T.StructType(
    [T.StructField(h, T.StringType()) for h in HEADINGS] + [T.StructField(c, T.StringType()) for c in AI_COLUMNS]
)

# Fields of a raw scraper record.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("min_amount", T.DoubleType()),
        T.StructField("max_amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("date_posted", T.StringType()),
        T.StructField("job_url", T.StringType()),
    ]
)

# Stored records carry their date as text and the result as any JSON value.
RECORD_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "posted_date" else f.dataType) for f in POSTING_SCHEMA.fields]
)


def file_identity(paths: Sequence[str]) -> Column:
    """A scanned file's path below what all ``paths`` have in common: unlike a bare name, it is one file's only.

    A path that is not found in the file's (a pattern, say) leaves the whole path.
    """
    parts = [p.rstrip("/").removeprefix("file://").split("/") for p in paths]
    if len(parts) > 1:
        parts = [p[:-1] for p in parts]
    common = []
    for level in zip(*parts):
        if len(set(level)) > 1:
            break
        common.append(level[0])
    root, path = "/".join(common), F.col("_metadata.file_path")
    at = F.instr(path, root)
    below = F.ltrim(F.substr(path, at + F.lit(len(root))), F.lit("/"))
    return F.when(at == 0, path).when(below == "", F.col("_metadata.file_name")).otherwise(below)


def number_text_rows(df: DataFrame, identity: Column | None = None) -> DataFrame:
    """Add ``source_file`` and the 0-based ``row_index`` in it to a scan of text files.

    Text formats have no row number. Within a task ids rise in reading order, so
    a row's place in its split is its id minus the split's first id, and the
    split's place is the row count of the splits before it. The counts, one row
    per split, are broadcast while Spark finds them small; past that, rows are
    shuffled by split, whose size ``spark.sql.files.maxPartitionBytes`` bounds.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        (F.col("_metadata.file_name") if identity is None else identity).alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = tagged.groupBy("_path", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_path", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        tagged.join(starts, ["_path", "_split"])
        .withColumn("row_index", F.col("_start") + F.col("_id") - F.col("_first"))
        .drop("_path", "_split", "_id", "_first", "_start")
    )


def to_postings(df: DataFrame) -> DataFrame:
    """A headed table -> posting rows. Unknown columns are dropped, absent ones are NULL.

    ``row_index`` is the id, as text in ``job_id``.
    """
    have = set(df.columns)
    columns = {field: F.col(f"`{h}`") for h, field in HEADINGS.items() if h in have}
    columns |= {c: F.col(c) for c in AI_COLUMNS if c in have}
    typed = dict(df.dtypes)
    if "Posted Date" in have and typed["Posted Date"] == "string":
        columns["posted_date"] = lenient_timestamp(F.col("`Posted Date`"))
    for h in ("Estimated Annual Salary", "Estimated Annual Salary (USD)"):
        if h in have:
            columns[HEADINGS[h]] = F.col(f"`{h}`").try_cast("double")
    named = df.select(*ROW_ID, *[c.alias(name) for name, c in columns.items()])
    rows = with_defaults(with_missing(named).withColumn("job_id", F.col("row_index").cast("string")))
    ai = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in AI_COLUMNS]
    return rows.select(*ROW_ID, *POSTING_SCHEMA.fieldNames(), *ai)


def scan_postings(
    spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", multiline: bool = False
) -> DataFrame:
    """Posting rows of headed Parquet, CSV or JSON-lines tables.

    With ``multiline``, CSV cells may hold line breaks, and each CSV file is one
    split; without it, or as JSON lines, large files are split. Parquet is the
    format to keep tables in: the row number comes with the scan, and columns and
    filters are pushed down. In all formats columns go by name, file by file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    identity = file_identity(paths)
    if fmt == "parquet":
        raw = spark.read.option("mergeSchema", True).parquet(*paths)
        return to_postings(raw.select("*", identity.alias("source_file"), F.col("_metadata.row_index").alias("row_index")))
    if fmt == "csv":
        reader = spark.read.options(header=True, multiLine=multiline, escape='"')
        parts = [to_postings(number_text_rows(reader.csv(files), identity)) for files in files_by_header(spark, paths)]
        return reduce(DataFrame.unionByName, parts)
    if fmt == "json":
        return to_postings(number_text_rows(spark.read.schema(_TEXT_HEADINGS).json(paths), identity))
    raise ValueError(f"unsupported format {fmt}")


def files_by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The CSV files of ``paths``, those with one header line together; the paths themselves if all have one.

    One line of each file is compared, and the files are named on the driver, as for any scan.
    """
    lines = spark.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
    first = lines.select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("id"))
    headers = first.groupBy("path").agg(F.min_by("value", "id").alias("header"))
    if headers.select("header").distinct().limit(2).count() < 2:
        return [paths]
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files")).orderBy("header")
    return [[unquote(f) for f in r.files] for r in groups.collect()]


def pending_files(spark: SparkSession, folder: str, suffix: str, finished: DataFrame | None = None) -> DataFrame:
    """Files of a folder that are inputs and whose result is not among ``finished.file_name``.

    Lists names only; file contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .load(folder)
        .select(F.col("path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), "length")
    )
    files = files.where(is_source_file(F.col("file_name")))
    if finished is not None:
        files = files.withColumn("_result", result_file(F.col("file_name")))
        done = finished.select(F.col("file_name").alias("_result")).distinct()
        files = files.join(done, "_result", "left_anti").drop("_result")
    return files


def scan_folder(spark: SparkSession, folder: str, fmt: str = "parquet", finished: DataFrame | None = None) -> DataFrame:
    """Posting rows of all pending files, as one DataFrame keyed by ``source_file``.

    The driver holds one path per file, as any file scan does.
    """
    paths = [r.path for r in pending_files(spark, folder, f".{fmt}", finished).select("path").toLocalIterator()]
    if not paths:
        return to_postings(
            spark.createDataFrame([], T.StructType([*_TEXT_HEADINGS.fields, T.StructField("source_file", T.StringType()), T.StructField("row_index", T.LongType())]))
        )
    return scan_postings(spark, paths, fmt)


def pending_sources(df: DataFrame, finished: DataFrame, row_id: Sequence[str] = ROW_ID) -> DataFrame:
    """Rows of a table already holding ``source_file``, without results, lock files and finished inputs.

    A file may hold most of the rows, hence the spread lookup.
    """
    rows = df.where(is_source_file(F.col("source_file"))).withColumn("_result", result_file(F.col("source_file")))
    done = finished.select(F.col("file_name").alias("_result")).distinct()
    return lookup(rows, done, ["_result"], row_id, "left_anti").drop("_result")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw scraper records, one JSON document per line, with their row ids."""
    return number_text_rows(spark.read.schema(RAW_SCHEMA).json(path), file_identity([path]))


def from_raw(df: DataFrame, platform: str = "indeed") -> DataFrame:
    """Raw scraper records -> postings of one platform."""
    named = df.withColumnsRenamed({"id": "job_id"}).withColumns(
        {"posted_date": lenient_timestamp(F.col("date_posted")), "platform": F.lit(platform)}
    )
    ids = [c for c in ROW_ID if c in df.columns]
    return with_defaults(with_missing(named.drop("date_posted"))).select(*ids, *POSTING_SCHEMA.fieldNames())


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Stored posting records, one JSON document per line; unknown keys are ignored."""
    return rehydrate(number_text_rows(spark.read.schema(RECORD_SCHEMA).json(path), file_identity([path])))


def rehydrate(df: DataFrame) -> DataFrame:
    """Fill absent fields: texts '', the fixed defaults, ``ai_analyzed`` false; only ISO dates are read."""
    rows = with_defaults(df.withColumn("posted_date", iso_timestamp(F.col("posted_date"))))
    texts = [
        f.name
        for f in POSTING_SCHEMA.fields
        if isinstance(f.dataType, T.StringType) and f.name != "ai_analysis"
    ]
    return rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in texts}
        | {"ai_analyzed": F.coalesce(F.col("ai_analyzed"), F.lit(False))}
    ).select(*[c for c in ROW_ID if c in df.columns], *POSTING_SCHEMA.fieldNames())
