"""Text clean-up, keys and casing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# White space: the Unicode kind plus the four ASCII separators. Spelled out, since
# Java's \s is ASCII only and its Unicode mode is several times slower per character.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Runs of white space other than a single space, which stays as it is.
WS_RUN = WS.replace(r"\x1c-\x20", r"\x1c-\x1f") + WS + "*| " + WS + "+"
# Fixed value: control characters that are stripped; TAB, LF and CR stay.
CONTROL_CHARS = r"[\x00-\x08\x0B-\x0C\x0E-\x1F]"
# Fixed value: separator between key parts.
KEY_SEPARATOR = "|||"
_CASED = r"(?U)[\p{IsUppercase}\p{IsLowercase}\p{Lt}]+|(?U)[^\p{IsUppercase}\p{IsLowercase}\p{Lt}]+"


def strip_ws(c: Column) -> Column:
    """Remove white space at both ends (``F.trim`` knows only the space)."""
    return F.btrim(c, F.lit(WS_CHARS))


def normalise(c: Column) -> Column:
    """Lower-case, collapse white space, trim; NULL and the text ``nan`` give ''."""
    folded = F.trim(F.regexp_replace(F.lower(c), WS_RUN, " "))
    return F.when(folded.isNull() | (folded == "nan"), F.lit("")).otherwise(folded)


def dedup_key(title: Column, company: Column, location: Column) -> Column:
    return F.concat_ws(KEY_SEPARATOR, normalise(title), normalise(company), normalise(location))


def cross_platform_key(title: Column, company: Column) -> Column:
    """Title and company key; NULL if either part is empty."""
    t, c = normalise(title), normalise(company)
    return F.when((t != "") & (c != ""), F.concat_ws(KEY_SEPARATOR, t, c))


def with_keys(df: DataFrame) -> DataFrame:
    """Add ``dedup_key`` and ``xp_key``, normalising each column once."""
    parts = df.withColumns({f"_n_{c}": normalise(F.col(c)) for c in ("title", "company", "location")})
    t, c, loc = F.col("_n_title"), F.col("_n_company"), F.col("_n_location")
    return parts.withColumns(
        {
            "dedup_key": F.concat_ws(KEY_SEPARATOR, t, c, loc),
            "xp_key": F.when((t != "") & (c != ""), F.concat_ws(KEY_SEPARATOR, t, c)),
        }
    ).drop("_n_title", "_n_company", "_n_location")


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_CHARS, "")


def strip_control_all(df: DataFrame) -> DataFrame:
    """Strip control characters from every string column, keeping the column order."""
    return df.select(
        *[
            strip_control(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def title_case(c: Column) -> Column:
    """Capital after every uncased character, unlike ``initcap`` which looks for blanks."""
    runs = F.regexp_extract_all(c, F.lit(_CASED), F.lit(0))
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r)))))
    return F.array_join(cased, "")


def or_default(c: Column, default: str) -> Column:
    """NULL or '' -> default."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def file_stem(name: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def result_folder(stem: Column) -> Column:
    # Fixed format of result folder names.
    return F.concat(F.lit("analysis_gemini_"), stem)


def result_file(name: Column) -> Column:
    # Fixed format of result file names: stem, mark, extension.
    stem = file_stem(name)
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.concat(stem, F.lit("_ai_gemini"), F.substr(base, F.length(stem) + 1))


def batch_of_checkpoint(name: Column) -> Column:
    """Batch id in the name of a resume-state file."""
    return F.replace(file_stem(name), F.lit("_checkpoint"), F.lit(""))


def is_source_file(name: Column) -> Column:
    """False for earlier results and lock files."""
    from postloom.schema import LOCK_PREFIX, RESULT_STEM_MARKS

    base, stem = F.regexp_extract(name, r"([^/]*)$", 1), file_stem(name)
    keep = ~base.startswith(LOCK_PREFIX)
    for mark in RESULT_STEM_MARKS:
        keep = keep & ~stem.contains(mark)
    return keep
