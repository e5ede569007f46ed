import json
import re
from datetime import datetime

from pyspark.sql import functions as F

from conftest import column
from postloom.functions import attempts, cells, dates, prompts, responses, text
from postloom.schema import VOCABULARY

ODD_TEXTS = [
    None, "", "nan", "NaN", " NAN ", "  A  b\tC ", " x　y ", "a\x1cb\x1fc", "ÄÖ  Ü", "İ", "ΑΣ ", "\n\n",
    "a  b", "x\x85y", "nan nan", "﻿z", "ß ẞ",
]


def normal(v):
    v = "" if v is None else str(v).strip().lower()
    return re.sub(r"\s+", " ", v) if v and v != "nan" else ""


def test_normalise(spark):
    assert column(spark, ODD_TEXTS, text.normalise) == [normal(v) for v in ODD_TEXTS]


def test_strip_ws(spark):
    assert column(spark, ODD_TEXTS, text.strip_ws) == [None if v is None else v.strip() for v in ODD_TEXTS]


def test_keys(spark):
    rows = spark.createDataFrame([(" Data  Eng", "Nan", None), (None, "x", "y"), ("", "", "")], "t string, c string, l string")
    out = rows.select(text.dedup_key(F.col("t"), F.col("c"), F.col("l")), text.cross_platform_key(F.col("t"), F.col("c")))
    assert [tuple(r) for r in out.collect()] == [("data eng||||||", None), ("|||x|||y", None), ("||||||", None)]
    named = rows.toDF("title", "company", "location")
    assert [r.dedup_key for r in text.with_keys(named).collect()] == ["data eng||||||", "|||x|||y", "||||||"]


def test_control_characters(spark):
    values = [f"a{chr(i)}b" for i in range(33)]
    want = [v if ord(v[1]) in (9, 10, 13, 32) else "ab" for v in values]
    assert column(spark, values, text.strip_control) == want


def test_title_case(spark):
    values = ["linkedin", "zip_recruiter", "o'brien-smith 2nd", "ALL CAPS", "", "a1b", "élan vital"]
    assert column(spark, values, text.title_case) == [v.title() for v in values]


def test_names(spark):
    names = ["a/b/jobs.v2.xlsx", "plain", ".hidden", "~$lock.csv", "x_ai_gemini.csv", "y_ai_perplexity_2.csv"]
    assert column(spark, names, text.file_stem) == ["jobs.v2", "plain", ".hidden", "~$lock", "x_ai_gemini", "y_ai_perplexity_2"]
    assert column(spark, names, text.is_source_file) == [True, True, True, False, False, False]
    assert column(spark, names[:2], text.result_file) == ["jobs.v2_ai_gemini.xlsx", "plain_ai_gemini"]
    assert column(spark, ["s/jobs_checkpoint.json"], text.batch_of_checkpoint) == ["jobs"]


def test_dates(spark):
    values = {
        "2024-03-05": "2024-03-05", "2024-03-05T10:11:12": "2024-03-05", " 2024-03-05 ": "2024-03-05",
        "2024-03-05T23:00:00-05:00": "2024-03-06", "March 5, 2024": "2024-03-05", "Mar 5, 2024": "2024-03-05",
        "5 March 2024": "2024-03-05", "3/5/2024": "2024-03-05", "20240305": "2024-03-05", "2024/3/5": "2024-03-05",
        "May 5, 2024": "2024-05-05", "12:30": "", "": "", "garbage": "", "2024-13-45": "",
    }
    out = column(spark, [*values, None], lambda c: dates.print_date(dates.lenient_timestamp(c)))
    assert out == [*values.values(), ""]
    iso = ["2024-03-05", "Mar 5, 2024", "2024-03-05T01:02:03", None]
    assert column(spark, iso, dates.iso_timestamp) == [datetime(2024, 3, 5), None, datetime(2024, 3, 5, 1, 2, 3), None]


def test_cells(spark):
    values = {
        '["a","b"]': (True, ["a", "b"]), "[a, b]": (True, ["a", "b"]), "['a']": (True, ["'a'"]), "a, b ,": (True, ["a", "b", ""]),
        "a": (False, ["a"]), "[]": (True, []), "[1, 2.5]": (True, ["1", "2.5"]), "[1],[2]": (True, ["1]", "[2"]),
        "7": (False, ["7"]), "[a": (False, ["[a"]),
    }
    out = column(spark, [*values, None, ""], cells.decode_cell)
    assert [None if c is None else (c.is_list, c["items"]) for c in out] == [*values.values(), None, None]
    encoded = column(spark, [*values, None], lambda c: cells.encode_cell(cells.decode_cell(c)))
    assert encoded == [", ".join(i) for _, i in values.values()] + [""]
    # A second pass changes nothing more than the first one did.
    again = column(spark, encoded, lambda c: cells.encode_cell(cells.decode_cell(c)))
    assert again == column(spark, again, lambda c: cells.encode_cell(cells.decode_cell(c)))


def prompt_rows(spark, descriptions):
    return spark.createDataFrame(
        [(i, "t{title}", "c", "l", None, d) for i, d in enumerate(descriptions)],
        "i int, title string, company string, location string, salary_range string, description string",
    )


def test_prompt_inputs(spark):
    lengths = [0, 3999, 4000, 4001]
    rows = prompt_rows(spark, ["é" * n for n in lengths] + ["😀" * 4001, None])
    out = rows.select("i", *[c.alias(n) for n, c in prompts.prompt_inputs(4000).items()]).orderBy("i").collect()
    assert [r.description for r in out] == ["No description", "é" * 3999, "é" * 4000, "é" * 4000, "😀" * 4000, "No description"]
    assert {r.salary_range for r in out} == {"Not specified"}
    whole = rows.select(F.length(prompts.prompt_inputs()["description"])).collect()
    assert sorted(r[0] for r in whole) == [14, 14, 3999, 4000, 4001, 4001]


def test_render(spark):
    rows = prompt_rows(spark, ["say {company} and {{x}}"])
    fields = prompts.prompt_inputs()
    template = "{title}|{{x}}|{salary_range}|{description}|}}{{"
    got = rows.select(prompts.render(template, fields)).first()[0]
    assert got == "t{title}|{x}|Not specified|say {company} and {{x}}|}{"
    assert rows.select(prompts.render("{title} {other}", fields)).first()[0] is None
    assert rows.select(prompts.render("", fields)).first()[0] == ""
    for bad in ("{", "}", "{}", "{0}", "{title!r}", "{title:>9}", "{title.x}"):
        try:
            prompts.render(bad, fields)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_builtin_template_renders(spark):
    got = prompt_rows(spark, ["d"]).select(prompts.render(prompts.builtin_template(), prompts.prompt_inputs())).first()[0]
    assert "PhD Preferred" in got and '"company_stage"' in got and "{{" not in got
    assert len(VOCABULARY) == 6


JSON_TEXTS = [
    "{}", "[]", "0", "null", "true", '"x"', '""', '{"a":1}', '{"a":1} trailing', '{"a":1}{"b":2}', "{'a':1}", '{"a":1,"a":2}',
    '{"a":NaN}', "NaN", "-Infinity", "[1,2", "[1,2]", "1,2", "", " ", '{"a":"b\nc"}', "// c\n1", '{"a":"\\x"}', "01", "1.", "]",
    '],["x"', '"a" "b"', '{"a":{"b":[1,{"c":null}]}}', "tru", "truex", "[1]]", '{"a":1}}', "nan",
]


def strict(t):
    try:
        json.loads(t)
        return True
    except json.JSONDecodeError:
        return False


def test_strict_json(spark):
    assert column(spark, JSON_TEXTS, responses.is_strict_json) == [strict(t) for t in JSON_TEXTS]


# text of an answer, how it is read, and what is read from it
ANSWERS = [
    ('{"job_category": "Other"}', "direct", {"job_category": "Other"}),
    ('  \n{"a": 1} ', "direct", {"a": 1}),
    ('pre ```json\n{"a": 1}\n``` post', "json_block", {"a": 1}),
    ('```\n{"a": [1]}\n```', "block", {"a": [1]}),
    ('see {"a": 1} ok', "braces", {"a": 1}),
    ('{"a":1} {"b":2}', "raw", '{"a":1} {"b":2}'),
    ('```json\nbad\n``` then {"a": 2}', "braces", {"a": 2}),
    ('```json {"a": 1', "raw", '```json {"a": 1'),
    ("no json", "raw", "no json"),
    ("", "empty", None),
    (None, "empty", None),
    ("   ", "raw", ""),
    ("{}", "empty_object", None),
    ("[]", "not_object", None),
    ("[1, 2]", "not_object", None),
    ("0", "not_object", None),
    ("null", "not_object", None),
    ("```json\n[1]\n```", "not_object", None),
    ("```json\n```", "raw", "```json\n```"),
    ("{'a': 1}", "raw", "{'a': 1}"),
    ('```json\nx{1}\n```\n```\n{"z": 1}\n```', "raw", '```json\nx{1}\n```\n```\n{"z": 1}\n```'),
    ('``` ```json {"q":1}```', "json_block", {"q": 1}),
    ('```json{"k":"```"}```', "braces", {"k": "```"}),
]


def test_answers(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(ANSWERS)], "i int, response_text string")
    out = responses.parse_response(rows).orderBy("i").collect()
    for r, (_, status, value) in zip(out, ANSWERS):
        assert (r.parse_status, json.loads(r.result_json) if r.result_json is not None else r.raw_response) == (status, value)
        assert r.usable == (status not in ("empty", "not_object", "empty_object"))


DATES = {
    "1/5/2024 3:04 PM": "2024-01-05 15:04:00", "Jan 5, 2024 10:00": "2024-01-05 10:00:00", "2024-01": "2024-01-01 00:00:00",
    "2024/01/05 10:00": "2024-01-05 10:00:00", "05.01.2024": "2024-01-05 00:00:00", "January 2024": "2024-01-01 00:00:00",
    "Fri, 05 Jan 2024 10:00:00 GMT": "2024-01-05 10:00:00", "Fri, 05 Jan 2024 10:00:00 +0200": "2024-01-05 08:00:00",
    "Friday, January 5, 2024": "2024-01-05 00:00:00", "1/5/24": "2024-01-05 00:00:00", "Jan 2024": "2024-01-01 00:00:00",
    "January 5, 2024 3:04 PM": "2024-01-05 15:04:00", "monday": None, "32.01.2024": None, "12:30": None,
}


def test_more_date_layouts(spark):
    got = column(spark, list(DATES), lambda c: F.date_format(dates.lenient_timestamp(c), "yyyy-MM-dd HH:mm:ss"))
    assert dict(zip(DATES, got)) == DATES


def test_result_cells(spark):
    docs = [
        '{"job_category": ["a", null, 2, true], "seniority_level": "[x]", "remote_policy": 3.0, "company_stage": null}',
        '{"job_category": "first", "job_category": "last", "education_required": {"z": 1}, "seniority_level": []}',
        None,
    ]
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, result_json string")
    out = [tuple(r)[2:] for r in responses.with_result_cells(rows).orderBy("i").collect()]
    assert out == [
        ("a, 2, true", "[x]", "", "", "3.0", ""),
        ("last", "", "", '{"z":1}', "", ""),
        ("",) * 6,
    ]
    assert column(spark, docs, lambda c: responses.result_field(c, "education_required", "-")) == ["-", '{"z":1}', "-"]


def test_errors_and_waits(spark):
    rows = spark.createDataFrame(
        [("429 x", 0), ("Quota gone", 2), ("boom", 0), ("boom", 2), (None, 1)], "m string, n int"
    )
    out = rows.select(attempts.error_class(F.col("m")), attempts.backoff_seconds(F.col("m"), F.col("n"))).collect()
    assert [tuple(r) for r in out] == [("rate_limited", 2.0), ("rate_limited", 8.0), ("other", 2.0), ("other", 0.0), (None, 0.0)]


def test_cost(spark):
    row = spark.range(1).select(attempts.cost_usd(F.lit(2_000_000), F.lit(1_000_000)), attempts.total_tokens(F.lit(2), F.lit(None))).first()
    assert abs(row[0] - 0.1125) < 1e-12 and row[1] == 2
