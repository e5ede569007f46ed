"""SQL for DuckDB, by query name. Every text starts from the driver's views."""

from __future__ import annotations

from checks.queries import TEMPLATE
from postloom.schema import AI_COLUMNS, VOCABULARY

_POSTINGS = """
postings AS (
  SELECT
    CASE WHEN p_partkey % 8 = 6 THEN 'f6_ai_gemini.csv' WHEN p_partkey % 8 = 7 THEN '~$f7.csv'
         ELSE 'f' || (p_partkey % 8) || '.csv' END AS source_file,
    p_partkey AS row_index,
    CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS job_id,
    CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN upper(replace(p_name, ' ', '  ')) ELSE p_name END AS title,
    CASE WHEN p_partkey % 5 = 0 THEN '  ' || p_brand || ' ' ELSE p_brand END AS company,
    p_type AS location,
    d.text AS description,
    CASE WHEN p_partkey % 13 <> 0 THEN p_size * 1000.0::DOUBLE END AS min_amount,
    CASE WHEN p_partkey % 2 = 0 THEN p_size * 2000.0::DOUBLE END AS max_amount,
    CASE WHEN p_partkey % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN p_partkey % 4 = 0 THEN 'monthly' ELSE 'yearly' END AS "interval",
    CASE WHEN p_partkey % 4 <> 0 THEN '$' || p_size || 'k' END AS salary_range,
    p_retailprice AS estimated_annual,
    CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS estimated_annual_usd,
    CASE WHEN p_partkey % 3 = 2 THEN 'bad' END AS bad_date,
    DATE '2024-01-01' + CAST(p_size AS INTEGER) AS day,
    CASE WHEN p_partkey % 7 <> 0 THEN strftime(DATE '2024-01-01' + CAST(p_size AS INTEGER), '%Y-%m-%d') ELSE '' END AS posted,
    'https://jobs.example.com/' || p_partkey AS job_url,
    CASE WHEN p_partkey % 2 = 0 THEN 'linkedin' ELSE 'indeed' END AS platform,
    CASE WHEN p_partkey % 6 = 0 THEN 'SQL, Python' END AS requirements,
    CASE WHEN p_partkey % 6 = 1 THEN '51-200' END AS company_size,
    CASE WHEN p_partkey % 10 = 0 THEN 'Closed' ELSE 'Active' END AS job_status,
    CASE WHEN l.toxic = 1 THEN 'Unknown role' WHEN l.quality = 1 THEN 'Data Engineer' WHEN l.quality = 0 THEN '' END AS "AI_job_category",
    CASE WHEN l.quality = 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Senior' ELSE 'Senior,Lead' END END AS "AI_seniority_level",
    CASE WHEN l.quality = 1 THEN '["Remote", "Hybrid"]' END AS "AI_remote_policy",
    (l.toxic IS NOT DISTINCT FROM 1 OR l.quality IS NOT DISTINCT FROM 1) AS enriched
  FROM part LEFT JOIN documents d ON p_partkey = d.doc_id LEFT JOIN labels l ON p_partkey = l.doc_id
),
normal AS (
  SELECT *,
    trim(regexp_replace(lower(coalesce(title, '')), '\\s+', ' ', 'g')) AS n_title,
    trim(regexp_replace(lower(company), '\\s+', ' ', 'g')) AS n_company,
    trim(regexp_replace(lower(location), '\\s+', ' ', 'g')) AS n_location
  FROM postings
),
keyed AS (
  SELECT *, n_title || '|||' || n_company || '|||' || n_location AS dedup_key,
    CASE WHEN n_title <> '' AND n_company <> '' THEN n_title || '|||' || n_company END AS xp_key
  FROM normal
),
processed AS (
  SELECT 'b' || (row_index // 100) AS batch_id, coalesce(nullif(job_id, ''), dedup_key) AS row_key, row_index * 60 AS done_second
  FROM keyed WHERE row_index % 7 = 0
),
pending AS (
  SELECT * FROM keyed k WHERE NOT enriched
    AND NOT EXISTS (SELECT 1 FROM processed p WHERE p.row_key = k.job_id)
    AND NOT EXISTS (SELECT 1 FROM processed p WHERE p.row_key = k.dedup_key)
)
"""

_ATTEMPTS = """
attempts AS (
  SELECT user_id AS batch_id, event_id AS seq, event_id // 3 AS row_key, CAST(event_id % 3 AS INTEGER) AS attempt_no,
    ts AS requested_at, event_type NOT IN ('error', 'click') AS ok,
    CASE event_type WHEN 'error' THEN '429 quota' WHEN 'click' THEN 'timeout' END AS error_msg,
    CASE WHEN event_type NOT IN ('error', 'click') THEN CASE WHEN event_id % 9 = 0 THEN '' ELSE props END END AS response_text,
    CAST(round(value * 100) AS BIGINT) AS input_tokens, CAST(round(value * 10) AS BIGINT) AS output_tokens,
    CASE WHEN event_id % 4 = 0 THEN 'fallback-model' ELSE 'main-model' END AS model
  FROM events
)
"""

_PARSED = r"""
answers AS (
  SELECT *, '{"job_category": "' || event_type || '", "seniority_level": ["Mid", "' || user_id || '"], "remote_policy": '
      || CAST(round(value * 100) AS BIGINT) || ', "company_stage": null}' AS js
  FROM events
),
responses AS (
  SELECT event_id, CASE event_id % 10
      WHEN 0 THEN js
      WHEN 1 THEN 'Sure:' || chr(10) || '```json' || chr(10) || js || chr(10) || '```' || chr(10) || 'Done.'
      WHEN 2 THEN '```' || chr(10) || js || chr(10) || '```'
      WHEN 3 THEN 'The answer is ' || js || ' as asked.'
      WHEN 4 THEN 'I cannot tell about ' || event_type
      WHEN 5 THEN js || ' ' || js
      WHEN 6 THEN ''
      WHEN 7 THEN '[' || user_id || ', 2]'
      WHEN 8 THEN '{}'
      ELSE '```json' || chr(10) || 'not json' || chr(10) || '```' || chr(10) || js END AS t
  FROM answers
),
ladder AS (
  SELECT event_id, t, CASE WHEN t <> '' THEN CAST(TRY_CAST(t AS JSON) AS VARCHAR) END AS c0,
    CAST(TRY_CAST(nullif(regexp_extract(t, '```json\s*([\s\S]*?)\s*```', 1), '') AS JSON) AS VARCHAR) AS c1,
    CAST(TRY_CAST(nullif(regexp_extract(t, '```\s*([\s\S]*?)\s*```', 1), '') AS JSON) AS VARCHAR) AS c2,
    CAST(TRY_CAST(nullif(regexp_extract(t, '\{[\s\S]*\}'), '') AS JSON) AS VARCHAR) AS c3
  FROM responses
),
found AS (
  SELECT event_id, t, coalesce(c0, c1, c2, c3) AS j,
    CASE WHEN t = '' THEN 'empty' WHEN coalesce(c0, c1, c2, c3) IS NULL THEN 'raw'
      WHEN coalesce(c0, c1, c2, c3)[1] <> '{' THEN 'not_object'
      WHEN coalesce(c0, c1, c2, c3) = '{}' THEN 'empty_object'
      WHEN c0 IS NOT NULL THEN 'direct' WHEN c1 IS NOT NULL THEN 'json_block' WHEN c2 IS NOT NULL THEN 'block'
      ELSE 'braces' END AS parse_status
  FROM ladder
),
parsed AS (
  SELECT event_id, parse_status, parse_status NOT IN ('empty', 'not_object', 'empty_object') AS usable,
    CASE WHEN parse_status = 'raw' THEN t END AS raw_response,
    CASE WHEN parse_status NOT IN ('empty', 'not_object', 'empty_object', 'raw') THEN j END AS j
  FROM found
),
cells AS (
  SELECT event_id, parse_status, usable, raw_response, j,
    coalesce(json_extract_string(j, '$.job_category'), '') AS "AI_job_category",
    coalesce(array_to_string(json_extract_string(j, '$.seniority_level[*]'), ', '), '') AS "AI_seniority_level",
    '' AS "AI_years_experience_required", '' AS "AI_education_required",
    coalesce(json_extract_string(j, '$.remote_policy'), '') AS "AI_remote_policy", '' AS "AI_company_stage"
  FROM parsed
)
"""

_RESULTS = """
results AS (
  SELECT c.*, c.event_id * 2 AS row_index FROM cells c
)
"""


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _template_sql() -> str:
    """The template as one concatenation."""
    out = _lit(TEMPLATE.replace("{{", "\x01").replace("}}", "\x02"))
    values = {
        "title": "coalesce(title, '')",
        "company": "coalesce(company, '')",
        "location": "coalesce(location, '')",
        "salary_range": "coalesce(nullif(salary_range, ''), 'Not specified')",
        "description": "coalesce(nullif(description, ''), 'No description')",
    }
    for name, sql in values.items():
        out = out.replace("{" + name + "}", f"' || {sql} || '")
    return out.replace("\x01", "{").replace("\x02", "}")


_PROMPTS = f"prompts AS (SELECT *, {_template_sql()} AS prompt, length({_template_sql()}) AS n FROM keyed)"

_MODEL = """
model AS (
  SELECT *,
    CASE WHEN n % 13 = 0 THEN 'failed' WHEN n % 11 = 0 THEN 'empty' ELSE 'answered' END AS outcome,
    CASE WHEN n % 13 = 0 OR n % 11 = 0 THEN 'empty' WHEN n % 7 = 0 THEN 'raw' WHEN n % 5 = 0 THEN 'json_block' ELSE 'direct' END AS status,
    n % 13 <> 0 AND n % 11 <> 0 AS usable,
    '{"job_category": "' || CASE n % 3 WHEN 0 THEN 'ML Engineer' WHEN 1 THEN 'Data Engineer' ELSE 'Other' END
      || '", "seniority_level": ' || CASE WHEN n % 2 = 0 THEN '["Senior", "Lead"]' ELSE '"Mid"' END
      || ', "years_experience_required": ' || n || ', "remote_policy": null}' AS js
  FROM prompts
)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def _violations() -> str:
    arms = []
    for field, allowed in VOCABULARY.items():
        col = f'"AI_{field}"'
        if field in ("job_category", "seniority_level", "remote_policy"):
            arms.append(
                f"SELECT source_file, row_index, '{field}' AS field, {col} AS value FROM postings "
                f"WHERE {col} <> '' AND {col} NOT IN ({', '.join(_lit(a) for a in allowed)})"
            )
    return " UNION ALL ".join(arms)


_OLD_CELLS = """
  coalesce("AI_job_category", '') AS old_category,
  coalesce(replace("AI_seniority_level", ',', ', '), '') AS old_level,
  CASE WHEN "AI_remote_policy" IS NULL THEN '' ELSE 'Remote, Hybrid' END AS old_policy
"""

# DuckDB's title-case: split on every uncased character.
_PLATFORM = "CASE WHEN platform = 'linkedin' THEN 'Linkedin' ELSE 'Indeed' END || '_Via-O''Brien 2Nd'"

_STATES = _POSTINGS + """,
states AS (
  SELECT batch_id, CAST(count(*) AS BIGINT) AS processed_count, CAST(100 AS BIGINT) AS total_count, max(row_key) AS last_job_id
  FROM processed WHERE CAST(substr(batch_id, 2) AS BIGINT) % 5 <> 4 GROUP BY batch_id
)
"""

ORACLE = {
    "posting_scan": _with(_POSTINGS)
    + """SELECT title, company, location, md5(description) AS description_md5, salary_range, estimated_annual,
      'USD' AS currency, 'yearly' AS "interval", 'Active' AS job_status, platform, job_url,
      CASE WHEN bad_date IS NULL THEN strftime(day, '%Y-%m-%d') ELSE '' END AS posted, TRUE AS id_is_position,
      nullif("AI_job_category", '') AS "AI_job_category", "AI_remote_policy" FROM postings""",
    "text_row_numbers": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad_files FROM part",
    "folder_scan": _with(_POSTINGS)
    + """SELECT source_file, row_index, regexp_replace(source_file, '\\.csv$', '') AS batch_id FROM postings
      WHERE source_file NOT LIKE '%\\_ai\\_gemini%' ESCAPE '\\' AND source_file NOT LIKE '~$%' AND source_file <> 'f1.csv'""",
    "raw_ingest": """SELECT CAST(event_id AS VARCHAR) AS job_id, event_type AS title,
      CASE WHEN user_id % 3 = 0 THEN 'company ' || user_id END AS company, json_extract_string(props, '$.k') AS location,
      value AS min_amount, CAST(NULL AS DOUBLE) AS max_amount, CASE WHEN event_id % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
      'yearly' AS "interval", 'indeed' AS platform, 'Active' AS job_status, strftime(ts, '%Y-%m-%d') AS posted FROM events""",
    "record_rehydrate": _with(_POSTINGS)
    + """SELECT job_id, coalesce(title, '') AS title, company, '' AS location, currency, 'yearly' AS "interval", max_amount,
      job_status, job_url, row_index % 2 = 0 AS ai_analyzed, "AI_job_category" AS category,
      CASE WHEN row_index % 3 = 0 THEN strftime(day, '%Y-%m-%d') ELSE '' END AS posted FROM postings""",
    "template_latest": """SELECT lang || '-' || source AS name, max(doc_id) AS modified_at, md5(arg_max(text, doc_id)) AS content_md5,
      CAST(length(arg_max(text, doc_id)) AS INTEGER) AS n_chars FROM documents GROUP BY 1""",
    "template_names": "SELECT DISTINCT lang || '-' || source AS name FROM documents ORDER BY name",
    "resume_listing": _with(_STATES)
    + "SELECT batch_id, processed_count, total_count, last_job_id, processed_count AS n_ids FROM states",
    "resume_load": _with(_POSTINGS) + "SELECT DISTINCT batch_id, row_key FROM processed WHERE batch_id = 'b3'",
    "resume_summary": _with(_POSTINGS)
    + """SELECT batch_id, count(*) AS processed_count, arg_max(row_key, done_second) AS last_job_id, max(done_second) AS done_second
      FROM processed GROUP BY batch_id""",
    "enriched_write": _with(_POSTINGS)
    + """SELECT regexp_replace(source_file, '\\.csv$', '') AS source_stem, row_index,
      CASE WHEN row_index % 8 < 2 THEN 'v2 ' || title ELSE title END AS title, company, "AI_job_category" FROM postings""",
    "ordered_commit": """SELECT CAST(p_partkey % 3 AS INTEGER) AS wave, count(*) AS n_data,
      CASE WHEN p_partkey % 3 = 1 THEN 0 ELSE count(*) END AS n_state FROM part GROUP BY p_partkey % 3""",
    "resume_retention": _with(_POSTINGS)
    + """SELECT batch_id, row_key FROM processed WHERE batch_id <> 'b1'
      AND batch_id IN (SELECT 'b' || (p_partkey // 100) FROM part WHERE p_size > 45)""",
    "export_projection": _with(_POSTINGS)
    + f"""SELECT title AS "Job Title", company AS "Company Name", requirements AS "Requirements", location AS "Location",
      salary_range AS "Salary Range", estimated_annual AS "Estimated Annual Salary", estimated_annual_usd AS "Estimated Annual Salary (USD)",
      company_size AS "Company Size", posted AS "Posted Date", nullif(job_status, 'Active') AS "Job Status", {_PLATFORM} AS "Platform",
      job_url AS "Job Link", description AS "Job Description" FROM postings""",
    "full_record": _with(_POSTINGS)
    + """SELECT job_id, title, company, location, min_amount, max_amount, currency, "interval", salary_range, estimated_annual,
      estimated_annual_usd, job_url, platform, requirements, company_size, job_status, CAST(NULL AS VARCHAR) AS ai_analysis,
      CAST(NULL AS BOOLEAN) AS ai_analyzed, dedup_key, md5(description) AS description_md5, posted FROM keyed""",
    "record_json": _with(_POSTINGS)
    + """SELECT '{"job_id":"' || job_id || '","title":' || CASE WHEN title IS NULL THEN 'null' ELSE '"' || title || '"' END
      || ',"company":"' || company || '","location":"' || location || '","currency":'
      || CASE row_index % 3 WHEN 0 THEN '"EUR"' WHEN 1 THEN '""' ELSE 'null' END
      || ',"interval":' || CASE WHEN row_index % 4 = 0 THEN '"monthly"' ELSE 'null' END
      || ',"job_url":"' || job_url || '","platform":"' || platform
      || '","description":' || coalesce(CAST(to_json(description) AS VARCHAR), 'null') || ',"dedup_key":"' || dedup_key || '"}' AS record FROM keyed""",
    "normalised_keys": _with(_POSTINGS) + "SELECT row_index, n_title AS title, dedup_key, xp_key FROM keyed",
    "control_strip": """SELECT doc_id, md5('a' || chr(9) || 'b' || text) AS text_md5,
      CAST(length('a' || chr(9) || 'b' || text) AS INTEGER) AS n_chars, lang || chr(10) || chr(13) AS lang FROM documents""",
    "date_parse": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS posted FROM orders""",
    "name_derivation": """SELECT page_id, s AS batch_id, 'analysis_gemini_' || s AS folder, s || '_ai_gemini.xlsx' AS file, s AS state_batch
      FROM (SELECT page_id, regexp_replace(url, '[^a-z0-9.]+', '-', 'g') AS s FROM pages)""",
    "prompt_inputs": _with(_POSTINGS)
    + """, inputs AS (SELECT row_index, coalesce(title, '') AS title, company, location, coalesce(salary_range, 'Not specified') AS salary_range,
      coalesce(nullif(substr(description, 1, 4000), ''), 'No description') AS description FROM postings)
      SELECT row_index, title, company, location, salary_range, CAST(length(description) AS INTEGER) AS n_chars,
      md5(description) AS description_md5 FROM inputs""",
    "prompt_render": _with(_POSTINGS, _PROMPTS)
    + "SELECT row_index, md5(prompt) AS prompt_md5, CAST(n AS INTEGER) AS n_chars, CAST(NULL AS VARCHAR) AS bad FROM prompts",
    "ai_cell_roundtrip": """WITH c AS (SELECT event_id, event_id % 7 AS k, event_type AS t, CAST(user_id AS VARCHAR) AS u FROM events)
      SELECT event_id, CASE WHEN k = 0 THEN FALSE WHEN k <= 4 THEN TRUE END AS is_list,
      CAST(CASE WHEN k = 0 THEN 1 WHEN k <= 4 THEN 2 END AS BIGINT) AS n_items,
      CASE WHEN k = 0 THEN t WHEN k <= 3 THEN t || ', ' || u WHEN k = 4 THEN u || ', 7' ELSE '' END AS text FROM c""",
    "response_parse": _with(_PARSED)
    + "SELECT event_id, parse_status, usable, raw_response, " + ", ".join(f'"{c}"' for c in AI_COLUMNS) + " FROM cells",
    "vocab_conformance": _with(_POSTINGS) + _violations(),
    "vocab_report": _with(_POSTINGS)
    + f"SELECT field, value, count(*) AS n_rows FROM ({_violations()}) GROUP BY field, value",
    "error_class_backoff": _with(_ATTEMPTS)
    + """SELECT seq, CASE WHEN error_msg LIKE '%429%' OR lower(error_msg) LIKE '%quota%' THEN 'rate_limited' WHEN error_msg IS NOT NULL THEN 'other' END AS error_class,
      CASE WHEN error_msg = '429 quota' THEN 2.0::DOUBLE * power(2, attempt_no) WHEN error_msg IS NOT NULL AND attempt_no < 2 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS wait_seconds,
      input_tokens + output_tokens AS total_tokens FROM attempts""",
    "pending_rows": _with(_POSTINGS) + "SELECT row_index, job_id, dedup_key FROM pending",
    "enrichment_split": _with(_POSTINGS)
    + "SELECT count(*) AS n_rows, count(*) FILTER (enriched) AS n_done, count(*) FILTER (NOT enriched) AS n_pending FROM postings",
    "known_keys": _with(_POSTINGS)
    + "SELECT coalesce(nullif(job_id, ''), dedup_key) AS row_key FROM keyed WHERE enriched UNION SELECT row_key FROM processed",
    "cross_platform_dups": _with(_POSTINGS)
    + """SELECT row_index, xp_key, EXISTS (SELECT 1 FROM keyed o WHERE o.platform = 'linkedin' AND o.xp_key = k.xp_key) AS is_duplicate
      FROM keyed k WHERE platform = 'indeed'""",
    "result_scatter": _with(_POSTINGS, _PARSED, _RESULTS)
    + f""", old AS (SELECT source_file, row_index, {_OLD_CELLS} FROM postings)
      SELECT o.source_file, o.row_index, coalesce(r."AI_job_category", old_category) AS "AI_job_category",
      coalesce(r."AI_seniority_level", old_level) AS "AI_seniority_level", '' AS "AI_years_experience_required",
      '' AS "AI_education_required", coalesce(r."AI_remote_policy", old_policy) AS "AI_remote_policy", '' AS "AI_company_stage",
      r.parse_status, r.raw_response FROM old o LEFT JOIN results r ON r.row_index = o.row_index AND r.usable""",
    "aligned_results": _with(_POSTINGS, _PARSED, _RESULTS)
    + """SELECT p.source_file, p.row_index, r.parse_status, md5(r.j) AS result_md5, r.raw_response
      FROM postings p LEFT JOIN results r ON r.row_index = p.row_index AND r.usable""",
    "quota_admission": _with(_POSTINGS)
    + """SELECT source_file, row_index, row_number() OVER (ORDER BY source_file, row_index) AS seq FROM keyed WHERE NOT enriched
      ORDER BY source_file, row_index LIMIT 700""",
    "row_at": _with(_POSTINGS)
    + "SELECT source_file, row_index, title, company FROM postings WHERE source_file = 'f3.csv' AND row_index = 43",
    "ordered_rows": _with(_POSTINGS)
    + "SELECT row_number() OVER (ORDER BY source_file, row_index) AS place, source_file, row_index, title FROM postings ORDER BY place",
    "bag_union": _with(_POSTINGS)
    + "SELECT row_index, title, company FROM postings UNION ALL SELECT row_index, title, NULL FROM postings",
    "dedup_keep_first": _with(_POSTINGS)
    + "SELECT row_index, dedup_key, xp_key FROM keyed QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY row_index) = 1",
    "dedup_flagged": _with(_POSTINGS)
    + """SELECT row_index, row_index % 4 <> 1 AS dedup, dedup_key FROM keyed
      QUALIFY row_index % 4 = 1 OR row_number() OVER (PARTITION BY dedup_key ORDER BY row_index) = 1""",
    "dedup_counts": _with(_POSTINGS)
    + """SELECT count(*) AS n_rows, count(DISTINCT dedup_key) AS n_kept, count(*) - count(DISTINCT dedup_key) AS n_dropped FROM keyed""",
    "key_suppression": _with(_POSTINGS)
    + """, r AS (SELECT row_index, CASE WHEN row_index % 2 = 0 THEN '' ELSE job_id END AS job_id, dedup_key, row_index % 3 <> 0 AS ok FROM keyed),
      k AS (SELECT *, coalesce(nullif(job_id, ''), dedup_key) AS rk FROM r)
      SELECT row_index, job_id, dedup_key FROM k QUALIFY NOT coalesce(
        bool_or(ok) OVER (PARTITION BY rk ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE)""",
    "circuit_breaker": _with(_ATTEMPTS)
    + """, e AS (SELECT batch_id, seq, ok, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS era FROM attempts WINDOW w AS (PARTITION BY batch_id ORDER BY seq)),
      f AS (SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY batch_id, era ORDER BY seq) AS run FROM e),
      t AS (SELECT batch_id, min(seq) AS cut FROM f WHERE run >= 5 GROUP BY batch_id)
      SELECT f.batch_id, f.seq, f.ok FROM f LEFT JOIN t USING (batch_id) WHERE cut IS NULL OR seq <= cut""",
    "trailing_requests": _with(_ATTEMPTS)
    + """, w AS (SELECT batch_id, epoch_us(requested_at) AS at_micros,
        count(*) OVER (PARTITION BY batch_id ORDER BY requested_at RANGE BETWEEN INTERVAL 59.999999 SECONDS PRECEDING AND CURRENT ROW) AS n_trailing,
        count(*) OVER (PARTITION BY batch_id, requested_at) AS n_at FROM attempts)
      SELECT DISTINCT batch_id, at_micros, n_at, n_trailing, n_trailing > 1 AS over_limit FROM w""",
    "attempt_resolution": _with(_ATTEMPTS)
    + """SELECT row_key, count(*) AS n_attempts, min(attempt_no) FILTER (error_msg IS NULL) AS decided_by,
      arg_min(response_text, attempt_no) FILTER (error_msg IS NULL) AS response_text,
      arg_max(error_msg, attempt_no) FILTER (error_msg IS NOT NULL) AS last_error,
      CASE WHEN count(*) FILTER (error_msg IS NULL) = 0 THEN 'failed'
        WHEN arg_min(response_text, attempt_no) FILTER (error_msg IS NULL) = '' THEN 'empty' ELSE 'answered' END AS outcome
      FROM attempts GROUP BY row_key""",
    "commit_marks": _with(_ATTEMPTS)
    + """, c AS (SELECT batch_id, seq, ok, CAST(count(*) FILTER (ok) OVER (PARTITION BY batch_id ORDER BY seq) AS BIGINT) AS n_success,
        max(seq) OVER (PARTITION BY batch_id) AS last FROM attempts)
      SELECT batch_id, seq, n_success, CASE WHEN ok AND n_success % 10 = 0 THEN 'interval' ELSE 'end' END AS reason
      FROM c WHERE (ok AND n_success % 10 = 0) OR seq = last""",
    "throughput_blocks": _with(_ATTEMPTS)
    + """, c AS (SELECT batch_id, ok, epoch_us(requested_at) AS us, count(*) FILTER (ok) OVER (PARTITION BY batch_id ORDER BY seq) AS n,
        min(epoch_us(requested_at)) OVER (PARTITION BY batch_id) AS began FROM attempts)
      SELECT batch_id, (n - 1) // 10 AS block, count(*) AS n_success, max(n) AS n_so_far, max(us) - min(began) AS elapsed_micros,
      round(CASE WHEN max(us) - min(began) > 0 THEN max(n) * 1e6 / (max(us) - min(began)) END, 9) AS per_second
      FROM c WHERE ok GROUP BY batch_id, block""",
    "usage_cost": _with(_ATTEMPTS)
    + """SELECT batch_id, count(*) AS request_count, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
      CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS total_tokens,
      round(sum(input_tokens) / 1e6 * 0.01875 + sum(output_tokens) / 1e6 * 0.075, 12) AS cost_usd
      FROM attempts WHERE ok OR response_text IS NOT NULL GROUP BY batch_id""",
    "usage_by_model": _with(_ATTEMPTS)
    + """SELECT batch_id, model, count(*) AS request_count, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
      CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS total_tokens,
      round(sum(input_tokens) / 1e6 * 0.01875 + sum(output_tokens) / 1e6 * 0.075, 12) AS cost_usd
      FROM attempts WHERE ok OR response_text IS NOT NULL GROUP BY batch_id, model""",
    "daily_usage": _with(_ATTEMPTS)
    + """SELECT strftime(requested_at, '%Y-%m-%d') AS day, count(*) AS request_count, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
      CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS total_tokens,
      round(sum(input_tokens) / 1e6 * 0.01875 + sum(output_tokens) / 1e6 * 0.075, 12) AS cost_usd, count(*) >= 200 AS limit_reached
      FROM attempts WHERE ok OR response_text IS NOT NULL GROUP BY day""",
    "progress_summary": _with(_POSTINGS)
    + """SELECT (SELECT count(*) FROM keyed) - count(*) AS processed, (SELECT count(*) FROM keyed) AS total, count(*) AS remaining,
      round(((SELECT count(*) FROM keyed) - count(*)) * 100.0::DOUBLE / nullif((SELECT count(*) FROM keyed), 0), 1) AS percent FROM pending""",
    "enrich_table": _with(_POSTINGS, _PROMPTS, _MODEL)
    + f""", known AS (SELECT DISTINCT coalesce(nullif(job_id, ''), dedup_key) AS k FROM keyed WHERE enriched),
      cand AS (SELECT *, coalesce(nullif(job_id, ''), dedup_key) AS rk FROM model m WHERE NOT enriched
        AND NOT EXISTS (SELECT 1 FROM known WHERE k = nullif(m.job_id, '')) AND NOT EXISTS (SELECT 1 FROM known WHERE k = m.dedup_key)),
      firsts AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY rk ORDER BY source_file, row_index) = 1),
      bare AS (SELECT rk, source_file AS f0, row_index AS i0, usable AS ok0 FROM firsts WHERE nullif(job_id, '') IS NULL),
      sent AS (SELECT source_file, row_index FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM bare b WHERE nullif(f.job_id, '') IS NOT NULL
        AND b.rk = f.dedup_key AND b.ok0 AND (b.f0 < f.source_file OR (b.f0 = f.source_file AND b.i0 < f.row_index)))),
      old AS (SELECT m.*, {_OLD_CELLS}, NOT (s.row_index IS NOT NULL AND m.usable) AS keep FROM model m LEFT JOIN sent s USING (source_file, row_index))
      SELECT source_file, row_index,
      CASE WHEN keep THEN old_category WHEN status = 'raw' THEN '' ELSE json_extract_string(js, '$.job_category') END AS "AI_job_category",
      CASE WHEN keep THEN old_level WHEN status = 'raw' THEN '' WHEN n % 2 = 0 THEN 'Senior, Lead' ELSE 'Mid' END AS "AI_seniority_level",
      CASE WHEN keep OR status = 'raw' THEN '' ELSE CAST(n AS VARCHAR) END AS "AI_years_experience_required",
      '' AS "AI_education_required", CASE WHEN keep THEN old_policy ELSE '' END AS "AI_remote_policy", '' AS "AI_company_stage",
      CASE WHEN NOT keep THEN status END AS parse_status,
      CASE WHEN NOT keep AND status = 'raw' THEN 'no answer for ' || n END AS raw_response FROM old""",
    "enrich_rows": _with(_POSTINGS, _PROMPTS, _MODEL)
    + """SELECT source_file, row_index, CAST(CASE WHEN outcome = 'failed' THEN 3 ELSE 1 END AS BIGINT) AS n_attempts, outcome,
      status AS parse_status, usable, CASE WHEN outcome = 'failed' THEN '429 quota exceeded' END AS last_error
      FROM model""",
    "generate_with_fallback": _with(_POSTINGS, _PROMPTS, _MODEL)
    + """SELECT source_file, row_index, CASE WHEN n % 26 = 0 THEN NULL WHEN n % 13 = 0 THEN 'fallback ' || n WHEN n % 11 = 0 THEN NULL
        WHEN n % 7 = 0 THEN 'no answer for ' || n WHEN n % 5 = 0 THEN '```json' || chr(10) || js || chr(10) || '```' ELSE js END AS text,
      CAST(CASE WHEN n % 26 = 0 THEN 3 ELSE 1 END AS BIGINT) AS n_attempts,
      CASE WHEN n % 26 = 0 THEN 'failed' WHEN n % 13 = 0 THEN 'answered' WHEN n % 11 = 0 THEN 'empty' ELSE 'answered' END AS outcome FROM model""",
    "observed_progress": _with(_PARSED)
    + "SELECT count(*) AS total, count(*) FILTER (usable) AS processed, count(*) FILTER (NOT usable) AS failed FROM parsed",
    "stream_ingest": _with(_POSTINGS) + "SELECT row_index, title, company FROM postings",
    "stream_dedup": "SELECT DISTINCT user_id || '|||' || event_type AS key FROM events",
    "stream_daily_usage": _with(_ATTEMPTS)
    + """SELECT strftime(requested_at, '%Y-%m-%d') AS day, batch_id, count(*) AS request_count, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
      CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
      round(sum(input_tokens) / 1e6 * 0.01875 + sum(output_tokens) / 1e6 * 0.075, 12) AS cost_usd
      FROM attempts WHERE ok GROUP BY day, batch_id""",
    "stream_enrich": f"""WITH keyed AS (SELECT doc_id AS row_index, lang || ' ' || source AS title, source AS company, lang AS location,
        CAST(NULL AS VARCHAR) AS salary_range, text AS description, FALSE AS enriched FROM documents), {_PROMPTS.replace("keyed)", "keyed)")}, {_MODEL}
      SELECT row_index, status AS parse_status, 0 AS decided_by FROM model WHERE usable""",
}
