"""Posting schema, external headings, result fields and closed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# The posting fields, their order and their types.
POSTING_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("min_amount", T.DoubleType()),
        T.StructField("max_amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("salary_range", T.StringType()),
        T.StructField("estimated_annual", T.DoubleType()),
        T.StructField("estimated_annual_usd", T.DoubleType()),
        T.StructField("posted_date", T.TimestampType()),
        T.StructField("job_url", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("requirements", T.StringType()),
        T.StructField("company_size", T.StringType()),
        T.StructField("job_status", T.StringType()),
        T.StructField("ai_analysis", T.StringType()),
        T.StructField("ai_analyzed", T.BooleanType()),
    ]
)

# A missing or empty cell of these fields takes this text.
POSTING_DEFAULTS = {"currency": "USD", "interval": "yearly", "job_status": "Active"}

# Display heading -> posting field, in export order.
HEADINGS = {
    "Job Title": "title",
    "Company Name": "company",
    "Requirements": "requirements",
    "Location": "location",
    "Salary Range": "salary_range",
    "Estimated Annual Salary": "estimated_annual",
    "Estimated Annual Salary (USD)": "estimated_annual_usd",
    "Job Description": "description",
    "Company Size": "company_size",
    "Posted Date": "posted_date",
    "Job Status": "job_status",
    "Platform": "platform",
    "Job Link": "job_url",
}

# The six result fields that are written to the table.
RESULT_FIELDS = (
    "job_category",
    "seniority_level",
    "years_experience_required",
    "education_required",
    "remote_policy",
    "company_stage",
)
AI_COLUMNS = tuple(f"AI_{name}" for name in RESULT_FIELDS)

# The answers allowed for each result field.
VOCABULARY = {
    "job_category": (
        "ML Engineer",
        "Data Scientist",
        "AI Researcher",
        "NLP Engineer",
        "Computer Vision Engineer",
        "AI Product Manager",
        "MLOps Engineer",
        "Data Engineer",
        "Research Scientist",
        "Applied Scientist",
        "Robotics Engineer",
        "AI Infrastructure Engineer",
        "Prompt Engineer",
        "Other",
    ),
    "seniority_level": (
        "Junior",
        "Mid",
        "Senior",
        "Lead",
        "Principal",
        "Director",
        "Not specified",
    ),
    "years_experience_required": ("0-2", "2-5", "5-8", "8-10", "10+", "Not specified"),
    "education_required": (
        "Bachelor's Required",
        "Bachelor's Preferred",
        "Master's Required",
        "Master's Preferred",
        "PhD Required",
        "PhD Preferred",
        "Not specified",
    ),
    "remote_policy": ("Remote", "Hybrid", "On-site", "Not specified"),
    "company_stage": ("Startup", "Scaleup", "Enterprise", "Not specified"),
}

# Row identity: input file and position in it.
ROW_ID = ("source_file", "row_index")

# Tables with these marks in their name are results or lock files.
RESULT_STEM_MARKS = ("_ai_perplexity", "_ai_gemini")
LOCK_PREFIX = "~$"

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("attempt_no", T.IntegerType()),
        T.StructField("requested_at", T.TimestampType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("response_text", T.StringType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("model", T.StringType()),
    ]
)
