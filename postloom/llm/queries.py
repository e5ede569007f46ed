"""One query for each operator, over the whole of its table, with its production parameters."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import functions as F

from postloom.llm import ann, audit, bpe, codes, counts, html, packing, quality, repeats, rules, simhash, urls, windows
from postloom.llm.common import table

BPE = path("byte_bpe_50k.json")
PIECES = path("piece_bpe_32k.model")
WORDS = path("word_bpe_49k.json")


def op1_token_counts(spark, sf_dir):
    return counts.report(table(spark, sf_dir, "documents"), PIECES)


def op2_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), BPE)


def op3_simhash(spark, sf_dir):
    return simhash.digests(table(spark, sf_dir, "documents"))


def op4_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), BPE)


def op6_repeats(spark, sf_dir):
    return repeats.digests(table(spark, sf_dir, "documents"))


def op7_quality(spark, sf_dir):
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html(spark, sf_dir):
    return html.report(table(spark, sf_dir, "pages"))


def op9_rules(spark, sf_dir):
    return rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_urls(spark, sf_dir):
    return urls.report(table(spark, sf_dir, "pages"))


def op11_codes(spark, sf_dir):
    return codes.quantize(table(spark, sf_dir, "embeddings"))


def op12_windows(spark, sf_dir):
    return windows.pack(table(spark, sf_dir, "documents"), WORDS)


def op13_audit(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_bpe, op3_simhash, op4_ann, op5_packing, op6_repeats, op7_quality, op8_html, op9_rules, op10_urls, op11_codes, op12_windows, op13_audit)}
ORACLE: dict[str, str] = {"op11_codes": codes.oracle_sql(), "op13_audit": audit.oracle_sql()}
