"""Small tables for the operators' tests."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    """A documents table from (doc_id, text)."""
    return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCS)


def syllables(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["the", "an", "é", "ß", "ing", "to", "漢", "ble"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


EDGES = [None, "", " \n\t ", "a", "a" * 5000, "ab " * 2000, "\x00\x1c\x85", "😀漢字", "#*$ | <b>", "x\n" * 300]
