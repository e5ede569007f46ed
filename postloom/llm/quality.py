"""Quality scores by gradient-boosted trees over statistics of the whole text.

The trees are fitted on the driver on a bounded sample of labelled documents (``train_rows``, those with the
smallest hashes of their ids); every document is scored, in its task, from its text alone.

Defined results: a null text is scored like the empty one; without usable labels every score is the same smoothed
share; a null doc_id is never held out; of several labels of one document the smallest counts; an empty table gives
no rows.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postloom.llm.common import fresh, small_batches, text_or_empty
from postloom.llm.gbt import Trees, fit

TRAIN_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "longest_word", "upper", "digit", "space", "control",
    "not_ascii", "stops", "marks", "symbols", "symbol_ends", "distinct_words", "commonest_word", "same_neighbours",
    "distinct_triples", "log_lines", "distinct_lines", "short_lines", "capitalised",
)
CLASSES = [
    np.array([b for b in range(256) if test(b)])
    for test in (
        lambda b: 65 <= b <= 90,
        lambda b: 48 <= b <= 57,
        lambda b: b in b" \t\n\r\x0b\x0c",
        lambda b: b < 32 and b not in b"\t\n\r\x0b\x0c",
        lambda b: b >= 128,
        lambda b: b in b".,",
        lambda b: b in b";:!?'\"()-",
        lambda b: b in b"#*$%&|<>@^~=+_{}[]\\/`",
    )
]


def statistics(text: str) -> list[float]:
    """The features of one text."""
    raw = text.encode()
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    shares = [counts[c].sum() / n for c in CLASSES]
    words = raw.split()
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), "i8", len(words)) if words else np.zeros(1, "i8")
    order: dict[bytes, int] = {}
    ids = np.fromiter((order.setdefault(w, len(order)) for w in words), "i8", len(words))
    commonest = np.bincount(ids).max() if words else 0
    triples = len(np.unique((ids[:-2] * len(order) + ids[1:-1]) * len(order) + ids[2:])) if len(words) > 2 else 0
    lines = [line for line in raw.split(b"\n") if line.strip()]
    k = max(1, len(lines))
    ends = np.fromiter((w[-1] for w in words), "u1", len(words))
    starts = np.fromiter((w[0] for w in words), "u1", len(words))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), lengths.std(), np.log1p(lengths.max()), *shares,
        np.isin(ends, CLASSES[7]).sum() / m, len(order) / m, commonest / m, sum(map(eq, words, words[1:])) / m,
        triples / max(1, len(words) - 2), np.log1p(len(lines)), len(set(lines)) / k,
        sum(len(line) < 40 for line in lines) / k, ((starts >= 65) & (starts <= 90)).sum() / m,
    ]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of the document are kept for evaluation: crc32 of its id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees for ``label`` from at most ``train_rows`` labelled documents outside the held-out fold."""
    small_batches(docs.sparkSession)
    labels = labels.select("doc_id", F.col(f"`{label}`").alias("y"))
    usable = labels.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).toDF("label_id", "y")

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([[float(v) for v in statistics(t.as_py())] for t in texts], pa.list_(pa.float64()))

    # Only id and text of the documents, so that no column of theirs clashes; one text per labelled id, chosen on
    # the executors (the one with the smallest hash), so that repeated rows of an id reach the driver once.
    texts = docs.select(F.col("doc_id").alias("label_id"), text_or_empty("text").alias("t"))
    known = texts.join(F.broadcast(chosen), "label_id")
    known = known.groupBy("label_id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    rows = known.select("label_id", "y", of(F.col("t")).alias("x")).toPandas()
    rows = rows.sort_values("label_id", kind="stable")
    x = np.array(rows["x"].tolist(), "f8").reshape(-1, len(FEATURES))
    return fit(x, rows["y"].to_numpy("f8"))


def score(docs: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t.as_py()) for t in texts], "f8").reshape(-1, len(FEATURES))
        return pa.array(trees.predict(x))

    return docs.withColumn(out, of(text_or_empty(text)))


def accepted(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``."""
    (out,) = fresh(docs, "score")
    return score(docs, trees, out=out).where(F.col(out) >= threshold).select(docs.columns)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
