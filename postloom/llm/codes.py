"""Product codes of vectors: integer k-means per part, with the assignment walked down a trie of distinct parts.

Each vector's components are scaled to integers ``floor(scale * x)`` and cut into ``parts`` equal consecutive parts
(vectors shorter than the longest are padded with zeros, so all parts have ``ceil(longest / parts)`` components).
Each part position has its own codebook of up to ``entries`` integer entries, seeded by that part of the vectors
with the smallest vec_ids. A round assigns each part to its codebook's nearest entry (squared Euclidean distance,
ties to the lower index) and replaces each used entry by the componentwise floor of its parts' mean.

The method. A round sees each distinct part once, with its number of occurrences as weight, so exact copies of a
vector, however many, cost one part each. A task sorts its distinct parts in lexicographic order, which is the
depth-first order of the trie over their components: neighbours share the trie path of their common prefix, so the
vector of distances to all entries accumulated over that prefix is kept and only the remaining components are added.
At a leaf the nearest entry is the argmin of that vector, and the part's weighted components are added to the sums of
its entry. Sums and counts are added up across tasks by Spark; only the codebooks, ``entries * width`` integers,
come to the driver and go out to the tasks. The final assignment runs the same walk over each task's own vectors.

Defined results: rows whose vector is null or holds a null, NaN or infinite component are dropped; every other row
gives one row, repeated rows and null vec_ids included (a null vec_id sorts after all others when seeding); an empty
vector is all zeros after padding; fewer kept rows than ``entries`` give that many entries; an empty table gives no
rows. ``label_error`` sums the errors of the rows with an equal label, null labels together. Arithmetic on the
integers is exact: in 64 bits while components stay below 2**24 in magnitude, in Python integers beyond.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from postloom.llm.common import written
from postloom.plans.spread import lookup

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
SMALL = 1 << 24


def kept_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(row, vec_id, label, ints)`` of the rows whose vector is whole and finite; ``row`` is unique."""
    vec = F.col("embedding")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    ints = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kept = vectors.where(vec.isNotNull() & ~bad)
    return kept.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), ints.alias("ints")
    )


def padded(ints, width: int, parts: int):
    return F.concat(ints, F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.lit(width * parts) - F.size(ints))))


def as_matrix(values, width: int) -> np.ndarray:
    """Parts as an ``(n, width)`` matrix, int64 if small enough for exact distances, else Python integers."""
    rows = [list(v) for v in values]
    big = any(abs(x) >= SMALL for r in rows for x in r)
    out = np.array(rows, dtype=object if big else np.int64).reshape(len(rows), width)
    return out


def walk(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of ``book`` and its squared distance for each row of ``parts``, down the trie of the rows."""
    n, width = parts.shape
    entry = np.zeros(n, np.int64)
    dist = np.zeros(n, dtype=object if parts.dtype == object or book.dtype == object else np.int64)
    if not n or not len(book):
        return entry, dist
    order = np.lexsort(parts.T[::-1]) if width else np.arange(n)
    ordered = parts[order]
    shared = np.zeros(n, np.int64)
    if n > 1 and width:
        differ = ordered[1:] != ordered[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), width)
    acc = np.zeros((width + 1, len(book)), dtype=dist.dtype)
    columns = [book[:, d] for d in range(width)]
    for i in range(n):
        row = ordered[i]
        for d in range(shared[i], width):
            step = row[d] - columns[d]
            acc[d + 1] = acc[d] + step * step
        total = acc[width]
        e = int(np.argmin(total))
        entry[order[i]] = e
        dist[order[i]] = total[e]
    return entry, dist


def round_sums(parts_table: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """Per (pos, entry): ``j`` = -1 holds the weight, ``j`` >= 0 the weighted sum of component j of its parts."""
    shared = parts_table.sparkSession.sparkContext.broadcast(books)

    def sums(batches):
        for batch in batches:
            pos = batch.column("pos").to_numpy()
            weight = batch.column("weight").to_numpy()
            values = batch.column("part").to_pylist()
            out_pos, out_entry, out_j, out_total = [], [], [], []
            for p in np.unique(pos):
                at = np.flatnonzero(pos == p)
                parts = as_matrix([values[i] for i in at], width)
                entry, _ = walk(parts, shared.value[p])
                w = weight[at]
                totals: dict[tuple[int, int], int] = {}
                if parts.dtype != object and len(w) and int(w.max()) * SMALL * len(w) < 1 << 62:
                    # Weighted sums per entry at once: every product and sum stays below 2**62.
                    used = np.unique(entry)
                    sums = np.zeros((len(used), width), np.int64)
                    counts = np.zeros(len(used), np.int64)
                    slot = np.searchsorted(used, entry)
                    np.add.at(sums, slot, parts * w[:, None])
                    np.add.at(counts, slot, w)
                    for e, row, c in zip(used.tolist(), sums.tolist(), counts.tolist()):
                        totals[(e, -1)] = c
                        totals.update(((e, j), v) for j, v in enumerate(row))
                else:
                    for k, e in enumerate(entry):
                        n = int(w[k])
                        totals[(int(e), -1)] = totals.get((int(e), -1), 0) + n
                        for j in range(width):
                            totals[(int(e), j)] = totals.get((int(e), j), 0) + n * int(parts[k, j])
                for (e, j), t in totals.items():
                    out_pos.append(int(p))
                    out_entry.append(e)
                    out_j.append(j)
                    out_total.append(Decimal(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_pos, pa.int32()), pa.array(out_entry, pa.int32()), pa.array(out_j, pa.int32()), pa.array(out_total, pa.decimal128(38, 0))],
                names=["pos", "entry", "j", "total"],
            )

    found = parts_table.mapInArrow(sums, "pos int, entry int, j int, total decimal(38,0)")
    return found.groupBy("pos", "entry", "j").agg(F.sum("total").alias("total"))


def updated(books: list[np.ndarray], sums: list, width: int) -> list[np.ndarray]:
    """Each used entry becomes the componentwise floor of its parts' mean; unused entries stay."""
    books = [b.copy() for b in books]
    weight = {(r.pos, r.entry): int(r.total) for r in sums if r.j == -1}
    for r in sums:
        if r.j >= 0 and weight.get((r.pos, r.entry)):
            value = int(r.total) // weight[(r.pos, r.entry)]
            book = books[r.pos]
            if book.dtype != object and abs(value) >= SMALL:
                books[r.pos] = book = book.astype(object)
            book[r.entry, r.j] = value
    return books


def quantize(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Per kept row of ``vectors`` (``vec_id``, ``embedding``, optional ``label``): vec_id, label, code, error,
    label_error, codebooks_sha256. ``code`` is the entries' indexes in part order, two hex digits each when
    ``entries`` <= 256."""
    spark = vectors.sparkSession
    kept = written(kept_rows(vectors, scale), "llm-code-rows")
    longest = kept.agg(F.max(F.size("ints"))).first()[0] or 0
    width = -(-longest // parts)
    whole = padded(F.col("ints"), width, parts)
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select(whole.alias("v")).collect()
    seed = as_matrix([r.v for r in seeds], width * parts)
    books = [seed[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    cut = F.array(*(F.slice(whole, p * width + 1, width) if width else F.array().cast("array<bigint>") for p in range(parts)))
    distinct = kept.select(F.posexplode(cut).alias("pos", "part")).groupBy("pos", "part").agg(F.count(F.lit(1)).alias("weight"))
    distinct = written(distinct, "llm-code-parts")
    for _ in range(rounds):
        books = updated(books, round_sums(distinct, books, width).collect(), width)
    shared = spark.sparkContext.broadcast(books)
    digits = max(2, len(f"{max(entries - 1, 1):x}"))

    def final(batches):
        for batch in batches:
            values = batch.column("v").to_pylist()
            codes = [""] * len(values)
            errors = [0] * len(values)
            for p in range(parts):
                matrix = as_matrix([v[p * width : (p + 1) * width] for v in values], width)
                entry, dist = walk(matrix, shared.value[p])
                for i in range(len(values)):
                    codes[i] += f"{int(entry[i]):0{digits}x}"
                    errors[i] += int(dist[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(codes, pa.string()), pa.array([Decimal(e) for e in errors], pa.decimal128(38, 0))], names=["row", "code", "error"]
            )

    coded = kept.select("row", whole.alias("v")).mapInArrow(final, "row bigint, code string, error decimal(38,0)")
    rows = written(kept.select("row", "vec_id", "label").join(coded, "row"), "llm-codes")
    keyed = rows.withColumns({"lab_null": F.col("label").isNull(), "lab": F.coalesce(F.col("label").cast("bigint"), F.lit(0))})
    per_label = keyed.groupBy("lab_null", "lab").agg(F.sum("error").alias("label_error"))
    joined = lookup(keyed, per_label, ["lab_null", "lab"], ["row"])
    text = ",".join(str(int(x)) for b in books for entry in b for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return joined.select(
        "vec_id",
        "code",
        F.col("error").cast("bigint").alias("error"),
        F.col("label_error").cast("bigint").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
        "label",
    )


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL for ``quantize`` over the table ``embeddings``, rounds written out one after another."""
    ctes = [
        f"""kept AS (
  SELECT vec_id::BIGINT AS vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"shape AS (SELECT coalesce((max(len(v)) + {parts - 1}) // {parts}, 0) AS w FROM kept)",
        f"""rows AS (
  SELECT row_number() OVER () AS rid, vec_id, label,
         list_transform(range(w * {parts}), lambda i: coalesce(v[i + 1], 0)) AS v, w FROM kept, shape)""",
        f"""parts AS (
  SELECT rid, p AS pos, list_transform(range(w), lambda j: v[p * w + j + 1]) AS part FROM rows, range({parts}) t(p))""",
        "dparts AS (SELECT pos, part, count(*) AS weight FROM parts GROUP BY pos, part)",
        f"""book0 AS (
  SELECT p.pos, s.idx, p.part AS c
  FROM (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS idx FROM rows) s
  JOIN parts p USING (rid) WHERE s.idx < {entries})""",
    ]

    def assign(source: str, book: str, name: str) -> str:
        square = "list_sum(list_transform(range(len(d.part)), lambda j: (d.part[j + 1] - b.c[j + 1]) * (d.part[j + 1] - b.c[j + 1])))"
        return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pos, part ORDER BY dist, idx) AS nth FROM (
      SELECT d.*, b.idx, coalesce({square}, 0)::BIGINT AS dist FROM {source} d JOIN {book} b ON d.pos = b.pos))
  WHERE nth = 1)"""

    for r in range(rounds):
        ctes.append(assign("dparts", f"book{r}", f"near{r}"))
        ctes.append(f"""sums{r} AS (
  SELECT pos, idx, j, sum(weight * part[j + 1]) AS s, sum(weight) AS n
  FROM near{r}, shape, range(w) t(j) GROUP BY pos, idx, j)""")
        ctes.append(f"""book{r + 1} AS (
  SELECT b.pos, b.idx, list(coalesce(u.x, b.c[t.j + 1]) ORDER BY t.j) AS c
  FROM book{r} b CROSS JOIN shape CROSS JOIN range(shape.w) t(j)
  LEFT JOIN (SELECT pos, idx, j, (s - ((s % n) + n) % n) // n AS x FROM sums{r}) u ON u.pos = b.pos AND u.idx = b.idx AND u.j = t.j
  GROUP BY b.pos, b.idx)""")
    ctes.append(assign("dparts", f"book{rounds}", "near_final"))
    body = ",\n".join(ctes)
    return f"""WITH {body},
coded AS (
  SELECT r.rid, any_value(r.vec_id) AS vec_id, any_value(r.label) AS label,
         string_agg(format('{{:02x}}', n.idx), '' ORDER BY p.pos) AS code, sum(n.dist)::BIGINT AS error
  FROM rows r JOIN parts p USING (rid) JOIN near_final n ON n.pos = p.pos AND n.part = p.part
  GROUP BY r.rid),
digest AS (
  SELECT sha256(coalesce(string_agg(x::VARCHAR, ',' ORDER BY pos, idx, j), '')) AS h
  FROM (SELECT pos, idx, j, c[j + 1] AS x FROM book{rounds}, range(len(c)) t(j)))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256, label
FROM coded, digest"""
