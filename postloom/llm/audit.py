"""Audit of how far the term distributions of sources drift from each other and from their language.

Terms are runs of ``TERM`` with A-Z lower-cased; null text, lang and source are read as ''. Each lang keeps the ``V``
terms found in at least ``min_docs`` of its documents (rows). Every occurring (lang, source) group, and each lang as
a whole, gives each kept term a smoothed share ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, ``N`` the group's
count of kept terms, and ``f(p, q) = floor((p - q)**2 / q)``. Part ``pair``: for each other source of the lang, the
sum of f over all kept terms, q the other source's share; part ``term``: each kept term the group has that is above
its share in the lang (q), ranked and cut after ``top`` ranks. Ranks run per group and part, value descending, item
ascending in UTF-8 order. All arithmetic is exact (decimals where products outgrow 64 bits).

The method. Texts are split into terms once, by Arrow, and counted with numpy per (lang, source, term) with the number
of documents that hold each; Spark adds the counts up before the shuffle. The kept vocabulary is split into ranges of
(lang, term) by range partitioning, together with the counted terms. Each range builds a minimal acyclic transducer from its sorted kept terms, by incremental construction with
a register of equivalent states; its outputs add up to each term's lexicographic ordinal. The counted terms of the
range go through it, each different term once, so that only kept terms are counted again, each under its ordinal; ordinals become
global by prefix sums over ranges and break ties between equal values. For the pair part each kept term becomes a
dense row of its lang's sources' shares (the constant share where a source lacks it); tasks add up f over their
terms for every pair of sources, and Spark adds up the tasks' sums.

Defined results: groups without any kept term still give their pair rows (value 0 where the lang keeps nothing) and
no term rows; a lang with one source gives no pair rows; repeated rows count as documents each; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.llm.common import small_batches, written
from postloom.session import shuffle_width

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Bytes of UTF-8: letters and all beyond ASCII stay, A-Z lower-cased, the rest are blanks.
SEPARATED = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
RANGE_ROWS = 1 << 18
COUNTED_BYTES = 16 << 20  # texts that a task counts at once
BIG = "decimal(38,0)"


class Vocabulary:
    """A minimal acyclic transducer from sorted distinct byte strings to their ordinals (0 = smallest)."""

    def __init__(self, words: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        unchecked: list[tuple[int, int, int]] = []  # (parent, byte, child) down the last word's path
        previous = b""

        def minimize(down_to: int) -> None:
            while len(unchecked) > down_to:
                parent, byte, child = unchecked.pop()
                key = (final[child], tuple(sorted(edges[child].items())))
                same = register.get(key)
                if same is None:
                    register[key] = child
                else:
                    edges[parent][byte] = same

        for word in words:
            if word <= previous and previous:
                raise ValueError("words must be sorted and distinct")
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            minimize(shared)
            node = unchecked[-1][2] if unchecked else 0
            for byte in word[shared:]:
                edges.append({})
                final.append(False)
                edges[node][byte] = len(edges) - 1
                node = len(edges) - 1
                unchecked.append((unchecked[-1][2] if unchecked else 0, byte, node))
            final[node] = True
            previous = word
        minimize(0)
        self._finish(edges, final)

    def _finish(self, edges: list[dict[int, int]], final: list[bool]) -> None:
        """Keep reachable states only; each edge's output is the number of words it skips."""
        order, words, stack = [], {}, [(0, False)]
        while stack:  # post-order: a state's count after those of its targets
            s, done = stack.pop()
            if done:
                if s not in words:
                    words[s] = int(final[s]) + sum(words[t] for t in edges[s].values())
                    order.append(s)
                continue
            if s in words:
                continue
            stack.append((s, True))
            stack.extend((t, False) for t in edges[s].values() if t not in words)
        self.size = words[0] if order else 0
        self.final = {s: final[s] for s in order}
        self.edges: dict[int, dict[int, tuple[int, int]]] = {}
        for s in order:
            skipped, out = int(final[s]), {}
            for byte in sorted(edges[s]):
                out[byte] = (edges[s][byte], skipped)
                skipped += words[edges[s][byte]]
            self.edges[s] = out
        self.states = len(order)

    def ordinal(self, word: bytes) -> int | None:
        state, total = 0, 0
        for byte in word:
            step = self.edges[state].get(byte)
            if step is None:
                return None
            state, out = step
            total += out
        return total if self.final[state] else None


def separated(text: pa.Array) -> pa.Array:
    """Texts (no nulls) with blanks for whatever is in no term, and A-Z lower-cased: bytes stay where they are."""
    _, offsets, data = text.buffers()
    data = pa.py_buffer((data.to_pybytes() if data else b"").translate(SEPARATED))
    return pa.Array.from_buffers(text.type, len(text), [None, offsets, data], offset=text.offset)


def counted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Occurrences of each (lang, source, term) of the batches, and the documents that hold it.

    Terms are coded by Arrow; counts are those of equal (document, term) and then (group, term) codes.
    """
    lang, source, text = (pa.concat_arrays([b.column(c) for b in batches]) for c in ("lang", "source", "text"))
    split = pc.ascii_split_whitespace(separated(text))
    coded = split.flatten().dictionary_encode()
    terms, lang, source = coded.dictionary, lang.dictionary_encode(), source.dictionary_encode()
    width, sources = max(1, len(terms)), max(1, len(source.dictionary))
    doc = np.repeat(np.arange(len(text)), np.diff(split.offsets.to_numpy()))
    found, n = np.unique(doc * width + coded.indices.to_numpy(), return_counts=True)
    real = pc.binary_length(terms).to_numpy() > 0  # a split gives empty strings at blank ends
    found, n = found[real[found % width]], n[real[found % width]]
    groups, group = np.unique(lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy(), return_inverse=True)
    keys, place = np.unique(group[found // width] * width + found % width, return_inverse=True)
    of = groups[keys // width]
    return pa.RecordBatch.from_arrays(
        [
            lang.dictionary.take(pa.array(of // sources)),
            source.dictionary.take(pa.array(of % sources)),
            terms.take(pa.array(keys % width)),
            # Sums below 2**53, so exact.
            pa.array(np.bincount(place, n, len(keys)).astype(np.int64)),
            pa.array(np.bincount(place, minlength=len(keys))),
        ],
        names=["lang", "source", "term", "count", "docs"],
    )


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: ``counted`` of every ``COUNTED_BYTES`` of texts."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= COUNTED_BYTES:
            yield counted(held)
            held, size = [], 0
    if held:
        yield counted(held)


def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: its vocabulary sizes by lang, and the counts of kept terms by (lang, source, local ordinal).

    Rows come sorted by (lang, term, kind); each different term goes through the transducer once.
    """
    pid, held = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
    if not held:
        return
    lang, term, kind, source, count = (pa.concat_arrays([b.column(c) for b in held]) for c in ("lang", "term", "kind", "source", "count"))
    held.clear()
    codes = lang.dictionary_encode()
    bounds = [0, *(np.flatnonzero(np.diff(codes.indices.to_numpy())) + 1).tolist(), len(lang)]
    for a, b in zip(bounds, bounds[1:]):
        terms = term.slice(a, b - a).dictionary_encode()
        words, at = terms.dictionary.cast(pa.binary()).to_pylist(), terms.indices.to_numpy()
        kept = kind.slice(a, b - a).to_numpy() == 0
        automaton = Vocabulary(words[i] for i in at[kept].tolist())
        ordinals = np.array([-1 if (o := automaton.ordinal(w)) is None else o for w in words], np.int64)[at]
        rows = pa.array(np.flatnonzero(~kept & (ordinals >= 0)) + a)
        n = len(rows) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, pid, np.int32)),
                pa.concat_arrays([lang.slice(a, 1), lang.take(rows)]),
                pa.concat_arrays([pa.nulls(1, pa.string()), source.take(rows)]),
                pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(ordinals[rows.to_numpy() - a])]),
                pa.concat_arrays([pa.nulls(1, pa.string()), term.take(rows)]),
                pa.concat_arrays([pa.array([automaton.size], pa.int64()), count.take(rows)]),
            ],
            names=["range", "lang", "source", "ordinal", "term", "count"],
        )


def share(count: Column, n: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (n + v))``, exactly: integral division of decimals."""
    top = F.lit(SCALE).cast(BIG) * (count + 1).cast(BIG)
    return (F.lit(1) + F.call_function("div", top, (n + v).cast(BIG))).cast("bigint")


def drift(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / q)`` for positive shares up to SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows ``lang, source, part, item, value, rank`` of the two parts."""
    spark = docs.sparkSession
    base = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    groups = written(base.select("lang", "source").distinct(), "llm-audit-groups")
    small_batches(spark)
    found_terms = base.mapInArrow(term_counts, "lang string, source string, term string, count bigint, docs bigint")
    # Each task adds up its batches again before the shuffle; a common term moves once a task.
    totals = found_terms.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    totals = written(totals, "llm-audit-counts")
    kept = totals.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = written(kept.select("lang", "term", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("source"), F.lit(0).cast("bigint").alias("count")), "llm-audit-kept")
    counted = totals.select("lang", "term", F.lit(1).alias("kind"), "source", "count")
    ranges = max(shuffle_width(spark), -(-(kept.count() + counted.count()) // RANGE_ROWS))
    both = kept.unionByName(counted).repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term", "kind")
    found = written(both.mapInArrow(recount, "range int, lang string, source string, ordinal bigint, term string, count bigint"), "llm-audit-found")
    sizes = found.where("term is null").select("range", "lang", F.col("count").alias("n"))
    # One row for each (range, lang) that a range holds.
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("range", "lang", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("lang")).alias("v"))
    present = found.where("term is not null").join(F.broadcast(sizes), ["range", "lang"])
    present = present.select("lang", "source", (F.col("first") + F.col("ordinal")).alias("ordinal"), "term", "count", "v")
    vocab = sizes.select("lang", "v").distinct()
    totals = found.where("term is not null").groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = groups.join(vocab, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = written(groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n", F.lit(0)).alias("n")), "llm-audit-sizes")
    groups = groups.withColumn("c", F.when(F.col("v") > 0, share(F.lit(0), F.col("n"), F.col("v"))))
    shares = present.join(groups.select("lang", "source", "n", "c"), ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("n"), F.col("v")))
    shares = written(shares.select("lang", "source", "ordinal", "term", "count", "v", "p", "c"), "llm-audit-shares")
    return term_part(shares, top).unionByName(pair_part(shares, groups))


def term_part(shares: DataFrame, top: int) -> DataFrame:
    whole = shares.groupBy("lang", "ordinal").agg(F.sum("count").alias("count"), F.first("v").alias("v"))
    lang_n = whole.groupBy("lang").agg(F.sum("count").alias("n"))
    whole = whole.join(lang_n, "lang").select("lang", "ordinal", share(F.col("count"), F.col("n"), F.col("v")).alias("q"))
    above = shares.join(whole, ["lang", "ordinal"]).where("p > q")
    value = drift(F.col("p"), F.col("q"))
    order = Window.partitionBy("lang", "source").orderBy(value.desc(), "ordinal")
    ranked = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"), F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= top)


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (lang, s, o) of a batch of kept terms: the sum of f(p_s, p_o) over them.

    Each term is a dense row of the shares of all sources of its lang, the constant share where a source lacks it;
    f is taken for one column o against all at once. Sums are split into 32-bit halves, so no 64-bit sum overflows.
    """
    low = np.uint64(0xFFFFFFFF)
    for batch in batches:
        out: dict[str, list] = {"lang": [], "s": [], "o": [], "total": []}
        langs = batch.column("lang").to_pylist()
        rows_of: dict[str, list[int]] = {}
        for i, lang in enumerate(langs):
            rows_of.setdefault(lang, []).append(i)
        for lang, rows in rows_of.items():
            every, has = batch.column("every")[rows[0]].values, batch.column("has").take(pa.array(rows))
            sources, names = every.field("source"), every.field("source").to_pylist()
            had = has.flatten()
            shares = np.tile(every.field("c").to_numpy(), (len(rows), 1))
            place = pc.index_in(had.field("source"), sources).to_numpy()
            shares[np.repeat(np.arange(len(rows)), pc.list_value_length(has).to_numpy()), place] = had.field("p").to_numpy()
            for o, name in enumerate(names):
                q = shares[:, o : o + 1]
                d = shares - q
                f = (d * d).view(np.uint64) // q.view(np.uint64)
                hi, lo = (f >> np.uint64(32)).sum(0), (f & low).sum(0)
                for s_, other in enumerate(names):
                    if s_ != o:
                        out["lang"].append(lang)
                        out["s"].append(other)
                        out["o"].append(name)
                        out["total"].append(Decimal((int(hi[s_]) << 32) + int(lo[s_])))
        yield pa.RecordBatch.from_pydict(
            out, schema=pa.schema([("lang", pa.string()), ("s", pa.string()), ("o", pa.string()), ("total", pa.decimal128(38, 0))])
        )


def pair_part(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum over kept terms of f(p_s, p_o), q = p_o, for every ordered pair of sources of a lang.

    Every kept term is had by some source, so the terms with their sources' shares are all terms. Each task adds up
    its terms' rows per pair; the sums, one row per task and pair, are added up by Spark.
    """
    width = shuffle_width(shares.sparkSession)
    has = shares.groupBy("lang", "ordinal").agg(F.collect_list(F.struct("source", "p")).alias("has"))
    every = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "c"))).alias("every"))
    # A common lang's terms are spread over all salts, each of which gets the lang's list of sources.
    every = every.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    has = has.withColumn("salt", F.pmod(F.xxhash64("ordinal"), F.lit(width)).cast("int")).join(every, ["lang", "salt"])
    walked = has.select("lang", "has", "every").mapInArrow(pair_sums, "lang string, s string, o string, total decimal(38,0)")
    walked = walked.groupBy("lang", "s", "o").agg(F.sum("total").alias("walked"))
    a = groups.select("lang", F.col("source").alias("s"))
    b = groups.select("lang", F.col("source").alias("o"))
    # The pairs of sources of a lang are the rows asked for.
    pairs = a.join(b, "lang").where("s <> o").join(walked, ["lang", "s", "o"], "left")
    value = F.coalesce("walked", F.lit(0).cast(BIG)).cast("bigint")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    made = pairs.select("lang", F.col("s").alias("source"), F.lit("pair").alias("part"), F.col("o").alias("item"), value.alias("value"))
    return made.withColumn("rank", F.row_number().over(order))


def oracle_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """DuckDB SQL for ``audit`` over the table ``documents``, with every group's shares of every kept term written out."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
occ AS (
  SELECT rid, lang, source, translate(t, '{UPPER}', '{LOWER}') AS term
  FROM d, unnest(regexp_extract_all(text, '{TERM}')) u(t)),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= {min_docs}),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT o.lang, o.source, o.term, count(*)::HUGEINT AS c FROM occ o JOIN kept k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(gc.c), 0) AS n FROM groups g LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source GROUP BY ALL),
gp AS (
  SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c, 1 + ({SCALE}::HUGEINT * (coalesce(gc.c, 0) + 1)) // (g.n + v.v) AS p
  FROM gn g JOIN v ON v.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source AND gc.term = k.term),
lc AS (SELECT lang, term, sum(c) AS c FROM gc GROUP BY ALL),
ln AS (SELECT lang, sum(c) AS n FROM gc GROUP BY lang),
lp AS (
  SELECT k.lang, k.term, 1 + ({SCALE}::HUGEINT * (coalesce(lc.c, 0) + 1)) // (coalesce(ln.n, 0) + v.v) AS q
  FROM kept k JOIN v ON v.lang = k.lang LEFT JOIN lc ON lc.lang = k.lang AND lc.term = k.term LEFT JOIN ln ON ln.lang = k.lang),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term_rows AS (
  SELECT gp.lang, gp.source, 'term' AS part, gp.term AS item, (gp.p - lp.q) * (gp.p - lp.q) // lp.q AS value
  FROM gp JOIN lp ON lp.lang = gp.lang AND lp.term = gp.term WHERE gp.c > 0 AND gp.p > lp.q),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
         (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM term_rows))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}"""
