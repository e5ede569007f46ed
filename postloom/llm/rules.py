"""Quality rules whose cutoffs are certified on labelled holdouts.

Each rule compares a ratio with a cutoff from a fixed grid. The labelled documents outside the held-out fold are
halved by a hash of their ids. One half chooses: in each stratum (language), the rule and cutoff that gain most
(rejected bad documents less ``PRICE`` times rejected clean ones, the laxer of equals), then the ones that gain most
among what is left, until none gains. The other half certifies the unions of the first choice, the first two and so on,
in this order and up to the first that fails: let a union reject ``k`` of the ``n`` clean documents of the half; it
passes if a false rejection rate of ``rate`` would give at most ``k`` with a probability of at most ``delta`` divided by
the number of strata tested (exact binomial tail). Tests in a fixed order cost no further share of ``delta``, and strata
too small to pass without a single rejection are not tested. So with probability ``1 - delta`` no stratum loses more
than ``rate`` of its clean documents.

``certified`` is the stricter way to one cutoff for each rule: on all of the labelled documents, each at
``rate / rules``, ``delta`` divided by all strata, rules and cutoffs.

All of it is DataFrame functions: statistics of whole texts, counts, tails and verdicts.

Defined results: a null text has no words and fails the base rule; strata without enough labels have no cutoffs, so
only the base rule rejects there; a null language is a stratum of its own; of several labels of one document the
smallest counts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.llm.common import fresh, text_or_empty, written
from postloom.llm.quality import held_out

SPACE = r"[\x20\x09-\x0D]+"
# Fixed values.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
RATE = 0.05
DELTA = 0.1
PRICE = 10
STEPS = 40
# rule: ratio and the ends of its grid of cutoffs
RULES = {
    "symbols": ("n_symbols / n_words", 0.005, 3.0),
    "repeated_words": ("n_repeat_words / n_words", 0.02, 1.0),
    "repeated_lines": ("n_dup_lines / n_lines", 0.02, 1.0),
    "long_words": ("word_chars / n_words", 4.0, 60.0),
    "short_words": ("n_words / word_chars", 0.1, 0.9),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeat_words(words: Column, window: int = 3) -> Column:
    """How many words are in windows of ``window`` words that the array holds twice or more.

    Most texts repeat no window: distinct hashes settle that. Else the windows themselves are sorted with their
    places, equal neighbours are the repeated ones, and the words that they cover are counted from place to place.
    """
    n = F.size(words)

    def at(i: Column, k: int) -> Column:
        return F.get(words, i + k)

    inner = F.slice(words, F.lit(1), F.greatest(n - (window - 1), F.lit(0)))
    hashes = F.transform(inner, lambda w, i: F.xxhash64(w, *(at(i, k) for k in range(1, window))))
    windows = F.transform(inner, lambda w, i: F.struct(F.concat_ws(" ", w, *(at(i, k) for k in range(1, window))).alias("w"), i.alias("i")))

    def places(s: Column) -> Column:
        def alike(x: Column, i: Column) -> Column:
            return F.get(s, i - 1)["w"].eqNullSafe(x["w"]) | F.get(s, i + 1)["w"].eqNullSafe(x["w"])

        return F.sort_array(F.transform(F.filter(s, alike), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def through(value: Column, f) -> Column:
        """``f(value)`` with ``value`` computed once."""
        return F.transform(F.array(value), f)[0]

    slow = through(through(F.sort_array(windows), places), covered)
    same = through(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(same, F.lit(0)).otherwise(slow).cast("long")


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS``, of whole texts."""
    words, whole, lined = fresh(docs, "words", "whole", "lines")
    made = docs.withColumn(whole, text_or_empty(text))
    made = made.withColumn(words, F.array_remove(F.split(whole, SPACE), ""))
    lines = F.filter(F.split(F.col(whole), "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    w, t = F.col(words), F.col(whole)
    made = made.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d")))[0].alias(lined),
        repeat_words(w).alias("n_repeat_words"),
    )
    return made.select(
        *(F.col(f"`{c}`") for c in docs.columns), "n_words", "word_chars", "n_symbols",
        F.col(lined)["n"].alias("n_lines"), (F.col(lined)["n"] - F.col(lined)["d"]).alias("n_dup_lines"), "n_repeat_words",
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratio(rule: str) -> Column:
    return F.coalesce(F.expr(f"try_divide({RULES[rule][0].replace(' / ', ', ')})"), F.lit(0.0))


def passed_cutoffs(rule: str) -> Column:
    """How many cutoffs of the rule's grid, which ascend in equal ratios, the ratio exceeds."""
    _, low, high = RULES[rule]
    steps = F.ceil(F.log(ratio(rule) / low) / F.log(F.lit(high / low)) * (STEPS - 1))
    return F.when(ratio(rule) <= low, F.lit(0)).otherwise(F.least(steps, F.lit(STEPS))).cast("int")


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial with n trials of probability p; 1 where k is beyond the mean."""
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), F.exp(n * F.log(F.lit(1 - p))).alias("sum"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j) + F.log(F.lit(p / (1 - p)))
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(steps, start, add)["sum"])


def certified(measured: DataFrame, labels: DataFrame, label: str = "quality", stratum: str = "lang") -> DataFrame:
    """``(stratum, rule, cutoff)``: the cutoff used by each rule in each stratum."""
    table = rejections(known_rows(measured, labels, label, stratum))
    tests = table.select("stratum").distinct().groupBy().agg((F.count("*") * len(RULES) * STEPS).alias("tests"))
    table = table.join(F.broadcast(tests))  # one row
    table = table.where(binomial_tail(F.col("k"), F.col("n"), RATE / len(RULES)) <= DELTA / F.col("tests"))
    best = gainful(table, "stratum", "rule")
    return best.select("stratum", "rule", F.col("passed").alias("cutoff"))


def known_rows(measured: DataFrame, labels: DataFrame, label: str, stratum: str) -> DataFrame:
    """Labelled documents outside the held-out fold that pass the base rule, once each: doc_id, stratum, ``y``, cutoffs
    passed by each rule."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.groupBy("doc_id").agg(F.min(label).alias("y"))
    known = measured.join(usable, "doc_id").where(~base_failed())
    known = known.select("doc_id", F.col(f"`{stratum}`").alias("stratum"), "y", *(passed_cutoffs(r).alias(r) for r in RULES))
    # One row per document: of rows repeating a doc_id, the one whose values hash least, chosen before the shuffle.
    one = F.min_by(F.struct(*known.columns), F.xxhash64(*known.columns))
    return known.groupBy("doc_id").agg(one.alias("_k")).select("_k.*")


def rejections(known: DataFrame) -> DataFrame:
    """Per stratum, rule and cutoff ``passed``: the ``n`` clean rows, and the clean (``k``) and bad rows rejected."""
    per_rule = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("passed")) for r in RULES)))
    seen = known.select("stratum", "y", per_rule.alias("x")).groupBy("stratum", "x.rule", "x.passed")
    seen = seen.agg(F.sum("y").alias("clean"), F.sum(1 - F.col("y")).alias("bad"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(STEPS)))
    sides = Window.partitionBy("stratum", "rule")
    beyond = sides.orderBy(F.desc("passed")).rangeBetween(Window.unboundedPreceding, 0)
    every = seen.select("stratum", "rule").distinct().withColumn("passed", steps)
    seen = seen.unionByName(every.withColumns({"clean": F.lit(0).cast("long"), "bad": F.lit(0).cast("long")}))
    seen = seen.groupBy("stratum", "rule", "passed").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    table = seen.select("stratum", "rule", "passed", F.sum("clean").over(sides).alias("n"), F.sum("clean").over(beyond).alias("k"), F.sum("bad").over(beyond).alias("bad"))
    return table.where("passed > 0")


def gainful(table: DataFrame, *by: str) -> DataFrame:
    """The rows of ``rejections`` that gain most for each value of ``by``, the laxer of equals, if they gain."""
    gain = F.col("bad") - PRICE * F.col("k")
    best = Window.partitionBy(*by).orderBy(gain.desc(), F.desc("passed"), "rule")
    return table.where(gain > 0).withColumn("nth", F.row_number().over(best)).where("nth = 1")


def joined(known: DataFrame, chosen: DataFrame, *columns: str) -> DataFrame:
    """``known`` with ``columns`` of its stratum's row in ``chosen``, null if there is none."""
    other = chosen.select(F.col("stratum").alias("of"), *columns)
    return known.join(other, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")


def passed_by(rule: Column) -> Column:
    return F.coalesce(*(F.when(rule == r, F.col(r)) for r in RULES))


def choices(known: DataFrame) -> DataFrame:
    """``(stratum, nth, rule, cutoff)``: rules and cutoffs in the order in which they gain most of what is left."""
    made, left = None, known
    for nth in range(1, len(RULES) + 1):
        best = gainful(rejections(left), "stratum").select("stratum", F.lit(nth).alias("nth"), "rule", F.col("passed").alias("cutoff"))
        best = written(best, "llm-choices")
        made = best if made is None else made.union(best)
        left = joined(left, best, "rule", "cutoff").where("rule is not null")
        left = left.where(passed_by(F.col("rule")) < F.col("cutoff")).drop("rule", "cutoff")
        if best.isEmpty():
            break
    return made


def certified_unions(measured: DataFrame, labels: DataFrame, label: str = "quality", stratum: str = "lang") -> DataFrame:
    """``(stratum, rule, cutoff)``: the rules of each stratum's largest certified union."""
    known = written(known_rows(measured, labels, label, stratum), "llm-known")
    half = F.pmod(F.xxhash64("doc_id", F.lit(42)), F.lit(2))
    chosen = written(choices(known.where(half == 0)), "llm-choices")
    picks = chosen.groupBy("stratum").agg(F.collect_list(F.struct("nth", "rule", "cutoff")).alias("picks"))
    first = F.array_min(F.transform(F.filter("picks", lambda p: passed_by(p["rule"]) >= p["cutoff"]), lambda p: p["nth"]))
    proof = joined(known.where((half == 1) & (F.col("y") == 1)), picks, "picks").where("picks is not null")
    proof = proof.select("stratum", first.alias("first")).groupBy("stratum", "first").count()
    # From here on, one row for each stratum.
    proof = proof.groupBy("stratum").agg(F.sum("count").alias("n"), F.collect_list(F.struct("first", "count")).alias("hits"))
    sizes = proof.groupBy().agg(F.collect_list("n").alias("sizes"))
    peers = F.size(F.filter("sizes", lambda m: m >= F.col("n"))).alias("peers")
    proof = written(proof.join(F.broadcast(sizes)).select("stratum", "n", "hits", peers), "llm-proof")
    able = proof.where(F.col("n") * F.log(F.lit(1 - RATE)) <= F.log(DELTA / F.col("peers")))
    tests = able.groupBy().agg(F.max("peers").alias("tests"))
    tested = proof.join(F.broadcast(tests)).where("peers <= tests")
    each = joined(chosen, tested, "n", "hits", "tests").where("n is not null")
    k = F.aggregate(F.filter("hits", lambda h: h["first"] <= F.col("nth")), F.lit(0).cast("long"), lambda a, h: a + h["count"])
    # k grows with nth, so what passes is the unions up to the first that fails.
    each = each.withColumn("k", k).where(binomial_tail(F.col("k"), F.col("n"), RATE) <= DELTA / F.col("tests"))
    return each.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def with_verdicts(measured: DataFrame, chosen: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    (key,) = fresh(measured, "stratum")
    names = fresh(measured, *(f"cutoff_{r}" for r in RULES))
    wide = chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.min("cutoff")).toDF(key, *names)
    both = measured.join(wide, F.col(f"`{stratum}`").eqNullSafe(F.col(key)), "left")
    broken = F.greatest(*(F.coalesce(passed_cutoffs(r) >= F.col(c), F.lit(False)) for r, c in zip(RULES, names)))
    kept = (~base_failed() & ~broken).alias("kept")
    return both.select(*(F.col(f"`{c}`") for c in measured.columns), base_failed().alias("base_failed"), kept)


def accepted(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with cutoffs certified on the labelled rows of ``labelled``, or its own.

    Texts are counted for the cutoffs and for the verdicts, and moved by no shuffle.
    """
    chosen = cutoffs(docs if labelled is None else labelled, labels)[1]
    (taken,) = fresh(docs, "row")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(taken), "lang", "text")
    # Asking for the number keeps filters above the counts: below them, texts would be split once for every word.
    measured = counts(whole).withColumn("number", F.monotonically_increasing_id())
    return with_verdicts(measured, chosen).where("kept and number >= 0").select(f"{taken}.*")


def cutoffs(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The counts of ``docs`` and the certified cutoffs, both written."""
    measured = written(counts(docs.select("doc_id", "lang", "text")).drop("text"), "llm-counts")
    return measured, written(certified_unions(measured, labels), "llm-cutoffs")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, ``base_failed`` and ``kept``."""
    return with_verdicts(*cutoffs(docs, labels)).select("doc_id", *COUNTS, "base_failed", "kept")
