"""Verdicts on urls: rules by host and path, and a ratio of two character models for the rest.

The models are variable-order Markov chains over host and path: of each character after its last ``ORDER`` ones,
interpolated down to no context by Witten-Bell weights (contexts that were never seen give way to shorter ones). One
is of rejected, one of accepted urls. Rejected are those with one of ``SEEDS`` as a part of their host; a quarter of
the others, by a hash, is left out and sets the threshold: the score (mean difference of log likelihoods per
character) that no more than ``FALSE_REJECTIONS`` of them pass, 0 at least. Urls that a rule decides take no part.

Only counts of different strings of ``ORDER + 1`` characters are joined, so a frequent string is one row; lookups of
the characters of all urls are salted, and not by broadcast, as that table grows with the urls.

Defined results: null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed; so is
every url where no url is rejected by a seed; repeated rows each get their verdict; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postloom.llm.common import fresh, written

ORDER = 4
SALTS = 16
FALSE_REJECTIONS = 0.005
MAX_RULES = 1000
# Rules as (host and path, verdict), and the words of spam hosts.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
SEEDS = (
    "ads", "adult", "bet", "bets", "casino", "cheap", "click", "escort", "free", "gambling", "loan", "loans", "lottery", "pharma", "pill",
    "pills", "poker", "porn", "promo", "sex", "slots", "spam", "track", "tracker", "tracking", "viagra", "win", "xxx",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def grams(text: Column) -> Column:
    """Each character with the ``ORDER`` ones before it; the start counts as so many separators."""
    padded = F.concat(F.lit("\u0002" * ORDER), text)
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substr(padded, i, F.lit(ORDER + 1)))


def likelihoods(counts: DataFrame) -> DataFrame:
    """``(gram, d)`` from ``(gram, accepted, rejected)``: log likelihood under rejected less that under accepted urls."""
    table, p = counts.select("gram"), {"accepted": F.lit(1 / 256), "rejected": F.lit(1 / 256)}
    for k in range(ORDER + 1):
        tail = F.substring("gram", ORDER + 1 - k, k + 1)
        seen = counts.groupBy(tail.alias(f"tail{k}")).agg(*(F.sum(c).alias(c) for c in p))
        context = F.substring(f"tail{k}", 1, k)
        totals = seen.groupBy(context.alias("context")).agg(
            *(F.sum(c).alias(f"n_{c}") for c in p), *(F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in p)
        )
        seen = seen.join(totals, context == F.col("context"))
        step = {}
        for c, lower in p.items():
            step[f"{c}{k}"], step[f"n_{c}{k}"], step[f"kinds_{c}{k}"] = F.col(c), F.col(f"n_{c}"), F.col(f"kinds_{c}")
            n, kinds = F.col(f"n_{c}{k}"), F.col(f"kinds_{c}{k}")
            p[c] = F.when(n > 0, (F.col(f"{c}{k}") + kinds * lower) / (n + kinds)).otherwise(lower)
        seen = seen.select(f"tail{k}", *(v.alias(c) for c, v in step.items()))
        table = table.withColumn(f"tail{k}", tail).join(seen, f"tail{k}")
    return table.select("gram", (F.log(p["rejected"]) - F.log(p["accepted"])).alias("d"))


def scores(texts: DataFrame) -> DataFrame:
    """``(s, held, seed, score)`` for different strings ``(s, seed)``."""
    held = F.pmod(F.xxhash64("s"), F.lit(4)) == 2
    texts = written(texts.withColumn("held", held & ~F.col("seed")), "llm-urls")
    parts = texts.select("s", "seed", "held", F.explode(grams(F.col("s"))).alias("gram"))
    counts = parts.groupBy("gram").agg(
        F.sum((~F.col("seed") & ~F.col("held")).cast("long")).alias("accepted"), F.sum(F.col("seed").cast("long")).alias("rejected")
    )
    table = written(likelihoods(written(counts, "llm-grams")), "llm-likelihoods")
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("s", F.lit(7)), F.lit(SALTS)).cast("int"))
    found = parts.join(salted.hint("merge"), ["gram", "salt"]).groupBy("s", "seed", "held").agg(F.sum("d").alias("d"))
    return written(found.select("s", "seed", "held", (F.col("d") / F.length("s")).alias("score")), "llm-url-scores")


def verdicts(pages: DataFrame, url: str = "url", rules=RULES, seeds=SEEDS) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict."""
    names = fresh(pages, "host", "path", "rule", "score", "verdict")
    h, p, r, sc, v = names
    says, s = fresh(pages, "rule_says", "rule_text")
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    made = pages.withColumns({h: host, p: path})
    rule, verdict = rule_of(F.col(h), F.col(p), rules)
    made = made.withColumns({r: rule, says: verdict, s: F.concat(h, p)})
    seed = F.arrays_overlap(F.split(F.col(h), "[.-]"), F.lit(list(seeds)))
    open_ = made.where(F.col(r).isNull() & (F.length(s) > 0)).select(F.col(s).alias("s"), seed.alias("seed"))
    scored = scores(open_.groupBy("s").agg(F.max("seed").alias("seed")))
    seeds_seen = F.max(F.col("seed"))
    found = scored.agg(F.percentile_approx(F.when(F.col("held"), F.col("score")), 1 - FALSE_REJECTIONS, 10_000).alias("at"), seeds_seen.alias("any")).first()
    threshold = max(0.0, found["at"] or 0.0) if found["any"] else float("inf")
    both = made.join(scored.select(F.col("s").alias(s), F.col("score").alias(sc)), s, "left")
    by_model = F.when(F.col(sc) > threshold, "block").otherwise("allow")
    return both.select(*(F.col(f"`{c}`") for c in pages.columns), h, p, r, F.when(F.col(r).isNull(), F.col(sc)).alias(sc), F.coalesce(F.col(says), by_model).alias(v))


def report(pages: DataFrame) -> DataFrame:
    return verdicts(pages.select("page_id", "url")).drop("url")
