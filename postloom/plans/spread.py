"""Equi-lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from postloom.session import shuffle_width

# A key is hot from this part of one fair partition on, so there are at most
# partitions / HOT_PART hot keys, sent as 8-byte hashes: the proven bound for the
# broadcasts below. The size of the table plays no part.
HOT_PART = 0.25


def _present(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def hot_keys(df: DataFrame, keys: Sequence[str], part: float | None = None) -> DataFrame:
    """Hashes ``_hot`` of the keys that hold ``part`` of a fair partition's rows each, and into how many places to split them.

    Reads the key columns only; counts are combined before the shuffle. A key
    gets twice its share of the shuffle partitions, so all hot keys together get
    at most two places per partition, plus two each. Keys of one hash are split
    alike, which changes no result.
    """
    width = shuffle_width(df.sparkSession)
    hashed = df.where(_present(keys)).select(F.xxhash64(*keys).alias("_hot"))
    counts = hashed.groupBy("_hot").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    fair = F.ceil(F.col("_n") * width / total) * 2
    return counts.where(F.col("_n") * width >= total * (part or HOT_PART)).select(
        "_hot", F.least(F.lit(width), F.greatest(F.lit(2), fair)).cast("int").alias("_fan")
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    part: float | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds each key once, without a hot task.

    Left rows with a hot key go to one of the key's places by a hash of
    ``spread_by`` (a unique row id), rows with a NULL key anywhere; only the hot
    rows of ``right`` are copied to each of their places. ``how`` is any join
    that keeps left rows or pairs: left, inner, left_semi, left_anti.
    """
    keys = list(keys)
    width = shuffle_width(left.sparkSession)
    hot = F.broadcast(hot_keys(left, keys, part))
    hashed = F.when(_present(keys), F.xxhash64(*keys)).alias("_hot")
    fan = F.when(_present(keys), F.coalesce(F.col("_fan"), F.lit(1))).otherwise(F.lit(width))
    place = F.when(fan == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread_by), fan).cast("int"))
    spread = left.select("*", hashed).join(hot, "_hot", "left").withColumn("_place", place).drop("_fan", "_hot")
    copies = right.select("*", hashed).join(hot, "_hot", "left").withColumn(
        "_place", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_fan"), F.lit(1)) - 1))
    ).drop("_fan", "_hot")
    return spread.join(copies, [*keys, "_place"], how).drop("_place")
