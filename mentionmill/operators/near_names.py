"""Pairs of like strings, by an inverted index of their bigrams."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType


@F.pandas_udf(IntegerType())
def indel_ratio(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """Similarity of two strings in percent: twice the matching characters over all characters; 0 where the characters they share cannot make ``least``."""

    def ratio(x: str, y: str, low: int) -> int:
        pair = SequenceMatcher(None, x or "", y or "", autojunk=False)
        return round(100 * pair.ratio()) if round(100 * pair.quick_ratio()) >= low else 0

    return pd.Series([ratio(x, y, low) for x, y, low in zip(a, b, least, strict=True)])


def bigrams(name: Column) -> Column:
    """The bigrams of a name between marks of its ends, each numbered among its likes: as many as characters and one."""
    plain = F.regexp_extract_all(F.concat(F.lit("\x01"), name, F.lit("\x02")), F.lit("(?s)(?=(..))"), F.lit(1))
    return F.transform(plain, lambda g, i: F.concat(g, F.size(F.filter(F.slice(plain, 1, i + 1), lambda x: x == g)).cast("string")))


def shared_least(total: Column, least: int) -> Column:
    """Bigrams that two names of ``total`` characters share at least, if their similarity is ``least`` percent.

    With M matching characters, the first name loses ``2 (a - M)`` of its
    ``a + 1`` bigrams at most by deletions and ``b - M`` by insertions, so
    ``1 - (a + b) + 3 M`` stay; rounding up to ``least`` starts half a percent lower.
    """
    return F.ceil(1 + total * (1.5 * (least - 0.5) / 100 - 1) - 1e-9)


def _indexed(names: DataFrame, often: DataFrame, least: int) -> DataFrame:
    """``name, grams, prefix``: bigrams from the rarest on, and those of them that any likely partner must share one of."""
    share = (least - 0.5) / 100
    rows = names.select("name", F.explode(bigrams(F.col("name"))).alias("gram")).join(often, "gram", "left")
    rows = rows.groupBy("name").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("g"))
    grams, size = F.transform("g", lambda x: x["gram"]), F.length("name")
    shortest = size + F.ceil(size * (share / (2 - share)) - 1e-9)
    return rows.select("name", grams.alias("grams")).withColumn("prefix", F.slice("grams", 1, F.greatest(F.lit(1), F.size("grams") - shared_least(shortest, least).cast("int") + 1)))


def like_pairs(left: DataFrame, right: DataFrame, least: int = 86) -> DataFrame:
    """``a, b, ratio``: pairs of a ``name`` of either side whose similarity rounds to ``least`` percent or more.

    Two such names share a number of bigrams that follows from ``least`` and
    their lengths. Bigrams are ordered from the rarest on (by ``right``), and
    each name is filed under so many of its first ones that no such pair is
    missed; so frequent bigrams are seldom keys. Pairs that meet under several
    are taken at the first; only those that share enough bigrams are scored.
    The names of both sides are made distinct; null and empty names are like none.
    """
    if least < 68:
        raise ValueError("names less than 68 % alike need not share a bigram")
    sides = [d.select("name").where("name <> ''").distinct() for d in (left, right)]
    often = sides[1].select(F.explode(bigrams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    a, b = (_indexed(d, often, least).withColumn("key", F.explode("prefix")) for d in sides)
    a, b = (d.select("key", F.col("name").alias(n), F.col("grams").alias(f"grams_{n}"), F.col("prefix").alias(f"prefix_{n}")) for d, n in ((a, "a"), (b, "b")))
    total = F.length("a") + F.length("b")
    met = a.join(b, "key").where((F.abs(F.length("a") - F.length("b")) <= total * (1 - (least - 0.5) / 100) + 1e-9) & (F.array_intersect("prefix_a", "prefix_b")[0] == F.col("key")))
    met = met.where(F.size(F.array_intersect("grams_a", "grams_b")) >= shared_least(total, least))
    return met.select("a", "b", indel_ratio("a", "b", F.lit(least)).alias("ratio")).where(F.col("ratio") >= least)
