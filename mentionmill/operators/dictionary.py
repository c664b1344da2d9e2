"""Dictionary matching by the first word, or the first characters, of a term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Terms up to this many are looked up inside the texts' rows; more are joined.
FEW = 5_000


def _found(texts: DataFrame, key: str, units: Column, terms: DataFrame, holds: Column) -> DataFrame:
    """``key, term``: terms (``unit, term, form``) whose unit is among a text's ``units`` and for which ``holds``.

    A short list (its size is checked) is looked up in each text's row, so that
    texts are neither exploded nor moved. A long one is joined with the texts'
    units, without the texts; only the pairs found meet the texts again, by key.
    """
    listed = terms.limit(FEW + 1).collect()
    if len(listed) <= FEW:
        heads = sorted({r["unit"] for r in listed})
        near = texts.withColumn("unit", F.explode(F.filter(units, lambda u: u.isin(heads))))
        return near.join(F.broadcast(terms), "unit").where(holds).select(key, "term").distinct()
    pairs = texts.select(key, F.explode(units).alias("unit")).hint("merge").join(terms, "unit").select(key, "term", "form", "unit").distinct()
    return pairs.join(texts.hint("merge"), key).where(holds).select(key, "term").distinct()


def match_terms(texts: DataFrame, terms: DataFrame, key: str, ignore_case: bool = False) -> DataFrame:
    """``key, term``: terms (column ``term``) found in ``text`` between word boundaries.

    A matching term's first word is a whole word of the text, so candidates are
    the terms whose first words a text has, and they are verified; texts and
    terms are never compared all with all. ``ignore_case`` lowers both sides.
    Terms without a word character are not matched.
    """
    low = F.lower if ignore_case else lambda c: F.col(c) if isinstance(c, str) else c
    texts = texts.select(key, low("text").alias("text"))
    heads = terms.select("term", low("term").alias("form")).withColumn("unit", F.regexp_extract("form", r"\w+", 0)).where("unit <> ''").distinct()
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\w+)"), F.lit(1)))
    whole = (F.col("form") == F.col("unit")) | F.rlike("text", F.concat(F.lit(r"\b\Q"), F.col("form"), F.lit(r"\E\b")))
    return _found(texts, key, words, heads, whole)


def match_aliases(texts: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """``key, canonical, surfaces``: names found by any alias (``alias, canonical``), with the forms that matched."""
    found = match_terms(texts, aliases.select(F.col("alias").alias("term")), key, ignore_case=True)
    return found.join(aliases, found["term"] == aliases["alias"]).groupBy(key, "canonical").agg(F.array_sort(F.collect_set("alias")).alias("surfaces"))


def match_substrings(texts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """``key, term``: terms of three characters or more found anywhere in ``text``, by their first three characters."""
    grams = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?s)(?=(...))"), F.lit(1)))  # overlapping, in one pass
    heads = terms.where(F.length("term") >= 3).select("term", F.col("term").alias("form"), F.substring("term", 1, 3).alias("unit")).distinct()
    return _found(texts.where(F.length("text") >= 3).select(key, "text"), key, grams, heads, F.col("text").contains(F.col("form")))
