"""Consensus of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionmill import fixed_values as V


def consensus(labels: DataFrame) -> DataFrame:
    """``pair, n, resolved, how`` from ``pair, label``.

    Hard: one label only. Soft: the most frequent label has 60 % of three or
    more and is valid. Otherwise: of weak labels only, the more frequent one
    (``Unknown`` on a tie); of valid and weak ones, the most frequent valid one;
    valid ones that differ have ``No consensus``. Ties go to the first by name.
    """
    counts = labels.groupBy("pair", "label").agg(F.count("*").alias("c"))
    valid, weak = F.col("label").isin(V.VALID_LABELS), F.col("label").isin(V.WEAK_LABELS)
    by = counts.groupBy("pair").agg(
        F.sum("c").alias("n"), F.count("*").alias("kinds"), F.min(F.struct(-F.col("c"), "label")).alias("top"),
        F.min(F.when(valid, F.struct(-F.col("c"), "label"))).alias("top_valid"), F.min(F.when(weak, F.struct(-F.col("c"), "label"))).alias("top_weak"),
        F.count_if(valid).alias("valid_kinds"), F.count_if(weak).alias("weak_kinds"),
        F.sum(F.when(F.col("label") == "Unknown", F.col("c")).otherwise(0)).alias("unknown"), F.sum(F.when(F.col("label") == "Unrelated", F.col("c")).otherwise(0)).alias("unrelated"),
    )
    top = F.col("top.label")
    hard = F.col("kinds") == 1
    soft = (F.negate(F.col("top.col1")) >= 0.6 * F.col("n")) & (F.col("n") >= 3) & top.isin(V.VALID_LABELS)
    only_weak = F.when(F.col("unrelated") > F.col("unknown"), F.lit("Unrelated")).otherwise(F.lit("Unknown"))
    fallback = F.when(F.col("valid_kinds") == 0, only_weak).when(F.col("weak_kinds") > 0, F.col("top_valid.label")).otherwise(F.lit("No consensus"))
    resolved = F.when(hard | soft, top).otherwise(fallback)
    return by.select("pair", "n", resolved.alias("resolved"), F.when(hard, F.lit("hard")).when(soft, F.lit("soft")).otherwise(F.lit("fallback")).alias("how"))


def pair_key(variant: Column, treatment: Column) -> Column:
    bare = F.replace(F.regexp_replace(F.lower(variant), r"[^\w\s]", ""), F.lit(" "), F.lit(""))
    return F.concat_ws(" + ", bare, F.lower(treatment))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Counts of values with their share in percent."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.bround(100.0 * F.col("n") / F.col("_t"), 2).alias("pct"))
