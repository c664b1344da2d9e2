"""Study-weighted co-occurrence and views of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mentionmill.operators.pairs import spread_pairs
from mentionmill.runtime import Scratch


def with_weight(studies: DataFrame, weights: dict[str, float], default: float = 0.0) -> DataFrame:
    """``weight`` by study design; a design without one gets the default."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return studies.withColumn("weight", F.coalesce(table[F.col("design")], F.lit(default)))


def cooccurrence(mentions: DataFrame, studies: DataFrame, left: str, right: str) -> DataFrame:
    """``a, b, papers, raw, pct``: papers that name both, the sum of squared weights, and it as a share of a's weight.

    Papers whose design weighs nothing add nothing to ``raw``. One join on the
    paper (papers of many names spread over tasks), then sums by pair with map-side combine.
    """
    weighed = mentions.join(studies.where("weight > 0").select("paper_id", "weight"), "paper_id")
    a = weighed.where(F.col("category") == left).select("paper_id", F.col("entity").alias("a"), "weight")
    a = Scratch(a.sparkSession, "cells").write("a", a)  # read for the pairs and for the base
    b = mentions.where(F.col("category") == right).select("paper_id", F.col("entity").alias("b"))
    raw = spread_pairs(a, b, "paper_id", "a", "b").groupBy("a", "b").agg(F.count("*").alias("papers"), F.sum(F.col("weight") * F.col("weight")).alias("raw"))
    base = a.groupBy("a").agg(F.sum("weight").alias("base"))
    return raw.join(base, "a").select("a", "b", "papers", "raw", (100 * F.try_divide("raw", "base")).alias("pct"))


def top_cells(cells: DataFrame, k: int, by: str = "raw") -> DataFrame:
    return cells.orderBy(F.desc(by), "a", "b").limit(k)


def extremes(cells: DataFrame, k: int, by: str = "score") -> DataFrame:
    """The strongest positive and the strongest negative cells."""
    up = cells.where(F.col(by) > 0).orderBy(F.desc(by), "a", "b").limit(k)
    return up.unionByName(cells.where(F.col(by) < 0).orderBy(by, "a", "b").limit(k))


def submatrix(cells: DataFrame, rows: int, columns: int, least: float = 1.0, by: str = "raw") -> DataFrame:
    """Cells above ``least`` of the heaviest rows and columns."""
    cells = cells.where(F.col(by) > least)
    a = cells.groupBy("a").agg(F.sum(by).alias("s")).orderBy(F.desc(F.round("s", 6)), "a").limit(rows)
    b = cells.groupBy("b").agg(F.sum(by).alias("s")).orderBy(F.desc(F.round("s", 6)), "b").limit(columns)
    return cells.join(a.select("a"), "a", "left_semi").join(b.select("b"), "b", "left_semi")


def best_of_each(cells: DataFrame, key: str, k: int, by: str = "score") -> DataFrame:
    """The ``k`` cells of each key with the largest absolute value, missing ones last."""
    other = "b" if key == "a" else "a"
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(F.abs(by)), other)
    return cells.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def signed(cells: DataFrame, consensus: DataFrame) -> DataFrame:
    """``score``: the share, negative for resistance, null without a consensus (``a + b``, lower case)."""
    agreed = consensus.select(F.lower("pair").alias("_pair"), "resolved")
    out = cells.withColumn("_pair", F.concat_ws(" + ", F.lower("a"), F.lower("b"))).join(agreed, "_pair", "left").drop("_pair")
    score = F.when(F.col("resolved").isNull() | (F.col("resolved") == "No consensus"), F.lit(None)).when(F.col("resolved") == "Resistant", -F.abs("pct")).otherwise(F.col("pct"))
    return out.withColumn("score", score)
