"""Incidence as rows: vocabularies, totals, roll-ups and wide exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def one_hot(mentions: DataFrame, papers: DataFrame, vocabulary: list[str], total: str = "total") -> DataFrame:
    """A 0/1 column for each name of a given vocabulary, and their sum; papers without any get zeros."""
    wide = mentions.where(F.col("entity").isin(vocabulary)).groupBy("paper_id").pivot("entity", vocabulary).agg(F.max(F.lit(1)))
    wide = papers.select("paper_id").distinct().join(wide, "paper_id", "left").na.fill(0)
    return wide.withColumn(total, sum((F.col(f"`{v}`") for v in vocabulary), F.lit(0)))


def vocabulary(mentions: DataFrame, most: int = 10_000) -> list[str]:
    """The names of a category for an export; an error beyond ``most`` columns."""
    names = [r[0] for r in mentions.select("entity").distinct().orderBy("entity").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} names are too many columns: export rows instead")
    return names


def totals(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity").agg(F.count("*").alias("n"))


def relabel(mentions: DataFrame, names: DataFrame) -> DataFrame:
    """Entities renamed by ``names(entity, name)``; those that become alike are one."""
    return mentions.join(names, "entity", "left").select("paper_id", "category", F.coalesce("name", "entity").alias("entity")).distinct()


def roll_up(mentions: DataFrame, parents: DataFrame) -> DataFrame:
    """``paper_id, parent``: a paper has a parent if it has any of its children."""
    return mentions.join(parents, "entity").select("paper_id", "parent").distinct()


def unused(entities: DataFrame, mentions: DataFrame) -> DataFrame:
    return entities.join(mentions.select("entity").distinct(), "entity", "left_anti")
