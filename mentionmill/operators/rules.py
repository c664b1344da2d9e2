"""Row rules of the corpus and the funnel that accounts for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionmill import fixed_values as V
from mentionmill.functions.text import quoted
from mentionmill.runtime import cut

DATE = r"^\d{4}-\d{2}-\d{2}$"
WORD_COUNT = r"\b[a-zA-Z]{2,}\b"


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def bad_prefix(c: Column) -> Column:
    return c.rlike(f"(?i)^(?:{quoted(V.TITLE_PREFIXES)})")


def bad_phrase(c: Column) -> Column:
    return c.rlike(rf"(?i)\b(?:{quoted(V.TITLE_PHRASES)})\b")


def placeholder(c: Column) -> Column:
    return c.rlike(rf"(?i)\b(?:{quoted(V.PLACEHOLDER_TITLES)})\b")


def withdrawn(c: Column) -> Column:
    return c.rlike(rf"(?i)^\[?(?:{quoted(V.WITHDRAWN_HEADS)})\b")


def blocked_abstract(c: Column) -> Column:
    """Whether an abstract begins with a notice that stands for one."""
    out = F.lit(False)
    for head in V.BLOCKED_ABSTRACTS:
        out = out | c.startswith(head)
    return out


def not_research(c: Column) -> Column:
    return c.rlike(f"(?i)(?:{quoted(V.NON_RESEARCH)})")


def real_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD_COUNT))


def rules() -> list[tuple[str, Column]]:
    """Reasons to reject a row, in the order in which they apply."""
    title, abstract = F.col("title"), F.col("abstract")
    return [
        ("blank", blank(title) | blank(abstract) | blank(F.col("authors"))),
        ("date", ~F.col("pub_date").rlike(DATE)),
        ("prefix", bad_prefix(title)),
        ("phrase", bad_phrase(title)),
        ("underscore", title.contains("_")),
        ("supplement", title.rlike("(?i)supple")),
        ("no letters", title.rlike("^[^A-Za-z]+$")),
        ("placeholder", placeholder(title)),
        ("title length", ~real_words(title).between(3, 60)),
        ("abstract length", ~real_words(abstract).between(80, 1000)),
        ("withdrawn", withdrawn(title)),
        ("not research", not_research(title)),
    ]


def reject_reason(named: list[tuple[str, Column]] | None = None) -> Column:
    """The first rule that a row fails, null if none: one pass for all rules."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in named or rules()])


def first_of(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


def funnel(df: DataFrame, id_col: str = "paper_id", order: str = "ingest_ord") -> DataFrame:
    """``reason, n``: rows that each rule removes, then repeats by id and by title and authors, and what is kept."""
    told = cut(df.select(id_col, order, F.lower("title").alias("_title"), F.lower("authors").alias("_authors"), reject_reason().alias("reason")))  # the rules are run once
    good = told.where(F.col("reason").isNull())
    by_id = good.withColumn("_n", F.row_number().over(Window.partitionBy(id_col).orderBy(order)))
    once = by_id.where("_n = 1").withColumn("_m", F.row_number().over(Window.partitionBy("_title", "_authors").orderBy(order)))
    parts = [
        told.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n")),
        by_id.where("_n > 1").groupBy(F.lit("repeated id").alias("reason")).agg(F.count("*").alias("n")),
        once.groupBy(F.when(F.col("_m") > 1, F.lit("repeated title")).otherwise(F.lit("kept")).alias("reason")).agg(F.count("*").alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
