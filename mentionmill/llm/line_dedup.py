"""Removal of boilerplate lines that spread over many sites."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from mentionmill.llm.common import apart, cut, order_id, trimmed


#: Parts that the documents of one line are dealt to.
SALTS = 16


def spread_lines(docs: DataFrame, min_sites: int = 10, band: float = 0.3, lg_k: int = 12, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Lines found on ``min_sites`` distinct sites or more: ``h1, h2, first`` (the smallest id that has the line).

    A HyperLogLog sketch of sites per line hash merges by aggregation, so a line
    that a third of all documents carry costs one sketch per map task. Lines
    whose estimate lies within ``band`` of the limit are counted exactly. The
    band is many times the sketch's standard error (1.6 % at ``lg_k`` 12), below
    it no line can reach the limit, above it none can miss it.
    """
    lines = _lines(docs, id_col, text_col, site_col)
    low, high = max(2, math.floor(min_sites * (1 - band))), math.ceil(min_sites * (1 + band))
    sketches = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sites"), F.min("ord").alias("first"))
    likely = sketches.select("h1", "h2", "first", F.hll_sketch_estimate("sites").alias("estimate")).where(F.col("estimate") >= low)
    likely = cut(likely)
    near = likely.where(F.col("estimate") < high).select("h1", "h2", "first")
    # One row a line and site, made map-side first: what is joined and counted then has few rows a line, however many documents carry it.
    seen = lines.groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
    counted = seen.join(near, ["h1", "h2"]).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    sure = likely.where(F.col("estimate") >= high).select("h1", "h2", "first")
    return sure.unionByName(counted.where(F.col("n") >= min_sites).select("h1", "h2", "first"))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row for each distinct line of a document, without blank ones."""
    line = F.explode(F.array_distinct(F.transform(F.split(F.col(text_col), "\n"), trimmed)))
    rows = docs.select(F.col(id_col).alias("id"), order_id(id_col).alias("ord"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"), line.alias("line"))
    return rows.where(F.col("line") != "").select("id", "ord", "site", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))


def dedup_lines(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", **sketch) -> DataFrame:
    """Remove lines found on ``min_sites`` sites or more from all documents but the first that has them.

    A line is compared without the white space at its ends; blank lines are
    neither compared nor removed. The first document (smallest id) keeps its
    line, so that no text is lost altogether. Returns the columns of ``docs``,
    the text without the removed lines, and ``n_lines`` and ``n_removed``.

    A null text stays null and has no lines; a null site is one site of its own;
    a null id is larger than any other; rows with one id, repeated ones too, share
    the removal of its lines; an empty table gives an empty result. Other columns
    go along, whatever their names; ``n_lines`` and ``n_removed`` are replaced. Only line hashes and ids are
    shuffled for the counts; texts are shuffled once, by id.
    """
    spread = spread_lines(docs, min_sites, id_col=id_col, text_col=text_col, site_col=site_col, **sketch)
    salted = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a line of a third of all documents meets its copies in many tasks
    lines = _lines(docs, id_col, text_col, site_col).select("id", "ord", "h1", "h2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    hits = lines.join(salted, ["h1", "h2", "salt"]).where(F.col("ord") > F.col("first"))
    hits = hits.groupBy(F.col("id").alias("__id")).agg(F.collect_set(F.struct("h1", "h2")).alias("__hit"))
    base, own = apart(docs, text_col, ("n_lines", "n_removed"))
    joined = base.join(hits, F.col("__own")[id_col].eqNullSafe(F.col("__id")), "left")
    split = F.split("__text", "\n")
    gone = lambda x: F.array_contains("__hit", F.struct(F.xxhash64(trimmed(x)).alias("h1"), F.hash(trimmed(x)).alias("h2")))
    full = lambda a: F.size(F.filter(a, lambda x: trimmed(x) != ""))
    dirty = F.col("__hit").isNotNull() & F.col("__text").isNotNull()
    out = joined.withColumns({"__n": F.when(F.col("__text").isNull(), F.lit(0)).otherwise(full(split)).cast("long"), "__kept": F.when(dirty, F.filter(split, lambda x: ~gone(x)))})
    removed = F.when(dirty, F.col("__n") - full(F.col("__kept"))).otherwise(F.lit(0)).cast("long")
    text = F.when(dirty, F.array_join("__kept", "\n")).otherwise(F.col("__text"))
    return out.select(*own(text), F.col("__n").alias("n_lines"), removed.alias("n_removed"))


SQL = r"""
WITH line AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), keyed AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM line
), spread AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 10
), judged AS (
  SELECT d.*, s.k IS NOT NULL AND d.doc_id > s.first AS gone FROM keyed d LEFT JOIN spread s ON d.k = s.k
), told AS (
  SELECT doc_id, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(t.n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed, 0)::BIGINT AS n_removed, md5(t.kept) AS kept_md5
FROM documents d LEFT JOIN told t ON d.doc_id = t.doc_id
"""
