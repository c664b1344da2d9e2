"""The engine's tables as views of the test tables, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionmill.functions.text import ascii_only

#: Heads that some titles get, so that every title rule has rows.
HEADS = [
    "", "", "", "Figure 1 of ", "Corrigendum to ", "Comment on ", "[Withdrawn] ", "No Title ", "A Supplementary Table for ", "Vitamin supplementation in ",
    "12: ", "#123 ", "Keynote: ", "------Abstract: ", "[", "BREAST CANCER ", "a_b ", "Lung carcinomas (HER2+) and ", "p53 mutation in MET amplification ", "12 34 ",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def article(spark: SparkSession, sf_dir: str, plain: bool = True) -> DataFrame:
    """``paper_id, title, abstract, authors, language, pub_date (text), ingest_ord``; ``plain`` texts are ASCII only."""
    heads = F.array(*[F.lit(h) for h in HEADS])
    text = F.coalesce("text", F.lit(""))
    text = ascii_only(text) if plain else text
    k = F.col("doc_id")
    date = F.date_format(F.date_add(F.lit("2014-01-01").cast("date"), F.pmod(k * 37, F.lit(4000)).cast("int")), "yyyy-MM-dd")
    return table(spark, sf_dir, "documents").select(
        k.alias("paper_id"), F.concat(F.element_at(heads, (F.pmod(k, F.lit(len(HEADS))) + 1).cast("int")), F.split_part(text, F.lit("."), F.lit(1))).alias("title"),
        text.alias("abstract"), F.col("source").alias("authors"), F.col("lang").alias("language"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit("2020-1-1")).otherwise(date).alias("pub_date"), k.alias("ingest_ord"),
    )


_HEADS_SQL = "[" + ", ".join("'" + h.replace("'", "''") + "'" for h in HEADS) + "]"
ARTICLE = rf"""article AS (
  SELECT doc_id AS paper_id, {_HEADS_SQL}[doc_id % {len(HEADS)} + 1] || split_part(t, '.', 1) AS title, t AS abstract,
    source AS authors, lang AS language,
    CASE WHEN doc_id % 11 = 0 THEN '2020-1-1' ELSE strftime(DATE '2014-01-01' + ((doc_id * 37) % 4000)::INT, '%Y-%m-%d') END AS pub_date, doc_id AS ingest_ord
  FROM (SELECT *, regexp_replace(coalesce(text, ''), '[^\x00-\x7F]+', '', 'g') AS t FROM documents)
)"""


#: The same with letters as they are.
WHOLE_ARTICLE = ARTICLE.replace(r"regexp_replace(coalesce(text, ''), '[^\x00-\x7F]+', '', 'g')", "coalesce(text, '')")


def mention(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    """``paper_id, category, entity``: one row for each pair; orders stand for papers.

    Lines are dealt by paper before their four names are told apart, so that
    neither rows four times as many are shuffled nor what goes on by paper
    shuffles again. Not ``distinct``: rows as they come, for what does not count them.
    """
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    line = line.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    kinds = [("Treatment", "p_brand"), ("Cancer", "p_type"), ("Variant", "p_name"), ("Gene", "n_name")]
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.col(c).alias("entity")) for k, c in kinds])).alias("m")
    line = line.select(F.col("l_orderkey").alias("paper_id"), *[c for _, c in kinds])
    if not distinct:
        return line.select("paper_id", pairs).select("paper_id", "m.*")
    return line.repartition("paper_id").select("paper_id", pairs).select("paper_id", "m.*").distinct()


MENTION = """line AS (
  SELECT l_orderkey, p_brand, p_type, p_name, n_name FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), mention AS (
  SELECT DISTINCT l_orderkey AS paper_id, 'Treatment' AS category, p_brand AS entity FROM line
  UNION SELECT l_orderkey, 'Cancer', p_type FROM line UNION SELECT l_orderkey, 'Variant', p_name FROM line UNION SELECT l_orderkey, 'Gene', n_name FROM line
)"""

#: Study designs by order priority; one of the five is left without.
DESIGNS = {"1-URGENT": "Clinical study", "2-HIGH": "Case report study", "3-MEDIUM": "In vitro study", "5-LOW": "Undefined"}


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``paper_id, design, pub_date``."""
    designs = F.create_map(*[F.lit(x) for pair in DESIGNS.items() for x in pair])
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("paper_id"), F.coalesce(designs[F.col("o_orderpriority")], F.lit("Unmapped")).alias("design"), F.to_date("o_orderdate").alias("pub_date"))


STUDY = (
    "study AS (SELECT o_orderkey AS paper_id, CASE o_orderpriority "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DESIGNS.items())
    + " ELSE 'Unmapped' END AS design, o_orderdate::DATE AS pub_date FROM orders)"
)


def weights_sql(weights: dict[str, float], default: float) -> str:
    return "CASE design " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in weights.items()) + f" ELSE {default}::DOUBLE END"


#: Labels of pairs (user and day stand for variant and treatment), by event type.
LABELS = {"purchase": "Sensitive", "error": "Resistant", "signup": "Diagnostic", "view": "Unknown", "click": "Unrelated"}


def label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``paper_id, variant, treatment, pair, label, ord``."""
    names = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    e = table(spark, sf_dir, "events")
    variant, treatment = F.concat(F.lit("v"), F.col("user_id")), F.concat(F.lit("T-"), F.pmod(F.col("event_id"), F.lit(23)))
    return e.select(F.col("event_id").alias("paper_id"), variant.alias("variant"), treatment.alias("treatment"), F.concat_ws(" + ", variant, F.lower(treatment)).alias("pair"), names[F.col("event_type")].alias("label"), F.col("event_id").alias("ord"))


LABEL = (
    "label AS (SELECT event_id AS paper_id, 'v' || user_id AS variant, 'T-' || (event_id % 23) AS treatment, 'v' || user_id || ' + ' || lower('T-' || (event_id % 23)) AS pair, CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())
    + " END AS label, event_id AS ord FROM events)"
)


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "
