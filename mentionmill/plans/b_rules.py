"""Row rules, projections and the cleaning funnel."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill import fixed_values as V
from mentionmill.functions import text as T
from mentionmill.operators import language as L
from mentionmill.operators import rules as R
from mentionmill.plans.registry import query
from mentionmill.plans.views import ARTICLE, MENTION, WHOLE_ARTICLE, article, mention, table, with_


def sql(s: str) -> str:
    return s.replace("'", "''")


A = with_(ARTICLE)
PREFIX, PHRASE = f"(?i)^(?:{sql(T.quoted(V.TITLE_PREFIXES))})", rf"(?i)\b(?:{sql(T.quoted(V.TITLE_PHRASES))})\b"
HOLDER, GONE = rf"(?i)\b(?:{sql(T.quoted(V.PLACEHOLDER_TITLES))})\b", rf"(?i)^\[?(?:{sql(T.quoted(V.WITHDRAWN_HEADS))})\b"
OPINION, COUNT = f"(?i)(?:{sql(T.quoted(V.NON_RESEARCH))})", r"len(regexp_extract_all({}, '\b[a-zA-Z]{{2,}}\b'))"
TITLE_N, ABSTRACT_N = COUNT.format("title"), COUNT.format("abstract")

LEXICON = ["the", "of", "and", "is", "that", "are", "to", "with", "for", "on"]


@query("B01_blank_fields", A + "SELECT count_if(title IS NULL) AS null_titles, count_if(trim(title) = '') AS blank_titles, count_if(abstract IS NOT NULL AND trim(abstract) <> '') AS good_abstracts FROM article")
def b01(spark, d):
    t = F.col("title")
    return article(spark, d).agg(F.count_if(t.isNull()).alias("null_titles"), F.count_if(F.trim(t) == "").alias("blank_titles"), F.count_if(~R.blank(F.col("abstract"))).alias("good_abstracts"))


@query("B02_date_shape", A + r"SELECT paper_id, pub_date FROM article WHERE regexp_matches(pub_date, '^\d{4}-\d{2}-\d{2}$')")
def b02(spark, d):
    return article(spark, d).where(F.col("pub_date").rlike(R.DATE)).select("paper_id", "pub_date")


@query("B03_first_by_id", "SELECT l_orderkey AS paper_id, arg_min(l_partkey, l_linenumber * 1000000 + l_partkey) AS part FROM lineitem GROUP BY l_orderkey")
def b03(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper_id"), F.col("l_partkey").alias("part"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("ord"))
    return R.first_of(rows, [F.col("paper_id")], "ord").select("paper_id", "part")


@query("B04_first_by_title_authors", A + "SELECT min(paper_id) AS paper_id FROM article GROUP BY lower(title), lower(authors)")
def b04(spark, d):
    return R.first_of(article(spark, d), [F.lower("title"), F.lower("authors")], "ingest_ord").select("paper_id")


@query(
    "B05_lexicon_english",
    A + rf"""SELECT paper_id, CASE WHEN len(w) = 0 THEN 'EMPTY/NA' WHEN len(list_intersect(w, {LEXICON})) / len(w)::DOUBLE > 0.15 THEN 'en' ELSE 'other' END AS said
    FROM (SELECT paper_id, list_distinct(regexp_extract_all(lower(title), '\w+')) AS w FROM article)""",
)
def b05(spark, d):
    words = F.array_distinct(T.tokens(F.lower("title")))
    share = F.size(F.array_intersect(words, F.array(*[F.lit(x) for x in LEXICON]))) / F.size(words)
    return article(spark, d).select("paper_id", F.when(F.size(words) == 0, F.lit("EMPTY/NA")).when(share > 0.15, F.lit("en")).otherwise(F.lit("other")).alias("said"))


FIT = 5  # documents whose id is not divisible by it are what the profiles are fitted on
TRIGRAMS = "unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram"


def letters_sql(column: str) -> str:
    return rf"string_split(' ' || trim(regexp_replace(lower({column}), '[^\p{{L}}]+', ' ', 'g')) || ' ', '')"


def said_sql(column: str) -> str:
    """The likeliest language of a column of ``article``."""
    return f"""{column}_c AS (SELECT paper_id, {letters_sql(column)} AS c FROM article WHERE length(trim({column})) > 10),
    {column}_g AS (SELECT paper_id, gram, count(*) AS k FROM (SELECT paper_id, {TRIGRAMS} FROM {column}_c) GROUP BY ALL),
    {column}_s AS (SELECT paper_id, lang, sum(k * score) AS s FROM {column}_g JOIN profile USING (gram) GROUP BY ALL),
    {column}_l AS (SELECT paper_id, lang AS said FROM {column}_s QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY s DESC, lang) = 1)"""


PROFILES = f"""chars AS (SELECT doc_id, lang, {letters_sql("text")} AS c FROM documents WHERE text IS NOT NULL),
    counts AS (SELECT lang, gram, count(*) AS c FROM (SELECT doc_id, lang, {TRIGRAMS} FROM chars) WHERE doc_id % {FIT} <> 0 AND lang IS NOT NULL GROUP BY ALL),
    vocabulary AS (SELECT DISTINCT gram FROM (SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY c DESC, gram) AS n FROM counts) WHERE n <= 5000),
    total AS (SELECT lang, sum(c) AS total FROM counts GROUP BY lang),
    profile AS MATERIALIZED (SELECT v.gram, t.lang, round(1000 * ln((coalesce(c.c, 0) + 1) / (total + (SELECT count(*) FROM vocabulary))))::BIGINT AS score FROM vocabulary v CROSS JOIN total t LEFT JOIN counts c ON c.gram = v.gram AND c.lang = t.lang)"""
SAID = with_(PROFILES, WHOLE_ARTICLE, said_sql("title"), said_sql("abstract"))
SAID += ", said AS (SELECT a.paper_id, language, coalesce(t.said, 'unknown') AS said_title, coalesce(b.said, 'unknown') AS said_abstract FROM article a LEFT JOIN title_l t USING (paper_id) LEFT JOIN abstract_l b USING (paper_id)) "


def profiles(spark, d):
    """Fitted on four fifths of the documents."""
    return L.fit_profiles(table(spark, d, "documents").where(F.pmod("doc_id", F.lit(FIT)) != 0))


@query("B06_language", SAID + "SELECT * FROM said")
def b06(spark, d):
    """Language of title and of abstract, apart, with letters as they are."""
    rows = article(spark, d, plain=False)
    said = L.detect(rows, profiles(spark, d), "paper_id", "title", "abstract")
    return rows.select("paper_id", "language").join(said.select("paper_id", F.col("title").alias("said_title"), F.col("abstract").alias("said_abstract")), "paper_id")


@query("B06_rejected_rows", SAID + "SELECT paper_id, said_title, said_abstract FROM said WHERE said_title <> 'en' AND said_abstract <> 'en'")
def b06_rejected(spark, d):
    """The side output: articles of which neither title nor abstract is English."""
    return L.split_by_language(article(spark, d, plain=False), profiles(spark, d))[1].select("paper_id", "said_title", "said_abstract")


def removed(name: str, text: str, rule) -> None:
    @query(name, A + f"SELECT paper_id, title FROM article WHERE {text}")
    def run(spark, d):
        return article(spark, d).where(rule()).select("paper_id", "title")


removed("B07_title_prefix", f"regexp_matches(title, '{PREFIX}')", lambda: R.bad_prefix(F.col("title")))
removed("B08_title_phrase", f"regexp_matches(title, '{PHRASE}')", lambda: R.bad_phrase(F.col("title")))
removed("B09_title_underscore", "contains(title, '_')", lambda: F.col("title").contains("_"))
removed("B10_title_supplement", r"regexp_matches(title, '(?i)[\w\-_]*supple\w*')", lambda: F.col("title").rlike("(?i)supple"))
removed("B11_title_no_letters", "regexp_matches(title, '^[^A-Za-z]+$')", lambda: F.col("title").rlike("^[^A-Za-z]+$"))
removed("B12_title_placeholder", f"regexp_matches(title, '{HOLDER}')", lambda: R.placeholder(F.col("title")))
removed("B13_word_counts", f"NOT ({TITLE_N} BETWEEN 3 AND 60) OR NOT ({ABSTRACT_N} BETWEEN 80 AND 1000)", lambda: ~R.real_words(F.col("title")).between(3, 60) | ~R.real_words(F.col("abstract")).between(80, 1000))
removed("B14_withdrawn", f"regexp_matches(title, '{GONE}')", lambda: R.withdrawn(F.col("title")))
removed("B15_not_research", f"regexp_matches(title, '{OPINION}')", lambda: R.not_research(F.col("title")))


@query("B16_blocked_abstract", A + "SELECT paper_id FROM article WHERE paper_id % 5 > 1")
def b16(spark, d):
    """Abstracts of two papers in five begin with one of the notices."""
    k = F.pmod("paper_id", F.lit(5))
    abstract = F.when(k == 0, F.concat(F.lit("Our website uses cookies to enhance your experience. "), "abstract")).when(k == 1, F.concat(F.lit("(Cell Reports 12, 3) "), "abstract")).otherwise(F.col("abstract"))
    return article(spark, d).where(~R.blocked_abstract(abstract)).select("paper_id")


@query("B17_title_tokens", A + r"SELECT paper_id FROM article WHERE len(regexp_split_to_array(trim(title), '\s+')) >= 3")
def b17(spark, d):
    return article(spark, d).where(F.size(F.split(F.trim("title"), r"\s+")) >= 3).select("paper_id")


@query("B18_date_range", A + "SELECT paper_id, pub_date FROM article WHERE pub_date BETWEEN '2019-01-01' AND '2019-12-31'")
def b18(spark, d):
    return article(spark, d).where(F.col("pub_date").between("2019-01-01", "2019-12-31")).select("paper_id", "pub_date")


@query("B19_row_count_threshold", with_(MENTION) + "SELECT paper_id, count(*) AS n FROM mention WHERE category = 'Gene' GROUP BY paper_id HAVING count(*) > 4")
def b19(spark, d):
    return mention(spark, d).where("category = 'Gene'").groupBy("paper_id").agg(F.count("*").alias("n")).where("n > 4")


@query(
    "B20_funnel",
    A + rf""", told AS (SELECT *, CASE WHEN trim(coalesce(title, '')) = '' OR trim(coalesce(abstract, '')) = '' OR trim(coalesce(authors, '')) = '' THEN 'blank'
      WHEN NOT regexp_matches(pub_date, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN 'date' WHEN regexp_matches(title, '{PREFIX}') THEN 'prefix' WHEN regexp_matches(title, '{PHRASE}') THEN 'phrase'
      WHEN contains(title, '_') THEN 'underscore' WHEN regexp_matches(title, '(?i)supple') THEN 'supplement' WHEN regexp_matches(title, '^[^A-Za-z]+$') THEN 'no letters'
      WHEN regexp_matches(title, '{HOLDER}') THEN 'placeholder' WHEN NOT ({TITLE_N} BETWEEN 3 AND 60) THEN 'title length' WHEN NOT ({ABSTRACT_N} BETWEEN 80 AND 1000) THEN 'abstract length'
      WHEN regexp_matches(title, '{GONE}') THEN 'withdrawn' WHEN regexp_matches(title, '{OPINION}') THEN 'not research' END AS reason FROM article),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY ingest_ord) AS n FROM told WHERE reason IS NULL),
    once AS (SELECT *, row_number() OVER (PARTITION BY lower(title), lower(authors) ORDER BY ingest_ord) AS m FROM ranked WHERE n = 1)
    SELECT reason, count(*) AS n FROM told WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'repeated id', count(*) FROM ranked WHERE n > 1 HAVING count(*) > 0
    UNION ALL SELECT CASE WHEN m > 1 THEN 'repeated title' ELSE 'kept' END, count(*) FROM once GROUP BY 1""",
)
def b20(spark, d):
    return R.funnel(article(spark, d))


@query(
    "B21_all_conditions",
    with_(MENTION)
    + """SELECT count(*) AS n, round(100.0 * count(*) / (SELECT count(DISTINCT paper_id) FROM mention), 2) AS pct FROM
    (SELECT paper_id FROM mention GROUP BY paper_id HAVING count_if(category = 'Gene') >= 2 AND count_if(category = 'Cancer') >= 2 AND count_if(category = 'Treatment') >= 2 AND count_if(category = 'Variant') >= 2)""",
)
def b21(spark, d):
    per = mention(spark, d).groupBy("paper_id").agg(*[F.count_if(F.col("category") == c).alias(c) for c in ("Gene", "Cancer", "Treatment", "Variant")])
    met = (F.col("Gene") >= 2) & (F.col("Cancer") >= 2) & (F.col("Treatment") >= 2) & (F.col("Variant") >= 2)
    return per.agg(F.count_if(met).alias("n"), F.round(100.0 * F.count_if(met) / F.count("*"), 2).alias("pct"))


@query("B22_box_outliers", "SELECT vec_id, NOT (embedding[1] BETWEEN -0.1 AND 0.1 AND embedding[2] BETWEEN -0.1 AND 0.1) AS outlier FROM embeddings")
def b22(spark, d):
    inside = F.col("embedding")[0].between(-0.1, 0.1) & F.col("embedding")[1].between(-0.1, 0.1)
    return table(spark, d, "embeddings").select("vec_id", (~inside).alias("outlier"))


@query("B23_dictionary_filters", "SELECT p_partkey AS id, list_filter(string_split(p_name, ' '), lambda x: length(x) > 4) AS aliases FROM part WHERE lower(p_name) NOT IN ('small ring', 'red bolt') AND length(p_name) > 4")
def b23(spark, d):
    rows = table(spark, d, "part").where(~F.lower("p_name").isin("small ring", "red bolt") & (F.length("p_name") > 4))
    return rows.select(F.col("p_partkey").alias("id"), F.filter(F.split("p_name", " "), lambda x: F.length(x) > 4).alias("aliases"))


@query("B24_rename", "SELECT r_regionkey AS id, r_name AS name FROM region")
def b24(spark, d):
    return table(spark, d, "region").withColumnsRenamed({"r_regionkey": "id", "r_name": "name"})


@query("B25_drop_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def b25(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.drop(*[c for c in rows.columns if not c.endswith("key") and c != "l_linenumber"])


@query("B26_reorder", "SELECT s_suppkey, s_acctbal, s_name, s_nationkey FROM supplier")
def b26(spark, d):
    rows = table(spark, d, "supplier")
    return rows.select("s_suppkey", *sorted(c for c in rows.columns if c != "s_suppkey"))


@query("B27_derived_columns", A + "SELECT paper_id, title || ' ' || abstract AS text, 'article' AS kind, paper_id % 2 = 0 AS flag FROM article")
def b27(spark, d):
    return article(spark, d).select("paper_id", F.concat_ws(" ", "title", "abstract").alias("text"), F.lit("article").alias("kind"), (F.col("paper_id") % 2 == 0).alias("flag"))


@query("B28_search", "SELECT p_partkey AS id FROM part WHERE contains(lower(p_name), 'ring') OR lower(p_name) = 'red bolt' OR list_contains(string_split(lower(p_name), ' '), 'gizmo')")
def b28(spark, d):
    low = F.lower("p_name")
    return table(spark, d, "part").where(low.contains("ring") | (low == "red bolt") | F.exists(F.split(low, " "), lambda a: a == "gizmo")).select(F.col("p_partkey").alias("id"))
