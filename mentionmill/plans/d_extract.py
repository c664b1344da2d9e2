"""Extraction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill.operators import automaton as T
from mentionmill.operators import dictionary as D
from mentionmill.operators import embedding as E
from mentionmill.operators import extract as X
from mentionmill.operators import neighbours as N
from mentionmill.plans.registry import query
from mentionmill.plans.views import ARTICLE, MENTION, article, mention, table, with_

TERMS = ["MET", "BRAF", "HER2", "the of", "and the", "Lung carcinomas", "p53 mutation", "breast cancer", "on the", "Figure"]
TERM = "term AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in TERMS) + "]) AS term)"
TEXT = "txt AS (SELECT paper_id, title || ' ' || abstract AS text FROM article)"


def texts(spark, d):
    return article(spark, d).select("paper_id", F.concat_ws(" ", "title", "abstract").alias("text"))


def terms(spark):
    return spark.createDataFrame([(t,) for t in TERMS], "term string")


@query("D01_dictionary_match", with_(ARTICLE, TEXT, TERM) + r"SELECT paper_id, term FROM txt, term WHERE regexp_matches(text, '\b' || term || '\b')")
def d01(spark, d):
    return D.match_terms(texts(spark, d), terms(spark), "paper_id")


@query("D02_dictionary_upper", with_(ARTICLE, TEXT, TERM) + r"SELECT DISTINCT paper_id, upper(term) AS term FROM txt, term WHERE regexp_matches(upper(text), '\b' || upper(term) || '\b')")
def d02(spark, d):
    return D.match_terms(texts(spark, d), terms(spark), "paper_id", ignore_case=True).select("paper_id", F.upper("term").alias("term")).distinct()


@query("D01_table_function", with_(ARTICLE, TEXT, TERM) + r"SELECT paper_id, term FROM txt, term WHERE regexp_matches(text, '\b' || term || '\b')")
def d01_table(spark, d):
    """The matcher as a table function of SQL."""
    spark.udtf.register("terms_in", T.table_function(T.listed(terms(spark), False, True)))
    texts(spark, d).createOrReplaceTempView("d01_texts")
    return spark.sql("SELECT paper_id, term FROM d01_texts, LATERAL terms_in(text)")


@query("D04_table_function", with_(ARTICLE, TEXT, TERM) + "SELECT paper_id, term FROM txt, term WHERE contains(text, term)")
def d04_table(spark, d):
    return T.find_terms(texts(spark, d), terms(spark), "paper_id", whole_words=False)


ALIASES = [("lung carcinomas", "lung cancer"), ("breast cancer", "breast cancer"), ("her2", "ERBB2"), ("p53 mutation", "TP53"), ("met amplification", "MET"), ("met", "MET")]
ALIAS = "alias AS (SELECT unnest([" + ", ".join(f"{{'alias': '{a}', 'canonical': '{c}'}}" for a, c in ALIASES) + "], recursive := true))"


@query("D03_alias_match", with_(ARTICLE, TEXT, ALIAS) + r"SELECT paper_id, canonical, array_to_string(list_sort(list(DISTINCT alias)), '|') AS surfaces FROM txt, alias WHERE regexp_matches(lower(text), '\b' || alias || '\b') GROUP BY paper_id, canonical")
def d03(spark, d):
    return D.match_aliases(texts(spark, d), spark.createDataFrame(ALIASES, "alias string, canonical string"), "paper_id").withColumn("surfaces", F.array_join("surfaces", "|"))


@query("D04_substring_match", with_(ARTICLE, TEXT, TERM) + "SELECT paper_id, term FROM txt, term WHERE contains(text, term)")
def d04(spark, d):
    return D.match_substrings(texts(spark, d), terms(spark), "paper_id")


TAGS = "tag AS (SELECT event_id // 8 AS key, event_id % 8 AS pos, CASE WHEN event_type IN ('view', 'error') THEN '##' ELSE '' END || event_type AS piece, CASE event_type WHEN 'click' THEN 'B-X' WHEN 'view' THEN 'I-X' WHEN 'error' THEN 'I-X' ELSE 'O' END AS tag FROM events)"


def tags(spark, d):
    kind = F.col("event_type")
    piece = F.concat(F.when(kind.isin("view", "error"), F.lit("##")).otherwise(F.lit("")), kind)
    tag = F.when(kind == "click", F.lit("B-X")).when(kind.isin("view", "error"), F.lit("I-X")).otherwise(F.lit("O"))
    return table(spark, d, "events").select(F.expr("event_id div 8").alias("key"), F.pmod("event_id", F.lit(8)).alias("pos"), piece.alias("piece"), tag.alias("tag"))


@query(
    "D05_merged_pieces",
    with_(TAGS) + "SELECT key, span, string_agg(regexp_replace(piece, '^##', ''), '' ORDER BY pos) AS entity FROM (SELECT *, (sum(CASE WHEN starts_with(tag, 'B-') THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY pos))::BIGINT AS span FROM tag WHERE tag <> 'O') WHERE span > 0 GROUP BY key, span",
)
def d05(spark, d):
    return X.merge_pieces(tags(spark, d), "key")


@query("D06_label_filter", "SELECT event_id, event_type AS entity FROM events WHERE event_type IN ('click', 'view', 'error') AND lower(event_type) <> 'view'")
def d06(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("entity"), F.col("event_type").alias("label"))
    return X.keep_labels(rows, ["click", "view", "error"], ["VIEW"]).select("event_id", "entity")


@query("D06_union_of_taggers", "SELECT user_id, event_type AS entity FROM events WHERE event_type IN ('click', 'view') UNION SELECT user_id, event_type FROM events WHERE event_type IN ('error', 'purchase') AND event_id % 3 = 0")
def d06_union(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", F.col("event_type").alias("entity"), F.col("event_type").alias("label"))
    return X.union_labels("user_id", X.keep_labels(rows, ["click", "view"], []), X.keep_labels(rows.where("event_id % 3 = 0"), ["error", "purchase"], []))


@query(
    "D07_windows",
    with_(ARTICLE) + r""", w AS (SELECT paper_id, len(regexp_extract_all(abstract, '\w+')) AS n FROM article)
    SELECT paper_id, CASE WHEN n <= 64 THEN 1 ELSE ceil((n - 64) / 32.0)::INT + 1 END AS fixed, CASE WHEN n <= 64 THEN 1 ELSE (n - 64) // 32 + 1 END AS stopped FROM w""",
)
def d07(spark, d):
    rows = article(spark, d).select("paper_id", F.regexp_extract_all("abstract", F.lit(r"(\w+)"), F.lit(1)).alias("t"))
    return rows.select("paper_id", F.size(X.windows(F.col("t"), 64, 32)).alias("fixed"), F.size(X.windows(F.col("t"), 64, 32, drop_tail=True)).alias("stopped"))


@query("D08_normalised_names")
def d08(spark, d):
    """Names with a letter doubled or a word before them, mapped back to the dictionary."""
    parts = table(spark, d, "part")
    k = F.col("p_partkey") % 3
    entity = F.when(k == 0, F.col("p_type")).when(k == 1, F.concat(F.lit("x-"), "p_type")).otherwise(F.concat("p_type", F.lit("S")))
    return X.normalise_names(parts.select(F.col("p_partkey").alias("id"), entity.alias("entity")), parts.select(F.col("p_type").alias("name")), "id")


@query("D09_variant_patterns", with_(ARTICLE) + r", s AS (SELECT paper_id, title || ' ' || abstract || ' rs' || paper_id || ' V600E' AS t FROM article) SELECT paper_id, list_sort(list_distinct(list_concat(regexp_extract_all(t, 'rs\d+'), regexp_extract_all(t, '\b[A-Z]\d+[A-Z]\b')))) AS found FROM s")
def d09(spark, d):
    t = F.concat("title", F.lit(" "), "abstract", F.lit(" rs"), "paper_id", F.lit(" V600E"))
    found = F.array_distinct(F.concat(F.regexp_extract_all(t, F.lit(r"(rs\d+)"), F.lit(1)), F.regexp_extract_all(t, F.lit(r"\b([A-Z]\d+[A-Z])\b"), F.lit(1))))
    return article(spark, d).select("paper_id", F.array_sort(found).alias("found"))


RESPONSE = r"resp AS (SELECT l_orderkey AS paper_id, string_agg('Variant: ' || l_partkey || 'A' || CASE WHEN l_linenumber % 3 = 0 THEN '>G' ELSE '' END || ', Gene: G' || l_suppkey, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey) AS response FROM lineitem GROUP BY l_orderkey)"


def responses(spark, d):
    item = F.concat(F.lit("Variant: "), "l_partkey", F.lit("A"), F.when(F.col("l_linenumber") % 3 == 0, F.lit(">G")).otherwise(F.lit("")), F.lit(", Gene: G"), "l_suppkey")
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", item.alias("s")))).alias("items"))
    return rows.select("paper_id", F.array_join(F.transform("items", lambda x: x["s"]), "\n").alias("response"))


@query(
    "D10_response_pairs",
    with_(RESPONSE) + r", p AS (SELECT paper_id, regexp_replace(response, '\n', ' ', 'g') AS t FROM resp) SELECT paper_id, len(regexp_extract_all(t, 'Variant:\s*([\w\d.*-]+),\s*Gene:\s*([\w\d]+)', 1))::INT AS plain, len(regexp_extract_all(t, 'Variant:\s*([\w\d.*>-]+),\s*Gene:\s*([\w\d]+)', 1))::INT AS hgvs, array_to_string(regexp_extract_all(t, 'Variant:\s*([\w\d.*>-]+),\s*Gene:\s*([\w\d]+)', 1), ',') AS variants FROM p",
)
def d10(spark, d):
    hgvs = X.response_pairs(F.col("response"), hgvs=True)
    return responses(spark, d).select("paper_id", F.size(X.response_pairs(F.col("response"))).alias("plain"), F.size(hgvs).alias("hgvs"), F.array_join(F.transform(hgvs, lambda x: x["variant"]), ",").alias("variants"))


@query("D11_response_triples", "SELECT event_id, 0 AS line_no, 'v' || user_id AS variant, 'T ' || event_type AS treatment, 'Sensitive' AS label FROM events WHERE event_id % 2 = 0")
def d11(spark, d):
    said = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("v"), "user_id", F.lit(" + T "), "event_type", F.lit(" : Sensitive\nno pair here"))).otherwise(F.lit("none"))
    return X.response_triples(table(spark, d, "events").select("event_id", said.alias("said")), "said", "event_id")


@query("D12_response_labels", "SELECT event_id, 0 AS line_no, 'v' || user_id || ' + T' AS pair, event_type AS label FROM events")
def d12(spark, d):
    said = F.concat(F.lit("v"), "user_id", F.lit(" + T: "), "event_type", F.lit("\nnote: none"))
    return X.response_labels(table(spark, d, "events").select("event_id", said.alias("said")), "said", "event_id")


@query("D13_listed_names", "SELECT event_id, list_filter(string_split(replace(event_type || ', BRAF, x, MET', ',', ''), ' '), lambda w: w IN ('BRAF', 'MET', 'click')) AS names FROM events")
def d13(spark, d):
    words = F.split(F.replace(F.concat("event_type", F.lit(", BRAF, x, MET")), F.lit(","), F.lit("")), " ")
    return table(spark, d, "events").select("event_id", F.filter(words, lambda w: w.isin("BRAF", "MET", "click")).alias("names"))


@query("D14_prompts", with_(ARTICLE) + "SELECT paper_id, 0 AS prompt_no, 'List genes in: ' || title AS prompt FROM article UNION ALL SELECT paper_id, 1, 'Title: ' || title || '. Variants?' FROM article")
def d14(spark, d):
    return X.prompts(article(spark, d).select("paper_id", "title"), ["List genes in: %s", "Title: %s. Variants?"], "title").drop("title")


def _shout(prompts: list[str]) -> list[str]:
    if any("error" in p for p in prompts):
        raise ValueError("the model failed")
    return [p.upper() for p in prompts]


@query("D15_model_calls", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE upper(event_type) END AS response FROM events")
def d15(spark, d):
    from mentionmill.runtime import ship

    ship(spark)
    return X.call_model(table(spark, d, "events").select("event_id", F.col("event_type").alias("prompt")), _shout).drop("prompt")


@query("D16_closed_classes", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN upper(event_type) ELSE 'Undefined' END AS category FROM events")
def d16(spark, d):
    from mentionmill.runtime import ship

    ship(spark)
    return X.classify(table(spark, d, "events").select("event_id", F.col("event_type").alias("text")), _shout, ["CLICK", "VIEW"]).drop("text")


@query("D17_resume", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def d17(spark, d):
    done = table(spark, d, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return X.not_yet(table(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


@query("D18_candidate_pairs", "WITH line AS (SELECT l_orderkey AS paper_id, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey), v AS MATERIALIZED (SELECT DISTINCT paper_id, p_name AS a FROM line), t AS MATERIALIZED (SELECT DISTINCT paper_id, p_brand AS b FROM line) SELECT v.paper_id, a, b FROM v JOIN t ON v.paper_id = t.paper_id")
def d18(spark, d):
    return X.candidate_pairs(mention(spark, d))


@query("D19_entity_lists", with_(MENTION) + "SELECT paper_id, category, string_agg(entity, ', ' ORDER BY entity) AS entities FROM mention GROUP BY paper_id, category")
def d19(spark, d):
    return X.entity_lists(mention(spark, d))


@query(
    "D20_nearest_vectors",
    "SELECT query, vec_id, rank::INT AS rank FROM (SELECT q.vec_id AS query, v.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id) AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id) WHERE rank <= 5",
)
def d20(spark, d):
    vectors = table(spark, d, "embeddings")
    return X.nearest(vectors.where("vec_id % 50 = 0"), vectors, 5).drop("cosine")


@query("D20_text_vectors")
def d20_text(spark, d):
    """An embedding of every document."""
    return E.text_vectors(table(spark, d, "documents"), "doc_id")


@query(
    "D20_neighbour_graph",
    "SELECT vec_id, neighbour, rank::INT AS rank, round(c, 6) AS cosine FROM (SELECT q.vec_id, v.vec_id AS neighbour, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS c, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(c, 12) DESC, v.vec_id) AS rank FROM embeddings q, embeddings v WHERE v.vec_id <> q.vec_id) WHERE rank <= 15",
)
def d20_graph(spark, d):
    """The 15 nearest of every vector: exact, as its SQL is, while all vectors fit one cell; above that its recall is measured."""
    return N.neighbour_graph(table(spark, d, "embeddings")).withColumn("cosine", F.round("cosine", 6))
