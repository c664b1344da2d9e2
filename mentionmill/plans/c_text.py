"""Text functions over titles and abstracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill import fixed_values as V
from mentionmill.functions import text as T
from mentionmill.operators import variants as X
from mentionmill.plans.registry import query
from mentionmill.plans.views import ARTICLE, article, table, with_
from mentionmill.runtime import ship

A = with_(ARTICLE)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def steps_sql(expr: str, steps: list[tuple[str, str]]) -> str:
    for pattern, new in steps:
        expr = f"regexp_replace({expr}, {q(pattern)}, {q(new.replace('$1', chr(92) + '1'))}, 'g')"
    return expr


def squeeze_sql(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '\s+', ' ', 'g'))"


CAPS = "regexp_matches({0}, '[A-Z]') AND NOT regexp_matches({0}, '[a-z]')"


def case_sql(column: str) -> str:
    return f"CASE WHEN {CAPS.format(column)} THEN upper(substr({column}, 1, 1)) || lower(substr({column}, 2)) ELSE {column} END"


def over_titles(name: str, sql: str, column, source: str = "title") -> None:
    @query(name, A + f"SELECT paper_id, {sql} AS out FROM article")
    def run(spark, d):
        return article(spark, d).select("paper_id", column().alias("out"))


C = F.col
mojibake = r"regexp_replace('‚Äì' || abstract || '√© <b>x</b>', '<[^>]+>', '', 'g')"
for bad, good in V.MOJIBAKE:
    mojibake = f"replace({mojibake}, {q(bad)}, {q(good)})"
over_titles("C01_clean_text", rf"regexp_replace({squeeze_sql(mojibake)}, '[^\x00-\x7F]+', '', 'g')", lambda: T.clean_text(T.unescape(F.concat(F.lit("&sbquo;&Auml;&igrave;"), C("abstract"), F.lit("&radic;&copy; <b>x</b>")))))
PLACE = [(r"(?i)\b(?:https?://|www\.)[^\s<>]+", "<URL>"), (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>"), (r"\+?\d?[ ]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}", "<PHONE>"), (r"[$£€¥]", "<CUR>")]
over_titles("C02_placeholders", steps_sql("abstract", PLACE), lambda: T.placeholders(C("abstract")))
over_titles(
    "C03_title_rules",
    rf"CASE WHEN regexp_matches(title, '^\d+$') OR length(title) <= 3 OR NOT regexp_matches(title, '[A-Za-z0-9]') THEN NULL WHEN {CAPS.format('title')} THEN array_to_string(list_transform(string_split(title, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') ELSE title END",
    lambda: T.title_rules(C("title")),
)


@query("C04_normal_title", A + f"SELECT paper_id, {case_sql('t')} AS out FROM (SELECT paper_id, {squeeze_sql(steps_sql('title', V.TITLE_STEPS))} AS t FROM article)")
def c04(spark, d):
    return article(spark, d).select("paper_id", T.normal_title(C("title")).alias("out"))


@query(
    "C05_normal_abstract",
    A + rf""", a AS (SELECT paper_id, CASE paper_id % 3 WHEN 0 THEN 'You have access, Introduction, ' || abstract WHEN 1 THEN '// x ABSTRACT: ' || abstract ELSE ': ' || abstract END AS t FROM article),
    b AS (SELECT paper_id, CASE WHEN starts_with(lower(t), 'you have access') AND regexp_matches(t, '(?i)\bintroduction\b') THEN regexp_extract(t, '(?is)\bintroduction\b.*') WHEN starts_with(t, '//') AND regexp_matches(t, '(?i)\babstracts?\b') THEN regexp_extract(t, '(?is)\babstracts?\b.*') ELSE t END AS t FROM a),
    c AS (SELECT paper_id, {squeeze_sql(steps_sql('t', V.ABSTRACT_STEPS))} AS t FROM b) SELECT paper_id, {case_sql('t')} AS out FROM c""",
)
def c05(spark, d):
    k = C("paper_id") % 3
    t = F.when(k == 0, F.concat(F.lit("You have access, Introduction, "), "abstract")).when(k == 1, F.concat(F.lit("// x ABSTRACT: "), "abstract")).otherwise(F.concat(F.lit(": "), "abstract"))
    return article(spark, d).select("paper_id", t.alias("t")).select("paper_id", T.normal_abstract(C("t")).alias("out"))


@query("C02_repaired", r"SELECT doc_id, trim(regexp_replace(replace(strip_accents(text), 'ß', 'ss'), '[\r\n]+', ' ', 'g')) AS out FROM documents")
def c02_repaired(spark, d):
    """Texts whose UTF-8 was read as Latin-1, repaired, transliterated and put on one line."""
    ship(spark)
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, d, "documents").select("doc_id", T.one_line(T.transliterate(T.repair(broken))).alias("out"))


over_titles("C06_numeric_heads", r"trim(regexp_replace(title, '^(?:\d{2,3}:|#\d{3,4}|<PHONE>:)\s*', '')) || regexp_replace('12 Background ' || title, '^\d+\s*(Background)', '\1')", lambda: F.concat(T.without_numbers(C("title")), T.without_numbers_before(F.concat(F.lit("12 Background "), C("title")))))
over_titles("C07_clean_term", squeeze_sql("regexp_replace(lower(trim(title)), '[-‐–—]', ' ', 'g')"), lambda: T.clean_term(T.nfkc(C("title"))))

term = r"regexp_replace(lower(trim(title)), '^[+.,\d()\-\s]+', '')"
for word in V.CANCER_QUALIFIERS:
    term = rf"regexp_replace({term}, {q(chr(92) + 'b' + word + chr(92) + 'b' + chr(92) + 's*')}, '', 'g')"
for many, one in V.CANCER_SINGULARS:
    term = f"replace({term}, '{many}', '{one}')"


def words_once(expr: str) -> str:
    """Distinct words in their first order."""
    return f"array_to_string(list_transform(list_filter(list_zip({expr}, range(1, len({expr}) + 1)), lambda z: z[1] <> '' AND list_position({expr}, z[1]) = z[2]), lambda z: z[1]), ' ')"


@query("C08_clean_cancer_term", A + rf", t AS (SELECT paper_id, regexp_split_to_array({term}, '\s+') AS w FROM article) SELECT paper_id, nullif({words_once('w')}, '') AS out FROM t")
def c08(spark, d):
    return article(spark, d).select("paper_id", T.clean_cancer_term(C("title")).alias("out"))


over_titles("C09_normal_cancer_name", squeeze_sql(steps_sql("lower(title)", T.CANCER_NAME_STEPS)), lambda: T.normal_cancer_name(C("title")))
over_titles("C10_standard_cancer", "replace(replace(replace(lower(title), 'adenocarcinoma', 'cancer'), 'tumor', 'cancer'), 'carcinoma', 'cancer')", lambda: T.standard_cancer(F.lower("title")))


@query(
    "C11_distinct_names",
    A + r""", n AS (SELECT paper_id, list_filter(list_transform(string_split(title || ', FAMILIAL, n/a, Lung-(x), lungx, ' || title, ','), lambda x: trim(regexp_replace(x, '[-()]', '', 'g'))), lambda x: x <> '' AND lower(x) NOT IN ('familial', 'n/a')) AS w FROM article)
    SELECT paper_id, list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: list_position(list_transform(w, lambda y: lower(y)), lower(z[1])) = z[2]), lambda z: z[1]) AS out FROM n""",
)
def c11(spark, d):
    names = F.concat("title", F.lit(", FAMILIAL, n/a, Lung-(x), lungx, "), "title")
    return article(spark, d).select("paper_id", T.distinct_names(names).alias("out"))


drug = steps_sql("lower(title)", [("-", " "), (r"\b(?:drug|treatment|therapy|chemotherapy|medication|cancer)\b", ""), (r"\s*\d+\s*$", "")])


@query("C12_normal_drug", A + rf", t AS (SELECT paper_id, regexp_split_to_array(trim({drug}), '\s+') AS w, regexp_split_to_array(trim(regexp_replace({drug}, '[^a-z\s]', '', 'g')), '\s+') AS v FROM article) SELECT paper_id, {words_once('w')} AS out, {words_once('v')} AS letters FROM t")
def c12(spark, d):
    return article(spark, d).select("paper_id", T.normal_drug(C("title")).alias("out"), T.normal_drug(C("title"), letters_only=True).alias("letters"))


over_titles("C13_clean_parent", squeeze_sql(steps_sql("lower('Malignant ' || title || ' adult leukaemia neoplasm')", [(r"\b(?:malignant|childhood|adult|juvenile|benign)\b", ""), ("neoplasm|carcinoma", "cancer"), ("leukaemia", "leukemia")])), lambda: T.clean_parent(F.concat(F.lit("Malignant "), "title", F.lit(" adult leukaemia neoplasm"))))

DISEASES = ["cutaneous melanoma", "gallbladder carcinoma", "bladder cancer", "glioblastoma multiforme", "acute myeloid leukemia", "breast cancer", "t-cell leukemia/lymphoma", "osteosarcoma"]
disease = "[" + ", ".join(q(x) for x in DISEASES) + f"][p_partkey % {len(DISEASES)} + 1]"
substring = "CASE " + " ".join(f"WHEN contains(x, '{k}') THEN '{v}'" for k, v in V.CANCER_KEYWORDS) + " ELSE x END"
whole = r"CASE WHEN regexp_matches(x, '\bbladder\b') AND NOT contains(x, 'gallbladder') THEN 'bladder cancer' WHEN contains(x, 'gallbladder') THEN 'gallbladder cancer' " + " ".join(rf"WHEN regexp_matches(x, '\b{k}\b') THEN '{v}'" for k, v in V.CANCER_KEYWORDS) + " ELSE x END"


def diseases(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.element_at(F.array(*[F.lit(x) for x in DISEASES]), (F.col("p_partkey") % len(DISEASES) + 1).cast("int")).alias("x"))


@query("C14_keyword_category", f"SELECT id, {substring} AS found, {whole} AS word FROM (SELECT p_partkey AS id, {disease} AS x FROM part)")
def c14(spark, d):
    return diseases(spark, d).select("id", T.keyword_category(C("x")).alias("found"), T.keyword_category(C("x"), "word").alias("word"))


@query("C15_blood_cancer", f"SELECT id, CASE WHEN contains(x, 'leukemi') AND contains(x, 'lymphoma') THEN 'leukemia/lymphoma' WHEN contains(x, 'leukemi') THEN 'leukemia' WHEN contains(x, 'lymphoma') THEN 'lymphoma' ELSE x END AS kind FROM (SELECT p_partkey AS id, {disease} AS x FROM part)")
def c15(spark, d):
    return diseases(spark, d).select("id", T.blood_cancer(C("x")).alias("kind"))


PAIRS = [("p.Val600Glu", "b-raf"), ("p53R175H", "TP53"), ("p53", "TP53"), ("mutation", "EGFR"), ("egfr", "EGFR"), ("ex20ins", "HER2"), ("c.2138C>G", "BRCA1"), ("T790M", "EGFR"), ("VUS", "ATM"), ("G12C", "K-RAS"), ("x", "UNKNOWN"), ("L858R", "CSF")]
_variant = "[" + ", ".join(q(v) for v, _ in PAIRS) + f"][l_partkey % {len(PAIRS)} + 1]"
_gene = "[" + ", ".join(q(g) for _, g in PAIRS) + f"][l_partkey % {len(PAIRS)} + 1]"
_aliases = "CASE g0 " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.GENE_ALIASES.items()) + " ELSE g0 END"
_codes = "|".join(V.AMINO_ACIDS)
_letter = "CASE lower({}) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.AMINO_ACIDS.items()) + " END"
_shape = rf"'(?i)\b({_codes})(\d+)({_codes})\b'"
_short = f"CASE WHEN regexp_matches(v1, {_shape}) THEN regexp_replace(v1, {_shape}, {_letter.format(f'regexp_extract(v1, {_shape}, 1)')} || regexp_extract(v1, {_shape}, 2) || {_letter.format(f'regexp_extract(v1, {_shape}, 3)')}) ELSE v1 END"
_exon = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(v2), {q(m)})' for m in marks)} THEN '{name}'" for name, marks in V.EXON_NAMES) + " ELSE v2 END"


def _in(words: list[str]) -> str:
    return ", ".join(q(w) for w in words)


@query(
    "C16_clean_pairs",
    rf"""WITH a AS (SELECT l_orderkey AS paper_id, l_linenumber AS ord, {_variant} AS v0, regexp_replace(upper({_gene}), '[-_\s]', '', 'g') AS g0 FROM lineitem),
    b AS (SELECT *, {_aliases} AS gene FROM a), c AS (SELECT *, CASE WHEN gene = 'TP53' AND starts_with(lower(v0), 'p53') THEN substr(v0, 4) ELSE v0 END AS v1 FROM b),
    e AS (SELECT *, {_short} AS v2 FROM c), f AS (SELECT *, {_exon} AS v3 FROM e),
    g AS (SELECT *, lower(regexp_replace(regexp_replace(v3, '(?i)^[cp]\.', ''), '[-_\s.]', '', 'g')) AS variant FROM f)
    SELECT paper_id, variant, gene, min(ord) AS ord FROM g WHERE gene NOT IN ({_in(V.NOT_GENES)}) AND gene NOT IN ({_in(V.NO_GENE)}) AND length(gene) BETWEEN 2 AND 10 AND length(variant) BETWEEN 2 AND 40
      AND variant <> lower(gene) AND variant NOT IN ({_in(V.NOT_VARIANTS)}) AND variant <> 'none' AND NOT ({' OR '.join(f"contains(variant, '{w}')" for w in V.NOT_IN_VARIANTS)}) GROUP BY ALL""",
)
def c16(spark, d):
    k = (F.col("l_partkey") % len(PAIRS) + 1).cast("int")
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("paper_id"), F.col("l_linenumber").alias("ord"), F.element_at(F.array(*[F.lit(v) for v, _ in PAIRS]), k).alias("variant"), F.element_at(F.array(*[F.lit(g) for _, g in PAIRS]), k).alias("gene")
    )
    return X.clean_pairs(rows, "paper_id")


@query("C17_gene_prefix", r"SELECT id, CASE WHEN starts_with(v, g) AND NOT regexp_matches(substr(v, length(g) + 1), '^[*.]') AND length(substr(v, length(g) + 1)) >= 2 THEN substr(v, length(g) + 1) ELSE v END AS out FROM (SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS g, CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', '') WHEN 1 THEN replace(p_name, ' ', '*') ELSE p_type END AS v FROM part)")
def c17(spark, d):
    v = F.when(C("p_partkey") % 3 == 0, F.replace("p_name", F.lit(" "), F.lit(""))).when(C("p_partkey") % 3 == 1, F.replace("p_name", F.lit(" "), F.lit("*"))).otherwise(C("p_type"))
    rows = table(spark, d, "part").select(C("p_partkey").alias("id"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("g"), v.alias("v"))
    return rows.select("id", X.without_gene_prefix(C("v"), C("g")).alias("out"))


ALIASED = "WITH v AS (SELECT p_partkey AS id, [{}][p_partkey % {} + 1] AS a, lower(split_part(p_name, ' ', 2)) AS tail FROM part), w AS (SELECT id, CASE WHEN id % 5 = 0 THEN 'TP53' ELSE a.gene END AS gene, a.alias || ' ' || tail AS v FROM v) SELECT id, CASE WHEN gene = 'TP53' THEN v ELSE ' ' || split_part(lower(v), ' ', -1) END AS out FROM w"
SOME = [("HER3", "ERBB3"), ("CMET", "MET"), ("GALECTIN", "LGALS1"), ("TELOMERASE", "TERT")]


@query("C17_alias_prefix", ALIASED.format(", ".join(f"{{'alias': '{a}', 'gene': '{g}'}}" for a, g in SOME), len(SOME)))
def c17_alias(spark, d):
    """Variants that begin with an alias of their gene, but for one in five, whose gene is another."""
    k = C("p_partkey")
    at = (k % len(SOME) + 1).cast("int")
    alias, gene = (F.element_at(F.array(*[F.lit(x) for x in xs]), at) for xs in zip(*SOME, strict=True))
    rows = table(spark, d, "part").select(k.alias("id"), F.when(k % 5 == 0, F.lit("TP53")).otherwise(gene).alias("gene"), F.concat(alias, F.lit(" "), F.lower(F.split_part("p_name", F.lit(" "), F.lit(2)))).alias("v"))
    return rows.select("id", X.without_alias_prefix(C("v"), C("gene"), V.GENE_ALIASES).alias("out"))


@query("C18_rejected_variants", "WITH a AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'q' || p_size WHEN 1 THEN p_size || 'd' WHEN 2 THEN 'v3' WHEN 3 THEN 'v' || p_size || 'e' WHEN 4 THEN 'del19' ELSE lower(p_type) || 'wt' END AS v FROM part) SELECT id, v FROM a WHERE v IN ('v3', 'v7') OR NOT (" + " OR ".join(f"regexp_matches(v, {q(s)})" for s in V.REJECTED_VARIANT_SHAPES) + f" OR v IN ({_in(V.REMOVED_VARIANTS)}))")
def c18(spark, d):
    k = C("p_partkey") % 6
    v = F.when(k == 0, F.concat(F.lit("q"), "p_size")).when(k == 1, F.concat("p_size", F.lit("d"))).when(k == 2, F.lit("v3")).when(k == 3, F.concat(F.lit("v"), "p_size", F.lit("e"))).when(k == 4, F.lit("del19")).otherwise(F.concat(F.lower("p_type"), F.lit("wt")))
    return table(spark, d, "part").select(C("p_partkey").alias("id"), v.alias("v")).where(~X.rejected(C("v")))


@query("C19_variant_keys", r"SELECT p_partkey AS id, k, regexp_extract(k, '^(.*)_([^_]*)$', 1) AS variant, regexp_extract(k, '^(.*)_([^_]*)$', 2) AS gene FROM (SELECT p_partkey, lower(replace(p_name, ' ', '_')) || '_' || upper(p_type) AS k FROM part)")
def c19(spark, d):
    rows = table(spark, d, "part").select(C("p_partkey").alias("id"), T.variant_key(F.replace("p_name", F.lit(" "), F.lit("_")), C("p_type")).alias("k"))
    variant, gene = T.split_variant_key(C("k"))
    return rows.select("id", "k", variant.alias("variant"), gene.alias("gene"))


@query("C20_rs_ids", r"SELECT o_orderkey AS id, lower(coalesce(nullif(regexp_extract(a, '(?i)rs\d+'), ''), nullif(regexp_extract(b, '(?i)rs\d+'), ''))) AS rs FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'RS' || o_custkey ELSE 'none' END AS a, CASE WHEN o_orderkey % 2 = 0 THEN 'x rs' || o_orderkey ELSE '' END AS b FROM orders)")
def c20(spark, d):
    a = F.when(C("o_orderkey") % 3 == 0, F.concat(F.lit("RS"), "o_custkey")).otherwise(F.lit("none"))
    b = F.when(C("o_orderkey") % 2 == 0, F.concat(F.lit("x rs"), "o_orderkey")).otherwise(F.lit(""))
    return table(spark, d, "orders").select(C("o_orderkey").alias("id"), T.rs_id(a, b).alias("rs"))


@query("C21_hgvs_tail", "SELECT o_orderkey AS id, string_split(string_split('NM_1:c.' || o_custkey || '|NP', '|')[1], ':')[-1] AS tail FROM orders")
def c21(spark, d):
    return table(spark, d, "orders").select(C("o_orderkey").alias("id"), T.hgvs_tail(F.concat(F.lit("NM_1:c."), C("o_custkey").cast("string"), F.lit("|NP"))).alias("tail"))


@query("C22_ontology_id", r"SELECT n_nationkey AS id, nullif(regexp_extract('http://x/' || CASE WHEN n_nationkey % 2 = 0 THEN 'DOID:' ELSE '' END || n_nationkey, 'DOID:(\d+)', 1), '') AS doid FROM nation")
def c22(spark, d):
    url = F.concat(F.lit("http://x/"), F.when(C("n_nationkey") % 2 == 0, F.lit("DOID:")).otherwise(F.lit("")), C("n_nationkey").cast("string"))
    return table(spark, d, "nation").select(C("n_nationkey").alias("id"), T.ontology_id(url).alias("doid"))


over_titles("C23_asked_cancer", "CASE WHEN lower(trim(title || ' tumour')) IN ('brain tumour') THEN lower(trim(title || ' tumour')) ELSE regexp_replace(lower(trim(title || ' tumour')), 'tumour|tumor|carcinoma|neoplasm', 'cancer', 'g') END", lambda: T.asked_cancer(F.concat("title", F.lit(" tumour")), ["brain tumour"]))
over_titles("C24_wrapped", r"regexp_replace(regexp_replace(title, '(.{1,60})(?:\s+|$)', '\1<br>', 'g'), '<br>$', '')", lambda: T.wrapped(C("title")))


@query("C25_labels", "SELECT p_type AS kind, format('{:,}', count(*) * 1000) AS n, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS label FROM part GROUP BY p_type")
def c25(spark, d):
    return table(spark, d, "part").groupBy(C("p_type").alias("kind")).agg(F.format_number(F.count("*") * 1000, 0).alias("n")).withColumn("label", F.initcap("kind"))


over_titles("C26_tokens", r"len(regexp_extract_all(title, '\w+'))", lambda: F.size(T.tokens(C("title"))))
over_titles("C27_listed", r"list_filter(list_transform(regexp_split_to_array(regexp_replace('[''' || title || '''; ''b'', c]', '^\[|\]$|[''" + '"' + r"]', '', 'g'), '[,;]'), lambda x: trim(x)), lambda x: x <> '')", lambda: T.listed(F.concat(F.lit("['"), "title", F.lit("'; 'b', c]"))))
