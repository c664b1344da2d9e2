"""Sources, batches and nested inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill.plans.registry import query
from mentionmill.plans.views import table
from mentionmill.runtime import Scratch, ship
from mentionmill.sources import readers as R
from mentionmill.sources import writers as W


@query("A01_scan_schema", "SELECT doc_id AS paper_id, lang AS language, length(text)::BIGINT AS n FROM documents")
def a01(spark, d):
    """Delimited text with line breaks and quotes inside fields, read by a given schema."""
    path = f"{Scratch(spark, 'csv').folder}/articles"
    W.write_csv(table(spark, d, "documents").select("doc_id", "lang", "text"), path)
    rows = R.read_csv(spark, path, "paper_id bigint, language string, text string", lineSep="\n")
    return rows.select("paper_id", "language", F.length("text").cast("long").alias("n"))


@query("A02_panel_list", "SELECT DISTINCT trim(p_brand) AS gene FROM part WHERE trim(p_brand) <> ''")
def a02(spark, d):
    path = f"{Scratch(spark, 'panel').folder}/list"
    listed = table(spark, d, "part").select(F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("gene")).distinct()
    listed.unionByName(spark.createDataFrame([(" ",)], "gene string")).write.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return R.read_panel(spark, path)


@query("A03_projected_scan", "SELECT o_orderkey AS paper_id, o_totalprice AS price FROM orders WHERE o_totalprice > 100000")
def a03(spark, d):
    return table(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("paper_id"), F.col("o_totalprice").alias("price"))


@query(
    "A04_fused_column",
    """SELECT try_cast(trim(replace(split_part(f, ',', 1), '"', '')) AS BIGINT) AS paper_id, trim(substr(f, strpos(f, ',') + 1), '" ') AS body
    FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE '"' || o_orderkey END || ', ' || o_orderpriority || ', ' || o_orderstatus || '"' AS f FROM orders)""",
)
def a04(spark, d):
    key = F.when(F.col("o_orderkey") % 10 == 0, F.lit("x")).otherwise(F.concat(F.lit('"'), F.col("o_orderkey")))
    fused = table(spark, d, "orders").select(F.concat(key, F.lit(", "), "o_orderpriority", F.lit(", "), "o_orderstatus", F.lit('"')).alias("f"))
    ident, body = R.split_fused(F.col("f"))
    return fused.select(ident.alias("paper_id"), body.alias("body"))


@query(
    "A05_log_total",
    """SELECT round(sum(regexp_extract(v, 'took ([0-9]+\\.[0-9]+) s', 1)::DOUBLE), 2) AS total, count(*) AS n
    FROM (SELECT 'batch ' || event_id || CASE WHEN event_type = 'error' THEN ' failed' ELSE ' took ' || event_id || '.25 s' END AS v FROM events) WHERE regexp_matches(v, 'took ([0-9]+\\.[0-9]+) s')""",
)
def a05(spark, d):
    said = F.when(F.col("event_type") == "error", F.lit(" failed")).otherwise(F.concat(F.lit(" took "), F.col("event_id"), F.lit(".25 s")))
    lines = table(spark, d, "events").select(F.concat(F.lit("batch "), F.col("event_id"), said).alias("value"))
    return R.log_total(lines, r"took ([0-9]+\.[0-9]+) s").select(F.round("total", 2).alias("total"), "n")


@query("A06_paged_records", "SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation")
def a06(spark, d):
    """Fetched page by page, as from a service: three records a page, one failure on the way."""
    rows = [r.asDict() for r in table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).orderBy("id").collect()]  # a stand-in for a service
    failed = []

    def fetch(cursor: str) -> dict:
        at = 0 if cursor == "*" else int(cursor)
        if at == 6 and not failed:
            failed.append(at)
            raise OSError("not now")
        return {"results": rows[at : at + 3], "meta": {"next_cursor": str(at + 3) if at + 3 < len(rows) else None}}

    return spark.createDataFrame(list(R.pages(fetch, sleep=lambda s: None)), "id long, name string")


@query("A07_dimension_source", "SELECT n.n_nationkey::BIGINT AS id, n.n_name AS name, r.r_name AS parent FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def a07(spark, d):
    """A dimension from a graph query with a cursor, four nodes a page."""
    joined = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = [r.asDict() for r in joined.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("parent")).orderBy("id").collect()]  # a stand-in for a service

    def fetch(after: str | None) -> dict:
        at = int(after or 0)
        return {"data": {"nations": {"edges": [{"node": r} for r in rows[at : at + 4]], "pageInfo": {"hasNextPage": at + 4 < len(rows), "endCursor": str(at + 4)}}}}

    return spark.createDataFrame(list(R.pages(fetch, R.connection("nations"), first=None, sleep=lambda s: None)), "id long, name string, parent string")


@query(
    "A08_enrichment_fallback",
    "SELECT c_custkey AS id, CASE WHEN c_nationkey % 5 < 2 THEN 'first ' || c_nationkey WHEN c_nationkey % 5 < 4 THEN 'second ' || c_nationkey END AS found FROM customer",
)
def a08(spark, d):
    """Keys looked up by clients in turn: the first knows some and fails on others, the second knows some of the rest."""
    ship(spark)

    def first(key):
        if key % 5 == 4:
            raise OSError("not there")
        return f"first {key}" if key % 5 < 2 else None

    def second(key):
        return f"second {key}" if key % 5 < 4 else None

    return R.enrich(table(spark, d, "customer"), "c_nationkey", [first, second]).select(F.col("c_custkey").alias("id"), "found")


@query(
    "A09_nested_json",
    """SELECT o_orderkey::VARCHAR AS paper_id, o_orderpriority AS title, array_to_string(string_split(o_orderpriority, '-'), ' ') AS abstract, CASE WHEN o_orderkey % 3 = 0 THEN 'A. ' || o_custkey ELSE 'A. ' || o_custkey || ', B. ' || o_orderkey END AS authors,
    o_custkey || '|' || o_orderkey AS citations, o_orderstatus AS concepts, year(o_orderdate)::INT AS pub_year, strftime(o_orderdate, '%Y-%m-%d') AS pub_date FROM orders""",
)
def a09(spark, d):
    """Bibliographic records written as JSON lines, read by their schema and flattened."""
    o, base = table(spark, d, "orders"), "https://records/"
    words = F.split("o_orderpriority", "-")
    author = lambda name: F.struct(F.struct(name.alias("display_name")).alias("author"))
    record = o.select(
        F.concat(F.lit(base), "o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"), F.year("o_orderdate").alias("publication_year"),
        F.map_from_entries(F.transform(words, lambda w, i: F.struct(w, F.array(i)))).alias("abstract_inverted_index"),
        F.array(author(F.concat(F.lit("A. "), "o_custkey")), author(F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("B. "), "o_orderkey")))).alias("authorships"),
        F.array(F.concat(F.lit(base), "o_custkey"), F.concat(F.lit(base), "o_orderkey")).alias("referenced_works"), F.array(F.struct(F.concat(F.lit(base), "o_orderstatus").alias("id"))).alias("concepts"),
    )
    path = f"{Scratch(spark, 'json').folder}/works"
    record.write.json(path)
    return R.flatten_works(spark.read.schema(R.RAW_WORK).json(path), base)


@query(
    "A09_nested_variants",
    """SELECT r_regionkey::BIGINT AS gene_id, r_name AS gene, lower(r_name) AS gene_description, n_nationkey::BIGINT AS variant_id, n_name AS variant, s_suppkey AS profile_id, s_name AS profile, NULL::VARCHAR AS profile_description,
    CASE s_suppkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN s_suppkey || ': A (None)' ELSE s_suppkey || ': A (None) | ' || (s_suppkey + 1) || ': B (' || s_name || ')' END AS assertions FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def a09_variants(spark, d):
    """Genes with variants, profiles and assertions, written as JSON lines of one gene each, read by their schema and flattened."""
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    none, k = F.lit(None).cast("string"), F.col("s_suppkey")
    one = F.struct(k.alias("id"), F.lit("A").alias("name"), none.alias("description"))
    two = F.struct((k + 1).alias("id"), F.lit("B").alias("name"), F.col("s_name").alias("description"))
    told = F.when(k % 3 == 1, F.array(one)).when(k % 3 == 2, F.array(one, two)).otherwise(F.slice(F.array(one), 1, 0))
    profile = s.select("s_nationkey", F.struct(k.alias("id"), F.col("s_name").alias("name"), none.alias("description"), F.struct(told.alias("nodes")).alias("assertions")).alias("p"))
    variant = n.join(profile.groupBy("s_nationkey").agg(F.collect_list("p").alias("nodes")), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    variant = variant.select("n_regionkey", F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.struct("nodes").alias("molecularProfiles")).alias("v"))
    gene = r.join(variant.groupBy("n_regionkey").agg(F.collect_list("v").alias("nodes")), F.col("n_regionkey") == F.col("r_regionkey"))
    path = f"{Scratch(spark, 'json').folder}/genes"
    gene.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lower("r_name").alias("description"), F.struct("nodes").alias("variants")).write.json(path)
    return R.flatten_genes(spark.read.schema(R.RAW_GENE).json(path))


@query("A10_inverted_text", "SELECT doc_id, array_to_string(list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> ''), ' ') AS body FROM documents")
def a10(spark, d):
    """Texts turned into maps from words to places, and back."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != "")
    return table(spark, d, "documents").select("doc_id", R.inverted_text(R.inverted_index(words)).alias("body"))


@query(
    "A11_joined_structs",
    "SELECT l_orderkey AS paper_id, coalesce(string_agg(replace('urn:' || l_partkey, 'urn:', ''), '|' ORDER BY l_linenumber, l_partkey) FILTER (l_returnflag <> 'A'), '') AS parts FROM lineitem GROUP BY l_orderkey",
)
def a11(spark, d):
    item = F.struct("l_linenumber", "l_partkey", F.when(F.col("l_returnflag") != "A", F.concat(F.lit("urn:"), F.col("l_partkey"))).alias("id"))
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return rows.select("paper_id", R.joined(F.col("items"), lambda x: x["id"], "urn:").alias("parts"))


@query("A12_csv_sink", "SELECT p_partkey, p_name, p_size, CASE WHEN p_size > 25 THEN p_brand END AS brand FROM part")
def a12(spark, d):
    """Written whole and read again; a missing value stays one."""
    path = f"{Scratch(spark, 'csv').folder}/parts"
    W.write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_size", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand")), path)
    return R.read_csv(spark, path, "p_partkey bigint, p_name string, p_size int, brand string")


@query("A13_chunked_csv", "SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS keys, true AS small FROM lineitem")
def a13(spark, d):
    """Files of 5,000 rows at most."""
    path = f"{Scratch(spark, 'csv').folder}/chunks"
    W.write_csv(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), path, rows_a_file=5000)
    rows = R.read_csv(spark, path, "l_orderkey bigint, l_linenumber int").groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))
    return rows.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), (F.max("n") <= 5000).alias("small"))


@query("A14_csv_append", "SELECT event_id::VARCHAR AS event_id, event_type FROM events")
def a14(spark, d):
    """Rows added in three goes, under one header."""
    path = f"{Scratch(spark, 'csv').folder}/log"
    e = table(spark, d, "events").select("event_id", "event_type")
    for k in range(3):
        W.append_csv(e.where(F.pmod("event_id", F.lit(3)) == k), path)
    return R.read_appended(spark, path)


@query("A16_graph_file", "SELECT n.n_name AS a, r.r_name AS b, (n.n_nationkey + 0.5)::DOUBLE AS weight, 'Region' AS category FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def a16(spark, d):
    """A small graph written as GML and read again."""
    pairs = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", (F.col("n_nationkey") + 0.5).cast("double")).collect()  # a graph to be drawn
    names = sorted({(a, "Nation") for a, _, _ in pairs} | {(b, "Region") for _, b, _ in pairs})
    vertices, edges = W.read_gml(W.gml(names, [tuple(p) for p in pairs]))
    kind = dict(vertices)
    return spark.createDataFrame([(a, b, w, kind[b]) for a, b, w in edges], "a string, b string, weight double, category string")


@query("A17_batches", "SELECT ceil(rn / 500.0)::INT AS batch, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1")
def a17(spark, d):
    return R.with_batch(table(spark, d, "orders").select("o_orderkey"), 500, "o_orderkey").groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query(
    "A18_reassembled_parts",
    "SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS balance FROM supplier",
)
def a18(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    folder = Scratch(spark, "parts").folder
    s.where("id % 2 = 0").write.parquet(f"{folder}/part-0")
    s.where("id % 2 = 1").drop("balance").write.parquet(f"{folder}/part-2")
    return R.read_parts(spark, [f"{folder}/part-{k}" for k in range(4)])  # 1 and 3 never came


@query(
    "A19_named_files",
    "SELECT 'supplier' AS model, count(*) AS n FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'region', count(*) FROM region",
)
def a19(spark, d):
    """Several files as one table, each row with the name that its file's name holds."""
    name = F.regexp_extract(F.input_file_name(), r"([a-z]+)\.parquet", 1)
    parts = [table(spark, d, t).select(name.alias("model")) for t in ("supplier", "nation", "region")]
    return R.reassemble(parts).groupBy("model").agg(F.count("*").alias("n"))
