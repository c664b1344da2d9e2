"""Incidence matrices as rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill.operators import mentions as M
from mentionmill.operators import variants as X
from mentionmill.plans.registry import query
from mentionmill.plans.views import MENTION, mention, table, with_

W = with_(MENTION)
KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "UNHEARD"]


@query("E01_one_hot_fixed", W + "SELECT o_orderkey AS paper_id, " + ", ".join(f'count_if(entity = \'{k}\')::INT AS "{k}"' for k in KINDS) + ", count(entity)::INT AS total FROM orders LEFT JOIN (SELECT * FROM mention WHERE category = 'Cancer') ON paper_id = o_orderkey GROUP BY o_orderkey")
def e01(spark, d):
    papers = table(spark, d, "orders").select(F.col("o_orderkey").alias("paper_id"))
    return M.one_hot(mention(spark, d).where("category = 'Cancer'"), papers, KINDS)


@query("E02_one_hot_found", W + "SELECT paper_id, " + ", ".join(f'count_if(entity = \'{k}\')::INT AS "{k}"' for k in KINDS[:-1]) + ", count(*)::INT AS total FROM mention WHERE category = 'Cancer' GROUP BY paper_id")
def e02(spark, d):
    found = mention(spark, d).where("category = 'Cancer'")
    return M.one_hot(found, found, M.vocabulary(found))


@query("E03_positions", W + "SELECT paper_id, entity, (row_number() OVER (PARTITION BY paper_id ORDER BY entity) - 1)::INT AS pos FROM mention WHERE category = 'Variant'")
def e03(spark, d):
    rows = mention(spark, d).where("category = 'Variant'").groupBy("paper_id").agg(F.array_sort(F.collect_set("entity")).alias("v"))
    return rows.select("paper_id", F.posexplode("v").alias("pos", "entity"))


@query("E04_pair_rows", "SELECT DISTINCT l_orderkey AS paper_id, lower(p_name) || '_' || upper(p_brand) AS pair FROM lineitem JOIN part ON l_partkey = p_partkey")
def e04(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("l_orderkey").alias("paper_id"), F.concat_ws("_", F.lower("p_name"), F.upper("p_brand")).alias("pair")).distinct()


@query("E05_totals", W + "SELECT entity, count(*) AS n FROM mention GROUP BY entity")
def e05(spark, d):
    return M.totals(mention(spark, d))


@query("E06_cross_check", W + "SELECT sum(n)::BIGINT AS row_sum, (SELECT count(*) FROM mention) AS cell_sum, sum(n) = (SELECT count(*) FROM mention) AS agree FROM (SELECT count(*) AS n FROM mention GROUP BY paper_id)")
def e06(spark, d):
    m = mention(spark, d)
    a = m.groupBy("paper_id").agg(F.count("*").alias("n")).agg(F.sum("n").alias("row_sum"))
    return a.crossJoin(F.broadcast(m.agg(F.count("*").alias("cell_sum")))).withColumn("agree", F.expr("row_sum = cell_sum"))


@query("E07_unused_entities", "SELECT n_name AS entity FROM nation WHERE n_name NOT IN (SELECT n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity > 49 AND l_linenumber = 7)")
def e07(spark, d):
    used = table(spark, d, "lineitem").where("l_quantity > 49 AND l_linenumber = 7").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    used = used.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("entity"))
    return M.unused(table(spark, d, "nation").select(F.col("n_name").alias("entity")), used)


@query("E08_binary_domain", "SELECT 'quality' AS name, count_if(quality NOT IN (0, 1)) AS bad, count_if(quality IS NULL) AS missing FROM labels UNION ALL SELECT 'toxic', count_if(toxic NOT IN (0, 1)), count_if(toxic IS NULL) FROM labels")
def e08(spark, d):
    long = table(spark, d, "labels").unpivot("doc_id", ["quality", "toxic"], "name", "v")
    return long.groupBy("name").agg(F.count_if(~F.col("v").isin(0, 1)).alias("bad"), F.count_if(F.col("v").isNull()).alias("missing"))


@query("E09_name_collisions", "SELECT p_name AS entity, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def e09(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_name").alias("entity")).agg(F.count("*").alias("n")).where("n > 1")


@query("E10_merged_names", W + "SELECT DISTINCT paper_id, category, CASE WHEN category = 'Cancer' AND entity IN ('SMALL', 'MEDIUM') THEN 'LARGE' ELSE entity END AS entity FROM mention")
def e10(spark, d):
    return M.relabel(mention(spark, d), spark.createDataFrame([("SMALL", "LARGE"), ("MEDIUM", "LARGE")], "entity string, name string"))


@query("E11_merged_aliases", W + "SELECT DISTINCT paper_id, CASE entity WHEN 'Brand#1' THEN 'Brand#2' WHEN 'Brand#3' THEN 'Brand#4' ELSE entity END AS entity FROM mention WHERE category = 'Treatment'")
def e11(spark, d):
    aliases = spark.createDataFrame([("Brand#1", "Brand#2", 1), ("Brand#1", "Brand#9", 2), ("Brand#3", "Brand#4", 3), ("Brand#5", "Brand#5", 4)], "alias string, canonical string, ord int")
    return X.merge_aliases(mention(spark, d).where("category = 'Treatment'").select("paper_id", "entity"), aliases)


PARENT = "parent AS (SELECT n_name AS entity, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey)"


def parents(spark, d):
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("entity"), F.col("r_name").alias("parent"))


@query("E12_roll_up", with_(MENTION, PARENT) + "SELECT DISTINCT paper_id, parent FROM mention JOIN parent USING (entity)")
def e12(spark, d):
    return M.roll_up(mention(spark, d), parents(spark, d))


@query("E13_without_parent", with_(MENTION, PARENT) + "SELECT o_orderkey AS paper_id FROM orders WHERE o_orderkey NOT IN (SELECT paper_id FROM mention JOIN parent USING (entity) WHERE parent = 'ASIA')")
def e13(spark, d):
    rolled = M.roll_up(mention(spark, d), parents(spark, d).where("parent = 'ASIA'"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("paper_id")).join(rolled, "paper_id", "left_anti")


@query("E14_name_parts", W + "SELECT split_part(entity, ' ', 2) AS part, count(*) AS n FROM mention WHERE category = 'Variant' GROUP BY 1")
def e14(spark, d):
    return mention(spark, d).where("category = 'Variant'").groupBy(F.substring_index("entity", " ", -1).alias("part")).agg(F.count("*").alias("n"))


@query("E15_sort_key", "SELECT DISTINCT p_brand AS name, length(p_brand) || p_brand AS sort_key FROM part")
def e15(spark, d):
    return table(spark, d, "part").select(F.col("p_brand").alias("name"), F.concat(F.length("p_brand").cast("string"), "p_brand").alias("sort_key")).distinct().orderBy("sort_key")


@query("E16_category_lists", W + "SELECT category, list_sort(list(DISTINCT entity)) AS entities FROM mention GROUP BY category")
def e16(spark, d):
    return mention(spark, d).select("category", "entity").distinct().groupBy("category").agg(F.array_sort(F.collect_list("entity")).alias("entities"))
