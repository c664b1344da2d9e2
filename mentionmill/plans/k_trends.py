"""Publication aggregates and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.operators import trends as R
from mentionmill.plans.g_aggregates import WEEK, weeks
from mentionmill.plans.registry import query
from mentionmill.plans.views import MENTION, STUDY, mention, study, table, with_
from mentionmill.runtime import cut

C = F.col


@query("K01_per_period", with_(STUDY) + """, p AS (SELECT unnest([{'kind': 'year', 'period': strftime(pub_date, '%Y')}, {'kind': 'month', 'period': strftime(pub_date, '%Y-%m')},
  {'kind': 'week', 'period': strftime(date_trunc('week', pub_date), '%Y-%m-%d') || '/' || strftime(date_trunc('week', pub_date) + INTERVAL 6 DAY, '%Y-%m-%d')}], recursive := true) FROM study) SELECT kind, period, count(*) AS n FROM p GROUP BY 1, 2""")
def k01(spark, d):
    return R.per_period(study(spark, d), "pub_date")


@query("K02_smoothed_weeks", with_(WEEK) + "SELECT week, CASE WHEN count(*) OVER w = 4 THEN round(avg(n) OVER w, 4) END AS smooth FROM week WINDOW w AS (ORDER BY week ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)")
def k02(spark, d):
    return R.centred_mean(weeks(spark, d), "week", "n").select("week", F.round("smooth", 4).alias("smooth"))


@query("K03_top_genes", with_(MENTION) + "SELECT entity, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 4) AS pct FROM mention WHERE category = 'Gene' GROUP BY entity ORDER BY n DESC, entity LIMIT 15")
def k03(spark, d):
    base = table(spark, d, "orders").agg(F.count("*").alias("of"))
    top = mention(spark, d).where("category = 'Gene'").groupBy("entity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(15)
    return top.crossJoin(F.broadcast(base)).select("entity", "n", F.round(100.0 * C("n") / C("of"), 4).alias("pct"))


@query("K03_genes_an_article", with_(MENTION) + "SELECT genes, count(*) AS papers FROM (SELECT paper_id, count(*) AS genes FROM mention WHERE category = 'Gene' GROUP BY paper_id) GROUP BY genes")
def k03b(spark, d):
    return mention(spark, d).where("category = 'Gene'").groupBy("paper_id").agg(F.count("*").alias("genes")).groupBy("genes").agg(F.count("*").alias("papers"))


@query("K04_cancer_categories", with_(MENTION) + ", c AS (SELECT CASE entity WHEN 'SMALL' THEN 'lung cancer' WHEN 'LARGE' THEN 'melanoma' ELSE 'leukemia' END AS category, count(*) AS n FROM mention WHERE category = 'Cancer' GROUP BY 1) SELECT CASE WHEN n < 300 THEN 'other cancers' ELSE category END AS category, sum(n)::BIGINT AS n, round(100.0 * sum(n) / (SELECT sum(n) FROM c), 4) AS pct FROM c GROUP BY 1")
def k04(spark, d):
    name = F.when(C("entity") == "SMALL", F.lit("small lung tumor")).when(C("entity") == "LARGE", F.lit("large melanoma")).otherwise(F.lit("leukemic disease"))
    n = mention(spark, d).where("category = 'Cancer'").groupBy(T.blood_cancer(T.keyword_category(name)).alias("category")).agg(F.count("*").alias("n"))
    n = n.groupBy(F.when(C("n") < 300, F.lit("other cancers")).otherwise(C("category")).alias("category")).agg(F.sum("n").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("of")))).select("category", "n", F.round(100.0 * C("n") / C("of"), 4).alias("pct"))


@query("K05_treatment_hierarchy", "SELECT p_type AS category, p_brand AS treatment, count(DISTINCT l_orderkey) AS papers FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_type, p_brand)")
def k05(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), C("l_partkey") == C("p_partkey"))
    return rows.rollup(C("p_type").alias("category"), C("p_brand").alias("treatment")).agg(F.count_distinct("l_orderkey").alias("papers"))


@query("K06_panel_coverage", with_(MENTION) + ", p AS (SELECT n_name FROM nation WHERE n_nationkey < 10 UNION SELECT 'ABSENT'), m AS (SELECT entity IN (SELECT n_name FROM p) AS inside, count(*) AS n, count(DISTINCT entity) AS names FROM mention WHERE category = 'Gene' GROUP BY 1) SELECT CASE WHEN inside THEN 'in panel' ELSE 'outside' END AS kind, names, n, round(100.0 * n / (SELECT sum(n) FROM m), 2) AS pct FROM m UNION ALL SELECT 'not found', count(*), 0, 0 FROM p WHERE n_name NOT IN (SELECT entity FROM mention)")
def k06(spark, d):
    genes = mention(spark, d).where("category = 'Gene'")
    panel = table(spark, d, "nation").where("n_nationkey < 10").select(C("n_name").alias("entity")).union(spark.createDataFrame([("ABSENT",)], "entity string"))
    n = genes.join(panel.withColumn("hit", F.lit(True)), "entity", "left").groupBy(F.when(C("hit"), F.lit("in panel")).otherwise(F.lit("outside")).alias("kind")).agg(F.count_distinct("entity").alias("names"), F.count("*").alias("n"))
    n = n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("of")))).select("kind", "names", "n", F.round(100.0 * C("n") / C("of"), 2).cast("double").alias("pct"))
    lost = panel.join(genes, "entity", "left_anti").agg(F.count("*").alias("names")).select(F.lit("not found").alias("kind"), "names", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("pct"))
    return n.unionByName(lost)


@query("K07_top_variants", with_(MENTION) + "SELECT entity, count(*) AS n, round(100.0 * count(*) / (SELECT count(DISTINCT paper_id) FROM mention WHERE category = 'Variant'), 4) AS pct FROM mention WHERE category = 'Variant' GROUP BY entity ORDER BY n DESC, entity LIMIT 20")
def k07(spark, d):
    v = mention(spark, d).where("category = 'Variant'")
    base = v.agg(F.count_distinct("paper_id").alias("of"))
    return v.groupBy("entity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(20).crossJoin(F.broadcast(base)).select("entity", "n", F.round(100.0 * C("n") / C("of"), 4).alias("pct"))


@query("K08_dataset_funnel", with_(MENTION) + "SELECT category, count(DISTINCT paper_id) AS papers FROM mention GROUP BY category UNION ALL SELECT 'all four', count(*) FROM (SELECT paper_id FROM mention GROUP BY paper_id HAVING count(DISTINCT category) = 4)")
def k08(spark, d):
    m = cut(mention(spark, d))
    each = m.groupBy("category").agg(F.count_distinct("paper_id").alias("papers"))
    every = m.groupBy("paper_id").agg(F.count_distinct("category").alias("k")).where("k = 4").agg(F.count("*").alias("papers"))
    return each.unionByName(every.select(F.lit("all four").alias("category"), "papers"))
