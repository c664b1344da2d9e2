"""Sorting, limits, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from mentionmill.operators import cooc as O
from mentionmill.plans.g_aggregates import SCORE, scores
from mentionmill.plans.registry import query
from mentionmill.plans.views import MENTION, mention, table, with_
from mentionmill.runtime import cut

C = F.col


@query("I01_sorted", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal, row_number() OVER (ORDER BY CASE WHEN c_acctbal > 0 THEN c_acctbal END DESC NULLS LAST, c_custkey)::INT AS place FROM customer")
def i01(spark, d):
    """Places of a descending order with missing values last, exact across range partitions."""
    bal = table(spark, d, "customer").select("c_custkey", F.when(C("c_acctbal") > 0, C("c_acctbal")).alias("bal"))
    ranged = cut(bal.repartitionByRange(C("bal").desc_nulls_last(), "c_custkey").withColumn("part", F.spark_partition_id()))  # numbered once
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    counts = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = C("before") + F.row_number().over(Window.partitionBy("part").orderBy(C("bal").desc_nulls_last(), "c_custkey"))
    return ranged.join(counts, "part").select("c_custkey", "bal", place.cast("int").alias("place"))


@query("I02_head_and_tail", "(SELECT 'head' AS side, p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5) UNION ALL (SELECT 'tail', p_partkey FROM part ORDER BY p_retailprice, p_partkey DESC LIMIT 5)")
def i02(spark, d):
    p = table(spark, d, "part")
    head = p.orderBy(F.desc("p_retailprice"), "p_partkey").limit(5).select(F.lit("head").alias("side"), "p_partkey")
    return head.unionByName(p.orderBy("p_retailprice", F.desc("p_partkey")).limit(5).select(F.lit("tail").alias("side"), "p_partkey"))


@query("I03_largest", with_(MENTION) + "SELECT entity, count(*) AS n FROM mention GROUP BY entity ORDER BY n DESC, entity LIMIT 10")
def i03(spark, d):
    return mention(spark, d).groupBy("entity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(10)


@query("I04_submatrix", with_(SCORE) + ", c AS (SELECT * FROM score WHERE score > 1.0), ra AS (SELECT a FROM c GROUP BY a ORDER BY round(sum(score), 6) DESC, a LIMIT 3), rb AS (SELECT b FROM c GROUP BY b ORDER BY round(sum(score), 6) DESC, b LIMIT 10) SELECT * FROM c WHERE a IN (SELECT a FROM ra) AND b IN (SELECT b FROM rb)")
def i04(spark, d):
    return O.submatrix(scores(spark, d), 3, 10, by="score")


@query("I05_extremes", with_(SCORE) + "(SELECT * FROM score WHERE score > 0 ORDER BY score DESC, a, b LIMIT 20) UNION ALL (SELECT * FROM score WHERE score < 0 ORDER BY score, a, b LIMIT 20)")
def i05(spark, d):
    return O.extremes(scores(spark, d), 20)


@query("I06_excluded_then_top", with_(MENTION) + "SELECT entity, count(*) AS n FROM mention WHERE category = 'Treatment' AND lower(entity) NOT IN ('brand#1', 'brand#2') GROUP BY entity ORDER BY n DESC, entity LIMIT 5")
def i06(spark, d):
    return mention(spark, d).where((C("category") == "Treatment") & ~F.lower("entity").isin("brand#1", "brand#2")).groupBy("entity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(5)


@query("I07_union", "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT n_name FROM nation")
def i07(spark, d):
    n, r = table(spark, d, "nation").select(C("n_name").alias("name")), table(spark, d, "region").select(C("r_name").alias("name"))
    return n.unionByName(r).unionByName(n).distinct()


@query("I08_intersect", "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 300000 INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def i08(spark, d):
    return table(spark, d, "orders").where("o_totalprice > 300000").select(C("o_custkey").alias("k")).intersect(table(spark, d, "customer").where("c_acctbal > 0").select(C("c_custkey").alias("k")))


@query("I09_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def i09(spark, d):
    return table(spark, d, "customer").select(C("c_custkey").alias("k")).subtract(table(spark, d, "orders").where("o_orderstatus = 'F'").select(C("o_custkey").alias("k")))


@query("I10_index_union", with_(SCORE) + "SELECT a AS name FROM score WHERE score > 500 UNION SELECT b FROM score WHERE score < -300")
def i10(spark, d):
    s = scores(spark, d)
    return s.where("score > 500").select(C("a").alias("name")).unionByName(s.where("score < -300").select(C("b").alias("name"))).distinct().orderBy("name")


@query("I11_sample", "SELECT event_id, event_type FROM events ORDER BY md5(event_id || ':42'), event_id LIMIT 3")
def i11(spark, d):
    """Three rows by the hash of their keys and a seed: the same on every run."""
    return table(spark, d, "events").orderBy(F.md5(F.concat("event_id", F.lit(":42"))), "event_id").limit(3).select("event_id", "event_type")


@query("I12_fixed_order", "SELECT k AS event_type, o AS ord, coalesce(n, 0) AS n FROM (SELECT unnest(['view', 'click', 'nothing']) AS k, unnest([1, 2, 3]) AS o) LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ON event_type = k")
def i12(spark, d):
    order = spark.createDataFrame([("view", 1), ("click", 2), ("nothing", 3)], "event_type string, ord int")
    n = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return order.join(n, "event_type", "left").select("event_type", "ord", F.coalesce("n", F.lit(0)).alias("n")).orderBy("ord")


@query("I13_unpivot", "SELECT s_suppkey, name, v FROM (SELECT s_suppkey, s_acctbal AS bal, s_nationkey::DOUBLE AS nation FROM supplier) UNPIVOT (v FOR name IN (bal, nation))")
def i13(spark, d):
    wide = table(spark, d, "supplier").select("s_suppkey", C("s_acctbal").alias("bal"), C("s_nationkey").cast("double").alias("nation"))
    return wide.unpivot("s_suppkey", ["bal", "nation"], "name", "v").where("v IS NOT NULL")


@query("I14_transpose", "SELECT p_brand, " + ", ".join(f"count_if(p_type = '{k}') AS \"{k}\"" for k in ("ECONOMY", "SMALL")) + " FROM part WHERE p_type IN ('ECONOMY', 'SMALL') GROUP BY p_brand")
def i14(spark, d):
    long = table(spark, d, "part").where(C("p_type").isin("ECONOMY", "SMALL")).groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    return long.groupBy("p_brand").pivot("p_type", ["ECONOMY", "SMALL"]).agg(F.sum("n")).na.fill(0)
