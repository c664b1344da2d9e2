"""Joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from mentionmill.operators.pairs import unordered_pairs
from mentionmill.operators.ranges import as_of, counted_in_intervals
from mentionmill.plans.registry import query
from mentionmill.plans.views import MENTION, mention, table, with_

C = F.col


@query("F01_left_null_safe", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON nullif(c_nationkey, 3) IS NOT DISTINCT FROM nullif(n_nationkey, 3)")
def f01(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, F.nullif("c_nationkey", F.lit(3)).eqNullSafe(F.nullif("n_nationkey", F.lit(3))), "left").select("c_custkey", "n_name")


#: Counts by key, whose keys overlap in part: what a chain of full joins has to keep.
CHAIN = [("customers", "customer", "c_nationkey"), ("suppliers", "supplier", "s_suppkey"), ("orders", "orders", "o_custkey"), ("items", "lineitem", "l_partkey")]


@query(
    "F02_full_outer_chain",
    "WITH " + ", ".join(f"{n}_ AS (SELECT {k}::BIGINT AS id, count(*) AS {n} FROM {t} GROUP BY 1)" for n, t, k in CHAIN) + " SELECT id, customers, suppliers, orders, items FROM customers_ FULL JOIN suppliers_ USING (id) FULL JOIN orders_ USING (id) FULL JOIN items_ USING (id)",
)
def f02(spark, d):
    parts = [table(spark, d, t).groupBy(C(k).cast("long").alias("id")).agg(F.count("*").alias(n)) for n, t, k in CHAIN]
    return reduce(lambda a, b: a.join(b, "id", "full"), parts)


@query("F03_composite_left", "SELECT coalesce(s_suppkey, c_custkey) AS id, s_name, n_name FROM (SELECT * FROM supplier FULL JOIN customer ON s_suppkey = c_custkey) LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey = c_nationkey % 5")
def f03(spark, d):
    both = table(spark, d, "supplier").join(table(spark, d, "customer"), C("s_suppkey") == C("c_custkey"), "full")
    found = both.join(table(spark, d, "nation"), (C("n_nationkey") == C("s_nationkey")) & (C("n_regionkey") == C("c_nationkey") % 5), "left")
    return found.select(F.coalesce("s_suppkey", "c_custkey").alias("id"), "s_name", "n_name")


@query("F04_reduce_merge", "SELECT user_id, " + ", ".join(f"nullif(count_if(event_type = '{k}'), 0) AS {k}" for k in ("click", "view", "error")) + " FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY user_id")
def f04(spark, d):
    parts = [table(spark, d, "events").where(C("event_type") == k).groupBy("user_id").agg(F.count("*").alias(k)) for k in ("click", "view", "error")]
    return reduce(lambda a, b: a.join(b, "user_id", "full"), parts)


@query("F05_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.09)")
def f05(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem").where("l_discount > 0.09"), C("o_orderkey") == C("l_orderkey"), "left_semi").select("o_orderkey")


@query("F06_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.05)")
def f06(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem").where("l_discount > 0.05"), C("o_orderkey") == C("l_orderkey"), "left_anti").select("o_orderkey")


@query("F07_match_indicator", "SELECT CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS found, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def f07(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.lit(True).alias("has"))
    return table(spark, d, "documents").select("doc_id").join(labels, "doc_id", "left").groupBy(F.when(C("has"), F.lit("both")).otherwise(F.lit("left_only")).alias("found")).agg(F.count("*").alias("n"))


@query("F08_lookup_default", "SELECT c_custkey, coalesce(n_name, 'unknown') AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey")
def f08(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "nation").where("n_regionkey < 3"), C("c_nationkey") == C("n_nationkey"), "left").select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"))


@query("F09_priority_lookup", "SELECT p_partkey, coalesce(CASE WHEN starts_with(p_name, 'red') THEN 'by name' END, CASE WHEN contains(p_name, 'ring') THEN 'by synonym' END) AS found FROM part WHERE starts_with(p_name, 'red') OR contains(p_name, 'ring')")
def f09(spark, d):
    """A name first, else a synonym: two priorities in one table, the first hit wins."""
    keys = spark.createDataFrame([("red", 1, "by name"), ("ring", 2, "by synonym")], "word string, priority int, found string")
    words = table(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "word"))
    hits = words.join(keys, "word").where((C("priority") == 2) | (C("at") == 0))
    first = hits.withColumn("n", F.row_number().over(Window.partitionBy("p_partkey").orderBy("priority"))).where("n = 1")
    return first.select("p_partkey", "found")


@query("F10_containment", "SELECT p_partkey, min(term) AS term FROM part, (SELECT unnest(['ring', 'red', 'bolt', 'gear']) AS term) WHERE contains(p_name, term) GROUP BY p_partkey")
def f10(spark, d):
    from mentionmill.operators.dictionary import match_substrings

    terms = spark.createDataFrame([(t,) for t in ("ring", "red", "bolt", "gear")], "term string")
    texts = table(spark, d, "part").select("p_partkey", C("p_name").alias("text"))
    return match_substrings(texts, terms, "p_partkey").groupBy("p_partkey").agg(F.min("term").alias("term"))


@query("F11_word_match", r"SELECT p_partkey, term FROM part, (SELECT unnest(['ring', 'red bolt', 'gear']) AS term) WHERE regexp_matches(p_name, '\b' || term || '\b')")
def f11(spark, d):
    from mentionmill.operators.dictionary import match_terms

    terms = spark.createDataFrame([(t,) for t in ("ring", "red bolt", "gear")], "term string")
    return match_terms(table(spark, d, "part").select("p_partkey", C("p_name").alias("text")), terms, "p_partkey")


@query("F12_product", "SELECT n_name, r_name FROM nation, region")
def f12(spark, d):
    return table(spark, d, "nation").select("n_name").crossJoin(F.broadcast(table(spark, d, "region").select("r_name")))


@query("F13_self_join", with_(MENTION) + "SELECT a.entity AS a, b.entity AS b, count(*) AS n FROM mention a JOIN mention b ON a.paper_id = b.paper_id AND a.entity < b.entity WHERE a.category = 'Cancer' AND b.category = 'Cancer' GROUP BY 1, 2")
def f13(spark, d):
    m = mention(spark, d).where("category = 'Cancer'")
    return unordered_pairs(m, "paper_id", "entity").groupBy(C("src").alias("a"), C("dst").alias("b")).agg(F.count("*").alias("n"))


@query("F14_positional", "SELECT a.conv_id, a.turn, a.role AS role_a, b.role AS role_b FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn")
def f14(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", C("role").alias("role_a")).join(c.select("conv_id", "turn", C("role").alias("role_b")), ["conv_id", "turn"])


@query("F15_inner_on_missing", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def f15(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer").where("c_acctbal > 5000"), C("o_custkey") == C("c_custkey")).select("o_orderkey", "c_name")


@query("F16_left_zero", "SELECT s_suppkey, coalesce(n, 0) AS n FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity = 50 GROUP BY 1) ON l_suppkey = s_suppkey")
def f16(spark, d):
    n = table(spark, d, "lineitem").where("l_quantity = 50").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return table(spark, d, "supplier").join(n, C("l_suppkey") == C("s_suppkey"), "left").select("s_suppkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("F19_dimension_match", "SELECT p_partkey, list_sort(list_intersect(list_distinct(string_split(p_name, ' ')), ['red', 'ring', 'hot'])) AS matched FROM part WHERE len(list_intersect(string_split(p_name, ' '), ['red', 'ring', 'hot'])) > 0")
def f19(spark, d):
    matched = F.array_sort(F.array_intersect(F.split("p_name", " "), F.array(F.lit("red"), F.lit("ring"), F.lit("hot"))))
    return table(spark, d, "part").select("p_partkey", matched.alias("matched")).where(F.size("matched") > 0)


#: Orders in the weeks of the events: what customers did by the second.
MOVED = "orders_at AS (SELECT o_custkey, o_orderkey, o_totalprice, TIMESTAMP '2024-01-01' + to_seconds(CAST(o_orderkey * 7919 % 2592000 AS BIGINT)) AS moment FROM orders)"


def orders_at(spark, d):
    seconds = F.pmod(C("o_orderkey") * 7919, F.lit(30 * 86400))
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp")) + seconds).alias("moment"))


@query("F17_as_of", with_(MOVED) + ", o AS (SELECT moment, max({'o_orderkey': o_orderkey, 'o_totalprice': o_totalprice}) AS h FROM orders_at GROUP BY moment) SELECT event_id, h.o_orderkey AS o_orderkey_as_of, h.o_totalprice AS o_totalprice_as_of FROM events e ASOF LEFT JOIN o ON e.ts >= o.moment")
def f17(spark, d):
    """The latest order, of anyone, at the time of each event."""
    e = table(spark, d, "events").select("event_id", C("ts").cast("timestamp").alias("ts"))
    return as_of(e, orders_at(spark, d), "ts", ["o_orderkey", "o_totalprice"], right_time="moment").drop("ts")


@query("F17_as_of_by_customer", with_(MOVED) + ", o AS (SELECT o_custkey, moment, max({'o_orderkey': o_orderkey}) AS h FROM orders_at GROUP BY ALL) SELECT event_id, user_id, h.o_orderkey AS o_orderkey_as_of FROM events e ASOF LEFT JOIN o ON e.user_id = o.o_custkey AND e.ts >= o.moment")
def f17_by(spark, d):
    """A user's own latest order at the time of each event."""
    e = table(spark, d, "events").select("event_id", "user_id", C("ts").cast("timestamp").alias("ts"))
    return as_of(e, orders_at(spark, d).withColumn("user_id", C("o_custkey")), "ts", ["o_orderkey"], right_time="moment", by="user_id").drop("ts")


@query("F17_intervals", with_(MOVED) + "SELECT o_orderkey, count(*) AS n, count(DISTINCT user_id) AS users FROM orders_at JOIN events ON floor(epoch(ts))::BIGINT >= floor(epoch(moment))::BIGINT AND floor(epoch(ts))::BIGINT < floor(epoch(moment))::BIGINT + 600 + o_orderkey % 3000 GROUP BY o_orderkey")
def f17_intervals(spark, d):
    """Events within some minutes after each order."""
    start = F.unix_timestamp("moment")
    spans = orders_at(spark, d).select("o_orderkey", start.alias("start"), (start + 600 + C("o_orderkey") % 3000).alias("end"))
    points = table(spark, d, "events").select("user_id", F.unix_timestamp(C("ts").cast("timestamp")).alias("second"))
    told = counted_in_intervals(points, spans, "second", "start", "end", "user_id", 3600, distinct="users")
    return told.groupBy("o_orderkey").agg(F.sum("n").alias("n"), F.max("users").alias("users"))  # spans of one key are equal
