"""Aggregations and windows."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from mentionmill.operators.consensus import summary
from mentionmill.operators.ranges import exact_percentile, numbered, running_sum, shifted, tiles
from mentionmill.plans.registry import query
from mentionmill.plans.views import LABEL, MENTION, label, mention, table, with_

C = F.col


@query("G01_value_counts", "SELECT event_type, count(*) AS n, round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM events GROUP BY event_type")
def g01(spark, d):
    return summary(table(spark, d, "events"), "event_type")


@query("G02_group_size_and_total", with_(LABEL) + "SELECT pair, label, count(*) AS n, (sum(count(*)) OVER (PARTITION BY pair))::BIGINT AS total, count(*) = sum(count(*)) OVER (PARTITION BY pair) AS alone FROM label GROUP BY pair, label")
def g02(spark, d):
    n = label(spark, d).groupBy("pair", "label").agg(F.count("*").alias("n"))
    return n.withColumn("total", F.sum("n").over(Window.partitionBy("pair"))).withColumn("alone", C("n") == C("total"))


@query("G03_group_sum", "SELECT p_type, p_brand, sum(p_size)::BIGINT AS size FROM part GROUP BY p_type, p_brand")
def g03(spark, d):
    return table(spark, d, "part").groupBy("p_type", "p_brand").agg(F.sum("p_size").alias("size"))


@query("G04_group_mean", "SELECT p_type, round(avg(p_size), 6) AS mean FROM part GROUP BY p_type")
def g04(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(F.round(F.avg("p_size"), 6).alias("mean")).orderBy(F.desc("mean"), "p_type")


@query("G05_by_year", with_(MENTION) + "SELECT year(o_orderdate)::INT AS year, entity, count(*) AS n FROM mention JOIN orders ON paper_id = o_orderkey WHERE category = 'Gene' GROUP BY 1, 2")
def g05(spark, d):
    dated = table(spark, d, "orders").select(C("o_orderkey").alias("paper_id"), F.year("o_orderdate").alias("year"))
    return mention(spark, d).where("category = 'Gene'").join(dated, "paper_id").groupBy("year", "entity").agg(F.count("*").alias("n"))


@query("G06_histogram_pivot", with_(MENTION) + "SELECT year, " + ", ".join(f'count_if(n = {k}) AS "{k}"' for k in range(1, 8)) + ", count_if(n > 7) AS more FROM (SELECT year(o_orderdate)::INT AS year, paper_id, count(*) AS n FROM mention JOIN orders ON paper_id = o_orderkey WHERE category = 'Gene' GROUP BY 1, 2) GROUP BY year")
def g06(spark, d):
    dated = table(spark, d, "orders").select(C("o_orderkey").alias("paper_id"), F.year("o_orderdate").alias("year"))
    per = mention(spark, d).where("category = 'Gene'").groupBy("paper_id").agg(F.count("*").alias("n")).join(dated, "paper_id")
    few = F.when(C("n") <= 7, C("n").cast("string")).otherwise(F.lit("more"))
    return per.select("year", few.alias("n")).groupBy("year").pivot("n", [*map(str, range(1, 8)), "more"]).agg(F.count(F.lit(1))).na.fill(0)


@query("G07_distinct", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def g07(spark, d):
    return table(spark, d, "lineitem").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("G08_global", "SELECT sum(p_size)::BIGINT AS total, round(avg(p_size), 6) AS mean, max(p_size) AS hi, min(p_size) AS lo, count(*) AS n FROM part")
def g08(spark, d):
    return table(spark, d, "part").agg(F.sum("p_size").alias("total"), F.round(F.avg("p_size"), 6).alias("mean"), F.max("p_size").alias("hi"), F.min("p_size").alias("lo"), F.count("*").alias("n"))


@query("G09_conditional", "SELECT event_type, count_if(value > 10) AS high, round(avg(CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END), 6) AS share FROM events GROUP BY event_type")
def g09(spark, d):
    high = C("value") > 10
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(high).alias("high"), F.round(F.avg(F.when(high, 1.0).otherwise(0.0)), 6).alias("share"))


@query("G10_small_groups", "SELECT CASE WHEN n < 80 THEN 'other' ELSE p_brand END AS brand, sum(n)::BIGINT AS n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) GROUP BY 1")
def g10(spark, d):
    n = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return n.groupBy(F.when(C("n") < 80, F.lit("other")).otherwise(C("p_brand")).alias("brand")).agg(F.sum("n").alias("n"))


@query("G11_percent_of_base", with_(MENTION) + "SELECT category, round(100.0 * count(DISTINCT paper_id) / (SELECT count(*) FROM orders), 4) AS pct FROM mention GROUP BY category")
def g11(spark, d):
    base = table(spark, d, "orders").agg(F.count("*").alias("base"))
    n = mention(spark, d).groupBy("category").agg(F.count_distinct("paper_id").alias("n"))
    return n.crossJoin(F.broadcast(base)).select("category", F.round(100.0 * C("n") / C("base"), 4).alias("pct"))


@query("G12_row_wise", "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey + l_suppkey AS total, greatest(l_partkey, l_suppkey) AS most FROM lineitem")
def g12(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr("l_partkey + l_suppkey").alias("total"), F.greatest("l_partkey", "l_suppkey").alias("most"))


@query("G13_spread", "SELECT round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS sd, round(corr(l_quantity, l_extendedprice), 6) AS r, count_if(l_quantity <> l_linenumber) AS differ FROM lineitem")
def g13(spark, d):
    q, p = C("l_quantity"), C("l_extendedprice")
    return table(spark, d, "lineitem").agg(F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev_pop(q), 6).alias("sd"), F.round(F.corr(q, p), 6).alias("r"), F.count_if(q != C("l_linenumber")).alias("differ"))


@query("G14_percentile", "SELECT event_type, round(coalesce(quantile_cont(value, 0.8), 0), 6) AS p80 FROM events GROUP BY event_type")
def g14(spark, d):
    e = table(spark, d, "events")
    told = exact_percentile(e, ["event_type"], "value", 0.8, name="p80")
    return e.select("event_type").distinct().join(told, "event_type", "left").select("event_type", F.round(F.coalesce("p80", F.lit(0.0)), 6).alias("p80"))


@query("G15_likeliest_label", with_(LABEL) + "SELECT pair, label FROM (SELECT pair, label, row_number() OVER (PARTITION BY pair ORDER BY count(*) DESC, label) AS rn FROM label GROUP BY pair, label) WHERE rn = 1")
def g15(spark, d):
    n = label(spark, d).groupBy("pair", "label").agg(F.count("*").alias("n"))
    return n.groupBy("pair").agg(F.min_by("label", F.struct(-C("n"), "label")).alias("label"))


@query("G16_collected", with_(MENTION) + "SELECT paper_id, list_sort(list(DISTINCT entity)) AS names FROM mention WHERE category = 'Cancer' GROUP BY paper_id")
def g16(spark, d):
    return mention(spark, d).where("category = 'Cancer'").groupBy("paper_id").agg(F.array_sort(F.collect_set("entity")).alias("names"))


@query("G17_last_good", "SELECT p_partkey, coalesce(list_filter(list_reverse(string_split(p_name, ' ')), lambda x: x NOT IN ('ring', 'bolt'))[1], p_name) AS parent FROM part")
def g17(spark, d):
    good = F.filter(F.reverse(F.split("p_name", " ")), lambda x: ~x.isin("ring", "bolt"))
    return table(spark, d, "part").select("p_partkey", F.coalesce(F.get(good, F.lit(0)), "p_name").alias("parent"))


@query("G18_rollup", "SELECT r_name, n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def g18(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), C("s_nationkey") == C("n_nationkey")).join(table(spark, d, "region"), C("n_regionkey") == C("r_regionkey"))
    return s.rollup("r_name", "n_name").agg(F.count("*").alias("n"))


WEEK = "week AS (SELECT date_trunc('week', o_orderdate)::DATE AS week, count(*) AS n FROM orders GROUP BY 1)"


def weeks(spark, d):
    return table(spark, d, "orders").groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(F.count("*").alias("n"))


@query("H01_centred_mean", with_(WEEK) + "SELECT week, n, CASE WHEN count(*) OVER w = 4 THEN round(avg(n) OVER w, 6) END AS smooth FROM week WINDOW w AS (ORDER BY week ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)")
def h01(spark, d):
    from mentionmill.operators.trends import centred_mean

    return centred_mean(weeks(spark, d), "week", "n").withColumn("smooth", F.round("smooth", 6))


@query("H02_keep_first", "SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY event_type, user_id")
def h02(spark, d):
    from mentionmill.operators.rules import first_of

    return first_of(table(spark, d, "events"), [C("event_type"), C("user_id")], "event_id").select("event_type", "user_id", "event_id")


@query("H03_all_repeats", "SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name, p_brand, p_type) > 1 AS repeated FROM part")
def h03(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", (F.count("*").over(Window.partitionBy("p_name", "p_brand", "p_type")) > 1).alias("repeated"))


@query("H04_top_one", with_(LABEL) + "SELECT pair, label, n FROM (SELECT pair, label, count(*) AS n, row_number() OVER (PARTITION BY pair ORDER BY count(*) DESC, label) AS r FROM label GROUP BY pair, label) WHERE r = 1")
def h04(spark, d):
    n = label(spark, d).groupBy("pair", "label").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("pair").orderBy(F.desc("n"), "label"))).where("r = 1").drop("r")


SCORE = "score AS (SELECT p_type AS a, p_name AS b, round(sum(l_quantity) - 600, 2) AS score FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"


def scores(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), C("l_partkey") == C("p_partkey"))
    return rows.groupBy(C("p_type").alias("a"), C("p_name").alias("b")).agg(F.round(F.sum("l_quantity") - 600, 2).alias("score"))


@query("H05_top_of_each", with_(SCORE) + "SELECT a, b, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY abs(score) DESC NULLS LAST, b) AS rank FROM score WHERE NOT starts_with(b, 'red')) WHERE rank <= 5")
def h05(spark, d):
    from mentionmill.operators.cooc import best_of_each

    return best_of_each(scores(spark, d).where("NOT startswith(b, 'red')"), "a", 5)


@query("H06_forced_keys", with_(SCORE) + "SELECT a, b, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY b ORDER BY abs(score) DESC NULLS LAST, a) AS rank FROM (SELECT a, b, CASE WHEN score > 0 THEN score END AS score FROM score) WHERE b IN ('red bolt', 'hot gear')) WHERE rank <= 3")
def h06(spark, d):
    from mentionmill.operators.cooc import best_of_each

    return best_of_each(scores(spark, d).where(C("b").isin("red bolt", "hot gear")).withColumn("score", F.when(C("score") > 0, C("score"))), "b", 3).select("a", "b", "score", "rank")


PVALUE = "pv AS (SELECT p_type AS a, p_name AS b, round(1.0 / (1 + count(*) % 40), 6) AS p FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"


@query("H07_false_discovery", with_(PVALUE) + ", r AS (SELECT *, p * 1000 / rank_hi AS q FROM (SELECT *, count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank_hi FROM pv)) SELECT a, b, p, round(least(1.0, min(q) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS p_adj FROM r")
def h07(spark, d):
    from mentionmill.operators.stats import benjamini_hochberg

    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), C("l_partkey") == C("p_partkey")).groupBy(C("p_type").alias("a"), C("p_name").alias("b")).agg(F.round(1.0 / (1 + F.count("*") % 40), 6).alias("p"))
    return benjamini_hochberg(rows, 1000).select("a", "b", "p", F.round("p_adj", 6).alias("p_adj"))


@query("H08_share_of_total", "SELECT p_type, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM part GROUP BY p_type")
def h08(spark, d):
    n = table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("t")))).select("p_type", F.round(C("n") / C("t"), 6).alias("share"))


@query("H09_order_of_all", "SELECT event_id, row_number() OVER w AS n, lag(value) OVER w AS one_before, lead(value, 3) OVER w AS three_after, ntile(7) OVER w AS tile, round(sum(value) OVER w, 4) AS running FROM events WINDOW w AS (ORDER BY ts, event_id)")
def h09(spark, d):
    """Numbers, neighbours, tiles and running sums over the whole table, by ranges of its order."""
    e, order = table(spark, d, "events").select("event_id", "ts", "value"), ("ts", "event_id")
    e = numbered(e, *order)
    e = shifted(shifted(e, "value", 1, *order, name="one_before"), "value", -3, *order, name="three_after")
    e = running_sum(tiles(e, 7, *order), "value", *order)
    return e.select("event_id", "n", "one_before", "three_after", "tile", F.round("running", 4).alias("running"))
