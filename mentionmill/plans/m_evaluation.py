"""Evaluation of extractors."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill.operators import evaluate as E
from mentionmill.plans.registry import query
from mentionmill.plans.views import table, with_

C = F.col
SCORES = "round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall, round(coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0), 6) AS specificity, round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0)::DOUBLE, 0), 6) AS accuracy, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1, round(coalesce(tp / nullif(tp + fp + fn, 0)::DOUBLE, 0), 6) AS jaccard"


def rounded(df):
    names = ("precision", "recall", "specificity", "accuracy", "f1", "jaccard")
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("M01_binary_confusion", "WITH c AS (SELECT lang, count_if(quality = 0 AND length(text) < 300) AS tp, count_if(quality = 1 AND length(text) < 300) AS fp, count_if(quality = 0 AND length(text) >= 300) AS fn, count_if(quality = 1 AND length(text) >= 300) AS tn FROM labels JOIN documents USING (doc_id) GROUP BY lang) SELECT lang, tp, fp, fn, tn, " + SCORES + " FROM c")
def m01(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    return rounded(E.scores(E.binary_confusion(rows, C("quality") == 0, F.length("text") < 300, "lang")))


COUNTS = "x AS (SELECT l_suppkey, l_orderkey, count_if(l_returnflag = 'A') AS h, count_if(l_linestatus = 'F') AS m FROM lineitem GROUP BY 1, 2)"


@query("M02_count_confusion", with_(COUNTS, "c AS (SELECT l_suppkey, sum(least(h, m))::BIGINT AS tp, sum(greatest(m - h, 0))::BIGINT AS fp, sum(greatest(h - m, 0))::BIGINT AS fn, count_if(h = 0 AND m = 0) AS tn FROM x GROUP BY l_suppkey)") + "SELECT l_suppkey, tp, fp, fn, tn, " + SCORES + " FROM c")
def m02(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.count_if(C("l_returnflag") == "A").alias("h"), F.count_if(C("l_linestatus") == "F").alias("m"))
    return rounded(E.scores(E.count_confusion(x, "h", "m", "l_suppkey")))


SETS = "x AS (SELECT l_orderkey, list(DISTINCT l_partkey) FILTER (l_returnflag = 'A') AS h0, list(DISTINCT l_partkey) FILTER (l_linestatus = 'F') AS m0 FROM lineitem GROUP BY 1), y AS (SELECT l_orderkey, coalesce(h0, []) AS h, coalesce(m0, []) AS m FROM x)"


@query("M03_set_confusion", with_(SETS, "c AS (SELECT sum(len(list_intersect(h, m)))::BIGINT AS tp, sum(len(list_filter(m, lambda v: NOT list_contains(h, v))))::BIGINT AS fp, sum(len(list_filter(h, lambda v: NOT list_contains(m, v))))::BIGINT AS fn, count_if(len(h) = 0 AND len(m) = 0) AS tn FROM y)") + "SELECT tp, fp, fn, tn, " + SCORES + " FROM c")
def m03(spark, d):
    part = lambda cond: F.collect_set(F.when(cond, C("l_partkey")))
    y = table(spark, d, "lineitem").groupBy("l_orderkey").agg(part(C("l_returnflag") == "A").alias("h"), part(C("l_linestatus") == "F").alias("m"))
    return rounded(E.scores(E.set_confusion(y, "h", "m")))


WRONG = "(SELECT l_orderkey AS key, list_sort(list_filter({0}, lambda v: NOT list_contains({1}, v))) AS names FROM y)"


@query("M03_first_errors", with_(SETS) + ", ".join(["SELECT * FROM (SELECT 'fp' AS kind, key, names FROM " + WRONG.format("m", "h") + " WHERE len(names) > 0 ORDER BY key LIMIT 5) UNION ALL SELECT * FROM (SELECT 'fn', key, names FROM " + WRONG.format("h", "m") + " WHERE len(names) > 0 ORDER BY key LIMIT 5)"]))
def m03_errors(spark, d):
    part = lambda cond: F.collect_set(F.when(cond, C("l_partkey")))
    y = table(spark, d, "lineitem").groupBy("l_orderkey").agg(part(C("l_returnflag") == "A").alias("h"), part(C("l_linestatus") == "F").alias("m"))
    return E.first_errors(y, "l_orderkey", "h", "m")


@query("M04_exact_match_rate", "SELECT round(avg(CASE WHEN trim(coalesce(o_orderpriority, '')) = CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '2-HIGH ' END THEN 1.0 ELSE 0.0 END), 6) AS rate FROM orders")
def m04(spark, d):
    said = F.when(C("o_orderkey") % 3 == 0, C("o_orderpriority")).otherwise(F.lit("2-HIGH "))
    same = F.trim(F.coalesce("o_orderpriority", F.lit(""))) == said
    return table(spark, d, "orders").agg(F.round(F.avg(F.when(same, 1.0).otherwise(0.0)), 6).alias("rate"))


@query("M05_pair_counts", r"SELECT sum(n)::BIGINT AS total, max(n) AS most, count_if(n > 0) AS rows_with, count_if(n = 0) AS rows_without FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '\d{3}-\d{4}')) AS n FROM documents)")
def m05(spark, d):
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\d{3}-\d{4}")).cast("long")
    return table(spark, d, "documents").select(n.alias("n")).agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.count_if(C("n") > 0).alias("rows_with"), F.count_if(C("n") == 0).alias("rows_without"))


SAID = "said AS (SELECT event_id, event_type AS p0, CASE WHEN event_id % 4 = 0 THEN 'view' ELSE event_type END AS p1, CASE WHEN event_id % 6 = 0 THEN 'error' ELSE event_type END AS p2 FROM events)"


def said(spark, d):
    k, t = C("event_id"), C("event_type")
    return table(spark, d, "events").select(k, t.alias("p0"), F.when(k % 4 == 0, F.lit("view")).otherwise(t).alias("p1"), F.when(k % 6 == 0, F.lit("error")).otherwise(t).alias("p2"))


@query("M06_agreement", with_(SAID) + "SELECT round(avg((p0 = p1)::INT), 6) AS a01, round(avg((p0 = p2)::INT), 6) AS a02, round(avg((p0 = p1 AND p1 = p2)::INT), 6) AS every, count_if(p1 <> p2) AS differ FROM said")
def m06(spark, d):
    rate = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    a, b = C("p0") == C("p1"), C("p1") == C("p2")
    return said(spark, d).agg(rate(a).alias("a01"), rate(C("p0") == C("p2")).alias("a02"), rate(a & b).alias("every"), F.count_if(~b).alias("differ"))


@query("M06_disagreeing_rows", with_(SAID) + "SELECT event_id, p0, p1, p2 FROM said WHERE p0 <> p1 OR p0 <> p2")
def m06_rows(spark, d):
    return E.disagreeing(said(spark, d), "event_id", "p0", "p1", "p2")


KINDS = ["click", "error", "purchase", "signup", "view", "none"]
GRID = f"k AS (SELECT unnest({KINDS}) AS k), grid AS (SELECT a.k AS p0, b.k AS p1, (SELECT count(*) FROM said s WHERE s.p0 = a.k AND s.p1 = b.k) AS n FROM k a, k b)"


@query("M07_class_confusion", with_(SAID, GRID) + "SELECT p0, p1, n FROM grid")
def m07(spark, d):
    return E.class_confusion(said(spark, d), "p0", "p1", KINDS)


@query("M08_weighted_scores", with_(SAID, GRID) + ", s AS (SELECT k, (SELECT sum(n) FROM grid WHERE p0 = k) AS support, (SELECT sum(n) FROM grid WHERE p1 = k) AS named, (SELECT n FROM grid WHERE p0 = k AND p1 = k) AS hit FROM k), t AS (SELECT support, coalesce(hit / nullif(named, 0)::DOUBLE, 0) AS p, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS r FROM s) SELECT round(sum(p * support) / sum(support), 2) AS precision, round(sum(r * support) / sum(support), 2) AS recall, round(sum(coalesce(2 * p * r / nullif(p + r, 0), 0) * support) / sum(support), 2) AS f1 FROM t")
def m08(spark, d):
    return E.weighted_scores(E.class_confusion(said(spark, d), "p0", "p1", KINDS), "p0", "p1")


@query("M09_scaled_columns", "WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT event_type, round(CASE WHEN event_type = 'error' THEN 1 - n / (max(n) OVER ())::DOUBLE ELSE n / (max(n) OVER ())::DOUBLE END, 6) AS scaled FROM c")
def m09(spark, d):
    c = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    share = C("n") / C("hi")
    return c.crossJoin(F.broadcast(c.agg(F.max("n").alias("hi")))).select("event_type", F.round(F.when(C("event_type") == "error", 1 - share).otherwise(share), 6).alias("scaled"))


@query("M10_model_by_gene", "SELECT p_type, " + ", ".join(f"count_if(l_returnflag = '{k}') AS \"{k}\"" for k in ("A", "N", "R")) + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type")
def m10(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), C("l_partkey") == C("p_partkey"))
    return rows.groupBy("p_type").pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1))).na.fill(0)


@query("M11_runtimes", "SELECT model, minutes, ord FROM (SELECT event_type AS model, round(sum(value) / 60, 4) AS minutes FROM events GROUP BY 1) JOIN (SELECT unnest(['view', 'error', 'click']) AS k, unnest([1, 2, 3]) AS ord) ON k = model")
def m11(spark, d):
    order = spark.createDataFrame([("view", 1), ("error", 2), ("click", 3)], "model string, ord int")
    spent = table(spark, d, "events").groupBy(C("event_type").alias("model")).agg(F.round(F.sum("value") / 60, 4).alias("minutes"))
    return spent.join(order, "model").orderBy("ord")
