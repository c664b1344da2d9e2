"""The co-occurrence graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill import fixed_values as V
from mentionmill.operators import clusters as K
from mentionmill.operators import consensus as N
from mentionmill.operators import cooc as O
from mentionmill.operators import graph as G
from mentionmill.plans.registry import query
from mentionmill.plans.views import MENTION, STUDY, mention, study, table, weights_sql, with_
from mentionmill.runtime import cut

C = F.col
EDGE = f"""gw AS (SELECT paper_id, {weights_sql(V.GRAPH_WEIGHTS, 0.5)} AS weight FROM study),
edge AS (SELECT a.entity AS src, b.entity AS dst, count(*) AS papers, sum(weight) AS weight FROM mention a JOIN mention b ON a.paper_id = b.paper_id AND a.entity < b.entity JOIN gw ON gw.paper_id = a.paper_id GROUP BY 1, 2),
sym AS (SELECT src, dst, papers, weight FROM edge UNION ALL SELECT dst, src, papers, weight FROM edge),
vertex AS (SELECT entity AS id, arg_min(category, CASE category WHEN 'Variant' THEN 1 WHEN 'Cancer' THEN 2 WHEN 'Treatment' THEN 3 ELSE 4 END) AS category FROM mention GROUP BY entity)"""
ALL = with_(MENTION, STUDY, EDGE)


def edges(spark, d, ordered=False):
    return G.edges(mention(spark, d), O.with_weight(study(spark, d), V.GRAPH_WEIGHTS, 0.5), ordered)


def both(spark, d):
    """Vertices, which need no mention twice, and edges."""
    return G.vertices(mention(spark, d, distinct=False)), edges(spark, d)


@query("L01_vertices", ALL + "SELECT id, category FROM vertex")
def l01(spark, d):
    return G.vertices(mention(spark, d))


@query("L02_edges", ALL + "SELECT src, dst, papers, round(weight, 6) AS weight FROM edge")
def l02(spark, d):
    return edges(spark, d).withColumn("weight", F.round("weight", 6))


@query("L03_ordered_edges", ALL + "SELECT src, dst, 2 * papers AS papers, round(2 * weight, 6) AS weight FROM edge")
def l03(spark, d):
    return edges(spark, d, ordered=True).withColumn("weight", F.round("weight", 6))


@query("L04_neighbours", ALL + "SELECT dst AS id, round(weight, 6) AS weight, category FROM sym JOIN vertex ON id = dst WHERE src = 'Brand#1'")
def l04(spark, d):
    m = mention(spark, d)
    return G.neighbours(G.edges_of(m, O.with_weight(study(spark, d), V.GRAPH_WEIGHTS, 0.5), ["Brand#1"]), G.vertices(mention(spark, d, distinct=False)), "Brand#1").withColumn("weight", F.round("weight", 6))


@query("L05_degree", ALL + "SELECT id, count(dst) AS degree, round(count(dst) / ((SELECT count(*) FROM vertex) - 1)::DOUBLE, 6) AS centrality FROM vertex LEFT JOIN sym ON src = id GROUP BY id")
def l05(spark, d):
    v, e = both(spark, d)
    return G.degree(v, e).withColumn("centrality", F.round("centrality", 6))


@query("L06_weight_statistics", ALL + "SELECT round(avg(weight), 6) AS mean, round(stddev_pop(weight), 6) AS sd, round(corr(papers, weight), 6) AS r, count_if(papers <> weight) AS differ FROM edge")
def l06(spark, d):
    return edges(spark, d).agg(F.round(F.avg("weight"), 6).alias("mean"), F.round(F.stddev_pop("weight"), 6).alias("sd"), F.round(F.corr("papers", "weight"), 6).alias("r"), F.count_if(C("papers") != C("weight")).alias("differ"))


@query(
    "L07_components",
    "WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS a, 'c' || (c_custkey - c_custkey % 7) AS b FROM customer), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS c FROM s UNION SELECT r.id, s.b FROM r JOIN s ON r.c = s.a) SELECT id, min(c) AS component FROM r GROUP BY id HAVING count(*) >= 3",
)
def l07(spark, d):
    """Components of three vertices or more; a vertex with itself alone has no edge."""
    k = C("c_custkey")
    e = table(spark, d, "customer").select(F.concat(F.lit("c"), k).alias("src"), F.concat(F.lit("c"), k - k % 7).alias("dst"), F.lit(1).alias("papers"), F.lit(1.0).alias("weight"))
    c = G.components(e)
    large = c.groupBy("component").agg(F.count("*").alias("n")).where("n >= 3")
    return c.join(large, "component").select("id", "component")


CHAIN = "WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS a, 'c' || (c_custkey - c_custkey % 7) AS b FROM customer WHERE c_custkey % 5 < 2), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS c FROM s UNION SELECT r.id, s.b FROM r JOIN s ON r.c = s.a), n AS (SELECT id, count(*) AS n FROM r GROUP BY id) "


def chain(spark, d):
    k = C("c_custkey")
    return table(spark, d, "customer").where(k % 5 < 2).select(F.concat(F.lit("c"), k).alias("src"), F.concat(F.lit("c"), k - k % 7).alias("dst"), F.lit(1).alias("papers"), F.lit(1.0).alias("weight"))


@query("L07_induced_edges", CHAIN + "SELECT a AS src, b AS dst FROM e JOIN n ON id = a WHERE n >= 3")
def l07_edges(spark, d):
    return G.large_components(chain(spark, d), 3)[0].select("src", "dst")


@query("L07_dropped_vertices", CHAIN + "SELECT count(CASE WHEN n >= 3 THEN 1 END) AS kept, count(CASE WHEN n < 3 THEN 1 END) AS dropped FROM n")
def l07_dropped(spark, d):
    return G.large_components(chain(spark, d), 3)[1]


@query("L08_node_size", ALL + ", g AS (SELECT id, count(dst) AS degree FROM vertex LEFT JOIN sym ON src = id GROUP BY id) SELECT id, round(5 + 20.0 * degree / (SELECT max(degree) FROM g), 4) AS size FROM g")
def l08(spark, d):
    v, e = both(spark, d)
    g = cut(G.degree(v, e))  # read for the largest and for all
    return g.crossJoin(F.broadcast(g.agg(F.max("degree").alias("hi")))).select("id", F.round(5 + 20.0 * C("degree") / C("hi"), 4).alias("size"))


ALIAS = "alias AS (SELECT split_part(p_name, ' ', 1) AS alias, p_brand AS canonical, p_partkey AS ord FROM part)"


def aliases(spark, d):
    return table(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("alias"), C("p_brand").alias("canonical"), C("p_partkey").alias("ord"))


@query("L10_last_alias", with_(ALIAS) + "SELECT alias, arg_max(canonical, ord) AS canonical FROM alias GROUP BY alias")
def l10(spark, d):
    return G.last_alias(aliases(spark, d))


@query("L10_unmatched", with_(ALIAS) + "SELECT DISTINCT split_part(p_name, ' ', 2) AS name FROM part WHERE split_part(p_name, ' ', 2) NOT IN (SELECT alias FROM alias)")
def l10_unmatched(spark, d):
    names = table(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name"))
    return G.unmatched(names, aliases(spark, d))


@query("L11_synonyms", "WITH n AS (SELECT DISTINCT p_partkey, unnest([p_brand, p_type, CASE WHEN p_size > 25 THEN p_name END]) AS name FROM part), m AS (SELECT * FROM n WHERE name IS NOT NULL) SELECT a.name, list_sort(list(DISTINCT b.name)) AS synonyms FROM m a JOIN m b ON a.p_partkey = b.p_partkey AND a.name <> b.name GROUP BY a.name")
def l11(spark, d):
    records = table(spark, d, "part").withColumn("third", F.when(C("p_size") > 25, C("p_name")))
    return G.synonyms(records, "p_partkey", ["p_brand", "p_type", "third"])


@query("L12_first_alias", with_(ALIAS) + ", f AS (SELECT alias, arg_min(canonical, ord) AS canonical FROM alias GROUP BY alias) SELECT x AS asked, coalesce(canonical, x) AS name FROM (SELECT unnest(['red', 'small', 'nothing']) AS x) LEFT JOIN f ON alias = x")
def l12(spark, d):
    asked = spark.createDataFrame([("red",), ("small",), ("nothing",)], "asked string")
    return asked.join(G.first_alias(aliases(spark, d)), C("asked") == C("alias"), "left").select("asked", F.coalesce("canonical", "asked").alias("name"))


CANCER, VARIANT = "SMALL", "red bolt"


def agreed(spark, d):
    """Labels of the variant's treatments, by the number in their names."""
    brands = table(spark, d, "part").select("p_brand").distinct()
    k = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 4
    label = F.when(k == 0, F.lit("Resistant")).when(k == 1, F.lit("No consensus")).otherwise(F.lit("Sensitive"))
    return brands.select(F.concat(F.lit(f"{VARIANT} + "), F.lower("p_brand")).alias("pair"), label.alias("resolved"))


@query(
    "L13_network_query",
    ALL
    + f""", agreed AS (SELECT DISTINCT p_brand, CASE regexp_extract(p_brand, '(\\d+)', 1)::INT % 4 WHEN 0 THEN 'Resistant' WHEN 1 THEN 'No consensus' ELSE 'Sensitive' END AS resolved FROM part),
    wc AS (SELECT dst AS name, weight FROM sym WHERE src = '{CANCER}'), wv AS (SELECT dst AS name, weight FROM sym WHERE src = '{VARIANT}'),
    rows AS (SELECT 'cancer' AS section, name, weight, 300.0 AS least FROM wc JOIN vertex ON id = name WHERE category = 'Treatment'
      UNION ALL SELECT lower(resolved), wc.name, wc.weight + wv.weight, 300.0 FROM wc JOIN vertex ON id = wc.name JOIN wv ON wv.name = wc.name JOIN agreed ON p_brand = wc.name WHERE category = 'Treatment' AND resolved IN ('Sensitive', 'Resistant')
      UNION ALL SELECT 'other cancer', wv.name, wv.weight + coalesce(wc.weight, 0), 80.0 FROM wv JOIN vertex ON id = wv.name LEFT JOIN wc ON wc.name = wv.name WHERE category = 'Cancer' AND id <> '{CANCER}'),
    cut AS (SELECT section, quantile_cont(weight, 0.8) AS cut FROM rows GROUP BY section),
    ranked AS (SELECT r.*, cut, row_number() OVER (PARTITION BY r.section ORDER BY round(weight, 6) DESC, name) AS rank FROM rows r JOIN cut ON cut.section = r.section)
    SELECT section, name, rank::INT AS rank, round(weight, 6) AS weight, round(weight, 6) >= round(cut, 6) AND weight >= least AS highlight FROM ranked WHERE rank <= 6""",
)
def l13(spark, d):
    edge = cut(G.edges_of(mention(spark, d), O.with_weight(study(spark, d), V.GRAPH_WEIGHTS, 0.5), [CANCER, VARIANT]).withColumn("weight", F.round("weight", 6)))
    out = G.network_query(edge, cut(G.vertices(mention(spark, d, distinct=False))), agreed(spark, d), CANCER, VARIANT)
    return out.withColumn("weight", F.round("weight", 6))


@query(
    "N01_parent_chain",
    """WITH RECURSIVE isa AS (SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'world' FROM region UNION ALL SELECT 'world', 'AFRICA'),
    r AS (SELECT child AS id, parent, 1 AS depth, [child, parent] AS seen FROM isa UNION ALL SELECT r.id, isa.parent, r.depth + 1, list_append(r.seen, isa.parent) FROM r JOIN isa ON isa.child = r.parent WHERE NOT list_contains(r.seen, isa.parent))
    SELECT id, parent, depth FROM r""",
)
def n01(spark, d):
    """Parents of parents, with a cycle at the root."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), C("n_regionkey") == C("r_regionkey")).select(C("n_name").alias("child"), C("r_name").alias("parent"))
    r = table(spark, d, "region").select(C("r_name").alias("child"), F.lit("world").alias("parent"))
    root = spark.createDataFrame([("world", "AFRICA")], "child string, parent string")
    return G.parents_of(spark, n.unionByName(r).unionByName(root).withColumn("ord", F.lit(1)))


def turns_sql(rounds: int) -> str:
    """Label propagation, a common table a turn."""
    ctes = ["t0 AS MATERIALIZED (SELECT DISTINCT src AS id, src AS community FROM near)"]
    for k in range(1, rounds + 1):
        half = f"CASE WHEN md5(id)[1] < '8' THEN 1 ELSE 0 END = {k % 2}"
        ctes.append(f"t{k} AS MATERIALIZED (SELECT id, CASE WHEN {half} THEN best ELSE community END AS community FROM t{k - 1} JOIN (SELECT src AS id, arg_min(community, (-w, community)) AS best FROM (SELECT src, community, round(sum(weight), 6) AS w FROM near JOIN t{k - 1} ON dst = id GROUP BY ALL) GROUP BY src) USING (id))")
    return ", ".join(ctes)


STRONG = ", strong AS (SELECT src, dst, weight FROM edge WHERE weight > (SELECT avg(weight) FROM edge) AND src NOT LIKE 'Brand%' AND dst NOT LIKE 'Brand%'), near AS MATERIALIZED (SELECT src, dst, weight FROM strong UNION ALL SELECT dst, src, weight FROM strong), " + turns_sql(6)


def strong(spark, d):
    """Edges heavier than the mean, brands left aside."""
    e = cut(edges(spark, d).select("src", "dst", "weight"))
    mean = e.agg(F.avg("weight").alias("mean"))
    return e.crossJoin(F.broadcast(mean)).where((C("weight") > C("mean")) & ~C("src").startswith("Brand") & ~C("dst").startswith("Brand")).drop("mean")


@query("J15_communities", ALL + STRONG + " SELECT id, community FROM t6")
def j15(spark, d):
    return K.communities(strong(spark, d), rounds=6)


@query("J15_modularity", ALL + STRONG + ", c AS (SELECT c, sum(weight) AS degree, sum(inside) AS inside FROM (SELECT unnest([x.community, y.community]) AS c, weight, CASE WHEN x.community = y.community THEN weight ELSE 0 END AS inside FROM strong JOIN t6 x ON x.id = src JOIN t6 y ON y.id = dst) GROUP BY c) SELECT count(*) AS communities, round(sum(inside / (SELECT sum(degree) FROM c) - pow(degree / (SELECT sum(degree) FROM c), 2)), 6) AS modularity FROM c")
def j15_modularity(spark, d):
    e = cut(strong(spark, d))
    return K.modularity(e, K.communities(e, rounds=6)).withColumn("modularity", F.round("modularity", 6))


@query("J15_kmeans")
def j15_kmeans(spark, d):
    """Clusters of all vectors; its start is drawn by hashes that SQL has not, so tests hold it against a plain run."""
    return K.kmeans(table(spark, d, "embeddings"), 10)[0].select("vec_id", "cluster")
