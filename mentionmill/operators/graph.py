"""The co-occurrence graph and questions about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from mentionmill import fixed_values as V
from mentionmill.operators.pairs import packed, pairs_of
from mentionmill.runtime import cut

PRIORITY = {"Variant": 1, "Cancer": 2, "Treatment": 3, "Gene": 4}


def vertices(mentions: DataFrame) -> DataFrame:
    """``id, category``: a name of several categories has the first by priority."""
    rank = F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])
    return mentions.groupBy(F.col("entity").alias("id")).agg(F.min_by("category", rank[F.col("category")]).alias("category"))


def edges(mentions: DataFrame, studies: DataFrame, ordered: bool = False) -> DataFrame:
    """``src, dst, papers, weight`` with ``src < dst``: all pairs of names of a paper; ``ordered`` counts both orders."""
    blocks = packed(mentions.select("paper_id", "entity").distinct(), "paper_id", "entity").join(studies.select("paper_id", "weight"), "paper_id")
    pairs = pairs_of(blocks, "paper_id", "weight")
    times = 2 if ordered else 1
    return pairs.groupBy("src", "dst").agg((times * F.count("*")).alias("papers"), (times * F.sum("weight")).alias("weight"))


def edges_of(mentions: DataFrame, studies: DataFrame, names: list[str]) -> DataFrame:
    """The rows of ``edges`` with an end in ``names``: only papers that name one of them are joined, not all pairs of all papers."""
    m = mentions.select("paper_id", "entity").distinct()
    named = m.where(F.col("entity").isin(names)).withColumnRenamed("entity", "named")
    pairs = named.join(studies.select("paper_id", "weight"), "paper_id").join(m, "paper_id")
    pairs = pairs.where((F.col("named") < F.col("entity")) | ((F.col("named") > F.col("entity")) & ~F.col("entity").isin(names)))
    pairs = pairs.select(F.least("named", "entity").alias("src"), F.greatest("named", "entity").alias("dst"), "weight")
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("papers"), F.sum("weight").alias("weight"))


def symmetric(edge: DataFrame) -> DataFrame:
    return edge.unionByName(edge.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "papers", "weight"))


def neighbours(edge: DataFrame, vertex: DataFrame, of: str) -> DataFrame:
    near = symmetric(edge).where(F.col("src") == of).select(F.col("dst").alias("id"), "weight")
    return near.join(vertex, "id")


def degree(vertex: DataFrame, edge: DataFrame) -> DataFrame:
    """``id, degree, centrality``: neighbours, and as a share of all other vertices; vertices without edges have 0."""
    d = edge.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    n = vertex.agg(F.count("*").alias("_n"))
    out = vertex.select("id").join(d, "id", "left").crossJoin(F.broadcast(n))
    degree = F.coalesce("degree", F.lit(0))
    return out.select("id", degree.alias("degree"), F.coalesce(F.try_divide(degree, F.col("_n") - 1), F.lit(0.0)).alias("centrality"))


def components(edge: DataFrame) -> DataFrame:
    """``id, component``: the smallest name reachable, by smallest labels and jumps to the label's own label until nothing changes."""
    both = cut(symmetric(edge).select("src", "dst"))
    label = cut(both.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.col("src")).alias("component")))
    while True:
        near = both.join(label, both["dst"] == label["id"]).groupBy("src").agg(F.min("component").alias("m"))
        new = label.join(near, label["id"] == near["src"]).select("id", F.least("component", "m").alias("c"))
        jump = new.select(F.col("id").alias("j"), F.col("c").alias("next"))
        new = cut(new.join(jump, new["c"] == jump["j"]).select("id", F.least("c", "next").alias("component")))
        changed = new.join(label.withColumnRenamed("component", "old"), "id").where("component <> old").isEmpty()
        label = new
        if changed:
            return label


def large_components(edge: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The edges between vertices of components of ``least`` vertices or more, and ``kept, dropped``: how many vertices stay and go."""
    c = cut(components(edge))
    sizes = c.groupBy("component").agg(F.count("*").alias("_n"))
    large = c.join(sizes.where(F.col("_n") >= least), "component").select("id")
    kept = F.coalesce(F.sum(F.when(F.col("_n") >= least, F.col("_n"))), F.lit(0))
    counts = sizes.agg(kept.alias("kept"), (F.coalesce(F.sum("_n"), F.lit(0)) - kept).alias("dropped"))
    return edge.join(large, edge["src"] == large["id"], "left_semi"), counts  # both ends of an edge are of one component


def unmatched(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names (``name``) that no alias stands for, each once."""
    return names.select("name").distinct().join(aliases.select(F.col("alias").alias("name")), "name", "left_anti")


def last_alias(aliases: DataFrame) -> DataFrame:
    """The canonical name of each alias, the last by ``ord``."""
    return aliases.groupBy("alias").agg(F.max_by("canonical", "ord").alias("canonical"))


def first_alias(aliases: DataFrame) -> DataFrame:
    return aliases.groupBy("alias").agg(F.min_by("canonical", "ord").alias("canonical"))


def synonyms(records: DataFrame, record: str, names: list[str]) -> DataFrame:
    """``name, synonyms``: all names that stand in one record with a name, itself left out."""
    long = records.select(record, F.explode(F.array(*names)).alias("name")).where("name IS NOT NULL AND name <> ''").distinct()
    other = long.withColumnRenamed("name", "other")
    return long.join(other, record).where("name <> other").groupBy("name").agg(F.array_sort(F.collect_set("other")).alias("synonyms"))


def network_query(edge: DataFrame, vertex: DataFrame, consensus: DataFrame, cancer: str, variant: str, k: int = 6, percentile: float = 0.8, least_treatment: float = 300.0, least_cancer: float = 80.0) -> DataFrame:
    """What goes with a disease and a variant: rows ``section, name, weight, highlight``.

    Sections: the treatments strongest with the disease; those of them that the
    variant is sensitive or resistant to, by the sum of both weights; and other
    diseases by their weights with the variant and with the disease. Each has
    the top ``k``; highlighted are those at the percentile of all candidates and
    at the least weight. Of ``edge`` only rows with one of both names are read,
    see ``edges_of``.
    """
    both = symmetric(edge).select("src", "dst", "weight").where(F.col("src").isin(cancer, variant))
    both = cut(both)  # read several times below
    excluded = [t.lower() for t in V.EXCLUDED_TREATMENTS]
    treatments = vertex.where((F.col("category") == "Treatment") & ~F.lower("id").isin(excluded)).select("id")
    with_cancer = both.where(F.col("src") == cancer).join(treatments, F.col("dst") == F.col("id")).select(F.col("dst").alias("name"), F.col("weight").alias("wc"))
    with_variant = both.where(F.col("src") == variant).select(F.col("dst").alias("name"), F.col("weight").alias("wv"))
    agreed = consensus.select(F.col("pair").alias("_pair"), "resolved")
    joint = with_cancer.join(with_variant, "name").withColumn("_pair", F.concat_ws(" + ", F.lit(variant.lower()), F.lower("name"))).join(agreed, "_pair")
    cancers = vertex.where((F.col("category") == "Cancer") & (F.col("id") != cancer)).select("id")
    other = with_variant.join(cancers, F.col("name") == F.col("id")).join(both.where(F.col("src") == cancer).select(F.col("dst").alias("name"), F.col("weight").alias("wc")), "name", "left")
    parts = [
        with_cancer.select(F.lit("cancer").alias("section"), "name", F.col("wc").alias("weight"), F.lit(least_treatment).alias("least")),
        joint.where(F.col("resolved").isin("Sensitive", "Resistant")).select(F.lower("resolved").alias("section"), "name", (F.col("wc") + F.col("wv")).alias("weight"), F.lit(least_treatment).alias("least")),
        other.select(F.lit("other cancer").alias("section"), "name", (F.col("wv") + F.coalesce("wc", F.lit(0.0))).alias("weight"), F.lit(least_cancer).alias("least")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    cuts = rows.groupBy("section").agg(F.percentile("weight", F.lit(percentile)).alias("cut"))
    w = Window.partitionBy("section").orderBy(F.desc("weight"), "name")
    ranked = rows.join(cuts, "section").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("section", "name", "rank", "weight", ((F.col("weight") >= F.col("cut")) & (F.col("weight") >= F.col("least"))).alias("highlight"))


def parents_of(spark: SparkSession, is_a: DataFrame) -> DataFrame:
    """``id, parent, depth``: the chain of first parents, of any length, ended by a cycle or the root."""
    first = is_a.groupBy(F.col("child").alias("c")).agg(F.min_by("parent", "ord").alias("p"))
    found = first.select(F.col("c").alias("id"), F.col("p").alias("parent"), F.lit(1).alias("depth"), F.array("c", "p").alias("seen"))
    out, level = found, found
    while True:
        level = level.join(first, level["parent"] == first["c"]).where(~F.array_contains("seen", F.col("p")))
        level = cut(level.select("id", F.col("p").alias("parent"), (F.col("depth") + 1).alias("depth"), F.concat("seen", F.array("p")).alias("seen")))
        if level.isEmpty():
            return out.drop("seen")
        out = out.unionByName(level)
