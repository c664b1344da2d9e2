"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mentionmill.llm.common import Scratch


def _check(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]
    return row[0], row[1]


def connected_components(edges: DataFrame, rows_a_task: int = 20_000) -> DataFrame:
    """The smallest node reachable from each node of ``edges(a, b)``: ``node, component``.

    Large-star hangs the larger neighbours of every node under the smallest of
    its neighbourhood, small-star the smaller ones; both keep components whole
    and they end, in about the square of the logarithm of the nodes, in stars.
    Each step joins edges with one row a node, so that a hub is split among
    tasks, and is written to the shared folder, about ``rows_a_task`` edges a
    file; tables of finished steps are dropped. Loops and null nodes are
    dropped; an empty table gives an empty result.
    """
    scratch, step = Scratch(edges.sparkSession, "components"), 0
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = scratch.write("edges-0", edges)
    seen = _check(edges)
    while seen[0]:
        step += 1
        tasks = max(4, 1 + seen[0] // rows_a_task)  # follows the number of edges, however many partitions shuffles have
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m"))).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.write(f"large-{step}", large.coalesce(tasks))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = scratch.write(f"edges-{step}", small.unionByName(least.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks))
        scratch.drop(f"edges-{step - 1}", f"large-{step}")
        now = _check(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
