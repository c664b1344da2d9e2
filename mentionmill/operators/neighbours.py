"""The graph of nearest vectors: a forest of balanced random-hyperplane cells, and exact ranking within cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from mentionmill.runtime import Scratch, ship

#: Cut values up to this many are sent out; more are joined.
FEW = 10_000


def units(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one; zero vectors stay."""
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    norm = np.sqrt((v * v).sum(1))[:, None]
    return v / np.where(norm > 0, norm, 1)


def cells(vectors: DataFrame, trees: int, leaf: int, seed: int, scratch: Scratch) -> DataFrame:
    """``id, tree, cell``: in every tree, cells of ``leaf`` vectors at most.

    Each level of a tree has a random direction; cells that are still too large
    are cut at the middle of their projections on it, so that halves are even
    whatever the shape of the data. Equal vectors are told apart by a hash of
    their ids, so a group of copies is cut like any other.
    """
    n, size = vectors.agg(F.count("*"), F.max(F.size("v"))).collect()[0]
    levels = 2 + max(0, math.ceil(math.log2(max(1, n) / leaf)))
    directions = np.random.default_rng(seed).standard_normal((size or 1, trees * levels)) / math.sqrt(size or 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = (units(b.column(1)) @ directions).reshape(-1, levels)  # a row for each vector and tree
            ids = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), trees)))
            lists = pa.ListArray.from_arrays(np.arange(0, at.size + 1, levels, dtype=np.int32), pa.array(at.ravel()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(trees, dtype=np.int32), b.num_rows)), lists], ["id", "tree", "at"])

    schema = StructType([vectors.schema["id"], StructField("tree", IntegerType()), *StructType.fromDDL("at array<double>").fields])
    shake = F.pmod(F.xxhash64("id", "tree"), F.lit(1 << 20)) * 1e-13
    state = scratch.write("level-0", vectors.select("id", "v").mapInArrow(run, schema).withColumn("cell", F.lit(0).cast("long")).withColumn("shake", shake))
    for level in range(levels):
        value = F.col("at")[level] + F.col("shake")
        cuts = state.groupBy("tree", "cell").agg(F.count("*").alias("n"), F.percentile_approx(value, 0.5, 2000).alias("cut")).where(F.col("n") > leaf).select("tree", "cell", "cut")
        cuts = scratch.write(f"cuts-{level}", cuts)
        open_ = len(cuts.limit(FEW + 1).collect())
        if not open_:
            break
        state = state.join(F.broadcast(cuts) if open_ <= FEW else cuts.hint("merge"), ["tree", "cell"], "left")  # many cells hold few rows each
        state = scratch.write(f"level-{level + 1}", state.select("id", "tree", "at", "shake", (F.col("cell") * 2 + F.coalesce((value > F.col("cut")).cast("int"), F.lit(0))).alias("cell")))
        scratch.drop(f"level-{level}")
    return state.select("id", "tree", "cell")


def neighbour_graph(vectors: DataFrame, k: int = 15, trees: int = 16, leaf: int = 1024, seed: int = 1, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id_col, neighbour, rank, cosine``: the ``k`` nearest other vectors by cosine to every vector, among those that share a cell with it in any tree.

    All rows are queries. Cells are groups of ``leaf`` rows at most, in which
    rows are compared exactly and the best ``k`` of each kept; the best of all
    trees are ranked by cosine, then by id. Work and shuffle are in proportion
    to the rows (times ``trees``), never to their square. What a neighbour's
    chance to share a cell is depends on the data: ``recall`` measures it.
    Vectors have one length; null vectors are left out; ids are unique.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "neighbours")
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v"))
    if rows.isEmpty():
        return rows.select(F.col("id").alias(id_col), F.col("id").alias("neighbour"), F.lit(1).alias("rank"), F.lit(1.0).alias("cosine"))
    placed = cells(rows, trees, leaf, seed, scratch).join(rows, "id")
    schema = StructType([placed.schema["id"], StructField("neighbour", placed.schema["id"].dataType), StructField("cosine", DoubleType())])

    def nearest(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("id").combine_chunks()
        ids, u = cell["id"].combine_chunks(), units(cell["v"].combine_chunks())
        c = np.round(u @ u.T, 12)
        np.fill_diagonal(c, -2)
        m = min(k, len(u) - 1)
        best = np.argsort(-c, axis=1, kind="stable")[:, :m]
        row = np.repeat(np.arange(len(u)), m)
        return pa.table({"id": ids.take(pa.array(row)), "neighbour": ids.take(pa.array(best.ravel())), "cosine": pa.array(c[row, best.ravel()])})

    met = placed.select("tree", "cell", "id", "v").groupBy("tree", "cell").applyInArrow(nearest, schema)
    met = met.groupBy("id", "neighbour").agg(F.max("cosine").alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour"))  # trees times k rows at most
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("id").alias(id_col), "neighbour", "rank", "cosine")


def recall(graph: DataFrame, exact: DataFrame, id_col: str = "vec_id", query: str = "query", neighbour: str = "vec_id") -> float:
    """The share of the true neighbours (rows of ``exact``) that the graph has."""
    true = exact.select(F.col(query).alias("q"), F.col(neighbour).alias("m"))
    found = true.join(graph.select(F.col(id_col).alias("q"), F.col("neighbour").alias("m")), ["q", "m"], "left_semi").count()
    return found / max(1, true.count())
