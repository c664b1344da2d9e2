"""Clusters of vectors and communities of a graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from mentionmill.runtime import Scratch, ship


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest center of each row (ties: the first) and the squared distance."""
    d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)[None, :], 0)
    at = d.argmin(1)
    return at, ((x - centers[at]) ** 2).sum(1)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _told(rows: DataFrame, centers: np.ndarray) -> DataFrame:
    """``rows(id, u, v)`` with ``cluster`` and ``d2``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, d2 = nearest(matrix(b.column(2)), centers)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32)), pa.array(d2)], ["id", "u", "v", "cluster", "d2"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("cluster", IntegerType()), StructField("d2", DoubleType())]))


def _means(rows: DataFrame, centers: np.ndarray) -> np.ndarray:
    """The means of the rows nearest to each center; sums of tasks are summed. A center without rows stays."""
    k, dims = centers.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims)), np.zeros(k, np.int64)
        for b in batches:
            x = matrix(b.column(2))
            at = nearest(x, centers)[0]
            np.add.at(total, at, x)
            n += np.bincount(at, minlength=k)
        c, j = np.repeat(np.arange(k), dims), np.tile(np.arange(dims), k)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(j), pa.array(total.ravel()), pa.array(n[c])], ["c", "j", "s", "n"])

    schema = StructType([StructField("c", LongType()), StructField("j", LongType()), StructField("s", DoubleType()), StructField("n", LongType())])
    out = centers.copy()
    for r in rows.mapInArrow(run, schema).groupBy("c", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).where("n > 0").collect():  # a row a component
        out[r["c"], r["j"]] = r["s"] / r["n"]
    return out


def weighted_start(points: np.ndarray, weight: np.ndarray, k: int, seed: int, draws: int = 16) -> np.ndarray:
    """``k`` of the candidates, each drawn by its weight times its squared distance from those drawn before; the best of some draws."""
    best = (np.inf, points[:0])
    for n in range(draws):
        draw, chosen, share = np.random.default_rng((seed, n)), [], weight.astype(np.float64)
        while len(chosen) < min(k, len(points)) and share.sum() > 0:
            chosen.append(int(draw.choice(len(points), p=share / share.sum())))
            share = weight * nearest(points, points[chosen])[1]
        if share.sum() < best[0]:
            best = (share.sum(), points[chosen])
    return best[1]


def kmeans(vectors: DataFrame, k: int, rounds: int = 10, starts: int = 3, seed: int = 1, id_col: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``id_col, cluster, d2`` and the centers, by k-means||.

    The start: in each of ``starts`` passes every row is a candidate with a
    probability of ``2 k`` times its share of all squared distances (by a hash
    of id, pass and seed), so that some ``2 k`` come a pass, whatever the number
    of rows; candidates are weighed by the rows nearest to them and ``k`` of
    them drawn on the driver. Then ``rounds`` of assignment and means. Only
    candidates and sums reach the driver. Null vectors are left out; fewer
    distinct rows than ``k`` give fewer clusters.
    """
    ship(vectors.sparkSession)
    uniform = lambda n: (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(n)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), uniform(0).alias("u"), F.col(vector).alias("v"))
    rows = Scratch(vectors.sparkSession, "kmeans").write("rows", rows)
    first = [r["v"] for r in rows.orderBy("u", "id").limit(1).collect()]
    if not first:
        return _told(rows, np.zeros((1, 1))).select(F.col("id").alias(id_col), "cluster", "d2"), np.zeros((0, 0))
    points = np.array(first, dtype=np.float64)
    for n in range(1, starts + 1):
        told = _told(rows, points)
        total = told.agg(F.sum("d2")).first()[0]
        if not total:
            break
        chosen = told.where(uniform(n) < F.least(F.lit(1.0), 2 * k * F.col("d2") / F.lit(total))).orderBy("id").select("v").collect()  # some 2 k rows
        points = np.concatenate([points, np.array([r["v"] for r in chosen], dtype=np.float64).reshape(-1, points.shape[1])])
    points = np.unique(points, axis=0)
    weight = np.zeros(len(points))
    for r in _told(rows, points).groupBy("cluster").count().collect():
        weight[r["cluster"]] = r["count"]
    centers = weighted_start(points, weight, k, seed)
    for _ in range(rounds):
        centers = _means(rows, centers)
    return _told(rows, centers).select(F.col("id").alias(id_col), "cluster", "d2"), centers


def communities(edge: DataFrame, rounds: int = 20) -> DataFrame:
    """``id, community`` by label propagation over ``edge(src, dst, weight)``, each edge once.

    Every vertex starts as its own community. In turns, the vertices of one half
    (by the first digit of the MD5 of their names) take the community with the
    largest weight among their neighbours, the first by name of equal ones; a
    half at a time, so that two sides never swap for ever. It ends when neither
    half changes, or after ``rounds`` turns. Sums by vertex and community are
    combined before the shuffle, so a hub is not one task's.
    """
    scratch = Scratch(edge.sparkSession, "communities")
    both = scratch.write("edges", edge.select("src", "dst", "weight").unionByName(edge.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
    label, still = scratch.write("turn-0", both.select(F.col("src").alias("id"), F.col("src").alias("community")).distinct()), 0
    for turn in range(1, rounds + 1):
        half = (F.substring(F.md5(F.col("id").cast("string")), 1, 1) < "8").cast("int") == turn % 2
        pulls = both.join(label, both["dst"] == label["id"]).groupBy("src", "community").agg(F.round(F.sum("weight"), 6).alias("w"))
        best = pulls.groupBy("src").agg(F.min(F.struct(-F.col("w"), "community")).alias("b")).select(F.col("src").alias("id"), F.col("b.community").alias("best"))
        new = label.join(best, "id").select("id", F.when(half, F.col("best")).otherwise(F.col("community")).alias("community"), (half & (F.col("best") != F.col("community"))).alias("moved"))
        new = scratch.write(f"turn-{turn}", new)
        still = still + 1 if new.where("moved").isEmpty() else 0
        scratch.drop(f"turn-{turn - 1}")
        label = new.select("id", "community")
        if still == 2:
            break
    return label


def modularity(edge: DataFrame, community: DataFrame) -> DataFrame:
    """``communities, modularity``: the share of weight inside communities over what their degrees would give by chance."""
    one = edge.join(community.select(F.col("id").alias("src"), F.col("community").alias("a")), "src").join(community.select(F.col("id").alias("dst"), F.col("community").alias("b")), "dst")
    ends = one.select(F.explode(F.array("a", "b")).alias("c"), "weight", ((F.col("a") == F.col("b")).cast("int") * F.col("weight")).alias("inside"))
    each = ends.groupBy("c").agg(F.sum("weight").alias("degree"), F.sum("inside").alias("inside"))
    total = each.agg(F.sum("degree").alias("all"))
    return each.crossJoin(F.broadcast(total)).agg(F.count("*").alias("communities"), F.sum(F.col("inside") / F.col("all") - F.pow(F.col("degree") / F.col("all"), 2)).alias("modularity"))
