"""Near-duplicate embedding vectors: an epsilon grid order join.

Two unit vectors have a cosine of ``c`` or more if their distance is
``sqrt(2 - 2c)`` or less. Distinct vectors are projected on their leading
principal axes, sorted by the cells of a grid of that width on them, and cut
into runs. A run has a box: the least and largest coordinates of its vectors on
the axes, and of the length of what the axes leave over. Boxes further apart
than the distance hold no link. Intervals of runs are joined recursively from
the whole order down, boxes of intervals first; what is left is pairs of blocks,
each a task's group of bounded size, within which pairs of runs are looked at by
box again and then compared in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from mentionmill.llm.common import Scratch, ship, tidy
from mentionmill.llm.components import connected_components
from mentionmill.llm.vectors import finite, named

#: Vectors of a run, runs of a block, and intervals that one of the next level holds.
RUN, RUNS, FAN = 512, 16, 4
#: Partitions of the sorted order at most; their runs are cut while they stream by.
PARTITIONS = 10_000
#: Components that axes are computed on; a longer vector is placed by its first ones.
WIDTH = 256
#: Boxes have to be apart by this much more than the distance: projections are rounded.
SLACK = 1e-6
#: Cosines this near to the limit are computed again without rounding of the sums.
CLOSE = 1e-9


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The components of all lists, and where each list begins."""
    at = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), at


def units(column: pa.Array, width: int) -> np.ndarray:
    """Vectors scaled to length one, filled up with zeros (or cut) to ``width`` components."""
    flat, at = lists(column)
    size = np.diff(at)
    out, row = np.zeros((len(size), width)), np.repeat(np.arange(len(size)), size)
    lane = np.arange(len(flat)) - at[row]
    most = np.zeros(len(size))
    np.maximum.at(most, row, np.abs(flat))
    scaled = flat / most[row]  # no overflow of the squares
    norm = np.sqrt(np.bincount(row, weights=scaled * scaled, minlength=len(size)))
    inside = lane < width
    out[row[inside], lane[inside]] = scaled[inside] / norm[row[inside]]
    return out


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that each reaches by the links ``a - b``, itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while (up[x] != up[y]).any():
        low = np.minimum(up[x], up[y])
        np.minimum.at(up, up[x], low)
        np.minimum.at(up, up[y], low)
        while (up[up] != up).any():
            up = up[up]
    own = up != np.arange(len(nodes))
    return nodes[own], nodes[up[own]]


def _axes(classes: DataFrame, width: int, leading: int) -> np.ndarray:
    """The leading principal axes of all unit vectors, from sums of products by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for b in batches:
            u = units(b.column(0), width)
            u = np.concatenate([u, np.ones((len(u), 1))], axis=1)
            total += u.T @ u
        i, j = np.meshgrid(np.arange(width + 1), np.arange(width + 1), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "s"])

    sums = classes.select("v").mapInArrow(tidy(run), "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((width + 1, width + 1))
    for r in sums:
        total[r["i"], r["j"]] = r["s"]
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / n
    values, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return axes[:, np.argsort(-values)[:leading]]


def _placed(classes: DataFrame, axes: np.ndarray, reach: float) -> DataFrame:
    """Classes with their coordinates ``at`` (on the axes, and the length left over) and grid ``cells``."""
    width = len(axes)
    kept = classes.select("low", "n", "v")
    schema = StructType([*kept.schema.fields, *StructType.fromDDL("size int, at array<double>, cells array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = units(b.column(2), width)
            on = u @ axes
            left = np.sqrt(np.maximum(0, (u * u).sum(1) - (on * on).sum(1)))  # with components beyond the width left out on both sides
            at, step = np.concatenate([on, left[:, None]], axis=1), np.floor(on / reach).astype(np.int32)
            listed = lambda m: pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], b.column(2).value_lengths().cast(pa.int32()), listed(at), listed(step)], ["low", "n", "v", "size", "at", "cells"])

    return kept.mapInArrow(tidy(run), schema)


def _runs(placed: DataFrame, n: int, scratch: Scratch, run_rows: int, runs: int) -> DataFrame:
    """The order cut into runs of ``run_rows`` vectors of one length: ``run`` (numbered along the order), its vectors and its box."""
    numbers = StructType.fromDDL("lo array<double>, hi array<double>").fields
    schema = StructType([StructField("part", IntegerType()), StructField("k", LongType()), StructField("size", IntegerType()), StructField("lows", ArrayType(placed.schema["low"].dataType)), StructField("ns", ArrayType(LongType())), StructField("vs", placed.schema["v"].dataType), *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, held = 0, None

        def cut(t: pa.Table) -> pa.RecordBatch:
            nonlocal k
            at = t["at"].combine_chunks()
            m = at.flatten().to_numpy().reshape(len(t), -1)
            one = lambda values: pa.ListArray.from_arrays(np.array([0, len(values)], dtype=np.int32), values)
            k += 1
            return pa.RecordBatch.from_arrays(
                [t["part"][:1].combine_chunks(), pa.array([k - 1]), t["size"][:1].combine_chunks(), one(t["low"].combine_chunks()), one(t["n"].combine_chunks()), one(t["v"].combine_chunks().flatten()), one(pa.array(m.min(0))), one(pa.array(m.max(0)))],
                ["part", "k", "size", "lows", "ns", "vs", "lo", "hi"],
            )

        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            while len(held):
                size = held["size"].to_numpy()[: run_rows + 1]
                end = int(np.argmax(size != size[0])) if (size != size[0]).any() else min(len(size), run_rows)
                if end == len(held):  # more of it may follow
                    break
                yield cut(held.slice(0, end))
                held = held.slice(end)
        if held is not None and len(held):
            yield cut(held)

    order = ("size", "cells", "at", "n", "v")
    dealt = placed.repartitionByRange(min(PARTITIONS, math.ceil(n / (run_rows * runs))), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    table = scratch.write("runs", dealt.select("low", "n", "v", "size", "at", "part").mapInArrow(tidy(run), schema))
    counts = sorted((r["part"], r["count"]) for r in table.groupBy("part").count().collect())  # a row a partition
    first, offsets = 0, []
    for part, c in counts:
        offsets.append((part, first))
        first += c
    starts = table.sparkSession.createDataFrame(offsets, "part int, start long")
    return table.join(F.broadcast(starts), "part").withColumn("run", F.col("start") + F.col("k")).withColumn("block", F.floor(F.col("run") / runs).cast("long")).drop("part", "k", "start")


def _near_blocks(blocks: DataFrame, n_blocks: int, coordinates: int, reach: float, scratch: Scratch) -> DataFrame:
    """``a, b`` (``a`` not after ``b``): blocks whose boxes are within reach, by intervals of the order from the whole down."""
    least, most = [F.min(F.col("lo")[i]) for i in range(coordinates)], [F.max(F.col("hi")[i]) for i in range(coordinates)]
    apart = lambda x, y: F.zip_with(x, y, lambda p, q: F.greatest(p - q, F.lit(0.0)))
    gap = F.aggregate(F.zip_with(apart("lo_a", "hi_b"), apart("lo_b", "hi_a"), lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x)
    halves = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in range(FAN) for y in range(FAN)])).alias("p")
    pairs = blocks.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(range(max(1, math.ceil(math.log(max(n_blocks, 2), FAN))))):
        interval = F.floor(F.col("block") / FAN**level).cast("long").alias("i")
        box = blocks.groupBy(interval).agg(F.min("short").alias("short"), F.max("long").alias("long"), F.array(*least).alias("lo"), F.array(*most).alias("hi"))
        left, right = (box.select(F.col("i").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("short", "long", "lo", "hi")]) for c in ("a", "b"))
        pairs = pairs.select((F.col("a") * FAN).alias("a"), (F.col("b") * FAN).alias("b"), halves).select((F.col("a") + F.col("p.x")).alias("a"), (F.col("b") + F.col("p.y")).alias("b")).where("a <= b")
        near = (gap <= reach * reach) & (F.col("short_a") <= F.col("long_b")) & (F.col("short_b") <= F.col("long_a"))
        pairs = scratch.write(f"pairs-{level}", pairs.join(left, "a").join(right, "b").where(near).select("a", "b"))
    return pairs


def whole(v: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, which loses no digit, so that squares do not overflow."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None])


def linked(p: np.ndarray, q: np.ndarray, cosine: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of ``p`` and ``q`` (those of ``x`` and ``y`` at length one) have the cosine; values next to the limit are settled by sums without rounding."""
    c = p @ q.T
    hit = c >= cosine
    for i, j in np.argwhere(np.abs(c - cosine) < CLOSE):
        hit[i, j] = math.fsum(x[i] * y[j]) / math.sqrt(math.fsum(x[i] * x[i]) * math.fsum(y[j] * y[j])) >= cosine
    return hit


def _compare(cosine: float, reach: float, run_rows: int):
    """For one pair of blocks: ``node, links`` of vectors with links, and ``node, root`` of the classes that they form."""

    class Run:
        def __init__(self, run: int, size: int, n: np.ndarray, v: np.ndarray, lo: np.ndarray, hi: np.ndarray):
            self.size, self.n, self.lo, self.hi = size, n, lo, hi
            self.v = whole(v.astype(np.float64).reshape(len(n), size))
            self.u, self.names = self.v / np.sqrt((self.v * self.v).sum(1))[:, None], run * run_rows + np.arange(len(n))
            self.links = np.zeros(len(n), np.int64)

        def far(self, other: Run) -> bool:
            gap = np.maximum(0, np.maximum(self.lo - other.hi, other.lo - self.hi))
            return self.size != other.size or (gap * gap).sum() > reach * reach

    def runs_of(t: pa.Table) -> list[Run]:
        flat = lambda c: [x.values.to_numpy(zero_copy_only=False) for x in t[c]]
        return [Run(*x) for x in zip(t["run"].to_pylist(), t["size"].to_pylist(), flat("ns"), flat("vs"), flat("lo"), flat("hi"), strict=True)]

    def run(both: pa.Table) -> pa.Table:
        one, two = (runs_of(both.filter(pc.equal(both["side"], side))) for side in ("a", "b"))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k, p in enumerate(one):
            for q in two or one[k:]:
                if p.far(q):
                    continue
                hit = linked(p.u, q.u, cosine, p.v, q.v)
                if p is q:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                p.links += hit @ q.n
                if p is not q:
                    q.links += hit.T @ p.n
                i, j = np.nonzero(hit)
                found.append(stars(p.names[i], q.names[j]))
        if not found:
            return pa.table({"node": pa.array([], pa.int64()), "root": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        node, root = stars(*(np.concatenate(x) for x in zip(*found, strict=True)))
        names, links = (np.concatenate([getattr(r, c) for r in one + two]) for c in ("names", "links"))
        names, links = names[links > 0], links[links > 0]
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.table({"node": pa.concat_arrays([pa.array(node), pa.array(names)]), "root": pa.concat_arrays([pa.array(root), none(len(names))]), "links": pa.concat_arrays([none(len(node)), pa.array(links)])})

    return run


def near_vectors(df: DataFrame, cosine: float = 0.9, leading: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", run_rows: int = RUN, runs: int = RUNS) -> DataFrame:
    """The id and ``n_links, component_id, kept`` of every row.

    Two vectors of one length are linked if their cosine, in double, is
    ``cosine`` or more. ``n_links`` counts linked other rows, ``component_id``
    is the smallest id reachable by links, itself included (null ids are
    passed over), and one row of each id that names its component is kept.

    Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing and are kept. Equal vectors are compared once: a class of
    them counts as its rows. Repeated ids are rows of their own; a row without
    an id has a null component unless it is linked to one that has. An empty
    table gives an empty result. Columns besides the two are not read.

    A task compares two blocks of ``run_rows * runs`` vectors at most. Vectors
    that hardly differ on any few axes leave nothing to skip, and then all
    pairs of blocks are compared: the order saves only what the data's shape
    lets it.
    """
    spark = df.sparkSession
    ship(spark)
    scratch, reach = Scratch(spark, "near-vectors"), math.sqrt(2 - 2 * cosine) + SLACK
    vector = named(vector_col)
    usable = finite(vector) & F.exists(vector, lambda x: x != 0)
    rows = df.select(named(id_col).alias("id"), F.when(F.coalesce(usable, F.lit(False)), vector).alias("v"))
    classes = scratch.write("classes", rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("n")))
    n, longest, total = classes.agg(F.count("*"), F.max(F.size("v")), F.sum("n")).collect()[0]
    alone = lambda d: d.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return alone(rows)
    axes = _axes(classes, min(longest, WIDTH), min(leading, longest))
    table = _runs(_placed(classes, axes, reach), n, scratch, run_rows, runs)
    extent = [F.array(*[f(F.col(c)[i]) for i in range(axes.shape[1] + 1)]).alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"))]
    blocks = scratch.write("boxes", table.groupBy("block").agg(F.min("size").alias("short"), F.max("size").alias("long"), *extent))
    pairs = _near_blocks(blocks, blocks.count(), axes.shape[1] + 1, reach, scratch)
    sides = [pairs.where(held).join(table.select(F.col("block").alias(c), "run", "size", "ns", "vs", "lo", "hi"), c).select("a", "b", F.lit(c).alias("side"), "run", "size", "ns", "vs", "lo", "hi") for c, held in (("a", "a <= b"), ("b", "a < b"))]
    found = sides[0].unionByName(sides[1]).groupBy("a", "b").applyInArrow(_compare(cosine, reach, run_rows), "node long, root long, links long")
    found = scratch.write("found", found)
    links = found.where("links IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("root IS NOT NULL").select(F.col("node").alias("a"), F.col("root").alias("b")))
    member = table.select("run", "size", "vs", F.posexplode(F.arrays_zip("lows", "ns")).alias("pos", "m"))
    member = member.select((F.col("run") * run_rows + F.col("pos")).alias("node"), F.slice("vs", F.col("pos") * F.col("size") + 1, F.col("size")).alias("v"), F.col("m.lows").alias("low"), F.col("m.ns").alias("n"))
    member = scratch.write("members", member.join(links, "node", "left").join(component, "node", "left").where("n > 1 OR links IS NOT NULL"))
    lowest = member.where("component IS NOT NULL").groupBy("component").agg(F.min("low").alias("lowest"), F.count("*").alias("size"))
    facts = with_hot(member, lowest, "component", "size", n).select("v", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.when(F.col("component").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component_id"))
    out = with_hot(rows, scratch.write("facts", facts), "v", "n", total)
    own = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))


def with_hot(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``facts``, one a key, of which ``weight`` counts the rows of the key among ``total``.

    Keys of more than a thousandth of all rows are a thousand at most: these are
    broadcast, and their rows stay where they are.
    """
    most = max(1000, total // 1000)
    heavy = F.broadcast(facts.where(F.col(weight) > most))
    rest = rows.join(heavy.select(key), key, "left_anti").join(facts.where(F.col(weight) <= most), key, "left")
    return rows.join(heavy, key).unionByName(rest)


SQL = """WITH RECURSIVE e AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS MATERIALIZED (SELECT n, vec_id, v FROM e WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.n AS a, b.n AS b FROM good a JOIN good b ON a.n <> b.n AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT a AS n, b AS m FROM link UNION SELECT reach.n, link.b FROM reach JOIN link ON link.a = reach.m),
low AS (SELECT reach.n, min(e.vec_id) AS m FROM reach JOIN e ON e.n = reach.m GROUP BY 1),
many AS (SELECT a AS n, count(*) AS k FROM link GROUP BY a),
told AS (SELECT e.vec_id, coalesce(k, 0) AS n_links, CASE WHEN m IS NULL OR e.vec_id < m THEN e.vec_id ELSE m END AS component_id FROM e LEFT JOIN many USING (n) LEFT JOIN low USING (n))
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM told"""
