"""Lloyd's rounds with grouped lower bounds, over vectors cut into parts.

Every part has a codebook of its own (one part: plain clustering). Entries of a
codebook are put into groups once. A row carries, for each part, its entry, an
upper bound of the distance to it and one lower bound a group; when entries
move, bounds drift with them. A part is looked at only if its upper bound
reaches a lower bound, first with the drifted, then with the exact upper bound,
and then only the groups whose bound is reached are scanned, exactly, in
integers. Bounds that are equal count as reached, so ties are always settled in
integers and the result is that of comparing every row with every entry.

Rows live in tables of the shared folder, one a round; the two latest are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, ShortType, StructField, StructType

from mentionmill.llm.common import Scratch, ship, tidy
from mentionmill.llm.vectors import matrix, packed, unpacked

#: Products of smaller integers are exact in double, over 64 components and more.
EXACT = 1 << 21
#: Bounds are kept in single precision; this much slack covers every rounding.
SLACK = 1e-5


def squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows from all centers, exact, as long integers."""
    small = not (x.size and centers.size) or max(np.abs(x).max(), np.abs(centers).max()) < EXACT
    a, c = (x.astype(np.float64), centers.astype(np.float64)) if small else (x, centers)
    d = (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]
    return d.astype(np.int64)


def own_squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances row by row."""
    return ((x - centers) ** 2).sum(1)


def grouped(centers: np.ndarray, groups: int) -> list[np.ndarray]:
    """Entry numbers of each group, by a few rounds of clustering the entries themselves."""
    heads = centers[: max(1, min(groups, len(centers)))].astype(np.float64)
    for _ in range(5):
        near = ((centers[:, None, :] - heads[None, :, :]) ** 2).sum(2).argmin(1)
        heads = np.array([centers[near == g].mean(0) if (near == g).any() else heads[g] for g in range(len(heads))])
    return [np.flatnonzero(near == g) for g in range(len(heads)) if (near == g).any()]


def up(d2: np.ndarray) -> np.ndarray:
    return (np.sqrt(d2.astype(np.float64)) * (1 + SLACK)).astype(np.float32)


def down(d2: np.ndarray) -> np.ndarray:
    return (np.sqrt(d2.astype(np.float64)) * (1 - SLACK)).astype(np.float32)


def assign(x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray, centers: np.ndarray, groups: list[np.ndarray], drift: np.ndarray) -> int:
    """Bring one part's ``code``, ``upper`` and ``lower`` up to date with ``centers``, in place; how many distances were computed."""
    upper += (drift[code] * (1 + SLACK)).astype(np.float32)
    lower -= (np.array([drift[g].max() for g in groups]) * (1 + SLACK)).astype(np.float32)
    np.maximum(lower, 0, out=lower)
    least = lower.min(1) * np.float32(1 - SLACK)
    rows = np.flatnonzero(upper * np.float32(1 + SLACK) >= least)
    held = own_squares(x[rows], centers[code[rows]])
    upper[rows] = up(held)
    computed, reach = len(rows), upper[rows] >= least[rows]
    rows, held = rows[reach], held[reach]
    old, best, new = code[rows], held.copy(), code[rows].copy()
    scanned = []
    for g, members in enumerate(groups):
        at = np.flatnonzero(lower[rows, g] * np.float32(1 - SLACK) <= up(best))
        d2 = squares(x[rows[at]], centers[members])
        computed += d2.size
        lane, first = np.arange(len(at)), d2.argmin(1) if len(at) else np.zeros(0, dtype=np.int64)
        one, name = d2[lane, first], members[first]
        d2[lane, first] = np.iinfo(np.int64).max
        scanned.append((at, one, name, d2.min(1) if len(at) else one))
        better = (one < best[at]) | ((one == best[at]) & (name < new[at]))
        best[at[better]], new[at[better]] = one[better], name[better]
    left = new != old
    for g, (at, one, name, two) in enumerate(scanned):
        mine = np.flatnonzero(left & np.isin(old, groups[g]))  # the entry left behind bounds its group from now on
        lower[rows[mine], g] = np.minimum(lower[rows[mine], g], down(held[mine]))
        lower[rows[at], g] = down(np.where(name == new[at], two, one))
    code[rows], upper[rows] = new, up(best)
    return computed


class State:
    """Codes and bounds of rows as bytes: two for a code, four for each bound."""

    def __init__(self, parts: int, groups: int):
        self.parts, self.groups = parts, groups
        self.width = parts * (2 + 4 + 4 * groups)

    def fresh(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros((n, self.parts), np.int64), np.full((n, self.parts), np.inf, np.float32), np.zeros((n, self.parts, self.groups), np.float32)

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, p = unpacked(column, self.width), self.parts
        lane = lambda lo, hi, kind: np.ascontiguousarray(raw[:, lo:hi]).view(kind)
        return lane(0, 2 * p, np.uint16).astype(np.int64), lane(2 * p, 6 * p, np.float32).copy(), lane(6 * p, self.width, np.float32).reshape(len(raw), p, self.groups).copy()

    def write(self, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.Array:
        n = len(code)
        return packed(np.concatenate([code.astype(np.uint16).view(np.uint8).reshape(n, -1), upper.view(np.uint8).reshape(n, -1), lower.reshape(n, -1).view(np.uint8).reshape(n, -1)], axis=1))


def _moved(books: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.sqrt(((books - before).astype(np.float64) ** 2).sum(2)) * (1 + SLACK)


def _totals(rows: DataFrame, state: State, parts: int, k: int, dims: int) -> list:
    """``slot, pos, total, n`` of the entries in use: sums of each task first, then of all; at most one row a component of the codebooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, width = np.zeros((parts, k * dims), np.int64), np.zeros((parts, k), np.int64), parts * dims
        for b in batches:
            x, code = matrix(b.column(0), width).reshape(-1, parts, dims), state.read(b.column(1))[0]
            for p in range(parts):
                slots = (code[:, p, None] * dims + np.arange(dims)).ravel()
                total[p] += np.bincount(slots, weights=x[:, p].ravel(), minlength=k * dims).astype(np.int64)
                n[p] += np.bincount(code[:, p], minlength=k)
        used = np.flatnonzero(n.ravel())
        slot = np.repeat(used, dims)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.tile(np.arange(dims), len(used))), pa.array(total.reshape(-1, dims)[used].ravel()), pa.array(n.ravel()[slot])], ["slot", "pos", "total", "n"])

    sums = rows.select("v", "state").mapInArrow(tidy(run), "slot long, pos long, total long, n long")
    return sums.groupBy("slot", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()


def lloyd(vectors: DataFrame, start: np.ndarray, rounds: int, groups: int, job: str) -> tuple[DataFrame, np.ndarray, Scratch]:
    """``own, codes, distance`` of ``vectors(own, v)`` and the final codebooks.

    ``start`` has shape (parts, entries, components); ``v`` holds parts times
    components integers. Each round assigns every row, then replaces every
    entry in use by the componentwise floor of the mean of its rows; at the end
    rows are assigned once more. Nothing of the rows but sums by entry reaches
    the driver. ``own`` is any column that goes along.
    """
    spark = vectors.sparkSession
    ship(spark)
    parts, k, dims = start.shape
    scratch, books, before = Scratch(spark, job), start.astype(np.int64), start.astype(np.int64)
    groupings = [grouped(books[p], groups) for p in range(parts)]
    state, own = State(parts, max(len(g) for g in groupings)), vectors.schema["own"]
    kept = StructType([own, vectors.schema["v"], StructField("state", BinaryType())])
    told = StructType([own, StructField("codes", ArrayType(ShortType())), StructField("distance", LongType())])

    def step(books: np.ndarray, drift: np.ndarray, last: bool, fresh: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = matrix(b.column(1), parts * dims).reshape(-1, parts, dims)
                code, upper, lower = state.fresh(len(x)) if fresh else state.read(b.column(2))
                distance = np.zeros(len(x), np.int64)
                for p in range(parts):
                    mine, c, u, lo = np.ascontiguousarray(x[:, p]), code[:, p].copy(), upper[:, p].copy(), lower[:, p, : len(groupings[p])].copy()
                    assign(mine, c, u, lo, books[p], groupings[p], drift[p])
                    code[:, p], upper[:, p], lower[:, p, : len(groupings[p])] = c, u, lo
                    if last:
                        distance += own_squares(mine, books[p][c])
                if last:
                    codes = pa.ListArray.from_arrays(np.arange(0, len(x) * parts + 1, parts, dtype=np.int32), pa.array(code.ravel().astype(np.int16)))
                    yield pa.RecordBatch.from_arrays([b.column(0), codes, pa.array(distance)], ["own", "codes", "distance"])
                else:
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), state.write(code, upper, lower)], ["own", "v", "state"])

        return tidy(run)

    rows = vectors.select("own", "v")
    for r in range(rounds + 1):
        drift = _moved(books, before)
        done = step(books, drift, r == rounds, r == 0)
        if r == rounds:
            out = scratch.write("assigned", rows.mapInArrow(done, told))
            scratch.drop(f"round-{r - 1}")
            return out, books, scratch
        rows = scratch.write(f"round-{r}", rows.mapInArrow(done, kept))
        if r:
            scratch.drop(f"round-{r - 1}")
        before = books.copy()
        for s in _totals(rows, state, parts, k, dims):
            books[s["slot"] // k, s["slot"] % k, s["pos"]] = s["total"] // s["n"]
