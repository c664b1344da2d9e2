"""Exact tests and false-discovery control on sparse cells."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from mentionmill.operators.ranges import running_min, running_sum
from mentionmill.runtime import cut


#: Logarithms below which a share of the likeliest table's probability is nothing in double precision.
FAINT = -750.0


def _ratios(row: int, col: int, n: int, mode: int, last: int) -> np.ndarray:
    """Logarithms of the probabilities of ``mode``, and on to ``last``, over that of ``mode``, as far as they are not nothing (some 40 standard deviations)."""
    step, parts, at, size = (1 if last >= mode else -1), [np.zeros(1)], mode, 1024
    while at != last and parts[-1][-1] > FAINT:
        k = np.arange(at, at + step * min(size, abs(last - at)), step, dtype=float)
        if step > 0:
            logs = np.log(row - k) + np.log(col - k) - np.log(k + 1) - np.log(n - row - col + k + 1)
        else:
            logs = np.log(k) + np.log(n - row - col + k) - np.log(row - k + 1) - np.log(col - k + 1)
        parts.append(parts[-1][-1] + np.cumsum(logs))
        at, size = at + step * len(k), size * 2
    return np.concatenate(parts)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """The probability of tables no likelier than ``[[a, b], [c, d]]`` with its margins.

    Probabilities are taken over that of the likeliest table, on both sides
    until they are nothing in double precision: memory grows with the standard
    deviation, which is the root of the counts, not with the counts.
    """
    row, col, n = a + b, a + c, a + b + c + d
    low, high = max(0, row + col - n), min(row, col)
    mode = min(high, max(low, (row + 1) * (col + 1) // (n + 2)))
    up, down = _ratios(row, col, n, mode, high), _ratios(row, col, n, mode, low)
    own, far = (up, a - mode) if a >= mode else (down, mode - a)
    if far >= len(own):
        return 0.0  # less than a double can tell
    logs = np.concatenate([down[:0:-1], up])
    each = np.exp(logs)
    return float(min(1.0, each[logs <= own[far] + 1e-7].sum() / each.sum()))


@F.pandas_udf(DoubleType())
def fisher(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([fisher_two_sided(int(w), int(x), int(y), int(z)) for w, x, y, z in zip(a, b, c, d, strict=True)], dtype="float64")


def fisher_reference(cells: DataFrame, by: str = "raw") -> DataFrame:
    """``p`` of the published scores: table ``[[a, T - a], [T - a, T]]`` with ``a`` the cell cut to an integer and ``T`` the sum of all cells so cut.

    ``p`` depends on ``a`` and ``T`` only, so it is computed once for each value
    of ``a``. Cells of nothing have 1.
    """
    total = cells.agg(F.sum(F.col(by)).cast("bigint").alias("T"))
    values = cells.where(F.col(by) > 0).select(F.col(by).cast("bigint").alias("_a")).distinct().crossJoin(F.broadcast(total))
    values = values.select("_a", fisher(F.col("_a"), F.greatest(F.col("T") - F.col("_a"), F.lit(0)), F.greatest(F.col("T") - F.col("_a"), F.lit(0)), F.col("T")).alias("p"))
    return cells.withColumn("_a", F.when(F.col(by) > 0, F.col(by).cast("bigint"))).join(values, "_a", "left").withColumn("p", F.coalesce("p", F.lit(1.0))).drop("_a")


def fisher_margins(cells: DataFrame, n_a: DataFrame, n_b: DataFrame, papers: int) -> DataFrame:
    """``p`` of the table of papers with both, one and neither, once for each distinct table; ``n_a(a, n_a)`` and ``n_b(b, n_b)`` count papers."""
    out = cells.join(n_a, "a").join(n_b, "b")
    key, both = ["papers", "n_a", "n_b"], F.col("papers")
    rest = F.lit(papers) - F.col("n_a") - F.col("n_b") + both
    told = out.select(*key).distinct().withColumn("p", fisher(both, F.col("n_a") - both, F.col("n_b") - both, rest))
    return out.join(told, key)


def benjamini_hochberg(cells: DataFrame, tests: int, p: str = "p") -> DataFrame:
    """``p_adj`` among ``tests`` tests, of which those not listed have ``p`` 1.

    Works on the histogram of ``p``: rows of one value share their largest rank.
    Ranks and running minima are taken over ranges of ``p``, so that no task has
    all its values, as many as they are.
    """
    cells = cut(cells)  # for the histogram and for the answer
    bins = running_sum(cells.where(F.col(p).isNotNull()).groupBy(p).agg(F.count("*").alias("_n")), "_n", p, name="_rank")
    bins = running_min(bins.withColumn("_q", F.col(p) * tests / F.col("_rank")), "_q", F.desc(p), name="_least")
    return cells.join(bins.select(p, F.least(F.lit(1.0), "_least").alias("p_adj")), p)
