"""Text embeddings: hashed TF-IDF reduced by a randomised singular value decomposition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from mentionmill.runtime import Scratch, ship

#: Entries of sparse rows that a task works on at once.
AT_ONCE = 50_000
WORD = r"(\w+)"


def hashed_words(text: Column, features: int) -> Column:
    """The feature of every word, in order; words are told apart by case-folded form and a 64-bit hash only."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(1))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))


def sparse_rows(words: pa.Array, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, feature, value`` of texts at unit length: one plus the logarithm of the count, by the weight of the feature."""
    size = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.repeat(np.arange(len(size)), size) * len(weight) + words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    row, feature = key // len(weight), key % len(weight)
    value = (1 + np.log(count)) * weight[feature]
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=len(size)))
    return row, feature, value / np.where(norm[row] > 0, norm[row], 1)


def times(rows: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, dense: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    row, feature, value = rows
    out = np.zeros((n, dense.shape[1]))
    for at in range(0, len(row), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        first = np.flatnonzero(np.diff(row[part], prepend=-1))
        out[row[part][first]] += np.add.reduceat(value[part, None] * dense[feature[part]], first, axis=0)
    return out


def times_transposed(rows: tuple[np.ndarray, np.ndarray, np.ndarray], dense: np.ndarray, out: np.ndarray) -> None:
    """Add the transposed sparse rows times ``dense`` to ``out``."""
    row, feature, value = rows
    order = np.argsort(feature, kind="stable")
    for at in range(0, len(order), AT_ONCE):
        part = order[at : at + AT_ONCE]
        first = np.flatnonzero(np.diff(feature[part], prepend=-1))
        out[feature[part][first]] += np.add.reduceat(value[part, None] * dense[row[part]], first, axis=0)


def _summed(rows: DataFrame, shape: tuple[int, int], add: Callable[[pa.Array, np.ndarray], None]) -> np.ndarray:
    """The sum over tasks of what ``add`` puts into a matrix of ``shape``: parameters bound it, not the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            add(b.column(0), total)
        used = np.flatnonzero(np.abs(total).sum(1))
        lists = pa.ListArray.from_arrays(np.arange(0, len(used) * shape[1] + 1, shape[1], dtype=np.int32), pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), lists], ["i", "v"])

    sums = rows.select("words").mapInArrow(run, "i long, v array<double>").select("i", F.posexplode("v").alias("j", "x"))
    rows_of = sums.groupBy("i", "j").agg(F.sum("x").alias("x")).groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "x"))).alias("v"))  # a row's lists are as long as shape says
    out = np.zeros(shape)
    for b in rows_of.toArrow().to_batches():
        out[b.column(0).to_numpy()] = b.column(1).flatten().field("x").to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
    return out


def text_vectors(texts: DataFrame, key: str, text: str = "text", dims: int = 64, features: int = 1 << 14, extra: int = 10, seed: int = 1) -> DataFrame:
    """``key, embedding``: ``dims`` components of every text at unit length, and all zeros for a text without words.

    Words are hashed to ``features``; counts and document frequencies make
    TF-IDF rows. Their leading right singular vectors come from two passes: one
    sums the rows' products with a random matrix (of ``dims + extra`` columns,
    from ``seed``), of which the driver makes an orthonormal basis; the other
    sums the small Gram matrix of the rows in that basis, whose eigenvectors
    turn it. A third pass gives the vectors. The driver holds matrices of
    ``features`` by ``dims + extra``, whatever the number of texts; equal seeds
    give equal vectors but for the rounding of sums.
    """
    spark = texts.sparkSession
    ship(spark)
    scratch = Scratch(spark, "text-vectors")
    rows = scratch.write("words", texts.select(F.col(key).alias("own"), hashed_words(F.col(text), features).alias("words")))
    n = rows.count()
    often = rows.select(F.explode(F.array_distinct("words")).alias("f")).groupBy("f").agg(F.count("*").alias("n")).toArrow()  # a row a feature at most
    weight = np.ones(features)
    weight[often["f"].to_numpy()] = 1 + np.log((1 + n) / (1 + often["n"].to_numpy()))
    width = min(dims + extra, features)
    start = np.random.default_rng(seed).standard_normal((features, width))

    def sketch(words: pa.Array, total: np.ndarray) -> None:
        a = sparse_rows(words, weight)
        times_transposed(a, times(a, len(words), start), total)

    basis = np.linalg.qr(_summed(rows, (features, width), sketch))[0]

    def gram(words: pa.Array, total: np.ndarray) -> None:
        b = times(sparse_rows(words, weight), len(words), basis)
        total += b.T @ b

    values, turn = np.linalg.eigh(_summed(rows, (width, width), gram))
    axes = basis @ turn[:, np.argsort(-values)[:dims]]
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])  # signs are free: the largest entry is positive
    axes = np.pad(axes, ((0, 0), (0, dims - axes.shape[1])))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = times(sparse_rows(b.column(1), weight), b.num_rows, axes)
            norm = np.sqrt((v * v).sum(1))[:, None]
            v = (v / np.where(norm > 0, norm, 1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(np.arange(0, v.size + 1, dims, dtype=np.int32), pa.array(v.ravel()))], ["own", "embedding"])

    schema = StructType([rows.schema["own"], StructField("embedding", ArrayType(FloatType()))])
    return rows.mapInArrow(placed, schema).withColumnRenamed("own", key)
