"""What several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionmill.runtime import Scratch, cut, shared_folder, ship

__all__ = ["LAST", "SEPARATORS", "WORD", "Scratch", "apart", "ascii_lower", "cut", "named", "order_id", "shared_folder", "ship", "table", "tidy", "trimmed"]

#: Separators of the contracts' words: space and the ASCII controls from tab to carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = 9223372036854775807


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *caches: dict) -> Callable:
    """``run`` for one task, after which its Python worker gives memory back.

    Workers are used again by later stages of the same application, and several
    wait beside each executor: what one keeps, all later stages pay for.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for c in caches:
                c.clear()
            give_back()

    return task


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def apart(df: DataFrame, text_col: str, replaced: tuple[str, ...]) -> tuple[DataFrame, Callable[[Column], list[Column]]]:
    """``__own`` (a struct of the columns besides the text and those ``replaced``) and ``__text``, so that no name clashes with inner ones.

    The function gives the columns back in their order, with the text it is given.
    """
    names = [c for c in df.columns if c not in replaced]
    others = [c for c in names if c != text_col]
    own = F.struct(*[named(c) for c in others]) if others else F.struct(F.lit(0).alias("none"))
    return df.select(own.alias("__own"), named(text_col).alias("__text")), lambda text: [(text if c == text_col else F.col("__own")[c]).alias(c) for c in names]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def trimmed(line: Column) -> Column:
    """Strip the separators from both ends."""
    return F.btrim(line, F.lit(SEPARATORS))


def order_id(name: str) -> Column:
    """An integer id for comparisons; a missing one comes last."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST))
