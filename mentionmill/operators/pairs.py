"""Pairs of the entities of a paper, with papers of many entities spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mentionmill.runtime import Scratch

#: Entities of a paper that are paired in one group; a heavier paper's entities are dealt to blocks of about as many.
LIGHT = 256


def blocked(rows: DataFrame, key: str, by: str, light: int | None = None) -> DataFrame:
    """``rows`` with ``blocks`` (one for each ``light`` rows of the key) and the row's ``block``, by a hash of ``by``.

    Only heavy keys are written down and met with the rows: they are as few as
    rows over ``light``.
    """
    light = light or LIGHT
    heavy = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > light).select(key, F.ceil(F.col("_n") / light).cast("int").alias("blocks"))
    out = rows.join(heavy, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return out.withColumn("block", F.pmod(F.xxhash64(by), F.col("blocks")).cast("int"))


def spread_pairs(left: DataFrame, right: DataFrame, key: str, a: str, b: str, light: int | None = None) -> DataFrame:
    """The rows of ``left`` joined with those of ``right`` on ``key``: all pairs of a key's rows.

    A key of n and m rows gives n times m pairs, which is what is asked for; but
    no task gets them all: where keys have more than ``light`` rows, both of
    their sides are dealt to blocks, every left block is sent to each right
    block, and pairs of blocks are the keys of the join. Such a row is repeated
    once for every block of the other side, so what is shuffled grows with the
    pairs divided by ``light``. Keys of few rows are joined as they are. Both
    tables are written once, as columns.
    """
    scratch, light = Scratch(left.sparkSession, "pairs"), light or LIGHT
    left, right = scratch.write("left", left), scratch.write("right", right)
    many = lambda d: d.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > light).select(key)
    heavy = scratch.write("heavy", many(left).unionByName(many(right)).distinct())
    if heavy.isEmpty():
        return left.join(right, key)
    few = left.join(heavy, key, "left_anti").join(right.join(heavy, key, "left_anti"), key)
    one, two = blocked(left.join(heavy, key, "left_semi"), key, a, light), blocked(right.join(heavy, key, "left_semi"), key, b, light)
    # What a side has to know is the number of the other side's blocks: heavy keys only.
    of_one, of_two = (d.where("blocks > 1").select(key, F.col("blocks").alias("_other")).distinct() for d in (one, two))
    one = one.join(of_two, key, "left").select(*left.columns, F.col("block").alias("_i"), F.explode(F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1)).alias("_j"))
    two = two.join(of_one, key, "left").select(*right.columns, F.col("block").alias("_j"), F.explode(F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1)).alias("_i"))
    return few.unionByName(one.join(two, [key, "_i", "_j"]).drop("_i", "_j"))


def unordered_pairs(rows: DataFrame, key: str, name: str, *more: str, light: int | None = None) -> DataFrame:
    """``key, src, dst`` with ``src < dst`` and the columns ``more``, which depend on the key: all pairs of a key's names; ``rows(key, name)`` are distinct.

    A key's names are put in order and gathered ``light`` at a time; these
    blocks are written once, and a block's own pairs are made in its row, so
    that rows that lie together by key are not shuffled again. Only keys of
    several blocks are joined: a pair of blocks is a key of that join, so a
    block is repeated once a block of its key and no task gets a heavy key's pairs.
    """
    return pairs_of(packed(rows, key, name, *more, light=light), key, *more)


def packed(rows: DataFrame, key: str, name: str, *more: str, light: int | None = None) -> DataFrame:
    """``key``, ``more``, ``block`` from 0, ``names``: the names of a key in order, ``light`` to a block."""
    place = F.row_number().over(Window.partitionBy(key).orderBy("_name"))
    rows = rows.where(F.col(key).isNotNull() & F.col(name).isNotNull()).select(key, F.col(name).alias("_name"), *more)
    rows = rows.withColumn("block", F.floor((place - 1) / (light or LIGHT)).cast("int"))
    return rows.groupBy(key, *more, "block").agg(F.sort_array(F.collect_list("_name")).alias("names"))


def pairs_of(blocks: DataFrame, key: str, *more: str) -> DataFrame:
    """The pairs of the names of each key of :func:`packed`."""
    blocks = Scratch(blocks.sparkSession, "pairs").write("blocks", blocks)
    later = F.explode(F.slice("names", F.col("_at") + 2, F.size("names"))).alias("dst")
    own = blocks.select(key, *more, "names", F.posexplode("names").alias("_at", "src")).select(key, "src", later, *more)
    heavy = blocks.where("block > 0").groupBy(key).agg((F.max("block") + 1).alias("_blocks"))
    if heavy.isEmpty():
        return own
    met = blocks.join(heavy, key).repartition(key, "block").select(key, *more, "names", "block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    low, high = F.least("block", "_other").alias("_i"), F.greatest("block", "_other").alias("_j")
    sides = met.where("block <> _other").select(key, *more, "names", "block", low, high)
    one = sides.where("block = _i").select(key, "_i", "_j", F.col("names").alias("_a"), *more)
    two = sides.where("block = _j").select(key, "_i", "_j", F.col("names").alias("_b"))
    across = one.join(two, [key, "_i", "_j"]).select(key, F.explode("_a").alias("src"), "_b", *more)
    return own.unionByName(across.select(key, "src", F.explode("_b").alias("dst"), *more))
