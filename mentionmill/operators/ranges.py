"""Order over a whole table without one task for it: ranges of the order, and what passes from one to the next."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionmill.runtime import cut, ship

#: Inner columns: the range of a row, its place within.
PART, AT = "_part", "_at"


def in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` dealt to ranges of ``order`` (columns that tell all rows apart), each numbered from 1 within; checkpointed, so that both stay as they are."""
    dealt = df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id())
    return cut(dealt.withColumn(AT, F.row_number().over(Window.partitionBy(PART).orderBy(*order)).cast("long")))


def _before(parts: DataFrame, *sums: str) -> DataFrame:
    """A row a range: what is before it. Ranges are as many as tasks, and their totals are gathered."""
    out, total = [], dict.fromkeys(sums)
    for r in sorted(parts.collect(), key=lambda r: r[PART]):
        out.append((r[PART], *total.values()))
        total = {c: r[c] if total[c] is None else total[c] if r[c] is None else total[c] + r[c] for c in sums}
    schema = ", ".join([f"{PART} int", *[f"{c} {parts.schema[c].dataType.simpleString()}" for c in sums]])
    return F.broadcast(parts.sparkSession.createDataFrame(out, schema).na.fill(0))


def numbered(df: DataFrame, *order: Column | str, name: str = "n") -> DataFrame:
    """``df`` and the number of each row along ``order``, from 1."""
    rows = in_ranges(df, *order)
    before = _before(rows.groupBy(PART).agg(F.count("*").alias("_n")), "_n")
    return rows.join(before, PART).withColumn(name, F.col(AT) + F.col("_n")).drop(PART, AT, "_n")


def running_sum(df: DataFrame, value: str, *order: Column | str, name: str = "running") -> DataFrame:
    """``df`` and the sum of ``value`` over all rows up to each along ``order``."""
    rows = in_ranges(df, *order)
    before = _before(rows.groupBy(PART).agg(F.sum(value).alias("_s")), "_s")
    upto = Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(before, PART).withColumn(name, F.sum(value).over(upto) + F.col("_s")).drop(PART, AT, "_s")


def running_min(df: DataFrame, value: str, *order: Column | str, name: str = "least") -> DataFrame:
    """``df`` and the least ``value`` of all rows up to each along ``order``; nulls are passed over."""
    rows = in_ranges(df, *order)
    kind, out, least = rows.schema[value].dataType.simpleString(), [], None
    for r in sorted(rows.groupBy(PART).agg(F.min(value).alias("m")).collect(), key=lambda r: r[PART]):  # a row a range
        out.append((r[PART], least))
        least = r["m"] if least is None else least if r["m"] is None else min(least, r["m"])
    before = F.broadcast(rows.sparkSession.createDataFrame(out, f"{PART} int, _m {kind}"))
    upto = Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    own = F.min(value).over(upto)
    return rows.join(before, PART).withColumn(name, F.least(own, F.col("_m"))).drop(PART, AT, "_m")


def tiles(df: DataFrame, n: int, *order: Column | str, name: str = "tile") -> DataFrame:
    """``df`` and the tile, from 1, of ``n`` tiles of even size along ``order``; the first ones take what is over."""
    total = df.count()
    size, over = divmod(total, n)
    out = numbered(df, *order, name="_row")
    wide = over * (size + 1)
    tile = F.when(F.col("_row") <= wide, F.ceil(F.col("_row") / (size + 1))).otherwise(over + F.ceil((F.col("_row") - wide) / max(size, 1)))
    return out.withColumn(name, tile.cast("int")).drop("_row")


def shifted(df: DataFrame, value: str, by: int, *order: Column | str, name: str = "shifted") -> DataFrame:
    """``df`` and ``value`` of the row ``by`` places earlier along ``order`` (later, if negative); null beyond the ends.

    Each range sends its last (first) rows, as many as ``by``, to those after
    (before) it, and looks its own rows up there.
    """
    rows = in_ranges(df, *order)
    before = _before(rows.groupBy(PART).agg(F.count("*").alias("_n")), "_n")
    rows = rows.join(before, PART).withColumn("_row", F.col(AT) + F.col("_n"))
    within, size, steps = Window.partitionBy(PART).orderBy(AT), F.count("*").over(Window.partitionBy(PART)), abs(by)
    rows = rows.withColumn("_own", F.lag(value, by).over(within) if by >= 0 else F.lead(value, steps).over(within)).withColumn("_size", size)
    edge = F.col(AT) > F.col("_size") - steps if by >= 0 else F.col(AT) <= steps
    border = rows.where(edge).select((F.col("_row") + by).alias("_row"), F.col(value).alias("_border"))  # steps rows a range
    out = rows.join(F.broadcast(border), "_row", "left")
    inside = F.col(AT) > steps if by >= 0 else F.col(AT) <= F.col("_size") - steps
    return out.withColumn(name, F.when(inside, F.col("_own")).otherwise(F.col("_border"))).drop(PART, AT, "_n", "_row", "_own", "_size", "_border")


def as_of(left: DataFrame, right: DataFrame, time: str, columns: list[str], right_time: str | None = None, by: str | None = None) -> DataFrame:
    """``left`` and, as ``<column>_as_of``, the ``columns`` of the latest row of ``right`` whose time is not after the left row's.

    Both tables are put into one order of (``by``, time), rows of ``right``
    first where times are equal (of several of one time, the last by the
    columns). The order is cut into ranges; each takes the last row of ``right``
    within it, and what it has not of its own comes from the ranges before it,
    one carried row each. No key is one task's, however many rows it has. Rows
    of ``left`` before any of ``right`` (of their ``by``) have nulls; a null
    time is as of nothing.
    """
    right_time = right_time or time
    group = F.col(by) if by else F.lit(0)
    held = F.struct(*[F.col(c) for c in columns])
    empty = F.lit(None).cast(right.select(held.alias("h")).schema["h"].dataType)
    one = left.select(group.alias("_by"), F.col(time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), empty.alias("_held"))
    none = F.lit(None).cast(one.schema["_row"].dataType)
    two = right.where(F.col(right_time).isNotNull()).select(group.alias("_by"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), none.alias("_row"), held.alias("_held"))
    rows = cut(one.unionByName(two).repartitionByRange("_by", "_t", "_side", "_held", F.xxhash64(F.to_json("_row"))).withColumn(PART, F.spark_partition_id()))
    mark = F.when(F.col("_side") == 0, F.struct(F.col("_by").alias("by"), F.col("_held").alias("held")))
    last = rows.where("_side = 0").groupBy(PART).agg(F.max(F.struct("_by", "_t", "_held")).alias("last")).collect()  # a row a range
    carried, latest, ends = [], None, {r[PART]: r["last"] for r in last}
    for part in range(rows.select(F.max(PART)).first()[0] + 1 if not rows.isEmpty() else 0):
        if latest is not None:
            carried.append((part, (latest["_by"], latest["_held"])))
        latest = ends.get(part, latest)
    kind = rows.select(mark.alias("m")).schema["m"].dataType.simpleString()
    border = rows.sparkSession.createDataFrame(carried, f"{PART} int, _carried {kind}")
    upto = Window.partitionBy(PART).orderBy("_by", "_t", "_side", "_held").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_seen", F.last(mark, ignorenulls=True).over(upto)).where("_side = 1").join(F.broadcast(border), PART, "left")
    best = F.coalesce("_seen", "_carried")
    told = F.when(best["by"].eqNullSafe(F.col("_by")) & F.col("_t").isNotNull(), best["held"])
    return seen.select("_row.*", *[told[c].alias(f"{c}_as_of") for c in columns])


def in_intervals(points: DataFrame, spans: DataFrame, time: str, start: str, end: str, bucket: int) -> DataFrame:
    """Rows of ``points`` joined with those of ``spans`` whose time is in ``[start, end)``, all numbers.

    Time is cut into buckets of ``bucket``: a span stands in each that it
    touches and a point in its own, and buckets are the keys of the join, so
    that points and spans far apart never meet. A bucket near the spans' usual
    length keeps both copies and meetings few. A pair meets once, since a point
    has one bucket.
    """
    one = points.where(F.col(time).isNotNull()).withColumn("_bucket", F.floor(F.col(time) / bucket).cast("long"))
    first, final = F.floor(F.col(start) / bucket).cast("long"), F.floor((F.col(end) - 1) / bucket).cast("long")
    two = spans.where(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(first, F.greatest(first, final))))
    return one.join(two, "_bucket").where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("_bucket")


def _weight_inside(t: np.ndarray, before: np.ndarray, weight: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each span, the weight of the points (sorted by ``t``) with ``t < end`` and ``before >= start``: a wavelet matrix, a pass a bit of the ranks of ``before``."""
    values, rank = np.unique(before, return_inverse=True)
    least, lo, hi = np.searchsorted(values, start), np.zeros(len(start), np.int64), np.searchsorted(t, end)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    out = np.zeros(len(start), np.int64)
    for b in reversed(range(int(len(values)).bit_length())):
        one = (rank >> b) & 1
        zeros, heavy = sums(1 - one), sums(weight * one)
        up = ((least >> b) & 1) == 1
        out += np.where(up, 0, heavy[hi] - heavy[lo])
        lo, hi = (np.where(up, zeros[-1] + x - zeros[x], zeros[x]) for x in (lo, hi))
        order = np.argsort(one, kind="stable")
        rank, weight = rank[order], weight[order]
    total = sums(weight)
    return out + total[hi] - total[lo]


def counted_in_intervals(points: DataFrame, spans: DataFrame, time: str, start: str, end: str, who: str, bucket: int, n: str = "n", distinct: str = "distinct") -> DataFrame:
    """``spans`` that have a point in ``[start, end)``, with the number of their points and of the points' different ``who``; times are whole numbers.

    No pair of a point and a span is made. A ``who`` counts in a span where its
    first point there is, so the different ones are the points (each ``who``
    once a time) less those whose ``who`` has its time before in the span too.
    Points of one time with the same time before are one row with its counts
    (times before longer ago than the longest span are alike), and equal spans
    are one: what a bucket holds is bounded by the square of the longest span,
    however many rows there are. Buckets of ``bucket`` are counted by
    themselves (a span in each that it touches) and added up. Null times and
    spans count nothing; a null ``who`` is a point of no one.
    """
    ship(points.sparkSession)
    longest = F.broadcast(spans.agg(F.max(F.col(end) - F.col(start)).alias("_longest")))
    t, none = F.col(time).cast("long"), F.lit(-(1 << 62))
    once = points.where(F.col(time).isNotNull()).groupBy(F.col(who).alias("_who"), t.alias("_t")).agg(F.count("*").alias("_n"))
    back = F.lag("_t").over(Window.partitionBy("_who").orderBy("_t"))
    back = F.when(F.col("_who").isNotNull(), back)
    rows = once.withColumn("_back", back).crossJoin(longest).withColumn("_back", F.when(F.col("_back") > F.col("_t") - F.col("_longest"), F.col("_back")).otherwise(none))
    rows = rows.groupBy("_t", "_back").agg(F.sum("_n").alias("_n"), F.count("_who").alias("_u")).withColumn("_bucket", F.floor(F.col("_t") / bucket).cast("long"))
    a, z = F.col(start).cast("long"), F.col(end).cast("long")
    first, final = F.floor(F.col("_a") / bucket).cast("long"), F.floor((F.col("_z") - 1) / bucket).cast("long")
    pieces = spans.where(a < z).select(a.alias("_a"), z.alias("_z")).distinct().select("_a", "_z", F.explode(F.sequence(first, final)).alias("_bucket"))

    def count(here: pa.Table, asked: pa.Table) -> pa.Table:
        here = here.sort_by("_t")
        t, back, n, u = (here[c].to_numpy() for c in ("_t", "_back", "_n", "_u"))
        a, z = asked["_a"].to_numpy(), asked["_z"].to_numpy()
        lo, hi = np.searchsorted(t, a), np.searchsorted(t, z)
        within = lambda w: (lambda s: s[hi] - s[lo])(np.concatenate([[0], np.cumsum(w)]))
        return pa.table({"_a": a, "_z": z, "_n": within(n), "_u": within(u) - _weight_inside(t, back, u, a, z)})

    told = rows.groupBy("_bucket").cogroup(pieces.groupBy("_bucket")).applyInArrow(count, "_a long, _z long, _n long, _u long")
    told = told.groupBy("_a", "_z").agg(F.sum("_n").alias(n), F.sum("_u").alias(distinct)).where(F.col(n) > 0)
    return spans.join(told, (a == F.col("_a")) & (z == F.col("_z"))).select(*spans.columns, n, distinct)


def exact_percentile(df: DataFrame, keys: list[str], value: str, share: float, most: int = 10_000, bins: int = 1024, name: str = "percentile") -> DataFrame:
    """``keys`` and the percentile of ``value`` with linear interpolation; exact, and no buffer grows with a group.

    The range that holds the two rows next to the place is narrowed by
    histograms of ``bins``, with counts by bin and nothing else, until a group's
    range has ``most`` rows or one value; only then are its rows ranked. Nulls
    are left out; a group without values is not in the result.
    """
    x = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*keys, x.alias("_x"))
    place = (F.col("_n") - 1) * F.lit(share)
    state = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).select(*keys, F.floor(place).alias("_first"), F.ceil(place).alias("_second"), (place - F.floor(place)).alias("_share"), "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_in")))

    def inside(state: DataFrame) -> DataFrame:
        met = rows.join(state, keys) if keys else rows.crossJoin(F.broadcast(state))
        return met.where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))

    wide = (F.col("_in") > most) & (F.col("_lo") < F.col("_hi"))
    while not state.where(wide).isEmpty():
        at = F.least(F.lit(bins - 1), F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)).cast("int")
        counts = inside(state.where(wide)).groupBy(*keys, "_first", "_second", "_share", "_below", at.alias("_bin")).agg(F.count("*").alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        upto = Window.partitionBy(*keys, "_first").orderBy("_bin")  # bins rows a group
        counts = counts.withColumn("_to", F.col("_below") + F.sum("_c").over(upto))
        held = (F.col("_to") > F.col("_first")) & (F.col("_to") - F.col("_c") <= F.col("_second"))
        narrow = counts.where(held).groupBy(*keys, "_first", "_second", "_share").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.min(F.col("_to") - F.col("_c")).alias("_below"), F.sum("_c").alias("_in"))
        state = cut(state.where(~wide).unionByName(narrow))
    ranked = inside(state).groupBy(*keys, "_first", "_second", "_share", "_below", "_x").agg(F.count("*").alias("_c"))
    ranked = ranked.withColumn("_to", F.col("_below") + F.sum("_c").over(Window.partitionBy(*keys, "_first").orderBy("_x")))
    at = lambda c: F.min(F.when(F.col("_to") > F.col(c), F.col("_x")))
    ends = ranked.groupBy(*keys, "_share").agg(at("_first").alias("_a"), at("_second").alias("_b"))
    return ends.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias(name))
