"""Series over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def per_period(df: DataFrame, date: str) -> DataFrame:
    """``kind, period, n``: rows a year, month and week (Monday to Sunday). Periods without rows are not listed."""
    week = F.date_trunc("week", date)
    kinds = F.array(
        F.struct(F.lit("year").alias("kind"), F.date_format(date, "yyyy").alias("period")),
        F.struct(F.lit("month").alias("kind"), F.date_format(date, "yyyy-MM").alias("period")),
        F.struct(F.lit("week").alias("kind"), F.concat_ws("/", F.date_format(week, "yyyy-MM-dd"), F.date_format(F.date_add(week, 6), "yyyy-MM-dd")).alias("period")),
    )
    return df.where(F.col(date).isNotNull()).select(F.explode(kinds).alias("k")).groupBy("k.kind", "k.period").agg(F.count("*").alias("n"))


def centred_mean(series: DataFrame, order: str, value: str, before: int = 2, after: int = 1) -> DataFrame:
    """``smooth``: the mean from ``before`` rows back to ``after`` ahead, null where the window is not full. A series of periods is small enough for one task."""
    w = Window.orderBy(order).rowsBetween(-before, after)
    return series.withColumn("smooth", F.when(F.count(value).over(w) == before + after + 1, F.avg(value).over(w)))
