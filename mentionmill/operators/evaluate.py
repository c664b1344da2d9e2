"""Evaluation of extractors against a truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


def scores(counts: DataFrame, empty_f1: float = 0.0) -> DataFrame:
    """Precision, recall, specificity, accuracy, F1 and Jaccard from ``tp, fp, fn, tn``; a division by nothing is 0 (F1: ``empty_f1``)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "specificity": _ratio(tn, tn + fp), "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn, empty_f1), "jaccard": _ratio(tp, tp + fp + fn),
    })


def binary_confusion(df: DataFrame, truth: Column, said: Column, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(truth & said).alias("tp"), F.count_if(~truth & said).alias("fp"), F.count_if(truth & ~said).alias("fn"), F.count_if(~truth & ~said).alias("tn"))


def count_confusion(df: DataFrame, truth: str, said: str, *by: str) -> DataFrame:
    """Confusion of counts: common ones, too many, too few, and rows where both are none."""
    t, s, zero = F.col(truth), F.col(said), F.lit(0)
    return df.groupBy(*by).agg(F.sum(F.least(t, s)).alias("tp"), F.sum(F.greatest(s - t, zero)).alias("fp"), F.sum(F.greatest(t - s, zero)).alias("fn"), F.count_if((t == 0) & (s == 0)).alias("tn"))


def set_confusion(df: DataFrame, truth: str, said: str, *by: str) -> DataFrame:
    """Confusion of sets of names a row."""
    both, extra, missed = F.size(F.array_intersect(truth, said)), F.size(F.array_except(said, truth)), F.size(F.array_except(truth, said))
    return df.groupBy(*by).agg(F.sum(both).alias("tp"), F.sum(extra).alias("fp"), F.sum(missed).alias("fn"), F.count_if((F.size(truth) == 0) & (F.size(said) == 0)).alias("tn"))


def first_errors(df: DataFrame, key: str, truth: str, said: str, k: int = 5) -> DataFrame:
    """``kind, key, names``: the first ``k`` rows by key with names too many (``fp``) and with names missed (``fn``)."""
    wrong = [(n, F.array_sort(F.array_except(a, b))) for n, a, b in (("fp", said, truth), ("fn", truth, said))]
    parts = [df.select(F.lit(n).alias("kind"), F.col(key).alias("key"), c.alias("names")).where(F.size("names") > 0).orderBy("key").limit(k) for n, c in wrong]
    return parts[0].unionByName(parts[1])


def disagreeing(df: DataFrame, key: str, *said: str) -> DataFrame:
    """The rows on which not all of ``said`` are alike; a missing answer is an answer."""
    return df.where(~F.forall(F.array(*said), lambda x: x.eqNullSafe(F.col(said[0])))).select(key, *said)


def class_confusion(df: DataFrame, truth: str, said: str, labels: list[str]) -> DataFrame:
    """``truth, said, n`` for all pairs of labels."""
    values = F.array(*[F.lit(x) for x in labels])
    grid = df.sparkSession.range(1).select(F.explode(values).alias(truth)).withColumn(said, F.explode(values))
    n = df.groupBy(truth, said).agg(F.count("*").alias("n"))
    return grid.join(n, [truth, said], "left").select(truth, said, F.coalesce("n", F.lit(0)).alias("n"))


def weighted_scores(confusion: DataFrame, truth: str, said: str) -> DataFrame:
    """Precision, recall and F1 averaged over labels by support, rounded to two digits."""
    t = confusion.groupBy(F.col(truth).alias("label")).agg(F.sum("n").alias("support"))
    s = confusion.groupBy(F.col(said).alias("label")).agg(F.sum("n").alias("named"))
    hit = confusion.where(F.col(truth) == F.col(said)).select(F.col(truth).alias("label"), F.col("n").alias("hit"))
    each = t.join(s, "label", "full").join(hit, "label", "left").na.fill(0)
    each = each.withColumns({"p": _ratio(F.col("hit"), F.col("named")), "r": _ratio(F.col("hit"), F.col("support"))})
    each = each.withColumn("f", _ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    mean = lambda c: F.round(F.sum(F.col(c) * F.col("support")) / F.sum("support"), 2)
    return each.agg(mean("p").alias("precision"), mean("r").alias("recall"), mean("f").alias("f1"))
