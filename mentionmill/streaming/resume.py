"""Resumable processing of arriving rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def process_new(spark: SparkSession, source: str, schema: str, key: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Read what has arrived in ``source``, drop keys that ``target`` has, append ``work`` of the rest.

    A run may be repeated: files are taken once by the checkpoint, keys once by
    the anti-join, so a batch that was cut short adds only what is missing.
    """

    def batch(rows: DataFrame, _: int) -> None:
        done = spark.read.parquet(target).select(key).distinct() if _exists(spark, target) else None
        fresh = rows.dropDuplicates([key]) if done is None else rows.dropDuplicates([key]).join(done, key, "left_anti")
        work(fresh).write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def counts_by_window(stream: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows a window and key; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
