"""What jobs of several rounds need: code on the workers, tables in the shared folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once for a Spark context."""
    context = spark.sparkContext
    if getattr(context, "_mentionmill_shipped", False):
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="mentionmill-")) / "mentionmill.zip"  # the driver's own; Spark copies it
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(archive))
    context._mentionmill_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` (or the context) names.

    Executors of a cluster read what others wrote there, so a cluster has to
    name one; only a session of one machine gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master.startswith("local") and "cluster" not in context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="mentionmill-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` and go on from the files: executors may be lost, work is not repeated."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_noted: ContextVar[list | None] = ContextVar("noted", default=None)


@contextmanager
def swept() -> Iterator[None]:
    """Drop, at the end of the block, all tables that jobs started within it have left: for callers that have written what they keep elsewhere."""
    made: list[Scratch] = []
    before = _noted.set(made)
    try:
        yield
    finally:
        _noted.reset(before)
        for s in made:
            s.drop("")


class Scratch:
    """Tables of one job in the shared folder, by name; those no longer read are dropped."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"
        if (noted := _noted.get()) is not None:
            noted.append(self)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables (an empty name: all), and let Spark's cleaner have the shuffle files of plans that are gone."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        jvm.System.gc()
