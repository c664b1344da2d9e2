"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mentionmill.llm import decontaminate, line_dedup, minhash_dedup, packing, quality
from mentionmill.llm.common import Scratch, named, table
from mentionmill.runtime import swept


def _columns(told: DataFrame, docs: DataFrame, **other: Column) -> DataFrame:
    """The columns of ``docs``, whatever their names, from ``told``; those in ``other`` as told there."""
    return told.select(*[other[c].alias(c) if c in other else named(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a host go, and documents that the quality rules reject. ``n_chars`` follows the text."""
    told = quality.quality_rules(docs).where("kept")
    changed = F.when(F.col("boilerplate_chars") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _columns(told, docs, n_chars=changed)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; so do documents that held nothing else. ``n_chars`` follows the text."""
    told = line_dedup.dedup_lines(docs).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _columns(told, docs, n_chars=changed)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, the one with the smallest id; rows without an id stay.

    Different texts under one id are compared as documents of their own: beyond
    the first they get numbers above all ids. Of rows repeated under one id with
    one text, the first by a hash of the whole row stays.
    """
    scratch = Scratch(spark, "near-stage")
    text = named("text").cast("string")
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), named("doc_id").cast("long").alias("id"), F.struct(F.xxhash64(text).alias("h"), F.xxhash64(text, F.lit(1)).alias("i")).alias("name"))
    known = rows.where("id IS NOT NULL")
    keys = scratch.write("keys", known.select("id", "name"))
    shared = keys.groupBy("id").agg(F.min("name").alias("first"), F.max("name").alias("last")).where("first <> last").select("id", "first")
    top = keys.agg(F.max("id")).collect()[0][0]
    extra = keys.join(shared, "id").where("name <> first").select("id", "name").distinct()
    extra = scratch.write("extra", extra.withColumn("num", F.monotonically_increasing_id() + F.lit((top or 0) + 1)))
    if extra.isEmpty():
        known = known.withColumn("num", F.col("id"))
    else:
        known = known.join(extra, ["id", "name"], "left").withColumn("num", F.coalesce("num", "id"))
    told = minhash_dedup.near_duplicates(known.select("num", F.col("row")["text"].alias("text")), id_col="num")
    kept = told.where("kept").groupBy(F.col("doc_id").alias("num")).agg(F.count("*").alias("copies"))
    whole = F.when(F.col("copies") > 1, F.md5(F.to_json("row")))  # only repeated rows need an order
    known = known.join(kept, "num").withColumn("n", F.row_number().over(Window.partitionBy("num").orderBy(whole))).where("n = 1")
    out = known.select("row").unionByName(rows.where("id IS NULL").select("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    told = decontaminate.contaminated_words(docs, table(spark, sf_dir, "benchmark"))
    return _columns(told.where(~decontaminate.is_contaminated()), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The last stage tokenizes, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    A stage's table is dropped once the next is written, and so is what the
    stage's operators have left in the folder; at the end only the result's
    table is there. An empty table runs through to an empty result; columns
    beyond those of ``documents`` go along up to the last stage, whatever their
    names and types.
    """
    scratch, docs = Scratch(spark, "corpus-pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        with swept():
            docs = scratch.write(f"stage-{k}", stage(spark, docs, sf_dir))
        scratch.drop(f"stage-{k - 1}")
    return docs
