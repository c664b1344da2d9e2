"""Readers of delimited, nested and paged inputs, and batches."""

from __future__ import annotations

import csv
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mentionmill.runtime import cut

ARTICLE_CSV = "paper_id bigint, title string, citations string, concepts string, authors string, abstract string, language string, pub_year int, pub_date string"
RAW_WORK = (
    "id string, title string, publication_date string, publication_year int, abstract_inverted_index map<string,array<int>>, "
    "authorships array<struct<author:struct<display_name:string>>>, referenced_works array<string>, concepts array<struct<id:string>>"
)


def read_csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """Delimited text with quoted fields that may hold line breaks; the schema is given, never inferred."""
    return spark.read.options(**({"header": "true", "multiLine": "true", "escape": '"', "quote": '"'} | options)).schema(schema).csv(path)


def read_panel(spark: SparkSession, path: str, name: str = "gene") -> DataFrame:
    """A list without a header: one column, trimmed, blanks dropped."""
    return spark.read.schema(f"{name} string").csv(path).select(F.trim(name).alias(name)).where(F.col(name) != "")


def split_fused(c: Column) -> tuple[Column, Column]:
    """A field that holds ``id,text``: the id (null if it is no number) and the text without quotes."""
    parts = F.split(c, ",", 2)
    return F.trim(F.regexp_replace(parts[0], '"', "")).try_cast("bigint"), F.btrim(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), F.lit('" '))


def log_total(lines: DataFrame, pattern: str, column: str = "value") -> DataFrame:
    """The sum and count of the numbers that ``pattern`` captures in text lines."""
    number = F.regexp_extract(column, pattern, 1)
    return lines.where(F.col(column).rlike(pattern)).agg(F.sum(number.cast("double")).alias("total"), F.count("*").alias("n"))


def inverted_index(words: Column) -> Column:
    """A map of the words of an array to their places, from 0.

    Words are sorted once with their places, and each run of one word is an
    entry: the work grows with the words (and their logarithm), not with words
    times distinct words. A lambda's argument holds the sorted array, so that
    it is made once a row.
    """
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def entries(at: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(at)), lambda i: (i == 1) | (F.get(at, i - 1)["w"] != F.get(at, i - 2)["w"]))

        def runs(first: Column) -> Column:
            after = lambda k: F.coalesce(F.get(first, k + 1), F.size(at) + 1)
            return F.transform(first, lambda i, k: F.struct(F.get(at, i - 1)["w"], F.transform(F.sequence(i, after(k) - 1), lambda j: F.get(at, j - 1)["i"])))

        return F.flatten(F.transform(F.array(first), runs))

    found = F.flatten(F.transform(F.array(placed), lambda at: F.when(F.size(at) > 0, entries(at)).otherwise(F.array())))
    return F.map_from_entries(found)


def inverted_text(index: Column) -> Column:
    """Text from a map of words to their places."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.sort_array(pairs), lambda x: x["w"]), " ")


def joined(items: Column, field: Callable[[Column], Column], base: str = "", separator: str = "|") -> Column:
    """A field of each struct of an array, without a prefix; elements that lack it are left out."""
    return F.array_join(F.transform(F.filter(items, lambda x: field(x).isNotNull()), lambda x: F.replace(field(x), F.lit(base), F.lit(""))), separator)


def flatten_works(raw: DataFrame, base: str = "") -> DataFrame:
    """Bibliographic JSON records as rows of articles."""
    return raw.select(
        F.replace("id", F.lit(base), F.lit("")).alias("paper_id"), "title", inverted_text(F.col("abstract_inverted_index")).alias("abstract"),
        F.array_join(F.transform(F.filter("authorships", lambda a: a["author"]["display_name"].isNotNull()), lambda a: a["author"]["display_name"]), ", ").alias("authors"),
        F.array_join(F.transform("referenced_works", lambda x: F.replace(x, F.lit(base), F.lit(""))), "|").alias("citations"),
        joined(F.col("concepts"), lambda x: x["id"], base).alias("concepts"), F.col("publication_year").alias("pub_year"), F.col("publication_date").alias("pub_date"),
    )


def _listed(page: dict) -> tuple[list, str | None]:
    """Records and the next cursor of a page ``{"results": [...], "meta": {"next_cursor": ...}}``."""
    return page["results"], page.get("meta", {}).get("next_cursor")


def connection(name: str) -> Callable[[dict], tuple[list, str | None]]:
    """Records and the next cursor of a page of the graph query ``name``: nodes of its edges, and its page information."""

    def read(page: dict) -> tuple[list, str | None]:
        found = page["data"][name]
        return [e["node"] for e in found["edges"]], found["pageInfo"]["endCursor"] if found["pageInfo"]["hasNextPage"] else None

    return read


def pages(
    fetch: Callable[[str | None], dict], read: Callable[[dict], tuple[list, str | None]] = _listed, first: str | None = "*", tries: int = 3, wait: float = 2.0, pause: float = 1.5, sleep: Callable[[float], None] = time.sleep
) -> Iterator[dict]:
    """Records of a cursor-paged source: each page is tried several times, pages are paced, the end is a page without a cursor."""
    cursor, more = first, True
    while more:
        for k in range(tries):
            try:
                records, cursor = read(fetch(cursor))
                break
            except OSError:
                if k == tries - 1:
                    raise
                sleep(wait)
        yield from records
        more = cursor is not None
        if more:
            sleep(pause)


def enrich(df: DataFrame, key: str, clients: list[Callable[[object], str | None]], found: str = "found") -> DataFrame:
    """``found`` for each row: the answer of the first client that has one for its ``key``; a client that fails has none.

    Each distinct key is asked once, by the task that holds it, whatever the
    number of rows with it; a null key is not asked.
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(k: object) -> str | None:
            for client in clients:
                try:
                    if (told := client(k)) is not None:
                        return told
                except Exception:  # noqa: BLE001  a client may fail in any way; the next is asked
                    continue
            return None

        for frame in frames:
            yield frame.assign(**{found: [one(k) for k in frame[key]]})

    told = keys.mapInPandas(ask, StructType([*keys.schema.fields, StructField(found, StringType())]))
    return df.join(told, key, "left")


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows that :func:`writers.append_csv` has put into ``path``, as strings, under the names of its header file."""
    header = spark.read.text(f"{path}/_header").first()[0]  # one line
    names = next(csv.reader([header]))
    schema = StructType([StructField(n, StringType()) for n in names])
    return spark.read.option("escape", '"').option("multiLine", "true").schema(schema).csv(f"{path}/rows")


def with_batch(df: DataFrame, size: int, order: str) -> DataFrame:
    """Numbered batches of ``size`` rows by ``order``, without a sort in one task.

    Rows are cut into ranges of ``order``; the counts of earlier ranges and the
    place inside a range give the number.
    """
    ranged = cut(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))  # numbered once
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_range", before.alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return ranged.join(counts, "_range").withColumn("batch", F.ceil(place / size).cast("int")).drop("_range", "_before")


#: A gene's record of a service: variants, their profiles, and the assertions about these.
RAW_GENE = """id long, name string, description string, variants struct<nodes: array<struct<id: long, name: string,
    molecularProfiles: struct<nodes: array<struct<id: long, name: string, description: string, assertions: struct<nodes: array<struct<id: long, name: string, description: string>>>>>>>>>"""


def flatten_genes(genes: DataFrame) -> DataFrame:
    """A row for each profile of each variant of each gene, its assertions joined in one text (``None`` without any).

    Genes without variants and variants without profiles have no row; missing
    names and descriptions in an assertion read ``None``.
    """
    variant = genes.select(F.col("id").alias("gene_id"), F.col("name").alias("gene"), F.col("description").alias("gene_description"), F.explode("variants.nodes").alias("v"))
    profile = variant.select("gene_id", "gene", "gene_description", F.col("v.id").alias("variant_id"), F.col("v.name").alias("variant"), F.explode("v.molecularProfiles.nodes").alias("p"))
    word = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    told = F.transform("p.assertions.nodes", lambda a: F.concat(word(a["id"]), F.lit(": "), word(a["name"]), F.lit(" ("), word(a["description"]), F.lit(")")))
    text = F.coalesce(F.nullif(F.array_join(told, " | "), F.lit("")), F.lit("None"))
    return profile.select("gene_id", "gene", "gene_description", "variant_id", "variant", F.col("p.id").alias("profile_id"), F.col("p.name").alias("profile"), F.col("p.description").alias("profile_description"), text.alias("assertions"))


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The parts of a table that are there, as one; missing ones are skipped, and an error tells if none is there."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(conf).exists(hadoop)

    found = [p for p in paths if there(p)]
    if not found:
        raise FileNotFoundError(f"none of {len(paths)} parts is there")
    return reassemble([spark.read.parquet(p) for p in found])


def reassemble(parts: list[DataFrame]) -> DataFrame:
    """Parts of one table, some of which may lack columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
