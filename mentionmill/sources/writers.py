"""Sinks: tables, batches and graph files."""

from __future__ import annotations

import re
from xml.sax.saxutils import escape, unescape

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, rows_a_file: int | None = None) -> None:
    """Parquet, in files of at most ``rows_a_file`` rows if that is given."""
    writer = df.write.mode(mode).partitionBy(*(partition_by or []))
    (writer.option("maxRecordsPerFile", rows_a_file) if rows_a_file else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_a_file: int | None = None) -> None:
    """Delimited files with a header each, of at most ``rows_a_file`` rows if that is given."""
    writer = df.write.mode(mode).option("header", "true").option("escape", '"')
    (writer.option("maxRecordsPerFile", rows_a_file) if rows_a_file else writer).csv(path)


def _field(name: str) -> str:
    """A name as a delimited field, on one line."""
    name = name.replace("\n", " ").replace("\r", " ")
    return '"' + name.replace('"', '""') + '"' if set(name) & set(',"') or name != name.strip() else name


def append_csv(df: DataFrame, path: str) -> None:
    """Add rows to ``path``: files without headers under ``rows``, and one header file, written only when there is none yet.

    The header file and the row files one after the other are one delimited
    file, however often rows were added.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    header = jvm.org.apache.hadoop.fs.Path(f"{path}/_header")
    if not header.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(header):
        spark.createDataFrame([(",".join(_field(c) for c in df.columns),)], "value string").coalesce(1).write.text(f"{path}/_header")
    df.write.mode("append").option("escape", '"').csv(f"{path}/rows")


def _quoted(text: str) -> str:
    return escape(text, {'"': "&quot;"})


def gml(vertices: list[tuple[str, str]], edges: list[tuple[str, str, float]]) -> str:
    """A small graph in GML: vertices with a category, edges with a weight."""
    number = {name: k for k, (name, _) in enumerate(vertices)}
    lines = ["graph ["]
    lines += [f'  node [ id {number[n]} label "{_quoted(n)}" category "{_quoted(c)}" ]' for n, c in vertices]
    lines += [f"  edge [ source {number[a]} target {number[b]} weight {w:g} ]" for a, b, w in edges]
    return "\n".join([*lines, "]"])


def read_gml(text: str) -> tuple[list[tuple[str, str]], list[tuple[str, str, float]]]:
    """The vertices and edges that :func:`gml` wrote."""
    plain = lambda x: unescape(x, {"&quot;": '"'})
    nodes = {int(k): (plain(n), plain(c)) for k, n, c in re.findall(r'node \[ id (\d+) label "([^"]*)" category "([^"]*)" \]', text)}
    edges = re.findall(r"edge \[ source (\d+) target (\d+) weight (\S+) \]", text)
    return list(nodes.values()), [(nodes[int(a)][0], nodes[int(b)][0], float(w)) for a, b, w in edges]
