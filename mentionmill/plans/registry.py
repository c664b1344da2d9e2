"""The queries of the engine and the SQL that each is held against."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FAMILIES = ("a_sources", "b_rules", "c_text", "d_extract", "e_matrix", "f_joins", "g_aggregates", "i_sets", "j_statistics", "k_trends", "l_graph", "m_evaluation", "s_streams")


def counted(sql: str) -> str:
    """``count_if(x)`` as a count of rows, whose type is that of Spark's."""
    while (at := sql.find("count_if(")) >= 0:
        depth, end = 1, at + 9
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(CASE WHEN {sql[at + 9 : end - 1]} THEN 1 END){sql[end:]}"
    return sql


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB equivalent."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = counted(sql)
        return f

    return add


def _load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"mentionmill.plans.{family}")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked treatments and diseases for a disease and a variant."""
    return queries()["L13_network_query"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return ORACLE
