"""Clustering of embedding vectors around centroids, by Yinyang grouping."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from mentionmill.llm import yinyang
from mentionmill.llm.vectors import finite, named, scaled

SCHEMA = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster_vectors(df: DataFrame, k: int = 40, rounds: int = 5, groups: int = 4, dims: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", salt: str = "2:") -> DataFrame:
    """The id and ``cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector of ``dims`` finite components.

    Components count as integers ``floor(256 * x)``. Centroids 0, 1, ... start
    as the ``k`` vectors with the smallest SHA-256 of ``salt`` and the id; each
    round assigns all vectors to the nearest centroid (ties: the smaller number)
    and moves centroids to the floor of the mean; centroids without vectors stay.

    Other vectors (null, of another length, with a null or non-finite component)
    have no row. Repeated rows and ids count each; of equal ids the smaller
    vector comes first, a null id counts as empty. With fewer than ``k`` vectors
    there are as many centroids; an empty table gives an empty result. Scaled
    components beyond 2**26 count as that. Columns besides the two are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    vector = named(vector_col)
    kept = df.where(finite(vector) & (F.size(vector) == dims)).select(named(id_col).alias("own"), scaled(vector).alias("v"))
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("own").cast("string"), F.lit(""))), 256)
    start = np.array([r["v"] for r in kept.orderBy(key, "v").limit(k).select("v").collect()], dtype=np.int64)
    if not len(start):
        return df.sparkSession.createDataFrame([], f"`{id_col}` {kind}, {SCHEMA}")
    told, books, scratch = yinyang.lloyd(kept, start[None], rounds, groups, "centroids")
    told = told.select(F.col("own").alias(id_col), F.col("codes")[0].cast("int").alias("cluster"), "distance")
    sums = {r["cluster"]: int(r["s"]) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    names = [(c, s, total, hashlib.sha256(",".join(map(str, books[0, c])).encode()).hexdigest()) for c, s in sums.items()]
    facts = df.sparkSession.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return told.join(F.broadcast(facts), "cluster").select(named(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows at most


def _sql(k: int = 40, rounds: int = 5) -> str:
    parts = [
        "kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        "x AS MATERIALIZED (SELECT n, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM (SELECT row_number() OVER (ORDER BY vec_id, v) AS n, * FROM kept))",
        f"c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM kept) WHERE c < {k})",
    ]
    for r in range(rounds + 1):
        parts.append(f"d{r} AS MATERIALIZED (SELECT n, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (SELECT x.n, c.c, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{r} c USING (pos) GROUP BY ALL) GROUP BY n)")
        if r < rounds:
            mean = "(s - ((s % m) + m) % m) // m"
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce({mean}, o.x) AS x, o.pos FROM c{r} o LEFT JOIN (SELECT c, pos, sum(x)::BIGINT AS s, count(*) AS m FROM x JOIN d{r} USING (n) GROUP BY ALL) f ON f.c = o.c AND f.pos = o.pos)")
    parts.append(f"h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS sha FROM c{rounds} GROUP BY c)")
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, d.c::INT AS cluster, d.d AS distance, (sum(d.d) OVER (PARTITION BY d.c))::BIGINT AS cluster_inertia, (sum(d.d) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
    FROM d{rounds} d JOIN (SELECT DISTINCT n, vec_id FROM x) USING (n) JOIN h ON h.c = d.c"""


SQL = _sql()
