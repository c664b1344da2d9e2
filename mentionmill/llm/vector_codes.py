"""Compression of embedding vectors: one codebook a part, learned by Yinyang Lloyd."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from mentionmill.llm import yinyang
from mentionmill.llm.vectors import bounded, finite, named, scaled

#: Parts that the rows of one label are dealt to where labels are too many to broadcast.
DEALT = 32


def code_vectors(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, groups: int = 4, dims: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """The id and ``code, error, label_error, codebooks_sha256`` of every vector of finite components.

    Components count as integers ``floor(256 * x)``; vectors are cut into
    ``parts`` equal consecutive parts, each with a codebook of ``entries``
    entries that starts as that part of the smallest ids (equal ids: the smaller
    vector first; null ids last). Rounds, ties and unused entries are as in
    ``yinyang.lloyd``. ``code`` has two hex digits a part (so at most 256
    entries), ``error`` is the squared distance from what the code stands for
    and ``label_error`` its sum over the rows of one label, null being a label.

    Vectors that are null or hold a null or non-finite component have no row.
    Vectors of another length than ``dims`` fit no codebook: they have a row
    whose code and error are null. Repeated rows count each; fewer vectors than
    entries give smaller codebooks; an empty table gives an empty result.
    Scaled components beyond 2**26 count as that. Other columns are not read.
    """
    if dims % parts or entries > 256:
        raise ValueError("parts have to divide the components, and an entry's number has two hex digits")
    vector = named(vector_col)
    rows = df.where(finite(vector)).select(F.struct(named(id_col).alias("id"), named(label_col).alias("label")).alias("own"), vector.alias("raw"))
    kept = rows.where(F.size("raw") == dims).select("own", scaled(F.col("raw")).alias("v"))
    start = np.array([r["v"] for r in kept.orderBy(F.asc_nulls_last("own.id"), "v").limit(entries).select("v").collect()], dtype=np.int64)
    other = rows.where(F.size("raw") != dims).select("own", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    sha = ""
    if len(start):
        books = start.reshape(len(start), parts, dims // parts).transpose(1, 0, 2)
        told, books, scratch = yinyang.lloyd(kept, books, rounds, groups, "codebooks")
        sha = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
        code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")
        other = told.select("own", code.alias("code"), F.col("distance").alias("error")).unionByName(other)
    sums = other.groupBy(F.col("own.label").alias("_label")).agg(F.sum("error").alias("label_error"))
    few = bounded(sums)
    if few is not None:
        out = other.join(few, F.col("own.label").eqNullSafe(F.col("_label")))
    else:  # a label may hold a third of all rows: deal its rows out
        many = sums.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
        out = other.withColumn("_at", F.pmod(F.xxhash64("own.id", "code"), F.lit(DEALT)))
        out = out.join(many, F.col("own.label").eqNullSafe(F.col("_label")) & (F.col("_at") == F.col("_part")))
    return out.select(F.col("own.id").alias(id_col), "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The vectors that rows of entry numbers stand for."""
    return np.concatenate([books[p][codes[:, p]] for p in range(books.shape[0])], axis=1)


def _sql(parts: int = 16, entries: int = 64, rounds: int = 2, width: int = 4) -> str:
    ctes = [
        "kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))",
        "named AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS n, * FROM kept)",
        f"x AS MATERIALIZED (SELECT n, x, (i - 1) // {width} AS p, (i - 1) % {width} AS pos FROM (SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM named))",
        f"c0 AS MATERIALIZED (SELECT n AS c, p, pos, x FROM x WHERE n < {entries})",
    ]
    for r in range(rounds + 1):
        ctes.append(f"d{r} AS MATERIALIZED (SELECT n, p, arg_min(c, d * {entries} + c) AS c, min(d) AS d FROM (SELECT x.n, x.p, c.c, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{r} c USING (p, pos) GROUP BY ALL) GROUP BY n, p)")
        if r < rounds:
            mean = "(s - ((s % m) + m) % m) // m"
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, o.p, o.pos, coalesce({mean}, o.x) AS x FROM c{r} o LEFT JOIN (SELECT c, p, pos, sum(x)::BIGINT AS s, count(*) AS m FROM x JOIN d{r} USING (n, p) GROUP BY ALL) f ON f.c = o.c AND f.p = o.p AND f.pos = o.pos)")
    ctes.append(f"e AS (SELECT n, string_agg(lower(lpad(hex(c), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM d{rounds} GROUP BY n)")
    return f"""WITH {", ".join(ctes)}
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, c, pos)) FROM c{rounds}) AS codebooks_sha256
    FROM named JOIN e USING (n)"""


SQL = _sql()
