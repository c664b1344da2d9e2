"""Extraction: windows of tokens, tagged spans, responses, prompts, pluggable models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mentionmill import fixed_values as V
from mentionmill.operators.near_names import like_pairs
from mentionmill.operators.neighbours import units
from mentionmill.operators.pairs import spread_pairs
from mentionmill.runtime import Scratch, ship

#: Cosines of unit vectors as products of matrices differ from those computed one by one by much less.
SLACK = 1e-9


def windows(tokens: Column, size: int = 512, stride: int = 256, drop_tail: bool = False) -> Column:
    """Overlapping windows of a token array. All tokens are covered; ``drop_tail`` stops at the first short window."""
    n = F.size(tokens)
    count = F.greatest(F.lit(1), F.ceil((n - size) / stride).cast("int") + 1)
    if drop_tail:
        count = F.when(n <= size, F.lit(1)).otherwise(F.floor((n - size) / stride).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(tokens, i * stride + 1, F.lit(size)))


def merge_pieces(tags: DataFrame, key: str) -> DataFrame:
    """``key, span, entity``: word pieces (``pos, piece, tag``) joined into entities, from one B- tag to the next."""
    w = Window.partitionBy(key).orderBy("pos")
    spans = tags.where("tag <> 'O'").withColumn("span", F.sum(F.when(F.col("tag").startswith("B-"), 1).otherwise(0)).over(w)).where("span > 0")
    pieces = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return spans.groupBy(key, "span").agg(F.array_join(F.transform(pieces, lambda x: F.regexp_replace(x["piece"], "^##", "")), "").alias("entity"))


def keep_labels(entities: DataFrame, labels: list[str], stop: list[str]) -> DataFrame:
    return entities.where(F.col("label").isin(labels) & ~F.lower("entity").isin([s.lower() for s in stop]))


def union_labels(key: str, *tagged: DataFrame) -> DataFrame:
    """``key, entity``: what any of several taggers has found, each name of a text once."""
    out = tagged[0].select(key, "entity")
    for t in tagged[1:]:
        out = out.unionByName(t.select(key, "entity"))
    return out.distinct()


def response_pairs(text: Column, hgvs: bool = False) -> Column:
    """``(variant, gene)`` structs of a response. The plain pattern loses changes such as ``c.1A>G``; ``hgvs`` finds them."""
    text, pattern = F.replace(text, F.lit("\n"), F.lit(" ")), F.lit(V.RESPONSE_PAIR_HGVS if hgvs else V.RESPONSE_PAIR)
    return F.zip_with(F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2)), lambda v, g: F.struct(v.alias("variant"), g.alias("gene")))


def response_triples(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """One row for each line ``variant + treatment : label``."""
    lines = df.select(*keys, F.posexplode(F.split(column, "\n")).alias("line_no", "line")).where(F.col("line").rlike(V.RESPONSE_TRIPLE))
    return lines.select(*keys, "line_no", *[F.trim(F.regexp_extract("line", V.RESPONSE_TRIPLE, i)).alias(n) for i, n in ((1, "variant"), (2, "treatment"), (3, "label"))])


def response_labels(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """One row for each line ``pair : label`` that holds both signs."""
    lines = df.select(*keys, F.posexplode(F.split(column, "\n")).alias("line_no", "line")).where(F.col("line").contains("+") & F.col("line").rlike(V.RESPONSE_LABELLED))
    return lines.select(*keys, "line_no", F.regexp_extract("line", V.RESPONSE_LABELLED, 1).alias("pair"), F.regexp_extract("line", V.RESPONSE_LABELLED, 2).alias("label"))


def prompts(df: DataFrame, templates: list[str], *columns: str) -> DataFrame:
    """A prompt a row and template; ``%s`` stand for the columns."""
    filled = F.array(*[F.struct(F.lit(k).alias("prompt_no"), F.format_string(t, *columns).alias("prompt")) for k, t in enumerate(templates)])
    return df.withColumn("_p", F.explode(filled)).select("*", "_p.*").drop("_p")


def call_model(df: DataFrame, ask: Callable[[list[str]], list[str]], prompt: str = "prompt", response: str = "response") -> DataFrame:
    """Ask a model for each prompt, by batches; a batch that fails is asked row by row, rows that fail answer ``ERROR``."""
    schema = StructType([*df.schema.fields, StructField(response, StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            try:
                told = ask(frame[prompt].tolist())
            except Exception:  # noqa: BLE001  a model may fail in any way
                told = []
                for p in frame[prompt]:
                    try:
                        told += ask([p])
                    except Exception:  # noqa: BLE001
                        told.append("ERROR")
            yield frame.assign(**{response: told})

    return df.mapInPandas(run, schema)


def classify(df: DataFrame, ask: Callable[[list[str]], list[str]], categories: list[str], text: str = "text", default: str = "Undefined") -> DataFrame:
    """Zero-shot classes; an answer outside the closed list is the default."""
    told = call_model(df, ask, text, "_said")
    return told.withColumn("category", F.when(F.col("_said").isin(categories), F.col("_said")).otherwise(F.lit(default))).drop("_said")


def not_yet(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key the output does not have: a run goes on where the last one ended."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def normalise_names(found: DataFrame, dictionary: DataFrame, key: str, least: int = 86) -> DataFrame:
    """``key, entity, name, how``: entities mapped to upper-cased dictionary names exactly, by each word that is a name, or by the likest name.

    The likest is looked for in the whole dictionary, for entities that the
    first two ways leave over, by an index of bigrams that misses no name of
    the similarity (``near_names.like_pairs``). Each distinct entity is scored once.
    """
    names = dictionary.select(F.upper("name").alias("name")).distinct()
    found = found.select(key, "entity", F.upper("entity").alias("_upper"))
    exact = found.join(names, found["_upper"] == names["name"]).select(key, "entity", "name", F.lit("exact").alias("how"))
    rest = found.join(exact.select(key, "entity"), [key, "entity"], "left_anti")
    words = rest.select(key, "entity", F.explode(F.split(F.regexp_replace("_upper", r"[\[\](),-]", " "), r"\s+")).alias("name"))
    by_word = words.where("name <> ''").join(names, "name").select(key, "entity", "name").distinct().withColumn("how", F.lit("word"))
    rest = rest.join(by_word.select(key, "entity"), [key, "entity"], "left_anti").distinct()
    near = like_pairs(rest.select(F.col("_upper").alias("name")), names, least).select(F.col("a").alias("_upper"), F.col("b").alias("name"), "ratio")
    near = near.groupBy("_upper").agg(F.max_by("name", F.struct("ratio", "name")).alias("name"))
    near = rest.join(near, "_upper").select(key, "entity", "name", F.lit("near").alias("how"))
    return exact.unionByName(by_word).unionByName(near)


def candidate_pairs(mentions: DataFrame, left: str = "Variant", right: str = "Treatment") -> DataFrame:
    """All pairs of a paper's entities of two categories; a heavy paper's are made by many tasks."""
    a = mentions.where(F.col("category") == left).select("paper_id", F.col("entity").alias("a"))
    return spread_pairs(a, mentions.where(F.col("category") == right).select("paper_id", F.col("entity").alias("b")), "paper_id", "a", "b")


def entity_lists(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("paper_id", "category").agg(F.array_join(F.array_sort(F.collect_set("entity")), ", ").alias("entities"))


def nearest(queries: DataFrame, vectors: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding", block: int = 4096) -> DataFrame:
    """The ``k`` nearest vectors by cosine to each of a stated set of query vectors, compared in blocks.

    All queries meet all vectors, in products of a block of ``block`` vectors
    and one of as many queries, dealt to tasks. A product only tells which
    vectors may be among the best: those within ``SLACK`` of the ``k``-th; their
    cosines are then computed one by one and ranked, ties by id, so rounding of
    the products decides nothing. Of equal vectors the ``k + 1`` first by id go
    in, since no later one can be among the ``k`` best. Vectors are of one length.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "nearest")
    kind = vectors.schema[id_col].dataType.simpleString()
    copies = Window.partitionBy("_v").orderBy("_id")
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("_id"), F.col(vector).alias("_v"))
    rows = scratch.write("rows", rows.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1).drop("_n"))
    asked = scratch.write("asked", queries.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("_id"), F.col(vector).alias("_v")))

    def packs(df: DataFrame, name: str) -> DataFrame:
        of = max(1, -(-df.count() // block))
        df = df.withColumn("_pack", F.pmod(F.xxhash64("_id"), F.lit(of)))
        return scratch.write(name, df.groupBy("_pack").agg(F.collect_list("_id").alias(f"{name}_ids"), F.collect_list("_v").alias(f"{name}_vs")).drop("_pack").repartition(min(of, 200)))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                qi, qv, vi, vv = (b.column(c)[r].values for c in ("q_ids", "q_vs", "v_ids", "v_vs"))
                ids, others, of = qi.to_numpy(zero_copy_only=False), vi.to_numpy(zero_copy_only=False), units(vv)
                q = units(qv)
                for at in range(0, len(q), 512):
                    part = ids[at : at + 512]
                    c = q[at : at + 512] @ of.T
                    c[part[:, None] == others[None, :]] = -np.inf
                    m = min(k, c.shape[1])
                    least = np.partition(c, c.shape[1] - m, axis=1)[:, c.shape[1] - m]
                    i, j = np.nonzero((c >= least[:, None] - SLACK) & (c > -np.inf))
                    yield pa.RecordBatch.from_arrays([qi.take(pa.array(i + at)), vi.take(pa.array(j)), pa.array(c[i, j])], ["query", "_id", "near"])

    met = packs(asked, "q").crossJoin(packs(rows, "v")).mapInArrow(best, f"query {kind}, _id {kind}, near double")
    met = scratch.write("met", met)
    order = Window.partitionBy("query").orderBy(F.desc("near"), "_id")
    edge = met.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).groupBy("query").agg(F.min("near").alias("_least"))
    near = met.join(edge, "query").where(F.col("near") >= F.col("_least") - SLACK).select("query", "_id")
    near = near.join(asked.select(F.col("_id").alias("query"), F.col("_v").alias("_q")), "query").join(rows, "_id")
    dot = F.aggregate(F.zip_with("_q", "_v", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    told = near.select("query", F.col("_id").alias(id_col), F.try_divide(dot, norm("_q") * norm("_v")).alias("cosine"))
    return told.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), id_col))).where(F.col("rank") <= k).select("query", id_col, "rank", "cosine")
