"""Proportional stratified interleaving: shards that all match the corpus mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mentionmill.llm.common import cut


def interleave_shards(docs: DataFrame, n_shards: int = 40, seed: int = 17, rows_per_bucket: int = 20_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Deal all rows into ``n_shards`` shards so that each holds every source in its share.

    Rows of a source are ranked in a seeded shuffle, by the first 52 bits of the
    MD5 of ``seed:id:checksum:size``; row ``r`` of ``n`` gets the
    fractional rank ``(r + 0.5) / n``; all rows are sorted by it and the sorted
    sequence is cut into shards whose row counts differ by at most one.

    Ranks are exact without a sort in one task: rows are dealt to hash buckets
    (about ``rows_per_bucket`` each, more buckets for more rows), ranked inside,
    and the counts of earlier buckets are added. A source with a third of all
    rows is spread over as many buckets as it needs.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, source,
    fraction``. A null text has size 16 and the checksum of no bytes; a null
    source is a source of its own; a null id is an id like any other; rows alike
    in id, source, size and checksum are interchangeable. An empty table gives
    an empty result. Other columns of ``docs`` are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "size"))
    rows = rows.withColumn("h", F.conv(F.substring(mark, 1, 13), 16, 10).cast("long"))  # 52 bits, exact as a double
    rows = cut(rows.withColumn("u", F.col("h") / F.lit(float(1 << 52))))
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a source of any size is in as many tasks as there are
    ties = ("h", "doc_id", "text_crc32", "size")

    rows = rows.withColumn("bucket", F.floor(F.col("u") * buckets).cast("int"))
    sizes = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("stratum", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("stratum")).alias("of"))
    inside = F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy("u", *ties))
    rows = rows.withColumn("inside", inside).join(sizes, ["stratum", "bucket"])
    rows = rows.withColumn("fraction", (F.col("before") + F.col("inside") - F.lit(0.5)) / F.col("of"))

    rows = cut(rows.withColumn("cell", F.floor(F.col("fraction") * buckets).cast("int")).drop("bucket", "before", "inside", "of"))
    cells = rows.groupBy("cell").agg(F.count("*").alias("n"))
    cells = cells.select("cell", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("cell").orderBy("fraction", "stratum", *ties))
    rank = F.col("before") + F.col("inside") - 1
    rows = rows.withColumn("inside", inside).join(cells, "cell").withColumn("rank", rank.cast("long"))
    shard = F.expr(f"cast(rank * {n_shards} div {max(total, 1)} as int)")
    start = F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}")
    return rows.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source", "fraction",
    )


SQL = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda s, i: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, c::BIGINT)) AS step
), doc AS (
  SELECT doc_id, source, encode(coalesce(text, '')) AS body FROM documents
), sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS stratum, (octet_length(body) + 16)::BIGINT AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(body), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda s, b: xor(s >> 8, step[(xor(s, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
  FROM doc, step
), marked AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', '17', coalesce(doc_id::VARCHAR, ''), text_crc32, size)), 1, 13))::BIGINT AS h FROM sized
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction FROM marked
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS place, count(*) OVER () AS total FROM ranked
), dealt AS (
  SELECT *, (place * 40 // total)::INT AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, place - (shard::BIGINT * total + 39) // 40 AS slot, NULL::INT AS grown_shard FROM dealt
"""
