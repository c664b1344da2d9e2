"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionmill.llm.common import apart, ascii_lower, cut

#: Letters, digits and everything beyond ASCII.
BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


RESULT = ("n_words", "n_hit", "n_items", "item_ids")
#: Parts that the documents of one fingerprint are dealt to.
SALTS = 8


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({BENCH_WORD})"), F.lit(1))


def _grams(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words; empty for fewer words."""
    n = F.size(words)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(k))))).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: Column, window: int) -> Column:
    """The smallest hash of every ``window`` neighbouring hashes, without direct repeats: ``(at, hash)`` of each choice.

    Two texts that share ``window + k - 1`` words share a choice among them,
    because the same window of hashes has the same minimum.
    """
    n = F.size(grams)
    least = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.array_min(F.slice(grams, i, F.lit(window))))
    return F.when(n >= window, least).otherwise(F.array().cast("array<bigint>"))


def _every(words: Column, m: int) -> Column:
    """All runs of ``m`` words with their places."""
    return F.transform(_grams(words, m), lambda x, i: F.struct(F.lit(m).alias("m"), i.alias("at"), x.alias("mark")))


def contaminated_words(docs: DataFrame, bench: DataFrame, span: int = 13, k: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Measure for every document the words that lie in a shared run of ``span`` words with a benchmark item.

    Fingerprints are the smallest ``k``-gram hash of each window of ``span - k +
    1`` neighbouring hashes, so any shared run of ``span`` words shares one. The
    fingerprints of documents and items are joined, and each hit is extended to
    the windows of ``span`` words around it, which are compared word by word
    with the item's windows. Items of fewer words are one window each and are
    looked up whole.

    Returns the columns of ``docs``, ``n_words``, ``n_hit``, ``n_items`` and
    ``item_ids`` (sorted strings). The join sides have no size limit: the
    benchmark is broadcast only where Spark finds it small enough. A null text
    has no words; a null item text is no item; a null item id is left out of
    ``item_ids``; rows alike in id and text get one result each; an empty
    benchmark gives no hits. Other columns go along, whatever their names; those of
    the result are replaced.
    """
    window = span - k + 1
    items = bench.select(F.col(item_col).cast("string").alias("item"), _words(F.col(item_text_col)).alias("words")).withColumn("n", F.size("words")).where(F.col("n") > 0)
    many = F.transform(F.sequence(F.lit(1), F.col("n") - span + 1), lambda i: F.slice("words", i, F.lit(span)))
    items = items.select("item", F.explode(F.when(F.col("n") >= span, many).otherwise(F.array("words"))).alias("words"))
    items = cut(items.withColumn("content", F.array_join("words", " ")).groupBy("content").agg(F.first("words").alias("words"), F.collect_set("item").alias("items")))
    short = [r[0] for r in items.select(F.size("words").alias("m")).where(F.col("m") < span).distinct().orderBy("m").collect()]  # fewer than span numbers

    marks = items.where(F.size("words") == span).select(F.lit(span).alias("m"), F.array_min(_grams(F.col("words"), k)).alias("mark"))
    marks = marks.unionByName(items.where(F.size("words") < span).select(F.size("words").alias("m"), F.xxhash64("words").alias("mark"))).distinct()

    base, own = apart(docs, text_col, RESULT)
    ident = F.col("__own")[id_col]
    base = base.withColumn("__th", F.xxhash64("__text"))
    worded = base.select(ident.alias("id"), F.col("__th").alias("th"), _words(F.col("__text")).alias("words"))
    found = worded.withColumn("grams", _grams(F.col("words"), k)).withColumn("least", _winnowed(F.col("grams"), window))
    # The place of a choice is its window's. Equal neighbours say the same: the first is kept, and one at least of every ``window`` places.
    fresh = lambda x, i: (i % window == 0) | (x != F.col("least")[F.greatest(i - 1, F.lit(0))])
    firsts = F.filter(F.transform("least", lambda x, i: F.when(fresh(x, i), F.struct(F.lit(span).alias("m"), i.alias("at"), x.alias("mark")))), lambda x: x.isNotNull())
    kinds = [firsts] + [_every(F.col("words"), m) for m in short]
    part, parts = F.pmod(F.xxhash64("id", "th"), F.lit(SALTS)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))  # a passage of a third of all documents meets them in many tasks
    found = found.select("id", "th", F.explode(F.concat(*kinds) if short else firsts).alias("f")).select("id", "th", "f.*", part.alias("part"))
    hits = found.join(marks.withColumn("part", parts), ["m", "mark", "part"]).groupBy("id", "th").agg(F.collect_list(F.struct("m", "at")).alias("hits"))
    hits = cut(hits)

    keyed = hits.withColumnsRenamed({"id": "__id", "th": "__hth"})
    near = base.select(ident.alias("id"), F.col("__th").alias("th"), F.col("__text").alias("text")).join(keyed, F.col("id").eqNullSafe(F.col("__id")) & F.col("th").eqNullSafe(F.col("__hth")))
    near = near.dropDuplicates(["id", "th"]).select("id", "th", _words(F.col("text")).alias("words"), "hits")
    # The shared run starts at the kept window or up to window - 1 later.
    starts = F.transform("hits", lambda h: F.when(h["m"] < span, F.array(F.struct(h["m"].alias("m"), h["at"].alias("s")))).otherwise(
        F.transform(F.sequence(h["at"], F.least(h["at"] + window - 1, F.size("words") - span)), lambda s: F.struct(F.lit(span).alias("m"), s.alias("s")))))
    tried = near.select("id", "th", "words", F.explode(F.array_distinct(F.flatten(starts))).alias("w"))
    tried = tried.select("id", "th", "w.m", "w.s", F.array_join(F.slice("words", F.col("w.s") + 1, F.col("w.m")), " ").alias("content"), part.alias("part"))
    real = tried.join(items.select("content", "items", parts.alias("part")), ["content", "part"])
    real = real.groupBy("id", "th").agg(F.collect_list(F.struct("s", "m")).alias("runs"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["s"], r["s"] + r["m"] - 1))))
    real = real.select(F.col("id").alias("__id"), F.col("th").alias("__rth"), F.size(covered).cast("long").alias("__hit"), F.sort_array("items").alias("__items"))

    out = base.withColumn("__n", F.regexp_count(ascii_lower(F.coalesce("__text", F.lit(""))), F.lit(BENCH_WORD)).cast("long"))
    out = out.join(real, ident.eqNullSafe(F.col("__id")) & F.col("__th").eqNullSafe(F.col("__rth")), "left")
    none = F.array().cast("array<string>")
    told = (F.col("__n"), F.coalesce("__hit", F.lit(0)).cast("long"), F.coalesce(F.size("__items"), F.lit(0)).cast("long"), F.coalesce("__items", none))
    return out.select(*own(F.col("__text")), *[c.alias(n) for c, n in zip(told, RESULT, strict=True)])


def is_contaminated() -> Column:
    """The contract's rule: hit words make up a twentieth of the document or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS m, array_to_string(words[s:s + least(len(words), 13) - 1], ' ') AS content
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS s FROM item WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT m FROM item_window),
doc_window AS (
  SELECT doc_id, m, s, array_to_string(words[s:s + m - 1], ' ') AS content
  FROM (SELECT doc_id, words, m, unnest(range(1, len(words) - m + 2)) AS s FROM doc, sizes WHERE len(words) >= m)
), hit AS (
  SELECT w.doc_id, w.s, w.m, i.item_id FROM doc_window w JOIN item_window i ON w.content = i.content AND w.m = i.m
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.words) AS contaminated
FROM doc d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""
