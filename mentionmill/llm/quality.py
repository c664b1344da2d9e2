"""Quality rules: text measures, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionmill.llm.common import SEPARATORS, WORD, apart, cut, trimmed

SYMBOLS = "#*$%&|<>"
VERDICT = ("base_failed", "line_chars", "boilerplate_chars", "kept")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Parts that the documents of one line are dealt to.
SALTS = 16


def text_measures(docs: DataFrame, text_col: str = "text", span: int = 5) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` to ``docs``, all without a shuffle.

    ``n_repeat_words`` counts the words covered by windows of ``span`` words
    that occur twice or more in the text: window hashes are sorted with their
    places, equal neighbours name the repeated places, and the places sorted
    again give the covered length. All of it is linear or n log n in the text.
    A null text has no words. Columns of the measures' names are replaced.
    """
    text = F.coalesce("__text", F.lit(""))
    without = lambda c, chars: F.length(F.translate(c, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: trimmed(x) != "")
    base, own = apart(docs, text_col, MEASURES)
    out = base.withColumns({"__words": F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), "__lines": lines})
    n = F.size("__words")
    out = out.withColumns({
        "__n": n.cast("long"),
        "__chars": without(text, SEPARATORS).cast("long"),
        "__symbols": (F.length(text) - without(text, SYMBOLS)).cast("long"),
        "__dups": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__grams": F.when(n > span, F.transform(F.sequence(F.lit(1), n - span + 1), lambda i: F.xxhash64(F.slice("__words", i, F.lit(span))))),
    })
    again = F.size("__grams") > F.size(F.array_distinct("__grams"))
    out = out.withColumn("__sorted", F.when(again, F.array_sort(F.transform("__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    body = lambda c, a: F.slice(c, F.lit(a), F.size(c) - 1)
    pairs = F.zip_with(body("__sorted", 1), body("__sorted", 2), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    out = out.withColumn("__places", F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))))
    gaps = F.zip_with(body("__places", 1), body("__places", 2), lambda a, b: F.least(b - a, F.lit(span)))
    covered = F.aggregate(gaps, F.lit(0), lambda s, x: s + x) + span
    inner = [F.col(x).alias(n) for x, n in zip(("__n", "__chars", "__symbols", "__dups"), MEASURES)]
    measures = F.struct(*inner, F.coalesce(F.when(F.size("__places") > 0, covered), F.lit(0)).cast("long").alias("n_repeat_words"))
    # A row for a row: filters on the measures stay above it, and the steps before are not copied into them.
    return out.select(*own(F.col("__text")), F.inline(F.array(measures)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _host_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    line = F.explode(F.array_distinct(F.transform(F.split(F.col(text_col), "\n"), trimmed)))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), line.alias("line"))
    return rows.where(F.col("line") != "").select("id", "th", "host", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), F.length("line").alias("chars"))


def frequent_host_lines(docs: DataFrame, min_docs: int = 10, max_share: float = 0.05, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Lines ``host, h1, h2`` in more than ``min_docs`` and more than ``max_share`` of a host's distinct documents.

    Exact copies count once: a document that is mirrored on its host is a matter
    for deduplication, not boilerplate.
    """
    lines = _host_lines(docs, id_col, text_col, host_col)
    counts = lines.groupBy("host", "h1", "h2", "th").agg(F.lit(1).alias("one")).groupBy("host", "h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    hosts = docs.where(F.col(text_col).isNotNull()).groupBy(F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.xxhash64(text_col).alias("th")).agg(F.lit(1).alias("one"))
    hosts = hosts.groupBy("host").agg(F.count("*").alias("of"))
    return counts.join(hosts, "host").where(F.col("n") > F.lit(max_share) * F.col("of")).select("host", "h1", "h2")


def quality_rules(docs: DataFrame, min_docs: int = 10, max_share: float = 0.05, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Clean and judge every document: its columns, the text without boilerplate lines, the measures, ``base_failed``, ``line_chars``, ``boilerplate_chars`` and ``kept``.

    A line is boilerplate on a host when more than ``min_docs`` and more than
    ``max_share`` of the host's distinct documents carry it (compared by hash,
    without the white space at its ends). A document is depleted when
    boilerplate makes up more than half of the characters of its distinct lines.
    ``kept`` is false for depleted documents and those that fail the base rules
    (fewer than 10 words, or over 20 % of them in repeated 5-word windows).
    Measures and verdict are those of the text as it came; every boilerplate line
    then leaves the text that is returned, each time it occurs, and blank lines
    stay. A text without boilerplate is returned unchanged.

    Texts are not shuffled for the counts: line hashes are counted per host with
    partial sums, so a hot host or line costs one row per map task. A null text
    has no words and fails; a null host is a host of its own; rows with equal id
    and text share one verdict; an empty table gives an empty result. Other
    columns go along, whatever their names; those of the measures and the verdict
    are replaced.
    """
    common = cut(frequent_host_lines(docs, min_docs, max_share, id_col, text_col, host_col))
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a line of a hot host meets its documents in many tasks
    lines = _host_lines(docs, id_col, text_col, host_col).withColumn("salt", F.pmod("th", F.lit(SALTS)).cast("int"))
    hits = lines.join(salted, ["host", "h1", "h2", "salt"]).dropDuplicates(["id", "th", "host", "h1", "h2"])
    hits = hits.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("host").alias("__host")).agg(F.sum("chars").alias("__hit"), F.collect_list(F.struct("h1", "h2")).alias("__lost"))
    told, own = apart(docs, text_col, (*MEASURES, *VERDICT))
    told = text_measures(told, "__text")
    distinct = F.array_distinct(F.transform(F.split(F.coalesce("__text", F.lit("")), "\n"), trimmed))
    told = told.withColumn("__line_chars", F.aggregate(distinct, F.lit(0).cast("long"), lambda s, x: s + F.length(x)))
    host = F.coalesce(F.col("__own")[host_col].cast("string"), F.lit(""))
    on = F.col("__own")[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64("__text") == F.col("__th")) & (host == F.col("__host"))
    out = told.join(hits, on, "left").withColumns({"__failed": base_failed(), "__boiler": F.coalesce("__hit", F.lit(0))})
    stays = lambda x: ~F.array_contains("__lost", F.struct(F.xxhash64(trimmed(x)).alias("h1"), F.hash(trimmed(x)).alias("h2")))
    cleaned = F.when(F.col("__lost").isNotNull(), F.array_join(F.filter(F.split("__text", "\n"), stays), "\n")).otherwise(F.col("__text"))
    kept = ~F.col("__failed") & (2 * F.col("__boiler") <= F.col("__line_chars"))
    verdict = (F.col("__failed"), F.col("__line_chars"), F.col("__boiler"), kept)
    out = out.withColumn("__clean", cleaned)  # before the caller's names come back
    return out.select(*own(F.col("__clean")), *MEASURES, *[c.alias(n) for c, n in zip(verdict, VERDICT, strict=True)])


SQL = r"""
WITH sep AS (SELECT chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS s),
doc AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
line AS (
  SELECT doc_id, coalesce(source, '') AS host, text, unnest(string_split(text, chr(10))) AS line FROM doc
), keyed AS (
  SELECT doc_id, host, text, line, trim(line, (SELECT s FROM sep)) AS k FROM line
), dups AS (
  SELECT doc_id, (count(*) - count(DISTINCT line)) AS n_dup_lines FROM keyed WHERE k <> '' GROUP BY doc_id
), counted AS (
  SELECT host, k, count(DISTINCT text) AS n FROM keyed WHERE k <> '' GROUP BY host, k
), hosts AS (
  SELECT coalesce(source, '') AS host, count(DISTINCT text) AS of FROM documents WHERE text IS NOT NULL GROUP BY 1
), common AS (
  SELECT c.host, c.k FROM counted c JOIN hosts h ON c.host = h.host WHERE c.n > 10 AND c.n > 0.05 * h.of
), part AS (
  SELECT DISTINCT doc_id, host, k FROM keyed WHERE k <> ''
), chars AS (
  SELECT p.doc_id, sum(length(p.k)) AS line_chars, coalesce(sum(length(p.k)) FILTER (c.k IS NOT NULL), 0) AS hit
  FROM part p LEFT JOIN common c ON p.host = c.host AND p.k = c.k GROUP BY p.doc_id
), word AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM doc
), gram AS (
  SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram WHERE g IS NOT NULL) WHERE n >= 2
), repeated AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM again, (SELECT unnest([0, 1, 2, 3, 4]) AS d) GROUP BY doc_id
), told AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_words,
    length(translate(d.text, (SELECT s FROM sep), ''))::BIGINT AS word_chars,
    (length(d.text) - length(translate(d.text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(u.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    coalesce(c.line_chars, 0) AS line_chars, coalesce(c.hit, 0) AS hit
  FROM doc d LEFT JOIN dups u ON d.doc_id = u.doc_id LEFT JOIN repeated r ON d.doc_id = r.doc_id LEFT JOIN chars c ON d.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * hit <= line_chars AS kept
FROM told
"""
