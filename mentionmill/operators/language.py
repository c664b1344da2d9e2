"""Languages of texts by character trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionmill.runtime import cut, ship

#: Texts of this many characters or fewer are not told.
SHORT = 10
#: Log-likelihoods are integers, so that sums do not depend on their order.
SCALE = 1000.0
#: Languages of a model at most: its table has a column for each.
MOST_LANGUAGES = 200
#: Characters of a task that are counted at a time; longer texts are counted in pieces.
PIECE = 1_000_000
#: Triples of a model's letters that a table may list; a model of more letters is searched.
MOST_TRIPLES = 8_000_000


def letters(text: Column) -> Column:
    """A text in lower case, with one space for whatever is no letter, also at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def _runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Characters of texts by runs of some ``PIECE``: numbers, where each piece starts and whose it is. After each piece are two zeros; pieces of a text overlap by two, so each trigram is in one."""
    held, owner, size = [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text or "") - 2, PIECE):
            held.append(text[at : at + PIECE + 2] + "\0\0")
            owner.append(k)
            size += len(held[-1])
            if size >= PIECE:
                yield _numbers(held), np.cumsum([0, *map(len, held[:-1])]), np.array(owner)
                held, owner, size = [], [], 0
    if held:
        yield _numbers(held), np.cumsum([0, *map(len, held[:-1])]), np.array(owner)


def _numbers(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``lang, gram, c``: the trigrams of each language's ``text`` and how often each is in a run."""
    for frame in frames:
        for lang, part in frame.groupby("lang"):
            for chars, _, _ in _runs(part["text"].tolist()):
                c = chars.astype(np.int64)
                whole = (c[:-2] > 0) & (c[1:-1] > 0) & (c[2:] > 0)
                codes, n = np.unique((c[:-2] << 42 | c[1:-1] << 21 | c[2:])[whole], return_counts=True)
                names = np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                yield pd.DataFrame({"lang": lang, "gram": [names[i : i + 3] for i in range(0, len(names), 3)], "c": n})


class Scores:
    """Sums of a model's scores over the trigrams of texts."""

    def __init__(self, grams: list[str], scores: np.ndarray):
        chars = _numbers(grams).reshape(-1, 3)
        alphabet = np.unique(chars)
        self.number = np.zeros(0x110000, np.int64)  # 0: no letter of the model
        self.number[alphabet] = np.arange(len(alphabet)) + 1
        self.base = len(alphabet) + 1
        codes = self._codes(chars[:, 0], chars[:, 1], chars[:, 2])
        order = np.argsort(codes)
        self.codes, self.scores = codes[order], np.vstack([scores[order], np.zeros((1, scores.shape[1]), np.int64)])  # last: no trigram of the model
        self.table = None
        if self.base**3 <= MOST_TRIPLES:
            self.table = np.full(self.base**3, len(codes), np.int32)
            self.table[self.codes] = np.arange(len(codes))

    def _codes(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (self.number[a] * self.base + self.number[b]) * self.base + self.number[c]

    def _places(self, chars: np.ndarray) -> np.ndarray:
        n = np.append(self.number[chars], [0, 0])
        codes = (n[:-2] * self.base + n[1:-1]) * self.base + n[2:]
        if self.table is not None:
            return self.table[codes]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, len(self.codes))

    def of(self, texts: list[str | None]) -> np.ndarray:
        """For each text how many of its trigrams the model has, and their summed scores."""
        out = np.zeros((len(texts), 1 + self.scores.shape[1]), np.int64)
        for chars, starts, owner in _runs(texts):
            place = self._places(chars)
            np.add.at(out[:, 0], owner, np.add.reduceat((place < len(self.codes)).astype(np.int64), starts))
            for k in range(self.scores.shape[1]):
                np.add.at(out[:, k + 1], owner, np.add.reduceat(self.scores[:, k][place], starts))
        return out


def fit_profiles(labelled: DataFrame, most: int = 5_000, lang: str = "lang", text: str = "text") -> DataFrame:
    """A model of the languages in ``labelled``: ``gram, lang, score``.

    Each language adds its ``most`` most frequent trigrams (ties: the first by
    name) to the vocabulary; ``score`` is the scaled logarithm of the share of a
    vocabulary's trigram in the language, with one added to every count. The
    table has ``most`` rows a language and language at most, whatever the size
    of ``labelled``. Null texts and null languages are left out. Tasks count
    the trigrams of their texts by runs, so that a row a run and trigram, not one
    for each place, is summed and shuffled.
    """
    ship(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), letters(F.col(text)).alias("text"))
    counts = rows.mapInPandas(_counted, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    counts = cut(counts)  # read three times
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "gram"))
    top = counts.withColumn("n", first).where(F.col("n") <= most).select("lang", "gram", "c")
    vocabulary, total = top.select("gram").distinct(), counts.groupBy("lang").agg(F.sum("c").alias("total"))
    size = vocabulary.agg(F.count("*").alias("v"))
    cells = total.crossJoin(F.broadcast(size)).crossJoin(vocabulary)  # languages times vocabulary, both bounded
    cells = cells.join(counts, ["lang", "gram"], "left")
    return cut(cells.select("gram", "lang", F.round(SCALE * F.log((F.coalesce("c", F.lit(0)) + 1) / (F.col("total") + F.col("v")))).cast("long").alias("score")))


def detect(texts: DataFrame, profiles: DataFrame, key: str, *columns: str) -> DataFrame:
    """``key`` and, for each of ``columns``, the likeliest language by ``profiles`` (ties: the first by name).

    ``unknown``: texts that are null, of ``SHORT`` characters or fewer without
    the white space at their ends, or without a trigram of the vocabulary. The
    profiles' table, whose size is bounded by how it was fitted and is checked
    here, is sent out, and each text's scores are summed where it is read, so
    that one row a text is shuffled. Rows of one key are told together.
    """
    names = sorted(r[0] for r in profiles.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = profiles.groupBy("gram").pivot("lang", names).agg(F.first("score")).toPandas() if names else pd.DataFrame({"gram": []})
    spark = texts.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((table["gram"].tolist(), table[names].fillna(0).to_numpy(np.int64).reshape(len(table), len(names))))

    def scored(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores = Scores(*model.value)
        for column in frames:
            yield pd.Series(list(scores.of(column.tolist())))

    score = F.pandas_udf(scored, "array<long>", F.PandasUDFType.SCALAR_ITER)
    parts = [F.when(F.length(F.trim(c)) > SHORT, letters(F.col(c))) for c in columns]
    one = texts.select(key, *[score(p).alias(f"_p{k}") for k, p in enumerate(parts)])
    sums = one.groupBy(key).agg(*[F.sum(F.col(f"_p{k}")[i]).alias(f"_p{k}_{i}") for k in range(len(columns)) for i in range(len(names) + 1)])

    def said(k: int) -> Column:
        scores = [F.col(f"_p{k}_{i + 1}") for i in range(len(names))]
        best = F.greatest(*scores, *[F.lit(None).cast("long")] * 2)
        return F.when(F.col(f"_p{k}_0") > 0, F.coalesce(*[F.when(c == best, F.lit(n)) for n, c in zip(names, scores, strict=True)], F.lit("unknown"))).otherwise(F.lit("unknown"))

    return sums.select(key, *[said(k).alias(c) for k, c in enumerate(columns)])


def split_by_language(articles: DataFrame, profiles: DataFrame, key: str = "paper_id", columns: tuple[str, ...] = ("title", "abstract"), lang: str = "en") -> tuple[DataFrame, DataFrame]:
    """Articles of which any of ``columns`` is in ``lang``, and the others, each with its languages ``said_<column>``."""
    told = detect(articles, profiles, key, *columns).select(key, *[F.col(c).alias(f"said_{c}") for c in columns])
    rows = articles.join(told, key)
    held = F.greatest(*[(F.col(f"said_{c}") == lang).cast("int") for c in columns], F.lit(0)) == 1
    return rows.where(held).select(*articles.columns), rows.where(~held)
