"""Toxicity grades by cumulative-link ordinal regression."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mentionmill.llm.common import ship, tidy

WORD = re.compile(r"[^\W\d_]+")
BITS = 20
GRADES = 4  # none, mild, strong, severe


class Features:
    """Hashed features of a text: each distinct word and its beginnings of three to eight letters; of those in ``only`` if that is given."""

    def __init__(self, only: np.ndarray | None = None, most: int = 100_000):
        self.words: dict[str, tuple[int, ...]] = {}
        self.only, self.most = None if only is None else frozenset(only.tolist()), most

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.most:
                self.words.clear()
            names = [f"={word}"] + [f"^{word[:n]}" for n in range(3, min(8, len(word)) + 1)]
            ids = (zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names)
            found = self.words[word] = tuple(i for i in ids if self.only is None or i in self.only)
        return found

    def of(self, text: str) -> np.ndarray:
        ids = {i for w in set(WORD.findall(text.lower())) for i in self.of_word(w)}
        return np.fromiter(ids, np.uint32, len(ids))


def _rows_with(features: list[np.ndarray]) -> np.ndarray:
    """How many rows have each feature."""
    n = np.zeros(1 << BITS, np.int32)
    for f in features:
        n[f] += 1  # a row has a feature once
    return n


def without_copies(features: list[np.ndarray], bands: int = 10, rows: int = 3) -> np.ndarray:
    """Rows that share no MinHash band with an earlier one: copies and near copies would make any of their words telling.

    Features of more than a twentieth of the rows say nothing about copies and
    are left out, unless a row has no others.
    """
    common = _rows_with(features) > max(2, len(features) / 20)
    factors = (np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    seen, out = set(), []
    for k, f in enumerate(features):
        f = rare if len(rare := f[~common[f]]) else f
        least = (np.multiply.outer(factors, f.astype(np.uint64) + np.uint64(1)).min(axis=1) if len(f) else np.zeros(bands * rows, np.uint64)).reshape(bands, rows)
        keys = {(j, band.tobytes()) for j, band in enumerate(least)}
        if seen.isdisjoint(keys):
            out.append(k)
        seen |= keys
    return np.array(out, int)


def telling(features: list[np.ndarray], toxic: np.ndarray, least: float = 6.5, purity: float = 0.75) -> np.ndarray:
    """Features that toxic rows have ``least`` standard deviations more often than chance allows, and clean rows hardly ever."""
    n, bad = _rows_with(features), _rows_with([f for f, t in zip(features, toxic, strict=True) if t])
    share = toxic.mean() if len(toxic) else 0.0
    spread = np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return np.flatnonzero((bad - n * share > least * spread) & (bad >= purity * n))


def grades(texts: list[str], toxic: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Severity of labelled rows, whose labels say toxic or not: 0 for clean ones, 1 to 3 for toxic ones by thirds of the share of words with a telling feature."""
    split = Features(ids)
    share = np.zeros(len(texts))
    for k in np.flatnonzero(toxic):
        words = WORD.findall(texts[k].lower())
        share[k] = sum(bool(split.of_word(w)) for w in words) / max(1, len(words))
    out = np.zeros(len(texts), int)
    if toxic.any():
        cuts = np.quantile(share[toxic == 1], [1 / 3, 2 / 3])
        out[toxic == 1] = 1 + (share[toxic == 1][:, None] > cuts[None]).sum(axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit(features: list[np.ndarray], y: np.ndarray, ids: np.ndarray, ridge: float = 1e-4, steps: int = 1000, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportional odds: ``P(grade > k) = sigmoid(w.x - theta_k)`` with one weight vector for all thresholds.

    Full-batch Adam on the mean log likelihood with a ridge, over the features
    ``ids``; all of them tell of toxicity, so weights are kept from below zero.
    Thresholds stay ordered, as the first and logarithms of the gaps.
    Returns feature ids, weights and thresholds.
    """
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    place = np.searchsorted(ids, np.concatenate(features) if features else np.zeros(0, np.int64))
    params = np.concatenate([np.zeros(len(ids)), [1.0, 0.0, 0.0]])
    first, second = np.zeros_like(params), np.zeros_like(params)
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y == 0).sum())))  # classes count alike
    for t in range(1, steps + 1):
        w, theta = params[: len(ids)], params[-3] + np.concatenate([[0], np.cumsum(np.exp(params[-2:]))])
        score = np.bincount(row, weights=w[place], minlength=len(y))
        over = _sigmoid(score[:, None] - theta[None])  # P(grade > k)
        padded = np.concatenate([np.ones((len(y), 1)), over, np.zeros((len(y), 1))], axis=1)
        p = np.maximum(padded[np.arange(len(y)), y] - padded[np.arange(len(y)), y + 1], 1e-12)
        slope = np.concatenate([np.zeros((len(y), 1)), over * (1 - over), np.zeros((len(y), 1))], axis=1)
        each = (weight / p / len(y))[:, None] * (np.eye(GRADES + 1)[y] - np.eye(GRADES + 1)[y + 1])[:, 1:-1] * slope[:, 1:-1]  # d log p / d (score - theta)
        d_theta = -each.sum(axis=0)
        grad = np.concatenate([np.bincount(place, weights=each.sum(axis=1)[row], minlength=len(ids)), [d_theta.sum(), np.exp(params[-2]) * d_theta[1:].sum(), np.exp(params[-1]) * d_theta[2]]])
        grad[: len(ids)] -= ridge * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        params = params + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        params[: len(ids)] = np.maximum(params[: len(ids)], 0)
    return ids, params[: len(ids)], params[-3] + np.concatenate([[0], np.cumsum(np.exp(params[-2:]))])


def fit_on(docs: DataFrame, labels: DataFrame, max_rows: int = 15_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fit on labelled documents, at most ``max_rows`` of them, chosen by the hash of their ids.

    The chosen ids, a bounded number, are sent to the texts, which stay where they are.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.join(F.broadcast(known), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("id").toArrow()
    texts, toxic = rows["text"].to_pylist(), np.array(rows["toxic"].to_pylist(), int).reshape(-1)
    return fit_texts(texts, toxic)


def fit_texts(texts: list[str], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    split = Features()
    found = [split.of(t) for t in texts]
    first = without_copies(found)
    ids = telling([found[k] for k in first], toxic[first])
    only = Features(ids)
    return fit([only.of(t) for t in texts], grades(texts, toxic, ids), ids)


def expected_severity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The severity of every document: ``doc_id, expected_severity, grade, p_toxic, toxic``.

    ``expected_severity`` is the mean grade (0 to 3) under the model, ``grade``
    the likeliest grade, ``toxic`` whether grade 1 or more is likelier than not.
    Whole texts are read. A null text is an empty one; null and repeated ids are
    kept as they are; an empty table gives an empty result; other columns are
    ignored. No shuffle; the model has one weight a feature that the fit kept.
    """
    ship(docs.sparkSession)
    ids, w, theta = model
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, weight = Features(ids), np.zeros(1 << BITS)
        weight[ids] = w
        for batch in batches:
            score = np.array([weight[split.of(t)].sum() if t else 0.0 for t in batch.column(1).to_pylist()])
            over = _sigmoid(score[:, None] - theta[None])
            padded = np.concatenate([np.ones((len(score), 1)), over, np.zeros((len(score), 1))], axis=1)
            likeliest = (padded[:, :-1] - padded[:, 1:]).argmax(axis=1)
            columns = [batch.column(0), pa.array(over.sum(axis=1)), pa.array(likeliest, pa.int32()), pa.array(over[:, 0]), pa.array(over[:, 0] > 0.5)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "expected_severity", "grade", "p_toxic", "toxic"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, expected_severity double, grade int, p_toxic double, toxic boolean")
