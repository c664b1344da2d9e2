"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mentionmill.llm.common import ship, tidy
from mentionmill.llm.html_blocks import HASHED, Blocks
from mentionmill.llm.html_pages import MAIN, OTHER, labelled_pages


def labelled(pages: list[str]) -> list[tuple[list[list[int]], np.ndarray]]:
    """Features and labels (1: article) of the blocks of marked pages."""
    split, out = Blocks(), []
    for page in pages:
        blocks = split.split(page)
        labels = np.array([t.count(MAIN) > t.count(OTHER) for t, _, _ in blocks], int)
        plain = [(t.replace(MAIN, "").replace(OTHER, ""), links, path) for t, links, path in blocks]
        if plain:
            out.append((split.features(plain), labels))
    return out


def _sums(unary: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: the probabilities of each block's label and of each neighbouring pair."""
    n = len(unary)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = unary[0]
    for i in range(1, n):
        ahead[i] = unary[i] + np.logaddexp(ahead[i - 1, 0] + move[0], ahead[i - 1, 1] + move[1])
    for i in range(n - 2, -1, -1):
        x = unary[i + 1] + back[i + 1]
        back[i] = np.logaddexp(move[:, 0] + x[0], move[:, 1] + x[1])
    whole = np.logaddexp(*ahead[-1])
    single = np.exp(ahead + back - whole)
    pair = np.exp(ahead[:-1, :, None] + move[None] + (unary[1:] + back[1:])[:, None, :] - whole) if n > 1 else np.zeros((0, 2, 2))
    return single, pair


@lru_cache(maxsize=4)
def train(n_pages: int = 400, epochs: int = 8, rate: float = 0.2, decay: float = 1e-5, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature by label) and transitions, by stochastic gradient ascent of the conditional likelihood with per-weight rates."""
    weight, move = np.zeros((HASHED, 2)), np.zeros((2, 2))
    seen, seen_move = np.full((HASHED, 2), 1e-2), np.full((2, 2), 1e-2)
    data, order = labelled(labelled_pages(n_pages, seed)), np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(data)):
            features, labels = data[k]
            flat = np.concatenate(features)
            which = np.repeat(np.arange(len(features)), [len(f) for f in features])
            unary = np.zeros((len(features), 2))
            np.add.at(unary, which, weight[flat])
            single, pair = _sums(unary, move)
            up = -single
            up[np.arange(len(labels)), labels] += 1
            step = np.zeros_like(move)
            np.add.at(step, (labels[:-1], labels[1:]), 1)
            step -= pair.sum(axis=0)
            ids, place = np.unique(flat, return_inverse=True)
            grad = np.zeros((len(ids), 2))
            np.add.at(grad, place, up[which])
            grad -= decay * len(data) * weight[ids]
            seen[ids] += grad**2
            weight[ids] += rate * grad / np.sqrt(seen[ids])
            seen_move += step**2
            move += rate * step / np.sqrt(seen_move)
    return weight, move


def viterbi(unary: np.ndarray, move: np.ndarray) -> list[int]:
    """The likeliest labels of a page's blocks."""
    if not len(unary):
        return []
    (m00, m01), (m10, m11) = move.tolist()
    a, b, back = *unary[0].tolist(), []
    for u0, u1 in unary[1:].tolist():
        from0, from1 = a + m00 < b + m10, a + m01 < b + m11
        back.append((from0, from1))
        a, b = u0 + (b + m10 if from0 else a + m00), u1 + (b + m11 if from1 else a + m01)
    label = int(b > a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


class Extractor:
    def __init__(self, weight: np.ndarray, move: np.ndarray):
        self.gap, self.move, self.blocks = weight, move, Blocks()

    def text(self, page: str) -> str:
        blocks = self.blocks.split(page)
        if not blocks:
            return ""
        features = self.blocks.features(blocks)
        unary = np.add.reduceat(self.gap[np.concatenate(features)], np.cumsum([0] + [len(f) for f in features[:-1]]), axis=0)
        return "\n".join(t for (t, _, _), keep in zip(blocks, viterbi(unary, self.move), strict=True) if keep)


def extract_text(pages: DataFrame, n_pages: int = 400, epochs: int = 8, seed: int = 5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: ``page_id, url, text, n_chars``.

    A page is cut into leaf blocks: text between the tags of block elements,
    character references decoded, white space made one space; scripts, styles
    and other raw elements have no blocks. Tags may be left out or unclosed as
    HTML allows, without loss of the text that follows. A linear-chain conditional random
    field with the tags, classes and ids of all ancestors, link share, length,
    punctuation, place and cue words as features marks the article's blocks; it
    is trained on ``n_pages`` made-up labelled pages and decoded by Viterbi.
    The marked blocks are joined by a line feed, nothing is capped.

    A null or empty page has the empty text; null ids and urls and repeated rows
    are kept as they are; an empty table gives an empty result; other columns
    are ignored. No shuffle; a task holds one batch of pages.
    """
    ship(pages.sparkSession)
    weight, move = train(n_pages, epochs, seed=seed)
    weight = weight.astype(np.float32)
    types = dict(pages.dtypes)
    arrow = [to_arrow_type(pages.schema[c].dataType) for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(weight, move)
        for batch in batches:
            texts = [extractor.text(p) if p else "" for p in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0).cast(arrow[0]), batch.column(1).cast(arrow[1]), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(tidy(run), f"page_id {types[id_col]}, url {types[url_col]}, text string, n_chars long")
