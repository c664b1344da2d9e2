"""Removal of repeated word windows behind a count-min prefilter."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mentionmill.llm import blocks as B
from mentionmill.llm.blocks import U

ROW_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class Windows:
    """The words of a block's texts and the hashes of their windows of ``span`` words."""

    def __init__(self, row: dict, span: int):
        self.ids, self.buffer, starts, ends = B.read_block(row)
        self.order = B.order_ids(self.ids)
        is_word = ~((self.buffer == 32) | ((self.buffer >= 9) & (self.buffer <= 13)))
        edge = np.flatnonzero(np.diff(is_word.view(np.int8), prepend=0, append=0))
        self.begin, self.end = edge[::2], edge[1::2]
        self.doc = np.searchsorted(starts, self.begin, side="right") - 1
        self.n_words = np.bincount(self.doc, minlength=len(self.ids))
        n = len(self.begin) - span + 1
        self.at = np.flatnonzero(self.doc[: max(n, 0)] == self.doc[span - 1 :]) if n > 0 else np.zeros(0, np.int64)
        self.h1 = self._hash(0, span)
        self.h2 = (self._hash(1, span) >> U(32)).astype(np.uint32)

    def _hash(self, family: int, span: int) -> np.ndarray:
        words = B.word_hashes(self.buffer, self.begin, self.end, family)
        out, factor = np.zeros(max(0, len(words) - span + 1), U), U(0x9FB21C651E98DF25)
        for i in range(span):
            out *= factor
            out += words[i : len(words) - span + 1 + i]
        return B.mix(out)[self.at]


def repeated_windows(docs: DataFrame, span: int = 13, depth: int = 2, cells_a_window: int = 4, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2_000_000, with_text: bool = False) -> DataFrame:
    """Remove each word covered by a window of ``span`` words whose words also start in a document with a smaller id.

    First pass: every block sketches its windows in a count-min sketch with
    ``depth`` rows of ``cells_a_window`` cells for each window of the corpus
    (estimated from its bytes). The sketch is cut into shards by cell; a shard
    adds up the blocks' sketches and answers which cells hold two or more. The
    sum is never smaller than the true count, so no repeated window is lost.
    Second pass: only windows estimated repeated are grouped exactly, by 96-bit
    hash, for their smallest id. No sketch or answer is sent to all executors,
    so its width follows the corpus; a window in a third of all documents is one
    entry a block.

    Returns ``doc_id, n_words, n_removed, kept_sha256`` (of the kept words
    joined by one space) and, with ``with_text``, ``kept`` (that text). A null
    text has no words; a null id is larger than any other; rows with one id do
    not repeat each other; an empty table gives an empty result; other columns
    are ignored. A block holds whole texts: a task needs about 60 bytes of
    memory for a byte of the longest.
    """
    blocks = B.pack(docs, id_col, text_col, block_bytes)
    total = blocks.agg(F.sum("n_bytes")).collect()[0][0] or 0
    width_bits = min(60, max(16, int(cells_a_window * max(total, 1) / 6 - 1).bit_length()))
    sketch_bits = max(0, min(width_bits - 23, max(6, width_bits - 26)))  # 8 million cells a shard, 64 million of large inputs
    exact_bits = B.shard_bits_for(total, 32_000_000)

    def cells(w: Windows):
        for j in range(depth):
            yield j, (w.h1 * U(ROW_FACTORS[j % 4]) + U(j)) >> U(64 - width_bits)

    def edges(cell: np.ndarray) -> np.ndarray:
        return np.searchsorted(cell >> U(width_bits - sketch_bits), np.arange((1 << sketch_bits) + 1).astype(U))

    def ask_counts(row):
        sent, w = {}, Windows(row, span)
        for j, cell in cells(w):
            found, n = np.unique(cell, return_counts=True)
            cut = edges(found)
            for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if b > a:
                    low = (found[a:b] & U((1 << (width_bits - sketch_bits)) - 1)).astype(np.uint32)
                    sent[j << sketch_bits | s] = B.encode(B.deltas(low), (n[a:b] > 1).view(np.uint8))
        return sent

    def add_up(bodies):
        sums, out = np.zeros(1 << (width_bits - sketch_bits), np.uint8), []
        for body in bodies:  # counts beyond two say no more
            low, many = B.decode(body, "<u4", "u1")
            at = np.cumsum(low, dtype=np.uint32)
            sums[at] = np.minimum(sums[at] + 1 + many, 2)
        for body in bodies:
            at = np.cumsum(B.decode(body, "<u4", "u1")[0], dtype=np.uint32)
            out.append(B.bits(sums[at] > 1))
        return out

    def estimated(w: Windows, replies) -> np.ndarray:
        """Windows whose smallest count over the rows of the sketch is two or more."""
        likely = np.ones(len(w.h1), bool)
        for j, cell in cells(w):
            found, place = np.unique(cell, return_inverse=True)
            cut, told = edges(found), np.zeros(len(found), bool)
            for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if b > a:
                    told[a:b] = B.unbits(replies[1, j << sketch_bits | s], b - a)
            likely &= told[place]
        return likely

    def groups(w: Windows, replies):
        likely = np.flatnonzero(estimated(w, replies))
        u1, u2, _, place = B.distinct(w.h1[likely], w.h2[likely])
        least = np.full(len(u1), B.LAST)
        np.minimum.at(least, place, w.order[w.doc[w.at[likely]]])
        cut = np.searchsorted(u1 >> U(64 - exact_bits) if exact_bits else np.zeros(len(u1), U), np.arange((1 << exact_bits) + 1).astype(U))
        return likely, u1, u2, place, least, list(enumerate(zip(cut[:-1], cut[1:], strict=True)))

    def ask_smallest(row):
        _, u1, u2, _, least, parts = groups(Windows(row, span), row["replies"])
        return {s: B.encode(B.deltas(u1[a:b]), u2[a:b], least[a:b]) for s, (a, b) in parts if b > a}

    def smaller_elsewhere(bodies):
        read = [B.decode(b, "<u8", "<u4", "<i8") for b in bodies]
        k1, k2, least = (np.concatenate(x) for x in ([np.cumsum(r[0], dtype=U) for r in read], [r[1] for r in read], [r[2] for r in read]))
        u1, _, _, place = B.distinct(k1, k2)
        first = np.full(len(u1), B.LAST)
        np.minimum.at(first, place, least)
        flags, at, out = first[place] < least, 0, []
        for r in read:
            out.append(B.bits(flags[at : at + len(r[0])]))
            at += len(r[0])
        return out

    def told(row):
        w = Windows(row, span)
        likely, u1, _, place, least, parts = groups(w, row["replies"])
        elsewhere = np.zeros(len(u1), bool)
        for s, (a, b) in parts:
            if b > a:
                elsewhere[a:b] = B.unbits(row["replies"][2, s], b - a)
        hit = w.at[likely][elsewhere[place] | (w.order[w.doc[w.at[likely]]] > least[place])]
        edge = np.zeros(len(w.begin) + 1, np.int32)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + span, -1)
        gone = np.cumsum(edge[:-1]) > 0
        lost = np.bincount(w.doc[gone], minlength=len(w.ids))
        # Each kept word and the byte after it, made a space.
        text = np.append(w.buffer, np.uint8(32))
        step = np.zeros(len(text) + 1, np.int8)
        step[w.begin[~gone]] = 1
        step[w.end[~gone]] -= 1
        keep = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        keep[w.end[~gone]] = True
        text[w.end[~gone]] = 32
        size = np.bincount(w.doc[~gone], weights=(w.end - w.begin + 1)[~gone], minlength=len(w.ids)).astype(np.int64)
        upto, out = np.concatenate([[0], np.cumsum(size)]), text[keep].tobytes()
        lines = []
        for i, ident in enumerate(w.ids):
            kept = out[upto[i] : max(upto[i], upto[i + 1] - 1)]
            lines.append([ident, int(w.n_words[i]), int(lost[i]), hashlib.sha256(kept).hexdigest(), *([kept.decode("utf-8", "replace")] if with_text else [])])
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines, strict=True), kinds, strict=True)], names=names)

    kinds, names = [pa.int64(), pa.int64(), pa.int64(), pa.string()], ["doc_id", "n_words", "n_removed", "kept_sha256"]
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        kinds, names, schema = [*kinds, pa.string()], [*names, "kept"], schema + ", kept string"
    counts = B.ask(blocks, [], 1, ask_counts, add_up)
    smallest = B.ask(blocks, [counts], 2, ask_smallest, smaller_elsewhere)
    return B.finish(blocks, [counts, smallest], told, schema)


SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, s, array_to_string(words[s:s + 12], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM doc WHERE len(words) >= 13)
), hit AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY content) AS first FROM win) WHERE first < doc_id
), gone AS (
  SELECT DISTINCT doc_id, s + d AS i FROM hit, (SELECT unnest(range(0, 13)) AS d)
), word AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM doc
), told AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.i) AS n_removed, coalesce(string_agg(w.w, ' ' ORDER BY w.i) FILTER (g.i IS NULL), '') AS kept
  FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(t.n_words, 0)::BIGINT AS n_words, coalesce(t.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN told t ON d.doc_id = t.doc_id
"""
