"""Removal of repeated byte strings by bucket-pointer refinement."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mentionmill.llm import blocks as B
from mentionmill.llm.blocks import U

Q = 25


class Suffixes:
    """The suffixes of a block's texts with their bucket pointers.

    ``pointer(h)`` names the bucket of each suffix at depth ``h``. The first are
    those of ``Q``-byte grams; at twice a depth a pointer is made of the
    pointers, at the present depth, of the suffix and of the one ``h`` bytes
    later. Equal pointers mean equal strings.
    """

    def __init__(self, row: dict, length: int):
        self.length = length
        self.ids, self.buffer, self.starts, self.ends = B.read_block(row)
        self.first = B.Rolling(self.buffer, 0)
        self.check = B.Rolling(self.buffer, 1)
        self.buckets = {Q: B.mix(self.first.grams(Q))}
        n = len(self.buffer)
        self.doc_end = np.repeat(self.ends, self.ends - self.starts + 1)
        self.doc_start = np.repeat(self.starts, self.ends - self.starts + 1)
        self.valid = np.arange(n) + length <= self.doc_end
        self._anchors()

    def pointer(self, h: int) -> np.ndarray:
        if h not in self.buckets:
            half = self.pointer(h // 2)
            here = half[: max(0, len(half) - h // 2)] * U(0x9E3779B97F4A7C15)
            here += half[h // 2 :]
            here ^= here >> U(32)
            here *= U(0xD6E8FEB86659FD93)
            self.buckets[h] = here
        return self.buckets[h]

    def key(self, start: np.ndarray, size: int, *salt) -> tuple[np.ndarray, np.ndarray]:
        """Names of the strings of ``size`` bytes at ``start``: the pointers of two overlapping halves, and a second hash."""
        h = Q
        while 2 * h <= size and h < 200:
            h *= 2
        rest = np.arange(0, size - h, h).tolist() + [size - h]
        k = np.full(len(start), U(size))
        for at in rest:
            k = B.mix(k * U(0x9E3779B97F4A7C15) + self.pointer(h)[start + at])
        for s in salt:
            k = B.mix(k + np.asarray(s).astype(U) * U(0xA24BAED4963EE407))
        return k, (self.check.of(start, start + size) >> U(32)).astype(np.uint32)

    def _anchors(self) -> None:
        """For each valid window of ``length`` bytes the place of its smallest gram of depth 50 (the leftmost): ``spans`` of neighbouring starts with one anchor."""
        self.depth = 2 * Q
        self.window = w = self.length - self.depth + 1
        grams = self.pointer(self.depth)
        starts = np.flatnonzero(self.valid)
        if not len(starts):
            self.spans = np.zeros((3, 0), np.int64)
            return
        keys = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
        rows = -(-len(keys) // w) + 1
        wide = np.full(rows * w, U(2**64 - 1))
        wide[: len(keys)] = keys
        wide = wide.reshape(rows, w)
        before = np.minimum.accumulate(wide, axis=1).ravel()
        after = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(after[starts], before[starts + w - 1]) & U(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        firsts = np.flatnonzero(new)
        self.spans = np.array([at[firsts], starts[firsts], starts[np.append(firsts[1:], len(starts)) - 1]])  # anchor, first and last start

    # The three depths at which buckets are refined ----------------------------

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        return self.key(self.spans[0], self.depth)

    def cells(self, live: np.ndarray):
        """Runs of 16 neighbouring starts, counted back from their anchor, that hold windows of live anchors: ``(anchor, first, last, cell)``."""
        anchor, first, last = self.spans[:, live]
        low, high = (anchor - last) >> 4, (anchor - first) >> 4
        n = high - low + 1
        which = np.repeat(np.arange(len(n)), n)
        cell = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]
        return anchor[which], first[which], last[which], cell

    def cell_keys(self, cells) -> tuple[np.ndarray, ...]:
        """What all windows of a cell share (385 bytes for 400), and what holds them all (415); zeros where the latter leaves the text."""
        anchor, _, _, cell = cells
        core = anchor - 16 * cell
        gram = self.pointer(self.depth)[anchor]
        inside = (core - 15 >= self.doc_start[core]) & (core + self.length <= self.doc_end[core])
        hull = np.zeros(len(core), U), np.zeros(len(core), np.uint32)
        hull[0][inside], hull[1][inside] = self.key(core[inside] - 15, self.length + 15, cell[inside], gram[inside])
        return *self.key(core, self.length - 15, cell, gram), *hull

    def windows(self, cells, unsure: np.ndarray) -> np.ndarray:
        """The starts in unsure cells."""
        anchor, first, last, cell = (x[unsure] for x in cells)
        low, high = np.maximum(first, anchor - 16 * cell - 15), np.minimum(last, anchor - 16 * cell)
        n = high - low + 1
        which = np.repeat(np.arange(len(n)), n)
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]


def _live(s: Suffixes, row: dict, shard_bits: int) -> np.ndarray:
    return B.repeated_keys(*s.grams(), row["replies"], 1, shard_bits)


UNIQUE, WHOLE, SHOWN, UNSURE = range(4)


def _sorted_cells(keys) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts cells by core and hull, where a new core and a new pair begin, and each cell's pair."""
    order = np.lexsort(keys[::-1])
    c1, c2, h1, h2 = (k[order] for k in keys)
    core, pair = np.ones(len(order), bool), np.ones(len(order), bool)
    core[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
    pair[1:] = core[1:] | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(pair) - 1
    return order, core, pair, place


def _cell_parts(keys, shard_bits: int):
    """The distinct pairs of core and hull, how often each occurs, each cell's pair, the first cell of each, and the range of every shard."""
    order, _, pair, place = _sorted_cells(keys)
    first = np.flatnonzero(pair)
    found = [k[order[first]] for k in keys]
    shard = (found[0] >> U(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(first), np.int64)
    edges = np.searchsorted(shard, np.arange((1 << shard_bits) + 1))
    parts = [(s, a, b) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
    return found, np.diff(np.append(first, len(order))), place, order[first], parts


def _answer_cells(bodies: list[bytes]) -> list[bytes]:
    """For each pair of each message: core unique; hull repeated; hull repeated and this block shows its windows to the core's others; hull unique."""
    read = [B.decode(b, "<u8", "<u4", "<u8", "<u4", "u1") for b in bodies]
    keys = [np.concatenate([np.cumsum(r[0], dtype=U) for r in read]), *(np.concatenate([r[i] for r in read]) for i in (1, 2, 3))]
    many = np.concatenate([r[4] for r in read])
    order, core, pair, _ = _sorted_cells(keys)  # stable: a pair's first message comes first
    core_no, pair_no, weight = np.cumsum(core) - 1, np.cumsum(pair) - 1, 1 + many[order]
    core_n, pair_n = np.bincount(core_no, weights=weight)[core_no], np.bincount(pair_no, weights=weight)[pair_no]
    kinds = np.bincount(core_no, weights=pair)[core_no]
    whole = (pair_n > 1) & ((keys[2][order] != 0) | (keys[3][order] != 0))
    told = np.where(whole, np.where((kinds > 1) & pair, SHOWN, WHOLE), np.where(core_n > 1, UNSURE, UNIQUE)).astype(np.uint8)
    codes, at, out = np.empty_like(told), 0, []
    codes[order] = told
    for r in read:
        out.append(B.encode(codes[at : at + len(r[0])]))
        at += len(r[0])
    return out


def _judged(s: Suffixes, row: dict, shard_bits: int):
    """Cells of live anchors, which are repeated as a whole, the windows to compare, and the windows shown to them."""
    cells = s.cells(_live(s, row, shard_bits))
    _, n, place, first, parts = _cell_parts(s.cell_keys(cells), shard_bits)
    code = np.zeros(len(n), np.uint8)
    for shard, a, b in parts:
        code[a:b] = B.decode(row["replies"][2, shard], "u1")[0]
    shown = np.zeros(len(place), bool)
    shown[first[code == SHOWN]] = True
    code = code[place]
    return s.windows(cells, (code == WHOLE) | (code == SHOWN)), s.windows(cells, code == UNSURE), s.windows(cells, shown)


def repeated_bytes(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2_000_000, with_text: bool = False) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts anywhere else in the corpus.

    Buckets of suffixes are refined in rounds, in which blocks of texts send
    shards the bucket pointers of suffixes that are still in question and learn
    which buckets hold others. (1) Buckets of 50-byte grams, of those suffixes
    only that are the smallest gram of a window of ``length`` bytes, so that
    every repeated window has one in a shared bucket. (2) Around grams that
    recur, pointers at depth ``length`` minus and plus 15 for cells of 16
    neighbouring windows: the smaller unique, none of them recurs; the larger
    repeated, all do. (3) The windows of the remaining cells at ``length``, and
    those of one repeated cell of each kind that shares their smaller bucket. A
    pointer at any depth is made of pointers of later offsets at a smaller
    depth; no round moves texts.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with
    ``with_text``, ``spans`` (start and end bytes) and ``kept`` (binary). A null
    text has no bytes; rows with one id are judged as separate texts; an empty
    table gives an empty result; other columns are ignored. A block holds whole
    texts: a task needs about 150 bytes of memory for a byte of the longest.
    """
    if length < 6 * Q:
        raise ValueError(f"strings of {length} bytes are too short: {6 * Q} at least")
    blocks = B.pack(docs, id_col, text_col, block_bytes)
    total = blocks.agg(F.sum("n_bytes")).collect()[0][0] or 0
    sb = B.shard_bits_for(total, 32_000_000)

    def ask_grams(row):
        s = Suffixes(row, length)
        return B.send_keys(*s.grams(), sb)

    def ask_cells(row):
        s = Suffixes(row, length)
        found, n, _, _, parts = _cell_parts(s.cell_keys(s.cells(_live(s, row, sb))), sb)
        return {shard: B.encode(B.deltas(found[0][a:b]), *(k[a:b] for k in found[1:]), (n[a:b] > 1).view(np.uint8)) for shard, a, b in parts}

    def ask_windows(row):
        s = Suffixes(row, length)
        _, tried, shown = _judged(s, row, sb)
        return B.send_keys(*s.key(np.concatenate([tried, shown]), length), sb)

    def told(row):
        s = Suffixes(row, length)
        sure, tried, shown = _judged(s, row, sb)
        again = B.repeated_keys(*s.key(np.concatenate([tried, shown]), length), row["replies"], 3, sb)
        hit = np.concatenate([sure, tried[again[: len(tried)]]])
        edge = np.zeros(len(s.buffer) + 1, np.int32)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        rise[s.starts] = gone[s.starts]
        fall = gone.copy()
        fall[:-1] &= ~gone[1:]
        runs = np.concatenate([[0], np.cumsum(rise)])
        lost = np.concatenate([[0], np.cumsum(gone)])
        out = []
        for i, a, b in zip(s.ids, s.starts.tolist(), s.ends.tolist(), strict=True):
            kept = s.buffer[a:b][~gone[a:b]].tobytes()
            line = [i, b - a, int(lost[b] - lost[a]), int(runs[b] - runs[a]), hashlib.sha256(kept).hexdigest()]
            if with_text:
                line += [[{"start": int(x), "end": int(y) + 1} for x, y in zip(np.flatnonzero(rise[a:b]), np.flatnonzero(fall[a:b]), strict=True)], kept]
            out.append(line)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names, schema = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        kinds += [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        names, schema = [*names, "spans", "kept"], schema + ", spans array<struct<start:long,end:long>>, kept binary"
    grams = B.ask(blocks, [], 1, ask_grams, B.answer_repeated)
    cells = B.ask(blocks, [grams], 2, ask_cells, _answer_cells)
    windows = B.ask(blocks, [grams, cells], 3, ask_windows, B.answer_repeated)
    return B.finish(blocks, [grams, cells, windows], told, schema)


#: Names of strings double from one byte to 256 (the number of the first start of an equal string, so nothing is hashed); two of them name 400 bytes.
SQL = r"""
WITH doc AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS d, hex(encode(coalesce(text, ''))) AS body FROM documents
), b1 AS MATERIALIZED (
  SELECT d, unnest(found) AS x, generate_subscripts(found, 1) AS p FROM (SELECT d, regexp_extract_all(body, '..') AS found FROM doc)
), n1 AS (
  SELECT d, p, ('0x' || x)::BIGINT AS n, row_number() OVER () AS g FROM b1
),
@doubling
w AS (
  SELECT d, p, n, lead(n, 144) OVER (PARTITION BY d ORDER BY p) AS m FROM n256
), hit AS (
  SELECT d, p FROM (SELECT d, p, count(*) OVER (PARTITION BY n, m) AS c FROM w WHERE m IS NOT NULL) WHERE c > 1
), cell AS (
  SELECT b.d, b.p, b.x, coalesce(b.p - max(h.p) OVER (PARTITION BY b.d ORDER BY b.p) < 400, false) AS gone FROM b1 b LEFT JOIN hit h ON b.d = h.d AND b.p = h.p
), edge AS (
  SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY d ORDER BY p) AS rise FROM cell
), told AS (
  SELECT d, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (rise) AS n_spans, string_agg(x, '' ORDER BY p) FILTER (NOT gone) AS kept FROM edge GROUP BY d
)
SELECT doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM doc LEFT JOIN told USING (d)
""".replace("@doubling", "".join(
    f"l{2 * k} AS (SELECT d, p, g, n, lead(n, {k}) OVER (PARTITION BY d ORDER BY p) AS m FROM n{k}),\n"
    f"n{2 * k} AS (SELECT d, p, g, min(g) OVER (PARTITION BY n, m) AS n FROM l{2 * k} WHERE m IS NOT NULL),\n"
    for k in (1, 2, 4, 8, 16, 32, 64, 128)
))
