"""Best-fit packing of tokenized documents behind a Martello-Toth reduction."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mentionmill.llm.common import cut, ship, tidy

#: Texts of ASCII and the letters of Latin-1 are split here; others are left to the tokenizer.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")
#: The normalizer and pre-tokenizer, whole, that make the split above equal to the tokenizer's own.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: printable ones themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokens:
    """Token ids of texts, piece by piece, with the pieces' ids held.

    A tokenizer that lowers text and splits it into runs of letters, digits and
    runs of other signs has the ids of a text in those of its pieces, which are
    found here for plain texts and looked up in the model once each. Other
    texts, and other tokenizers, go to the tokenizer itself, word by word where
    white space ends tokens. Holds ``most`` pieces and ``most`` words at most;
    they are let go when a task ends.
    """

    own: dict[str, WordTokens] = {}

    def __init__(self, definition: str, most: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.held, self.words, self.most = Tokenizer.from_str(definition), {}, {}, most
        read = json.loads(definition)
        self.split = all(read.get(k) == v for k, v in RULES.items())
        self.letters = _byte_letters()

    @classmethod
    def of(cls, definition: str) -> WordTokens:
        key = hashlib.sha256(definition.encode()).hexdigest()
        if key not in cls.own:
            cls.own[key] = cls(definition)
        return cls.own[key]

    def clear(self) -> None:
        self.held.clear()
        self.words.clear()

    def _piece(self, piece: str) -> bytes:
        written = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
        return np.array([t.id for t in self.tokenizer.model.tokenize(written)], "<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        if not self.split:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.encode().split()  # at ASCII white space
        unknown = list({w for w in words if w not in self.words})
        if len(self.words) + len(unknown) > self.most:
            self.words.clear()
            unknown = list(set(words))
        for w, e in zip(unknown, self.tokenizer.encode_batch([w.decode() for w in unknown], add_special_tokens=False), strict=True):
            self.words[w] = np.array(e.ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        for text in texts:
            if not self.split or "<|" in text or not PLAIN.fullmatch(text):
                yield self._whole(text)
                continue
            pieces = PIECE.findall(text.lower())
            try:
                yield b"".join(map(self.held.__getitem__, pieces))
            except KeyError:
                unknown = {p for p in pieces if p not in self.held}
                if len(self.held) + len(unknown) > self.most:
                    self.held.clear()
                    unknown = set(pieces)
                for p in unknown:
                    self.held[p] = self._piece(p)
                yield b"".join(map(self.held.__getitem__, pieces))


def reduce_instance(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets that dominate all others with their largest item (Martello and Toth); ``counts`` keeps what is left.

    For the largest item ``j`` and the largest ``k`` that fits beside it: ``{j}``
    is fixed if nothing fits; ``{j, k}`` if they fill the bin, if no two items
    fit beside ``j``, or if no three do and no two sum to more than ``k``. Items
    of one size are fixed together.
    """
    fixed = []
    sizes = sorted(counts)
    for j in sorted(counts, reverse=True):
        while counts.get(j):
            rest = lambda x, j=j: counts[x] - (x == j)  # noqa: E731  items besides one j
            small = []
            for x in sizes:
                if counts[x] and (n := rest(x)) > 0:
                    small += [x] * min(3 - len(small), n)
                if len(small) == 3:
                    break
            room = capacity - j
            if not small or small[0] > room:
                fixed.append(((j,), counts[j]))
                counts[j] = 0
                break
            k = next(x for x in range(min(room, sizes[-1]), 0, -1) if counts.get(x) and rest(x) > 0)
            sure = k == room or len(small) < 2 or small[0] + small[1] > room
            if not sure and (len(small) < 3 or sum(small) > room):
                best, live = 0, [x for x in sizes if counts[x] and rest(x) > 0 and x <= room]
                a, b = 0, len(live) - 1
                while a <= b:
                    if live[a] + live[b] > room or (a == b and rest(live[a]) < 2):
                        b -= 1
                    else:
                        best, a = max(best, live[a] + live[b]), a + 1
                sure = k >= best
            if not sure:
                break
            n = counts[j] // 2 if k == j else min(counts[j], counts[k])
            fixed.append(((j, k), n))
            counts[j] -= n
            counts[k] -= n
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: each item goes to the open bin that it leaves the least room in."""
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [items, bins]
    many = np.zeros(capacity + 1, np.int64)

    def put(items: tuple, bins: int) -> None:
        room = capacity - sum(items)
        open_[room].append([items, bins])
        many[room] += bins

    for w in sorted(counts, reverse=True):
        left = counts[w]
        while left:
            fits = np.flatnonzero(many[w:])
            if not len(fits):
                each = capacity // w
                if left >= each:
                    put((w,) * each, left // each)
                if left % each:
                    put((w,) * (left % each), 1)
                break
            room = int(fits[0]) + w
            group = open_[room][-1]
            each = min(room // w, left)
            bins = min(group[1], left // each)
            group[1] -= bins
            many[room] -= bins
            if not group[1]:
                open_[room].pop()
            put(group[0] + (w,) * each, bins)
            left -= bins * each
    return [(items, bins) for groups in open_.values() for items, bins in groups]


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows ``(length, first rank, first sequence, offset)``: the items of a length, by rank, fill the slots in order.

    The rows depend on the distinct lengths, ``capacity`` of them at most, not on the number of items.
    """
    left = dict(counts)
    groups = reduce_instance(left, capacity) + best_fit({w: n for w, n in left.items() if n}, capacity)
    used, sequence, rows = defaultdict(int), 0, []
    for items, bins in groups:
        offset = 0
        for w in items:
            rows.append((w, used[w], sequence, offset))
            used[w] += bins
            offset += w
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, rows_per_bucket: int = 20_000, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize documents, cut those over ``capacity`` into pieces, and pack the pieces into few sequences.

    A document is its ids and ``end_id``; only longer ones are cut, the last
    piece may be shorter. The plan is made from the histogram of lengths (at
    most ``capacity`` numbers, whatever the input): sets that provably dominate
    are fixed, the rest goes best-fit. Pieces are ranked within their length
    (in hash buckets, so that a common length is no hot task) and take the
    plan's slots by rank.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and,
    with ``with_ids``, ``ids``. A null text is empty and becomes ``end_id``
    alone; null and repeated ids are kept as they are; pieces alike in length are
    ranked by a hash of id, piece and ids, and ties of it by those; an empty table gives an
    empty result; other columns are ignored. Memory follows the longest text.
    """
    ship(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    last = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens.of(definition)
        try:
            yield from with_tokens(words, batches)
        finally:
            words.clear()

    def with_tokens(words: WordTokens, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = [t or "" for t in batch.column(1).to_pylist()], []
            for i, ids in zip(batch.column(0).to_pylist(), words.encode(texts), strict=True):
                ids += last
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((i, p, at // 4, len(part) // 4, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype(np.int64)] if with_ids else [])))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = cut(rows.mapInArrow(tidy(tokenized), schema))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    slots = plan(counts, capacity)
    firsts = (slots[:, 0] << 40) + slots[:, 1]

    buckets = max(1, -(-sum(counts.values()) // rows_per_bucket))
    ties = ("h", "doc_id", "piece", "ids_crc32", "start")
    pieces = pieces.withColumn("h", F.xxhash64("doc_id", "piece", "ids_crc32")).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    ranked = pieces.withColumn("inside", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*ties))).join(sizes, ["length", "bucket"])
    ranked = ranked.select(*names, (F.col("before") + F.col("inside") - 1).cast("long").alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(firsts, (length << 40) + rank, side="right") - 1
            more = [pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *more], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(placed, schema + ", sequence_id long, offset long")
