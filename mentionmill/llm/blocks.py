"""Text blocks that ask hash shards about their fingerprints.

A corpus is packed into blocks of some megabytes (compressed texts and their
ids), hash-partitioned by block and checkpointed, so that later rounds join
answers to blocks without moving texts again. In a round every block sends each
shard of the hash space one message with its distinct fingerprints, sorted; the
shard merges the messages of all blocks and answers each of them in the same
order, often with one bit a fingerprint. A fingerprint that a third of all
documents hold is one entry a block, so no shard or task is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionmill.llm.common import LAST, cut, give_back, ship, tidy

U = np.uint64
BLOCK = "block long, ids array<long>, lens array<long>, n_bytes long, body binary"
MESSAGE = "shard int, block long, body binary"
REPLY = "block long, step int, shard int, body binary"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Rolling:
    """Hashes of any byte range of a buffer from prefix sums of a polynomial over random byte values, modulo 2**64."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buffer: np.ndarray, family: int):
        values = mix(np.arange(256, dtype=U) + U(1 + 256 * (family + 1)))
        base = int(mix(np.array([family + 77], dtype=U))[0]) | 5
        held = self.powers.get(family)
        if held is None or len(held[0]) <= len(buffer):
            n = max(1 << 20, 1 << int(len(buffer) + 1).bit_length())
            held = tuple(np.concatenate([np.ones(1, U), np.cumprod(np.full(n, b % 2**64, dtype=U))]) for b in (base, pow(base, -1, 2**64)))
            if n <= 1 << 23:
                self.powers[family] = held
        self.inverse = held[1]
        self.sums = np.zeros(len(buffer) + 1, dtype=U)
        np.cumsum(values[buffer] * held[0][: len(buffer)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def grams(self, q: int) -> np.ndarray:
        """Hashes of all ranges of ``q`` bytes."""
        n = len(self.sums) - q
        return (self.sums[q:] - self.sums[:n]) * self.inverse[:n] if n > 0 else np.zeros(0, U)


MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=U)


def word_hashes(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray, family: int) -> np.ndarray:
    """64-bit names of the byte ranges: their lanes of 8 bytes, each scrambled into the last, so that no pattern of letters cancels.

    Ranges of over 64 bytes are few and are named by BLAKE2.
    """
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(buffer) + 1,), "<u8", padded, strides=(1,))
    size = end - begin
    state = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + U(family + 1))
    live = np.flatnonzero((size > 0) & (size <= 64))
    done = 0
    while len(live):
        left = size[live] - done
        state[live] = mix(state[live] ^ (lanes[begin[live] + done] & MASKS[np.minimum(left, 8)])) + U(0xD6E8FEB86659FD93)
        done += 8
        live = live[left > 8]
    for k in np.flatnonzero(size > 64).tolist():
        name = hashlib.blake2b(buffer[begin[k] : end[k]].tobytes(), digest_size=8, salt=family.to_bytes(8, "little")).digest()
        state[k] = U(int.from_bytes(name, "little"))
    return state


def encode(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, by byte planes, compressed."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def decode(body: bytes, *kinds: str) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(planes) // sum(widths), 0, []
    for kind, w in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(planes[at : at + n * w].reshape(w, n).T).view(kind).reshape(n))
        at += n * w
    return out


def deltas(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def unbits(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8), count=n).view(bool)


def pack(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = 2_000_000) -> DataFrame:
    """Blocks of whole documents (one at least), hash-partitioned by block and checkpointed.

    A null text is stored as no bytes, a null id as null.
    """
    kind = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("n_bytes", pa.int64()), ("body", pa.binary())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            row = [[(part << 32) + made], [list(ids)], [[len(t) for t in texts]], [held], [body]]
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(row, kind, strict=True)], schema=kind)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                t = t or b""
                if texts and held + len(t) > block_bytes:
                    yield block()
                    made, ids, texts, held = made + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if texts:
            yield block()

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = rows.mapInArrow(tidy(packed), BLOCK)
    return _placed(blocks, docs.sparkSession)


def _placed(blocks: DataFrame, spark: SparkSession) -> DataFrame:
    """Blocks hash-partitioned and checkpointed such that Spark still knows the partitioning.

    An adaptive plan forgets it, and each join of answers would then shuffle the
    texts again; so this one plan is not adaptive.
    """
    parts, before = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(blocks.repartition(parts, "block"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def read_block(row: dict) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and the buffer of all texts with a line feed after each; the texts' starts and ends there."""
    lens = np.array(row["lens"], dtype=np.int64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=max(1, int(lens.sum()))), np.uint8) if lens.sum() else np.zeros(0, np.uint8)
    starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]]).astype(np.int64)
    buffer = np.full(len(raw) + len(lens), 10, np.uint8)
    real = np.ones(len(buffer), bool)
    real[starts + lens] = False
    buffer[real] = raw
    return row["ids"], buffer, starts, starts + lens


def order_ids(ids: list) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids], dtype=np.int64)


def _with_replies(blocks: DataFrame, replies: list[DataFrame]) -> DataFrame:
    if not replies:
        return blocks.withColumn("replies", F.array().cast("array<struct<step:int,shard:int,body:binary>>"))
    every = replies[0]
    for r in replies[1:]:
        every = every.unionByName(r)
    every = every.groupBy("block").agg(F.collect_list(F.struct("step", "shard", F.col("body").alias("body"))).alias("replies"))
    return blocks.join(every, "block", "left")


def _by_row(batches: Iterator[pa.RecordBatch], told: Callable[[dict], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            row["replies"] = {(r["step"], r["shard"]): r["body"] for r in row["replies"] or []}
            if (out := told(row)) is not None:
                yield out


def ask(blocks: DataFrame, replies: list[DataFrame], step: int, asked: Callable[[dict], dict[int, bytes]], answered: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """One round: ``asked`` turns a block (with earlier replies) into messages by shard, ``answered`` merges a shard's messages and replies to each."""

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(row: dict) -> pa.RecordBatch | None:
            sent = asked(row)
            return pa.RecordBatch.from_arrays([pa.array(list(sent), pa.int32()), pa.array([row["block"]] * len(sent), pa.int64()), pa.array(list(sent.values()), pa.binary())], names=["shard", "block", "body"]) if sent else None

        return _by_row(batches, one)

    def answers(table: pa.Table) -> pa.Table:
        back = answered(table["body"].to_pylist())
        give_back()
        return pa.table([table["block"], pa.array([step] * len(back), pa.int32()), table["shard"], pa.array(back, pa.binary())], names=["block", "step", "shard", "body"])

    messages = _with_replies(blocks, replies).mapInArrow(tidy(asks, Rolling.powers), MESSAGE)
    return cut(messages.groupBy("shard").applyInArrow(answers, REPLY))


def finish(blocks: DataFrame, replies: list[DataFrame], told: Callable[[dict], pa.RecordBatch | None], schema: str) -> DataFrame:
    return _with_replies(blocks, replies).mapInArrow(tidy(lambda batches: _by_row(batches, told), Rolling.powers), schema)


# Fingerprints found once or more often ----------------------------------------


def send_keys(k1: np.ndarray, k2: np.ndarray, shard_bits: int) -> dict[int, bytes]:
    """Messages with the distinct pairs ``(k1, k2)``, sorted, and whether the block has each more than once."""
    u1, u2, n = distinct(k1, k2)[:3]
    shard = (u1 >> U(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(u1), np.int64)
    edges = np.searchsorted(shard, np.arange((1 << shard_bits) + 1))
    return {s: encode(deltas(u1[a:b]), u2[a:b], (n[a:b] > 1).view(np.uint8)) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a}


def distinct(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, how often each occurs, and for each input pair its place among them."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    return a[first], b[first], np.diff(np.append(first, len(a))), place


def answer_repeated(bodies: list[bytes]) -> list[bytes]:
    """One bit for each pair of each message: do all blocks together have it twice or more?"""
    read = [decode(b, "<u8", "<u4", "u1") for b in bodies]
    k1 = np.concatenate([np.cumsum(r[0], dtype=U) for r in read])
    k2, many = np.concatenate([r[1] for r in read]), np.concatenate([r[2] for r in read])
    u1, _, n, place = distinct(k1, k2)
    more = (n > 1) | (np.bincount(place, weights=many, minlength=len(u1)) > 0)
    flags, at, out = more[place], 0, []
    for r in read:
        out.append(bits(flags[at : at + len(r[0])]))
        at += len(r[0])
    return out


def repeated_keys(k1: np.ndarray, k2: np.ndarray, replies: dict, step: int, shard_bits: int) -> np.ndarray:
    """The answers for the pairs that :func:`send_keys` sent, one for each input pair."""
    if not len(k1):
        return np.zeros(0, bool)
    u1, _, _, place = distinct(k1, k2)
    shard = (u1 >> U(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(u1), np.int64)
    edges, told = np.searchsorted(shard, np.arange((1 << shard_bits) + 1)), np.zeros(len(u1), bool)
    for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if b > a:
            told[a:b] = unbits(replies[step, s], b - a)
    return told[place]


def shard_bits_for(total: int, each: int, tasks: int = 64, most: int = 8) -> int:
    """So many bits that a shard gets about ``each`` of ``total``; up to ``most`` times as much once there are ``tasks`` shards.

    Every block has a message for every shard, so large inputs get large shards.
    """
    shards = -(-total // each)
    return max(0, (max(1, min(shards, max(tasks, -(-shards // most)))) - 1).bit_length())
