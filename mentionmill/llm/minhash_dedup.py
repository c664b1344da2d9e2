"""Near-duplicate documents: MinHash bands, signature check, exact check, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from mentionmill.llm.blocks import mix, word_hashes
from mentionmill.llm.common import Scratch, ship, tidy
from mentionmill.llm.components import connected_components

U = np.uint64
SIGNATURE = 128
#: Rows that meet one copy of their centre's text.
CENTER_ROWS = 256
#: Cells of the sketch that orders shingles by how many rows have them.
CELLS = 1 << 20
#: Bytes of shingle sets that a tile holds at once; others are made again from the texts.
HELD = 64_000_000


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, A-Z lowered; of the whole sequence if it is shorter; none without words."""
    buffer = np.frombuffer(text.lower(), np.uint8)  # bytes.lower() changes A-Z only
    is_word = ~((buffer == 32) | ((buffer >= 9) & (buffer <= 13)))
    edge = np.flatnonzero(np.diff(is_word.view(np.int8), prepend=0, append=0))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, U)
    words = word_hashes(buffer, begin, end, 2)
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, U(size))
    for i in range(size):
        out *= U(0x9FB21C651E98DF25)
        out += words[i : len(words) - size + 1 + i]
    return np.unique(mix(out))


def minima(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The smallest value of the hash set under each of ``n`` universal functions ``a * x + b`` modulo 2**64."""
    a = mix(np.arange(1, n + 1, dtype=U) + U(seed << 20)) | U(1)
    b = mix(a + U(0x51ED270B))
    out = np.full(n, U(2**64 - 1))
    for at in range(0, len(hashes), 1024):
        values = np.multiply.outer(a, hashes[at : at + 1024])
        values += b[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


FEATURES = "id long, n long, k1 long, k2 long, bands array<long>, signature binary, body binary"


def _features(size: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for at in range(0, len(ids), 500):
                out = []
                for i, text in zip(ids[at : at + 500], texts[at : at + 500], strict=True):
                    text = text or b""
                    h = shingle_hashes(text, size)
                    if not len(h):
                        out.append((i, 0, 0, 0, None, None, None))
                        continue
                    m = minima(h, bands * rows, seed)
                    wide = (m >> U(32)).reshape(bands, rows)
                    key = np.arange(1, bands + 1, dtype=U)
                    for j in range(rows):
                        key = mix(key * U(0x9E3779B97F4A7C15) + wide[:, j])
                    k1, k2 = (int(mix(h ^ U(c)).sum().view(np.int64)) for c in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D))
                    out.append((i, len(h), k1, k2, key.view(np.int64), (m[:SIGNATURE] >> U(32)).astype(np.uint8).tobytes(), squeeze.compress(text)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["id", "n", "k1", "k2", "bands", "signature", "body"])

    return run


def _alike(a: pa.Array, b: pa.Array, least: float) -> np.ndarray:
    left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), SIGNATURE) for x in (a, b))
    return (left == right).mean(axis=1) >= least


def _likely(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = pa.array(_alike(batch.column("sa"), batch.column("sb"), least))
                yield batch.select(["a", "b"]).filter(keep)

    return run


def _confirmed(size: int, percent: int):
    """Links of rows with their centre, in one pass over rows sorted by ``center, part``, centres first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        of, sets = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("center", "part", "id", "first", "body")]
            for center, part, node, first, body in zip(*columns, strict=True):
                if of != (center, part):
                    of, sets = (center, part), []
                own = shingle_hashes(open_.decompress(body), size)
                if first:
                    sets.append(own)
                    continue
                for other in sets:
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        out.append((node, center))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return run


def _tile(table: pa.Table):
    """A tile's key, nodes, components, signatures and open keys, and the rows of its two sides."""
    comp, ids = table["component"].to_numpy(), table["node"].to_pylist()
    sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, SIGNATURE)
    side, same = table["side"].to_numpy(), table["i"][0].as_py() == table["j"][0].as_py()
    left = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    return table["key"][0].as_py(), ids, comp, sig, [frozenset(k) for k in table["keys"].to_pylist()], left, right, same


def _partners(x: int, comp: np.ndarray, sig: np.ndarray, right: np.ndarray, same: bool, least: float) -> np.ndarray:
    """Rows of another component whose signatures agree with row ``x``."""
    near = right[(comp[right] != comp[x]) & ((right > x) if same else True)]
    return near[(sig[near] == sig[x]).mean(axis=1) >= least] if len(near) else near


def _tile_rows(least: float):
    """The rows of a tile with a likely partner in it, for which this tile is where the pair is judged."""

    def run(table: pa.Table) -> pa.Table:
        key, _, comp, sig, keys, left, right, same = _tile(table)
        wanted = np.zeros(len(comp), bool)
        for x in left.tolist():
            for y in _partners(x, comp, sig, right, same, least).tolist():
                if not (wanted[x] and wanted[y]) and min(keys[x] & keys[y]) == key:
                    wanted[[x, y]] = True
        return table.filter(pa.array(wanted))

    return run


def _tile_links(least: float, size: int, percent: int):
    """Links between components within one tile: rows of two sides, or of one with itself.

    Pairs whose signatures agree are confirmed here on their full sets, each in
    the smallest open bucket that both rows share, and only if the links found
    in the tile don't connect them already; so a tile returns fewer links than
    it has rows.
    """

    def run(table: pa.Table) -> pa.Table:
        key, ids, comp, sig, keys, left, right, same = _tile(table)
        bodies = table["body"].to_pylist()
        open_, sets, parent, out = zstandard.ZstdDecompressor(), {}, {c: c for c in comp.tolist()}, []

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        held = 0

        def shingles(k: int) -> np.ndarray:
            nonlocal held
            if k not in sets:
                found = shingle_hashes(open_.decompress(bodies[k]), size)
                if held > HELD:
                    sets.clear()
                    held = 0
                sets[k], held = found, held + found.nbytes
            return sets[k]

        for x in left.tolist():
            for y in _partners(x, comp, sig, right, same, least).tolist():
                a, b = root(int(comp[x])), root(int(comp[y]))
                if a == b or min(keys[x] & keys[y]) != key:
                    continue
                one, other = shingles(x), shingles(y)
                both = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(other) - both):
                    parent[max(a, b)] = min(a, b)
                    out.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 75, bands: int = 60, rows: int = 6, seed: int = 11, tile: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents linked by a Jaccard similarity of ``percent`` or more of their ``shingle``-word sets.

    Many universal hash minima a document form ``bands`` of ``rows``; a pair at
    75 % shares no band with probability 8e-6. Documents with one set are one
    class, of which the smallest id stands for all. In each band bucket every
    member is a candidate with the bucket's smallest id, so a bucket costs as
    many pairs as it has members. Candidates are checked by signature
    (``SIGNATURE`` minima of one byte; pairs below 0.53, six standard errors
    under 75 %, are dropped) and then exactly on their full sets: the texts are
    read once, and each goes to its centre, whose own text is there once for
    every ``CENTER_ROWS`` of them, so that a centre of many is spread over tasks.
    Components come from alternating stars. Where a bucket of up to ``tile`` rows
    still holds members of several components besides its smallest id, those
    members are compared with each other by signature; only rows with a likely
    partner get their texts and are compared exactly, in that task, which returns
    only links that join components. Rows of larger buckets are not compared all
    with all: they meet in buckets of their rarest shingles (:func:`rare_buckets`),
    of which any linked pair shares one, so that a passage of very many rows costs
    no more than the rows. Only where more than ``tile`` rows share one and
    aren't of one component yet is that bucket compared in tiles of ``tile`` by
    ``tile``. No pair that shares a bucket is left out and no list of pairs is made.

    Sets are compared by 64-bit names of shingles, from names of words without
    algebraic structure; two different shingles of a pair are taken for one with
    probability 5e-20 each. Returns ``doc_id, n_shingles, component_id, kept``
    and ``class_id`` (the smallest id with the same set). A text without words
    (or null) is linked with nothing; a row without an id is linked with nothing,
    has no component and is kept; rows with one id are one node; an empty table
    gives an empty result; other columns are ignored. Intermediate tables lie in
    the shared folder and are dropped once nothing reads them.
    """
    ship(docs.sparkSession)
    scratch, likely_least = Scratch(docs.sparkSession, "near-dedup"), percent / 100 - 0.22
    told = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    told = scratch.write("features", told.mapInArrow(tidy(_features(shingle, bands, rows, seed)), FEATURES))
    full = told.where((F.col("n") > 0) & F.col("id").isNotNull())
    same_set = ["n", "k1", "k2"]
    heads = full.groupBy(*same_set).agg(F.min("id").alias("node"), F.count("*").alias("members"), F.min_by("bands", "id").alias("bands"), F.min_by("signature", "id").alias("signature"))
    heads = scratch.write("heads", heads)
    signature, bodies = heads.select("node", "signature"), full.select("id", "body")
    copied = heads.where("members > 1").select(*same_set, F.col("node").alias("class_id"))
    member = told.select("id", *same_set).join(copied, same_set, "left")
    own_class = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("class_id", "id")).otherwise(F.col("id"))
    member = scratch.write("member", member.select("id", "n", own_class.alias("class_id")))

    keyed = heads.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("members")).where(F.col("members") > 1)
    buckets = scratch.write("buckets", keyed.join(shared.select("key", "center"), "key").where(F.col("node") != F.col("center")))
    pairs = buckets.select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    pairs = pairs.join(signature.toDF("a", "sa"), "a").join(signature.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    pairs = scratch.write("pairs", pairs.mapInArrow(tidy(_likely(likely_least)), "a long, b long"))
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / CENTER_ROWS).cast("int").alias("parts")).where("parts > 1")
    parts = scratch.write("parts", parts)  # a row for some hundreds of pairs at least: Spark sees its size, and sends it out if it is small
    edges = scratch.write("edges", _with_centers(pairs, parts, bodies).mapInArrow(tidy(_confirmed(shingle, percent)), "a long, b long"))
    found = scratch.write("components", connected_components(edges))
    scratch.drop("pairs", "parts")

    placed = buckets.select("key", "node").join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_ = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")).where(F.col("lo") != F.col("hi")).select("key", "members")
    rest = scratch.write("open", placed.join(open_, "key"))
    small, large = rest.where(F.col("members") <= tile), rest.where(F.col("members") > tile)
    keys = small.groupBy("node").agg(F.collect_list("key").alias("keys"))  # as many as bands at most
    spread = _tiles(small, tile).join(signature.join(keys, "node"), "node")
    crowded = scratch.write("crowded", large.select("node", "component").distinct())  # often nothing, or so few that Spark sends them to the texts
    if not crowded.isEmpty():
        crowd = scratch.write("crowd", crowded.join(bodies.withColumnRenamed("id", "node"), "node"))
        rare = scratch.write("rare", rare_buckets(crowd, scratch, shingle, percent))
        scratch.drop("rarest")
        spread = spread.unionByName(_two_sided(rare, tile).join(signature, "node").withColumn("keys", F.array("key")))
    likely = scratch.write("likely", spread.groupBy("key", "i", "j").applyInArrow(_tile_rows(likely_least), spread.schema))
    more = likely.join(bodies.withColumnRenamed("id", "node").hint("merge"), "node").groupBy("key", "i", "j").applyInArrow(_tile_links(likely_least, shingle, percent), "a long, b long")
    more = scratch.write("more", more.distinct())
    # Rows with one id and different sets are one node: their classes are linked through it.
    doubled = member.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("id").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where(F.col("lo") != F.col("hi"))
    joint = member.join(doubled.select("id"), "id", "left_semi").select(F.col("id").alias("a"), F.col("class_id").alias("b"))
    more = scratch.write("joint", more.unionByName(joint))
    if not more.isEmpty():
        found = scratch.write("all", connected_components(edges.unionByName(more)))
    scratch.drop("features", "heads", "buckets", "edges", "open", "crowded", "crowd", "rare", "likely", "more", "joint")
    out = member.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    component = F.coalesce("component", "class_id")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"), "class_id")


def _tiles(rows: DataFrame, tile: int) -> DataFrame:
    """Rows ``key, node, component, members`` dealt to tiles ``i, j`` of ``tile`` by ``tile`` rows; a bucket that fits one is one."""
    rows = rows.withColumn("tiles", F.ceil(F.col("members") / tile).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select("key", "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))


def _two_sided(rows: DataFrame, tile: int) -> DataFrame:
    """Rows of :func:`rare_buckets` dealt to tiles of ``tile`` rows that are first by ``tile`` others; tiles ``j`` are negative, so none meets itself."""
    a, b = (F.ceil(F.col(c) / tile).cast("int") for c in ("firsts", "members"))
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = rows.where("first").withColumns({"i": own(a), "j": each(b)}).withColumn("side", F.lit(0))
    right = rows.withColumns({"j": own(b), "i": each(a)}).withColumn("side", F.lit(1))
    return left.unionByName(right).select("key", "node", "component", "i", (-1 - F.col("j")).alias("j"), "side")


def rare_buckets(crowd: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """Buckets ``key, node, component, first, firsts, members`` of rows ``node, component, body`` by shingles that are rare.

    Two sets of ``n <= m`` shingles that are ``percent`` alike share at least
    ``2 * percent * n / (100 + percent)`` and at least ``percent * m / 100`` of
    them. So, in any order that is the same for all sets, the first shingle they
    share is among the first ``n - 2 * percent * n / (100 + percent) + 1`` of the
    smaller (there its row is ``first``) and the first ``m - percent * m / 100 + 1``
    of the larger; only rows that are ``first`` need to meet the others of a
    bucket. The order is by rows that have the shingle, rarest first, as a sketch
    of ``CELLS`` counts tells them: a passage that all rows share stands last, and
    no bucket comes of it where each row has enough words of its own. No pair of
    that similarity is left out, however good the sketch. Shingles alone in their
    cell are in one row and make no bucket. Of buckets with the same rows one
    stays, and none stays whose rows are of one component.
    """
    ship(crowd.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, cells = zstandard.ZstdDecompressor(), np.zeros(CELLS, np.int64)
        for batch in batches:
            for body in batch.column("body").to_pylist():
                np.add.at(cells, (shingle_hashes(open_.decompress(body), size) & U(CELLS - 1)).astype(np.int64), 1)
        at = np.flatnonzero(cells)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(cells[at], pa.int64())], names=["cell", "n"])

    told = crowd.select("body").mapInArrow(tidy(counted), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # CELLS rows at most
    cells = np.zeros(CELLS, np.int64)
    cells[told["cell"].to_numpy()] = told["n"].to_numpy()
    shared = crowd.sparkSession.sparkContext.broadcast(cells)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, rows = zstandard.ZstdDecompressor(), shared.value
        names, kept, held = ("node", "component", "key", "first"), [], 0

        def batch_of(found: list) -> pa.RecordBatch:
            sizes = [len(f[2]) for f in found]
            nodes, components = (np.repeat(np.array([f[k] for f in found], np.int64), sizes) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(components), pa.array(np.concatenate([f[2] for f in found]).view(np.int64)), pa.array(np.concatenate([f[3] for f in found]))], names=names)

        for batch in batches:
            for node, component, body in zip(*[batch.column(c).to_pylist() for c in ("node", "component", "body")], strict=True):
                own = shingle_hashes(open_.decompress(body), size)  # distinct, in order
                n = rows[(own & U(CELLS - 1)).astype(np.int64)]
                head = np.argsort(n, kind="stable")[: len(own) + percent * len(own) // -100 + 1]
                is_first = np.arange(len(head)) < len(own) + 2 * percent * len(own) // -(100 + percent) + 1
                shared_too = n[head] > 1
                if shared_too.any():
                    kept.append((node, component, own[head[shared_too]], is_first[shared_too]))
                    held += int(shared_too.sum())
                if held > 100_000:
                    yield batch_of(kept)
                    kept, held = [], 0
        if kept:
            yield batch_of(kept)

    heads = scratch.write("rarest", crowd.select("node", "component", "body").mapInArrow(tidy(first), "node long, component long, key long, first boolean"))
    part = 2**31 - 1  # sums of such parts stay within a long
    name = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(part))
    told = {"rows1": F.sum(name(1)), "rows2": F.sum(name(2)), "rows3": F.sum(F.when(F.col("first"), name(3)))}
    sums = heads.groupBy("key").agg(F.count("*").alias("members"), F.count_if("first").alias("firsts"), F.min("component").alias("lo"), F.max("component").alias("hi"), *[c.alias(n) for n, c in told.items()])
    sums = sums.where((F.col("lo") != F.col("hi")) & (F.col("firsts") > 0)).groupBy("members", "firsts", *told).agg(F.min("key").alias("key")).select("key", "members", "firsts")
    return heads.join(sums, "key").select("key", "node", "component", "first", "firsts", "members")


def _with_centers(pairs: DataFrame, parts: DataFrame, bodies: DataFrame) -> DataFrame:
    """The text of each pair's ``a`` and of its centre ``b``, sorted so that they meet: in ``parts`` of some ``CENTER_ROWS`` rows a centre."""
    n = F.coalesce("parts", F.lit(1))
    members = pairs.join(parts, "b", "left").select(F.col("a").alias("id"), F.col("b").alias("center"), F.pmod(F.xxhash64("a"), n).cast("int").alias("part"), F.lit(False).alias("first"))
    centers = pairs.select("b").distinct().join(parts, "b", "left")
    centers = centers.select(F.col("b").alias("id"), F.col("b").alias("center"), F.explode(F.sequence(F.lit(0), n - 1)).alias("part"), F.lit(True).alias("first"))
    met = members.unionByName(centers).join(bodies.hint("merge"), "id")
    return met.repartition("center", "part").sortWithinPartitions("center", "part", F.desc("first")).select("center", "part", "id", "first", "body")


SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[s:s + least(len(words), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 5, 0) + 2)) AS s FROM doc WHERE len(words) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2) p
  JOIN size sx ON sx.doc_id = p.x JOIN size sy ON sy.doc_id = p.y WHERE 100 * p.both >= 75 * (sx.n + sy.n - p.both)
), sym AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, s.y FROM reach r JOIN sym s ON r.y = s.x
), told AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT t.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, t.component_id, t.doc_id = t.component_id AS kept
FROM told t LEFT JOIN size s ON s.doc_id = t.doc_id
"""
