"""Clustering, codes and near-duplicates of embedding vectors against plain computations."""

import hashlib
import math

import numpy as np
import pytest

from mentionmill.llm import centroid_clustering, embedding_dedup, vector_codes, yinyang

SCHEMA = "vec_id long, embedding array<float>, label int, `a.b` string, own int, v string, m map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, "y", {"z": 1}) for i, v, k in rows], SCHEMA)


def nearest(x, centers):
    d = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


def lloyd(x, centers, rounds):
    centers = centers.copy()
    for _ in range(rounds):
        at = nearest(x, centers)[0]
        for c in set(at):
            mine = x[at == c]
            centers[c] = mine.sum(0) // len(mine)
    return (*nearest(x, centers), centers)


def integers(vectors):
    return np.floor(np.array(vectors, dtype=np.float32).astype(np.float64) * 256).astype(np.int64)


def cloud(seed, n, dims, step=0.25):
    """Vectors on a coarse lattice, so that ties and repeated rows are many."""
    rng = np.random.default_rng(seed)
    return (np.round(rng.normal(size=(n, dims)) / step) * step).tolist()


@pytest.mark.parametrize("k, groups", [(6, 2), (12, 5), (3, 1)])
def test_bounds_lose_nothing(k, groups):
    rng = np.random.default_rng(k)
    x = rng.integers(-3, 4, size=(400, 3))
    centers = x[:k].copy()
    members = yinyang.grouped(centers, groups)
    code, upper, lower = np.zeros(400, np.int64), np.full(400, np.inf, np.float32), np.zeros((400, len(members)), np.float32)
    drift, computed = np.zeros(k), []
    for _ in range(8):
        computed.append(yinyang.assign(x, code, upper, lower, centers, members, drift))
        want, d2 = nearest(x, centers)
        assert (code == want).all()
        exact = np.sqrt(((x[:, None, :] - centers[None]) ** 2).sum(2))
        assert (upper + 1e-3 >= np.sqrt(d2)).all()
        for g, m in enumerate(members):
            other = np.where(np.isin(m, code)[None, :] & (m[None, :] == code[:, None]), np.inf, exact[:, m]).min(1)
            assert (lower[:, g] <= other + 1e-3).all()
        new = np.array([x[code == c].sum(0) // (code == c).sum() if (code == c).any() else centers[c] for c in range(k)])
        drift, centers = np.sqrt(((new - centers) ** 2).sum(1)), new
    assert computed[-1] < computed[0]  # bounds spare distances once centers settle


def test_large_integers_are_exact():
    x = np.array([[1 << 26, -(1 << 26)], [(1 << 26) - 1, 0]])
    assert yinyang.squares(x, x[:1])[1, 0] == 1 + (1 << 52) and yinyang.squares(x, x)[0, 0] == 0


def test_clusters_equal_plain_rounds(spark):
    vectors = cloud(1, 300, 8)
    bad = [None, [], [1.0] * 7, [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] * 8]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(7, vectors[7], 0), (None, vectors[8], 0)] + [(1000 + i, v, 0) for i, v in enumerate(bad)]
    got = centroid_clustering.cluster_vectors(frame(spark, rows), k=9, rounds=4, groups=3, dims=8).collect()
    kept = [(i, v) for i, v, _ in rows if i is None or i < 1000]
    x = integers([v for _, v in kept])
    first = sorted(range(len(kept)), key=lambda n: (hashlib.sha256(f"2:{'' if kept[n][0] is None else kept[n][0]}".encode()).hexdigest(), x[n].tolist()))[:9]
    at, d, centers = lloyd(x, x[first], 4)
    want = [(i, int(c), int(e), int(d[at == c].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()) for (i, _), c, e in zip(kept, at, d, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_codes_equal_plain_rounds(spark):
    vectors = cloud(2, 200, 8)
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(vectors)] + [(3, vectors[3], 1), (900, None, 1), (901, [None] * 8, 1), (902, [float("inf")] * 8, 1), (903, [1.0] * 4, 2)]
    got = {(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.code_vectors(frame(spark, rows), parts=4, entries=10, rounds=2, groups=3, dims=8).collect()}
    kept = [(i, v, k) for i, v, k in rows if i < 900]
    x = integers([v for _, v, _ in kept])
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0], x[n].tolist()))[:10]
    parts = [lloyd(x[:, 2 * p : 2 * p + 2], x[order][:, 2 * p : 2 * p + 2], 2) for p in range(4)]
    error = sum(p[1] for p in parts)
    sha = hashlib.sha256(",".join(str(v) for p in parts for v in p[2].ravel()).encode()).hexdigest()
    label = {k: int(sum(e for (_, _, o), e in zip(kept, error, strict=True) if o == k)) for k in (None, 1, 2)}
    want = {(i, "".join(f"{p[0][n]:02x}" for p in parts), int(error[n]), label[k], sha) for n, (i, _, k) in enumerate(kept)} | {(903, None, None, label[2], sha)}
    assert got == want
    books = np.stack([p[2] for p in parts])
    again = vector_codes.decode(np.stack([p[0] for p in parts], axis=1), books)
    assert ((again - x) ** 2).sum(1).tolist() == error.tolist()


def test_many_labels_are_dealt_out(spark, monkeypatch):
    rows = [(i, v, i) for i, v in enumerate(cloud(3, 40, 4))] + [(99, [0.0] * 4, None)]
    few = vector_codes.code_vectors(frame(spark, rows), parts=2, entries=4, rounds=1, dims=4).collect()
    monkeypatch.setattr(vector_codes, "bounded", lambda df: None)
    many = vector_codes.code_vectors(frame(spark, rows), parts=2, entries=4, rounds=1, dims=4).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, many)) and len(few) == 41


def plain_links(rows, cosine):
    good = [n for n, (_, v, _) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in good:
        for b in good:
            x, y = rows[a][1], rows[b][1]
            if a != b and len(x) == len(y) and math.fsum(p * q for p, q in zip(x, y, strict=True)) / math.sqrt(math.fsum(p * p for p in x) * math.fsum(q * q for q in y)) >= cosine:
                links[a] += 1
                up[max(root(a), root(b))] = min(root(a), root(b))
    low = {}
    for n, (i, _, _) in enumerate(rows):
        known = [c for c in (low.get(root(n)), i) if c is not None]
        low[root(n)] = min(known) if known else None
    return sorted(((i, links[n], low[root(n)], i == low[root(n)]) for n, (i, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("run_rows, runs", [(8, 2), (512, 16)])
def test_near_vectors_equal_brute_force(spark, run_rows, runs):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(25, 6)) * [4, 3, 2, 1, 1, 1]
    vectors = [(np.round((base[rng.integers(25)] + rng.normal(size=6) * rng.choice([0.0, 0.2, 0.6])) * 8) / 8).tolist() for _ in range(220)]
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [1.0, 0.0, 0.0, 0.0], [9.0, 3.0, 3.0, 1.0], [9.0, 3.0, 3.0, 1.125], [-0.0, 1.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]]
    ids = [int(i) for i in rng.permutation(300)]
    rows = [(ids[n], v, None) for n, v in enumerate(vectors + odd + [[1.0] * 6] * 30)]
    rows += [(None, vectors[0], None), (ids[1], vectors[2], None), (ids[3], vectors[3], None), (None, [1.0, 2.0], None)]
    got = embedding_dedup.near_vectors(frame(spark, rows), 0.9, leading=3, run_rows=run_rows, runs=runs).collect()
    assert sorted(map(tuple, got), key=str) == plain_links(rows, 0.9)


def test_far_blocks_are_skipped(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(n, [math.cos(a), math.sin(a), 0.01], 0) for n, a in enumerate(rng.uniform(0, 2 * math.pi, 600))]
    compared = []
    inner = embedding_dedup._near_blocks

    def watched(blocks, n_blocks, *a):
        pairs = inner(blocks, n_blocks, *a)
        compared.append((n_blocks, pairs.count()))
        return pairs

    embedding_dedup._near_blocks = watched
    try:
        got = embedding_dedup.near_vectors(frame(spark, rows), 0.999, leading=2, run_rows=4, runs=2).collect()
    finally:
        embedding_dedup._near_blocks = inner
    assert sorted(map(tuple, got), key=str) == plain_links([(i, [float(np.float32(c)) for c in v], k) for i, v, k in rows], 0.999)
    blocks, pairs = compared[0]
    assert pairs < 0.35 * blocks * (blocks + 1) / 2  # most pairs of blocks are never formed


def test_links_form_whole_classes():
    rng = np.random.default_rng(7)
    for _ in range(50):
        a, b = rng.integers(0, 30, 25), rng.integers(0, 30, 25)
        up = {int(x): int(x) for x in np.concatenate([a, b])}

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            up[max(root(x), root(y))] = min(root(x), root(y))
        node, low = embedding_dedup.stars(a, b)
        assert dict(zip(node.tolist(), low.tolist(), strict=True)) == {x: root(x) for x in up if root(x) != x}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert centroid_clustering.cluster_vectors(none).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroid_clustering.cluster_vectors(none).count() == vector_codes.code_vectors(none).count() == embedding_dedup.near_vectors(none).count() == 0
    only = frame(spark, [(1, None, None), (2, [0.0] * 64, 3)])
    assert [tuple(r) for r in embedding_dedup.near_vectors(only).collect()] == [(1, 0, 1, True), (2, 0, 2, True)]
    assert [r.vec_id for r in vector_codes.code_vectors(only).collect()] == [2]
