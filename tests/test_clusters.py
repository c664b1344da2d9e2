"""Clusters and communities against plain runs."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from mentionmill.operators import clusters


def cloud(n=400):
    rng = np.random.default_rng(1)
    heads = rng.normal(size=(5, 4)) * 20
    return [(int(k), (heads[k % 5] + rng.normal(size=4)).tolist()) for k in range(n)]


def test_kmeans_finds_the_clusters_and_follows_its_seed(spark):
    rows = cloud()
    df = spark.createDataFrame([*rows, (999, None)], "vec_id long, embedding array<double>")
    told, centers = clusters.kmeans(df, 5, rounds=8, seed=4)
    got = {r.vec_id: r.cluster for r in told.collect()}
    again, same = clusters.kmeans(df.repartition(7), 5, rounds=8, seed=4)
    assert np.allclose(centers, same) and got == {r.vec_id: r.cluster for r in again.collect()} and 999 not in got
    groups = [{got[k] for k, _ in rows if k % 5 == g} for g in range(5)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 5


def test_rounds_equal_a_plain_run(spark):
    rows = cloud(120)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, start = clusters.kmeans(df, 7, rounds=0, seed=2)
    _, after = clusters.kmeans(df, 7, rounds=3, seed=2)
    x, c = np.array([v for _, v in rows]), start.copy()
    for _ in range(3):
        at = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([x[at == j].mean(0) if (at == j).any() else c[j] for j in range(len(c))])
    assert len(start) == 7 and np.allclose(after, c)
    assert len({tuple(v) for v in start.tolist()} & {tuple(v) for v in x.tolist()}) == 7  # candidates are rows


def test_few_rows(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(9)], "vec_id long, embedding array<double>")
    told, centers = clusters.kmeans(df, 3)
    assert len(centers) == 1 and {r.cluster for r in told.collect()} == {0}
    assert clusters.kmeans(df.limit(0), 3)[0].count() == 0


def plain_communities(edges, rounds):
    label, still = {v: v for e in edges for v in e[:2]}, 0
    for turn in range(1, rounds + 1):
        new = dict(label)
        for v in label:
            if (hashlib.md5(v.encode()).hexdigest()[0] < "8") != (turn % 2 == 1):
                continue
            pull = {}
            for a, b, w in edges:
                for x, y in ((a, b), (b, a)):
                    if x == v:
                        pull[label[y]] = pull.get(label[y], 0) + w
            new[v] = min(pull, key=lambda c: (-round(pull[c], 6), c))
        still = still + 1 if new == label else 0
        label = new
        if still == 2:
            break
    return label


def test_communities_equal_a_plain_run(spark):
    rng = np.random.default_rng(3)
    edges = sorted({(f"{g}{min(a, b)}", f"{g}{max(a, b)}", 1.0) for g in "xyz" for a, b in rng.integers(0, 9, (30, 2)).tolist() if a != b} | {("x1", "y1", 0.3), ("y2", "z2", 0.3)})
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    for rounds in (1, 2, 30):
        got = {r.id: r.community for r in clusters.communities(df, rounds).collect()}
        assert got == plain_communities(edges, rounds)
    assert all(len({got[v] for v in got if v[0] == g}) == 1 for g in "xyz") and len(set(got.values())) >= 2
    q = clusters.modularity(df, spark.createDataFrame([(v, v[0]) for v in got], "id string, community string")).first()
    total = sum(w for *_, w in edges)
    want = 0.0
    for g in "xyz":
        inside = sum(w for a, b, w in edges if a[0] == b[0] == g)
        degree = sum(w for a, b, w in edges for v in (a, b) if v[0] == g)
        want += inside / total - (degree / (2 * total)) ** 2
    assert q.communities == 3 and abs(q.modularity - want) < 1e-9
    assert clusters.communities(df.limit(0)).count() == 0
    assert clusters.communities(df.where(F.col("src") == "x1").limit(1)).count() == 2
