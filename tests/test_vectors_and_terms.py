"""Text vectors against an exact decomposition, the neighbour graph by its recall, the table function against the joins."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mentionmill.operators import automaton, dictionary, embedding, extract, neighbours
from mentionmill.runtime import Scratch


def topics(seed, n):
    r = random.Random(seed)
    words = [[f"w{t}x{k}" for k in range(30)] for t in range(6)]
    return [(k, " ".join(r.choice(words[k % 6] if r.random() < 0.8 else r.choice(words)) for _ in range(r.randint(20, 60)))) for k in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([*topics(1, 240), (900, None), (901, ""), (902, "...")], "k long, text string").repartition(3)


def test_vectors_are_as_near_as_the_exact_decomposition(spark, texts):
    dims, features = 6, 512
    got = {r.k: np.array(r.embedding) for r in embedding.text_vectors(texts, "k", dims=dims, features=features, seed=3).collect()}
    rows = sorted(((r.k, r.w) for r in texts.select("k", embedding.hashed_words(F.col("text"), features).alias("w")).collect()))
    words = pa.array([w for _, w in rows], pa.list_(pa.int32()))
    often = np.bincount(np.concatenate([np.unique(w) for _, w in rows if w]), minlength=features)
    weight = np.where(often > 0, 1 + np.log((1 + len(rows)) / (1 + often)), 1)
    row, feature, value = embedding.sparse_rows(words, weight)
    a = np.zeros((len(rows), features))
    a[row, feature] = value
    _, s, v = np.linalg.svd(a, full_matrices=False)
    exact = a @ v[:dims].T
    best = np.sqrt((s[dims:] ** 2).sum())
    norm = np.sqrt((exact**2).sum(1))[:, None]
    exact = exact / np.where(norm > 0, norm, 1)
    mine = np.stack([got[k] for k, _ in rows])
    assert np.abs(mine @ mine.T - exact @ exact.T).mean() < 0.03  # the same angles
    basis = np.linalg.qr(a.T @ (a @ np.random.default_rng(3).standard_normal((features, dims + 10))))[0]
    assert np.linalg.norm(a - a @ basis @ basis.T) <= 1.02 * best
    same = [k % 6 for k, _ in rows[:240]]
    near = (mine[:240] @ mine[:240].T - 3 * np.eye(240)).argmax(1)
    assert np.mean([same[i] == same[j] for i, j in enumerate(near)]) > 0.95
    assert all(not got[k].any() for k in (900, 901, 902)) and all(abs(np.linalg.norm(got[k]) - 1) < 1e-5 for k in range(240))


def test_vectors_follow_the_seed(spark, texts):
    one, two = (sorted((r.k, r.embedding) for r in embedding.text_vectors(d, "k", dims=4, features=128, seed=5).collect()) for d in (texts, texts.repartition(2)))
    assert np.allclose([v for _, v in one], [v for _, v in two], atol=1e-5)
    assert embedding.text_vectors(texts.limit(0), "k", dims=4, features=64).count() == 0
    assert len(embedding.text_vectors(texts, "k", dims=32, features=16).first().embedding) == 32  # fewer features than components


def exact_graph(rows, k):
    u = np.array([v for _, v in rows])
    u = u / np.linalg.norm(u, axis=1)[:, None]
    c = np.round(u @ u.T, 12)
    return {rows[i][0]: [rows[j][0] for j in sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-c[i, j], rows[j][0]))[:k]] for i in range(len(rows))}


def test_neighbours_are_exact_in_one_cell_and_nearly_all_in_many(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 12))
    rows = [(int(i), (base[i % 40] + 0.4 * rng.normal(size=12)).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = exact_graph(rows, 5)
    one = neighbours.neighbour_graph(df, k=5, trees=1, leaf=2000)
    got = {}
    for r in one.orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append(r.neighbour)
    assert got == want
    many = neighbours.neighbour_graph(df, k=5, trees=10, leaf=150)
    exact = spark.createDataFrame([(q, m) for q, ms in want.items() for m in ms], "query long, vec_id long")
    assert neighbours.recall(many, exact) >= 0.9
    ranks = many.groupBy("vec_id").agg(F.count("*").alias("n"), F.max("rank").alias("r")).collect()
    assert len(ranks) == 1200 and {(r.n, r.r) for r in ranks} == {(5, 5)}


def test_cells_are_bounded_though_a_third_are_copies(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0, 0.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(900)]
    v = spark.createDataFrame(rows, "id long, v array<double>")
    sizes = neighbours.cells(v, 3, 64, 1, Scratch(spark, "test")).groupBy("tree", "cell").count()
    assert sizes.agg(F.max("count")).collect()[0][0] <= 64 and sizes.agg(F.sum("count")).collect()[0][0] == 2700
    few = sorted(map(tuple, neighbours.cells(v, 2, 64, 1, Scratch(spark, "test")).collect()))
    monkeypatch.setattr(neighbours, "FEW", 0)  # cut values are joined, not sent out
    assert sorted(map(tuple, neighbours.cells(v, 2, 64, 1, Scratch(spark, "test")).collect())) == few


def test_neighbours_of_few_null_and_zero_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.neighbour, r.rank) for r in neighbours.neighbour_graph(df, k=2).collect())
    assert got == [(1, 3, 2), (1, 4, 1), (3, 1, 1), (3, 4, 2), (4, 1, 1), (4, 3, 2)]
    assert neighbours.neighbour_graph(df.limit(0)).count() == 0


def dictionary_of(n):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdeABC1_") for _ in range(r.randint(1, 5)))
    odd = ["a-b", "-a", "(a", "a)", "a b", "b c d", "A", "_", "ab.", "...", "", None, "c++", "a  b"]
    return sorted({word() if r.random() < 0.6 else f"{word()} {word()}" for _ in range(n)}) + odd


@pytest.mark.parametrize("ignore_case, whole", [(False, True), (True, True), (False, False)])
def test_table_function_equals_the_joins(spark, ignore_case, whole):
    r = random.Random(10)
    terms = spark.createDataFrame([(t,) for t in dictionary_of(3000)], "term string")
    rows = [(k, "".join(r.choice("abcdeABC1_ -.()+ ") for _ in range(r.randint(0, 120)))) for k in range(80)] + [(100, None), (101, ""), (102, "a b c d"), (102, "a b")]
    texts = spark.createDataFrame(rows, "k long, text string")
    want = dictionary.match_terms(texts, terms, "k", ignore_case) if whole else dictionary.match_substrings(texts, terms, "k")
    got = automaton.find_terms(texts, terms, "k", ignore_case, whole)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_hundred_thousand_terms_without_exploding_words(spark, monkeypatch):
    terms = spark.range(100_000).select(F.concat(F.lit("term"), F.col("id"), F.lit(" of "), F.col("id") % 7).alias("term"))
    texts = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("see term"), F.col("id") * 400, F.lit(" of "), (F.col("id") * 400) % 7, F.lit(" and term5 of 6")).alias("text"))
    got = automaton.find_terms(texts, terms, "k")
    assert sorted(map(tuple, got.collect())) == sorted((k, f"term{k * 400} of {k * 400 % 7}") for k in range(200))
    assert "Generate explode" not in got._jdf.queryExecution().toString()
    monkeypatch.setattr(automaton, "MOST_TERMS", 10)  # longer lists are joined
    assert automaton.find_terms(texts, terms.where("term LIKE '%00 of%' OR term = 'term0 of 0'"), "k").count() == got.count()


def test_recall_of_vectors_of_documents(spark, texts):
    v = embedding.text_vectors(texts.where("k < 900"), "k", dims=16, features=1024).withColumnRenamed("k", "vec_id")
    v = spark.createDataFrame(v.collect(), v.schema)
    graph = neighbours.neighbour_graph(v, k=5, trees=8, leaf=60)
    exact = extract.nearest(v.where("vec_id % 10 = 0"), v, 5)
    assert neighbours.recall(graph, exact) >= 0.9


def test_nearest_over_blocks_with_copies(spark):
    """Blocks smaller than the tables; copies are ranked by id, whatever block they are in."""
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 8)).astype(np.float32)
    rows = [(k, base[k % 40].tolist()) for k in range(400)] + [(400, None)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = extract.nearest(v.where("vec_id % 50 = 0 AND vec_id < 400"), v, 12, block=7)
    u = base.astype(float) / np.sqrt((base.astype(float) ** 2).sum(1))[:, None]
    c = np.round(u @ u.T, 9)
    want = [(q, m, n + 1) for q in range(0, 400, 50) for n, m in enumerate(sorted((m for m in range(400) if m != q), key=lambda m: (-c[q % 40, m % 40], m))[:12])]
    assert sorted((x.query, x.vec_id, x.rank) for x in got.collect()) == sorted(want)
