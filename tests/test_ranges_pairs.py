"""Order over whole tables, as-of and interval joins, percentiles, and pairs of heavy papers, against plain computations."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from mentionmill.operators import cooc, graph, pairs, ranges


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(3)
    data = [(k, r.randrange(40), r.choice([None, *range(9)])) for k in range(500)]
    return data, spark.createDataFrame(data, "k long, t long, v long").repartition(5)


def ordered(data):
    return sorted(data, key=lambda x: (x[1], x[0]))


def test_numbers_sums_minima_and_tiles(spark, rows):
    data, df = rows
    want = ordered(data)
    assert {r.k: r.n for r in ranges.numbered(df, "t", "k").collect()} == {x[0]: n + 1 for n, x in enumerate(want)}
    sums, least, total, low = {}, {}, None, None
    for k, _, v in want:
        total, low = (total if v is None else (total or 0) + v), (low if v is None else v if low is None else min(low, v))
        sums[k], least[k] = total, low
    assert {r.k: r.running for r in ranges.running_sum(df, "v", "t", "k").collect() if sums[r.k] is not None} == {k: s for k, s in sums.items() if s is not None}
    assert {r.k: r.least for r in ranges.running_min(df, "v", "t", "k").collect()} == least
    for n in (1, 7, 500, 600):
        told = {r.k: r.tile for r in ranges.tiles(df, n, "t", "k").collect()}
        plain = df.select("k", F.ntile(n).over(Window.orderBy("t", "k")).alias("tile")).collect()
        assert told == {r.k: r.tile for r in plain}


@pytest.mark.parametrize("by", [1, 4, -1, -6, 600])
def test_neighbours_along_an_order(spark, rows, by):
    data, df = rows
    want = ordered(data)
    told = {r.k: r.shifted for r in ranges.shifted(df, "v", by, "t", "k").collect()}
    assert told == {x[0]: want[n - by][2] if 0 <= n - by < len(want) else None for n, x in enumerate(want)}
    plan = ranges.shifted(df, "v", by, "t", "k")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("by", [None, "g"])
def test_as_of(spark, by):
    r = random.Random(4)
    left = [(k, r.choice([None, "a", "b", "c"]), r.choice([None, *range(60)])) for k in range(300)]
    right = [(r.choice(["a", "a", "b", None]), r.choice([None, *range(5, 55)]), r.randrange(1000), r.choice([None, "x"])) for _ in range(80)]
    got = ranges.as_of(spark.createDataFrame(left, "k long, g string, t long").repartition(4), spark.createDataFrame(right, "g string, t long, p long, q string"), "t", ["p", "q"], by=by)
    want = {}
    for k, g, t in left:
        met = [(u, p, q is not None, q) for h, u, p, q in right if u is not None and t is not None and u <= t and (by is None or h == g)]
        best = max(met, key=lambda m: m[:3], default=None)
        want[k] = (best[1], best[3]) if best else (None, None)
    assert {r.k: (r.p_as_of, r.q_as_of) for r in got.collect()} == want
    assert got.columns == ["k", "g", "t", "p_as_of", "q_as_of"]
    empty = spark.createDataFrame([], "g string, t long, p long, q string")
    none = ranges.as_of(spark.createDataFrame(left, "k long, g string, t long"), empty, "t", ["p"], by=by)
    assert none.count() == 300 and none.where("p_as_of IS NOT NULL").isEmpty()


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_intervals(spark, bucket):
    r = random.Random(5)
    points = [(k, r.choice([None, *range(-50, 100)])) for k in range(200)]
    spans = [(k, s, s + r.randrange(-2, 40)) for k, s in ((k, r.randrange(-60, 100)) for k in range(60))]
    got = ranges.in_intervals(spark.createDataFrame(points, "k long, t long"), spark.createDataFrame(spans, "s long, a long, b long"), "t", "a", "b", bucket)
    assert sorted((x.k, x.s) for x in got.collect()) == sorted((k, s) for k, t in points for s, a, b in spans if t is not None and a <= t < b)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.8, 1.0])
def test_percentiles_are_exact_however_narrow(spark, share):
    r = np.random.default_rng(6)
    values = {"even": r.normal(size=700), "far": np.concatenate([r.normal(size=400), [1e12, -1e12]]), "ties": np.full(500, 3.5), "few": np.repeat([1.0, 2.0], 300), "one": [7.0], "steep": 10.0 ** r.uniform(-9, 9, 600)}
    data = [(k, float(x)) for k, xs in values.items() for x in xs] + [("even", None), ("none", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(4)
    got = {x.g: x.percentile for x in ranges.exact_percentile(df, ["g"], "x", share, most=20, bins=8).collect()}
    assert got.keys() == values.keys()
    assert all(abs(got[k] - np.percentile(xs, 100 * share)) <= 1e-9 * max(1, abs(got[k])) for k, xs in values.items())
    whole = ranges.exact_percentile(df.where("g = 'even'"), [], "x", share, most=10, bins=4).collect()
    assert abs(whole[0][0] - np.percentile(values["even"], 100 * share)) < 1e-9
    assert ranges.exact_percentile(df.limit(0), ["g"], "x", share).count() == 0


def test_heavy_papers_make_all_pairs_by_even_tasks(spark):
    n = 20_000
    heavy = spark.range(n).select(F.lit(1).cast("long").alias("paper"), F.format_string("n%05d", "id").alias("name"))
    light = spark.createDataFrame([(p, f"n{k:05d}") for p in range(2, 40) for k in range(p % 5)], "paper long, name string")
    made = pairs.unordered_pairs(heavy.unionByName(light), "paper", "name", light=1024)
    counts = sorted(r["count"] for r in made.groupBy(F.spark_partition_id().alias("task")).count().collect())
    assert sum(counts) == n * (n - 1) // 2 + sum((p % 5) * (p % 5 - 1) // 2 for p in range(2, 40))
    assert counts[-1] <= 2 * counts[len(counts) // 2]


@pytest.mark.parametrize("light", [1, 3, 1000])
def test_spread_pairs_equal_the_join(spark, light):
    r = random.Random(7)
    left = [*{(r.randrange(6), f"a{r.randrange(15)}") for _ in range(60)}, (None, "x")]
    right = [(p, b, 1.5) for p, b in {(r.randrange(8), f"b{r.randrange(9)}") for _ in range(50)}]
    one, two = spark.createDataFrame(left, "paper long, a string"), spark.createDataFrame(right, "paper long, b string, w double")
    got = pairs.spread_pairs(one, two, "paper", "a", "b", light=light)
    assert sorted((x.paper, x.a, x.b, x.w) for x in got.collect()) == sorted((p, a, b, w) for p, a in left for q, b, w in right if p is not None and p == q)
    same = pairs.unordered_pairs(one.where("paper IS NOT NULL"), "paper", "a", light=light)
    assert sorted(map(tuple, same.collect())) == sorted((p, a, b) for p, a in left for q, b in left if p is not None and p == q and a < b)


def test_edges_and_cells_of_heavy_papers(spark, monkeypatch):
    monkeypatch.setattr(pairs, "LIGHT", 2)
    m = [(1, "V", f"v{k}") for k in range(7)] + [(1, "T", f"t{k}") for k in range(3)] + [(2, "V", "v1"), (2, "T", "t1"), (3, "T", "t0")]
    mentions = spark.createDataFrame(m, "paper_id long, category string, entity string")
    studies = spark.createDataFrame([(1, 0.5), (2, 1.0)], "paper_id long, weight double")
    got = {(r.src, r.dst): (r.papers, r.weight) for r in graph.edges(mentions, studies).collect()}
    assert len(got) == 45 and got["t1", "v1"] == (2, 1.5) and got["v0", "v6"] == (1, 0.5)
    cells = {(r.a, r.b): (r.papers, r.raw) for r in cooc.cooccurrence(mentions, studies, "T", "V").collect()}
    assert len(cells) == 21 and cells["t1", "v1"] == (2, 1.25) and cells["t0", "v3"] == (1, 0.25)


@pytest.mark.parametrize("bucket", [3, 50])
def test_counts_in_intervals_make_no_pairs(spark, bucket):
    r = random.Random(5)
    points = [(r.choice([None, 1, 2, 3, 4, 5]), r.choice([None, *range(-20, 80)])) for _ in range(400)]
    spans = [(k, a := r.randrange(-30, 90), a + r.randrange(-2, 40)) for k in range(200)] + [(200, None, 5), (201, 3, 4), (202, 3, 4)]
    p, s = spark.createDataFrame(points, "who long, t long"), spark.createDataFrame(spans, "k long, a long, b long")
    got = ranges.counted_in_intervals(p, s, "t", "a", "b", "who", bucket)
    want = []
    for k, a, b in spans:
        inside = [w for w, t in points if t is not None and a is not None and a <= t < b]
        want += [(k, a, b, len(inside), len({w for w in inside if w is not None}))] if inside else []
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_interval_counts_of_many_rows_of_few_moments(spark):
    """4,000,000 pairs of a point and a span are never made: the plan has no join of points with spans."""
    p = spark.range(2000).selectExpr("id AS who", "id % 7 AS t")
    s = spark.range(2000).selectExpr("id AS k", "0L AS a", "7L AS b")
    got = ranges.counted_in_intervals(p, s, "t", "a", "b", "who", 10)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.select("n", "distinct").distinct().collect() == [(2000, 2000)] and "FlatMapCoGroupsInArrow" in plan


def test_mentions_are_shuffled_once_by_paper(spark):
    """Lists, pairs and cells go on by paper; before, four times the rows were shuffled and then dealt anew by paper."""
    from mentionmill.plans import views
    from mentionmill.operators import extract

    d = "/root/testdata/sf0.001"
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    lists = plan(extract.entity_lists(views.mention(spark, d)))
    assert lists.count("Exchange hashpartitioning") - lists.count("SortMergeJoin") * 2 <= 1
    packed = plan(pairs.packed(views.mention(spark, d).select("paper_id", "entity").distinct(), "paper_id", "entity"))
    assert packed.count("Exchange hashpartitioning") - packed.count("SortMergeJoin") * 2 <= 1


def test_pairs_of_one_heavy_paper_are_whole(spark):
    rows = spark.range(1000).selectExpr("1L AS paper", "printf('n%04d', id) AS name").unionByName(spark.range(5).selectExpr("2L AS paper", "printf('n%04d', id) AS name"))
    blocks = pairs.packed(rows, "paper", "name", light=64)
    assert blocks.agg(F.max(F.size("names"))).first()[0] == 64
    made = pairs.pairs_of(blocks, "paper").where("src < dst").groupBy("paper").agg(F.count_distinct("src", "dst").alias("d"), F.count("*").alias("n"))
    assert sorted(map(tuple, made.collect())) == [(1, 499_500, 499_500), (2, 10, 10)]
