"""Columns whose names are used inside an operator, and rows repeated in full, change nothing."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mentionmill.llm import decontaminate, line_dedup, minhash_dedup, quality, sharding, substring_dedup, suffix_dedup

NAMES = {
    "op1": ["id", "n", "k1", "k2", "bands", "signature", "body", "node", "key", "a", "b", "rep", "class_id", "component", "members"],
    "op2": ["__own", "__text", "__id", "__hit", "__n", "__kept", "hit_lines", "kept_lines", "new_text", "hit_id", "h1", "h2", "ord", "site", "line", "first", "salt", "id"],
    "op5": ["__own", "__text", "__id", "__th", "__host", "__hit", "__lost", "__words", "__lines", "__n", "_words", "_id", "th", "host", "line", "h1", "h2", "chars", "salt", "one", "of"],
    "op9": ["__own", "__text", "__id", "__th", "__hth", "__rth", "__hit", "__items", "__n", "_id", "_hit", "_items", "words", "item", "grams", "least", "hits", "part", "mark", "m", "at"],
}


def rows():
    r = random.Random(12)
    prose = lambda n: " ".join(f"w{r.randrange(900)}" for _ in range(n))
    out = [(k, f"{prose(40)}\nshared line of all\n{prose(20)}", f"s{k % 14}") for k in range(40)]
    out += [(k, out[0][1], "s1") for k in (50, 51)] + [out[3], out[3]]  # copies, and rows repeated in full
    return out + [(60, None, None), (61, "", "s2"), (None, out[1][1], "s3"), (62, "x", "s4")]


RUNS = {
    "op1": lambda d: minhash_dedup.near_duplicates(d).select("doc_id", "n_shingles", "component_id", "kept"),
    "op2": lambda d: line_dedup.dedup_lines(d, min_sites=10),
    "op5": lambda d: quality.quality_rules(d, min_docs=1),
    "op9": lambda d: decontaminate.contaminated_words(d, d.sparkSession.createDataFrame([(1, rows()[2][1]), (2, "shared line of all")], "item_id long, text string")),
}


@pytest.mark.parametrize("op", NAMES)
def test_inner_names_as_columns(make, op):
    plain = make(rows()).drop("id", "words")
    clash = plain.select(*[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in NAMES[op]], "*")
    want = RUNS[op](plain)
    got = RUNS[op](clash)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    if op != "op1":
        assert got.columns[: len(clash.columns)] == clash.columns
        for c in NAMES[op]:
            assert all(x[c] == (None if x["doc_id"] is None else f"{c}-{x['doc_id']}") for x in got.collect())


def test_result_names_as_columns_are_replaced(make):
    plain = make(rows())
    for op, names in (("op2", ["n_lines", "n_removed"]), ("op5", [*quality.MEASURES, *quality.VERDICT]), ("op9", list(decontaminate.RESULT))):
        got = RUNS[op](plain.select("*", *[F.lit("old").alias(n) for n in names])).select(*RUNS[op](plain).columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, RUNS[op](plain).collect()))


def test_other_operators_ignore_other_columns(make):
    plain = make(rows()).drop("id", "words")
    more = plain.select("*", *[F.lit(7).alias(c) for c in ("id", "block", "ids", "lens", "body", "h", "u", "bucket", "stratum", "inside", "before", "rank", "cell", "size", "shard")])
    for run in (lambda d: sharding.interleave_shards(d), lambda d: suffix_dedup.repeated_bytes(d, length=150), lambda d: substring_dedup.repeated_windows(d)):
        assert sorted(map(repr, run(more).collect())) == sorted(map(repr, run(plain).collect()))


def test_pipeline_with_clashing_columns_null_ids_and_no_rows(spark, make, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["_row", "__row0", "__own", "__text", "node", "salt", "th"]
    docs = make(rows()).drop("id", "words").select("*", *[F.lit("x").alias(c) for c in names])
    for frame, empty in ((docs, False), (docs.limit(0), True)):
        step = frame
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, step, str(tmp_path))
            if k < 4:
                assert out.columns == docs.columns
            out.write.mode("overwrite").parquet(f"{tmp_path}/{empty}-{k}")
            step = spark.read.parquet(f"{tmp_path}/{empty}-{k}")
        ids = {r.doc_id for r in step.collect()}
        assert ids == (set() if empty else {*range(40), None})


def odd(docs):
    """With a dotted name, a name with a backtick, a map and a struct."""
    extra = [F.lit("x").alias("a.b"), F.lit("y").alias("c`d"), F.create_map(F.lit("k"), F.col("doc_id")).alias("m"), F.struct(F.lit(1).alias("text")).alias("row")]
    return docs.select("*", *extra)


def test_stages_keep_odd_columns_and_unrelated_texts_of_one_id(spark, make, tmp_path):
    spark.createDataFrame([(1, rows()[7][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    other = " ".join(f"z{k}" for k in range(60))
    docs = odd(make([*rows(), (5, other, "s9"), (5, other, "s9"), (70, other + " end", "s8")])).drop("id", "words")
    step = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, step, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        step = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 2:
            near = [r.doc_id for r in step.collect()]
    got = step.collect()
    assert sorted(near, key=str) == sorted([*range(40), None, 70], key=str)  # the other text of 5 is near 70, whose number is smaller
    assert sorted((r.doc_id for r in got), key=str) == sorted([*(k for k in range(40) if k != 7), None, 70], key=str)
    assert all(r["a.b"] == "x" and r["c`d"] == "y" and r["m"] == {"k": r.doc_id} and r["row"].text == 1 for r in got if r.doc_id is not None)


def test_unrelated_texts_of_one_id_are_both_kept(spark, make, tmp_path):
    docs = odd(make([(1, " ".join(f"a{k}" for k in range(30))), (1, " ".join(f"b{k}" for k in range(30))), (1, " ".join(f"b{k}" for k in range(30)))])).drop("id", "words")
    got = corpus_pipeline.near_stage(spark, docs, str(tmp_path)).collect()
    assert sorted(r.text[0] for r in got) == ["a", "b"] and {r.doc_id for r in got} == {1}


def test_pipeline_leaves_its_result_only(spark, make, tmp_path):
    import gc
    import time
    from pathlib import Path

    from mentionmill.runtime import shared_folder

    docs = make(rows()).drop("id", "words")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows()[7][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert 7 not in {r.doc_id for r in out.select("doc_id").collect()}
    left = [p for p in folder.iterdir() if p not in before and not p.name.startswith("rdd-")]
    assert len(left) == 1 and [p.name for p in left[0].iterdir()] == ["stage-4"]
    for _ in range(60):  # checkpoints go with their plans, when Spark's cleaner comes by
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if not [p for p in folder.iterdir() if p not in before and p.name.startswith("rdd-") and any(p.iterdir())]:
            break
        time.sleep(0.5)
    else:
        raise AssertionError("checkpoints are left")
