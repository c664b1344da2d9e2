"""Literal cases of cleaning, sinks, graphs and evaluation."""

import pytest
from pyspark.sql import functions as F

from mentionmill.functions import text as T
from mentionmill.operators import evaluate, extract, graph, rules
from mentionmill.runtime import ship
from mentionmill.sources import readers, writers


def told(spark, column, *texts):
    ship(spark)
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r.out for r in rows.select("k", column(F.col("t")).alias("out")).orderBy("k").collect()]


def test_repair_and_transliteration(spark):
    broken = "Café – naïve “x” Größe".encode().decode("cp1252", "replace")
    assert told(spark, T.repair, "CafÃ© dâ€™or", "Ã\x89tude", "Café", "plain", "", None, "naïve Ã", "日本", "Ã© 日") == ["Café d’or", "Étude", "Café", "plain", "", None, "naïve Ã", "日本", "Ã© 日"]
    assert "�" in broken and told(spark, T.repair, broken) == [broken]  # what was lost stays so
    assert told(spark, T.transliterate, "Größe", "Łódź – “naïve”", "日本x", None, "æøå") == ["Grosse", 'Lodz - "naive"', "x", None, "aeoa"]
    assert told(spark, T.one_line, "a\r\nb\n\nc ", None) == ["a b c", None]


def test_blocked_abstracts(spark):
    assert told(spark, rules.blocked_abstract, "Our website uses cookies to enhance your experience. More", "(Cell Reports 3)", "The cell", "our website") == [True, True, False, False]


def test_appended_names_with_commas_and_quotes(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x,y", 'q"r')], 'k int, `a,b` string, `c"d` string')
    for _ in range(2):
        writers.append_csv(rows, f"{tmp_path}/log")
    got = readers.read_appended(spark, f"{tmp_path}/log")
    assert got.columns == ["k", "a,b", 'c"d'] and [tuple(r) for r in got.collect()] == [("1", "x,y", 'q"r')] * 2


def test_missing_parts_are_skipped(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "k int, v string").write.parquet(f"{tmp_path}/0")
    spark.createDataFrame([(2,)], "k int").write.parquet(f"{tmp_path}/2")
    got = readers.read_parts(spark, [f"{tmp_path}/{n}" for n in range(4)])
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (2, None)]
    with pytest.raises(FileNotFoundError):
        readers.read_parts(spark, [f"{tmp_path}/9"])


def test_large_components_and_unmatched_names(spark):
    edge = spark.createDataFrame([("a", "b", 1, 1.0), ("b", "c", 1, 1.0), ("x", "y", 1, 1.0)], "src string, dst string, papers int, weight double")
    kept, counts = graph.large_components(edge, 3)
    assert sorted((r.src, r.dst) for r in kept.collect()) == [("a", "b"), ("b", "c")] and tuple(counts.first()) == (3, 2)
    assert tuple(graph.large_components(edge.limit(0), 3)[1].first()) == (0, 0)
    names = spark.createDataFrame([("met",), ("zzz",), ("zzz",), (None,)], "name string")
    aliases = spark.createDataFrame([("met", "MET")], "alias string, canonical string")
    assert sorted(map(str, (r.name for r in graph.unmatched(names, aliases).collect()))) == ["None", "zzz"]


def test_errors_disagreements_and_taggers(spark):
    rows = spark.createDataFrame([(3, ["a"], ["a", "b"]), (1, ["a", "c"], []), (2, [], ["z", "y"])], "k int, h array<string>, m array<string>")
    got = sorted((r.kind, r.key, r.names) for r in evaluate.first_errors(rows, "k", "h", "m", 1).collect())
    assert got == [("fn", 1, ["a", "c"]), ("fp", 2, ["y", "z"])]
    said = spark.createDataFrame([(1, "x", "x", "x"), (2, "x", None, "x"), (3, None, None, None), (4, "x", "x", "y")], "k int, a string, b string, c string")
    assert sorted(r.k for r in evaluate.disagreeing(said, "k", "a", "b", "c").collect()) == [2, 4]
    one, two = (spark.createDataFrame(r, "k int, entity string") for r in ([(1, "a"), (1, "a")], [(1, "a"), (2, "b")]))
    assert sorted(map(tuple, extract.union_labels("k", one, two).collect())) == [(1, "a"), (2, "b")]


def test_nested_genes(spark, tmp_path):
    lines = [
        '{"id": 1, "name": "G", "description": null, "variants": {"nodes": [{"id": 2, "name": "V", "molecularProfiles": {"nodes": [{"id": 3, "name": "P", "assertions": {"nodes": [{"id": 4, "name": "A", "description": "d"}, {"id": 5}]}}, {"id": 6, "name": "Q", "assertions": {"nodes": []}}, {"id": 7}]}}, {"id": 8, "name": "W"}]}}',
        '{"id": 9, "name": "H"}',
    ]
    (tmp_path / "genes.json").write_text("\n".join(lines))
    got = readers.flatten_genes(spark.read.schema(readers.RAW_GENE).json(f"{tmp_path}/genes.json")).collect()
    assert [(r.gene_id, r.variant, r.profile_id, r.assertions) for r in got] == [(1, "V", 3, "4: A (d) | 5: None (None)"), (1, "V", 6, "None"), (1, "V", 7, "None")]


def test_alias_prefixes(spark):
    from mentionmill import fixed_values
    from mentionmill.operators import variants

    rows = [(1, "HER2 amp", "erbb2 "), (2, " her2neuX", "ERBB2"), (3, "HER2 amp", "EGFR"), (4, "v600e", "BRAF"), (5, None, "BRAF"), (6, "cbrafv600e", "BRAF"), (7, "x", None)]
    df = spark.createDataFrame(rows, "k int, v string, g string")
    got = {r.k: r.out for r in df.select("k", variants.without_alias_prefix(F.col("v"), F.col("g"), fixed_values.GENE_ALIASES).alias("out")).collect()}
    want = {}
    for k, v, g in rows:
        want[k] = v
        for alias, canonical in fixed_values.GENE_ALIASES.items():
            if v is not None and g is not None and canonical == g.strip().upper() and v.strip().lower().startswith(alias.lower()):
                want[k] = v.strip().lower()[len(alias):]
                break
    assert got == want and got[1] != "HER2 amp" and got[3] == "HER2 amp"


def test_long_texts_go_to_python_few_at_a_time(spark):
    """Not as Arrow batches of ten thousand whole texts, and plain ASCII not at all."""
    rows = spark.range(3).selectExpr("CASE id WHEN 0 THEN 'plain' WHEN 1 THEN 'Gr\u00c3\u00b6\u00c3\u009fe' END AS t")
    out = rows.select(T.transliterate(T.repair(F.col("t"))).alias("o"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert [r.o for r in out.collect()] == ["plain", "Grosse", None]
