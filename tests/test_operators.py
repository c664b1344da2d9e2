"""One case for each rule or trap of the blueprint."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mentionmill import fixed_values as V
from mentionmill.functions import text as T
from mentionmill.operators import consensus, cooc, dictionary, evaluate, extract, graph, mentions, rules, stats, trends, variants
from mentionmill.sources import readers, writers
from mentionmill.streaming import resume


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'int'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("title", "reason"), [
    ("Fighting cancer with tablets", "prefix"), ("Vitamin D supplementation in melanoma", "supplement"), ("Two words", "title length"), ("A plain good title of work", None),
    ("Newspaper coverage of oncology trials", "not research"), ("[Retracted] a study of mice", "withdrawn"), ("a_b of something else", "underscore"), ("12 34", "no letters"), ("No title available for this one", "placeholder"),
])
def test_title_rules(spark, title, reason):
    assert one(spark, rules.reject_reason(), title=title, abstract="word " * 80, authors="x", pub_date="2020-01-01") == reason


def test_length_and_date_bounds(spark):
    says = lambda n, date="2020-99-99": one(spark, rules.reject_reason(), title="A plain good title of work", abstract="word " * n, authors="x", pub_date=date)
    assert [says(n) for n in (79, 80, 1000, 1001)] == ["abstract length", None, None, "abstract length"]
    assert says(80, "2020-1-1") == "date"


def test_funnel_adds_up(spark):
    rows = [(k, f"Good title number {'one two three'.split()[k % 3]} here", "word " * 90, "a", "2020-01-01", k) for k in range(9)] + [(1, "Good title of another one", "word " * 90, "b", "2020-01-01", 99), (50, "Fig", "x", "a", "2020-01-01", 5)]
    told = {r.reason: r.n for r in rules.funnel(spark.createDataFrame(rows, "paper_id int, title string, abstract string, authors string, pub_date string, ingest_ord int")).collect()}
    assert sum(told.values()) == len(rows) and told == {"repeated id": 1, "repeated title": 6, "kept": 3, "prefix": 1}


def test_terms(spark):
    x = F.col("x")
    assert one(spark, T.normal_cancer_name(x), x="Breast Carcinomas (HER2+) 2") == "breast cancer"
    assert one(spark, T.keyword_category(x), x="cutaneous melanoma") == "melanoma"
    assert one(spark, T.keyword_category(x, "word"), x="cutaneous melanoma") == "cutaneous melanoma"
    assert one(spark, T.keyword_category(x, "word"), x="gallbladder carcinoma") == "gallbladder cancer"
    assert one(spark, T.clean_cancer_term(x), x="+2 advanced breast cancers breast") == "breast cancer"
    assert one(spark, T.clean_cancer_term(x), x="patients") is None
    assert one(spark, T.normal_drug(x), x="Drug-X therapy 12") == "x"
    assert one(spark, T.sentence_case(x), x="ALL CAPS 2") == "All caps 2"
    assert one(spark, T.title_rules(x), x="123") is None and one(spark, T.title_rules(x), x="P53'S ROLE") == "P53's Role"
    assert one(spark, T.listed(x), x="['a', 'b;c']") == ["a", "b", "c"] and one(spark, T.listed(x), x=None) == []
    assert one(spark, T.unescape(x), x="&eacute;&lt;") == "é<" and one(spark, T.nfkc(x), x="ﬁ") == "fi"
    assert one(spark, T.clean_text(x), x="a‚Äìb <i>c</i>  é") == "a-b c "
    assert one(spark, T.placeholders(x), x="see https://x.org or a@b.org, $5") == "see <URL> or <EMAIL>, <CUR>5"


@pytest.mark.parametrize(("pair", "clean"), [
    (("p.Val600Glu", "b-raf"), [("v600e", "BRAF")]), (("p53", "TP53"), []), (("mutation", "EGFR"), []), (("egfr", "EGFR"), []), (("ex20ins", "HER2"), [("exon20ins", "ERBB2")]), (("L858R", "CSF"), []),
])
def test_variant_pairs(spark, pair, clean):
    got = variants.clean_pairs(spark.createDataFrame([(1, *pair, 1)], "k int, variant string, gene string, ord int"), "k").collect()
    assert [(r.variant, r.gene) for r in got] == clean


def test_rejected_variants(spark):
    kept = spark.createDataFrame([(v,) for v in ("q61", "12d", "v3", "v600e", "del19")], "v string").where(~variants.rejected(F.col("v"))).collect()
    assert {r.v for r in kept} == {"v3", "v600e"}


def test_dictionary(spark):
    texts = spark.createDataFrame([(1, "MET amplification"), (2, "METHOD"), (3, "met (x+) y")], "k int, text string")
    terms = spark.createDataFrame([("MET",), ("met (x+)",), ("(",)], "term string")
    assert {(r.k, r.term) for r in dictionary.match_terms(texts, terms, "k").collect()} == {(1, "MET")}
    assert {(r.k, r.term) for r in dictionary.match_substrings(texts, terms, "k").collect()} == {(1, "MET"), (2, "MET"), (3, "met (x+)")}
    aliases = spark.createDataFrame([("met", "MET"), ("amplification", "amp")], "alias string, canonical string")
    assert {(r.k, r.canonical) for r in dictionary.match_aliases(texts, aliases, "k").collect()} == {(1, "MET"), (1, "amp"), (3, "MET")}


def test_windows(spark):
    tokens = F.sequence(F.lit(0), F.col("n") - 1)
    size = lambda n, **k: [len(w) for w in one(spark, extract.windows(tokens, **k), n=n)]
    assert size(600) == [512, 344] and size(600, drop_tail=True) == [512] and size(512) == [512] and size(10) == [10]


def test_responses(spark):
    text = "Variant: V600E, Gene: BRAF\nVariant: c.1A>G, Gene: X"
    plain, hgvs = (one(spark, extract.response_pairs(F.col("x"), h), x=text) for h in (False, True))
    assert [tuple(p) for p in plain] == [("V600E", "BRAF")] and [tuple(p) for p in hgvs] == [("V600E", "BRAF"), ("c.1A>G", "X")]
    got = extract.response_triples(spark.createDataFrame([(1, "- V600E_BRAF + vemurafenib : Sensitive\nnone")], "k int, t string"), "t", "k").first()
    assert (got.variant, got.treatment, got.label) == ("- V600E_BRAF", "vemurafenib", "Sensitive")


def test_piece_merge_and_names(spark):
    tags = spark.createDataFrame([(1, 0, "br", "B-G"), (1, 1, "##af", "I-G"), (1, 2, "x", "O"), (1, 3, "met", "B-G")], "k int, pos int, piece string, tag string")
    assert {r.entity for r in extract.merge_pieces(tags, "k").collect()} == {"braf", "met"}
    found = spark.createDataFrame([(1, "BRAF"), (2, "x-MET"), (3, "KRASS"), (4, "zzz")], "k int, entity string")
    names = spark.createDataFrame([("BRAF",), ("MET",), ("KRAS",)], "name string")
    assert {(r.k, r.name, r.how) for r in extract.normalise_names(found, names, "k").collect()} == {(1, "BRAF", "exact"), (2, "MET", "word"), (3, "KRAS", "near")}


def test_names_equal_brute_force(spark):
    import random
    import re
    from difflib import SequenceMatcher

    draw = random.Random(7)
    word = lambda low, high: "".join(draw.choice("ABcd1") for _ in range(draw.randint(low, high)))
    names = ["BRAF", "KRAS", "EGFR", "CTNNB1", "estrogen receptor alpha gene", "Egfr", None] + [word(4, 12) for _ in range(120)]
    entities = ["kras", "-BRAF", "pEGFR", "cCTNNB1", "the estrogen receptor alpha gene", "BRAF, KRAS", "zzz", "", None, "(x) [BRAF]", "é"] + [word(3, 16) for _ in range(150)]
    for n in names[7:60]:
        at = draw.randrange(len(n))
        entities += [word(1, 1) + n, n[:at] + "x" + n[at:], n[:at] + n[at + 1 :]]
    rows = [(k, e) for k, e in enumerate(entities)] + [(0, "BRAF, KRAS"), (0, "pEGFR"), (0, "pEGFR")]
    full, want = {n.upper() for n in names if n}, set()
    for k, e in rows:
        up = (e or "").upper()
        words = {w for w in re.sub(r"[\[\](),-]", " ", up).split() if w in full}
        if up in full:
            want.add((k, e, up, "exact"))
        elif words:
            want |= {(k, e, w, "word") for w in words}
        elif up:
            score, best = max((round(100 * SequenceMatcher(None, up, n, autojunk=False).ratio()), n) for n in full)
            want |= {(k, e, best, "near")} if score > 85 else set()
    found = spark.createDataFrame(rows, "k int, entity string")
    got = [tuple(r) for r in extract.normalise_names(found, spark.createDataFrame([(n,) for n in names], "name string"), "k").collect()]
    assert set(got) == want and {(0, "kras", "KRAS", "exact"), (0, "BRAF, KRAS", "KRAS", "word"), (0, "pEGFR", "EGFR", "near")} <= want
    assert len([x for x in got if x[3] != "exact"]) == len({x for x in got if x[3] != "exact"})


def test_cooccurrence_weights(spark):
    m = spark.createDataFrame([(1, "T", "t"), (1, "V", "v"), (2, "T", "t"), (3, "T", "u"), (3, "V", "v")], "paper_id int, category string, entity string")
    s = cooc.with_weight(spark.createDataFrame([(1, "Clinical study"), (2, "Undefined"), (3, "?")], "paper_id int, design string"), V.MATRIX_WEIGHTS)
    got = cooc.cooccurrence(m, s, "T", "V").collect()
    assert [(r.a, r.b, r.papers, r.raw, round(r.pct, 6)) for r in got] == [("t", "v", 1, 1.0, 66.666667)]


def test_fisher_and_false_discovery(spark):
    assert stats.fisher_two_sided(5, 995, 995, 1000) == pytest.approx(1.384e-215, rel=1e-3)
    assert stats.fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert stats.fisher_two_sided(0, 5, 5, 0) == pytest.approx(2 / 252)
    p = [0.01, 0.01, 0.04, 0.2, 0.9]
    got = sorted(r.p_adj for r in stats.benjamini_hochberg(spark.createDataFrame([(x,) for x in p], "p double"), 10).collect())
    full, best = sorted(p) + [1.0] * 5, 1.0
    want = []
    for k in range(9, -1, -1):
        best = min(best, full[k] * 10 / (k + 1))
        want.append(min(1.0, best))
    assert got == pytest.approx(sorted(want)[:5])
    cells = spark.createDataFrame([("a", "b", 0.0), ("a", "c", 5.0), ("a", "d", 995.0)], "a string, b string, raw double")
    ps = {r.b: r.p for r in stats.fisher_reference(cells).collect()}
    assert ps["b"] == 1.0 and ps["c"] == pytest.approx(stats.fisher_two_sided(5, 995, 995, 1000))


@pytest.mark.parametrize(("labels", "want"), [
    ("S", ("Sensitive", "hard")), ("SSR", ("Sensitive", "soft")), ("SSSR", ("Sensitive", "soft")), ("SR", ("No consensus", "fallback")), ("SU", ("Sensitive", "fallback")),
    ("UN", ("Unknown", "fallback")), ("UUN", ("Unknown", "fallback")), ("UNN", ("Unrelated", "fallback")), ("N", ("Unrelated", "hard")),
])
def test_consensus(spark, labels, want):
    names = {"S": "Sensitive", "R": "Resistant", "U": "Unknown", "N": "Unrelated"}
    got = consensus.consensus(spark.createDataFrame([("p", names[x]) for x in labels], "pair string, label string")).first()
    assert (got.resolved, got.how) == want


def test_graph(spark):
    m = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (2, "B"), (2, "C")], "paper_id int, entity string")
    s = spark.createDataFrame([(1, 1.0), (2, 0.5)], "paper_id int, weight double")
    assert {(r.src, r.dst, r.papers, r.weight) for r in graph.edges(m, s).collect()} == {("A", "B", 2, 1.5), ("A", "C", 1, 0.5), ("B", "C", 1, 0.5)}
    assert {r.weight for r in graph.edges(m, s, ordered=True).collect()} == {3.0, 1.0}
    for names in (["A"], ["B", "C"], ["A", "B", "C"], ["none"], []):
        want = [tuple(r) for r in graph.edges(m, s).collect() if {r.src, r.dst} & set(names)]
        assert sorted(tuple(r) for r in graph.edges_of(m, s, names).collect()) == sorted(want)


def test_parents_of_deep_chains(spark):
    is_a = spark.createDataFrame([(f"n{k}", f"n{k + 1}", 1) for k in range(30)] + [("n0", "other", 2), ("a", "b", 1), ("b", "a", 1)], "child string, parent string, ord int")
    want = {(f"n{k}", f"n{m}", m - k) for k in range(30) for m in range(k + 1, 31)} | {("a", "b", 1), ("b", "a", 1)}
    assert sorted((r.id, r.parent, r.depth) for r in graph.parents_of(spark, is_a).collect()) == sorted(want)


def test_network_query(spark):
    edge = spark.createDataFrame([("c", "t", 1, 400.0), ("t", "v", 1, 10.0), ("c", "v", 1, 90.0), ("c2", "v", 1, 100.0), ("c", "chemotherapy", 1, 999.0), ("c", "TRK inhibitor", 1, 999.0)], "src string, dst string, papers int, weight double")
    vertex = spark.createDataFrame([("c", "Cancer"), ("c2", "Cancer"), ("v", "Variant"), ("t", "Treatment"), ("chemotherapy", "Treatment"), ("TRK inhibitor", "Treatment")], "id string, category string")
    agreed = spark.createDataFrame([("v + t", "Sensitive")], "pair string, resolved string")
    got = {(r.section, r.name): (r.weight, r.highlight) for r in graph.network_query(edge, vertex, agreed, "c", "v").collect()}
    assert got == {("cancer", "t"): (400.0, True), ("sensitive", "t"): (410.0, True), ("other cancer", "c2"): (100.0, True)}


def test_centred_mean(spark):
    got = trends.centred_mean(spark.createDataFrame([(k, k) for k in range(1, 9)], "k int, v int"), "k", "v").orderBy("k").collect()
    assert [r.smooth for r in got] == [None, None, 2.5, 3.5, 4.5, 5.5, 6.5, None]


def test_evaluation(spark):
    got = evaluate.count_confusion(spark.createDataFrame([(3, 5), (2, 0), (0, 0)], "h int, m int"), "h", "m").first()
    assert (got.tp, got.fp, got.fn, got.tn) == (3, 2, 2, 1)
    none = evaluate.scores(spark.createDataFrame([(0, 0, 0, 4)], "tp int, fp int, fn int, tn int"), empty_f1=1.0).first()
    assert (none.precision, none.f1, none.accuracy) == (0.0, 1.0, 1.0)


def test_sources(spark, tmp_path):
    index = F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0), F.lit(2)))
    assert spark.range(1).select(readers.inverted_text(index).alias("t")).first().t == "a b a"
    path = f"{tmp_path}/x.csv"
    (tmp_path / "x.csv").write_text('paper_id,title\n1,"two\nlines, ""quoted"""\n2,\n')
    assert [(r.paper_id, r.title) for r in readers.read_csv(spark, path, "paper_id bigint, title string").collect()] == [(1, 'two\nlines, "quoted"'), (2, None)]
    writers.write_table(spark.range(10), f"{tmp_path}/t", rows_a_file=3)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10
    assert 'weight 0.5' in writers.gml([("a", "Cancer"), ("b", "Variant")], [("a", "b", 0.5)])
    raw = '{"id":"u/1","title":"t","abstract_inverted_index":{"x":[0]},"authorships":[{"author":{"display_name":"A"}},{"author":{}}],"referenced_works":["u/2"],"concepts":[{"id":"u/3"}],"publication_year":2020,"publication_date":"2020-01-01"}'
    (tmp_path / "w.json").write_text(raw)
    got = readers.flatten_works(spark.read.schema(readers.RAW_WORK).json(f"{tmp_path}/w.json"), "u/").first()
    assert (got.paper_id, got.abstract, got.authors, got.citations, got.concepts) == ("1", "x", "A", "2", "3")


def test_one_hot_refuses_too_many_columns(spark):
    with pytest.raises(ValueError, match="too many"):
        mentions.vocabulary(spark.range(20).select(F.col("id").cast("string").alias("entity")), most=10)


def test_stream_resumes(spark, tmp_path):
    source, target, at = (f"{tmp_path}/{x}" for x in ("in", "out", "checkpoint"))
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string").write.parquet(source)
    run = lambda: resume.process_new(spark, source, "id long, v string", "id", lambda d: d.withColumn("v", F.upper("v")), target, at)
    run()
    spark.createDataFrame([(2, "again"), (3, "c")], "id long, v string").write.mode("append").parquet(source)
    run()
    run()
    assert sorted((r.id, r.v) for r in spark.read.parquet(target).collect()) == [(1, "A"), (2, "B"), (3, "C")]


def test_per_period(spark):
    got = {(r.kind, r.period): r.n for r in trends.per_period(spark.createDataFrame([(dt.date(2024, 1, 3),), (None,)], "d date"), "d").collect()}
    assert got == {("year", "2024"): 1, ("month", "2024-01"): 1, ("week", "2024-01-01/2024-01-07"): 1}


def test_letters_are_not_research(spark):
    """Phrases in full, not taken from the list that the rule uses."""
    from mentionmill.operators import rules

    titles = ["Authors response to the letter", "Author comment: a view", "Commentary on care", "Guest editorial of May", "In reply to: Smith", "From the Editor's desk", "A trial of vemurafenib in melanoma", "Responses of authored cells"]
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    assert [r[0] for r in rows.select(rules.not_research(rows.title)).collect()] == [True] * 6 + [False] * 2


def test_texts_are_not_broadcast_for_a_dictionary(spark):
    from mentionmill.operators import dictionary

    texts = spark.createDataFrame([(1, "MET amplification in lung cancer"), (2, "METHOD met"), (3, None)], "paper_id long, text string")
    few = spark.createDataFrame([("MET",), ("lung cancer",), ("amplification in",), ("!!",)], "term string")
    want = [(1, "MET"), (1, "amplification in"), (1, "lung cancer")]
    assert sorted(map(tuple, dictionary.match_terms(texts, few, "paper_id").collect())) == want
    whole = dictionary.FEW
    try:
        dictionary.FEW = 2  # the way of long lists
        found = dictionary.match_terms(texts, few, "paper_id")
        assert sorted(map(tuple, found.collect())) == want
        assert sorted(map(tuple, dictionary.match_substrings(texts, few, "paper_id").collect())) == sorted([*want, (2, "MET")])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BuildLeft" not in plan.split("== Initial Plan ==")[-1]
    finally:
        dictionary.FEW = whole


def test_paged_sources_and_clients(spark):
    from mentionmill.sources import readers

    asked = []

    def fetch(after):
        asked.append(after)
        at = int(after or 0)
        return {"data": {"x": {"edges": [{"node": {"id": k}} for k in range(at, min(at + 2, 5))], "pageInfo": {"hasNextPage": at + 2 < 5, "endCursor": str(at + 2)}}}}

    assert [r["id"] for r in readers.pages(fetch, readers.connection("x"), first=None, sleep=lambda s: None)] == [0, 1, 2, 3, 4] and asked == [None, "2", "4"]
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    clients = [lambda k: {"a": "one"}[k], lambda k: "two" if k == "b" else None]
    assert sorted(map(str, readers.enrich(rows, "k", clients).collect())) == sorted(map(str, [spark.createDataFrame([(k, v)], "k string, found string").first() for k, v in (("a", "one"), ("a", "one"), ("b", "two"), ("c", None), (None, None))]))


def test_graph_files_and_appended_rows(spark, tmp_path):
    from mentionmill.sources import readers, writers

    vertices, edges = [('a "b" <c>', "Gene"), ("d & e", "Cancer")], [('a "b" <c>', "d & e", 2.5)]
    assert writers.read_gml(writers.gml(vertices, edges)) == (vertices, edges)
    rows = spark.createDataFrame([(1, 'x, "y"\nz')], "id long, text string")
    for _ in range(2):
        writers.append_csv(rows, f"{tmp_path}/log")
    assert [tuple(r) for r in readers.read_appended(spark, f"{tmp_path}/log").collect()] == [("1", 'x, "y"\nz')] * 2
    header = [p for p in (tmp_path / "log" / "_header").iterdir() if p.name.startswith("part-")]
    assert [p.read_text() for p in header] == ["id,text\n"]


def test_inverted_index_of_a_long_text(spark):
    """20,000 words, 3,001 different ones: the old index compared each different word with all words, 60,000,000 times."""
    words = F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda x: F.concat(F.lit("w"), (x * 7919 % 3001).cast("string")))
    row = spark.range(1).select(words.alias("w")).select("w", readers.inverted_index(F.col("w")).alias("m")).select("w", "m", readers.inverted_text(F.col("m")).alias("t")).first()
    assert row.t == " ".join(row.w) and len(row.m) == 3001 and row.m["w0"] == [k for k, w in enumerate(row.w) if w == "w0"]
    empty = spark.range(1).select(F.array().cast("array<string>").alias("w")).select(readers.inverted_index(F.col("w")).alias("m")).first()
    assert empty.m == {}


def test_fisher_of_large_counts_takes_little_memory():
    """Counts of a hundred million: the old test listed all tables, some 10 GB."""
    import tracemalloc

    tracemalloc.start()
    near = stats.fisher_two_sided(37_500_000, 62_500_000, 62_500_000, 104_166_667)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert near == pytest.approx(1.0, abs=1e-3) and peak < 50_000_000
    assert stats.fisher_two_sided(0, 0, 0, 0) == 1.0 and stats.fisher_two_sided(1000, 0, 0, 1000) == pytest.approx(0.0, abs=1e-300)
