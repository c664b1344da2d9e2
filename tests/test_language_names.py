"""Language profiles by held-out accuracy, near names against brute force."""

import os
import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mentionmill.operators import language, near_names
from mentionmill.plans import b_rules
from mentionmill.plans.views import article

DATA = os.environ.get("MENTIONMILL_TESTDATA_LARGER", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_languages_of_texts_that_were_not_fitted(spark):
    rows = article(spark, DATA, plain=False)
    told = language.detect(rows, b_rules.profiles(spark, DATA), "paper_id", "title", "abstract").join(rows.select("paper_id", "language"), "paper_id")
    held = told.where(F.pmod("paper_id", F.lit(b_rules.FIT)) == 0)
    n, titles, abstracts = held.agg(F.count("*"), F.avg((F.col("title") == F.col("language")).cast("int")), F.avg((F.col("abstract") == F.col("language")).cast("int"))).collect()[0]
    assert n == 200 and abstracts >= 0.98 and titles >= 0.9


SAMPLES = [("en", "the weather is nice and the people are walking with their dogs"), ("de", "das wetter ist schön und die leute gehen mit ihren hunden"), ("en", None), (None, "nothing said of it")]


@pytest.fixture(scope="module")
def profiles(spark):
    return language.fit_profiles(spark.createDataFrame(SAMPLES, "lang string, text string"))


def test_profiles_are_bounded_and_smoothed(spark, profiles):
    few = language.fit_profiles(spark.createDataFrame(SAMPLES, "lang string, text string"), most=5)
    assert few.count() == 2 * few.select("gram").distinct().count() <= 2 * 2 * 5
    assert {r.lang for r in profiles.collect()} == {"en", "de"} and profiles.where("score >= 0").isEmpty()


def test_short_null_and_wordless_texts_are_unknown(spark, profiles):
    rows = [(1, "the people", "the people and the dogs"), (2, None, "   the   "), (3, "12345678901234", "ist das die lösung"), (4, "", "ΩΩΩΩΩΩΩΩΩΩΩΩ"), (5, "  the dogs are nice  ", "die leute gehen")]
    got = language.detect(spark.createDataFrame(rows, "k long, title string, abstract string"), profiles, "k", "title", "abstract")
    assert sorted(map(tuple, got.collect())) == [(1, "unknown", "en"), (2, "unknown", "unknown"), (3, "unknown", "de"), (4, "unknown", "unknown"), (5, "en", "de")]
    assert language.detect(got.limit(0), profiles, "k", "title").count() == 0


def test_rows_are_kept_by_either_column_and_the_others_put_aside(spark, profiles):
    rows = [(1, "the people are nice", "das wetter ist schön", "x"), (2, "die leute gehen", "das wetter ist schön", "y"), (3, None, None, "z")]
    kept, aside = language.split_by_language(spark.createDataFrame(rows, "paper_id long, title string, abstract string, more string"), profiles)
    assert [(r.paper_id, r.more) for r in kept.collect()] == [(1, "x")] and kept.columns == ["paper_id", "title", "abstract", "more"]
    assert sorted((r.paper_id, r.said_title, r.said_abstract) for r in aside.collect()) == [(2, "de", "de"), (3, "unknown", "unknown")]


@pytest.mark.parametrize("piece, triples", [(language.PIECE, language.MOST_TRIPLES), (5, 0)])
def test_scores_are_those_of_plain_counts(spark, monkeypatch, piece, triples):
    """Letters beyond 16 bits are one letter, texts in pieces and models that are searched give the same sums."""
    monkeypatch.setattr(language, "PIECE", piece)
    monkeypatch.setattr(language, "MOST_TRIPLES", triples)
    r = random.Random(4)
    texts = ["".join(r.choice("abcä \U00010428\U00010429 中") for _ in range(r.choice([0, 1, 2, 3, 7, 40]))) for _ in range(60)] + [None]
    grams = [f"{a}{b}{c}" for a in "abä" for b in "ab \U00010428" for c in "a中\U00010429"]
    scores = [[r.randrange(-9000, 0), r.randrange(-9000, 0)] for _ in grams]
    got = language.Scores(grams, np.array(scores)).of(texts).tolist()
    score = dict(zip(grams, scores, strict=True))
    met = [[score[t[i : i + 3]] for i in range(len(t) - 2) if t[i : i + 3] in score] for t in (x or "" for x in texts)]
    assert got == [[len(m), sum(x[0] for x in m), sum(x[1] for x in m)] for m in met]
    frames = language._counted(iter([pd.DataFrame({"lang": ["x"] * 61, "text": texts})]))
    counts = Counter()
    for f in frames:
        counts.update(dict(zip(f["gram"], f["c"], strict=True)))
    assert counts == Counter(t[i : i + 3] for t in texts if t for i in range(len(t) - 2))


def test_letters_beyond_sixteen_bits_make_whole_trigrams(spark):
    rows = [("en", "abc abd"), ("dsrt", "\U00010428\U00010429\U0001042a \U00010428\U00010429\U0001042b")]
    fitted = language.fit_profiles(spark.createDataFrame(rows, "lang string, text string"))
    want = {t[i : i + 3] for _, x in rows for t in (f" {x} ",) for i in range(len(t) - 2)}
    assert {r.gram for r in fitted.collect()} == want


def names_of(seed, n):
    r = random.Random(seed)
    word = lambda letters, k: "".join(r.choice(letters) for _ in range(k))
    names = {word("ABCDEFGHIJKLMNOPQRSTUVWXYZ", r.randint(3, 12)) + (str(r.randint(1, 30)) if r.random() < 0.4 else "") for _ in range(n)}
    return sorted(names | {word("AB", r.randint(1, 9)) for _ in range(60)} | {"ÄÖÜß😀X", "ÄÖÜß😀", "AAAAAAAA", "AAAAAAAAA"})


def asked_of(names, seed, n):
    r, out = random.Random(seed), set()
    for _ in range(n):
        x = list(r.choice(names))
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(x) + 1)
            if r.random() < 0.5 or not x:
                x.insert(k, r.choice("ABCD"))
            else:
                x.pop(min(k, len(x) - 1))
        out.add("".join(x))
    return sorted(x for x in out if x)


def brute(asked, names, least):
    out = set()
    for x in asked:
        for y in names:
            pair = SequenceMatcher(None, x, y, autojunk=False)
            if round(100 * pair.real_quick_ratio()) >= least and round(100 * pair.quick_ratio()) >= least and round(100 * pair.ratio()) >= least:
                out.add((x, y, round(100 * pair.ratio())))
    return out


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_like_names_equal_brute_force_on_ten_thousand(spark):
    names = names_of(1, 10_000)
    asked = [*asked_of(names, 2, 120), "ÄÖÜß😀"]
    got = near_names.like_pairs(frame(spark, [*asked, None, "", asked[0]]), frame(spark, [*names, None, ""]))
    assert {tuple(r) for r in got.collect()} == brute(asked, names, 86) and got.count() == len({tuple(r) for r in got.collect()})


@pytest.mark.parametrize("least", [70, 95, 100])
def test_other_similarities(spark, least):
    names = names_of(3, 300)
    asked = asked_of(names, 4, 60)
    got = near_names.like_pairs(frame(spark, asked), frame(spark, names), least)
    assert {tuple(r) for r in got.collect()} == brute(asked, names, least)


def test_no_bigram_is_the_key_of_many_pairs(spark):
    names = names_of(5, 4_000)
    often = frame(spark, names).select(F.explode(near_names.bigrams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    filed = near_names._indexed(frame(spark, names), often, 86).select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    largest, pairs = filed.agg(F.max(F.col("n") * F.col("n")), F.sum(F.col("n") * F.col("n"))).collect()[0]
    assert largest <= 0.01 * pairs and pairs <= 0.05 * len(names) ** 2
