"""Packing, extraction, toxicity and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from mentionmill.llm import components, extraction, html_blocks, html_pages, packing, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    t, held = Tokenizer.from_file(PATH), packing.WordTokens(open(PATH, encoding="utf-8").read(), most=300)
    r = random.Random(1)
    signs = "abcXYZéÀßÿ019 .,;:!?'\"-_&<|>()\n\t\x0b\x1c\x85\xa0×÷²İΣ日本́’“…"
    texts = ["".join(r.choices(signs, k=r.randint(0, 60))) for _ in range(1500)]
    texts += ["don't they'll I'M he's 's 'll", "<|endoftext|> x<|ENDOFTEXT|>y.", "", " ", "a" * 3000, "...!!!,,,", "x" + " ab" * 3000]
    for text, ids in zip(texts, held.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_packing_is_a_round_trip(make):
    from tokenizers import Tokenizer

    r = random.Random(4)
    words = "the quick brown fox jumps over a lazy dog again".split()
    rows = [(k, " ".join(r.choices(words, k=r.choice([3, 40, 300, 900, 2500])))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, "fox " * 2047), (203, "fox " * 2048), (3, "dog"), (3, "dog"), (None, "dog")]
    got = packing.pack_documents(make(rows), PATH, with_ids=True, rows_per_bucket=20).collect()
    by_sequence, by_doc, t = defaultdict(list), defaultdict(list), Tokenizer.from_file(PATH)
    for p in got:
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and p["length"] == len(p["ids"]) <= 2048
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append((p["start"], p["piece"], p["ids"]))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048
    for i, text in rows:
        if i not in (3, None):
            pieces = sorted(by_doc[i])
            assert [x for _, _, ids in pieces for x in ids] == t.encode(text or "", add_special_tokens=False).ids + [0]
            assert all(len(ids) == 2048 for _, _, ids in pieces[:-1]) and [p for _, p, _ in pieces] == list(range(len(pieces)))
    total = sum(p["length"] for p in got)
    assert len(by_sequence) <= 1.05 * -(-total // 2048) + 1
    assert packing.pack_documents(make([]), PATH).count() == 0


def fewest(sizes, capacity):
    """The least number of bins, by exhaustion."""
    sizes = sorted(sizes, reverse=True)

    def fits(k):
        def put(i, room):
            if i == len(sizes):
                return True
            tried = set()
            for b in range(k):
                if room[b] >= sizes[i] and room[b] not in tried:
                    tried.add(room[b])
                    room[b] -= sizes[i]
                    if put(i + 1, room):
                        return True
                    room[b] += sizes[i]
            return False

        return put(0, [capacity] * k)

    return next(k for k in range(len(sizes) + 1) if fits(k))


def test_reduction_keeps_an_optimum():
    r = random.Random(8)
    for _ in range(120):
        sizes = [r.randint(1, 20) for _ in range(r.randint(0, 9))]
        counts = dict(Counter(sizes))
        fixed = packing.reduce_instance(counts, 20)
        left = [w for w, n in counts.items() for _ in range(n)]
        assert sorted(left + [w for items, n in fixed for _ in range(n) for w in items]) == sorted(sizes)
        assert all(sum(items) <= 20 for items, _ in fixed)
        assert sum(n for _, n in fixed) + fewest(left, 20) == fewest(sizes, 20)
        bins = packing.best_fit(dict(Counter(left)), 20)
        assert sorted(w for items, n in bins for _ in range(n) for w in items) == sorted(left) and all(sum(i) <= 20 for i, _ in bins)


def test_components_equal_union_find(spark):
    r = random.Random(6)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2000 + k) for k in range(50)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {c.node: c.component for c in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_of_broken_pages():
    split = html_blocks.Blocks().split
    text = lambda page: [t for t, _, _ in split(page)]
    assert text("<p><b>One.<br><p>two &amp; &eacute;<script>x</p></script>three") == ["One.", "two & é", "three"]
    assert text("<ul><li>a<li>b</ul>c<!-- d --><style>e") == ["a", "b", "c"]
    assert text("") == [] and text("plain  \n text") == ["plain text"] and text("<div") == []
    assert text("<TITLE>t</TITLE><P>x&nbsp;y<a href='>'>z</a>") == ["x yz"]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(3)
    for n in range(1, 7):
        unary, move = r.normal(size=(n, 2)), r.normal(size=(2, 2))
        score = lambda y: sum(unary[i, y[i]] for i in range(n)) + sum(move[y[i], y[i + 1]] for i in range(n - 1))  # noqa: E731,B023
        best = max(np.ndindex(*[2] * n), key=score)
        assert list(best) == extraction.viterbi(unary, move)
        single, pair = extraction._sums(unary, move)
        weights = {y: np.exp(score(y)) for y in np.ndindex(*[2] * n)}
        total = sum(weights.values())
        for i in range(n):
            assert np.isclose(single[i, 1], sum(w for y, w in weights.items() if y[i]) / total)


def test_extraction_on_held_out_pages(spark):
    weight, move = extraction.train()
    found = extraction.Extractor(weight.astype("float32"), move)
    pages = html_pages.labelled_pages(60, seed=77)
    right = total = 0
    for features, labels in extraction.labelled(pages):
        unary = np.array([weight[f].sum(axis=0) for f in features])
        right += sum(a == b for a, b in zip(extraction.viterbi(unary, move), labels))
        total += len(labels)
    assert right / total > 0.99
    plain = pages[0].replace(html_pages.MAIN, "").replace(html_pages.OTHER, "")
    rows = [(1, "u", plain), (1, "u", plain), (2, None, None), (3, "v", ""), (None, "w", "<p>" + "long text goes on. " * 20000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", __import__("pyspark").sql.functions.lit("clash"))
    got = extraction.extract_text(frame).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id == 1} == {found.text(plain)} and [r.text for r in got if r.page_id in (2, 3)] == ["", ""]
    assert extraction.extract_text(frame.limit(0)).count() == 0


def labelled_texts(n, seed):
    r = random.Random(seed)
    clean = ["".join(r.choices("abcdefghijkmnop", k=r.randint(4, 9))) for _ in range(3000)]
    bad = ["idiot", "clown", "fool", "loweit", "loweis", "loween"]
    texts, toxic = [], []
    for _ in range(n):
        w, t = r.choices(clean, k=r.randint(10, 60)), int(r.random() < 0.25)
        for _ in range(r.choice([1, 3, 8]) if t else 0):
            w.insert(r.randrange(len(w)), r.choice(bad))
        texts.append(" ".join(w))
        toxic.append(t)
    return texts, np.array(toxic)


def test_toxicity_on_held_out_texts(spark, make):
    texts, toxic = labelled_texts(800, 1)
    model = toxicity.fit_texts(texts, toxic)
    assert list(model[2]) == sorted(model[2])
    more, truth = labelled_texts(300, 2)
    rows = list(enumerate(more)) + [(None, None), (400, ""), (401, "idiot " * 5000), (5, more[5])]
    out = toxicity.expected_severity(make(rows), model).collect()
    said = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and np.mean([said[k].toxic == bool(t) for k, t in enumerate(truth)]) > 0.97
    assert not said[None].toxic and not said[400].toxic and said[401].toxic
    heavy = [said[k].expected_severity for k, t in enumerate(truth) if t and len(re.findall("idiot|clown|fool|lowe", more[k])) >= 8]
    light = [said[k].expected_severity for k, t in enumerate(truth) if t and len(re.findall("idiot|clown|fool|lowe", more[k])) == 1]
    assert np.mean(heavy) > np.mean(light)
    labels = spark.createDataFrame([(k, int(t)) for k, t in enumerate(toxic)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    fitted = toxicity.fit_on(make(list(enumerate(texts)) + [(0, texts[0])]), labels, max_rows=500)
    assert len(fitted[0])
    assert toxicity.expected_severity(make([]), model).count() == 0


def test_severity_equals_plain_sums(make):
    """Scores from each distinct feature's weight, thresholds and grades, without arrays."""
    import math

    r = random.Random(3)
    features = toxicity.Features()
    vocabulary = ["idiot", "clown", "ab", "Fool", "été", "x1y", "loween"]
    weights = {}
    for w in vocabulary[:5]:
        for f in features.of_word(w.lower()):
            weights[f] = r.uniform(0, 2)
    theta = [0.5, 1.5, 4.0]
    model = (np.array(sorted(weights)), np.array([weights[k] for k in sorted(weights)]), np.array(theta))
    texts = [" ".join(r.choices(vocabulary, k=r.randint(0, 6))) for _ in range(40)] + ["", None, "idiot idiot IDIOT", "idiotic-clown"]
    got = {x.doc_id: x for x in toxicity.expected_severity(make(list(enumerate(texts))), model).collect()}
    for k, text in enumerate(texts):
        seen = {f for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for f in features.of_word(w)}
        over = [1 / (1 + math.exp(t - sum(weights.get(f, 0) for f in seen))) for t in theta]
        each = [a - b for a, b in zip([1, *over], [*over, 0])]
        assert got[k].expected_severity == pytest.approx(sum(g * p for g, p in enumerate(each)))
        assert each[got[k].grade] == pytest.approx(max(each)) and got[k].p_toxic == pytest.approx(over[0]) and got[k].toxic == (over[0] > 0.5)


def test_fit_is_a_maximum():
    """No small step of a weight or threshold raises the likelihood that the fit maximises."""
    r = random.Random(7)
    features = [np.array([f for f in range(5) if r.random() < 0.4], np.uint32) for _ in range(300)]
    y = np.array([min(3, max(0, round(sum(0.9 for _ in f) + r.gauss(-1, 1)))) for f in features])
    ids, w, theta = toxicity.fit(features, y, np.arange(5), steps=6000, rate=0.02)
    weight = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y == 0).sum()))

    def value(w, theta):
        over = [[1.0, *(1 / (1 + np.exp(t - w[f].sum())) for t in theta), 0.0] for f in features]
        return sum(c * np.log(o[k] - o[k + 1]) for c, o, k in zip(weight, over, y)) / len(y) - 1e-4 * (w**2).sum() / 2

    best = value(w, theta)
    for k in range(5):
        for step in (-0.02, 0.02):
            if w[k] + step >= 0:
                assert value(w + step * np.eye(5)[k], theta) < best + 1e-5
    for k in range(3):
        for step in (-0.02, 0.02):
            assert value(w, theta + step * np.eye(3)[k]) < best + 1e-5


def test_pipeline_stages(spark, make, tmp_path):
    r = random.Random(9)
    prose = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    item = prose(40)
    rows = [(k, prose(60), f"s{k % 20}") for k in range(80)]
    rows += [(100 + k, f"{prose(50)}\nshared by all sites, every one of them", f"s{k}") for k in range(20)]
    rows += [(200, rows[3][1], "s1"), (201, rows[3][1] + " and one more", "s2"), (300, "short", "s1"), (301, None, "s1"), (302, f"x {item}", "s2"), (303, "again and again and " * 30, "s3")]
    docs = make(rows).drop("id", "words")
    folder = f"{tmp_path}/sf"
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]
    step, left = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        step = stage(spark, step, folder)
        assert step.columns == docs.columns
        step.write.parquet(f"{tmp_path}/{k}")
        step = spark.read.parquet(f"{tmp_path}/{k}")
        left.append({x.doc_id: x for x in step.collect()})
    everything = {x[0] for x in rows}
    assert set(left[0]) == everything - {300, 301, 303}
    assert sum("shared by all" in x.text for x in left[1].values()) == 1 and all(x.n_chars == len(x.text) for x in left[1].values())
    assert set(left[2]) == set(left[1]) - {200, 201} and set(left[3]) == set(left[2]) - {302}
    out = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in out} == set(left[3])
    # The packed rows of a plain run: the shared line is left in its first document only, all else is as it came.
    from tokenizers import Tokenizer

    t, texts = Tokenizer.from_file(PATH), {i: x for i, x, *_ in rows}
    want = {}
    for i in left[3]:
        text = texts[i] if i < 101 else texts[i].split("\n")[0]
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        want[i] = [(k // 2048, k, len(part := ids[k : k + 2048]), zlib.crc32(np.array(part, "<u4").tobytes())) for k in range(0, len(ids), 2048)]
    got, sequences = defaultdict(list), defaultdict(list)
    for p in out:
        got[p.doc_id].append((p.piece, p.start, p.length, p.ids_crc32))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {i: sorted(x) for i, x in got.items()} == want
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048


