"""Quality, sharding, decontamination."""

import re
import zlib
from collections import Counter

from mentionmill.llm import decontaminate, quality, sharding


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + d for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for d in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_quality_measures(make):
    texts = ["", None, "a b c d e", "a b c d e f", "a b c d e a b c d e", "x x x x x x x", "é # | <b>\n\né # | <b>\n \x0b\x0c\r\n", "one two three four five six seven eight nine ten " * 3, "w " * 4000]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.text_measures(make(list(enumerate(texts)))).collect()}
    assert got == {k: measures(t) for k, t in enumerate(texts)}


def test_quality_verdicts(make):
    own = lambda k: " ".join(f"word{k}x{j}" for j in range(12))
    line = "all rights reserved by the owners of this very long footer line, which says nothing at all to anybody who reads it today"
    rows = [(k, own(k), "h") for k in range(100)]
    rows += [(200 + k, f"{line}\nshort {k}", "h") for k in range(20)]  # boilerplate and nothing else
    rows += [(300 + k, f"{line}\n{own(300 + k)} {own(400 + k)}", "h") for k in range(5)]
    rows += [(500 + k, "the same document on the same host again and again and again", "h") for k in range(30)]  # copies count once
    rows += [(600, f"{line}\n words here", "other"), (601, None, "h"), (None, own(9), None), (602, "too short", "h")]
    got = {r.doc_id: r.kept for r in quality.quality_rules(make(rows)).collect()}
    assert all(got[k] for k in range(100)) and not any(got[200 + k] for k in range(20))
    assert all(got[300 + k] for k in range(5)) and all(got[500 + k] for k in range(30))
    assert got[600] and not got[601] and got[None] and not got[602]
    assert quality.quality_rules(make([])).count() == 0


def test_quality_removes_host_lines(spark, make):
    import corpus_pipeline

    own = lambda k: " ".join(f"word{k}x{j}" for j in range(12))
    footer = "all rights reserved"
    rows = [(k, f"{own(k)}\n {footer}\t\n\n{own(k + 1000)}\n{footer}", "h") for k in range(20)]
    rows += [(50, f"{own(50)}\n{footer}", "other"), (51, f" {own(51)}\n\n", "h"), (52, None, "h"), (None, f"{own(53)}\n{footer}", "h"), (3, f"{own(54)}\nand more", "h")]
    out = quality.quality_rules(make(rows))
    want = [(k, f"{own(k)}\n\n{own(k + 1000)}", True) for k in range(20)]
    want += [(50, rows[20][1], True), (51, rows[21][1], True), (52, None, False), (None, own(53), True), (3, rows[24][1], True)]
    assert sorted(((r.doc_id, r.text, r.kept) for r in out.collect()), key=str) == sorted(want, key=str)
    staged = corpus_pipeline.quality_stage(spark, make(rows), "").collect()
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in staged), key=str) == sorted(((k, t, len(t)) for k, t, kept in want if kept), key=str)


def test_shards(make):
    rows = [(k, f"text {k % 50}", "hot" if k % 3 else f"s{k % 7}") for k in range(1003)] + [(None, None, None), (5, "text 5", "hot"), (5, "text 5", "hot")]
    docs = make(rows)
    got = sharding.interleave_shards(docs, n_shards=40, rows_per_bucket=100).collect()
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(40):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    by_source = Counter((r["shard"], r["source"]) for r in got)
    share = sum(r[2] == "hot" for r in rows) / len(rows)
    assert all(abs(by_source[s, "hot"] - share * counts[s]) <= 4 for s in range(40))
    assert all(r["size"] == len((t := f"text {r['doc_id'] % 50}")) + 16 and r["text_crc32"] == zlib.crc32(t.encode()) for r in got if r["doc_id"] is not None)
    # the order is that of brute force: rank in a source by hash, then by fraction
    ranks = {}
    for name in {r["source"] for r in got}:
        own = sorted(r["fraction"] for r in got if r["source"] == name)
        ranks[name] = [(k + 0.5) / len(own) for k in range(len(own))]
        assert own == ranks[name]
    place = sorted((r["shard"], r["slot"], r["fraction"]) for r in got)
    assert [f for _, _, f in place] == sorted(f for _, _, f in place)
    assert sharding.interleave_shards(make([])).count() == 0


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_decontamination_equals_brute_force(spark, make):
    long = " ".join(f"q{k}" for k in range(40))
    items = [(1, long), (2, "What is, it?"), (3, "cycle a b " * 9), (10, None), (11, "!!"), (12, "one"), (None, "lost item here"), (2, "short Two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    part = " ".join(f"Q{k}" for k in range(5, 20))
    texts = [
        long, f"x y {part} z", " ".join(f"q{k}" for k in range(5, 17)), f"{part}, but {long}", "so WHAT IS it", "a short two of one", "cycle a b " * 30, "", None,
        "é" * 30, " ".join(f"n{k}" for k in range(400)) + " " + part, "lost item here", "a b " * 50,
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, texts[1]), (1, "other"), (None, part)]
    windows = {}
    for i, t in items:
        w = words(t)
        m = min(13, len(w))
        for s in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + m]), set()).add(i)
    want = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if (x := tuple(w[s : s + m])) in windows:
                    hit |= set(range(s, s + m))
                    found |= {str(n) for n in windows[x] if n is not None}
        want.append((i, len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    out = decontaminate.contaminated_words(make(rows), bench).withColumn("bad", decontaminate.is_contaminated())
    got = [(r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids), r.bad) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert decontaminate.contaminated_words(make([]), bench).count() == 0
    assert decontaminate.contaminated_words(make(rows), bench.limit(0)).where("n_hit > 0").count() == 0


