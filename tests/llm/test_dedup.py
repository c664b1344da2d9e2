"""Near, line, suffix and substring dedup against brute force, with hard cases."""

import hashlib
import random
import re
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from mentionmill.llm import line_dedup, minhash_dedup, substring_dedup, suffix_dedup
from mentionmill.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = WORD.findall(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def words(r, n):
    return [r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa").capitalize() + str(r.randrange(400)) for _ in range(n)]


def corpus(seed=3):
    r = random.Random(seed)
    rows, passage = [], words(r, 60)
    for k in range(60):
        w = words(r, r.randint(1, 120))
        if k % 3 == 0:
            at = r.randrange(len(w) + 1)
            w[at:at] = passage[: r.choice([8, 13, 14, 60])]
        rows.append((k, " ".join(w)))
    base = words(r, 150)
    for k in range(60, 90):  # near copies, a few of them beyond the limit
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = "edit" + str(r.randrange(9999))
        rows.append((k, " ".join(w)))
    rows += [(90 + k, rows[5][1]) for k in range(12)]  # exact copies
    rows += [(200, None), (201, ""), (202, "one"), (203, "One"), (204, " \n\t "), (205, "a b c d"), (206, "a  b\nC D"), (207, "é É é É é"), (None, "a b c d"), (208, "x " * 3000)]
    r.shuffle(rows)
    return rows


def brute_near(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def told_near(docs, tile):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs, tile=tile).collect()}


def test_near_duplicates_equal_brute_force(make):
    rows = corpus()
    assert told_near(make(rows), 8) == brute_near(rows) | {None: (1, None, True)}


def beside_passage(r, n, own=12, every=None):
    """Rows of one long passage with words of their own: 0.70 alike, so in each other's buckets and not linked; every ``every``-th is a near copy of an earlier row."""
    passage, rows, tails = words(r, 60), [], []
    for k in range(n):
        copy = every and k % every == every - 1
        tail = list(r.choice(tails)) if copy else [f"own{k}x{j}" for j in range(own)]
        if copy:
            tail[-1] = f"end{k}"
        tails.append(tail)
        rows.append((k, " ".join(passage + tail)))
    return rows


def test_near_duplicates_in_crowded_buckets_equal_brute_force(make):
    """Buckets of many tiles, whose linked rows are mostly linked with another row than the smallest."""
    rows = beside_passage(random.Random(4), 240, every=5)
    want = brute_near(rows)
    assert 150 < len({c for _, c, _ in want.values()}) < 240
    for tile in (4, 16):
        assert told_near(make(rows), tile) == want


def crowd_of(spark, rows):
    squeeze = zstandard.ZstdCompressor()
    return spark.createDataFrame([(k, k, squeeze.compress(t.encode())) for k, t in rows], "node long, component long, body binary")


def test_rows_of_a_crowded_bucket_cost_no_pairs(spark):
    """20,000 rows around one passage: without links no bucket of rare shingles, with them as many pairs as links."""
    pairs = F.coalesce(F.sum(F.col("firsts") * F.col("members")), F.lit(0))
    for every, least, most in ((None, 0, 1), (50, 400, 20_000)):
        scratch = Scratch(spark, "test")
        made = minhash_dedup.rare_buckets(crowd_of(spark, beside_passage(random.Random(5), 20_000, every=every)), scratch, 5, 75)
        assert least <= made.groupBy("key", "firsts", "members").count().agg(pairs).collect()[0][0] < most
        scratch.drop("")


def test_rare_buckets_are_empty_without_partners(spark):
    scratch = Scratch(spark, "test")
    one = crowd_of(spark, [(1, "a b c d e f g"), (2, "h i j k l")])
    assert minhash_dedup.rare_buckets(one, scratch, 5, 75).count() == 0
    assert minhash_dedup.rare_buckets(one.where("node < 0"), Scratch(spark, "test"), 5, 75).count() == 0
    same = one.unionByName(one.withColumn("node", F.col("node") + 10))  # two rows of one component make no bucket
    assert minhash_dedup.rare_buckets(same, Scratch(spark, "test"), 5, 75).count() == 0


def test_near_duplicates_of_hard_tables(make):
    assert minhash_dedup.near_duplicates(make([])).count() == 0
    same = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(make(same)).collect())
    assert got == [(3, 3, True), (7, 3, False), (7, 3, False)]


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


def test_patterned_words_are_told_apart(make):
    swap = str.maketrans("ab", "ba")
    for n in (64, 1024, 4096):
        one = thue_morse(n)
        other = one.translate(swap)
        shared = [f"w{k}" for k in range(12)]
        rows = [(1, " ".join([one, *shared])), (2, " ".join([other, *shared])), (3, one), (4, other), (5, one + " " + one), (6, other + " " + one)]
        got = sorted(tuple(r) for r in substring_dedup.repeated_windows(make(rows)).collect())
        assert got == brute_windows(rows)
        few = [(1, f"{one} a b c d"), (2, f"{other} a b c d"), (3, one), (4, other), (5, f"{one}  a b c D")]
        near = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(make(few)).collect()}
        assert near == {1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4), 5: (1, 1)}


def test_near_duplicates_with_repeated_ids(make):
    """Two texts under one id: both are searched, and link their copies through the id."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, c), (5, c + " end"), (5, c + " end"), (None, c)]
    got = sorted(((r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(make(rows)).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (None, None)]


def brute_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_dedup_equals_brute_force(make):
    rows = corpus(5) + [(300, "abcde" * 200), (301, "y" * 500)]
    for size in (2_000_000, 700):
        got = suffix_dedup.repeated_bytes(make(rows), length=200, block_bytes=size).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_bytes(rows, 200)


def test_suffix_dedup_spans_and_empty_table(make):
    assert suffix_dedup.repeated_bytes(make([])).count() == 0
    t = "".join(chr(97 + k * k % 23) for k in range(300)) + "".join(random.Random(2).choices("klmnop", k=450))
    rows = [(1, "A" + t), (2, "B" + t + "C")]
    got = {r.doc_id: r for r in suffix_dedup.repeated_bytes(make(rows), with_text=True).collect()}
    assert [(s.start, s.end) for s in got[2].spans] == [(1, 751)] and bytes(got[2].kept) == b"BC" and bytes(got[1].kept) == b"A"


def brute_windows(rows, span=13):
    first, out = {}, []
    key = lambda i: 2**63 - 1 if i is None else i
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - span + 1):
            c = tuple(w[k : k + span])
            first[c] = min(first.get(c, key(i)), key(i))
    for i, w in texts:
        gone = bytearray(len(w))
        for k in range(len(w) - span + 1):
            if first[tuple(w[k : k + span])] < key(i):
                gone[k : k + span] = b"\1" * span
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_dedup_equals_brute_force(make):
    rows = corpus(7) + [(5, "again " * 40)]
    for size in (2_000_000, 700):
        got = substring_dedup.repeated_windows(make(rows), block_bytes=size).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_windows(rows)
    assert substring_dedup.repeated_windows(make([])).count() == 0


def test_substring_dedup_text(make):
    p = " ".join(f"w{k}" for k in range(13))
    got = {r.doc_id: r.kept for r in substring_dedup.repeated_windows(make([(1, f"{p} x"), (2, f"é\n{p}  tail")]), with_text=True).collect()}
    assert got == {1: f"{p} x", 2: "é tail"}


def test_line_dedup(make):
    rows = [(k, f"own line {k}\n Common \n\nCommon", f"s{k}") for k in range(12)]
    rows += [(20, "Common", None), (21, None, "s1"), (22, "", "s1"), (None, "Common\nlast", "s3"), (23, "rare\nrare", "s9")]
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(make(rows)).collect()}
    want = {(0, rows[0][1], 3, 0)} | {(k, f"own line {k}\n", 3, 2) for k in range(1, 12)}
    want |= {(20, "", 1, 1), (21, None, 0, 0), (22, "", 0, 0), (None, "last", 2, 1), (23, "rare\nrare", 2, 0)}
    assert got == want
    assert set(make(rows).columns) <= set(line_dedup.dedup_lines(make(rows)).columns)
    assert line_dedup.dedup_lines(make([])).count() == 0
    few = line_dedup.dedup_lines(make([(k, "seldom", f"s{k}") for k in range(9)]))
    assert few.where("n_removed > 0").count() == 0  # nine sites: counted exactly, below the limit
