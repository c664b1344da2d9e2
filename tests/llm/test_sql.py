"""The SQL that queries are held against, itself held against brute force."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pandas as pd

from mentionmill.llm import sharding, suffix_dedup


def test_suffix_and_sharding_sql():
    shared, pair = "é" * 150 + "x" * 250, "ab" * 200
    rows = [(1, shared + "q"), (2, "zz" + shared), (3, None), (4, ""), (5, "m" * 700), (6, pair), (7, "short"), (8, pair + "tail")]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    documents["source"] = ["s", None, "s", "t", None, "s", "t", "t"]
    link = duckdb.connect()
    link.register("documents", documents)
    bodies = {k: (t or "").encode() for k, t in rows}
    starts = Counter(b[i : i + 400] for b in bodies.values() for i in range(len(b) - 399))
    got = {r[0]: r[1:] for r in link.sql(suffix_dedup.SQL).fetchall()}
    assert set(got) == set(bodies)
    for k, b in bodies.items():
        gone = [False] * len(b)
        for i in range(len(b) - 399):
            if starts[b[i : i + 400]] > 1:
                gone[i : i + 400] = [True] * 400
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        assert got[k] == (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    dealt = link.sql(sharding.SQL).fetchall()
    assert len(dealt) == len(rows)
    assert all(r[1] == len(bodies[r[0]]) + 16 and r[2] == zlib.crc32(bodies[r[0]]) for r in dealt)
