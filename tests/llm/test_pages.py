"""Pages that the training generator did not make, and the whole query against exhaustion over all labellings."""

import itertools

import numpy as np
from mentionmill.llm import extraction, html_blocks

LONG = "The council met on Monday to discuss the plans for the new bridge, and most of its members were in favour."
MORE = "Work on the bridge is expected to begin in spring, although the costs have risen by a third since last year."
LAST = "Residents had asked for a wider path, which the engineers say they can build without much delay."

PAGES = [
    f"<head><meta charset=utf-8><title>t</title><h1>A new bridge</h1><p>{LONG}<p>{MORE}",  # neither </head> nor <body>
    f"<!DOCTYPE html><title>t</title><article><h1>A new bridge</h1><p>{LONG}</p><object data=x><p>{MORE}</p><p>{LAST}</p></article>",  # unclosed object
    f"<body><main><h1>A new bridge</h1><select><option>one<p>{LONG}</p><p>{MORE}</p></main>",  # unclosed select
    f"<body><main><canvas id=c><p>{LONG}</p><svg viewBox=1><p>{MORE}</p><p>{LAST}</p></main>",
    f"<body><article><p><a title=don't href=/x>{LONG}</a></p><p>{MORE}</p><p>It's {LAST}</p></article>",  # a quote inside an unquoted value
    f"<body><noscript><article><p>{LONG}</p><template><p>{MORE}</p></article>",
    f"<HTML><BODY><NAV><UL><LI><A HREF=/>Home</A><LI><A HREF=/n>News</A></UL></NAV><ARTICLE><P>{LONG}<P>{MORE}</ARTICLE><FOOTER>Copyright 2024</FOOTER>",
    f"<body><div class=content><p>{LONG}</p><p data-x = 'a>b' class=\"text\">{MORE}</p></3><p>{LAST}</p></div><div class=footer>All rights reserved</div>",
]


def test_nothing_is_lost_in_splitting():
    split = html_blocks.Blocks().split
    for page in PAGES:
        text = "\n".join(t for t, _, _ in split(page))
        for line in (LONG, MORE, LAST):
            assert (line in text) == (line in page), page
    texts = lambda page: [t for t, _, _ in split(page)]
    assert texts("<head>loose<p>x</head><p>y") == ["loose", "x", "y"]
    assert texts("<p a='x>y' b=\"'\">z</p><b c=d'e>f</b>") == ["z", "f"]
    assert texts("<select><option>a<option>b</select><p>c<svg><text>d</text></svg>") == ["a", "b", "c", "d"]
    assert texts("a</>b<!-->c-->d</ x>e") == ["abc-->de"]
    assert texts("<p =x>one<p x==y>two<p a= >three<p/a/b=c/>four") == ["one", "two", "three", "four"]
    assert texts("<textarea><p>x</textarea>y<iframe>z</iframe>") == ["y"]
    assert split("<div " + "a=b " * 50_000 + ">x") and texts("<" * 20_000)  # linear in the page


def test_recall_on_hand_written_pages():
    weight, move = extraction.train()
    found = extraction.Extractor(weight.astype("float32"), move)
    wanted = kept = 0
    for page in PAGES:
        lines = found.text(page).split("\n")
        for line in (LONG, MORE, LAST):
            if line in page:
                wanted += 1
                kept += any(line in x for x in lines)
        assert not any("Copyright" in x or "rights reserved" in x or x in ("Home", "News") for x in lines)
    assert kept / wanted >= 0.9


def test_query_equals_exhaustion(spark):
    """The labels of the query's text are the best of all labellings of a page's blocks."""
    weight, move = extraction.train()
    weight, split = weight.astype(np.float32), html_blocks.Blocks()
    pages = [p for p in PAGES if len(split.split(p)) <= 10] + ["", None, "<p>a</p>" * 9, f"<nav><a>x</a></nav><p>{LONG}</p><ul><li>{MORE}<li>b</ul><footer>c</footer>"]
    want = []
    for page in pages:
        blocks = split.split(page or "")
        unary = [weight[f].sum(axis=0) for f in split.features(blocks)]
        score = lambda y: sum(u[k] for u, k in zip(unary, y)) + sum(move[a, b] for a, b in itertools.pairwise(y))  # noqa: E731,B023
        best = max(itertools.product((0, 1), repeat=len(blocks)), key=score)
        want.append("\n".join(t for (t, _, _), k in zip(blocks, best) if k))
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").selectExpr("*", "'u' AS url", "'x' AS text", "1 AS n_chars")
    got = {r.page_id: (r.text, r.n_chars) for r in extraction.extract_text(frame).collect()}
    assert got == {k: (t, len(t)) for k, t in enumerate(want)}
