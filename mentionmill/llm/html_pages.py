"""Labelled training pages: made-up sites whose article text is known.

The pages of a corpus carry no labels, so the field is trained on pages made
here: random layouts with articles and all that surrounds them. Each word of an
article starts with one mark and each other word with another; a block's label
is read from its marks, which are removed before training.
"""

from __future__ import annotations

import random

MAIN, OTHER = "\ue000", "\ue001"
SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo za zo th er in on an st nd".split()
ARTICLE = [("article", ""), ("main", ""), ("div", "content"), ("div", "article body"), ("div", "post content"), ("section", "story"), ("div", "entry content"), ("article", "post"), ("div", "main text"), ("div", "")]
MENU = [("nav", ""), ("ul", "menu"), ("div", "navigation"), ("div", "nav bar"), ("header", ""), ("div", "breadcrumb")]
NOTICE = [("div", "cookie notice"), ("div", "banner"), ("div", "popup modal"), ("div", "alert notice"), ("p", "notice")]
ADVERT = [("div", "ad"), ("div", "ads"), ("div", "advert"), ("aside", "promo"), ("div", "sponsored"), ("ins", "adsbygoogle"), ("div", "ad slot")]
SIDE = [("aside", ""), ("div", "sidebar"), ("div", "related"), ("section", "recommended"), ("div", "widget"), ("div", "share social"), ("div", "newsletter")]
COMMENTS = [("div", "comments"), ("section", "comments"), ("ol", "comment list"), ("div", "discussion replies"), ("div", "disqus thread")]
FOOTER = [("footer", ""), ("div", "footer"), ("div", "site footer copyright")]
PHRASES = {
    "notice": ["We use cookies", "Accept all cookies", "Privacy settings"], "side": ["Read more", "Related", "Share this", "Follow us", "Subscribe to our newsletter"],
    "foot": ["Copyright", "©", "All rights reserved", "Terms", "Privacy", "Contact"], "form": ["Sign up", "Search", "Log in", "Your name"], "comments": ["Reply", "Comments", "posted 3 days ago", "Like"],
}


class Page:
    def __init__(self, r: random.Random):
        self.r = r

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def sentence(self, mark: str, low: int = 3, high: int = 18) -> str:
        words = [self.word() + ("," if self.r.random() < 0.1 else "") for _ in range(self.r.randint(low, high))]
        words[0] = words[0].capitalize()
        return " ".join(mark + w for w in words) + self.r.choice([".", ".", ".", "", "!", "?"])

    def prose(self, mark: str, most: int = 8) -> str:
        return " ".join(self.sentence(mark) for _ in range(self.r.randint(1, most)))

    def phrase(self, kind: str) -> str:
        return " ".join(OTHER + w for w in self.r.choice(PHRASES[kind]).split())

    def open(self, kinds: list[tuple[str, str]]) -> tuple[str, str]:
        tag, marks = self.r.choice(kinds)
        joined = self.r.choice([" ", "-", "_"]).join(marks.split())
        return f'<{tag} {self.r.choice(["class", "id"])}="{joined}">' if marks else f"<{tag}>", f"</{tag}>"

    def around(self, kinds, inner: str) -> str:
        a, b = self.open(kinds)
        return a + inner + b

    def links(self, n: int) -> str:
        items = [f'<a href="/{self.word()}">{OTHER}{self.word()}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.7 else " | ".join(items)

    def paragraph(self, mark: str) -> str:
        text, r = self.prose(mark), self.r.random()
        if r < 0.1:
            return f"<p><b>{text}<br>"
        if r < 0.2:
            return f'<p>{text} <a href="/x">{self.sentence(mark, 2, 4)}</a> {text}</p>'
        if r < 0.26:
            return f"<h2>{self.sentence(mark, 2, 7)}</h2>"
        if r < 0.31:
            return "<ul>" + "".join(f"<li>{self.sentence(mark)}" for _ in range(self.r.randint(2, 5))) + "</ul>"
        if r < 0.35:
            return f"<blockquote>{text}</blockquote>"
        if r < 0.38:
            return f"<div>{text}</div>"
        if r < 0.39:
            return self.r.choice(["<object>{}</object>", "<canvas>{}</canvas>", "<video>{}</video>"]).format(f"<p>{text}</p>")
        return f"<p>{text}</p>"

    def advert(self) -> str:
        return self.around(ADVERT, self.prose(OTHER, 3) if self.r.random() < 0.8 else self.links(2))

    def side(self) -> str:
        return self.around(SIDE, f"<h3>{self.phrase('side')}</h3>" + self.r.choice([self.links(self.r.randint(2, 6)), f"<p>{self.prose(OTHER, 2)}</p>"]))

    def form(self) -> str:
        choice = "<select>" + "".join(f"<option>{OTHER}{self.word()}" for _ in range(self.r.randint(2, 4))) + "</select>" if self.r.random() < 0.3 else ""
        return f"<form><label>{self.phrase('form')}</label><input name=q>{choice}<button>{self.phrase('form')}</button></form>"

    def unseen(self) -> str:
        """What browsers with scripts and pictures don't show as text."""
        return self.r.choice([f"<noscript>{self.prose(OTHER, 1)}</noscript>", f"<svg><text>{OTHER}{self.word()}</text></svg>", f"<template><p>{self.prose(OTHER, 2)}</p></template>"])

    def comments(self) -> str:
        return self.around(COMMENTS, "".join(f'<div class="comment"><b>{OTHER}{self.word()}</b><p>{self.prose(OTHER, 3)}</p><a>{self.phrase("comments")}</a></div>' for _ in range(self.r.randint(1, 4))))

    def html(self) -> str:
        r, few = self.r, lambda p: self.r.random() < p
        parts = ["<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>"]
        parts += [self.around(MENU, self.links(r.randint(3, 8)))] if few(0.9) else []
        parts += [self.around(NOTICE, f"<p>{self.phrase('notice')} {self.prose(OTHER, 2)}</p>")] if few(0.3) else []
        parts += [self.advert()] if few(0.5) else []
        parts += [self.unseen()] if few(0.15) else []
        parts += [self.side()] if few(0.25) else []
        body = [f"<h1>{self.sentence(MAIN, 2, 10)}</h1>"] if few(0.85) else []
        for _ in range(r.randint(1, 14)):
            body.append(self.paragraph(MAIN))
            body += [self.advert()] if few(0.05) else []
            body += [self.side()] if few(0.03) else []
        parts.append(self.around(ARTICLE, "".join(body)))
        parts += [self.comments()] if few(0.35) else []
        parts += [self.side()] if few(0.4) else []
        parts += [self.form()] if few(0.3) else []
        parts += [self.advert()] if few(0.2) else []
        parts += [self.around(FOOTER, f"<p>{self.phrase('foot')} {self.prose(OTHER, 2)}</p>" if few(0.6) else f"{self.phrase('foot')} &middot; {self.prose(OTHER, 1)}")] if few(0.9) else []
        return "".join([*parts, "</body></html>"])


def labelled_pages(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return [Page(r).html() for _ in range(n)]
