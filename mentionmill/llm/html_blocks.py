"""Leaf blocks of HTML pages with the features of their ancestors and text."""

from __future__ import annotations

import html
import re
import zlib

#: Elements whose content is text up to their own closing tag, and no part of a page's prose.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
#: Elements that may hold anything. One that is never closed holds nothing: the rest of the page is not its own.
HOLDERS = {"noscript", "template", "svg", "object", "canvas", "select", "audio", "video"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "param", "track"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "math", "mfrac", "mi", "mn", "mo", "mroot", "mrow", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "semantics",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: An opening tag of the key ends an open element of the values, up to the nearest of the barriers.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = {"ul", "ol", "dl", "table", "body", "article", "section", "div", "main"}
#: Comments, declarations, and tags with their attributes; a quote is one only where a value begins.
TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?:>|[^a-zA-Z>][^>]*+(?:>|\Z))
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+|=)*+)(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))", re.I)
WORDS = re.compile(r"[a-z]+|[0-9]+")
HASHED = 1 << 15

CUES = re.compile(
    r"(cookie|privacy|subscribe|newsletter|sign up|sign in|log ?in|register|advert|sponsor|promo|share|follow us|comment|repl(?:y|ies)|related|read more|copyright|©|all rights|terms|menu|home|contact|search|next|previous|posted|ago\b|like|click)"
)


def feature(name: str) -> int:
    return zlib.crc32(name.encode()) % HASHED


class Blocks:
    """Splits pages; features of a path of ancestors are held, so that each path is looked at once."""

    def __init__(self, most: int = 50_000):
        self.paths: dict[tuple, list[int]] = {}
        self.most = most

    def path_features(self, path: tuple) -> list[int]:
        found = self.paths.get(path)
        if found is None:
            names = {"bias"}
            for depth, (tag, marks) in enumerate(reversed(path)):
                if tag not in INLINE:
                    names.add(f"in {tag}")
                for m in marks:
                    names |= {f"mark {m}", f"mark {tag} {m}"}
                if depth < 2:
                    names.add(f"up{depth} {tag}")
            if not any(t in ("article", "main") for t, _ in path):
                names.add("no article")
            if len(self.paths) >= self.most:
                self.paths.clear()
            found = self.paths[path] = [feature(n) for n in sorted(names)]
        return found

    def split(self, page: str) -> list[tuple[str, float, tuple]]:
        """The blocks in page order: text with white space made one space, share of it in links, path of ancestors."""
        stack: list[tuple[str, tuple]] = []
        out: list[tuple[str, float, tuple]] = []
        pieces: list[str] = []
        linked, links, at, path = 0, 0, 0, ()
        held: dict[str, int] = {}  # where each holder is closed last

        def flush() -> None:
            nonlocal linked, pieces
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    out.append((text, min(1.0, linked / len(text)), path))
            pieces, linked = [], 0

        while at < len(page):
            m = TOKEN.search(page, at)
            end = m.start() if m else len(page)
            if end > at:
                text = html.unescape(page[at:end])
                if not pieces:
                    path = tuple(stack)
                pieces.append(text)
                if links:
                    linked += len(text.strip())
            if not m:
                break
            at = m.end()
            tag = m[2].lower() if m[2] else None
            if tag is None:
                continue
            if not m[1] and tag in RAW:
                flush()
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else len(page)
                continue
            if tag == "head":  # its elements are raw or empty; what cannot stand in it is the body, with or without a tag
                flush()
                continue
            if tag in HOLDERS and not m[1]:
                if tag not in held:
                    held[tag] = max((x.start() for x in re.finditer(rf"</{tag}\b", page, re.I)), default=-1)
                if held[tag] < at:
                    flush()
                    continue
            if tag in VOID:
                if tag in INLINE:
                    pieces += [" "] if pieces else []
                else:
                    flush()
                continue
            if tag not in INLINE:
                flush()
            if m[1]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        links -= sum(t == "a" for t, _ in stack[k:])
                        del stack[k:]
                        break
                continue
            ends = CLOSES.get(tag, set()) | ({"p"} if tag not in INLINE else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in BARRIERS:
                    break
            marks = ()
            if "=" in m[3]:
                marks = tuple(sorted({w for a in ATTRIBUTE.findall(m[3]) for w in WORDS.findall(" ".join(a).lower())}))
            stack.append((tag, marks))
            links += tag == "a"
        flush()
        return out

    def features(self, blocks: list[tuple[str, float, tuple]]) -> list[list[int]]:
        longest = max((len(t) for t, _, _ in blocks), default=1)
        out = []
        for k, (text, links, path) in enumerate(blocks):
            n = text.count(" ") + 1
            names = [
                f"words {min(7, n.bit_length())}", f"links {round(links * 4)}", f"place {8 * k // len(blocks)}", f"stops {min(3, text.count('. ') + text.endswith(('.', '!', '?')))}",
                f"size {round(4 * len(text) / longest)}", f"commas {min(3, text.count(','))}", f"case {text.isupper()} {text[:1].isupper()}", f"end {text[-1] in '.!?:;'}",
            ]
            if n < 30:
                names += [f"cue {c}" for c in set(CUES.findall(text.lower()))]
            out.append(self.path_features(path) + [feature(x) for x in names])
        return out
