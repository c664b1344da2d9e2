"""Dictionary matching as a table function: all terms of a text in one pass over its characters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionmill.operators import dictionary
from mentionmill.runtime import ship

#: Terms, and characters of all terms, of an automaton that is sent to the workers; longer lists are joined.
MOST_TERMS, MOST_CHARACTERS = 500_000, 20_000_000
WORD = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def _edge(text: str, at: int, inside: bool, plain: bool) -> bool:
    """Whether a word begins or ends at ``at``, where a term's own character next to it is of a word or not (``inside``)."""
    other = text[at] if 0 <= at < len(text) else " "
    word = other in WORD if plain else other.isalnum() or other == "_"
    return word != inside


def matcher(forms: dict[str, list[str]], whole_words: bool) -> Callable[[str | None], set[str]]:
    """A function from a text to the terms found in it; ``forms`` has the terms for each form that is looked for."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for form, terms in forms.items():
        plain = all(c in WORD for c in form)
        ends = tuple(c in WORD if plain else c.isalnum() or c == "_" for c in (form[0], form[-1]))
        automaton.add_word(form, (len(form), ends, plain, terms))
    automaton.make_automaton()

    def find(text: str | None) -> set[str]:
        found: set[str] = set()
        for end, (size, (first, last), plain, terms) in automaton.iter(text or ""):
            if terms[0] not in found and (not whole_words or (_edge(text, end - size, first, plain) and _edge(text, end + 1, last, plain))):
                found.update(terms)
        return found

    return find


def listed(terms: DataFrame, ignore_case: bool, whole_words: bool) -> dict[str, list[str]] | None:
    """The terms by the form that is looked for, or nothing if there are too many to send out."""
    low = F.lower("term") if ignore_case else F.col("term")
    usable = F.col("form").rlike(r"\w") if whole_words else F.length("form") >= 3
    rows = terms.select("term", low.alias("form")).where(usable).distinct()
    n, size = rows.agg(F.count("*"), F.sum(F.length("form"))).collect()[0]
    if n > MOST_TERMS or (size or 0) > MOST_CHARACTERS:
        return None
    forms: dict[str, list[str]] = {}
    for r in rows.toLocalIterator():
        forms.setdefault(r["form"], []).append(r["term"])
    return forms


def table_function(forms: dict[str, list[str]], whole_words: bool = True, ignore_case: bool = False):
    """A table function ``(text) -> term`` for ``lateralJoin`` or, once registered, for SQL's ``LATERAL``.

    The forms go to each worker once, and each worker builds the automaton when
    its first text comes.
    """

    if SparkSession.getActiveSession() is not None:
        ship(SparkSession.getActiveSession())

    class Terms:
        def __init__(self) -> None:
            self.find = built(forms, whole_words)

        def eval(self, text: str) -> Iterator[tuple[str]]:
            for term in self.find(text.lower() if ignore_case and text is not None else text):
                yield (term,)

    kept: dict = {}

    def built(forms: dict[str, list[str]], whole_words: bool):
        if "find" not in kept:
            kept["find"] = matcher(forms, whole_words)
        return kept["find"]

    return F.udtf(Terms, returnType="term string")


def find_terms(texts: DataFrame, terms: DataFrame, key: str, ignore_case: bool = False, whole_words: bool = True) -> DataFrame:
    """``key, term``: the rows of ``dictionary.match_terms`` (or, without ``whole_words``, of ``match_substrings``), by one pass a text.

    Texts are neither exploded into words nor joined. Lists beyond
    ``MOST_TERMS`` or ``MOST_CHARACTERS`` are not sent out: those are matched by
    the joins of ``dictionary``. Null and empty texts have no terms; terms that
    those functions leave out are left out here.
    """
    forms = listed(terms, ignore_case, whole_words)
    if forms is None:
        return dictionary.match_terms(texts, terms, key, ignore_case) if whole_words else dictionary.match_substrings(texts, terms, key)
    if not forms:
        return texts.select(key, F.lit("").alias("term")).limit(0)
    find = table_function(forms, whole_words)
    low = F.lower("text") if ignore_case else F.col("text")
    rows = texts.select(key, low.alias("text"))
    return rows.lateralJoin(find(F.col("text").outer())).select(key, "term").distinct()
