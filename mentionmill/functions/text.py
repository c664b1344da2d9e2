"""Text rules as column expressions; nothing here leaves the JVM except :func:`nfkc`, :func:`unescape` and, where texts are not ASCII, :func:`repair` and :func:`transliterate`."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from mentionmill import fixed_values as V

NULL_TOKENS = ("", "nan", "none", "n/a")


def quoted(phrases: list[str]) -> str:
    """An alternation of literal phrases for regular expressions, longest first, so that it reads alike in all dialects."""
    return "|".join(re.sub(r"([.^$*+?{}\[\]\\|()/])", r"\\\1", p) for p in sorted(phrases, key=lambda p: (-len(p), p)))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]+", "")


def squeeze(c: Column) -> Column:
    """White space made one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else x)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x) if isinstance(x, str) else x)


#: Letters that do not fall apart into a letter of ASCII and a mark.
LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "þ": "th", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "..."}


_TABLE = str.maketrans(LETTERS)


@F.udf(StringType(), useArrow=False)  # rows go to Python a hundred at a time, so that long texts do not add up
def _transliterated(x: str | None) -> str | None:
    return None if x is None else unicodedata.normalize("NFKD", x.translate(_TABLE)).encode("ascii", "ignore").decode()


def _where_not_ascii(rule, c: Column) -> Column:
    """``rule``, which keeps ASCII as it is, for texts that have other characters: only those go to Python."""
    other = F.when(F.length(c) < F.octet_length(c), c)
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(rule(other))


def transliterate(c: Column) -> Column:
    """The closest ASCII letters; what has none is left out."""
    return _where_not_ascii(_transliterated, c)


def _repaired(text: str) -> str:
    for page in ("cp1252", "latin-1"):
        try:
            return text.encode(page).decode("utf-8")
        except UnicodeError:  # a character that the page has not, or bytes that are no UTF-8
            continue
    return text


@F.udf(StringType(), useArrow=False)
def _mended(x: str | None) -> str | None:
    return None if x is None else _repaired(x)


def repair(c: Column) -> Column:
    """Text whose UTF-8 was read as Windows-1252 or Latin-1, read right: all its characters are of that page and their bytes are UTF-8. Other text stays as it is."""
    return _where_not_ascii(_mended, c)


def one_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\r\n]+", " "))


def clean_text(c: Column) -> Column:
    """Strip tags, mend wrongly decoded characters, squeeze white space, drop non-ASCII; references other than the five of XML need :func:`unescape` before."""
    c = F.regexp_replace(c, r"<[^>]+>", "")
    for bad, good in V.MOJIBAKE:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return ascii_only(squeeze(c))


def xml_entities(c: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def placeholders(c: Column) -> Column:
    """URLs, e-mail addresses, phone numbers and currency signs replaced by their kinds."""
    c = F.regexp_replace(c, r"(?i)\b(?:https?://|www\.)[^\s<>]+", "<URL>")
    c = F.regexp_replace(c, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>")
    c = F.regexp_replace(c, r"\+?\d?[ ]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}", "<PHONE>")
    return F.regexp_replace(c, r"[$£€¥]", "<CUR>")


def all_caps(c: Column) -> Column:
    return c.rlike("[A-Z]") & ~c.rlike("[a-z]")


def title_rules(c: Column) -> Column:
    """Digits alone, three characters or fewer, or nothing alphanumeric: null; all capitals: capitalised words."""
    return F.when(c.rlike(r"^\d+$") | (F.length(c) <= 3) | ~c.rlike("[A-Za-z0-9]"), F.lit(None)).when(all_caps(c), F.initcap(c)).otherwise(c)


def sentence_case(c: Column) -> Column:
    return F.when(all_caps(c), F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))).otherwise(c)


def _steps(c: Column, steps: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def normal_title(c: Column) -> Column:
    return sentence_case(squeeze(_steps(c, V.TITLE_STEPS)))


def normal_abstract(c: Column) -> Column:
    intro, head = F.regexp_extract(c, r"(?is)\bintroduction\b.*", 0), F.regexp_extract(c, r"(?is)\babstracts?\b.*", 0)
    c = F.when(F.lower(c).startswith("you have access") & (intro != ""), intro).otherwise(c)
    head = F.regexp_extract(c, r"(?is)\babstracts?\b.*", 0)
    c = F.when(c.startswith("//") & (head != ""), head).otherwise(c)
    return sentence_case(squeeze(_steps(c, V.ABSTRACT_STEPS)))


def without_numbers(title: Column) -> Column:
    """Numeric heads such as ``12:``, ``#123`` or ``<PHONE>:`` removed."""
    return F.trim(F.regexp_replace(title, r"^(?:\d{2,3}:|#\d{3,4}|<PHONE>:)\s*", ""))


def without_numbers_before(abstract: Column, word: str = "Background") -> Column:
    return F.regexp_replace(abstract, rf"^\d+\s*({word})", "$1")


def clean_term(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(F.trim(c)), "[-‐–—]", " "))


def distinct_words(c: Column) -> Column:
    """Words in order, each once."""
    return F.array_join(F.filter(F.array_distinct(F.split(c, r"\s+")), lambda w: w != ""), " ")


def clean_cancer_term(c: Column) -> Column:
    """Qualifiers removed one after the other as whole words, plurals made singular, repeated words dropped; null if nothing is left."""
    c = F.regexp_replace(F.lower(F.trim(c)), r"^[+.,\d()\-\s]+", "")
    bare = c
    for word in V.CANCER_QUALIFIERS:
        bare = F.regexp_replace(bare, rf"\b{word}\b\s*", "")
    c = F.when(c.rlike(rf"\b(?:{'|'.join(V.CANCER_QUALIFIERS)})\b"), bare).otherwise(c)  # most terms have none
    for many, one in V.CANCER_SINGULARS:
        c = F.replace(c, F.lit(many), F.lit(one))
    c = distinct_words(c)
    return F.when(c != "", c)


CANCER_NAME_STEPS = [(r"\([^)]*\)", ""), (r"carcinomas?|tumou?rs?|cancers", "cancer"), (r"[.\d/]+\s*$", "")]


def normal_cancer_name(c: Column) -> Column:
    return squeeze(_steps(F.lower(c), CANCER_NAME_STEPS))


def standard_cancer(c: Column) -> Column:
    for word in ("adenocarcinoma", "tumor", "carcinoma"):
        c = F.replace(c, F.lit(word), F.lit("cancer"))
    return c


def distinct_names(c: Column, separator: str = ",") -> Column:
    """A delimited list: hyphens and brackets dropped, ``familial`` and ``n/a`` left out, the first spelling of each name kept."""
    names = F.transform(F.split(c, separator), lambda x: F.trim(F.regexp_replace(x, r"[-()]", "")))
    names = F.filter(names, lambda x: (x != "") & ~F.lower(x).isin("familial", "n/a"))
    return F.aggregate(names, F.array().cast("array<string>"), lambda seen, x: F.when(F.exists(seen, lambda y: F.lower(y) == F.lower(x)), seen).otherwise(F.concat(seen, F.array(x))))


def normal_drug(c: Column, letters_only: bool = False) -> Column:
    c = F.regexp_replace(F.lower(c), "-", " ")
    c = F.regexp_replace(c, r"\b(?:drug|treatment|therapy|chemotherapy|medication|cancer)\b", "")
    c = F.regexp_replace(c, r"\s*\d+\s*$", "")
    if letters_only:
        c = F.regexp_replace(c, r"[^a-z\s]", "")
    return distinct_words(F.trim(c))


def clean_parent(c: Column) -> Column:
    c = F.regexp_replace(F.lower(c), r"\b(?:malignant|childhood|adult|juvenile|benign)\b", "")
    c = F.regexp_replace(F.regexp_replace(c, "neoplasm|carcinoma", "cancer"), "leukaemia", "leukemia")
    return squeeze(c)


def keyword_category(c: Column, mode: str = "substring", keywords: list[tuple[str, str]] | None = None) -> Column:
    """The category of the first keyword found (``substring`` or whole ``word``); the name itself if none is."""
    keywords, low = keywords or V.CANCER_KEYWORDS, F.lower(c)
    if mode == "substring":
        return F.coalesce(*[F.when(low.contains(k), F.lit(v)) for k, v in keywords], c)
    bladder = F.when(low.rlike(r"\bbladder\b") & ~low.contains("gallbladder"), F.lit("bladder cancer")).when(low.contains("gallbladder"), F.lit("gallbladder cancer"))
    return F.coalesce(bladder, *[F.when(low.rlike(rf"\b{k}\b"), F.lit(v)) for k, v in keywords], c)


def blood_cancer(c: Column) -> Column:
    low = F.lower(c)
    leukemia, lymphoma = low.contains("leukemia") | low.contains("leukemic"), low.contains("lymphoma")
    return F.when(leukemia & lymphoma, F.lit("leukemia/lymphoma")).when(leukemia, F.lit("leukemia")).when(lymphoma, F.lit("lymphoma")).otherwise(c)


def asked_cancer(c: Column, exceptions: list[str]) -> Column:
    """A user's disease name: synonyms of cancer replaced unless the name is an exception."""
    low = F.lower(F.trim(c))
    return F.when(low.isin(exceptions), low).otherwise(F.regexp_replace(low, "tumour|tumor|carcinoma|neoplasm", "cancer"))


def wrapped(c: Column, width: int = 60, mark: str = "<br>") -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"(.{{1,{width}}})(?:\s+|$)", f"$1{mark}"), f"{mark}$", "")


def listed(c: Column) -> Column:
    """A delimited or literal list as an array of trimmed names; null as an empty one."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"^\[|\]$|['\"]", "")
    return F.filter(F.transform(F.split(bare, "[,;]"), lambda x: F.trim(x)), lambda x: x != "")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(\w+)"), F.lit(1))


def rs_id(*names: Column) -> Column:
    """The first reference number ``rs...`` in the given texts, in order."""
    return F.lower(F.coalesce(*[F.nullif(F.regexp_extract(n, r"(?i)rs\d+", 0), F.lit("")) for n in names]))


def hgvs_tail(c: Column) -> Column:
    return F.element_at(F.split(F.split(c, r"\|")[0], ":"), -1)


def ontology_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"DOID:(\d+)", 1), F.lit(""))


def variant_key(variant: Column, gene: Column) -> Column:
    return F.concat_ws("_", F.lower(variant), F.upper(gene))


def split_variant_key(key: Column) -> tuple[Column, Column]:
    """The parts before and after the last underscore."""
    return F.regexp_extract(key, r"^(.*)_([^_]*)$", 1), F.substring_index(key, "_", -1)
