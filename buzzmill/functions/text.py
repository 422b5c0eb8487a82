"""Text functions as Spark expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def base_letters() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and the letters below the marks; from the Unicode decompositions."""
    marked, plain = [], []
    for code in (*range(0xE0, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if c == c.lower() and base != c and len(base) == 1:
            marked.append(c)
            plain.append(base)
    return "".join(marked), "".join(plain)


def collapse(text: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def strip_marks(text: Column, with_d: bool = False) -> Column:
    """Lower case without accents; đ stays unless with_d."""
    marked, plain = base_letters()
    return F.regexp_replace(F.translate(F.lower(text), marked + ("đ" if with_d else ""), plain + ("d" if with_d else "")), r"\p{Mn}", "")


def fold(text: Column) -> Column:
    """Letters a-z, digits and # alone, words parted by one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(strip_marks(text, True), r"[^a-z0-9#\s]+", " "), r"\s+", " "))


def term_in(folded: Column, term: str) -> Column:
    """Whether a folded term is in folded text: #tags as tag or bare, phrases as substrings, words at boundaries."""
    if term.startswith("#"):
        return folded.contains(term) | folded.contains(term[1:])
    return folded.contains(term) if " " in term else folded.rlike(rf"(?<![a-z0-9#]){term}(?![a-z0-9])")


def any_term(folded: Column, terms: Sequence[str]) -> Column:
    """term_in for any of the terms, as few expressions as possible."""
    words = [t for t in terms if not t.startswith("#") and " " not in t]
    out = F.lit(False)
    for t in terms:
        out = out if t in words else out | term_in(folded, t)
    return out | folded.rlike(rf"(?<![a-z0-9#])(?:{'|'.join(words)})(?![a-z0-9])") if words else out


def clauses(text: Column, contrast: Sequence[str] = ("but", "however", "nhưng", "tuy nhiên")) -> Column:
    """Parts of a text between punctuation, line ends and contrasting words."""
    parts = F.split(F.lower(text), rf"(?U)[.!?;,\n]+|\b(?:{'|'.join(contrast)})\b")
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(text), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no query, fragment or closing slash."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    host = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1))
    return F.regexp_replace(F.concat(host, F.substring(bare, F.length(host) + 1, F.length(bare))), r"/+$", "")


def first_text(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def snippet(text: Column, n: int = 160) -> Column:
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n - 1), F.lit("…"))).otherwise(flat)


def squeeze(text: Column) -> Column:
    """A key without spaces, dots, underscores and dashes."""
    return F.regexp_replace(F.lower(text), r"[\s._-]+", "")


def with_parameter(url: Column, name: str, value: Column) -> Column:
    return F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit(f"{name}="), value)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def plain_form(term: str) -> str:
    """A literal without accents, đ as d."""
    return "".join(c for c in unicodedata.normalize("NFD", term.replace("đ", "d").replace("Đ", "D")) if unicodedata.category(c) != "Mn")


def fold_literal(term: str) -> str:
    """What fold does, for a literal."""
    return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789#" else " " for c in plain_form(term.lower())).split())


def any_phrase(folded: Column, phrases: Sequence[str]) -> Column:
    """Whether a phrase is in folded text: as a substring from four letters on or with a space or #, else as a word."""
    return folded.rlike("|".join(p if " " in p or len(p) >= 4 or p.startswith("#") else rf"(?<![a-z0-9#]){p}(?![a-z0-9])" for p in dict.fromkeys(map(fold_literal, phrases))))


def normal(text: Column) -> Column:
    """Composed letters (NFC), case folded, runs of white space as one space, trimmed; null is empty. Arrow batches: Spark has no NFC."""
    @F.pandas_udf("string")
    def composed(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(lambda t: " ".join(unicodedata.normalize("NFC", t).casefold().split()))

    return composed(text)
