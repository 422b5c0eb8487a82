"""Scans of one text from its start to its end, as Arrow-fed functions: what nested expressions would read again and again.

The work of each grows with the length of its text, whatever the text holds.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate, pairwise

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_END = re.compile(r"\r\n|[\n\r]")
#: Punctuation that ends a clause, and the characters of a text that are first split into clauses, from its end.
MARKS, BLOCK = ".!?;…", 1000


def _beyond(run: re.Match) -> str:
    """What characters beyond ASCII are in folded text: combining marks are nothing, others part words."""
    return "" if all(unicodedata.category(c) == "Mn" for c in run[0]) else " "


def folded(text: str) -> str:
    """Letters a-z, digits and # alone, words parted by one space."""
    text = text.lower()
    if not text.isascii():
        text = re.sub(r"[^\x00-\x7F]+", _beyond, unicodedata.normalize("NFD", text.replace("đ", "d")))
    return re.sub(r"[^a-z0-9#]+", " ", text).strip()


class Phrases:
    """Folded phrases to look for: substrings from four letters on, shorter words at boundaries; longer ones take their place first."""

    def __init__(self, terms: Sequence[str]):
        import ahocorasick

        self.terms = sorted(dict.fromkeys(map(folded, terms)), key=len, reverse=True)
        self.whole = [not (" " in t or len(t) >= 4 or t.startswith("#")) for t in self.terms]
        self.found = ahocorasick.Automaton()
        for k, t in enumerate(self.terms):
            self.found.add_word(t, k)
        self.found.make_automaton()

    def hits(self, blob: str, not_after: str = "") -> list[int]:
        """Where phrases start in folded text, none over another; not where `not_after` ends before them, with a space or without."""
        free, at, ends = [], {}, len(blob)
        for last, k in self.found.iter(blob):
            end = last + 1
            start = end - len(self.terms[k])
            if self.whole[k] and (start and blob[start - 1] != " " or end < ends and blob[end] != " "):
                continue
            if start < at.get(k, 0):  # over the place before of the same phrase
                continue
            at[k] = end
            free.append((k, start, end))
        taken, out = bytearray(len(blob)) if len(free) > 1 else b"", []
        for _, start, end in sorted(free):
            if not_after and blob[max(0, start - len(not_after) - 1) : start].rstrip(" ").endswith(not_after):
                continue
            if len(free) > 1:
                if any(taken[start:end]):
                    continue
                taken[start:end] = b"\1" * (end - start)
            out.append(start)
        return out


class Negations:
    """How many negating words are among the `window` words before a place of a text, the piece of a word right before it included."""

    def __init__(self, blob: str, words: frozenset[str], window: int):
        self.blob, self.words, self.window = blob, words, window
        self.longest = max(map(len, words))
        given = blob.split(" ")
        self.starts = [0, *accumulate(len(word) + 1 for word in given[:-1])]
        self.sums = [0, *accumulate(word in words for word in given)]

    def before(self, start: int) -> int:
        n = bisect_right(self.starts, start) - 1
        part = start - self.starts[n]
        low = max(0, n - self.window + (part > 0))
        return self.sums[n] - self.sums[low] + (0 < part <= self.longest and self.blob[self.starts[n] : start] in self.words)


def _space(run: re.Match) -> str:
    """A run of white space, kept as short as the pattern of clauses needs it."""
    run = run[0]
    if "\n" not in run:
        return " "
    return ("\n" if set(run) == {"\n"} else "\n ") if run[0] == "\n" else " \n"


class Sentiment:
    """Counts of good and bad phrases by clause, each turned by an odd number of negations before it."""

    def __init__(self, good: Sequence[str], bad: Sequence[str], negations: Sequence[str], contrast: Sequence[str], window: int):
        self.good, self.bad, self.negations, self.window = Phrases(good), Phrases(bad), frozenset(negations), window
        self.clauses = re.compile(rf"[{MARKS}]+|\n+|\s+(?:{'|'.join(contrast)})\s+", re.IGNORECASE)

    def balance(self, clause: str) -> int:
        blob = folded(clause)
        ups, downs = self.good.hits(blob), self.bad.hits(blob, "sau")
        if not ups and not downs:
            return 0
        turns = Negations(blob, self.negations, self.window)
        value = lambda hits: sum(-1 if turns.before(h) % 2 else 1 for h in hits)
        return value(ups) - value(downs)

    def parts(self, text: str) -> Iterator[str]:
        """Clauses that may hold a phrase, the last one first. Blocks of growing size start after a mark, which no other end of a clause reaches across."""
        end, size, blank = len(text), BLOCK, True
        while end > 0:
            start = 1 + max(text.rfind(mark, 0, max(0, end - size)) for mark in MARKS)
            block = text[start:end]
            kept = [p for p in self.clauses.split(re.sub(r"\s{2,}", _space, block)) if p.strip()]
            blank = blank and not kept
            blob = folded(block)
            if next(self.good.found.iter(blob), None) or next(self.bad.found.iter(blob), None):
                yield from reversed(kept)
            end, size = start, 2 * size
        if blank:
            yield text

    def __call__(self, text: str | None) -> str:
        for part in self.parts(text or ""):
            if told := self.balance(part):
                return "positive" if told > 0 else "negative"
        return "neutral"


def sentiment(text: Column, good: Sequence[str], bad: Sequence[str], negations: Sequence[str], contrast: Sequence[str], window: int) -> Column:
    given, kept = (good, bad, negations, contrast, window), []

    @F.pandas_udf("string")
    def label(texts: pd.Series) -> pd.Series:
        if not kept:
            kept.append(Sentiment(*given))
        return texts.map(kept[0])

    return label(text)


def lines_of(text: str | None) -> list[str]:
    """Trimmed lines that are not empty."""
    return [x for line in LINE_END.split(text or "") if (x := line.strip())]


def _apart(places: Sequence[int], least: int) -> list[int]:
    """Ascending places without those less than `least` after the last that stayed."""
    out: list[int] = []
    for p in places:
        if not out or p >= out[-1] + least:
            out.append(p)
    return out


def blocks(lines: Sequence[str], name: str, times: Sequence[str], skip: str, footer: str) -> list[tuple[str, str, str]]:
    """(name, time, text) of blocks of lines: a name, a time, and lines of text up to the next block, a footer or a date (the last of times).

    The first line of a block's text is no skipped one; later ones are left out, as are counts.
    """
    name, skip, footer = re.compile(name), re.compile(skip), re.compile(footer)
    times = [re.compile(t) for t in times]
    starts = _apart([i for i in range(len(lines) - 2) if name.search(lines[i]) and any(t.search(lines[i + 1]) for t in times) and not skip.search(lines[i + 2])], 3)
    out = []
    for start, end in pairwise([*starts, len(lines)]):
        told = [lines[start + 2]]
        for line in lines[start + 3 : end]:
            if footer.search(line) or times[-1].search(line):
                break
            if not skip.search(line) and not re.fullmatch(r"\d+", line):
                told.append(line)
        out.append((lines[start], lines[start + 1], " ".join(told)))
    return out


def threads(lines: Sequence[str], noise: frozenset[str], top: frozenset[str], date: str) -> list[tuple[str, str, str]]:
    """(name, time, text) below the first line of `top`, or from the fifth line on: a name, at most one line of its own, a time, lines of text."""
    begin = next((k for k, line in enumerate(lines) if line in top), 4)
    lines, dated, plain, count = [*lines[begin:], *[""] * 6], re.compile(date), re.compile(r"^[A-Za-z0-9._]+$"), re.compile(r"(?i)^[\d./KMB]+$")
    size = len(lines) - 6

    def header(i: int) -> int | None:
        """Place of the text after a name's time."""
        if not (lines[i].startswith("@") and " " not in lines[i] or plain.search(lines[i])):
            return None
        after = next((k for k in range(i + 1, i + 4) if lines[k] not in noise), i + 4)
        return after + 1 if dated.search(lines[after]) else after + 2 if dated.search(lines[after + 1]) else None

    found = {i: at for i in range(size) if (at := header(i)) is not None}
    starts = _apart(list(found), 2)
    out = []
    for start, end in pairwise([*starts, size]):
        at = found[start]
        told = " ".join(x for x in lines[at:end] if not count.search(x) and x not in noise)
        if told:
            out.append((lines[start], lines[at - 1], told))
    return out


class ThreadPage:
    """The lines of a thread's page: whose post it is, when and what it says, and the comments below it.

    noise: lines of the site's own; top, activity: those above comments; date, any_date: patterns of a time and of a written date; chrome: of the
    site's menus. A header is a name, lines of the site, at most one other line, and a time.
    """

    HEAD = 40

    def __init__(self, body: str | None, noise: frozenset[str], top: frozenset[str], activity: frozenset[str], date: re.Pattern, chrome: re.Pattern):
        self.body, self.lines, self.noise, self.top, self.marks, self.date, self.chrome = body or "", lines_of(body), noise, top, top | activity, date, chrome
        # of each line the first from there on that is not the site's
        self.after = [len(self.lines)] * (len(self.lines) + 1)
        for k in range(len(self.lines) - 1, -1, -1):
            self.after[k] = self.after[k + 1] if self.lines[k] in noise else k
        self.names = [x.startswith("@") and " " not in x or re.fullmatch(r"[A-Za-z0-9._]+", x) is not None for x in self.lines]

    def at(self, k: int) -> str:
        return self.lines[k] if 0 <= k < len(self.lines) else ""

    def header(self, k: int) -> tuple[str, int] | None:
        """Time and place of the text of the header that begins at a line."""
        if not self.names[k]:
            return None
        after = self.after[k + 1]
        return next(((self.at(j), j + 1) for j in (after, after + 1) if self.date.search(self.at(j))), None)

    def told(self, start: int, end: int) -> list[str]:
        """Lines of text: neither the site's nor counts alone."""
        return [x for x in self.lines[start:end] if x not in self.noise and not re.fullmatch(r"[\d./KMBkmb]+", x)]

    def is_chrome(self, text: str) -> bool:
        return not text or self.chrome.search(text) is not None

    def read(self, page: str) -> tuple[str, str, list[tuple[str, str, str]]]:
        """(label of its time, text, comments as name, time and text) of the page of `page`."""
        owner = page.lstrip("@").casefold()
        own = next((k for k, x in enumerate(self.lines) if owner and x.lstrip("@").casefold() == owner), -1)
        others = lambda start: (k for k in range(start, len(self.lines)) if self.names[k] and self.lines[k].lstrip("@").casefold() != owner)
        head = self.header(own) if own >= 0 else None
        if own >= 0:
            plain = lambda k: self.lines[k] not in self.noise and not re.fullmatch(r"[\d./KMBkmb]+", self.lines[k])
            below = next((k for k in others(max(head[1] if head else own, own + 1)) if plain(k)), len(self.lines))
        else:
            below = next((k for k, x in enumerate(self.lines) if x in self.top), -1)
            below = below if below >= 0 else next((k for k in range(4, len(self.lines) - 1) if self.header(k)), len(self.lines))
        label, text = "", ""
        if head:
            end = next(others(head[1]), len(self.lines))
            text = " ".join(self.told(head[1], end))
            label = head[0]
        if not head or self.is_chrome(text):
            dated = next((k for k in (3, 4) if self.date.search(self.at(k))), None)
            label, start = (self.at(dated), dated + 1) if dated is not None else ("", 3)
            text = " ".join(self.told(start, below))
        if self.is_chrome(text):
            after = (self.at(k + 1) for k, x in enumerate(self.lines[:-1]) if self.date.search(x))
            text = next((x for x in after if len(x) > 10 and not self.is_chrome(x)), text)
        return label, text, self.comments(below, own)

    def comments(self, start: int, own: int) -> list[tuple[str, str, str]]:
        """Below the marks at `start`: from each header to the next, which is no line of the site nor part of another header."""
        start = next((k for k in range(start, len(self.lines)) if self.lines[k] not in self.marks), len(self.lines))
        heads = [(k, h) for k in range(start, len(self.lines)) if (own < 0 or k > own) and (h := self.header(k))]
        out, at = [], start
        kept = []
        for k, h in heads:
            if k >= at and (not kept or self.lines[k] not in self.noise):
                kept.append((k, h))
                at = h[1]
        ends = [k for k, _ in kept[1:]] + [len(self.lines)]
        for (k, (label, begin)), end in zip(kept, ends[: len(kept)], strict=True):
            if told := " ".join(self.told(begin, end)):
                out.append((self.lines[k], label, told))
        return out

    def written_date(self, html: str) -> str:
        """A date of the page's source or text, then one of the text's lines; empty if none."""
        blob = f"{html}\n{self.body}"
        for pattern in (r"\b(\d{2}/\d{2}/\d{2,4})\b", r'(?i)aria-label="(\d{1,2}\s+th(?:áng|g)\s+\d{1,2}(?:[^"]*)?)"'):
            if found := re.search(pattern, blob):
                return found[1]
        return ""

    def label(self) -> str:
        """A written date of the first lines, or of the text; else a short relative time."""
        first = self.lines[: self.HEAD]
        own = next((x for x in first if re.fullmatch(r"\d{1,2}/\d{1,2}/\d{2,4}", x)), None)
        if found := own or (m := re.search(r"\b(\d{1,2}/\d{1,2}/\d{2,4})\b", self.body)) and m[1]:
            return found
        short = next((x for x in first if re.fullmatch(r"(?i)\d+[smhdw]", x)), None)
        return short or ((m := re.search(r"(?i)\b(\d+[smhdw])\b", self.body)) and m[1]) or ""


_QUOTED_OR_BRACE = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*(?:"|\\?$)|[{}]', re.DOTALL)


def balanced(source: str | None, marker: str) -> str | None:
    """The object that follows a marker, up to its closing brace; braces within quoted texts do not count. None if it never closes."""
    start = re.search(rf"{re.escape(marker)}\s*=?\s*\{{", source or "")
    if not start:
        return None
    depth = 0
    for token in _QUOTED_OR_BRACE.finditer(source, start.end() - 1):
        depth += {"{": 1, "}": -1}.get(token[0], 0)
        if not depth:
            return source[start.end() - 1 : token.end()]
    return None
