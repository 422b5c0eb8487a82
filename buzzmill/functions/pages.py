"""Comments, counts and dates out of the text or source of a page, as Spark expressions over the array of its lines."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from buzzmill.functions import scans
from buzzmill.functions.times import compact_count

# Lines of two sites that are no text of people.
THREADS_NOISE = ("Thread", "Translate", "Top", "Hàng đầu", "View activity", "Xem hoạt động", "Pinned", "Tác giả", "Author", "·")
THREADS_TOP, THREADS_ACTIVITY = ("Top", "Hàng đầu"), ("View activity", "Xem hoạt động")
_MENU = r"more posts from .*|meta|meta ai|about|blog|jobs|help|api|privacy|terms|locations|popular|instagram lite|threads|contact uploading(?: &| and) non-users"
INSTAGRAM_SKIP = rf"(?iu)^(?:\d[\d.,]*\s+likes?|reply|see translation|view all .* replies?|liked by .*|{_MENU}|meta verified)$"
INSTAGRAM_FOOTER = rf"(?iu)^(?:{_MENU}|english|afrikaans|العربية|čeština|dansk|deutsch)$"
# Shapes of names and times.
NAME = r"(?i)^[a-z0-9._]{2,}$"
AGO = r"(?iu)^(?:\d+\s*[smhdw]|\d+\s*(?:giây|phút|giờ|ngày|tuần)\s*trước|\d+\s*(?:seconds?|minutes?|hours?|days?|weeks?)\s*ago)$"
DATE = r"^(?:[A-Z][a-z]+ \d{1,2}(?:, \d{4})?|\d{1,2} [A-Z][a-z]{2} \d{4})$"
THREADS_DATE = r"(?iu)^(?:\d{2}/\d{2}/(?:\d{2}|\d{4})|\d+[smhdw]|\d+\s*(?:sec|min|second|minute|hour|day|week)s?|\d+\s*(?:giay|giây|phut|phút|gio|giờ|ngay|ngày|tuan|tuần))$"


def lines_of(text: Column) -> Column:
    """Trimmed lines that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]"), lambda x: F.trim(x)), lambda x: x != "")


COMMENT = "external_id string, author string, {time} string, text string"


def instagram_comments(body: Column, url: Column) -> Column:
    """Array of comments (external_id, author, created_at_label, text, url) of a post page's text.

    A comment is a name, a time and lines of text up to the next one, a footer or a date; the first block is the
    caption. Of comments with equal name, time and beginning the first stays. Null and short texts give none.
    """

    @F.pandas_udf(f"array<struct<{COMMENT.format(time='created_at_label')}, url string>>")
    def found(bodies: pd.Series, urls: pd.Series) -> pd.Series:
        def comments(text, link):
            first = {}
            for author, label, told in scans.blocks(scans.lines_of(text), NAME, [AGO, DATE], INSTAGRAM_SKIP, INSTAGRAM_FOOTER)[1:]:
                key = "comment:" + re.sub(r"[^a-z0-9._|:-]+", "-", f"{author}|{label}|{told[:80]}".strip().lower())
                first.setdefault(key, (author, label, told))
            return [{"external_id": key, "author": a, "created_at_label": t, "text": x, "url": None if link is None else f"{link}#comment-{k}"} for k, (key, (a, t, x)) in enumerate(first.items(), 1)]

        return pd.Series([comments(text, link) for text, link in zip(bodies, urls, strict=True)], index=bodies.index, dtype=object)

    return found(body, url)


def threads_comments(body: Column, post_id: Column) -> Column:
    """Array of comments (external_id, author, created_at, text) below the marker of a thread page's text.

    A comment is a name, at most one line that the site did not add, a time, and lines of text up to the next one; counts alone are no text.
    Pages without a marker are read from their fifth line on.
    """

    @F.pandas_udf(f"array<struct<{COMMENT.format(time='created_at')}>>")
    def found(bodies: pd.Series, ids: pd.Series) -> pd.Series:
        def comments(text, of):
            told = scans.threads(scans.lines_of(text), frozenset(THREADS_NOISE), frozenset(THREADS_TOP), THREADS_DATE)
            return [{"external_id": ":".join(p for p in ("comment", of, str(k)) if p is not None), "author": a, "created_at": t, "text": x} for k, (a, t, x) in enumerate(told, 1)]

        return pd.Series([comments(text, of) for text, of in zip(bodies, ids, strict=True)], index=bodies.index, dtype=object)

    return found(body, post_id)


THREAD = "created_at string, post_text string, comments array<struct<external_id string, author string, created_at string, text string>>"
# Menus of the site.
THREADS_CHROME = r"(?i)messages\s+activity\s+profile|insights\s+saved\s+feeds|ghost\s+posts|edit\s+following|view\s+activity|new\s+thread|for\s+you"
SHORTEST_PAGE = 5


def thread_page(body: Column, html: Column, page: Column, post_id: Column) -> Column:
    """Struct (created_at, post_text, comments) of a thread's page; null for pages of fewer than five lines, or of menus alone.

    The post is the owner's block where the page has one; its time a written date of the source or text, else the block's own label.
    A label that is relative alone is no publish time and is empty.
    """

    @F.pandas_udf(THREAD)
    def found(bodies: pd.Series, sources: pd.Series, pages: pd.Series, ids: pd.Series) -> pd.DataFrame:
        date, chrome = re.compile(THREADS_DATE), re.compile(THREADS_CHROME)
        rows = []
        for text, source, owner, of in zip(bodies, sources, pages, ids, strict=True):
            page = scans.ThreadPage(text, frozenset(THREADS_NOISE), frozenset(THREADS_TOP), frozenset(THREADS_ACTIVITY), date, chrome)
            label, told, comments = page.read(owner or "") if len(page.lines) >= SHORTEST_PAGE else ("", "", [])
            if not comments and page.is_chrome(told):
                rows.append((None, None, None))
                continue
            label = page.written_date(source or "") or label or page.label()
            if re.fullmatch(r"(?i)\d+\s*[smhdw]", label):
                label = ""
            rows.append((label, told, [{"external_id": f"comment:{of}:{k}", "author": a, "created_at": t, "text": x} for k, (a, t, x) in enumerate(comments, 1)]))
        return pd.DataFrame(rows, columns=["created_at", "post_text", "comments"], dtype=object)

    return found(body, html, page, post_id)


def date_label(body: Column) -> Column:
    """The date of a thread page's text: a slashed one, a line of its own before others, else a short relative one; null if none."""
    lines = F.slice(lines_of(body), 1, 40)
    own = F.get(F.filter(lines, lambda x: x.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}$")), F.lit(0))
    short = F.get(F.filter(lines, lambda x: x.rlike(r"(?i)^\d+[smhdw]$")), F.lit(0))
    part = lambda p: F.nullif(F.regexp_extract(F.coalesce(body, F.lit("")), p, 1), F.lit(""))
    return F.coalesce(own, part(r"\b(\d{1,2}/\d{1,2}/\d{2,4})\b"), short, part(r"(?i)\b(\d+[smhdw])\b"))


def counts_near(html: Column, mark: Column, keys: dict[str, str], before: int = 0, after: int = 2500) -> Column:
    """Struct of the first counts by name that stand near a mark of a page's source: a window of characters around each place of the mark."""
    pieces = F.split(html, F.concat(F.lit("\\Q"), mark, F.lit("\\E")))
    windows = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p, k: F.concat(F.when(F.lit(before > 0), F.substring(F.get(pieces, k), -before, before)).otherwise(""), F.substring(p, 1, after)))
    first = lambda key: F.get(F.filter(F.transform(windows, lambda w: F.nullif(F.regexp_extract(w, rf'"{key}"\s*:\s*"?(\d+)', 1), F.lit("")).try_cast("long")), lambda n: n.isNotNull()), F.lit(0))
    return F.struct(*[first(key).alias(name) for name, key in keys.items()])


def views_of(body: Column) -> Column:
    """"1.2K views", "3 lượt xem": the count."""
    return compact_count(F.nullif(F.regexp_extract(F.coalesce(body, F.lit("")), r"(?iu)([\d.,]+\s*[KMB]?)\s*(?:views|lượt xem)", 1), F.lit("")))


def balanced_json(source: Column, marker: str) -> Column:
    """The JSON object that follows a marker in a page's source, up to its closing brace; braces within texts do not count. Null if it never closes."""

    @F.pandas_udf("string")
    def found(sources: pd.Series) -> pd.Series:
        return sources.map(lambda text: scans.balanced(text, marker))

    return found(source)
