"""What crawled texts, names and titles are rid of, and which of them are no text of people, as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from buzzmill.functions.text import fold, let
from buzzmill.functions.times import compact_count

#: White space, as one class for any engine.
SPACE = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# What a map's page shows around reviews, and how it labels times.
MAP_CHROME = r"drag to change|click to remove|messages\s+activity\s+profile"
MAP_AGO = r"(?:(?:\d+|a|an)\s*(?:second|minute|hour|day|week|month|year)s?\s*ago|(?:\d+|một)\s*(?:giây|phút|giờ|ngày|tuần|tháng|năm)\s*trước)\s*"
MAP_AUTHOR = r"^(?:local\s+guide\s*[·•]?\s*)?(?:\d[\d,]*\s+reviews?\s*[·•]?\s*)?(?:\d[\d,]*\s+photos?\s*)?"
MAP_NOTES = (r"\s*(?:translated by google|đã dịch bằng google)\s*", r"\s*(?:see original|xem bản gốc)\s*")
# Parts that the patterns above cannot do without.
MAP_CHROME_HINTS, MAP_AGO_HINTS, MAP_NOTE_HINTS = ("drag to change", "to remove", "prof"), ("ago", "trước"), (("google",), ("ee or", "xem b"))
MAP_ICONS = r"[\x{E000}-\x{F8FF}]"
SHORTEST_REVIEW, FEW_LETTERS, LONG_CHROME = 12, 12, 40
# Spam, buttons and page biographies in exports.
EXPORT_SPAM = r"membership\.makeviral|ets\.org|write a comment|see more see translation|[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{34F}\x{35F}]|r[\x{34F}\x{35F}]?[\s\x{34F}\x{35F}]?e[\x{34F}\x{35F}]?[\s\x{34F}\x{35F}]?o[\x{34F}\x{35F}]?[\s\x{34F}\x{35F}]?s"
EXPORT_BIOGRAPHY = r"^\s*.+\.\s*\d[\d,\.]+\s+likes\s*[·•]\s*[\d,\.]+\s+talking about this"
EXPORT_TAIL = r"\s*(?:see more|see translation|write a comment\.?\.?\.?)\s*$"
EXPORT_CLOCK = r"\s*0:\d{2}\s*/\s*\d+:\d{2}\s*"
EXPORT_BUTTONS = ("see translation", "pages you follow", "top fan")
SHORTEST_EXPORT = 8
# Words of buttons below a comment, and how its time is labelled.
COMMENT_BUTTONS = ("like", "reply", "share", "send", "edited", "thích", "trả lời", "chia sẻ", "đã chỉnh sửa")
COMMENT_TIME = r"^(?:\d+[hmdwy]|\d+\s+(?:minutes?|hours?|days?|weeks?))$"
# Words of a name that was searched for.
SEARCHED = ("review", "trailer", "xem", "ve", "phim")
CAPTION = r"^([\d.,]+)\s+likes?,\s*([\d.,]+)\s+comments?\s*-\s*[^:]+:\s*[\"']?(.*)$"
#: The largest whole number up to which a double holds each.
SAFE = (1 << 53) - 1


def compact(text: Column) -> Column:
    """Runs of white space as one space, trimmed; null is empty."""
    # single spaces stay as they are, and characters of ASCII words need one look
    space, other = f"[[^!-~]&&[{SPACE}]]", f"[[^ -~]&&[{SPACE}]]"
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"{other}{space}*| {space}+", " "))


def _without(text: Column, pattern: str, by: str = " ") -> Column:
    return F.regexp_replace(text, f"(?iu){pattern}", by)


def _holds(text: Column, hints: Sequence[str]) -> Column:
    """Whether one of the hints is in a text of any case: what a slower pattern needs. Hints have no i, k or s, whose cases differ by engine."""
    return let(F.lower(text), lambda t: reduce(lambda a, b: a | b, [t.contains(h) for h in hints]))


def _unless(text: Column, hints: Sequence[str], pattern: str, by: str = " ") -> Column:
    """_without, for texts that hold one of the hints."""
    return let(text, lambda t: F.when(_holds(t, hints), _without(t, pattern, by)).otherwise(t))


def _chrome(t: Column) -> Column:
    """place_chrome of a compact text."""
    few = (F.length(t) > LONG_CHROME) & ~t.rlike(rf"^(?:\P{{L}}*+\p{{L}}){{{FEW_LETTERS}}}")
    return (t == "") | few | (t.contains(" - Google Maps |") & t.contains("Search")) | (_holds(t, MAP_CHROME_HINTS) & t.rlike(f"(?iu){MAP_CHROME}"))


def place_chrome(text: Column) -> Column:
    """Whether a text of a map's page is the page's own: nothing, its buttons and menus, or hardly any letters in much text."""
    return let(compact(text), _chrome)


def place_title(title: Column) -> Column:
    """A place's name without the page's; empty where it is the page's own text."""
    return let(_without(compact(title), r"\s*-\s*google maps\s*$", ""), lambda t: F.when(place_chrome(t), F.lit("")).otherwise(F.trim(t)))


def place_author(author: Column) -> Column:
    """A reviewer's name without icons, rank and number of reviews."""
    return compact(_without(F.regexp_replace(compact(author), MAP_ICONS, ""), r"(?s)(?:local\s+guide|\d+\s+reviews?).*$", ""))


def place_review(text: Column) -> Column:
    """A place review alone: what follows the time of its card, up to the buttons below it, without notes of translation.

    Where too little follows the time, the rank and counts before the review go instead. Empty for the page's own texts and for
    reviews of fewer than 12 characters.
    """

    def body(t: Column) -> Column:
        after = F.when(_holds(t, MAP_AGO_HINTS), F.trim(F.regexp_extract(t, f"(?isu){MAP_AGO}(.*)$", 1))).otherwise(F.lit(""))
        own = let(after, lambda a: F.when(F.length(a) >= SHORTEST_REVIEW, a).otherwise(F.trim(_without(t, MAP_AUTHOR, ""))))
        return F.when(place_chrome(t), F.lit("")).otherwise(own)

    def cut(t: Column) -> Column:
        t = F.trim(_unless(t, ["more"], r"(?s)\s*(?:…\s*)?more.*$", ""))
        return let(t, lambda x: F.when(x.contains("Like") | x.contains(" Share"), F.regexp_replace(x, r"(?s)(?:Like| Share).*$", "")).otherwise(x))

    def bare(t: Column) -> Column:
        for note, hints in zip(MAP_NOTES, MAP_NOTE_HINTS, strict=True):
            t = _unless(t, hints, note)
        return compact(t)

    plain = let(compact(text), lambda t: F.when(t.rlike(MAP_ICONS), F.regexp_replace(t, MAP_ICONS, " ")).otherwise(t))
    kept = let(let(let(plain, body), cut), bare)
    return let(kept, lambda t: F.when((F.length(t) < SHORTEST_REVIEW) | _chrome(t), F.lit("")).otherwise(t))


def export_text(text: Column) -> Column:
    """A text as exports show it: the text of a record that was taken whole, without spam, the clock of a video, bullets before it and buttons after it."""

    def taken(t: Column) -> Column:
        inner = F.regexp_extract(t, r'"text"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
        return F.when(t.startswith('{"') & (inner != ""), F.coalesce(F.get_json_object(F.concat(F.lit('{"t":"'), inner, F.lit('"}')), "$.t"), inner)).otherwise(t)

    bare = _without(_without(let(F.trim(F.coalesce(text, F.lit(""))), taken), EXPORT_SPAM), EXPORT_CLOCK)
    return compact(_without(F.regexp_replace(bare, f"^[·•{SPACE}]+", ""), EXPORT_TAIL, ""))


def export_noise(text: Column, author: Column | None = None) -> Column:
    """Whether an export leaves a text out: fewer than 8 characters, spam in it or its author, a page's biography, no word, or a button."""
    text, author = F.coalesce(text, F.lit("")), F.lit("") if author is None else F.coalesce(author, F.lit(""))
    spam = text.rlike(f"(?iu){EXPORT_SPAM}") | author.rlike(f"(?iu){EXPORT_SPAM}")
    return (F.length(text) < SHORTEST_EXPORT) | spam | text.rlike(f"(?iu){EXPORT_BIOGRAPHY}") | text.rlike(rf"^[·•{SPACE},:;!?.\-0-9]+$") | F.lower(text).isin(*EXPORT_BUTTONS)


def export_author(name: Column, titles: Column) -> Column:
    """A name, trimmed; empty where it is a term that was searched for: a tag, one of a few words, or a film's title (folded terms)."""

    def told(blob: Column) -> Column:
        padded = F.concat(F.lit(" "), blob, F.lit(" "))
        word = lambda t: padded.contains(F.concat(F.lit(" "), t, F.lit(" "))) | padded.contains(F.concat(F.lit(" "), t, F.lit("#")))
        tag = lambda t: (F.ltrim(t, F.lit("#")) != "") & blob.contains(F.ltrim(t, F.lit("#")))
        holds = lambda t: F.when(t == "", False).when(t.startswith("#"), tag(t)).when(t.contains(" "), blob.contains(t)).otherwise(word(t))
        found = (blob == "") | blob.startswith("#") | F.exists(F.coalesce(titles, F.array().cast("array<string>")), holds)
        for w in SEARCHED:
            found = found | blob.contains(w)
        return F.when(found, F.lit("")).otherwise(F.trim(name))

    return let(fold(F.coalesce(name, F.lit(""))), told)


def is_comment_text(text: Column) -> Column:
    """Whether a line can be a comment: two characters or more, no button, no time alone."""
    return let(F.lower(compact(text)), lambda t: (F.length(t) >= 2) & ~t.isin(*COMMENT_BUTTONS) & ~t.rlike(COMMENT_TIME))


def safe_identifier(value: Column) -> Column:
    """An identifier as text: digits that a double holds exactly without leading zeros, others as they are, trimmed."""
    text = F.trim(F.coalesce(value, F.lit("")))
    digits = F.when(text.rlike(r"^\d+$"), F.coalesce(F.nullif(F.ltrim(text, F.lit("0")), F.lit("")), F.lit("0")))
    safe = F.when(F.length(digits) <= 16, digits).try_cast("long") <= SAFE
    return F.coalesce(F.when(safe, digits), text)


def engagement_prefix(caption: Column) -> Column:
    """Struct of a caption '1,234 likes, 56 comments - name on date: "text"': likes, comments, and the text without quotes and entities."""

    def told(t: Column) -> Column:
        hit = t.rlike(f"(?isu){CAPTION}")
        part = lambda k: F.when(hit, F.regexp_extract(t, f"(?isu){CAPTION}", k))
        text = F.trim(F.trim(F.trim(F.trim(part(3)), F.lit('"')), F.lit("'")))
        text = F.replace(F.replace(text, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
        return F.struct(compact_count(part(1)).alias("likes"), compact_count(part(2)).alias("comments"), F.coalesce(F.nullif(text, F.lit("")), t).alias("text"))

    return let(F.trim(F.coalesce(caption, F.lit(""))), told)
