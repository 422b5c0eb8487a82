"""Times and numbers from labels, as Spark expressions; the reference time is always given, never the clock's.

Results are local clock times without a zone where the label names none. Labels that tell no time give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from buzzmill.functions.text import let

ZONE = "Asia/Ho_Chi_Minh"
# Date formats in the order in which they are tried, of labels in general, within longer texts, of media, of stores.
FORMATS = ("M/d/yy", "M/d/yyyy", "d/M/yyyy", "d/M/yy", "yyyy-MM-dd", "MMM d, yyyy", "d MMM yyyy")
SLASHED = FORMATS[:4]
MEDIA_FORMATS = ("MMM d, yyyy", "d MMM yyyy", "MMMM d, yyyy", "d MMMM yyyy", "yyyy-MM-dd", "d/M/yyyy", "M/d/yyyy")
# Seconds of units, in the order in which they are tried; months and years are 30 and 365 days.
DAY = 86400
AGO = (
    *((rf"{unit}\s+trước", n) for unit, n in (("năm", 365 * DAY), ("tháng", 30 * DAY), ("tuần", 7 * DAY), ("ngày", DAY), ("giờ", 3600), ("phút", 60), ("giây", 1))),
    *((rf"{unit}s?\s*ago", n) for unit, n in (("year", 365 * DAY), ("month", 30 * DAY), ("week", 7 * DAY), ("day", DAY), ("hour", 3600), ("minute", 60), ("second", 1))),
    *((rf"{unit}\b", n) for unit, n in (("w", 7 * DAY), ("d", DAY), ("h", 3600), ("m", 60), ("s", 1))),
)
EDITED = r"^(?:thời gian chỉnh sửa|edited(?:\s+on)?|chỉnh sửa)\s*:?\s*"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = r"jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
SLASH_DATE = r"\b(\d{1,2}/\d{1,2}/\d{2,4})\b"


def _part(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def business_day(at: Column) -> Column:
    """The day in Vietnam of an instant given in UTC."""
    return F.to_date(F.from_utc_timestamp(at, ZONE))


def iso_time(label: Column) -> Column:
    """An ISO date with or without a time of day; an offset is dropped, not applied."""
    shape = r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?)(?:Z|[+-]\d{2}:?\d{2})?$"
    return _part(F.trim(label), shape).try_cast("timestamp")


def in_formats(label: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    return F.coalesce(*[F.try_to_timestamp(label, F.lit(f)) for f in formats])


def relative(label: Column, now: Column) -> Column:
    """now less "3 giờ trước", "Edited 2 days ago", "13h" and the like, anywhere in the label; larger units are tried first."""
    low = F.regexp_replace(F.regexp_replace(F.trim(F.lower(label)), r"(?U)\s+", " "), f"(?iuU){EDITED}", "")
    low = F.regexp_replace(low, r"(?U)\b(?:một|mot|an|a)\b", "1")
    seconds = let(low, lambda x: F.coalesce(*[_part(x, rf"(?U)([0-9]+)\s*{unit}").try_cast("long") * n for unit, n in AGO]))
    return F.timestamp_seconds(F.unix_timestamp(now) - seconds)


def is_relative_only(label: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.trim(label), r"(?U)\s", "").rlike(r"(?i)^\d+[smhdw]$"), F.lit(False))


def dated_label(label: Column, now: Column) -> Column:
    """"19 tháng 7 lúc 10:10", "July 19, 2025 at 10:10 PM": without a year the latest that is at most two hours after now."""
    flat, local = F.trim(F.regexp_replace(label, r"(?U)\s+", " ")), F.from_utc_timestamp(now, ZONE)
    return let(flat, lambda text: _dated(text, local))


def _dated(text: Column, local: Column) -> Column:
    def at(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
        of = lambda x, y: F.try_make_timestamp(y, x["m"], x["d"], F.coalesce(x["h"], F.lit(0)), F.coalesce(x["i"], F.lit(0)), F.lit(0))
        no_year = lambda x: let(of(x, F.year(local)), lambda this: F.when(this > local + F.expr("INTERVAL 2 HOURS"), of(x, F.year(local) - 1)).otherwise(this))
        parts = F.struct(year.alias("y"), month.alias("m"), day.alias("d"), hour.alias("h"), minute.alias("i"))
        return let(parts, lambda x: F.when(x["y"].isNotNull(), of(x, x["y"])).otherwise(no_year(x)))

    number = lambda pattern, group: _part(text, pattern, group).try_cast("int")
    home = r"(?iuU)(\d{1,2})\s*(?:tháng|thg)\s*(\d{1,2})(?:\s*,?\s*(\d{4}))?(?:\s+lúc\s+(\d{1,2}):(\d{2}))?"
    english = rf"(?iuU)({_MONTH})\s+(\d{{1,2}})(?:,?\s+(\d{{4}}))?(?:\s+at\s+(\d{{1,2}}):(\d{{2}})\s*(AM|PM)?)?"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(_part(text, english, 1), 1, 3))).cast("int")
    hour, half = number(english, 4), F.upper(_part(text, english, 6))
    hour = F.when((half == "PM") & (hour < 12), hour + 12).when((half == "AM") & (hour == 12), F.lit(0)).otherwise(hour)
    return F.coalesce(
        at(number(home, 3), number(home, 2), number(home, 1), number(home, 4), number(home, 5)),
        F.when(month > 0, at(number(english, 3), month, number(english, 2), hour, number(english, 5))),
    )


def media_date(label: Column, now: Column) -> Column:
    """Relative and dated labels, in local time, then MEDIA_FORMATS."""
    flat = F.trim(F.regexp_replace(label, r"(?U)\s+", " "))
    return let(flat, lambda text: F.coalesce(F.from_utc_timestamp(relative(text, now), ZONE), dated_label(text, now), in_formats(text, MEDIA_FORMATS)))


def parse_time(label: Column, now: Column) -> Column:
    """ISO, FORMATS in order, a slashed date within the label, relative, then dated labels; null if none fits."""
    return let(F.trim(label), lambda text: F.coalesce(iso_time(text), in_formats(text), in_formats(_part(text, SLASH_DATE), SLASHED), relative(text, now), dated_label(text, now)))


def occurred_at(labels: list[Column], body: Column, now: Column) -> Column:
    """Struct of the time and its source for a post: parsed, relative_unverified, or crawl_fallback where no time is known.

    labels are tried in order, those that are relative alone last; then a slashed date in the body, then a relative one.
    """
    first = F.trim(F.coalesce(*[F.nullif(c, F.lit("")) for c in labels]))
    told = F.struct(first.alias("first"), F.coalesce(*[F.when(~is_relative_only(c), parse_time(c, now)) for c in labels]).alias("at"))
    return let(told, lambda x: _with_source(x["first"], x["at"], body, now))


def _with_source(first: Column, labelled: Column, body: Column, now: Column) -> Column:
    slashed = F.when(first.rlike(r"\d{1,2}/\d{1,2}/\d{2,4}"), parse_time(first, now))
    crumb = _part(body, r"(?iuU)\b(\d+\s*[smhdw])\b|\b\d+\s*(?:giờ|phút|ngày|tuần)\s*trước\b", 0)
    found = F.coalesce(labelled, in_formats(_part(body, SLASH_DATE), SLASHED), parse_time(crumb, now))
    source = lambda at: F.when(at.isNull(), "crawl_fallback").when(is_relative_only(first), "relative_unverified").otherwise("parsed")
    other = let(found, lambda at: F.struct(at.alias("at"), source(at).alias("date_source")))
    return let(slashed, lambda at: F.when(at.isNotNull(), F.struct(at.alias("at"), F.lit("parsed").alias("date_source"))).otherwise(other))


def comment_occurred_at(label: Column, post_label: Column, body: Column, now: Column) -> Column:
    """Struct of the time and its source for a comment: its own label, else the post's (post_inferred), else what its body tells."""
    told = F.array(parse_time(label, now), parse_time(post_label, now), occurred_at([label], body, now)["at"])
    first = lambda x: F.get(F.filter(x, lambda t: t.isNotNull()), F.lit(0))
    source = lambda x: F.when(x[0].isNotNull(), "parsed").when(x[1].isNotNull(), "post_inferred").when(x[2].isNotNull(), "parsed").otherwise("crawl_fallback")
    return let(told, lambda x: F.struct(first(x).alias("at"), source(x).alias("date_source")))


def not_crawl_clock(at: Column, crawled: Column, seconds: int = 2) -> Column:
    """Null for times that are the crawler's own clock."""
    return F.when(F.coalesce(F.abs(F.unix_timestamp(at) - F.unix_timestamp(crawled)) > seconds, F.lit(True)), at)


# Short labels of a site's comments, in seconds; written dates of two others; how near the crawl's clock a time is no post's.
SHORT_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800, "mo": 2592000, "y": 31536000}
COMMENT_FORMATS = ("yyyy-MM-dd", "MMM d, yyyy", "d MMM yyyy")
CRAWL_WINDOW = 900


def comment_time(platform: Column, value: Column, label: Column, crawled: Column, posted: Column) -> Column:
    """When a comment was written: its value unless that is the crawl's own clock, else its label before the crawl, or before the post's time where that is unknown.

    tiktok has numbers and labels such as "3d" or "2 mo ago" alone; other platforms have written dates, and labels of any kind. Null where neither tells.
    """
    text, short = F.trim(F.coalesce(value, F.lit(""))), platform == "tiktok"
    written = F.when(~short, F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in COMMENT_FORMATS]))
    stated = F.coalesce(text.try_cast("timestamp"), F.when(short, content_time(text)), written)
    stated = F.when(text.rlike(r"^\d+$") & ~short, F.lit(None)).otherwise(stated)
    told, since = F.trim(F.coalesce(label, F.lit(""))), F.coalesce(crawled, posted)
    bare = F.regexp_replace(F.regexp_replace(F.lower(told), r"\s", ""), "ago$", "")
    seconds = F.element_at(F.create_map(*[F.lit(x) for kv in SHORT_UNITS.items() for x in kv]), F.regexp_extract(bare, r"^\d+(s|m|h|d|w|mo|y)$", 1))
    brief = F.timestamp_seconds(F.unix_timestamp(since) - F.regexp_extract(bare, r"^(\d+)", 1).try_cast("long") * seconds)
    longer = F.coalesce(media_date(told, since), relative(told, since))
    return F.coalesce(not_crawl_clock(stated, crawled), F.when((told != "") & since.isNotNull(), F.when(short, F.when(bare.rlike(r"^\d+(?:s|m|h|d|w|mo|y)$"), brief)).otherwise(longer)))


def published_choice(labels: list[Column], crawled: Column) -> Column:
    """Struct (at, label) of a post's time: the first label that can be read and is not the crawl's own time.

    A time within 900 s of the crawl counts only if its label has a year. Without any, at is null and label the first that is not blank.
    """
    def read(label: Column) -> Column:
        return F.coalesce(label.try_cast("timestamp"), F.to_utc_timestamp(dated_label(label, crawled), ZONE), relative(label, crawled))

    def kept(label: Column) -> Column:
        near = F.abs(F.unix_timestamp(read(label)) - F.unix_timestamp(crawled)) <= CRAWL_WINDOW
        good = read(label).isNotNull() & (~near | label.rlike(r"\b(?:19|20)\d{2}\b"))
        return F.when(good, F.struct(read(label).alias("at"), label.alias("label")))

    trimmed = [F.nullif(F.trim(c), F.lit("")) for c in labels]
    none = F.struct(F.lit(None).cast("timestamp").alias("at"), F.coalesce(*trimmed, F.lit("")).alias("label"))
    return F.coalesce(*[kept(c) for c in trimmed], none)


# How news write dates, each kind with the order of day, month and year.
NEWS_DATES = (
    (r"\b\d{1,2}[/.-]\d{1,2}[/.-]20\d{2}\b", (0, 1, 2)),
    (r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept|Sep|Oct|Nov|Dec)\.?\s+\d{1,2},?\s+20\d{2}\b", (1, 0, 2)),
    (r"\b\d{1,2}\s+th[aá]ng\s+\d{1,2},?\s+20\d{2}\b", (0, 1, 2)),
)


def dates_in(text: Column, first_year: int, last_year: int) -> Column:
    """Valid dates of a text, of the years given, repeats kept: first those written d/m/yyyy, then "July 24, 2026", then "24 tháng 7 2026"."""

    def dates(pattern: str, order: tuple[int, int, int]) -> Column:
        def date(x: Column) -> Column:
            parts = F.regexp_extract_all(x, F.lit(r"\p{L}+|\d+"), F.lit(0))
            parts = F.filter(parts, lambda p: ~F.lower(p).isin("tháng", "thang"))
            at = [F.get(parts, F.lit(k)) for k in order]
            named = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(F.get(parts, F.lit(0)), 1, 3)))
            month = named.cast("string") if order[0] == 1 else at[1]
            return F.concat_ws("-", at[2], F.lpad(month, 2, "0"), F.lpad(at[0], 2, "0")).try_cast("date")

        found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?iuU){pattern}"), F.lit(0))
        return F.filter(F.transform(found, date), lambda d: d.isNotNull() & F.year(d).between(first_year, last_year))

    return F.concat(*[dates(p, o) for p, o in NEWS_DATES])


# Kinds of a film's milestones in order.
MILESTONES = ("announcement", "trailer", "press_sneak", "premiere", "w1_decay")


def milestones(release: Column, trailer: Column, press: Column) -> Column:
    """Array of struct(kind, day, sort_order): the trailer is 45 days before the release unless known, the announcement 14
    days before it, the press show the day before, the decay 5 days after; null without a release."""
    opening = F.to_date(release)
    shown = F.coalesce(F.to_date(trailer), F.date_add(opening, -45))
    days = (F.date_add(shown, -14), shown, F.coalesce(F.to_date(press), F.date_add(opening, -1)), opening, F.date_add(opening, 5))
    rows = [F.struct(F.lit(kind).alias("kind"), day.alias("day"), F.lit(k + 1).alias("sort_order")) for k, (kind, day) in enumerate(zip(MILESTONES, days, strict=True))]
    return F.when(opening.isNotNull(), F.array(*rows))


def duration(seconds: Column) -> Column:
    """"45s", "3m 5s", "2h 1m"; null for null and negatives."""
    s = F.floor(seconds)
    return F.when(s < 0, None).when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh %dm", F.floor(s / 3600), F.floor(s / 60) % 60))


def content_time(value: Column) -> Column:
    """Seconds, milliseconds (above 10**12), or ISO text, as an instant; null if none, or 0."""
    n = F.when(value.rlike(r"^\d{9,13}$"), value.try_cast("long"))
    return F.when(n == 0, None).when(n > 10**12, F.timestamp_millis(n)).when(n.isNotNull(), F.timestamp_seconds(n)).otherwise(F.when(~value.rlike(r"^\d+$"), value.try_cast("timestamp")))


# Keys of creation times in pages, numbers first, and keys of written times.
CREATED_KEYS, CREATED_TEXTS = ("createTime", "create_time", "taken_at_timestamp", "taken_at", "published_time"), ("datePublished", "uploadDate")


def created_in_html(html: Column) -> Column:
    """The creation time that a page states: the first of each key is read, and the first key with a readable one counts."""
    patterns = [rf'"{k}"\s*:\s*"?(\d{{9,13}})"?' for k in CREATED_KEYS] + [rf'"{k}"\s*:\s*"([^"]+)"' for k in CREATED_TEXTS]
    return F.coalesce(*[content_time(_part(html, p)) for p in patterns])


def earliest_in_html(html: Column, key: str, least: int = 1262304000) -> Column:
    """The earliest plausible unix time of a key, of all that a page states."""
    found = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(rf'"{key}"\s*:\s*"?(\d{{9,10}})\b'), F.lit(1)), lambda x: x.try_cast("long"))
    return F.timestamp_seconds(F.array_min(F.filter(found, lambda x: x >= least)))


def compact_count(text: Column) -> Column:
    """"1.2K", "1,367", "1.229.143", "1,5", "10.7K likes": a whole number, halves to even; null for negatives and text without a leading number."""
    pattern = r"(?U)^\s*([0-9.,]+)\s*([KkMmBb])?\b"
    parts = F.struct(F.regexp_extract(text, pattern, 1).alias("raw"), F.upper(F.regexp_extract(text, pattern, 2)).alias("suffix"))
    factor = lambda s: F.when(s == "K", 1e3).when(s == "M", 1e6).when(s == "B", 1e9).otherwise(1.0)
    return let(parts, lambda p: F.bround(_number(p["raw"]) * factor(p["suffix"])).cast("long"))


def _number(raw: Column) -> Column:
    """A number whose points and commas part thousands or, standing alone, decimals; a comma before three digits parts thousands."""
    dots, commas = F.regexp_count(raw, F.lit(r"\.")), F.regexp_count(raw, F.lit(","))
    no_comma, no_dot = F.regexp_replace(raw, ",", ""), F.regexp_replace(raw, r"\.", "")
    decimal = lambda c: F.regexp_replace(c, ",", ".")
    number = (
        F.when(dots > 1, no_dot)
        .when(commas > 1, no_comma)
        .when((commas == 1) & (dots == 1), F.when(raw.rlike(r",.*\."), no_comma).otherwise(decimal(no_dot)))
        .when(commas == 1, F.when(raw.rlike(r",\d{3}$"), no_comma).otherwise(decimal(raw)))
        .otherwise(raw)
    )
    return F.coalesce(number.try_cast("double"), F.regexp_replace(raw, "[^0-9]", "").try_cast("double"))


def first_count(*values: Column, skip_zero: bool = False) -> Column:
    """The first known count; with skip_zero, the first that is not 0 either, else 0 or null as they come last."""
    return F.coalesce(*[F.nullif(v, F.lit(0)) for v in values[:-1]], values[-1]) if skip_zero else F.coalesce(*values)


def rating(text: Column) -> Column:
    """The first number of a label, with a decimal point or comma."""
    return _part(F.regexp_replace(text, ",", "."), r"(\d+(?:\.\d+)?)").try_cast("double")


def star_sentiment(stars: Column) -> Column:
    return F.when(stars >= 4, "positive").when(stars <= 2, "negative").when(stars.isNotNull(), "neutral")


def strict_int(text: Column) -> Column:
    """A whole number and nothing else; null otherwise."""
    return F.when(F.trim(text).rlike(r"^[+-]?\d+$"), F.trim(text).try_cast("long"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(100.0 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


