"""Maps, identifiers, addresses and cleaned text of records, as Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from buzzmill.functions.text import canonical_url, let, strip_marks

# Host patterns of platforms.
PLATFORMS = {"facebook": r"facebook\.com|fb\.com|fb\.watch", "tiktok": r"tiktok\.com", "youtube": r"youtube\.com|youtu\.be", "instagram": r"instagram\.com", "threads": r"threads\.(?:net|com)", "google": r"google\.[a-z.]+/maps|goo\.gl/maps"}
# Ids within addresses.
POST_IDS = {"tiktok": r"/(?:video|photo)/(\d+)", "youtube": r"(?:[?&]v=|youtu\.be/|/shorts/|/embed/)([A-Za-z0-9_-]{6,})", "instagram": r"/(?:p|reel|tv)/([A-Za-z0-9_-]+)", "threads": r"/post/([A-Za-z0-9_-]+)", "facebook": r"(?:/posts/|/videos/|/reel/|story_fbid=|fbid=|/permalink/)([A-Za-z0-9]+)"}


def merge_maps(old: Column, new: Column) -> Column:
    """Both maps as one; keys of new win, null counts as empty. Needs no setting about repeated keys."""
    a, b = (F.coalesce(m, F.create_map().cast("map<string,string>")) for m in (old, new))
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def with_key(m: Column, key: str, value: Column) -> Column:
    """The map with one key set; as it is where it holds that value already."""
    known = F.try_element_at(m, F.lit(key))
    return F.when(known.eqNullSafe(value), m).otherwise(merge_maps(m, F.create_map(F.lit(key), value)))


def histogram(counts: Column) -> Column:
    """{"1": n, ... "5": n} of a list of five counts; empty for shorter lists and null."""
    keys = F.array(*[F.lit(str(k)) for k in range(1, 6)])
    return F.when(F.size(counts) >= 5, F.map_from_arrays(keys, F.transform(F.slice(counts, 1, 5), lambda c: F.coalesce(c.cast("int"), F.lit(0))))).otherwise(F.create_map().cast("map<string,int>"))


def script_json(html: Column, marker: str) -> Column:
    """The text of the script element with an id or type that the marker names, whole; null if there is none."""
    return F.nullif(F.trim(F.regexp_extract(html, rf"(?is)<script[^>]*\b{marker}[^>]*>(.*?)</script>", 1)), F.lit(""))


def hash_id(*parts: Column, n: int = 24) -> Column:
    """The first n digits of the SHA-1 of the parts joined by bars; null parts are empty."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]).cast("binary")), 1, n)


def record_id(record: Column, n: int = 20) -> Column:
    """The same for a struct, over its JSON with fields in the struct's order."""
    return F.substring(F.sha1(F.to_json(record).cast("binary")), 1, n)


def id_and_name(stem: Column) -> Column:
    """Struct of a file's stem: what stands before its first underscore, and after; without one, both are the stem."""
    parts = F.split(stem, "_", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("id"), F.coalesce(F.get(parts, F.lit(1)), stem).alias("name"))


def dashed_slug(text: Column, mark: str = "-") -> Column:
    """Lower-case letters and digits without accents, đ as d, others as one mark."""
    return F.regexp_replace(F.regexp_replace(strip_marks(text, True), "[^a-z0-9]+", mark), f"^{mark}+|{mark}+$", "")


def platform_of(url: Column, others: Mapping[str, str] = PLATFORMS) -> Column:
    out = F
    for name, pattern in others.items():
        out = out.when(url.rlike(f"(?i)^(?:[a-z]+://)?(?:[a-z0-9-]+\\.)*(?:{pattern})"), F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def post_id(url: Column) -> Column:
    """The id that a platform's address holds; null for others."""
    return let(platform_of(url), lambda p: F.coalesce(*[F.when(p == name, F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))) for name, pattern in POST_IDS.items()]))


def post_url(url: Column) -> Column:
    """The address without query, but for platforms whose id is in it."""
    video = F.regexp_extract(url, POST_IDS["youtube"], 1)
    return F.when((platform_of(url) == "youtube") & (video != ""), F.concat(F.lit("https://www.youtube.com/watch?v="), video)).otherwise(canonical_url(url))


def folder_slug(path: Column) -> Column:
    """The film's folder below processed/, but not the default one."""
    return F.nullif(F.nullif(F.regexp_extract(F.translate(path, "\\", "/"), r"/processed/([^/]+)/", 1), F.lit("")), F.lit("default_film"))


def unescaped(text: Column) -> Column:
    """Text whose \\n, \\" and \\uXXXX escapes are resolved as in JSON; as it is where that fails."""
    quoted = F.concat(F.lit('{"t":"'), F.regexp_replace(text, r'(?<!\\)"', r'\\"'), F.lit('"}'))
    return F.when(text.contains("\\"), F.coalesce(F.get_json_object(quoted, "$.t"), text)).otherwise(text)
