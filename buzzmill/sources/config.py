"""Configuration of terms: payloads from files or tables, terms by process, and merged lists."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fields of a payload that hold terms to search for, and terms that exclude.
SEARCH_FIELDS = ("keywords", "core_keywords", "sub_keywords", "branch_keywords", "listening_keywords", "boost_keywords", "hashtags")
EXCLUDE_FIELDS = ("exclude_keywords", "spam_keywords")
EVERY_PROCESS = ("*", "all")


def ordered_terms(terms: Iterable[str]) -> list[str]:
    """Terms in order, trimmed, each once whatever its case."""
    out: dict[str, str] = {}
    for t in terms:
        t = str(t or "").strip()
        if t:
            out.setdefault(t.casefold(), t)
    return list(out.values())


def is_enabled(term: str | Mapping, process: str | None = None) -> bool:
    """Plain terms always are; {value, enabled, processes} for the processes it names, all if it names none."""
    if isinstance(term, str):
        return bool(term.strip())
    if not term.get("enabled", True) or not str(term.get("value") or "").strip():
        return False
    named = [str(p).strip().casefold() for p in term.get("processes") or ()]
    return not named or process is None or process.casefold() in named or any(p in EVERY_PROCESS for p in named)


def terms_of(payload: Mapping, fields: Iterable[str] = SEARCH_FIELDS, process: str | None = None) -> list[str]:
    """Enabled terms of the fields for a process (the payload's active_process if none is given), in order, each once."""
    process = process or payload.get("active_process")
    found = (t for f in fields for t in payload.get(f) or () if is_enabled(t, process))
    return ordered_terms(t if isinstance(t, str) else t["value"] for t in found)


def load_payload(path: str | None = None, rows: DataFrame | None = None, source: str = "auto") -> dict:
    """A payload from an explicit file; else by source: db (rows of field, position, term), file, or auto (db if it has rows).

    Configuration is small by nature, so its rows are collected.
    """
    if path and source in ("file", "auto") and rows is None:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    found: dict[str, list[str]] = {}
    if rows is not None and source in ("db", "auto"):
        for r in rows.orderBy("field", "position").collect():
            found.setdefault(r["field"], []).append(r["term"])
    if found or source == "db":
        return {f: ordered_terms(t) for f, t in found.items()}
    return json.loads(Path(path).read_text(encoding="utf-8")) if path else {}


def merged_terms(brands: DataFrame) -> DataFrame:
    """Rows (list, position, term) from brands (brand_slug, is_primary, field, position, term).

    Campaign hashtags are listening terms too; keywords of brands that are not primary are competitor terms too. Each
    list has each term once, whatever its case, at its first place.
    """
    lists = F.array_compact(F.array(F.col("field"), F.when(F.col("field") == "campaign_hashtags", "listening_keywords"), F.when((F.col("field") == "keywords") & ~F.col("is_primary"), "competitor_keywords")))
    rows = brands.select(F.explode(lists).alias("list"), F.struct("brand_slug", "position").alias("at"), F.trim("term").alias("term")).where("term <> ''")
    first = rows.groupBy("list", F.lower("term").alias("k")).agg(F.min(F.struct("at", "term")).alias("f"))
    ordered = first.groupBy("list").agg(F.array_sort(F.collect_list("f")).alias("terms"))
    return ordered.select("list", F.posexplode("terms").alias("position", "f")).select("list", "position", F.col("f.term").alias("term"))


def latest_film_payload(films: DataFrame, queries: DataFrame) -> DataFrame:
    """films (slug, keywords) with the keywords of each one's newest query (slug, updated_at, keywords) added; films without stay."""
    newest = queries.groupBy("slug").agg(F.max_by("keywords", F.struct(F.col("updated_at").isNotNull(), "updated_at")).alias("_more"), F.max("updated_at").alias("updated_at"))
    none = F.array().cast("array<string>")
    return films.join(newest, "slug", "left").select("slug", F.array_union(F.coalesce("keywords", none), F.coalesce("_more", none)).alias("keywords"), "updated_at")
