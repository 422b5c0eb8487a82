"""Reports: how tags changed by a rebuild, what a crawl found by keyword, dates of films from news."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.text import snippet
from buzzmill.operators.classify import rebuild_category
from buzzmill.operators.tables import first_rows


def brand_changes(rows: DataFrame, before: Column, after: Column) -> DataFrame:
    """By brand: mentions that gain it, lose it or keep it."""
    added, removed, kept = F.array_except(after, before), F.array_except(before, after), F.array_intersect(after, before)
    tell = lambda a, what: F.transform(a, lambda b: F.struct(b.alias("brand"), F.lit(what).alias("what")))
    each = rows.select(F.explode(F.concat(tell(added, "added"), tell(removed, "removed"), tell(kept, "unchanged"))).alias("x")).select("x.*")
    return each.groupBy("brand").agg(*[F.count_if(F.col("what") == w).alias(w) for w in ("added", "removed", "unchanged")])


def change_examples(rows: DataFrame, before: Column, after: Column, key: str, text: str, samples: int = 50) -> DataFrame:
    """By category of change: mentions, the first one's text as a snippet, and the keys of the first `samples`.

    Each task keeps the first keys of a category alone before the shuffle, so a category's rows are never together.
    """
    told = rows.select(rebuild_category(before, after).alias("category"), F.col(key).alias("_key"), snippet(F.col(text)).alias("text"))
    first = told.groupBy("category").agg(F.count("*").alias("mentions"), F.min_by("text", "_key").alias("example"))
    few = first_rows(told.where("_key is not null").select("category", "_key"), ["category"], ["_key"], samples)
    keys = few.groupBy("category").agg(F.array_sort(F.collect_list("_key")).alias("samples"))
    return first.join(keys, first["category"].eqNullSafe(keys["category"]), "left").select(first["category"], "mentions", "example", F.coalesce("samples", F.array().cast(keys.schema["samples"].dataType)).alias("samples"))


def replacements(rows: DataFrame, before: Column, after: Column) -> DataFrame:
    """How often each brand gave way to each other one in the same mention."""
    pairs = F.flatten(F.transform(F.array_except(before, after), lambda b: F.transform(F.array_except(after, before), lambda a: F.struct(b.alias("old"), a.alias("new")))))
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.old", "p.new").agg(F.count("*").alias("mentions"))


def keyword_stats(log: DataFrame) -> DataFrame:
    """By keyword of a crawl log (keyword, seen_before, state, detail, comments): discovered, new, already_seen, stale, details that went well or failed, comments."""
    return log.groupBy("keyword").agg(
        F.count("*").alias("discovered"),
        F.count_if(~F.col("seen_before")).alias("new"),
        F.count_if("seen_before").alias("already_seen"),
        F.count_if(F.col("state") == "stale").alias("stale"),
        F.count_if(F.col("detail") == "ok").alias("detail_ok"),
        F.count_if(F.col("detail") == "failed").alias("detail_failed"),
        F.coalesce(F.sum("comments"), F.lit(0)).alias("comments"),
    )


def film_dates(news: DataFrame) -> DataFrame:
    """By film of news (film, pos, kind, published, dates): the first day of a trailer's news, and the commonest date in premiere news, ties to the first seen."""
    trailer = news.groupBy("film").agg(F.min(F.when(F.col("kind") == "trailer", F.to_date("published"))).alias("trailer_date"))
    each = news.where("kind = 'premiere'").select("film", "pos", F.posexplode("dates").alias("at", "day"))
    counted = each.groupBy("film", "day").agg(F.count("*").alias("n"), F.min(F.struct("pos", "at")).alias("first"))
    best = counted.groupBy("film").agg(F.max_by("day", F.struct("n", (-F.col("first.pos")).alias("p"), (-F.col("first.at")).alias("a"))).alias("release_date"))
    return trailer.join(best, "film", "left")


def annotated(rows: DataFrame, state: Column, rank: Column, limit: int) -> DataFrame:
    """rows with freshness, in_final_limit, stale and coverage: stale rows and those beyond the limit get no comments, unknown ones stay eligible."""
    out = rows.withColumn("freshness", state).withColumn("in_final_limit", rank <= limit).withColumn("stale", F.col("freshness") == "stale")
    return out.withColumn("coverage", F.col("in_final_limit") & ~F.col("stale")).withColumn("spends_on_comments", F.col("coverage"))


def grouped_values(rows: DataFrame, key: str, value: str, where: Column) -> DataFrame:
    """By key the sorted distinct values for which the condition holds; an empty array where it never does."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(F.when(where, F.col(value)))).alias(f"{value}s"))


def limits(env: dict[str, str], discovery: int = 300, final: int = 100, comments: int = 200) -> dict[str, int]:
    """Candidates found, kept, and comments an item, from variables of the environment; never more kept than found."""
    number = lambda name, other: int(env[name]) if str(env.get(name, "")).strip().isdigit() else other
    found = number("CRAWL_DISCOVERY_LIMIT", discovery)
    return {"discovery": found, "final": min(number("CRAWL_FINAL_LIMIT", final), found), "comments": number("CRAWL_COMMENT_LIMIT", comments)}


def capped(rows: DataFrame, key: str, order: Sequence[str | Column], found: int, kept: int) -> DataFrame:
    """The first `found` rows of each key with in_final for the first `kept`."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= found).withColumn("in_final", F.col("rank") <= min(kept, found))
