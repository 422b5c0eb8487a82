"""Importing crawled items: posts and comments become mentions with brands, sentiment, times and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.cleaning import place_author, place_review
from buzzmill.functions.records import record_id
from buzzmill.functions.times import comment_occurred_at, compact_count, occurred_at
from buzzmill.operators.classify import brands, market, sentiment


def _metadata(**values: Column) -> Column:
    """A map of the values that are known."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def post_mentions(items: DataFrame, now: Column) -> DataFrame:
    """Mentions of posts (platform, post_id, author_key, post_text, post_url, post_created_at, like_count ... as labels).

    Posts of place pages, of other markets, or without a brand are none. `verified` is false where the time is not to
    be trusted: such a mention refreshes a known one but makes no new one.
    """
    text, none = F.coalesce("post_text", F.lit("")), F.lit(None).cast("string")
    rows = items.where(F.col("platform") != "google").withColumn("brands", brands(text, F.col("post_url"), F.col("author_key")))
    rows = rows.where((F.size("brands") > 0) & (market(text, F.col("post_url"), F.col("author_key"), F.col("platform")) == "vietnam"))
    counts = {c: compact_count(F.col(c)) if c in items.columns else none for c in ("like_count", "comment_count", "view_count", "share_count")}
    rows = rows.withColumn("o", occurred_at([F.col("post_created_at")], text, now)).where("o.at is not null")
    meta = _metadata(date_source=F.col("o.date_source"), date_label=F.nullif(F.trim("post_created_at"), F.lit("")), **counts)
    filled = F.when(text == "", "(empty)").otherwise(text)
    return rows.select("platform", "post_id", "author_key", filled.alias("content_text"), sentiment(text).alias("sentiment"), F.col("o.at").alias("occurred_at"), F.col("post_url").alias("permalink"), meta.alias("metadata"), "brands", (F.col("o.date_source") == "parsed").alias("verified"))


def comment_mentions(comments: DataFrame, now: Column) -> DataFrame:
    """Mentions of comments (platform, post_id, external_id, author, text, created_at, url; of the post: post_created_at, post_text, page_name, post_url, search_keyword).

    Place reviews and their authors are cleaned. On threads, another's comment that repeats the post is a quote of it and goes. A
    comment's brands are those of its text, link (its own or the post's) and author; a place review without one takes those of the
    place's name, text, address and search term. Comments without a brand or of other markets are none, as are those without
    any time, but for place reviews, which get `now`. A missing external_id is made from the comment. rating is kept if there is one.
    """
    given = {"url", "external_id", "rating", "page_name", "post_url", "search_keyword"} - set(comments.columns)
    rows = comments.withColumns({c: F.lit(None).cast("string") for c in given})
    empty, at_all = F.lit(""), F.col("o.at").isNotNull()
    rows = rows.withColumn("o", comment_occurred_at(F.col("created_at"), F.col("post_created_at"), F.coalesce("text", empty), now))
    rows = rows.withColumn("link", F.coalesce(F.nullif(F.trim("url"), empty), F.nullif(F.trim("post_url"), empty)))
    is_place = F.col("platform") == "google"
    # cleaned twice, as a card may hold another card
    places = rows.where(is_place).withColumn("author", place_author(F.col("author"))).withColumn("t", place_review(F.col("text"))).withColumn("t", place_review(F.col("t")))
    name = lambda c: F.lower(F.ltrim(F.coalesce(c, empty), F.lit("@")))
    quoted = (F.col("platform") == "threads") & (name("page_name") != "") & (name("author") != "") & (name("page_name") != name("author")) & (F.trim("post_text") == F.trim("t"))
    others = rows.where(~F.coalesce(is_place, F.lit(False)) & at_all).withColumn("author", F.coalesce("author", empty)).withColumn("t", F.coalesce("text", empty)).where(~F.coalesce(quoted, F.lit(False)))
    both = places.unionByName(others).where(F.trim("t") != "").withColumn("brands", brands(F.col("t"), F.col("link"), F.col("author")))
    place = F.concat_ws(" ", *[F.coalesce(c, empty) for c in ("page_name", "post_text", "post_url", "search_keyword")])
    unnamed = both.where(is_place & (F.size("brands") == 0)).withColumn("brands", brands(place, F.col("post_url"), F.col("page_name")))
    found = both.where(F.size("brands") > 0).unionByName(unnamed.where(F.size("brands") > 0))
    found = found.where(market(F.col("t"), F.col("link"), F.col("author"), F.col("platform")) == "vietnam")
    made = record_id(F.struct("author", "created_at", "post_id", F.col("t").alias("text")))
    return found.select(
        "platform", "post_id", F.coalesce(F.nullif(F.trim("external_id"), empty), made).alias("external_id"), F.col("author").alias("author_key"), F.col("t").alias("content_text"),
        sentiment(F.col("t")).alias("sentiment"), F.coalesce("o.at", now).alias("occurred_at"), F.col("link").alias("permalink"), _metadata(date_source=F.col("o.date_source"), rating=F.col("rating")).alias("metadata"), "brands",
    )


def upsert_mentions(old: DataFrame, new: DataFrame, key: str = "post_id", seq: str = "seq") -> DataFrame:
    """old mentions after those of new, in the order of seq.

    Text is the last; sentiment, time and link the last that is known, times only where verified; metadata is merged
    key by key. New keys appear only if one of their rows is verified. Metadata are rows of their own until the last value of
    each of a mention's keys is known, so a post with any number of updates is combined before it is shuffled.
    """
    rows = old.select("*", F.lit(True).alias("verified"), F.lit(0).alias("_new")).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    at = F.struct("_new", seq)
    last = lambda c, known: F.max_by(c, F.when(known, at)).alias(c)
    keys = rows.groupBy(key).agg(
        F.max_by("content_text", at).alias("content_text"),
        last("sentiment", F.col("sentiment").isNotNull()),
        last("occurred_at", F.col("occurred_at").isNotNull() & F.col("verified")),
        last("permalink", F.col("permalink").isNotNull()),
        F.bool_or((F.col("_new") == 0) | F.col("verified")).alias("_known"),
    )
    entries = rows.select(F.col(key).alias("_key"), at.alias("_at"), F.explode("metadata").alias("name", "value"))
    values = entries.groupBy("_key", "name").agg(F.max_by(F.struct("value"), "_at").alias("v"))
    maps = values.groupBy("_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "v.value")))).alias("metadata"))
    merged = keys.where("_known").drop("_known").join(maps, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return merged.withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))
