"""Filters of grouped records: by terms, by film, by place, by optional conditions; comments flattened with their replies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.text import collapse
from buzzmill.functions.times import compact_count, first_count
from buzzmill.operators.classify import Film, brands, film_relevant


def hits(text: Column, terms: Sequence[str]) -> Column:
    """The terms that are in a text, whatever the case and the spaces between words, in the order of the terms."""
    flat = collapse(F.coalesce(text, F.lit("")))
    known = [t for t in dict.fromkeys(" ".join(t.lower().split()) for t in terms) if t]
    return F.array_compact(F.array(*[F.when(flat.contains(t), F.lit(t)) for t in known])) if known else F.array().cast("array<string>")


def filtered(rows: DataFrame, key: str, is_post: Column, terms: Sequence[str], exclude: Sequence[str] = (), film: Film | None = None, blank_posts: bool = False) -> DataFrame:
    """Posts and comments as rows (text): those of records of which the post or a comment matches, with `matches`.

    A record whose post has an excluded term goes, and so does a comment that has one. With a film, comments must be
    about it, and so must posts; a post that is not keeps its matches unless blank_posts, but does not count.
    """
    text = F.coalesce("text", F.lit(""))
    found = rows.withColumn("is_post", is_post).withColumn("matches", hits(text, terms)).withColumn("_out", F.size(hits(text, exclude)) > 0)
    about = film_relevant(text, film) if film else F.lit(True)
    found = found.withColumn("_counts", (F.size("matches") > 0) & about & ~F.col("_out"))
    found = found.withColumn("matches", F.when(F.col("is_post") & F.lit(blank_posts) & ~F.col("_counts"), F.array().cast("array<string>")).otherwise(F.col("matches")))
    record = found.groupBy(key).agg(F.bool_or(F.col("is_post") & F.col("_out")).alias("_gone"), F.bool_or("_counts").alias("_kept")).where("_kept and not _gone").select(key)
    return found.where(F.col("is_post") | (~F.col("_out") & (F.lit(film is None) | F.col("_counts")))).join(record, key, "left_semi").drop("_out", "_counts")


def place_matches(text: Column, place: Column, terms: Sequence[str]) -> Column:
    """Whether a review counts: its text has a term that is no hashtag, or the place is one of a brand."""
    return (F.size(hits(text, [t for t in terms if not t.startswith("#")])) > 0) | (F.size(brands(place)) > 0)


def flat_comments(posts: DataFrame) -> DataFrame:
    """Comments of raw posts (id, permalink_url, comments with replies two levels deep) as rows with parent, address and likes.

    Likes are the first known of like_count and reaction_count.
    """
    reply = lambda c, parent: F.struct(c["id"].alias("external_id"), c["message"].alias("text"), c["created_time"].alias("created_at"), parent.alias("parent_comment_id"), first_count(compact_count(c["like_count"]), compact_count(c["reaction_count"])).alias("likes"))
    none = F.lit(None).cast("string")
    each = F.flatten(F.transform("comments", lambda c: F.concat(F.array(reply(c, none)), F.coalesce(F.transform(c["replies"], lambda r: reply(r, c["id"])), F.array().cast("array<struct<external_id:string,text:string,created_at:string,parent_comment_id:string,likes:bigint>>")))))
    rows = posts.select("id", "permalink_url", F.explode(each).alias("c")).select(F.col("id").alias("post_id"), "permalink_url", "c.*")
    address = F.concat("permalink_url", F.when(F.col("permalink_url").contains("?"), "&").otherwise("?"), F.lit("comment_id="), "external_id")
    return rows.withColumn("url", address).drop("permalink_url")


def keyword_hits(items: Column, keyword: str) -> Column:
    """Of an array of JSON texts those that hold the keyword anywhere."""
    return F.filter(items, lambda x: F.lower(x).contains(keyword.lower()))


def narrowed(rows: DataFrame, conditions: Mapping[str, object], only_missing: str | None = None) -> DataFrame:
    """rows with equal values in the columns given, None meaning any; only_missing: a metadata key that is not set yet."""
    for column, value in conditions.items():
        rows = rows if value is None else rows.where(F.col(column).eqNullSafe(F.lit(value)))
    return rows if only_missing is None else rows.where(F.try_element_at("metadata", F.lit(only_missing)).isNull())
