"""Mentions, bridges and crawl logs, made from the supplied tables; and readers of record files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLATFORMS = ("facebook", "tiktok", "youtube", "threads", "news")

COMMENT = T.StructType([T.StructField(c, T.StringType()) for c in ("external_id", "author", "text", "created_at", "url", "parent_comment_id")])
POST = T.StructType([T.StructField(c, T.StringType()) for c in ("platform", "post_id", "page_name", "post_url", "post_created_at", "post_text", "search_keyword")] + [T.StructField("comments", T.ArrayType(COMMENT))])


WRAPPERS = ("items", "mentions", "data")
#: Names in raw crawls for fields of posts and comments.
POST_NAMES = {"post_id": "id", "post_url": "permalink_url", "post_created_at": "created_time", "post_text": "message"}
COMMENT_NAMES = {"external_id": "id", "text": "message", "created_at": "created_time"}
#: A record as texts, so that no shape of a field makes it unreadable.
RAW = T.StructType([T.StructField(c, T.StringType()) for c in (*POST.names, *POST_NAMES.values(), *WRAPPERS)])


def flat_comments(raw: str | None) -> list[tuple] | None:
    """Comments from an array or {data: [...]}, each before its replies, which name it as their parent; null if neither."""
    if raw is None:
        return None
    listed = lambda v: v if isinstance(v, list) else (v.get("data") or []) if isinstance(v, dict) else None
    try:
        found = listed(json.loads(raw, parse_int=str, parse_float=str))
    except ValueError:
        return None
    if not isinstance(found, list):
        return None
    out, left = [], [(c, None) for c in reversed(found)]
    while left:
        c, parent = left.pop()
        if not isinstance(c, dict):
            continue
        values = {f: c.get(f) if c.get(f) is not None else c.get(COMMENT_NAMES.get(f, f)) for f in COMMENT.names}
        values["parent_comment_id"] = values["parent_comment_id"] or parent
        out.append(tuple(v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values.values()))
        replies = listed(c.get("comments"))
        left += [(r, values["external_id"]) for r in reversed(replies if isinstance(replies, list) else [])]
    return out


def read_records(spark: SparkSession, path: str, lines: bool = False, glob: str = "*") -> DataFrame:
    """Grouped post records from JSON arrays, {items|mentions|data: [...]} wrappers, or JSON lines; what is not JSON goes.

    Of the files below path only those whose names fit glob are opened. sources.lines gives the lines that are no records.

    Raw crawls' names (id, message, ...) are taken too; comments are an array or {data: [...]}, replies follow theirs.
    `file` is the path that a record came from; a missing platform is taken from the folder below `processed`.
    """
    objects = lambda array: F.filter(F.from_json(array, "array<string>"), lambda x: x.startswith("{"))
    parsed = lambda texts: F.transform(texts, lambda x: F.from_json(x, RAW))
    schema = T.StructType([*RAW.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.option("multiLine", not lines).option("recursiveFileLookup", True).option("pathGlobFilter", glob).schema(schema).json(path).withColumn("file", F.col("_metadata.file_path"))
    # an array with an element that is no object is given as unreadable: its objects stay
    own = F.when(F.col("_corrupt_record").isNull(), F.array(F.struct(*RAW.names))).otherwise(parsed(objects(F.col("_corrupt_record"))))
    rows = rows.select("file", F.explode(own).alias("r")).select("file", "r.*")
    lists = [F.from_json(w, "array<string>") for w in WRAPPERS]
    wrapped = F.coalesce(*[F.when(F.size(x) > 0, objects(F.col(w))) for w, x in zip(WRAPPERS, lists, strict=True)], *[F.when(x.isNotNull(), F.array().cast("array<string>")) for x in lists])
    rows = rows.select("file", F.explode(F.coalesce(parsed(wrapped), F.array(F.struct(*RAW.names)))).alias("r")).select("file", "r.*")
    named = [F.coalesce(c, POST_NAMES[c]).alias(c) if c in POST_NAMES else F.col(c) for c in POST.names if c != "comments"]
    rows = rows.select("file", *named, F.udf(flat_comments, POST["comments"].dataType)("comments").alias("comments"))
    place = F.nullif(F.regexp_extract("file", r"/processed/[^/]+/([^/]+)/", 1), F.lit(""))
    platform = F.coalesce(F.nullif(F.trim("platform"), F.lit("")), place)
    return rows.withColumn("platform", F.when(platform == "google_maps", "google").otherwise(platform))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as mentions: one in ten has no author, one in ten a blank one."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select(
        F.col("event_id").alias("mention_id"),
        F.col("ts").alias("occurred_at"),
        F.get(F.array(*map(F.lit, PLATFORMS)), (F.col("event_id") % 5).cast("int")).alias("platform_code"),
        F.when(F.col("event_type").isin("view", "click"), "post").otherwise("comment").alias("mention_kind"),
        F.when(F.col("event_type") == "purchase", "positive").when(F.col("event_type") == "error", "negative").otherwise("neutral").alias("sentiment"),
        F.when(F.col("k") < 10, "owned").when(F.col("k") < 25, "paid").otherwise("earned").alias("media_type"),
        (F.col("k") >= 95).alias("is_spam"),
        F.when(F.col("k") % 10 < 2, "want_to_see").when(F.col("k") % 10 == 2, "not_interested").alias("intent"),
        F.when(F.col("user_id") % 10 == 0, F.lit(None)).when(F.col("user_id") % 10 == 1, "").otherwise(F.col("user_id").cast("string")).alias("author_key"),
        "user_id",
        "k",
    )


def links(rows: DataFrame, entity: str, n: int, shift: int, every: int) -> DataFrame:
    """A bridge: each mention to user_id % n, and each mention_id divisible by `every` to a second entity."""
    first, second = F.col("user_id") % n, (F.col("user_id") + shift) % n
    both = F.when(F.col("mention_id") % every == 0, F.array_distinct(F.array(first, second))).otherwise(F.array(first))
    return rows.select("mention_id", F.explode(both).alias(entity))


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as discoveries; one in eleven has no content time."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select("event_id", F.concat(F.lit("u"), F.col("user_id"), F.lit("/"), F.col("k")).alias("url"), F.col("event_type").alias("keyword"), F.when(F.col("k") % 11 != 0, F.col("ts")).alias("content_ts"), F.col("ts").alias("seen_at"))


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """Items of news feeds as posts: id from link and title, text without tags, publication time (null where unreadable)."""
    rows = spark.read.format("xml").option("rowTag", "item").schema("title string, description string, link string, pubDate string").load(path)
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("description", F.lit("")), "<[^>]+>", " "), r"\s+", " "))
    when = F.try_to_timestamp(F.regexp_replace("pubDate", "^[A-Za-z]+, *", ""), F.lit("d MMM yyyy HH:mm:ss z"))
    return rows.select(F.substring(F.sha1(F.concat_ws("|", "link", "title")), 1, 24).alias("post_id"), "title", plain.alias("post_text"), F.col("link").alias("post_url"), when.alias("published_at"))
