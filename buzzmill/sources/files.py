"""Readers of exported and supplied files: mention files of a folder, shares as CSV, app stores' JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buzzmill.functions.records import folder_slug, hash_id
from buzzmill.functions.times import star_sentiment
from buzzmill.sources.tables import read_records

MENTION_FILES = ("*_grouped_parsed.json", "*_keyword_mentions.json")
# Formats of the days of a share.
SHARE_DAYS = ("yyyy-MM-dd", "d/M/yyyy", "M/d/yyyy")


def read_mention_files(spark: SparkSession, root: str, film: str | None = None, platforms: Sequence[str] | None = None, globs: Sequence[str] = MENTION_FILES) -> DataFrame:
    """Records of the files below root whose names fit one of the globs, each file once, others unopened; of one film's folder and known platforms if given."""
    rows = read_records(spark, root, glob="{" + ",".join(globs) + "}").withColumn("film_slug", folder_slug(F.col("file")))
    rows = rows if film is None else rows.where(F.lower("film_slug") == film.lower())
    return rows if platforms is None else rows.where(F.col("platform").isin(*platforms))


def read_shares(spark: SparkSession, path: str, brands: DataFrame) -> DataFrame:
    """Box-office shares (period_start, period_end, brand_slug, gbo_share_pct, cinema_count, source_name) of known brands.

    The file may start with a byte-order mark; days have three formats; rows without a slug, period or share go.
    """
    raw = spark.read.option("header", True).csv(path)
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    missing = {"period_start", "period_end", "brand_slug", "gbo_share_pct"} - set(raw.columns)
    if missing:
        raise ValueError(f"columns are missing: {', '.join(sorted(missing))}")
    day = lambda c: F.to_date(F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in SHARE_DAYS]))
    other = lambda c, t: F.trim(c).try_cast(t) if c in raw.columns else F.lit(None).cast(t)
    rows = raw.select(day("period_start").alias("period_start"), day("period_end").alias("period_end"), F.lower(F.trim("brand_slug")).alias("brand_slug"), F.trim("gbo_share_pct").try_cast("double").alias("gbo_share_pct"), other("cinema_count", "int").alias("cinema_count"), other("source_name", "string").alias("source_name"))
    return rows.where("brand_slug <> '' and period_start is not null and period_end is not null and gbo_share_pct is not null").join(brands.select("brand_slug").distinct(), "brand_slug", "left_semi")


REVIEWS = "array<struct<reviewId:string,id:string,score:int,rating:int,at:string,updated:string,content:string,title:string,review:string,version:string,userName:string,author:string,replyContent:string>>"


def store_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews of both stores of a live.json as rows: app, review_id, author, stars, sentiment, text, at (UTC), version, reply; newest first."""
    raw = spark.read.option("multiLine", True).schema(f"galaxy_google_play_reviews {REVIEWS}, galaxy_app_store_reviews {REVIEWS}").json(path)
    of = lambda c, app: raw.select(F.lit(app).alias("app"), F.explode(c).alias("r"))
    rows = of("galaxy_google_play_reviews", "google_play").unionByName(of("galaxy_app_store_reviews", "app_store")).select("app", "r.*")
    stars, author = F.coalesce("score", "rating"), F.coalesce("userName", "author")
    text = F.coalesce("content", F.concat_ws(". ", F.nullif(F.trim("title"), F.lit("")), "review"))
    at = F.coalesce("at", "updated").try_cast("timestamp")
    known = F.coalesce(F.nullif(F.coalesce("reviewId", "id"), F.lit("")), hash_id(F.col("app"), author, text))
    return rows.select("app", known.alias("review_id"), author.alias("author"), stars.alias("stars"), star_sentiment(stars).alias("sentiment"), text.alias("text"), at.alias("at"), "version", F.col("replyContent").alias("reply")).orderBy(F.col("at").desc_nulls_last(), "review_id")


def store_histogram(counts, descending: bool):
    """Counts of one to five stars; one store lists them from five to one."""
    return F.reverse(counts) if descending else counts
