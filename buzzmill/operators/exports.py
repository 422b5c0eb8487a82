"""Exports: files by film and platform, JSON lines, and summaries beside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOM = "﻿"


def write_csv(rows: DataFrame, path: str, fields: Sequence[str], by: Sequence[str] = ("film_slug", "platform")) -> None:
    """CSV files with a header, in folders by film and platform; missing fields are empty columns.

    The first header cell starts with the mark that spreadsheets know UTF-8 by.
    """
    named = [F.col(f) if f in rows.columns else F.lit("").alias(f) for f in fields if f not in by]
    out = rows.select(*[F.col(b) for b in by], *named)
    first = next(f for f in fields if f not in by)
    out.withColumnRenamed(first, BOM + first).write.mode("overwrite").partitionBy(*by).option("header", True).option("escape", '"').csv(path)


def write_json(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def export_rows(mentions: DataFrame, posts: DataFrame, title_hit: Column) -> DataFrame:
    """Rows to export: kept posts, all comments of kept posts, and other comments whose text has the title.

    mentions: kind, post_id, text ...; posts: post_id and kept.
    """
    kept = posts.where("kept").select("post_id").distinct().withColumn("_kept", F.lit(True))
    return mentions.join(kept, "post_id", "left").where(F.coalesce("_kept", F.lit(False)) | ((F.col("kind") == "comment") & title_hit)).drop("_kept")


def deduped(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key, combined before the shuffle."""
    return rows.withColumn("_key", key).groupBy("_key").agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def summary(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows by group before and after, and how many went."""
    count = lambda df, name: df.groupBy(*by).agg(F.count("*").alias(name))
    both = count(before, "rows_before").join(count(after, "rows_after"), list(by), "left").withColumn("rows_after", F.coalesce("rows_after", F.lit(0)))
    return both.withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def newest_first(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows in descending order of the fields as texts, the first field first."""
    return rows.orderBy(*[F.col(f).cast("string").desc_nulls_last() for f in fields])


def workbook(catalog: DataFrame, films: DataFrame, metrics: DataFrame, most: int = 5000) -> dict[str, DataFrame]:
    """Sheets of a workbook by name; the metrics are the last `most` rows by day, then title and platform."""
    return {"catalog": catalog.orderBy("slug"), "films": films.orderBy("title"), "metrics": metrics.orderBy(F.col("metric_date").desc_nulls_last(), "title", "platform_code").limit(most)}
