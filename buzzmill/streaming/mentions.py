"""Mentions as a stream: daily counts under a watermark, and upserts of seen URLs in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from buzzmill.functions.times import ZONE
from buzzmill.sources.scratch import scratch_path


def read_events(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def daily_counts(events: DataFrame, late: str = "14 days") -> DataFrame:
    """Counts and about how many users by business day and type; state older than `late` is dropped."""
    local = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).withColumn("day", F.window(F.from_utc_timestamp("ts", ZONE), "1 day"))
    return local.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"))


def upsert_batches(events: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Every available file once, each micro-batch given to apply with its number; the checkpoint remembers what was seen."""
    return events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()


def counted_by_day(spark: SparkSession, folder: str, schema: str, files_at_once: int = 1) -> DataFrame:
    """daily_counts over all files of a folder, files_at_once in a micro-batch: of each day and type the totals that came last.

    A batch writes the totals that it changed, under its number. Rows that come after their day's state has gone are passed over;
    late.part_late keeps those. An empty folder gives no rows.
    """
    path = scratch_path(spark, "daily-counts")
    stream = daily_counts(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder))
    stream.sparkSession.createDataFrame([], stream.schema).write.parquet(f"{path}/changes/batch=-1")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    query = stream.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint")
    query.trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    changes = spark.read.parquet(f"{path}/changes")
    last = changes.groupBy("day", "event_type").agg(F.max_by(F.struct("n", "users"), "batch").alias("t"))
    return last.select(F.to_date("day.start").alias("day"), "event_type", "t.n", "t.users")


SEEN = "url {url}, first_seen timestamp, last_seen timestamp, times long, content_ts timestamp"


def seen(spark: SparkSession, events: DataFrame, path: str | None = None) -> DataFrame:
    """State of a stream of discoveries (url, seen_at, content_ts) after all files: first and last seen, times, last known content time by url.

    Each micro-batch is merged with the table of the batch before, which is found by its number and written anew under the
    batch's own. So a batch that is run again gives the same table, and a later call with the same path goes on where the last
    one ended. No discoveries give an empty table.
    """
    path = path or scratch_path(spark, "seen-urls")
    schema = SEEN.format(url=events.schema["url"].dataType.simpleString())

    def merge(batch: DataFrame, number: int) -> None:
        at = F.col("seen_at").cast("timestamp")
        new = batch.select("url", at.alias("first_seen"), at.alias("last_seen"), F.lit(1).cast("long").alias("times"), F.col("content_ts").cast("timestamp").alias("content_ts"))
        rows = new.unionByName(spark.read.schema(schema).parquet(f"{path}/state-{number - 1}"))
        known = F.max_by("content_ts", F.when(F.col("content_ts").isNotNull(), F.col("last_seen")))
        merged = rows.groupBy("url").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("times").alias("times"), known.alias("content_ts"))
        merged.write.mode("overwrite").parquet(f"{path}/state-{number}")
        spark.createDataFrame([(number,)], "batch long").coalesce(1).write.mode("append").parquet(f"{path}/done")

    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/state--1")
    spark.createDataFrame([(-1,)], "batch long").write.mode("ignore").parquet(f"{path}/done")
    upsert_batches(events, f"{path}/checkpoint", merge).awaitTermination()
    last = spark.read.schema("batch long").parquet(f"{path}/done").agg(F.max("batch")).first()[0]
    return spark.read.schema(schema).parquet(f"{path}/state-{last}")
