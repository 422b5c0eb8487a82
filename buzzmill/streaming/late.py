"""Daily counts of a stream whose late rows are kept: parted first, counted apart, while the counts' state is dropped in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from buzzmill.functions.times import ZONE

#: When a business day starts, from the start of the UTC day.
DAY_STARTS = "17 hours"


def part_late(events: DataFrame, path: str, horizon: str = "14 days") -> StreamingQuery:
    """Write each batch of a stream (ts and others) to path/in_time and path/late, with the column `late`.

    A row is late when its business day ended `horizon` or more before the latest time of the batches before its own. The latest
    time of each batch is stored under the batch's number, so a batch that runs again parts its rows alike. Rows without a time
    are in time.
    """
    spark = events.sparkSession
    schema = T.StructType([T.StructField(f.name, T.TimestampType() if f.name == "ts" else f.dataType) for f in events.schema])
    for name in ("in_time", "late"):  # so that both can be read before anything has come
        spark.createDataFrame([], schema.add("late", "boolean") if "late" not in schema.names else schema).write.mode("overwrite").parquet(f"{path}/{name}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("ts", F.col("ts").cast("timestamp")).persist()
        clocks = spark.read.schema("latest timestamp, batch int").parquet(f"{path}/clocks") if number else None
        clock = clocks.where(F.col("batch") < number).agg(F.max("latest")).first()[0] if number else None
        ended = F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp("ts", ZONE)) + F.expr("interval 1 day"), ZONE)
        late = F.coalesce(ended <= F.lit(clock) - F.expr(f"interval {horizon}"), F.lit(False)) if clock else F.lit(False)
        parted = batch.withColumn("late", late)
        parted.where("late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        parted.where("not late").write.mode("overwrite").parquet(f"{path}/in_time/batch={number}")
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{path}/clocks/batch={number}")
        batch.unpersist()

    return events.writeStream.option("checkpointLocation", f"{path}/parting").trigger(availableNow=True).foreachBatch(write).start()


def count_days(spark: SparkSession, schema: T.StructType, path: str, kind: str, horizon: str = "14 days") -> StreamingQuery:
    """Counts by business day and kind of the rows in time, as they change: path/changes holds each batch's new totals alone.

    A day's state goes once the watermark is past the day. No row in time comes later than that: what is parted as in time is
    later than any watermark that the rows before it give.
    """
    rows = spark.readStream.schema(f"ts timestamp, {kind} {schema[kind].dataType.simpleString()}, batch int").parquet(f"{path}/in_time")
    local = rows.withWatermark("ts", horizon)
    counts = local.groupBy(F.window("ts", "1 day", startTime=DAY_STARTS).alias("day"), kind).agg(F.count("*").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    spark.createDataFrame([], counts.schema).write.mode("overwrite").parquet(f"{path}/changes/batch=-1")
    return counts.writeStream.outputMode("update").option("checkpointLocation", f"{path}/counting").trigger(availableNow=True).foreachBatch(write).start()


def totals(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """day, kind, n (in time) and late of all rows so far: the last total of each day, and the late rows counted."""
    changes = spark.read.schema(f"day struct<start timestamp, end timestamp>, {kind} string, n long, batch int").parquet(f"{path}/changes")
    local = F.to_date(F.from_utc_timestamp("day.start", ZONE)).alias("day")
    counted = changes.select(local, kind, "n", "batch").groupBy("day", kind).agg(F.max_by("n", "batch").alias("n"), F.lit(0).cast("long").alias("late"))
    kept = spark.read.parquet(f"{path}/late").select(F.to_date(F.from_utc_timestamp("ts", ZONE)).alias("day"), kind).groupBy("day", kind).agg(F.lit(0).cast("long").alias("n"), F.count("*").alias("late"))
    return counted.unionByName(kept).groupBy("day", kind).agg(F.sum("n").alias("n"), F.sum("late").alias("late"))


def first_seen(events: DataFrame, key: str, at: str, horizon: str) -> DataFrame:
    """The first row of each key of a stream; a key is forgotten `horizon` after its time, and rows older than that are passed over."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])
