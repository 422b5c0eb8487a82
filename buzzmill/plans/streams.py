"""Queries that run a stream over all files of a table (one file or a folder) and return what it left, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.operators import crawl
from buzzmill.operators.freshness import Limits
from buzzmill.plans.queries import LOG, STALE, query
from buzzmill.sources.scratch import scratch_path
from buzzmill.sources.tables import crawl_log, table
from buzzmill.streaming import late, rounds, stops
from buzzmill.streaming import mentions as S


def _late_totals(spark, arrivals, horizon):
    """Totals of a list of tables that arrive one after the other, each in a round of its own that goes on from the checkpoints."""
    path, schema = scratch_path(spark, "late"), arrivals[0].schema
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{path}/arrived")
        late.part_late(spark.readStream.schema(schema).parquet(f"{path}/arrived"), path, horizon).awaitTermination()
        late.count_days(spark, schema, path, "event_type", horizon).awaitTermination()
    return late.totals(spark, path, "event_type")


@query("SELECT (ts + INTERVAL 7 HOUR)::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return _late_totals(spark, [events], "14 days").select("day", "event_type", (F.col("n") + F.col("late")).alias("n"))


@query(
    """WITH e AS (SELECT *, event_id % 4 AS arrived FROM events), c AS (SELECT arrived, max(max(ts)) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock FROM e GROUP BY arrived)
SELECT (ts + INTERVAL 7 HOUR)::DATE AS day, event_type, count(*) FILTER (WHERE NOT late) AS n, count(*) FILTER (WHERE late) AS late
FROM (SELECT *, coalesce((ts + INTERVAL 7 HOUR)::DATE + INTERVAL 1 DAY - INTERVAL 7 HOUR <= clock - INTERVAL 7 DAY, false) AS late FROM e JOIN c USING (arrived)) GROUP BY ALL"""
)
def stream_late_counts(spark, sf_dir):
    """Events that arrive in four rounds; those of days that ended a week before the latest time so far are late, and counted apart."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _late_totals(spark, [events.where(F.col("event_id") % 4 == k).select("ts", "event_type") for k in range(4)], "7 days")


@query(f"{LOG} SELECT DISTINCT url FROM l")
def stream_first_urls(spark, sf_dir):
    """Each address of the log once, as a stream that remembers addresses for a year of the log's time."""
    path, log = scratch_path(spark, "first"), crawl_log(spark, sf_dir).select("url", "seen_at")
    log.write.parquet(f"{path}/arrived")
    events = spark.readStream.schema(log.schema).parquet(f"{path}/arrived")
    new = late.first_seen(events, "url", "seen_at", "365 days")
    new.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{path}/rows").select("url")


@query(
    f"""{LOG}, s AS (SELECT event_id, split_part(url, '/', 1) AS crawler, {STALE} FROM l),
c AS (SELECT *, sum((freshness = 'stale')::INT) OVER w AS stale, row_number() OVER w AS n, sum((freshness = 'fresh')::INT) OVER w AS resets FROM s WINDOW w AS (PARTITION BY crawler ORDER BY event_id)),
r AS (SELECT *, sum((freshness = 'stale')::INT) OVER (PARTITION BY crawler, resets ORDER BY event_id) AS run FROM c),
h AS (SELECT *, CASE WHEN freshness = 'stale' AND run >= 4 THEN 'freshness_boundary' WHEN stale >= 8 THEN 'stale_limit' WHEN n >= 15 THEN 'max_items' END AS reason FROM r),
k AS (SELECT *, count(reason) OVER (PARTITION BY crawler ORDER BY event_id) AS stops FROM h), l2 AS (SELECT *, max(n) OVER (PARTITION BY crawler) AS most FROM k WHERE stops = 0 OR stops = 1 AND reason IS NOT NULL)
SELECT event_id, crawler, freshness, CASE WHEN reason IS NULL AND n = most THEN 'exhausted' ELSE reason END AS stop_reason FROM l2"""
)
def stream_stop_rules(spark, sf_dir):
    """Discoveries that arrive in four rounds; every round goes on from the state that the one before left in the checkpoint."""
    path, limits = scratch_path(spark, "stops"), Limits(4, 8, 15)
    state = F.when(F.col("content_ts").isNull(), "unknown").when(F.col("content_ts") < "2024-01-14", "stale").otherwise("fresh")
    log = crawl_log(spark, sf_dir).select("event_id", F.substring_index("url", "/", 1).alias("crawler"), state.alias("freshness"))
    low, high = log.agg(F.min("event_id"), F.max("event_id")).first()
    edges = [low + (high + 1 - low) * k // 4 for k in range(5)] if low is not None else [0, 0]
    for a, b in zip(edges, edges[1:], strict=False):
        log.where(F.col("event_id").between(a, b - 1)).write.mode("append").parquet(f"{path}/arrived")
        arrived = spark.readStream.schema(log.schema).parquet(f"{path}/arrived")
        stops.take(stops.followed(arrived, "crawler", "event_id", "freshness", limits), path).awaitTermination()
    return stops.taken(spark, path, log.schema, "crawler", "event_id")


@query(
    f"""{LOG}, r AS (SELECT split_part(url, '/', 1) AS crawler, event_id, k * 7.0 AS elapsed, CASE WHEN k < 30 THEN 0 ELSE k % 4 END AS found, CASE WHEN k < 15 THEN 0 ELSE k % 2 END AS known FROM l JOIN e USING (event_id)),
c AS (SELECT *, row_number() OVER w AS pos, sum(found) OVER w AS total, sum(found + known) OVER w AS seen FROM r WINDOW w AS (PARTITION BY crawler ORDER BY event_id)),
i AS (SELECT *, pos - coalesce(max(CASE WHEN found > 0 THEN pos END) OVER (PARTITION BY crawler ORDER BY event_id), 0) AS idle FROM c),
h AS (SELECT *, CASE WHEN elapsed >= 680 THEN 'keyword_runtime_limit' WHEN elapsed >= 660 THEN 'runtime_limit' WHEN total >= 9 THEN 'max_items' WHEN idle >= 3 THEN 'idle_limit' WHEN seen = 0 AND pos >= 2 THEN 'empty_limit' END AS reason FROM i),
k AS (SELECT *, count(reason) OVER (PARTITION BY crawler ORDER BY event_id) AS stops FROM h), m AS (SELECT *, max(pos) OVER (PARTITION BY crawler) AS most FROM k WHERE stops = 0 OR stops = 1 AND reason IS NOT NULL)
SELECT event_id, crawler, CASE WHEN reason IS NULL AND pos = most THEN 'scroll_exhausted' ELSE reason END AS stop_reason, least(9, total - CASE WHEN elapsed >= 660 THEN found ELSE 0 END)::BIGINT AS total FROM m"""
)
def search_stops(spark, sf_dir):
    """Events as scrolls of a search, five rules to end it."""
    k = F.get_json_object("props", "$.k").cast("int")
    log = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("crawler"), "event_id", (k * 7.0).alias("elapsed"), F.when(k < 30, 0).otherwise(k % 4).alias("found"), F.when(k < 15, 0).otherwise(k % 2).alias("known"))
    return crawl.stopped_rounds(log, "crawler", "event_id", 9, 3, 2, 680, 660).select("event_id", "crawler", "stop_reason", F.col("total").cast("long").alias("total"))


@query(
    """SELECT 'events' AS platform, event_id % 3 + 1 AS round, 'ok' AS status, count(*) AS rows FROM events GROUP BY ALL"""
)
def stream_rounds(spark, sf_dir):
    """Three rounds over events, a third of which arrives before each."""
    path, events = scratch_path(spark, "rounds"), table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))

    def start(number):
        events.where(F.col("event_id") % 3 == number - 1).write.mode("append").parquet(f"{path}/arrived")
        arrived = spark.readStream.schema(events.schema).parquet(f"{path}/arrived")
        return arrived.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/rows")

    log = rounds.rounds(spark, "events", start, most=3, pause=0)
    return log.select("platform", F.col("round").cast("long").alias("round"), "status", "rows")


@query("SELECT o_custkey AS url, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen, count(*) AS times FROM orders GROUP BY ALL")
def stream_seen_urls(spark, sf_dir):
    """Orders as discoveries of their customers."""
    names = {"o_custkey": "url", "o_orderdate": "seen_at"}
    schema = table(spark, sf_dir, "orders").schema
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parquet*").withColumnsRenamed(names).withColumn("content_ts", F.col("seen_at"))
    return S.seen(spark, orders).select("url", "first_seen", "last_seen", "times")
