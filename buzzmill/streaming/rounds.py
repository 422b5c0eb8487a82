"""Rounds of a stream, with a limit of time each, and a log of every run and batch as a table."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from buzzmill.sources.scratch import scratch_path

EVENTS = "platform string, query_id string, run_id string, kind string, at timestamp, batch long, rows long, state_rows long, error string"
ROUNDS = "platform string, round int, status string, started_at timestamp, completed_at timestamp, rows long, error string"


class ProgressLog(StreamingQueryListener):
    """Starts, batches and ends of the named streams of a session, held until they are written to a table.

    Named streams only: the name is the platform. A batch is one row, so what is held is small; write() empties it.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.held = spark, path or scratch_path(spark, "progress"), []
        self.names: dict[str, str] = {}

    def _add(self, event, kind: str, batch=None, rows=None, state_rows=None, error=None) -> None:
        platform = self.names.get(str(event.runId))
        if platform is not None:
            self.held.append((platform, str(event.id), str(event.runId), kind, datetime.now(timezone.utc), batch, rows, state_rows, error))

    def onQueryStarted(self, event) -> None:
        if event.name:
            self.names[str(event.runId)] = event.name
            self._add(event, "start")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(p, "batch", p.batchId, p.numInputRows, sum(s.numRowsTotal for s in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(event, "failed" if event.exception else "complete", error=event.exception and event.exception[:4000])

    def write(self) -> None:
        """Append what has been held to the table."""
        held, self.held = self.held, []
        if held:
            self.spark.createDataFrame(held, EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(self.path)


def runs(events: DataFrame) -> DataFrame:
    """One row a run of a ProgressLog's table: platform, status (open, complete or failed), times, duration, batches, rows, error."""
    last = F.col("kind").isin("complete", "failed")
    one = events.groupBy("platform", "query_id", "run_id").agg(
        F.coalesce(F.max(F.when(last, F.col("kind"))), F.lit("open")).alias("status"),
        F.min(F.when(F.col("kind") == "start", F.col("at"))).alias("started_at"),
        F.max(F.when(last, F.col("at"))).alias("completed_at"),
        F.count_if(F.col("kind") == "batch").alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max("error").alias("error"),
    )
    return one.withColumn("duration_seconds", F.unix_timestamp("completed_at") - F.unix_timestamp("started_at"))


def last_run(done: DataFrame) -> DataFrame:
    """platform and the end of its last run that ended well."""
    return done.where("status = 'complete'").groupBy("platform").agg(F.max("completed_at").alias("last_run"))


def rounds(spark: SparkSession, platform: str, start: Callable[[int], StreamingQuery], most: int, pause: float = 120, timeout: float = 14_400) -> DataFrame:
    """`most` rounds one after the other, each a stream that start(round) begins; one row a round (ROUNDS).

    A round that takes longer than `timeout` seconds is stopped (status timeout), one that fails is noted (failed), and the next
    round goes on from the checkpoint in either case. Spark itself refuses a second stream on a checkpoint, so no lock is kept.
    """
    log = []
    for number in range(1, most + 1):
        began, status, error, rows = datetime.now(timezone.utc), "ok", None, 0
        try:
            query = start(number)
            try:
                if not query.awaitTermination(timeout):
                    status = "timeout"
            finally:
                query.stop()
                rows = sum(p["numInputRows"] for p in map(_plain, query.recentProgress))
        except Exception as e:  # a round's failure is a row of the log
            status, error = "failed", str(e)[:4000]
        log.append((platform, number, status, began, datetime.now(timezone.utc), rows, error))
        if number < most:
            time.sleep(max(0.0, pause))
    return spark.createDataFrame(log, ROUNDS)


def _plain(progress) -> dict:
    return progress if isinstance(progress, dict) else json.loads(progress.json)
