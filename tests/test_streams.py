"""Streams with state: the same rows as the batch form, over restarts; late rows; rounds that fail or take too long."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from buzzmill.operators import freshness, ranks
from buzzmill.operators.freshness import Limits
from buzzmill.streaming import late, mentions, rounds, stops

LOG = "i long, k string, s string"


def by_hand(rows, limits):
    """Rows (i, key, state) that are taken, with the reason at the last of each key."""
    kept, counts = {}, {}
    for i, k, s in sorted(rows):
        items, stale, run, why = counts.get(k, (0, 0, 0, None))
        if why:
            continue
        items, stale, run = items + 1, stale + (s == "stale"), run + 1 if s == "stale" else 0 if s == "fresh" else run
        if limits.stale_run and s == "stale" and run >= limits.stale_run:
            why = "freshness_boundary"
        elif limits.stale and stale >= limits.stale:
            why = "stale_limit"
        elif limits.items and items >= limits.items:
            why = "max_items"
        counts[k], kept[i] = (items, stale, run, why), (k, s, why)
    last = {k: i for i, (k, _, _) in kept.items()}
    return sorted((i, str(k), str(s), "exhausted" if i in last.values() and not counts[k][3] else str(why)) for i, (k, s, why) in kept.items())


def as_rows(df):
    return sorted((r["i"], str(r["k"]), str(r["s"]), str(r["stop_reason"])) for r in df.collect())


@pytest.fixture(scope="module")
def discoveries():
    rng = random.Random(4)
    return [(i, rng.choice(["a"] * 20 + ["b", "c", None]), rng.choice(["stale"] * 3 + ["fresh", "unknown", None])) for i in range(900)]


@pytest.mark.parametrize("limits", [Limits(6, 25, 300), Limits(0, 500, 0), Limits(0, 0, 700), Limits(0, 0, 0), Limits(9, 0, 0)])
def test_stop_rules(spark, discoveries, limits):
    df = spark.createDataFrame(discoveries, LOG).repartition(5)
    assert as_rows(freshness.stopped_rows(df, "k", "i", "s", limits)) == by_hand(discoveries, limits)


def test_stop_rules_as_a_stream(spark, discoveries, tmp_path):
    """Files one by one, each taken by a new query on the same checkpoint."""
    limits, path = Limits(6, 60, 90), f"file://{tmp_path}"
    for n in range(0, 900, 300):
        spark.createDataFrame(discoveries[n : n + 300], LOG).repartition(2).write.mode("append").parquet(f"{path}/in")
        arrived = spark.readStream.schema(LOG).parquet(f"{path}/in")
        stops.take(stops.followed(arrived, "k", "i", "s", limits), path).awaitTermination()
        assert as_rows(stops.taken(spark, path, arrived.schema, "k", "i")) == by_hand(discoveries[: n + 300], limits)
    stops.take(stops.followed(arrived, "k", "i", "s", limits), path).awaitTermination()
    assert as_rows(stops.taken(spark, path, arrived.schema, "k", "i")) == by_hand(discoveries, limits)


def test_no_task_holds_a_keyword(spark):
    """One keyword in all rows is sorted over several ranges, and its ranks and runs go on across them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, "only", (k * 7919) % 2003 if k % 5 else None) for k in range(2000)]
        df = spark.createDataFrame(rows, "i long, k string, at long").repartition(3)
        kept = ranks.placed(df, ["k"], ["i"])
        assert kept.select("_part").distinct().count() > 2
        want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        got = {r["i"]: (r["newest_rank"], r["in_final"]) for r in freshness.newest(df, "k", "at", "i", 9).collect()}
        assert got == {i: (n, n <= 9) for n, (i, _, _) in enumerate(want, 1)}
        assert ranks.numbered(df, [F.desc("i")]).where("rank <> 2000 - i").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_of_nothing(spark):
    none = spark.createDataFrame([], LOG)
    assert ranks.numbered(none, ["i"]).count() == 0 and freshness.stopped_rows(none, "k", "i", "s", Limits()).count() == 0


def test_late_rows_are_kept(spark, tmp_path):
    path, first = f"file://{tmp_path}", datetime(2024, 1, 1, 3, tzinfo=timezone.utc)
    schema = "ts timestamp, event_type string, note string"
    arrivals = [[(first + timedelta(days=d), "x", f"{n}-{d}") for d in days] for n, days in enumerate([[0, 1, 1], [2, 30], [1, 20, 30], [2, 28, 45], [40, 46]])] + [[(None, "x", "no time")]]
    states, known = [], []
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/arrived")
        events = spark.readStream.schema(schema).parquet(f"{path}/arrived")
        late.part_late(events, path, "7 days").awaitTermination()
        counting = late.count_days(spark, events.schema, path, "event_type", "7 days")
        counting.awaitTermination()
        states += [p["stateOperators"][0]["numRowsTotal"] for p in counting.recentProgress if p["stateOperators"]]
        known += rows
    assert max(states) > states[-1]
    noted = spark.read.parquet(f"{path}/late")
    assert {r["note"] for r in noted.collect()} == {"2-1", "2-20", "3-2"} and {r["late"] for r in noted.collect()} == {True}
    got = late.totals(spark, path, "event_type").where("day is not null")
    assert got.agg(F.sum("n"), F.sum("late")).first() == (len(known) - 1 - 3, 3)
    assert got.where("day = date'2024-01-02'").first()[2:] == (2, 1)


def test_first_seen(spark, tmp_path):
    rows = [(f"u{k % 7}", datetime(2024, 1, 1 + k % 3, tzinfo=timezone.utc)) for k in range(40)]
    spark.createDataFrame(rows, "url string, at timestamp").write.parquet(f"file://{tmp_path}/in")
    events = late.first_seen(spark.readStream.schema("url string, at timestamp").parquet(f"file://{tmp_path}/in"), "url", "at", "30 days")
    events.writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start(f"file://{tmp_path}/out").awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [f"u{k}" for k in range(7)]


def test_seen_goes_on_and_takes_nothing(spark, tmp_path):
    schema, path = "url string, seen_at timestamp, content_ts timestamp", f"file://{tmp_path}"
    spark.createDataFrame([], schema).write.parquet(f"{path}/in")
    read = lambda: spark.readStream.schema(schema).parquet(f"{path}/in")
    assert mentions.seen(spark, read(), f"{path}/state").count() == 0
    day = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    for rows in ([("a", day(1), day(1)), ("b", day(2), None)], [("a", day(3), None)], [("b", day(1), day(1)), ("a", day(5), day(4))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        got = mentions.seen(spark, read(), f"{path}/state")
    assert sorted((r["url"], r["first_seen"].day, r["last_seen"].day, r["times"], r["content_ts"].day) for r in got.collect()) == [("a", 1, 5, 3, 4), ("b", 1, 2, 2, 1)]
    none = spark.readStream.schema("ts timestamp, user_id long, event_type string").parquet(f"{path}/in").schema
    (tmp_path / "empty").mkdir()
    assert mentions.counted_by_day(spark, f"{path}/empty", none).count() == 0


def test_rounds_and_their_log(spark, tmp_path):
    """A round that works, one that fails, one that takes too long, and one that takes up what they left."""
    path, log = f"file://{tmp_path}", rounds.ProgressLog(spark)
    spark.streams.addListener(log)
    done = []

    def start(number):
        spark.createDataFrame([(number * 10 + k,) for k in range(number)], "i long").coalesce(1).write.mode("append").parquet(f"{path}/in")

        def take(batch, _):
            n = batch.count()
            if number == 2:
                raise ValueError("no luck")
            if number == 3:  # stopped meanwhile, so the batch is taken again
                time.sleep(20)
                return
            done.append(n)

        events = spark.readStream.schema("i long").parquet(f"{path}/in")
        return events.writeStream.queryName("tiktok").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).foreachBatch(take).start()

    try:
        got = rounds.rounds(spark, "tiktok", start, most=4, pause=0, timeout=10).orderBy("round").collect()
        assert [(r["round"], r["status"]) for r in got] == [(1, "ok"), (2, "failed"), (3, "timeout"), (4, "ok")]
        assert "no luck" in got[1]["error"] and got[0]["rows"] == 1 and all(r["completed_at"] >= r["started_at"] for r in got)
        assert sum(done) == 1 + 2 + 3 + 4
        for _ in range(100):
            if sum(e[3] in ("complete", "failed") for e in log.held) == 4:
                break
            time.sleep(0.1)
        log.write()
        log.write()
    finally:
        spark.streams.removeListener(log)
    runs = rounds.runs(log.table()).orderBy("started_at").collect()
    assert [r["status"] for r in runs][:2] == ["complete", "failed"] and runs[-1]["status"] == "complete" and len(runs) == 4
    assert runs[0]["rows"] == 1 and runs[0]["batches"] == 1 and runs[0]["duration_seconds"] >= 0 and "no luck" in runs[1]["error"]
    assert rounds.last_run(rounds.runs(log.table())).first()["last_run"] == runs[-1]["completed_at"]
