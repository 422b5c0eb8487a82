import datetime

import pytest
from pyspark.sql import functions as F

from buzzmill.functions import cleaning
from buzzmill.functions import text as X
from buzzmill.functions import times as D
from buzzmill.operators import freshness, tables
from buzzmill.sources.tables import read_records


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("raw, n", [("1,367", 1367), ("1.2K", 1200), ("1.229.143", 1229143), ("1,5", 2), ("10.7K likes", 10700), ("-3", None), ("", None), (None, None)])
def test_compact_count(spark, raw, n):
    assert value(spark, D.compact_count(F.lit(raw))) == n


@pytest.mark.parametrize("label, day", [("07/31/26", (2026, 7, 31)), ("31/07/2026", (2026, 7, 31)), ("05/08/26", (2026, 5, 8)), ("3 giờ trước", (2026, 9, 10)), ("2 tháng trước", (2026, 7, 12)), ("13h", (2026, 9, 9)), ("junk", None)])
def test_parse_time(spark, label, day):
    got = value(spark, F.to_date(D.parse_time(F.lit(label), F.lit("2026-09-10 12:00:00").cast("timestamp"))))
    assert got == (datetime.date(*day) if day else None)


def test_fold_and_terms(spark):
    assert value(spark, X.fold(F.lit("Đặt  VÉ, Ở rạp #Phim!"))) == "dat ve o rap #phim"
    assert value(spark, X.strip_marks(F.lit("Đặt"))) == "đat"
    assert value(spark, X.term_in(F.lit("gia dinh"), "dinh")) and not value(spark, X.term_in(F.lit("giadinh"), "dinh"))
    assert value(spark, X.term_in(F.lit("xem phim"), "#phim"))
    assert value(spark, X.slug(F.lit("Mưa đỏ: Phần 2"))) == "mua_do_phan_2"


def test_business_day(spark):
    assert value(spark, D.business_day(F.lit("2026-09-10 18:00:00").cast("timestamp"))) == datetime.date(2026, 9, 11)


def test_upsert_is_idempotent_and_keeps_known(spark):
    old = spark.createDataFrame([(1, 0, "a", 5, None)], "id int, seq int, text string, likes int, author string")
    new = spark.createDataFrame([(1, 1, "b", None, "x"), (1, 2, None, 7, "y"), (2, 3, "c", 1, None)], old.schema)
    once = tables.upsert(old, new, ["id"], "seq", latest=["text"], keep=["author"])
    assert sorted(map(tuple, once.collect())) == [(1, None, 7, "x"), (2, "c", 1, None)]
    again = tables.upsert(once.withColumn("seq", F.lit(9)), new, ["id"], "seq", latest=["text"], keep=["author"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_stale_cut(spark):
    states = ["stale", "unknown", "stale", "fresh", "stale", "stale", "stale", "fresh"]
    rows = spark.createDataFrame([("k", i, s) for i, s in enumerate(states)], "key string, at int, state string")
    assert sorted(r["at"] for r in freshness.cut_after_stale(rows, "key", "at", "state", 3).collect()) == list(range(7))


def test_read_records(spark, tmp_path):
    folder = tmp_path / "processed" / "film_a" / "google_maps"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('[{"post_id": "1", "post_text": "x", "comments": [{"text": "c"}]}]')
    (folder / "b.json").write_text('{"items": [{"post_id": "2", "platform": "tiktok"}, {"post_id": "3"}]}')
    got = {r["post_id"]: r["platform"] for r in read_records(spark, str(tmp_path)).collect()}
    assert got == {"1": "google", "2": "tiktok", "3": "google"}


def test_stream_matches_batch(spark, tmp_path):
    from buzzmill.streaming.mentions import read_events, upsert_batches

    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    seen = []
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.schema)
    upsert_batches(read_events(spark, str(tmp_path / "in"), schema), str(tmp_path / "state"), lambda df, _: seen.append(df.count())).awaitTermination()
    assert sum(seen) == batch.count()


def test_place_review_reads_a_text_few_times(spark):
    """The time of a card is looked for once; texts without a pattern's words, in any case, with icons or odd spaces, stay whole."""
    assert str(cleaning.place_review(F.col("t"))).count("regexp_extract(") == 1
    cases = [
        ("phòng chiếu lớn, sạch", "phòng chiếu lớn, sạch"), ("A 2 TUẦN TRƯỚC phòng\u2003chiếu \t lớn  MORE x", "phòng chiếu lớn"), ("an hour ago short", "an hour ago short"), ("\ue000\ue001 room of the film \u00a0 is\x1c fine", "room of the film is fine"),
        ("room is fine SEE ORIGINAL or not", "room is fine or not"), ("Click \u212a to remove this room", "Click \u212a to remove this room"), ("clic\u212a TO REMOVE this room", ""), ("me\u017f\u017fages  activity profile of room", ""), ("1234567890 " * 5 + "eleven char", ""),
        ("a room, Tran\u017flated BY google, it is", "a room, , it is"), ("1234567890 " * 5 + "twelve chars.x", "1234567890 " * 5 + "twelve chars.x"), (None, ""), ("ten chars.", ""),
    ]
    got = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "k int, t string").select("k", cleaning.place_review(F.col("t")).alias("r")).collect()
    assert {r["k"]: r["r"] for r in got} == {k: r for k, (_, r) in enumerate(cases)}


def test_replace_links_deals_rows_by_number(spark, monkeypatch):
    """Null keys stay, repeated links go, and a task gets few rows, whatever number there is."""
    frame = lambda rows: spark.createDataFrame(rows, "k long, b string")
    old, new = frame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, None)]), frame([(1, "x"), (2, "y"), (2, "y"), (2, None), (None, "z")])
    got = tables.replace_links(old, new, frame([(2, "t"), (2, "u"), (None, "t"), (9, "t")]), "k").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a"), (None, "c"), (3, None), (2, "y"), (2, None)], key=str)
    monkeypatch.setattr(tables, "TASK_ROWS", 500, raising=False)
    many = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("b"))
    sizes = [r["n"] for r in tables.replace_links(many, many, many.where("k % 2 = 0"), "k").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 800
