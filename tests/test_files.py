"""Files in and out: mention files, shares, store reviews, exports, configuration."""

import json

import pytest
from pyspark.sql import functions as F

from buzzmill.operators import exports
from buzzmill.sources import config, files


def test_mention_files(spark, tmp_path):
    for slug, platform, name in (("the_odyssey", "tiktok", "a_grouped_parsed.json"), ("minion", "google_maps", "b_keyword_mentions.json"), ("minion", "tiktok", "c.json"), ("default_film", "other", "d_grouped_parsed.json")):
        folder = tmp_path / "processed" / slug / platform
        folder.mkdir(parents=True)
        (folder / name).write_text(json.dumps([{"post_id": name, "post_text": "x"}]))
    rows = files.read_mention_files(spark, str(tmp_path), platforms=["tiktok", "google"])
    assert sorted((r["post_id"], r["film_slug"], r["platform"]) for r in rows.collect()) == [("a_grouped_parsed.json", "the_odyssey", "tiktok"), ("b_keyword_mentions.json", "minion", "google")]
    assert [r["film_slug"] for r in files.read_mention_files(spark, str(tmp_path), film="THE_ODYSSEY").collect()] == ["the_odyssey"]
    assert [r["film_slug"] for r in files.read_mention_files(spark, str(tmp_path), platforms=["other"]).collect()] == [None]


def test_shares(spark, tmp_path):
    f = tmp_path / "gbo.csv"
    f.write_text("﻿period_start,period_end,brand_slug,gbo_share_pct,cinema_count\n2026-01-01,31/01/2026,GLX,12.5,20\n01/13/2026,2026-01-31,cgv,40,\n2026-01-01,2026-01-31,,1,1\n2026-01-01,2026-01-31,other,1,1\nbad,2026-01-31,glx,1,1\n")
    brands = spark.createDataFrame([("glx",), ("cgv",)], "brand_slug string")
    rows = sorted((r["brand_slug"], str(r["period_start"]), str(r["period_end"]), r["gbo_share_pct"], r["cinema_count"], r["source_name"]) for r in files.read_shares(spark, str(f), brands).collect())
    assert rows == [("cgv", "2026-01-13", "2026-01-31", 40.0, None, None), ("glx", "2026-01-01", "2026-01-31", 12.5, 20, None)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="brand_slug"):
        files.read_shares(spark, str(tmp_path / "bad.csv"), brands)


def test_store_reviews(spark, tmp_path):
    live = {
        "galaxy_google_play_reviews": [{"reviewId": "r1", "score": 5, "at": "2026-01-02T00:00:00Z", "content": "hay", "userName": "a"}, {"score": 3, "at": None, "content": "tạm", "userName": "b"}],
        "galaxy_app_store_reviews": [{"id": "s1", "rating": 1, "title": "Lỗi", "review": "văng app", "author": "c", "updated": "2026-01-03T00:00:00Z"}],
    }
    (tmp_path / "live.json").write_text(json.dumps(live))
    rows = files.store_reviews(spark, str(tmp_path / "live.json")).collect()
    assert [(r["app"], r["stars"], r["sentiment"], r["text"]) for r in rows] == [("app_store", 1, "negative", "Lỗi. văng app"), ("google_play", 5, "positive", "hay"), ("google_play", 3, "neutral", "tạm")]
    assert rows[0]["review_id"] == "s1" and len(rows[2]["review_id"]) == 24


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("minion", "tiktok", 'a "q", b', "2"), ("minion", "news", "é", "1")], "film_slug string, platform string, text string, id string")
    exports.write_csv(rows, str(tmp_path / "csv"), ["film_slug", "platform", "id", "text", "author"])
    found = list((tmp_path / "csv" / "film_slug=minion" / "platform=tiktok").glob("*.csv"))
    assert found[0].read_text(encoding="utf-8").splitlines() == ["﻿id,text,author", '2,"a ""q"", b",""']
    exports.write_json(rows, str(tmp_path / "json"))
    exports.write_json(rows, str(tmp_path / "json"), append=True)
    assert spark.read.json(str(tmp_path / "json")).count() == 4
    assert [r["id"] for r in exports.newest_first(rows, ["platform", "id"]).collect()] == ["2", "1"]
    catalog = spark.createDataFrame([("b",), ("a",)], "slug string")
    metrics = spark.createDataFrame([("2026-01-01", "x", "all"), ("2026-01-02", "x", "all")], "metric_date string, title string, platform_code string")
    book = exports.workbook(catalog, catalog.withColumn("title", F.col("slug")), metrics, 1)
    assert [r["slug"] for r in book["catalog"].collect()] == ["a", "b"] and book["metrics"].first()["metric_date"] == "2026-01-02" and book["metrics"].count() == 1


def test_terms(spark, tmp_path):
    payload = {"active_process": "crawl", "keywords": ["Phim", " phim ", {"value": "x", "processes": ["import"]}, {"value": "y", "processes": ["*"]}, {"value": "z", "enabled": False}], "hashtags": ["#a"], "exclude_keywords": ["no"]}
    assert config.terms_of(payload) == ["Phim", "y", "#a"]
    assert config.terms_of(payload, process="import") == ["Phim", "x", "y", "#a"]
    assert config.terms_of(payload, config.EXCLUDE_FIELDS) == ["no"]
    path = tmp_path / "k.json"
    path.write_text(json.dumps({"keywords": ["file"]}))
    rows = spark.createDataFrame([("keywords", 2, "b"), ("keywords", 1, "a"), ("keywords", 3, "A")], "field string, position int, term string")
    assert config.load_payload(str(path)) == {"keywords": ["file"]}
    assert config.load_payload(str(path), rows) == {"keywords": ["a", "b"]}
    assert config.load_payload(str(path), rows.limit(0)) == {"keywords": ["file"]}
    assert config.load_payload(None, rows.limit(0), "db") == {}


def test_days_out_of_order(spark):
    from buzzmill.operators.metrics import on_days

    rows = spark.createDataFrame([(1, "2024-01-20 18:00:00"), (2, "2024-01-20 16:00:00")], "mention_id int, t string").select("mention_id", F.col("t").cast("timestamp").alias("occurred_at"))
    assert [r["mention_id"] for r in on_days(rows, "2024-01-21", "2024-01-21").collect()] == [1]
    assert on_days(rows).count() == 2
    with pytest.raises(ValueError):
        on_days(rows, "2024-01-22", "2024-01-21")
