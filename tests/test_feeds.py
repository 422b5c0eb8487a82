"""Rejected lines, nodes at any depth, many terms, hot posts, bounded samples and sketches."""

import json
import random

import numpy as np
from pyspark.sql import functions as F

from buzzmill.operators import classify, imports, metrics, reports, term_index
from buzzmill.sources import lines, stores


def test_rejected_lines(spark, tmp_path):
    good = [json.dumps({"id": k, "name": f"n{k}", "tags": ["a", "b"] if k % 2 else "none"}) for k in range(400)]
    broken = {3: '{"id": 1', 77: "[1, 2]", 200: "7", 399: "nonsense {"}
    told = ["" if k == 10 else " \t" if k == 11 else broken.get(k, line) for k, line in enumerate(good)]
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.jsonl").write_text("\n".join(told) + "\n")
    (tmp_path / "y.jsonl").write_text("\r\n".join(["oops", good[5], "", "null"]))
    (tmp_path / "z.json").write_text("other")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records, rejects = lines.read_with_rejects(spark, f"file://{tmp_path}", "id long, name string, tags array<string>")
        read = lines.read_lines(spark, f"file://{tmp_path}")
        assert read.rdd.getNumPartitions() > 4 and not any(f.endswith("z.json") for f in read.inputFiles())
        bad = {(r["file"].rsplit("/", 1)[1], r["line_number"]): (r["reason"], r["text"]) for r in rejects.collect()}
        want = {("x.jsonl", k + 1): ("not a record" if k in (77, 200) else "not json", t) for k, t in broken.items()}
        assert bad == want | {("y.jsonl", 1): ("not json", "oops"), ("y.jsonl", 4): ("not a record", "null")}
        rows = sorted((r["id"], r["name"], r["tags"]) for r in records.where("file like '%x.jsonl'").collect())
        assert rows == [(k, f"n{k}", ["a", "b"] if k % 2 else None) for k in range(400) if k not in broken and k not in (10, 11)]
        assert records.count() == 395 and {tuple(r)[1:] for r in lines.reject_counts(rejects).collect()} == {("not json", 2), ("not a record", 2), ("not json", 1), ("not a record", 1)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [df.count() for df in lines.read_with_rejects(spark, f"file://{tmp_path}", "id long", ["*.none"])] == [0, 0]


def test_nodes_at_any_depth(spark):
    review = lambda i, stars, **more: {"id": i, "rating": stars, "contents": f"c{i}", "reviewerName": "n", "date": "d", **more}
    deep = review("deep", 4)
    for k in range(300):
        deep = [deep] if k % 2 else {"k": deep}
    data = {"a": [review("1", 5, response={"contents": "thanks"}), {"b": review("1", 1)}, review("", 3), review("9", 0), {"$kind": "Review", "id": "kind", "rating": 2}], "d": deep, "r": {"$kind": "Ratings", "ratingCounts": [9, 1]}}
    last = {"x": {"$kind": "Ratings", "ratingCounts": [50, 40, None, 20, 10], "ratingAverage": 4.2, "totalNumberOfRatings": 120}}
    page = lambda d: f'<p><script id="serialized-server-data" type="x">{json.dumps(d)}</script>'
    rows = [("app", 1, page(data)), ("app", 2, page([review("1", 2), review("2", 3), last])), ("none", 1, None), ("none", 2, "<script>"), ("none", 3, page({}).replace("{}", "{oops"))]
    pages = spark.createDataFrame(rows, "app string, page int, html string")
    nodes = stores.page_nodes(pages, stores.server_data(F.col("html")), ("app", "page"))
    got = {r["id"]: (r["app"], r["rating"], r["review"], r["reply"]) for r in stores.page_reviews(nodes, "app", ("page",)).collect()}
    assert got == {"1": ("app", 5, "c1", "thanks"), "deep": ("app", 4, "cdeep", None), "kind": ("app", 2, None, None), "2": ("app", 3, "c2", None)}
    assert [tuple(r) for r in stores.page_ratings(nodes, "app", ("page",)).collect()] == [("app", 4.2, 120, [10, 20, 0, 40, 50])]
    entry = lambda i, stars: {"id": {"label": i}, "im:rating": {"label": stars}, "title": {"label": "t"}, "author": {"name": {"label": "a"}}}
    feeds = [("app", 1, json.dumps({"feed": {"entry": [{"title": {"label": "the app"}}, entry("5", "4"), entry("", "x"), entry("5", "1")]}})), ("app", 2, json.dumps({"feed": {"entry": [entry("5", "2"), entry("6", "3")]}})), ("app", 3, "{}"), ("app", 4, None)]
    found = stores.feed_reviews(spark.createDataFrame(feeds, "app string, page int, feed string"), "app", "page", F.col("feed"))
    assert sorted((str(r["id"]), r["rating"]) for r in found.collect()) == [("5", 4), ("6", 3), ("None", 0)]


def test_terms_by_their_rarest_run(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 9)))
    texts = [(k, " ".join(word() for _ in range(rng.randint(0, 30)))) for k in range(120)] + [(500, None), (501, ""), (502, "a"), (503, "😀 abc 😀😀")]
    terms = [(k, word()) for k in range(300)] + [(900, None), (901, ""), (902, "a"), (903, "😀😀"), (904, texts[5][1])]
    got = term_index.matches(spark.createDataFrame(texts, "i long, t string"), "i", "t", spark.createDataFrame(terms, "k long, w string"), "k", "w")
    assert sorted(map(tuple, got.collect())) == sorted((i, k) for i, t in texts for k, w in terms if t and w and w in t)
    assert term_index.matches(spark.createDataFrame(texts, "i long, t string"), "i", "t", spark.createDataFrame([], "k long, w string"), "k", "w").count() == 0


def test_terms_of_every_length_and_few_runs(spark):
    """Terms around each span's length, with characters of several bytes; a text gives a small part of its runs to terms of 24 bytes."""
    rng = random.Random(4)
    texts = [(k, "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 200)))) for k in range(150)]
    cut = lambda t, n: t[(a := rng.randrange(len(t) + 1)) : a + n]
    terms = [(k, cut(rng.choice(texts)[1], n)) for k, n in enumerate([*range(0, 60)] * 6)] + [(k, "".join(rng.choice("abé") for _ in range(k % 30))) for k in range(1000, 1060)]
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    got = term_index.matches(frame(texts, "i long, t string"), "i", "t", frame(terms, "k long, w string"), "k", "w")
    assert sorted(map(tuple, got.collect())) == sorted((i, k) for i, t in texts for k, w in terms if t and w and w in t)
    long_texts = [(k, " ".join(str(rng.random())[2:] for _ in range(300))) for k in range(20)]
    texts = frame(long_texts, "i long, _text string")
    levels = spark.sparkContext.broadcast(term_index._levels(texts, [24]))
    given = term_index._chosen(texts, "i", "_text", levels, [24], False).count()
    assert given < sum(len(t) for _, t in long_texts) / 7


def test_campaign_counts_of_copies(spark):
    """Counts are those of the pairs, for campaigns of one keyword or several; copies meet once, so 4,000 equal texts of 4,000 campaigns take no 16 million pairs."""
    rng = random.Random(5)
    words = ["xem phim", "rạp gần nhà", "#hay quá", "x", "", "vé", "vé rẻ hôm nay cho cả nhà mình"]
    rows = [(k, rng.choice([None, "glx", "cgv"]), rng.choice([None, "", " ".join(rng.choice(words) for _ in range(4))])) for k in range(200)]
    rules = [(rng.randrange(60), rng.choice([*words, None]), rng.choice(["running", "ended", "planned"]), rng.choice([None, "glx", "cgv", ""])) for _ in range(120)]
    mentions, keywords = spark.createDataFrame(rows, "mention_id long, brand_slug string, content_text string"), spark.createDataFrame(rules, "campaign_id long, keyword string, status string, brand_slug string")
    pairs = classify.campaign_matches(mentions, keywords, listed=10_000).groupBy("campaign_id").agg(F.count("*").alias("mentions"))
    assert sorted(map(tuple, classify.campaign_counts(mentions, keywords).collect())) == sorted(map(tuple, pairs.collect()))
    equal = spark.range(4000).select(F.col("id").alias("mention_id"), F.lit("glx").alias("brand_slug"), F.lit("rạp gần nhà mình hay quá").alias("content_text"))
    many = spark.range(4000).select(F.col("id").alias("campaign_id"), F.lit("gần nhà").alias("keyword"), F.lit("running").alias("status"), F.lit(None).cast("string").alias("brand_slug"))
    counts = classify.campaign_counts(equal, many)
    assert counts.where("mentions = 4000").count() == 4000


def test_terms_that_texts_hold(spark, monkeypatch):
    """Lists of terms of any length, found in one look through pieces of texts; nearly nothing else passes the filters."""
    rng = random.Random(6)
    texts = [(k, "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 600)))) for k in range(120)] + [(500, None), (501, ""), (502, "a")]
    cut = lambda t, n: t[(a := rng.randrange(len(t) + 1)) : a + n]
    terms = {cut(rng.choice(texts[:120])[1], n) for n in [*range(80), 150, 300, 500] * 6} | {"".join(rng.choice("abé") for _ in range(k % 70)) for k in range(140)} | {None}
    monkeypatch.setattr(term_index, "CHUNK_BYTES", 100)
    filters = term_index._filters(spark.createDataFrame([(w,) for w in terms], "w string"), "w")
    for _, text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts, sizes = term_index._windows(data, np.array([0, len(data)]), filters)
        found = {bytes(data[a : a + n]) for a, n in zip(starts, sizes, strict=True)}
        want = {w.encode() for w in terms if w and text and w in text}
        assert want <= found and len(found) <= len(want) + 20
    whole = term_index.held(spark.createDataFrame(texts, "i long, t string"), "t", spark.createDataFrame([(w,) for w in terms], "w string"), "w")
    keys = spark.createDataFrame([(w,) for w in terms], "w string").select("w", term_index.window_key(F.col("w")).alias("key"))
    got = whole.select("i", F.explode("held").alias("key")).join(keys, "key").select("i", "w").collect()
    assert sorted(map(tuple, got)) == sorted((i, w) for i, t in texts for w in terms if t and w and w in t)


def test_campaign_counts_leave_texts_where_they_are(spark, monkeypatch):
    """Neither texts nor pairs of a text and a keyword are stored or shuffled, and passes over few keywords each give the same counts."""
    rng = random.Random(7)
    words = [f"từ{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(k, rng.choice([None, "glx", "cgv"]), " ".join(rng.choice(words) for _ in range(300))) for k in range(300)]
    rules = [(k % 250, rng.choice(words) + " " * (k % 2) + rng.choice(words) * (k % 2), "running", rng.choice([None, "glx"])) for k in range(300)]
    mentions, keywords = spark.createDataFrame(rows, "mention_id long, brand_slug string, content_text string"), spark.createDataFrame(rules, "campaign_id long, keyword string, status string, brand_slug string")
    kept, real = [], classify.stored

    def stored(df, label):
        out = real(df, label)
        kept.append((out.count(), out.columns))
        return out

    monkeypatch.setattr(classify, "stored", stored)
    pairs = classify.campaign_matches(mentions, keywords).groupBy("campaign_id").agg(F.count("*").alias("mentions"))
    want = sorted(map(tuple, pairs.collect()))
    assert sum(n for _, n in want) > 3000
    for size in (4_000_000, 40):
        monkeypatch.setattr(classify, "PASS_KEYWORDS", size)
        kept.clear()
        assert sorted(map(tuple, classify.campaign_counts(mentions, keywords).collect())) == want
        assert max(n for n, _ in kept) <= 300 and not any({"text", "mention_id", "again", "first"} & set(c) for _, c in kept)


def test_campaigns_with_very_many_keywords(spark):
    """100,000 keywords are joined by equal values: no nested loop, and the rows of the list."""
    docs = spark.range(200).select(F.col("id").alias("mention_id"), F.when(F.col("id") % 2 == 0, "glx").alias("brand_slug"), F.concat(F.lit("Xem  phim "), F.sha1(F.col("id").cast("string")), F.lit(" hay")).alias("content_text"))
    keywords = spark.range(100_000).select((F.col("id") % 50).alias("campaign_id"), F.concat(F.lit("#"), F.substring(F.sha1((F.col("id") % 20_000).cast("string")), 3, 12), F.col("id").cast("string").substr(6, 9)).alias("keyword"), F.lit("running").alias("status"), F.when(F.col("id") % 3 == 0, "glx").alias("brand_slug"))
    few = keywords.where("campaign_id < 2").limit(900)
    joined = classify.campaign_matches(docs, keywords)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.count() > 100
    assert sorted(map(tuple, classify.campaign_matches(docs, few).collect())) == sorted(map(tuple, classify.campaign_matches(docs, few, listed=0).collect()))


def test_one_post_with_very_many_updates(spark):
    schema = "post_id long, seq long, content_text string, sentiment string, occurred_at timestamp, permalink string, metadata map<string,string>"
    old = spark.createDataFrame([(1, 0, "old", "positive", None, "l", {"a": "0", "z": "kept"}), (None, 0, "no id", None, None, None, None)], schema)
    new = spark.range(100_000).select(F.lit(1).cast("long").alias("post_id"), F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("content_text"), F.lit(None).cast("string").alias("sentiment"), F.lit(None).cast("timestamp").alias("occurred_at"), F.lit(None).cast("string").alias("permalink"), F.create_map(F.lit("a"), F.col("id").cast("string"), F.concat(F.lit("m"), (F.col("id") % 3).cast("string")), F.when(F.col("id") < 99_000, F.col("id").cast("string"))).alias("metadata"), (F.col("id") % 2 == 0).alias("verified"))
    got = {r["post_id"]: r for r in imports.upsert_mentions(old, new).collect()}
    assert got[1]["content_text"] == "t99999" and got[1]["sentiment"] == "positive" and got[1]["permalink"] == "l"
    assert got[1]["metadata"] == {"a": "99999", "m0": None, "m1": None, "m2": None, "z": "kept"} and got[None]["metadata"] == {}
    assert imports.upsert_mentions(old.limit(0), new.where("not verified")).count() == 0


def test_samples_are_cut_before_the_shuffle(spark):
    rows = spark.range(5000).select("id", F.lit("hello").alias("t"), F.array().cast("array<string>").alias("b"), F.when(F.col("id") % 2 == 0, F.array(F.lit("cgv"))).otherwise(F.array(F.lit("glx"))).alias("a"))
    out = reports.change_examples(rows, F.col("b"), F.col("a"), "id", "t", 7)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        assert len(r["samples"]) == 7 and r["samples"] == sorted(r["samples"]) and r["samples"][0] < 2 and r["mentions"] >= 2500
    assert reports.change_examples(rows.limit(0), F.col("b"), F.col("a"), "id", "t").count() == 0


def test_sketches_of_days_add_up(spark):
    rows = spark.range(40_000).select(F.col("id").alias("mention_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("occurred_at"), F.lit(False).alias("is_spam"), F.concat(F.lit("p"), F.col("id") % 3).alias("platform_code"), F.when(F.col("id") % 10 > 0, (F.col("id") % 9000).cast("string")).alias("author_key"))
    links = rows.select("mention_id", (F.col("mention_id") % 2).alias("brand"))
    daily = metrics.daily_authors(rows, links, ["brand"])
    for r in metrics.authors_over(daily, ["brand"]).collect():
        exact = rows.join(links, "mention_id").where(F.col("brand") == r["brand"]).select(F.count_distinct("author_key")).first()[0]
        assert abs(r["authors"] - exact) <= 0.05 * exact
    assert metrics.authors_over(daily, ["brand"], "2031-01-01").count() == 0
