"""Queries of labels, numbers, maps, identifiers and addresses: each row gets a label of known meaning by its id."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.functions import records as R
from buzzmill.functions import times as D
from buzzmill.plans.queries import query
from buzzmill.plans.texts import documents, expected, pick, values
from buzzmill.sources.tables import table



def now():
    """The reference time of all cases."""
    return F.lit("2026-09-10 12:00:00").cast("timestamp")


TIME_CASES = [
    ("2026-09-01T10:00:00Z", "2026-09-01 10:00:00"), ("2026-09-01T10:00:00+07:00", "2026-09-01 10:00:00"), ("2026-08-05", "2026-08-05 00:00:00"), ("07/31/26", "2026-07-31 00:00:00"), ("31/07/2026", "2026-07-31 00:00:00"),
    ("05/08/26", "2026-05-08 00:00:00"), ("Aug 5, 2026", "2026-08-05 00:00:00"), ("5 Aug 2026", "2026-08-05 00:00:00"), ("posted 07/31/2026 by x", "2026-07-31 00:00:00"), ("13h", "2026-09-09 23:00:00"),
    ("3 giờ trước", "2026-09-10 09:00:00"), ("khoảng 3 giờ trước", "2026-09-10 09:00:00"), ("Edited 3 days ago", "2026-09-07 12:00:00"), ("một tháng trước", "2026-08-11 12:00:00"), ("a year ago", "2025-09-10 12:00:00"),
    ("2 tuần trước", "2026-08-27 12:00:00"), ("45m", "2026-09-10 11:15:00"), ("2 d", "2026-09-08 12:00:00"), ("19 tháng 7 lúc 10:10", "2026-07-19 10:10:00"), ("19 tháng 12 lúc 10:10", "2025-12-19 10:10:00"),
    ("19 thg 7, 2024 lúc 8:05", "2024-07-19 08:05:00"), ("July 19 at 10:10 PM", "2026-07-19 22:10:00"), ("December 1, 2024 at 12:05 AM", "2024-12-01 00:05:00"), ("31 tháng 2", None), ("13:45", None), ("hello", None), ("", None), ("12", None),
]


@query(expected(TIME_CASES, "told").replace("label AS", "CAST(label AS TIMESTAMP) AS"))
def label_times(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", D.parse_time(pick(TIME_CASES, 0), now()).cast("timestamp_ntz").alias("told"))


RELATIVE_CASES = [("13h", True), ("2 d", True), ("5W", True), ("13 hours", False), ("3 giờ trước", False), ("", False), ("12", False)]


@query(f"SELECT doc_id, label = 'True' AS crumb FROM documents JOIN {values([(str(c[1]),) for c in RELATIVE_CASES], 'label')} ON k = doc_id % {len(RELATIVE_CASES)}")
def relative_only(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", D.is_relative_only(pick(RELATIVE_CASES, 0)).alias("crumb"))


MEDIA_CASES = [("8 giờ trước", "2026-09-10 11:00:00"), ("August 5, 2026", "2026-08-05 00:00:00"), ("Aug 5, 2026", "2026-08-05 00:00:00"), ("5 August 2026", "2026-08-20 00:00:00"), ("05/08/2026", "2026-08-05 00:00:00"), ("08/25/2026", "2026-08-25 00:00:00"), ("10 tháng 9 lúc 20:30", "2026-09-10 20:30:00"), ("10 tháng 9 lúc 21:30", "2025-09-10 21:30:00"), ("soon", None)]


@query(expected(MEDIA_CASES, "told").replace("label AS", "CAST(label AS TIMESTAMP) AS"))
def media_dates(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", D.media_date(pick(MEDIA_CASES, 0), now()).cast("timestamp_ntz").alias("told"))


OCCURRED_CASES = [
    ("2026-09-01", "", "x", "2026-09-01 00:00:00", "parsed"), ("13h", "", "x", None, "crawl_fallback"), ("13h", "2026-09-01", "x", "2026-09-01 00:00:00", "relative_unverified"), ("", "", "seen 07/31/26 here", "2026-07-31 00:00:00", "parsed"),
    ("", "", "anna 3h reply", "2026-09-10 09:00:00", "parsed"), ("on 07/31/2026", "", "", "2026-07-31 00:00:00", "parsed"), ("", "", "", None, "crawl_fallback"), ("13h", "", "anna 2 ngày trước", "2026-09-08 12:00:00", "relative_unverified"),
]


@query(f"SELECT doc_id, CAST(told AS TIMESTAMP) AS occurred_at, date_source FROM documents JOIN {values([c[3:] for c in OCCURRED_CASES], 'told', 'date_source')} ON k = doc_id % {len(OCCURRED_CASES)}")
def post_occurred_at(spark, sf_dir):
    o = D.occurred_at([pick(OCCURRED_CASES, 0), pick(OCCURRED_CASES, 1)], pick(OCCURRED_CASES, 2), now())
    return documents(spark, sf_dir).withColumn("o", o).select("doc_id", F.col("o.at").cast("timestamp_ntz").alias("occurred_at"), "o.date_source")


COMMENT_CASES = [("2d", "2026-09-01", "x", "2026-09-08 12:00:00", "parsed"), ("", "2026-09-01", "x", "2026-09-01 00:00:00", "post_inferred"), ("?", "?", "on 07/31/26", "2026-07-31 00:00:00", "parsed"), (None, None, None, None, "crawl_fallback")]


@query(f"SELECT doc_id, CAST(told AS TIMESTAMP) AS occurred_at, date_source FROM documents JOIN {values([c[3:] for c in COMMENT_CASES], 'told', 'date_source')} ON k = doc_id % {len(COMMENT_CASES)}")
def comment_occurred_at(spark, sf_dir):
    o = D.comment_occurred_at(*[pick(COMMENT_CASES, k).cast("string") for k in range(3)], now())
    return documents(spark, sf_dir).withColumn("o", o).select("doc_id", F.col("o.at").cast("timestamp_ntz").alias("occurred_at"), "o.date_source")


COUNT_CASES = [
    ("1,367", 1367), ("1.2K", 1200), ("1.229.143", 1229143), ("1,5", 2), ("10.7K likes", 10700), ("-3", None), ("", None), ("3 bình luận", 3), ("12 members", 12), ("5 minutes", 5), ("12Karat", None), ("1,367K", 1367000),
    ("1.367", 1), ("1,367.5", 1368), ("1.367,5", 1368), ("2M", 2000000), ("1b", 1000000000), ("113", 113), ("2.5", 2), (" 7 ", 7), ("likes 7", None), ("1,2,3", 123),
]


@query(expected(COUNT_CASES, "n").replace("label AS", "CAST(label AS BIGINT) AS"))
def compact_counts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", D.compact_count(pick(COUNT_CASES, 0)).alias("n"))


RATING_CASES = [("4,5 sao", "4.5"), ("5", "5"), ("rated 3.0 of 5", "3"), ("none", None), (None, None)]


@query(f"SELECT doc_id, CAST(label AS DOUBLE) AS rating, CASE WHEN label::DOUBLE >= 4 THEN 'positive' WHEN label::DOUBLE <= 2 THEN 'negative' WHEN label IS NOT NULL THEN 'neutral' END AS sentiment FROM documents JOIN {values([c[1:] for c in RATING_CASES], 'label')} ON k = doc_id % {len(RATING_CASES)}")
def star_ratings(spark, sf_dir):
    stars = D.rating(pick(RATING_CASES, 0).cast("string"))
    return documents(spark, sf_dir).select("doc_id", stars.alias("rating"), D.star_sentiment(stars).alias("sentiment"))


@query("SELECT event_id, CASE WHEN regexp_matches(v, '^-?[0-9]+$') THEN v::BIGINT END AS n, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN 0 END, 0), event_id) AS first FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN '-' || event_id ELSE event_id || '.5' END AS v FROM events)")
def strict_numbers(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", F.expr("case event_id % 3 when 0 then string(event_id) when 1 then '-' || event_id else event_id || '.5' end"))
    return e.select("event_id", D.strict_int(F.col("v")).alias("n"), D.first_count(F.when(F.col("event_id") % 3 == 0, 0).cast("long"), F.col("event_id"), skip_zero=True).alias("first"))


HTML_CASES = [
    ('{"createTime":"1725962400","x":1}', "2024-09-10 10:00:00"), ('{"taken_at":1725962400000}', "2024-09-10 10:00:00"), ('"create_time" : 1725962400 "createTime":1', "2024-09-10 10:00:00"),
    ('"datePublished":"2024-09-10T10:00:00Z"', "2024-09-10 10:00:00"), ("none", None), ('"taken_at": 1725900000, "taken_at_timestamp":"1725962400"', "2024-09-10 10:00:00"), ('"published_time": 1725962400 "datePublished":"2020-01-01"', "2024-09-10 10:00:00"),
    ('"uploadDate":"2024-09-10T17:00:00+07:00"', "2024-09-10 10:00:00"), ('"datePublished":"soon" "uploadDate":"2024-09-10T10:00:00"', "2024-09-10 10:00:00"), ('"createTime":"0000000000", "taken_at":1725962400', "2024-09-10 10:00:00"),
]


@query(f"SELECT page_id, CAST(label AS TIMESTAMP) AS created FROM pages JOIN {values([c[1:] for c in HTML_CASES], 'label')} ON k = page_id % {len(HTML_CASES)}")
def html_created(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    html = F.concat(F.coalesce("html", F.lit("")), F.lit("<script>"), pick(HTML_CASES, 0, "page_id"), F.lit("</script>"))
    return p.select("page_id", D.created_in_html(html).cast("timestamp_ntz").alias("created"))


@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN NULL ELSE make_timestamp((1700000000 + least(page_id, 1000)) * 1000000) END AS earliest FROM pages")
def html_earliest(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    parts = F.array(F.lit(5000000000), F.lit(1700000000) + F.col("page_id"), F.lit(1700001000), F.lit(999999999))
    told = F.array_join(F.transform(parts, lambda x: F.concat(F.lit('"taken_at":'), x.cast("string"))), ", ")
    html = F.concat(F.coalesce("html", F.lit("")), F.when(F.col("page_id") % 4 == 0, "").otherwise(told))
    return p.select("page_id", D.earliest_in_html(html, "taken_at").cast("timestamp_ntz").alias("earliest"))


@query(
    """WITH f AS (SELECT o_orderkey AS film_id, o_orderdate::DATE AS r, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE - 40 END AS t, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate::DATE - 3 END AS p FROM orders WHERE o_orderkey % 7 <> 0)
SELECT film_id, u.kind, u.day, u.n AS sort_order FROM f, LATERAL (VALUES ('announcement', (coalesce(t, r - 45) - 14)::DATE, 1), ('trailer', coalesce(t, r - 45)::DATE, 2), ('press_sneak', coalesce(p, r - 1)::DATE, 3), ('premiere', r, 4), ('w1_decay', (r + 5)::DATE, 5)) AS u(kind, day, n)"""
)
def film_milestones(spark, sf_dir):
    """Films without a release (every seventh) have no milestones."""
    o, day = table(spark, sf_dir, "orders"), F.to_date("o_orderdate")
    release = F.when(F.col("o_orderkey") % 7 != 0, day)
    rows = D.milestones(release, F.when(F.col("o_orderkey") % 3 == 0, F.date_add(day, -40)), F.when(F.col("o_orderkey") % 5 == 0, F.date_add(day, -3)))
    return o.select(F.col("o_orderkey").alias("film_id"), F.inline(rows))


DATES_CASES = [
    ("khởi chiếu 12/9/2026 và 12.09.2026, rồi 3-10-2027", "2026-09-12,2026-09-12,2027-10-03"), ("ngày 5 tháng 11 2026", "2026-11-05"), ("2026-09-12", ""), ("31/2/2026, 1/1/2020", ""), ("không có", ""),
    ("July 24, 2026 then 1/2/2026, Sept. 3 2027 and may 1 2025", "2026-02-01,2026-07-24,2027-09-03,2025-05-01"), ("4 THÁNG 7, 2026; 4 thang 7 2026", "2026-07-04,2026-07-04"), ("February 30, 2026 Aug 7 2026x 112/9/2026", ""),
]


@query(expected(DATES_CASES, "dates"))
def text_dates(spark, sf_dir):
    found = D.dates_in(F.concat_ws(" ", pick(DATES_CASES, 0), "text"), 2024, 2029)
    return documents(spark, sf_dir).select("doc_id", F.array_join(F.transform(found, lambda d: d.cast("string")), ",").alias("dates"))


@query("SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || ((s // 60) % 60) || 'm' END AS duration FROM (SELECT event_id, (event_id * 37) % 20000 AS s FROM events)")
def durations(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", D.duration((F.col("event_id") * 37) % 20000).alias("duration"))


@query("SELECT event_id, CASE WHEN abs(d) > 2 THEN ts + to_seconds(d) END AS kept FROM (SELECT event_id, ts, (event_id % 9 - 4)::INT AS d FROM events)")
def crawl_clock(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("d", (F.col("event_id") % 9 - 4).cast("int"))
    return e.select("event_id", D.not_crawl_clock(F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, d)"), F.col("ts")).alias("kept"))


@query("""SELECT event_id, 'a' || event_id AS a, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'old' END AS b, CASE WHEN event_id % 2 = 0 THEN 'c' END AS c, 'seen' AS state, 3 + (event_id % 2 = 0)::INT AS keys FROM events""")
def metadata_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    old = F.create_map(F.lit("a"), F.concat(F.lit("a"), F.col("event_id").cast("string")), F.lit("b"), F.lit("old"))
    new = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("b"), F.lit("new"), F.lit("c"), F.lit("c")))
    m = e.select("event_id", R.with_key(R.with_key(R.merge_maps(old, new), "state", F.lit("seen")), "state", F.lit("seen")).alias("m"))
    return m.select("event_id", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("a", "b", "c", "state")], F.size("m").alias("keys"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey % 7)::INT END AS ones, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 0 END AS fives, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 5 END AS bins FROM customer")
def rating_histogram(spark, sf_dir):
    k = F.col("c_custkey")
    counts = F.when(k % 4 == 0, F.array(k, k)).otherwise(F.array(k % 7, k, k, k, F.lit(None).cast("long")))
    c = table(spark, sf_dir, "customer").select("c_custkey", R.histogram(counts).alias("h"))
    return c.select("c_custkey", F.try_element_at("h", F.lit("1")).alias("ones"), F.try_element_at("h", F.lit("5")).alias("fives"), F.size("h").alias("bins"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id END AS id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'it''s' END AS name FROM pages")
def script_records(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    script = F.concat(F.lit('<SCRIPT type="a/b" id="DATA">\n{"id": '), F.col("page_id").cast("string"), F.lit(', "name": "it\'s"}\n</script>'))
    html = F.concat(F.when(F.col("page_id") % 3 == 0, "").otherwise(script), F.coalesce("html", F.lit("")))
    j = R.script_json(html, 'id="DATA"')
    return p.select("page_id", F.get_json_object(j, "$.id").try_cast("long").alias("id"), F.get_json_object(j, "$.name").alias("name"))


@query("SELECT page_id, substr(sha1(coalesce(url, '') || '|' || page_id), 1, 24) AS stable_id, substr(sha1('{\"page_id\":' || page_id || '}'), 1, 20) AS record_id FROM pages")
def stable_ids(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", R.hash_id(F.col("url"), F.col("page_id").cast("string")).alias("stable_id"), R.record_id(F.struct("page_id")).alias("record_id"))


@query("SELECT c_custkey, c_custkey::VARCHAR AS id, c_name || '_x' AS name, regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '-', 'g') || '-d' AS slug FROM customer")
def page_context(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    ctx = R.id_and_name(F.concat_ws("_", F.col("c_custkey").cast("string"), "c_name", F.lit("x")))
    return c.withColumn("p", ctx).select("c_custkey", "p.id", "p.name", R.dashed_slug(F.concat("c_mktsegment", F.lit(" - Đ!"))).alias("slug"))


URL_CASES = [
    ("https://www.tiktok.com/@a/video/123?x=1", "tiktok", "123", "https://www.tiktok.com/@a/video/123"), ("https://youtu.be/abcDEF123?t=1", "youtube", "abcDEF123", "https://www.youtube.com/watch?v=abcDEF123"),
    ("https://m.youtube.com/watch?app=1&v=abcDEF123", "youtube", "abcDEF123", "https://www.youtube.com/watch?v=abcDEF123"), ("https://www.instagram.com/reel/Ab_-1/", "instagram", "Ab_-1", "https://www.instagram.com/reel/Ab_-1"),
    ("https://www.threads.net/@b/post/Cd9", "threads", "Cd9", "https://www.threads.net/@b/post/Cd9"), ("https://www.facebook.com/p/posts/pfbid0A?y#z", "facebook", "pfbid0A", "https://www.facebook.com/p/posts/pfbid0A"),
    ("https://example.com/tiktok.com/video/9", None, None, "https://example.com/tiktok.com/video/9"),
]


@query(f"SELECT doc_id, platform, post_id, post_url FROM documents JOIN {values([c[1:] for c in URL_CASES], 'platform', 'post_id', 'post_url')} ON k = doc_id % {len(URL_CASES)}")
def post_addresses(spark, sf_dir):
    u = pick(URL_CASES, 0)
    return documents(spark, sf_dir).select("doc_id", R.platform_of(u).alias("platform"), R.post_id(u).alias("post_id"), R.post_url(u).alias("post_url"))


ESCAPED_CASES = [(r"a\nb", "a\nb"), (r"caf\u00e9", "café"), ('say "x"', 'say "x"'), (r"bad \q", r"bad \q"), (r"a \"b\" c", 'a "b" c')]


@query(expected(ESCAPED_CASES, "clean"))
def unescaped_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", R.unescaped(pick(ESCAPED_CASES, 0)).alias("clean"))


PATH_CASES = [("/data/processed/the_odyssey/tiktok/a.json", "the_odyssey"), ("/data/processed/default_film/a.json", None), ("C:\\d\\processed\\minion\\a.json", "minion"), ("/data/raw/a.json", None)]


@query(expected(PATH_CASES, "slug"))
def film_folders(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", R.folder_slug(pick(PATH_CASES, 0)).alias("slug"))
