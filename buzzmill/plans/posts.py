"""Queries of post records out of detail pages, and of kinds of rebuilt mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.functions.text import normal
from buzzmill.operators.classify import rebuild_example
from buzzmill.plans.queries import query
from buzzmill.plans.texts import documents, expected, pick, values
from buzzmill.sources import posts
from buzzmill.sources.tables import table


def _details(spark, sf_dir, html, url):
    """Pages with a site's script put before their source; every fifth detail is stale."""
    p, n = table(spark, sf_dir, "pages"), F.col("page_id").cast("string")
    comment = lambda i, label: F.struct(F.concat(F.lit(f"comment:{i}-"), n).alias("external_id"), F.lit("anna").alias("author"), F.lit(" hay ").alias("text"), F.lit("").alias("created_at"), F.lit(label).alias("created_at_label"), F.lit("").alias("parent_comment_id"))
    crawled = F.array(comment("a", "3h"), comment("b", "")).cast(posts.CRAWLED)
    return p.select("page_id", F.concat(html(n), F.coalesce("html", F.lit(""))).alias("raw_html"), url(n).alias("url"), F.lit("").alias("current_url"), F.lit("2026-09-10T12:00:00Z").alias("crawled_at"), crawled.alias("crawled_comments"), (F.col("page_id") % 5 == 0).alias("stale"), F.lit(None).cast("boolean").alias("coverage"), F.lit("").alias("freshness"))


_COLUMNS = ["post_id", "page_name", "post_url", "created", "post_text", "views", "ids", "times"]


def _told(rows):
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    ids, times = F.transform("comments", lambda c: c["external_id"]), F.transform("comments", lambda c: F.coalesce(at(c["created_at"]), F.lit("-")))
    return rows.select("post_id", "page_name", "post_url", at(F.col("post_created_at")).alias("created"), "post_text", F.col("stats.view_count").alias("views"), F.array_join(ids, ",").alias("ids"), F.array_join(times, ",").alias("times"))


@query(
    """SELECT 'v' || page_id AS post_id, 'owner' AS page_name, 'https://www.tiktok.com/@o/video/' || page_id AS post_url, '2024-09-10 10:00:00' AS created, 'a film' AS post_text, page_id AS views,
  'comment:a-' || page_id || ',comment:b-' || page_id || CASE WHEN page_id % 2 = 0 THEN ',comment:c1' ELSE '' END AS ids, '2026-09-10 09:00:00,-' || CASE WHEN page_id % 2 = 0 THEN ',2024-09-10 10:00:01' ELSE '' END AS times
FROM pages WHERE page_id % 5 <> 0 AND page_id % 3 <> 0"""
)
def tiktok_posts(spark, sf_dir):
    """Even pages hold their item and comments in one place, odd ones in another; every third page has none."""
    item = lambda n: F.concat(F.lit('{"id":"v'), n, F.lit('","desc":" a film ","createTime":"1725962400","author":{"uniqueId":"owner"},"stats":{"playCount":'), n, F.lit("}}"))
    comments = '[{"cid":"c1","text":"x","createTime":1725962401,"user":{"nickname":"b"}},{"text":"no id"}]'
    page = lambda n: F.concat(F.lit('<script id="__UNIVERSAL_DATA_FOR_REHYDRATION__" type="application/json">{"__DEFAULT_SCOPE__":{"webapp.video-detail":{"itemInfo":{"itemStruct":'), item(n), F.lit(f'}},"comments":{comments}}}}}}}</script>'))
    module = lambda n: F.concat(F.lit('<script id="SIGI_STATE">{"ItemModule":{"1":'), item(n), F.lit("}}</script>"))
    html = lambda n: F.when(F.col("page_id") % 3 == 0, "").when(F.col("page_id") % 2 == 0, page(n)).otherwise(module(n))
    return _told(posts.tiktok_posts(_details(spark, sf_dir, html, lambda n: F.concat(F.lit("https://www.tiktok.com/@o/video/"), n, F.lit("?x=1")))))


@query(
    """SELECT 'vid' || (page_id + 100000) AS post_id, CASE WHEN page_id % 3 <> 0 THEN 'channel' END AS page_name, 'https://www.youtube.com/watch?v=vid' || (page_id + 100000) AS post_url, CASE WHEN page_id % 3 <> 0 THEN '2024-09-10 00:00:00' END AS created,
  CASE WHEN page_id % 3 <> 0 THEN 'about {it}' ELSE '' END AS post_text, CASE WHEN page_id % 3 <> 0 THEN page_id END AS views, 'comment:a-' || page_id || ',comment:b-' || page_id AS ids, '2026-09-10 16:00:00,-' AS times FROM pages WHERE page_id % 5 <> 0"""
)
def youtube_posts(spark, sf_dir):
    video = lambda n: F.concat(F.lit("vid"), (F.col("page_id") + 100000).cast("string"))
    page = lambda n: F.concat(F.lit('<script>var ytInitialPlayerResponse = {"videoDetails":{"videoId":"'), video(n), F.lit('","author":"channel","shortDescription":"about {it}","viewCount":"'), n, F.lit('"},"microformat":{"playerMicroformatRenderer":{"publishDate":"2024-09-10"}}};var x = {}</script>'))
    html = lambda n: F.when(F.col("page_id") % 3 == 0, "").otherwise(page(n))
    return _told(posts.youtube_posts(_details(spark, sf_dir, html, lambda n: F.concat(F.lit("https://youtu.be/"), video(n)))))


@query(
    """SELECT CASE WHEN page_id % 2 = 0 THEN 'Sc' || page_id ELSE 'Url' || page_id END AS post_id, CASE page_id % 3 WHEN 0 THEN 'alt' WHEN 1 THEN 'Og Name' ELSE 'owner_' || page_id END AS page_name, CASE page_id % 3 WHEN 0 THEN 'cap' ELSE 'og "text"' END AS post_text,
  CASE page_id % 3 WHEN 0 THEN 7 ELSE 1234 END AS likes, CASE page_id % 3 WHEN 0 THEN 9 ELSE 56 END AS comments, CASE page_id % 3 WHEN 0 THEN '2024-09-10 10:00:00' WHEN 1 THEN '2024-09-10 10:00:01' ELSE '2026-09-08 12:00:00' END AS created,
  CASE WHEN page_id % 4 = 3 THEN 'body: first/2026-09-10 16:00:00' ELSE 'comment:a-' || page_id || ': hay/2026-09-10 16:00:00,comment:b-' || page_id || ': hay/-' END AS told FROM pages WHERE page_id % 5 <> 0"""
)
def instagram_posts(spark, sf_dir):
    """Every third page has data, one a description and times, and one the text's labels alone; every fourth has no crawled comments."""
    k = F.col("page_id") % 3
    data = '<script type="application/ld+json">{"caption":" cap ","author":{"alternateName":"alt"},"uploadDate":"2024-09-10T10:00:00Z","interactionStatistic":[{"interactionType":{"@type":"https://x/LikeAction"},"userInteractionCount":7},{"interactionType":{"@type":"CommentAction"},"userInteractionCount":"9"}]}</script>'
    described = '<meta x property="og:description" content="1,234 likes, 56 comments - o on July 1: &quot;og &quot;text&quot;&quot;">'.replace("&quot;og &quot;text&quot;&quot;", "og &quot;text&quot;")
    og = described + '<meta property="og:title" content="Og Name on Instagram"> "taken_at":1725962500,"taken_at_timestamp":1725962401,"taken_at":12345678901'
    owner = lambda n: F.concat(F.lit(described + ' "owner":{"id":"1","username":"owner_'), n, F.lit('"'))
    code = lambda n: F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(' "shortcode":"Sc'), n, F.lit('" '))).otherwise("")
    html = lambda n: F.concat(F.when(k == 0, F.lit(data)).when(k == 1, F.lit(og)).otherwise(owner(n)), code(n))
    d = _details(spark, sf_dir, html, lambda n: F.concat(F.lit("https://www.instagram.com/p/Url"), n, F.lit("/?x=1")))
    body = F.lit("owner.x\n2d\ncaption here\nanna\n3h\nfirst")
    d = d.withColumn("body_text", body).withColumn("comment_count_observed", F.lit(99)).withColumn("crawled_comments", F.when(F.col("page_id") % 4 == 3, F.array().cast(posts.CRAWLED)).otherwise(F.col("crawled_comments")))
    at = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("-"))
    told = F.array_join(F.transform("comments", lambda c: F.concat(F.when(c["text"] == "first", F.lit("body: ")).otherwise(F.concat(c["external_id"], F.lit(": "))), c["text"], F.lit("/"), at(c["created_at"]))), ",")
    return posts.instagram_posts(d).select("post_id", "page_name", "post_text", F.col("stats.like_count").alias("likes"), F.col("stats.comment_count").alias("comments"), at(F.col("post_created_at")).alias("created"), told.alias("told"))


@query(
    """SELECT CASE page_id % 3 WHEN 0 THEN page_id::VARCHAR WHEN 1 THEN '1a:2b' ELSE 'galaxy_cinema_' || page_id END AS post_id, CASE page_id % 3 WHEN 1 THEN 'galaxy' ELSE 'Galaxy Cinema ' || page_id END AS page_name, 4.5::DOUBLE AS rating, CASE WHEN page_id % 2 = 0 THEN '' ELSE '12 Nguyen Du' END AS address,
  'r1/An/Phòng sạch, ghế tốt/2026-09-10 09:00:00/5.0,r2/Bình/rất hài lòng lắm/2026-09-01 00:00:00/-' AS told FROM pages"""
)
def place_posts(spark, sf_dir):
    """Places by number, by code and by title; a review comes twice, one is too short, and one has no id."""
    p, n, k = table(spark, sf_dir, "pages"), F.col("page_id").cast("string"), F.col("page_id") % 3
    review = lambda i, a, t, at, label, stars: F.struct(F.lit(i).alias("external_id"), F.lit(a).alias("author"), F.lit(t).alias("text"), F.lit(at).alias("created_at"), F.lit(label).alias("created_at_label"), F.lit(stars).alias("rating_label"))
    reviews = F.array(review("r1", "An Local Guide · 3 reviews", "An 3 reviews 3 hours ago Phòng sạch, ghế tốt Like Share", "", "3 hours ago", "5 stars"), review(" r2 ", "Bình", "rất hài lòng lắm …More", "2026-09-01", "", None), review("r1", "x", "another text of it", "", "", ""), review("r3", "x", "short", "", "", ""), review("", "x", "no id but long enough", "", "", ""))
    url = F.when(k == 0, F.concat(F.lit("https://maps.google.com/?cid="), n)).when(k == 1, F.lit("https://www.google.com/maps/place/x/data=!1s0x1a:2b!2")).otherwise("https://www.google.com/maps/place/y")
    title = F.when(k == 1, F.lit("Drag to change")).otherwise(F.concat(F.lit(" Galaxy  Cinema "), n, F.lit(" - Google Maps")))
    title = F.when(k == 2, F.concat(F.lit("Galaxy Cinema "), n)).otherwise(title)
    d = p.select("page_id", url.alias("url"), F.lit("").alias("current_url"), title.alias("title"), F.when(F.col("page_id") % 2 == 0, "click to remove").otherwise("12  Nguyen Du").alias("address"), F.lit("4,5 stars").alias("rating_text"), F.lit(" galaxy ").alias("search_keyword"), F.lit("2026-09-10T12:00:00Z").alias("crawled_at"), reviews.cast(posts.REVIEW).alias("crawled_reviews"))
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    told = F.array_join(F.transform("comments", lambda c: F.concat_ws("/", c["external_id"], c["author"], c["text"], at(c["created_at"]), F.coalesce(c["rating"].cast("string"), F.lit("-")))), ",")
    return posts.place_posts(d).select("post_id", "page_name", "stats.rating", "stats.address", told.alias("told"))


@query("SELECT CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE 'pf' || doc_id END AS id, coalesce(text, '')[1:20] AS first, trim(coalesce(text, '')) AS post_text, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '2026-09-03 10:00:00' END AS latest FROM documents WHERE doc_id % 7 <> 0")
def legacy_posts(spark, sf_dir):
    """Documents as posts with their text; every seventh is of another site, every fourth has comments without a time."""
    d, k = documents(spark, sf_dir), F.col("doc_id")
    c = lambda t, at: F.struct(t.alias("text"), F.when(k % 4 != 0, at).alias("created_at"))
    rows = d.select(F.when(k % 7 == 0, "tiktok").otherwise("facebook").alias("platform"), F.when(k % 2 == 0, F.concat(F.lit("00"), k.cast("string"))).otherwise(F.concat(F.lit("pf"), k.cast("string"))).alias("post_id"), F.lit("p").alias("page_id"), F.lit("n").alias("page_name"), F.col("text").alias("post_text"), F.array(c(F.substring("text", 1, 20), F.lit("2026-09-02")), c(F.lit("x"), F.lit("2026-09-03T10:00:00Z"))).alias("comments"))
    return posts.legacy_posts(rows, "film").select("id", F.get("comments_", F.lit(0)).alias("first"), "post_text", F.date_format("created_at_comment", "yyyy-MM-dd HH:mm:ss").alias("latest"))


# A page's text by lines (| parts them), and the label, text and comments of its post.
THREAD_CASES = [
    ("Thread|parent|2d|quoted words of the parent|owner|07/31/26|·|Tác giả|my post here|12|second line|anna|3h|first comment|4|ben|View activity|1d|second|line", "07/31/26", "my post here", "anna/3h/first comment,ben/1d/second line"),
    ("a b|c d|e f|07/30/26|the post text|Top|anna|5h|hello there", "07/30/26", "the post text", "anna/5h/hello there"), ("owner|13h|only a relative time|1.2K views|x y", "", "only a relative time 1.2K views x y", ""),
    ("one|two", None, None, None), ("a b|c d|e f|For you|New thread", None, None, None), ("owner|2d|For you|x y|q r|anna|1h|a comment of hers", "", "x y q r", "anna/1h/a comment of hers"),
]


@query(
    f"""SELECT page_id, 'C' || page_id AS post_id, label, post_text, comments, CASE WHEN page_id % 2 = 0 THEN page_id END AS likes, CASE WHEN page_id % 2 = 0 THEN 7 END AS replies, CASE WHEN k = 2 THEN 1200 WHEN page_id % 2 = 0 THEN 99 END AS views
FROM pages JOIN {values([c[1:] for c in THREAD_CASES], "label", "post_text", "comments")} ON k = page_id % {len(THREAD_CASES)} WHERE label IS NOT NULL AND page_id % 5 <> 0"""
)
def threads_posts(spark, sf_dir):
    n = F.col("page_id").cast("string")
    code = lambda n: F.concat(F.lit('{"code":"other","like_count":1} {"code":"C'), n, F.lit('","like_count":'), n, F.lit(',"fbid":"77'), n, F.lit('"} XDTTextPostAppMediaInfo:77'), n, F.lit(' {"direct_reply_count":7,"repost_count":3,"impression_count":99} '))
    html = lambda n: F.when(F.col("page_id") % 2 == 0, code(n)).otherwise("")
    d = _details(spark, sf_dir, html, lambda n: F.lit("x")).withColumn("raw_html", html(n))
    d = d.withColumn("current_url", F.concat(F.lit("https://www.threads.net/@owner/post/C"), n, F.lit("?x"))).withColumn("linked_threads", F.array().cast("array<string>")).withColumn("body_text", F.translate(pick(THREAD_CASES, 0, "page_id"), "|", "\n"))
    told = F.array_join(F.transform("comments", lambda c: F.concat_ws("/", c["author"], c["created_at"], c["text"])), ",")
    out = posts.threads_posts(d)
    return out.select(F.substring("post_id", 2, 20).cast("long").alias("page_id"), "post_id", F.col("post_created_at").alias("label"), "post_text", told.alias("comments"), F.col("stats.like_count").alias("likes"), F.col("stats.comment_count").alias("replies"), F.col("stats.view_count").alias("views"))


EXAMPLES = [
    ("cgv", "", "CGV Korea", "stale_cgv_korea_foreign_removed"), ("glx", "", "hello", "keyword_only_false_positive_removed"), ("glx", "", "galaxy cinema jaipur", "unrelated_or_stale_untagged"), ("", "cgv", "CGV Menas Mall", "valid_cgv_menas_mall_remains"),
    ("cgv", "cgv", "cgv liberty citypoint", "valid_cgv_liberty_citypoint_remains"), ("cgv", "cgv", "cgv hà nội", "valid_cgv_vietnam_remains"), ("lotte", "lotte", "lotte cinema vietnam", "valid_lotte_vietnam_remains"), ("glx", "glx", "rạp galaxy", "valid_galaxy_vietnam_remains"),
    ("bhd", "beta", "x", "brand_replacement"), ("bhd", "bhd", "x", "unchanged_tagged"), ("", "bhd", "x", None), ("", "", "x", None),
]


@query(expected(EXAMPLES, "example"))
def rebuild_examples(spark, sf_dir):
    sets = lambda k: F.filter(F.split(pick(EXAMPLES, k), ","), lambda x: x != "")
    return documents(spark, sf_dir).select("doc_id", rebuild_example(sets(0), sets(1), pick(EXAMPLES, 2), F.lit("")).alias("example"))


NORMAL_CASES = [("Muà  ĐỎ\n", "muà đỏ"), ("Straße", "strasse"), ("  ", ""), ("Tĩn", "tĩn")]


@query(f"SELECT doc_id, label || ' ' || 'x' AS normal FROM documents JOIN {values([c[1:] for c in NORMAL_CASES], 'label')} ON k = doc_id % {len(NORMAL_CASES)}".replace("label || ' ' || 'x'", "trim(label || ' x')"))
def normal_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", normal(F.concat(pick(NORMAL_CASES, 0), F.lit(" X "))).alias("normal"))
