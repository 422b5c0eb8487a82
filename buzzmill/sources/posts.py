"""Post records out of crawled detail pages of four sites, in one schema; and the older record of a fifth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.cleaning import compact, engagement_prefix, place_author, place_chrome, place_review, place_title, safe_identifier
from buzzmill.functions.pages import balanced_json, counts_near, instagram_comments, thread_page, views_of
from buzzmill.functions.records import post_id, post_url, script_json
from buzzmill.functions.text import first_text, let
from buzzmill.functions.times import ZONE, comment_time, compact_count, content_time, media_date, not_crawl_clock, rating, relative
from buzzmill.operators.crawl import without_stale
from buzzmill.operators.tables import merge_first

COMMENT = "struct<external_id:string,author:string,text:string,created_at:timestamp,url:string,parent_comment_id:string>"
# Where the pages hold what.
TIKTOK_SCRIPTS = ('id="__UNIVERSAL_DATA_FOR_REHYDRATION__"', 'id="SIGI_STATE"')
TIKTOK_DETAIL = "$['__DEFAULT_SCOPE__']['webapp.video-detail']"
TIKTOK_ITEM = "id string, desc string, createTime string, author struct<id:string,uniqueId:string,nickname:string>, stats struct<diggCount:bigint,commentCount:bigint,playCount:bigint,shareCount:bigint>"
TIKTOK_COMMENT = "struct<cid:string,id:string,text:string,createTime:string,reply_id:string,reply_comment_id:string,user:struct<unique_id:string,nickname:string,uid:string>>"
CRAWLED = "array<struct<external_id:string,author:string,text:string,created_at:string,created_at_label:string,parent_comment_id:string>>"


def _address(url: Column, comment: Column) -> Column:
    return F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit("comment_id="), F.regexp_replace(comment, "^comment:", ""))


def _crawled(platform: str, raw: Column, url: Column, crawled_at: Column, posted: Column) -> Column:
    """Comments (CRAWLED) with an id and text; times by comment_time."""
    kept = F.filter(F.coalesce(raw, F.array().cast(CRAWLED)), lambda c: (F.coalesce(F.trim(c["external_id"]), F.lit("")) != "") & (F.coalesce(F.trim(c["text"]), F.lit("")) != ""))
    at = lambda c: comment_time(F.lit(platform), c["created_at"], c["created_at_label"], crawled_at, posted)
    row = lambda c: F.struct(c["external_id"].alias("external_id"), F.coalesce(c["author"], F.lit("")).alias("author"), F.trim(c["text"]).alias("text"), at(c).alias("created_at"), _address(url, c["external_id"]).alias("url"), F.coalesce(c["parent_comment_id"], F.lit("")).alias("parent_comment_id"))
    return F.transform(kept, row)


def tiktok_posts(details: DataFrame) -> DataFrame:
    """Posts of details (url, current_url, raw_html, crawled_at, crawled_comments, stale, coverage, freshness).

    The item is that of the page's data, or the first of its module of items; pages without one give no post. Crawled
    comments come first, then those of the page, each id once. Stale and uncovered details give none.
    """
    url = post_url(first_text(F.col("current_url"), F.col("url")))
    rows = without_stale(details).withColumn("_url", url).withColumn("_data", F.coalesce(*[script_json(F.col("raw_html"), m) for m in TIKTOK_SCRIPTS]))
    module = F.map_values(F.from_json(F.get_json_object("_data", "$.ItemModule"), "map<string,string>"))
    item = F.coalesce(F.get_json_object("_data", f"{TIKTOK_DETAIL}.itemInfo.itemStruct"), F.get(module, F.lit(0)))
    rows = rows.withColumn("_item", F.from_json(item, TIKTOK_ITEM)).where(item.isNotNull())
    listed = F.filter(F.coalesce(F.from_json(F.get_json_object("_data", f"{TIKTOK_DETAIL}.comments"), f"array<{TIKTOK_COMMENT}>"), F.array().cast(f"array<{TIKTOK_COMMENT}>")), lambda c: first_text(c["cid"], c["id"]).isNotNull())
    own = lambda c: F.concat(F.lit("comment:"), first_text(c["cid"], c["id"]))
    row = lambda c: F.struct(own(c).alias("external_id"), F.coalesce(first_text(c["user"]["unique_id"], c["user"]["nickname"], c["user"]["uid"]), F.lit("")).alias("author"), F.trim(c["text"]).alias("text"), content_time(c["createTime"]).alias("created_at"), _address(F.col("_url"), own(c)).alias("url"), F.coalesce(first_text(c["reply_id"], c["reply_comment_id"]), F.lit("")).alias("parent_comment_id"))
    crawled = _crawled("tiktok", F.col("crawled_comments"), F.col("_url"), content_time(F.col("crawled_at")), content_time(F.col("_item.createTime")))
    comments = let(F.struct(crawled.cast(f"array<{COMMENT}>").alias("a"), F.transform(listed, row).cast(f"array<{COMMENT}>").alias("b")), lambda x: merge_first(x["a"], x["b"], "external_id"))
    stats = F.col("_item.stats")
    counts = F.struct(stats["diggCount"].alias("like_count"), stats["commentCount"].alias("comment_count"), stats["playCount"].alias("view_count"), stats["shareCount"].alias("share_count"))
    return rows.select(F.lit("tiktok").alias("platform"), F.coalesce("_item.id", post_id(F.col("_url"))).alias("post_id"), F.col("_item.author.id").alias("page_id"), first_text(F.col("_item.author.uniqueId"), F.col("_item.author.nickname")).alias("page_name"), F.col("_url").alias("post_url"), content_time(F.col("_item.createTime")).alias("post_created_at"), F.trim(F.coalesce("_item.desc", F.lit(""))).alias("post_text"), counts.alias("stats"), comments.alias("comments"))


def youtube_posts(details: DataFrame) -> DataFrame:
    """Posts of details as for tiktok_posts, from the player's object in the page; comments are the crawled ones."""
    url = post_url(first_text(F.col("current_url"), F.col("url")))
    rows = without_stale(details).withColumn("_url", url).withColumn("_data", balanced_json(F.col("raw_html"), "ytInitialPlayerResponse"))
    get = lambda path: F.get_json_object("_data", path)
    micro = "$.microformat.playerMicroformatRenderer"
    video, text = F.coalesce(get("$.videoDetails.videoId"), post_id(F.col("_url"))), first_text(get("$.videoDetails.shortDescription"), get(f"{micro}.description.simpleText"), get("$.videoDetails.title"))
    counts = F.struct(F.lit(None).cast("bigint").alias("like_count"), F.lit(None).cast("bigint").alias("comment_count"), compact_count(get("$.videoDetails.viewCount")).alias("view_count"), F.lit(None).cast("bigint").alias("share_count"))
    at = content_time(F.coalesce(get(f"{micro}.publishDate"), get(f"{micro}.uploadDate")))
    comments = _crawled("youtube", F.col("crawled_comments"), F.col("_url"), content_time(F.col("crawled_at")), at).cast(f"array<{COMMENT}>")
    return rows.where(video.isNotNull()).select(F.lit("youtube").alias("platform"), video.alias("post_id"), get("$.videoDetails.channelId").alias("page_id"), get("$.videoDetails.author").alias("page_name"), F.col("_url").alias("post_url"), at.alias("post_created_at"), F.coalesce(text, F.lit("")).alias("post_text"), counts.alias("stats"), comments.alias("comments"))


# Where a page of the third site holds what; keys of times, of which the earliest is the post's.
INSTAGRAM_JSON = r'(?s)<script type="application/ld\+json">(\{.*?\})</script>'
INSTAGRAM_TIMES = (r'"taken_at_timestamp"\s*:\s*(\d{9,12})', r'"taken_at"\s*:\s*(\d{9,12})', r'"caption"\s*:\s*\{[^{}]*?"created_at"\s*:\s*(\d{9,12})', r'"date_published"\s*:\s*(\d{9,12})')
INSTAGRAM_LD = "caption string, description string, uploadDate string, author struct<alternateName:string>, interactionStatistic array<struct<interactionType:struct<`@type`:string>,userInteractionCount:string>>"
INSTAGRAM_DATE = r"(?i)((?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\s+\d{1,2},?\s+\d{4})"
INSTAGRAM_AGO = r"(?iu)\b(\d+\s*[smhdwy]|just\s+now|\d+\s*(?:second|minute|hour|day|week|month|year)s?\s*ago|\d+\s*(?:giây|phút|giờ|ngày|tuần|tháng|năm)\s*trước)\b"
PLAUSIBLE_TIMES = (1_000_000_000, 4_000_000_000)
HEAD_LINES = 12


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


def _meta(html: Column, name: str) -> Column:
    return _found(html, rf'(?i)<meta[^>]+property="{name}"[^>]+content="([^"]*)"')


def instagram_posts(details: DataFrame) -> DataFrame:
    """Posts of details as for tiktok_posts, with body_text and comment_count_observed.

    The caption is that of the page's data, else of its description, without its counts, which fill in for missing ones; then those
    observed. The time is the data's, else the earliest plausible one of the page, else a date of the text, none of which is the
    crawl's own clock; else a label among the text's first lines, counted from the crawl. Comments are the crawled ones, else those
    of the text, each at its own time, else its label's, else at none.
    """
    url = post_url(first_text(F.col("current_url"), F.col("url")))
    rows = without_stale(details).withColumn("_url", url).withColumn("_ld", F.from_json(_found(F.col("raw_html"), INSTAGRAM_JSON), INSTAGRAM_LD))
    html, crawled, body = F.col("raw_html"), content_time(F.col("crawled_at")), F.coalesce("body_text", F.lit(""))
    told = first_text(F.trim(F.coalesce("_ld.caption", "_ld.description")), F.trim(_meta(html, "og:description")))
    rows = rows.withColumn("_e", engagement_prefix(told))
    described = F.coalesce(_meta(html, "og:description"), told)
    counted = lambda k: compact_count(_found(described, r"(?i)([\d.,]+)\s*likes?,\s*([\d.,]+)\s*comments?", k))
    stated = lambda kind: F.get(F.filter(F.coalesce("_ld.interactionStatistic", F.array().cast("array<struct<interactionType:struct<`@type`:string>,userInteractionCount:string>>")), lambda x: x["interactionType"]["@type"].endswith(kind)), F.lit(0))["userInteractionCount"].try_cast("long")
    likes = F.coalesce(stated("LikeAction"), counted(1), F.col("_e.likes"))
    comments_count = F.coalesce(stated("CommentAction"), counted(2), F.col("_e.comments"), F.col("comment_count_observed").try_cast("long"))
    times = F.flatten(F.array(*[F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(p), F.lit(1)), lambda x: x.try_cast("long")) for p in INSTAGRAM_TIMES]))
    earliest = F.array_min(F.filter(times, lambda x: x.between(*PLAUSIBLE_TIMES)))
    own = F.coalesce(content_time(F.nullif(F.trim("_ld.uploadDate"), F.lit(""))), F.timestamp_seconds(earliest))
    written = F.to_timestamp(F.to_date(F.try_to_timestamp(F.regexp_replace(_found(body, INSTAGRAM_DATE), r"(?i)^(\w{3})\w*\s+(\d{1,2}),?\s+(\d{4})$", "$1 $2 $3"), F.lit("MMM d yyyy"))))
    head = F.array_join(F.slice(F.split(body, "\n"), 1, HEAD_LINES), "\n")
    label = _found(head, INSTAGRAM_AGO)
    anchored = F.when(crawled.isNotNull(), F.coalesce(relative(label, crawled), F.to_utc_timestamp(media_date(label, crawled), ZONE)))
    at = F.coalesce(not_crawl_clock(own, crawled), not_crawl_clock(written, crawled), anchored)
    code = F.coalesce(_found(html, r'"shortcode":"([^"]+)"'), post_id(F.col("_url")))
    owner = r'"owner":\{"id":"([^"]+)","username":"([^"]+)"'
    name = first_text(F.trim("_ld.author.alternateName"), F.trim(F.substring_index(_meta(html, "og:title"), " on Instagram", 1)), _found(html, owner, 2))
    rows = rows.withColumn("_at", at).withColumn("_own", instagram_comments(F.col("body_text"), F.col("_url")))
    kept = lambda c: (F.coalesce(F.trim(c["external_id"]), F.lit("")) != "") & (F.coalesce(F.trim(c["text"]), F.lit("")) != "")
    when = lambda given, told: comment_time(F.lit("instagram"), given, told, crawled, F.col("_at"))
    address = lambda c: F.concat(F.col("_url"), F.lit("#comment-"), F.regexp_replace(c["external_id"], "^comment:", ""))
    listed = F.filter(F.coalesce("crawled_comments", F.array().cast(CRAWLED)), kept)
    from_list = F.transform(listed, lambda c: F.struct(c["external_id"].alias("external_id"), F.coalesce(F.trim(c["author"]), F.lit("")).alias("author"), F.trim(c["text"]).alias("text"), when(c["created_at"], c["created_at_label"]).alias("created_at"), address(c).alias("url"), F.coalesce(c["parent_comment_id"], F.lit("")).alias("parent_comment_id")))
    from_text = F.transform(F.filter("_own", kept), lambda c: F.struct(c["external_id"].alias("external_id"), c["author"].alias("author"), c["text"].alias("text"), when(F.lit(None).cast("string"), c["created_at_label"]).alias("created_at"), c["url"].alias("url"), F.lit("").alias("parent_comment_id")))
    comments = F.when(F.size(F.coalesce("crawled_comments", F.array().cast(CRAWLED))) > 0, from_list.cast(f"array<{COMMENT}>")).otherwise(from_text.cast(f"array<{COMMENT}>"))
    counts = F.struct(likes.alias("like_count"), comments_count.alias("comment_count"), F.lit(None).cast("bigint").alias("view_count"), F.lit(None).cast("bigint").alias("share_count"))
    return rows.where(code.isNotNull()).select(F.lit("instagram").alias("platform"), code.alias("post_id"), F.coalesce(_found(html, owner), F.lit("")).alias("page_id"), F.coalesce(name, F.lit("")).alias("page_name"), F.col("_url").alias("post_url"), F.col("_at").alias("post_created_at"), F.coalesce("_e.text", F.lit("")).alias("post_text"), counts.alias("stats"), comments.alias("comments"))


# A thread's address, and where its page holds the counts of a post.
THREAD_URL = r"https://www\.threads\.(?:net|com)/@[^/]+/post/[^/?#]+"
THREAD_OWNER, THREAD_CODE = r"https://www\.threads\.(?:net|com)/@([^/]+)/post/", r"/post/([^/?#]+)"
THREAD_COUNTS = {"comment_count": "direct_reply_count", "repost_count": "repost_count", "quote_count": "quote_count", "view_count": "impression_count"}


def threads_posts(details: DataFrame) -> DataFrame:
    """Posts of details (current_url, linked_threads, body_text, raw_html, stale, coverage, freshness).

    post_created_at is a label, empty where the page shows a relative time alone: counted from the import's clock it would be no
    publish time. Likes stand near the post's code in the source, other counts near the post's number; views of the text come first.
    """
    address = _found(first_text(F.col("current_url"), F.get("linked_threads", F.lit(0))), THREAD_URL, 0)
    rows = without_stale(details).withColumn("_url", F.coalesce(address, F.lit("")))
    rows = rows.withColumn("_id", F.coalesce(_found(F.col("_url"), THREAD_CODE), F.lit(""))).withColumn("_page", F.coalesce(_found(F.col("_url"), THREAD_OWNER), F.lit("")))
    html = F.coalesce("raw_html", F.lit(""))
    rows = rows.withColumn("_t", thread_page(F.col("body_text"), html, F.col("_page"), F.col("_id"))).where(F.col("_t.comments").isNotNull())
    near = counts_near(html, F.concat(F.lit('"code":"'), F.col("_id"), F.lit('"')), {"likes": "like_count", "number": "fbid"})
    rows = rows.withColumn("_near", near)
    more = counts_near(html, F.concat(F.lit("XDTTextPostAppMediaInfo:"), F.coalesce(F.col("_near.number").cast("string"), F.lit("-"))), THREAD_COUNTS, before=400, after=900)
    rows = rows.withColumn("_more", more)
    counts = F.struct(F.col("_near.likes").alias("like_count"), "_more.comment_count", "_more.repost_count", "_more.quote_count", F.coalesce(views_of(F.col("body_text")), F.col("_more.view_count")).alias("view_count"))
    return rows.select(F.lit("threads").alias("platform"), F.col("_id").alias("post_id"), F.col("_page").alias("page_name"), F.col("_url").alias("post_url"), F.col("_t.created_at").alias("post_created_at"), F.col("_t.post_text").alias("post_text"), counts.alias("stats"), F.col("_t.comments").alias("comments"))


# How a place's address holds its id.
PLACE_ID = (r"(?i)[?&]cid=(\d+)", r"(?i)!1s0x([0-9a-f:]+)")
REVIEW = "array<struct<external_id:string,author:string,text:string,created_at:string,created_at_label:string,rating_label:string>>"


def place_posts(details: DataFrame) -> DataFrame:
    """Places of details (url, current_url, title, address, rating_text, search_keyword, crawled_at, crawled_reviews) as posts, their reviews as comments.

    A place without an id in its address has its title's slug; with neither it is none. Titles and addresses that are the page's own
    words are empty, a title then the search term's. Reviews are cleaned; those without an id or text go, of equal ids the first
    stays. A review's time is its own, else its label's before the crawl, else the crawl's. skip_post_mention: a place is no mention.
    """
    url = first_text(F.col("current_url"), F.col("url"))
    slug = F.regexp_replace(F.regexp_replace(F.lower(compact(F.col("title"))), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    rows = details.withColumn("_url", F.coalesce(url, F.lit(""))).withColumn("_id", F.coalesce(*[_found(url, p) for p in PLACE_ID], F.nullif(slug, F.lit("")))).where("_id is not null")
    rows = rows.withColumn("_title", F.coalesce(first_text(place_title(F.col("title")), place_title(F.col("search_keyword"))), F.lit(""))).withColumn("_crawled", content_time(F.col("crawled_at")))
    at = lambda r: F.coalesce(content_time(F.nullif(F.trim(r["created_at"]), F.lit(""))), relative(r["created_at_label"], F.col("_crawled")), F.col("_crawled"))
    clean = lambda r: F.struct(compact(r["external_id"]).alias("external_id"), place_author(r["author"]).alias("author"), place_review(r["text"]).alias("text"), at(r).alias("created_at"), rating(r["rating_label"]).alias("rating"), F.col("_url").alias("url"))
    kept = F.filter(F.transform(F.coalesce("crawled_reviews", F.array().cast(REVIEW)), clean), lambda c: (c["external_id"] != "") & (c["text"] != ""))
    ids = lambda cs: F.transform(cs, lambda c: c["external_id"])
    first = let(kept, lambda cs: let(ids(cs), lambda known: F.filter(cs, lambda c, k: F.array_position(known, c["external_id"]) == k + 1)))
    address = compact(F.col("address"))
    rows = rows.withColumn("comments", first)
    stats = F.struct(rating(F.col("rating_text")).alias("rating"), F.size("comments").alias("review_count"), F.when(place_chrome(address), F.lit("")).otherwise(address).alias("address"), F.coalesce(F.trim("search_keyword"), F.lit("")).alias("search_keyword"))
    return rows.select(F.lit("google_maps").alias("platform"), F.col("_id").alias("post_id"), F.col("_title").alias("page_name"), F.col("_url").alias("post_url"), F.col("_crawled").alias("post_created_at"), F.col("_title").alias("post_text"), stats.alias("stats"), "comments", F.lit(True).alias("skip_post_mention"))


def legacy_posts(posts: DataFrame, film: str) -> DataFrame:
    """The older record of one site's posts (platform, post_id, page_id, page_name, post_text, comments): identifiers, comments as texts, and the latest time of a comment."""
    rows = posts.where((F.col("platform") == "facebook") & (F.coalesce(F.trim("post_id"), F.lit("")) != ""))
    texts = F.transform("comments", lambda c: F.coalesce(c["text"], F.lit("")))
    latest = F.array_max(F.transform("comments", lambda c: content_time(c["created_at"])))
    number = lambda c: safe_identifier(F.col(c)).alias(c)
    return rows.select(safe_identifier(F.col("post_id")).alias("id"), "platform", number("post_id"), number("page_id"), F.trim(F.coalesce("page_name", F.lit(""))).alias("page_name"), F.trim(F.coalesce("post_text", F.lit(""))).alias("post_text"), F.coalesce(texts, F.array().cast("array<string>")).alias("comments_"), latest.alias("created_at_comment"), F.lit(film).alias("film_title"))
