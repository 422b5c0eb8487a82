"""Queries of what texts are rid of: phrases of known meaning before every document's whole text, and SQL that works the rules out."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.functions import cleaning as K
from buzzmill.functions import times as D
from buzzmill.operators import classify, crawl, imports
from buzzmill.plans.labels import now
from buzzmill.plans.queries import query
from buzzmill.plans.texts import documents, expected, pick, quoted, values
from buzzmill.sources.tables import table


def _compact(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{K.SPACE}]+', ' ', 'g'))"


def _without(x: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({x}, {quoted('(?i)' + pattern)}, '{by}', 'g')"


def _chrome(x: str) -> str:
    few = f"length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g')) < {K.FEW_LETTERS} AND length({x}) > {K.LONG_CHROME}"
    return f"({x} = '' OR regexp_matches({x}, {quoted('(?i)' + K.MAP_CHROME)}) OR contains({x}, ' - Google Maps |') AND contains({x}, 'Search') OR {few})"


def _given(cases, sql: str, key: str = "doc_id", source: str = "documents") -> str:
    """SQL: each document's phrase and text as t; t holds the text alone where the phrase is empty."""
    return f"WITH g AS (SELECT {key}, phrase || coalesce(text, '') AS t FROM {source} JOIN {values([(c,) for c in cases], 'phrase')} ON k = {key} % {len(cases)}) {sql}"


CARDS = ["", "Nguyen A Local Guide · 12 reviews 3 photos 2 months ago ", "Local Guide · 1,204 reviews 7 photos ", "an hour ago ok", " một năm trước Rạp rất đẹp …More2 Like 3 Share again ", "Drag to change the map ", "X - Google Maps | Search ", "2 tuần trước Tốt (Translated by Google) lắm See original ", "Phòng chiếu lớn, sẽ quay lại Like Share "]


@query(
    _given(
        CARDS,
        f""", f AS (SELECT doc_id, regexp_replace({_compact('t')}, '{K.MAP_ICONS}', ' ', 'g') AS t FROM g), a AS (SELECT *, trim(regexp_extract(t, {quoted('(?is)' + K.MAP_AGO + '(.*)$')}, 1)) AS after FROM f),
b AS (SELECT doc_id, CASE WHEN {_chrome(_compact('t'))} THEN '' WHEN length(after) >= {K.SHORTEST_REVIEW} THEN after ELSE trim(regexp_replace(t, {quoted('(?i)' + K.MAP_AUTHOR)}, '')) END AS t FROM a),
c AS (SELECT doc_id, {_compact(_without(_without("regexp_replace(trim(regexp_replace(t, '(?is)\\s*(?:…\\s*)?more.*$', '')), '(?s)(?:Like| Share).*$', '')", K.MAP_NOTES[0]), K.MAP_NOTES[1]))} AS t FROM b)
SELECT doc_id, CASE WHEN {_chrome('t')} OR length(t) < {K.SHORTEST_REVIEW} THEN '' ELSE t END AS review FROM c""",
    )
)
def place_reviews(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", K.place_review(F.concat(pick([(c,) for c in CARDS], 0), "text")).alias("review"))


NAMES = ["Anna Local Guide · 3 reviews ", "Bình 12 reviews ", "Chi  ", "", "Galaxy Cinema - Google Maps", "click to remove "]


@query(
    _given(
        NAMES,
        f""", n AS (SELECT doc_id, {_compact(f"regexp_replace(regexp_replace({_compact('t')}, '{K.MAP_ICONS}', '', 'g'), '(?is)(?:local\\s+guide|\\d+\\s+reviews?).*$', '')")} AS author, regexp_replace({_compact('t')}, '(?i)\\s*-\\s*google maps\\s*$', '') AS t FROM g)
SELECT doc_id, author, CASE WHEN {_chrome('t')} THEN '' ELSE trim(t) END AS title FROM n""",
    )
)
def place_names(spark, sf_dir):
    t = F.concat(pick([(c,) for c in NAMES], 0), "text")
    return documents(spark, sf_dir).select("doc_id", K.place_author(t).alias("author"), K.place_title(t).alias("title"))


EXPORTED = ['{"id":1,"text":"line\\none \\"two\\" caf\\u00e9","x":2}', "", "· • Write a comment... ", "0:12 / 3:45 ", "ets.org ", "see translation", "A page. 1,234 likes · 56 talking about this ", "... 12 !", "Top fan"]
_SPAM = quoted("(?i)" + K.EXPORT_SPAM)


@query(
    _given(
        EXPORTED,
        f""", u AS (SELECT doc_id, t, CASE WHEN doc_id % {len(EXPORTED)} = 0 THEN 'line' || chr(10) || 'one "two" café' ELSE trim(t) END AS s FROM g),
c AS (SELECT doc_id, t, {_compact(f"regexp_replace(regexp_replace({_without(_without('s', K.EXPORT_SPAM), K.EXPORT_CLOCK)}, '^[·•{K.SPACE}]+', ''), {quoted('(?i)' + K.EXPORT_TAIL)}, '')")} AS clean FROM u)
SELECT doc_id, clean, length(t) < {K.SHORTEST_EXPORT} OR regexp_matches(t, {_SPAM}) OR regexp_matches(t, {quoted('(?i)' + K.EXPORT_BIOGRAPHY)}) OR regexp_matches(t, {quoted(f'^[·•{K.SPACE},:;!?.' + chr(92) + '-0-9]+$')}) OR list_contains({list(K.EXPORT_BUTTONS)}, lower(t)) AS noise FROM c""",
    )
)
def export_texts(spark, sf_dir):
    t = F.concat(pick([(c,) for c in EXPORTED], 0), "text")
    return documents(spark, sf_dir).select("doc_id", K.export_text(t).alias("clean"), K.export_noise(t).alias("noise"))


NOISE_CASES = [("phim ok", "", True), ("phim hay lắm", "", False), ("phim hay lắm", "ets.org", True), ("- 12:34 !!", "", True), ("Top Fan!", "", False), ("pages you follow", "", True), ("Rạp. 12,345 likes • 67 talking about this", "", True), ("Write a comment…", "", True), ("phim ​ hay", "", True)]


@query(f"SELECT doc_id, label = 'True' AS noise FROM documents JOIN {values([(str(c[-1]),) for c in NOISE_CASES], 'label')} ON k = doc_id % {len(NOISE_CASES)}")
def noise_labels(spark, sf_dir):
    """Phrases alone: a text after them would make each of them long."""
    return documents(spark, sf_dir).select("doc_id", K.export_noise(pick(NOISE_CASES, 0), pick(NOISE_CASES, 1)).alias("noise"))


AUTHORS = [("Anna", "Anna"), (" Bình  Minh ", "Bình  Minh"), ("Review Phim Hay", ""), ("#hashtag", ""), ("Vé rẻ", ""), ("...", ""), ("fan of Odyssey", ""), ("Odysseys", "Odysseys"), ("The  Odyssey fans", ""), ("minion#1", ""), ("_abc", "_abc"), ("dune2", "")]


@query(expected(AUTHORS, "author"))
def author_names(spark, sf_dir):
    """Names of authors, a field of a few words."""
    titles = F.array(*map(F.lit, ["odyssey", "the odyssey", "#dune", "minion"]))
    return documents(spark, sf_dir).select("doc_id", K.export_author(pick(AUTHORS, 0), titles).alias("author"))


LINES = ["Reply", "send", "Đã chỉnh sửa", "3h", "5 minutes", "12 d", "x", "❤❤", "  Chia   sẻ ", "", "hay"]


@query(
    f"""WITH g AS (SELECT doc_id, unnest([phrase, phrase || coalesce(text, '')]) AS t, unnest([false, true]) AS whole FROM documents JOIN {values([(c,) for c in LINES], 'phrase')} ON k = doc_id % {len(LINES)}), c AS (SELECT doc_id, whole, lower({_compact('t')}) AS t FROM g)
SELECT doc_id, whole, length(t) >= 2 AND NOT list_contains({list(K.COMMENT_BUTTONS)}, t) AND NOT regexp_matches(t, '{K.COMMENT_TIME}') AS is_comment FROM c"""
)
def comment_lines(spark, sf_dir):
    """Lines alone, and before a text."""
    phrase = pick([(c,) for c in LINES], 0)
    lines = F.array(F.struct(phrase.alias("t"), F.lit(False).alias("whole")), F.struct(F.concat(phrase, "text").alias("t"), F.lit(True).alias("whole")))
    return documents(spark, sf_dir).select("doc_id", F.inline(lines)).select("doc_id", "whole", K.is_comment_text(F.col("t")).alias("is_comment"))


IDS = [("9007199254740991", "9007199254740991"), ("9007199254740992", "9007199254740992"), ("007", "7"), (" 12a ", "12a"), ("", ""), ("0000", "0"), ("00000000000000000000012", "12"), ("pfbid02Ab", "pfbid02Ab"), ("0009007199254740992", "0009007199254740992")]


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN label ELSE o_orderkey::VARCHAR END AS id FROM orders JOIN {values([c[1:] for c in IDS], 'label')} ON k = o_orderkey % {len(IDS)}")
def safe_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", K.safe_identifier(F.when(F.col("o_orderkey") % 2 == 0, pick(IDS, 0, "o_orderkey")).otherwise(F.concat(F.lit(" 00"), F.col("o_orderkey").cast("string")))).alias("id"))


CAPTIONS = [('1,234 likes, 56 comments - anna on July 1, 2026: "hello &quot;you&quot; &amp; ', 1234, 56), ("1.229.143 likes, 1 comment - b: 'x ", 1229143, 1), ("plain ", None, None), ("2 like, 0 comments - : ", 2, 0)]


@query(
    f"""WITH g AS (SELECT doc_id, trim(phrase || coalesce(text, '')) AS t, likes, comments FROM documents JOIN {values([(c[0], c[1], c[2]) for c in CAPTIONS], 'phrase', 'likes', 'comments')} ON k = doc_id % {len(CAPTIONS)}),
e AS (SELECT *, replace(replace(trim(trim(trim(trim(regexp_extract(t, {quoted('(?is)' + K.CAPTION)}, 3)), '"'), '''')), '&quot;', '"'), '&amp;', '&') AS body FROM g)
SELECT doc_id, likes::BIGINT AS likes, comments::BIGINT AS comments, CASE WHEN likes IS NULL OR body = '' THEN t ELSE body END AS body FROM e"""
)
def caption_engagement(spark, sf_dir):
    return documents(spark, sf_dir).withColumn("e", K.engagement_prefix(F.concat(pick(CAPTIONS, 0), "text"))).select("doc_id", "e.likes", "e.comments", F.col("e.text").alias("body"))


PLACES = [
    ("https://www.google.com/maps/place/Galaxy+Cinema+X", True), ("https://www.google.com/maps/place/CGV?hl=en&z=1", False), ("https://www.google.com/maps/place/R%E1%BA%A1p+Galaxy?hl=en", True), ("https://www.google.com/maps/place/Galaxy+Nguy%E1%BB%85n+Du/data=1", True),
    ("https://www.google.com/maps/place/CGV+x/data=galaxy+cinema", False), ("https://www.google.com/maps/place/Galaxy+Cinema+cgv", False), ("https://www.google.com/maps/search/galaxy", False), ("https://www.google.com/maps/place/Galaxy+Tourist", False), ("%zz/maps/place/galaxy", True),
]


@query(f"SELECT doc_id, label = 'True' AS place, regexp_replace(regexp_replace(u, '([?&])hl=[^&#]*&?', '\\1', 'g'), '[?&]$', '') || CASE WHEN contains(regexp_replace(regexp_replace(u, '([?&])hl=[^&#]*&?', '\\1', 'g'), '[?&]$', ''), '?') THEN '&' ELSE '?' END || 'hl=vi' AS url FROM documents JOIN {values([(p[0], str(p[1])) for p in PLACES], 'u', 'label')} ON k = doc_id % {len(PLACES)}")
def place_urls(spark, sf_dir):
    u = pick(PLACES, 0)
    return table(spark, sf_dir, "documents").select("doc_id", crawl.is_place_of(u).alias("place"), crawl.with_language(u).alias("url"))


KEPT = [("glx", "galaxy mipec tối nay"), ("glx", "GALAXY KINH DƯƠNG"), ("glx", "galaxy cinema và samsung"), ("glx", "galaxy"), ("cgv", "#CGV"), ("cgv", "x"), ("lotte", "lotte cinema"), ("lotte", "lotte cinema, lotte mart"), ("beta", "vé beta"), ("beta", "beta"), ("beta", "rạp beta, beta test"), ("bhd", "bhd imax"), ("bhd", "abhd imax"), ("cinestar", "cine star"), ("other", "cgv")]


def _keep_sql() -> str:
    holds = lambda terms: "(" + " OR ".join(f"contains(t, {quoted(x)})" for x in terms) + ")"
    out = ""
    for brand, (wanted, unwanted, word) in classify.KEEP.items():
        found = holds(wanted) + (f" OR regexp_matches(t, '\\b{word}\\b') AND regexp_matches(t, {quoted(classify.P.KEEP_CONTEXT)})" if word else "")
        out += f" WHEN '{brand}' THEN ({found})" + (f" AND NOT {holds(unwanted)}" if unwanted else "")
    return out


@query(f"WITH g AS (SELECT doc_id, brand, lower(phrase || ' ' || coalesce(text, '')) AS t FROM documents JOIN {values(KEPT, 'brand', 'phrase')} ON k = doc_id % {len(KEPT)}) SELECT doc_id, CASE brand{_keep_sql()} ELSE false END AS kept FROM g")
def brand_keyword_kept(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", classify.brand_keyword_keep(F.concat(pick(KEPT, 1), F.lit(" "), "text"), pick(KEPT, 0)).alias("kept"))


#: Platform, author, text, link, post's text, page, sentiment and brands; null where the comment is none.
COMMENTS = [
    ("tiktok", "a", "rạp galaxy tốt", "", "p", "x", "positive", "glx"), ("google", "An Local Guide · 3 reviews", "An 3 reviews 2 months ago Phòng sạch và nhân viên rất tốt Like", "", "p", "Galaxy Cinema Nguyễn Du", "positive", "glx"), ("google", "a", "ok", "", "p", "Galaxy Cinema", None, None),
    ("threads", "@Other", "rạp cgv rất tốt", "", "rạp cgv rất tốt", "owner", None, None), ("threads", "@Owner", "rạp cgv rất tốt", "", "rạp cgv rất tốt", "owner", "positive", "cgv"), ("threads", "", "rạp cgv rất tốt", "", "rạp cgv rất tốt", "owner", "positive", "cgv"),
    ("facebook", "a", "không liên quan", "", "p", "x", None, None), ("facebook", "Lotte Cinema Việt Nam", "cảm ơn bạn", "", "p", "x", "positive", "lotte"), ("facebook", "a", "tốt", "https://www.facebook.com/galaxycine.vn/posts/1", "p", "x", "positive", "glx"), ("google", "a", "Sạch sẽ, ghế rất tốt và rộng", "", "Rạp Galaxy Quận 7", "rạp", "positive", "glx"),
]


@query(
    f"""SELECT event_id::VARCHAR AS external_id, author, sentiment, brands, CASE WHEN event_id % 3 = 0 THEN 'parsed' WHEN event_id % 3 = 1 THEN 'post_inferred' ELSE 'crawl_fallback' END AS date_source, CASE WHEN platform = 'google' THEN '5' END AS rating
FROM events JOIN {values([(c[0], 'An' if c[1].startswith('An ') else c[1], c[6], c[7]) for c in COMMENTS], 'platform', 'author', 'sentiment', 'brands')} ON k = event_id % {len(COMMENTS)} WHERE brands IS NOT NULL AND (event_id % 3 < 2 OR platform = 'google')"""
)
def import_comments(spark, sf_dir):
    """Every third comment has no time, nor its post: only place reviews among them are kept."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id") % 3
    own = {c: pick(COMMENTS, k, "event_id").alias(c) for k, c in enumerate(["platform", "author", "text", "url", "post_text", "page_name"])}
    rows = e.select(*own.values(), F.lit("p").alias("post_id"), F.col("event_id").cast("string").alias("external_id"), F.when(n == 0, "2026-09-02").otherwise("").alias("created_at"), F.when(n < 2, "2026-09-01").otherwise("").alias("post_created_at"), F.when(own["platform"] == "google", "5").alias("rating"))
    m = imports.comment_mentions(rows, now())
    told = lambda k: F.try_element_at("metadata", F.lit(k)).alias(k)
    return m.select("external_id", F.col("author_key").alias("author"), "sentiment", F.array_join("brands", ",").alias("brands"), told("date_source"), told("rating"))


#: Platform, value, label, time of the crawl, of the post, and the comment's time.
COMMENT_TIMES = [
    ("tiktok", "1725962400", "3d", "2026-09-10 12:00:00", "", "2024-09-10 10:00:00"), ("tiktok", "2026-09-10T12:00:01Z", "3d", "2026-09-10 12:00:00", "", "2026-09-07 12:00:00"), ("tiktok", "", "2 mo ago", "2026-09-10 12:00:00", "", "2026-07-12 12:00:00"),
    ("tiktok", "", "3 days ago", "2026-09-10 12:00:00", "", None), ("tiktok", "", "1h", "", "2026-09-01 00:00:00", "2026-08-31 23:00:00"), ("tiktok", "", "1h", "", "", None), ("tiktok", "2026-09-01T00:00:00+07:00", "", "", "", "2026-08-31 17:00:00"),
    ("youtube", "Sep 3, 2026", "", "2026-09-10 12:00:00", "", "2026-09-03 00:00:00"), ("youtube", "3 Sep 2026", "1 day ago", "2026-09-10 12:00:00", "", "2026-09-03 00:00:00"), ("youtube", "1725962400", "", "2026-09-10 12:00:00", "", None),
    ("instagram", "2026-09-10T11:59:59Z", "", "2026-09-10 12:00:00", "", None), ("instagram", "soon", "", "2026-09-10 12:00:00", "2026-09-01 00:00:00", None),
]


@query(f"SELECT event_id, label::TIMESTAMP AS written FROM events JOIN {values([c[-1:] for c in COMMENT_TIMES], 'label')} ON k = event_id % {len(COMMENT_TIMES)}")
def comment_times(spark, sf_dir):
    of = lambda k: F.nullif(pick(COMMENT_TIMES, k, "event_id"), F.lit(""))
    at = D.comment_time(of(0), of(1), of(2), of(3).try_cast("timestamp"), of(4).try_cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", at.cast("timestamp_ntz").alias("written"))


#: Three labels of a post's time, in their order, and what is taken at 2026-09-10 12:00 UTC.
PUBLISHED = [
    ("July 19, 2026 at 10:10", "2026-07-01T00:00:00Z", "", "2026-07-19 03:10:00", "July 19, 2026 at 10:10"), ("", "2026-07-01T00:00:00Z", "x", "2026-07-01 00:00:00", "2026-07-01T00:00:00Z"), ("5 phút trước", "", "2026-08-01T01:00:00Z", "2026-08-01 01:00:00", "2026-08-01T01:00:00Z"),
    ("5 phút trước", "", "", None, "5 phút trước"), ("", "", "2026-09-10T12:03:00Z", "2026-09-10 12:03:00", "2026-09-10T12:03:00Z"), ("sometime", " ", "", None, "sometime"), ("", "", "", None, ""), ("3 giờ trước", "2026-01-01T00:00:00Z", "", "2026-09-10 09:00:00", "3 giờ trước"),
]


@query(f"SELECT event_id, told::TIMESTAMP AS published, label FROM events JOIN {values([c[3:] for c in PUBLISHED], 'told', 'label')} ON k = event_id % {len(PUBLISHED)}")
def published_times(spark, sf_dir):
    found = D.published_choice([pick(PUBLISHED, k, "event_id") for k in range(3)], F.lit("2026-09-10 12:00:00").cast("timestamp"))
    return table(spark, sf_dir, "events").withColumn("p", found).select("event_id", F.col("p.at").cast("timestamp_ntz").alias("published"), "p.label")
