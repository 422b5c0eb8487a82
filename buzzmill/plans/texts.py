"""Queries of the text classifiers. Each document's text is put beside a phrase whose labels are known; the SQL gives those labels.

Where a classifier looks for given terms alone, the SQL looks for them too; elsewhere the labels are stated beside the
phrases, and hold whatever the invented prose of the documents says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from buzzmill.operators import classify as C
from buzzmill.operators import packs as P
from buzzmill.plans.queries import query
from buzzmill.sources.tables import table


def quoted(x) -> str:
    if x is None:
        return "NULL"
    return "'" + str(x).replace("'", "''") + "'"


def pick(cases: Sequence, k: int, by: str = "doc_id") -> Column:
    """The k-th field of the case whose number is the id modulo the number of cases."""
    return F.element_at(F.array(*[F.lit(c[k]) for c in cases]), (F.pmod(F.col(by), F.lit(len(cases))) + 1).cast("int"))


def values(cases: Sequence, *columns: str) -> str:
    """The cases as SQL values (k, columns...)."""
    rows = ", ".join("(" + ", ".join([str(k), *[quoted(c) for c in case]]) + ")" for k, case in enumerate(cases))
    return f"(VALUES {rows}) AS v(k, {', '.join(columns)})"


def expected(cases: Sequence, column: str) -> str:
    """SQL: doc_id and the stated label of its case."""
    return f"SELECT doc_id, label AS {column} FROM documents JOIN {values([c[-1:] for c in cases], 'label')} ON k = doc_id % {len(cases)}"


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


BRAND_CASES = [
    ("Went to Galaxy Cinema yesterday", "", "glx"), ("rạp galaxy ngon", "", "glx"), ("#galaxymovie", "", "glx"), ("galaxy sư vạn hạnh", "", "glx"), ("galaxy long xuyen", "", "glx"),
    ("Galaxy Cinema Jaipur", "", ""), ("galaxy s24 ultra", "", ""), ("Samsung Galaxy Ultra ra mắt - galaxycine.vn", "", ""), ("galaxy cinema india", "", ""), ("follow rapgalaxy", "", ""),
    ("cgv royal city", "", "cgv"), ("#cgv", "", "cgv"), ("lotte cinema gò vấp", "", "lotte"), ("lotte mart sale", "", ""), ("lotte", "", ""), ("bhd star bitexco", "", "bhd"),
    ("bhd only", "", ""), ("rạp bhd chiều nay", "", "bhd"), ("beta xuân thuỷ", "", "beta"), ("rạp beta gần nhà", "", "beta"), ("beta test game", "", ""), ("chỉ nói beta thôi", "", ""),
    ("cinestar quốc thanh", "", "cinestar"), ("cgv và lotte mart", "", "cgv"), ("CGV Korea khai trương rạp mới tại Seoul", "", ""), ("Lotte Cinema mở rạp tại Hàn Quốc", "", ""),
    ("CGV và Lotte Cinema cạnh tranh tại thị trường Việt Nam", "", "cgv,lotte"), ("CGV Việt Nam mở các suất chiếu đặc biệt cuối tuần", "", "cgv"),
    ("Xem ngay các suất chiếu hấp dẫn tại rạp gần nhà", "", ""), ("Pass vé Galaxy Cinema số lượng lớn rẻ hơn giá rạp", "", ""), ("Tuyển dụng part-time tại CGV Việt Nam", "", ""),
    ("[Review] In Nolan We Trust?", "https://www.galaxycine.vn/a", "glx"), ("CGV phát hành", "https://www.cineplay.co.kr/vi-vn/articles/29500", ""),
    ("Galaxy Cinema, CGV, Lotte Cinema, Beta Cinemas, BHD Star, Cinestar", "", "glx,cgv,lotte,beta,bhd,cinestar"), ("Caritas hỗ trợ vùng lũ - cgvdt.vn", "", ""),
]


@query(expected(BRAND_CASES, "brands"))
def brand_tags(spark, sf_dir):
    d = documents(spark, sf_dir)
    found = C.brands(F.concat(pick(BRAND_CASES, 0), F.lit(" \n "), "text"), pick(BRAND_CASES, 1))
    return d.select("doc_id", F.array_join(found, ",").alias("brands"))


@query(expected([(*c[:-1], c[-1] or "others") for c in BRAND_CASES], "brands"))
def brand_tags_or_others(spark, sf_dir):
    d = documents(spark, sf_dir)
    found = C.brands(pick(BRAND_CASES, 1), F.concat("text", F.lit(" ")), pick(BRAND_CASES, 0), other="others")
    return d.select("doc_id", F.array_join(found, ",").alias("brands"))


SPAM_CASES = [("book vé rạp galaxy",), ("GDTG uy tín",), ("các suất chiếu",), ("các suất chiếu cgv",), ("các suất chiếu lotte cinema",), ("một phim hay",), ("Nhượng  lại vé",)]
_SPAM = " OR ".join(f"contains(t, {quoted(p)})" for p in P.SPAM_ALWAYS)


@query(
    f"""WITH x AS (SELECT doc_id, trim(regexp_replace(lower(phrase || ' ' || coalesce(text, '')), '\\s+', ' ', 'g')) AS t FROM documents JOIN {values(SPAM_CASES, "phrase")} ON k = doc_id % {len(SPAM_CASES)})
SELECT doc_id, {_SPAM} OR (contains(t, 'các suất chiếu') AND NOT regexp_matches(t, '\\bcgv\\b|lotte\\s*cinema|galaxy\\s*cine|\\bcinestar\\b|bhd\\s*star|beta\\s*cin')) AS spam FROM x"""
)
def spam_gate(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", C.is_spam(C.collapse(F.concat_ws(" ", pick(SPAM_CASES, 0), "text"))).alias("spam"))


MARKET_CASES = [
    ("xem tại galaxycine.vn", "", "", "vietnam"), ("phim mới", "https://www.cineplay.co.kr/a", "", "foreign"), ("CGV Việt Nam", "https://koreatimes.co.kr/b", "", "vietnam"),
    ("Bitcoin và lãi suất", "", "", "unrelated"), ("Bitcoin tại cinema", "", "", "vietnam"), ("CGV Korea khai trương tại Seoul", "", "", "foreign"), ("mumbai premiere", "", "", "foreign"),
    ("xem phim ở Hà Nội", "", "", "vietnam"), ("phim này hay", "", "news", "ambiguous"), ("phim này hay", "", "tiktok", "vietnam"), ("possiamo vedere", "", "", "foreign"),
    ("영화 봤어요", "", "", "foreign"), ("chỗ này rất ổn", "", "google_maps", "vietnam"), ("chỗ này rất ổn", "", "facebook", "ambiguous"), ("khong thich phim nay", "", "", "vietnam"),
    ("nothing to see", "", "", "ambiguous"), ("rạp cgv đông", "", "", "vietnam"), ("Honda Odyssey", "", "", "foreign"), ("đi tphcm", "", "news", "vietnam"), ("pháo hoa ở Đà Nẵng", "", "", "vietnam"),
]


@query(expected(MARKET_CASES, "market"))
def market_scope(spark, sf_dir):
    """Phrases alone: prose in other languages would say something of its own."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", C.market(pick(MARKET_CASES, 0), pick(MARKET_CASES, 1), F.lit(None).cast("string"), pick(MARKET_CASES, 2)).alias("market"))


@query(f"""SELECT label AS market, count(*) AS mentions FROM documents JOIN {values([c[-1:] for c in MARKET_CASES], "label")} ON k = doc_id % {len(MARKET_CASES)} WHERE label = 'vietnam' GROUP BY label""")
def market_filter(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("market", C.market(pick(MARKET_CASES, 0), pick(MARKET_CASES, 1), None, pick(MARKET_CASES, 2)))
    return d.where("market = 'vietnam'").groupBy("market").agg(F.count("*").alias("mentions"))


#: Each phrase ends a text after a contrast word, so its verdict decides.
MKT_CASES = [
    ("phim rất hay", "positive"), ("dịch vụ tệ", "negative"), ("không tốt", "negative"), ("không phải không tốt", "positive"), ("chưa tệ chút nào", "positive"), ("chưa thấy chán", "positive"),
    ("gia đình đi xem", "positive"), ("hay và tốt nhưng kém", "negative"), ("ghế xấu, lỗi, tốt", "negative"), ("ko hay", "negative"), ("xuất sắc", "positive"),
    ("không ai trong chúng tôi nghĩ là sẽ có lúc thích", "positive"), ("thất vọng; ổn", "positive"), ("khong co loi", "positive"),
]


@query(expected(MKT_CASES, "sentiment"))
def mkt_sentiment(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", C.sentiment(F.concat("text", F.lit(" nhưng "), pick(MKT_CASES, 0))).alias("sentiment"))


MKT_NEUTRAL = [("", "neutral"), ("rồi sau đó về", "neutral"), ("hay nhưng không", "positive"), ("tốt tệ", "neutral"), ("xem rồi", "neutral"), ("ngon! tệ? xem", "negative")]


@query(f"SELECT label AS sentiment, count(*) AS mentions FROM documents JOIN {values([c[-1:] for c in MKT_NEUTRAL], 'label')} ON k = doc_id % {len(MKT_NEUTRAL)} GROUP BY label")
def mkt_sentiment_counts(spark, sf_dir):
    d = documents(spark, sf_dir).select(C.sentiment(pick(MKT_NEUTRAL, 0)).alias("sentiment"))
    return d.groupBy("sentiment").agg(F.count("*").alias("mentions"))


DIS_CASES = [
    ("Phim này quá hay luôn", "positive"), ("diễn xuất tốt cảm động quá", "positive"), ("phí tiền chán quá", "negative"), ("kịch bản lê thê thất vọng", "negative"),
    ("Diễn viên diễn ổn nhưng kịch bản hơi dở", "negative"), ("Mở đầu hơi nhạt nhưng càng xem càng hay", "positive"), ("hay mà dở", "negative"), ("masterpiece; rồi về", "positive"), ("hay dở đều có", "negative"),
]


@query(expected(DIS_CASES, "sentiment"))
def dis_sentiment(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", C.film_sentiment(F.concat("text", F.lit("\n"), pick(DIS_CASES, 0))).alias("sentiment"))


INTENT_CASES = [
    ("Cuối tuần đi xem Nghỉ Hè sợ Nghỉ Hưu", "want_to_see"), ("Săn vé The Odyssey luôn", "want_to_see"), ("Nghe nói hay để dành cuối tuần coi", "want_to_see"), ("Không xem đâu chán lắm", "not_interested"),
    ("Khỏi xem phim này", "not_interested"), ("Đã xem rồi hay quá", "watched_praise"), ("Xem xong thất vọng phí tiền", "watched_criticize"), ("Phim này quá hay luôn", None), ("phí tiền chán quá", None),
    ("skip, phải xem phim khác", "not_interested"), ("bỏ qua mọi lời chê, tôi và cả nhà vẫn muốn xem", "want_to_see"), ("vừa xem", None), ("", None), ("I can't wait", "want_to_see"),
]


@query(expected(INTENT_CASES, "intent"))
def film_intent(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", C.intent(pick(INTENT_CASES, 0)).alias("intent"))


@query(
    f"""SELECT platform_code, count(*) FILTER (WHERE after IS NOT NULL AND after IS DISTINCT FROM before) AS updated, count(*) FILTER (WHERE after IS NULL AND before IS NOT NULL) AS cleared
FROM (SELECT CASE event_id % 3 WHEN 0 THEN 'news' WHEN 1 THEN 'tiktok' ELSE 'threads' END AS platform_code, CASE WHEN event_id % 4 = 0 THEN 'want_to_see' END AS before,
  CASE WHEN event_id % 3 = 0 THEN before ELSE label END AS after FROM events JOIN {values([c[-1:] for c in INTENT_CASES], "label")} ON k = event_id % {len(INTENT_CASES)}) GROUP BY platform_code"""
)
def intent_reclassify(spark, sf_dir):
    from buzzmill.operators.tables import change_counts

    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.when(F.col("event_id") % 3 == 0, "news").when(F.col("event_id") % 3 == 1, "tiktok").otherwise("threads").alias("platform_code"),
        pick(INTENT_CASES, 0, "event_id").alias("content_text"),
        F.when(F.col("event_id") % 4 == 0, "want_to_see").alias("intent"),
    )
    after = C.classify_intents(rows.withColumn("before", F.col("intent")), reclassify=True)
    return change_counts(after, "platform_code", "before", "intent")


CATALOG = [
    C.Film("nghi_he_so_nghi_huu", "Nghỉ Hè sợ Nghỉ Hưu", terms=["#NghiHeSoNghiHuu"]),
    C.Film("am_chuoi_phim_ngan_linh_di", "Ám: Chuỗi phim ngắn linh dị", core=["ám chuỗi phim ngắn"], ambiguous=["ám"], soft_exclude=["ám ảnh"]),
    C.Film("the_odyssey", "The Odyssey", terms=["#Odyssey", "odyssey"], context=["nolan"], exclude=["honda", "assassin's creed", "homer"]),
    C.Film("minion", terms=["minions", "minion"], exclude=["avatar minion"]),
    C.Film("spider", "Spider-Man Brand New Day", core=["khởi đầu mới"], terms=["spider-man", "người nhện"], ambiguous_context=["brand new day", "khởi đầu mới"]),
    C.Film("old_film", "Old Film", active=False),
    C.Film("later", "Phim Sau", listening_from="2024-01-15"),
]
FILM_CASES = [
    ("Trailer Nghỉ Hè sợ Nghỉ Hưu mới ra", "nghi_he_so_nghi_huu"), ("Hóng phim #NghiHeSoNghiHuu quá", "nghi_he_so_nghi_huu"), ("tôi bị ám ảnh", ""), ("Xem trailer phim Ám chuỗi phim ngắn", "am_chuoi_phim_ngan_linh_di"),
    ("The Odyssey trailer ra rạp", "the_odyssey"), ("#Odyssey Nolan movie review", "the_odyssey"), ("Honda Odyssey trailer sale at dealership", ""), ("Assassin's Creed Odyssey game review trailer", ""),
    ("Reading Homer The Odyssey in class trailer", ""), ("đưa trẻ đi xem phim Minions", "minion"), ("đổi avatar minion sticker phim", ""), ("Spider-Man Brand New Day trailer", "spider"), ("Nhớ Spider-Man No Way Home phim", ""),
    ("Người Nhện phần mới Khởi Đầu Mới trailer", "spider"), ("old film movie", ""), ("phim sau và the odyssey", "the_odyssey,later"),
]


@query(expected(FILM_CASES, "films"))
def film_detect(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.array_join(C.films(F.concat(pick(FILM_CASES, 0), F.lit(" \n "), "text"), CATALOG), ",").alias("films"))


@query(f"SELECT doc_id, contains(label, 'the_odyssey') AS relevant, label = 'spider' AS strictly FROM documents JOIN {values([c[-1:] for c in FILM_CASES], 'label')} ON k = doc_id % {len(FILM_CASES)}")
def film_relevance(spark, sf_dir):
    text = F.concat(pick(FILM_CASES, 0), F.lit(" \n "), "text")
    return documents(spark, sf_dir).select("doc_id", C.film_relevant(text, CATALOG[2]).alias("relevant"), C.film_relevant(text, CATALOG[4], strict=True).alias("strictly"))


RESOLVE_CASES = [
    ("The Odyssey trailer", "", "the_odyssey", "the_odyssey", "path+alias"), ("The Odyssey trailer", "", "minion", "the_odyssey", "alias"), ("hello", "The Odyssey", "the_odyssey", "the_odyssey", "path+keyword"),
    ("hello", "The Odyssey", "minion", "", "skip-path"), ("hello", "", "the_odyssey", "", "skip-path"),
]


@query(f"SELECT doc_id, films, method FROM documents JOIN {values([c[3:] for c in RESOLVE_CASES], 'films', 'method')} ON k = doc_id % {len(RESOLVE_CASES)}")
def film_resolve(spark, sf_dir):
    found = C.resolve_films(pick(RESOLVE_CASES, 0), F.array(pick(RESOLVE_CASES, 1)), pick(RESOLVE_CASES, 2), CATALOG)
    return documents(spark, sf_dir).withColumn("r", found).select("doc_id", F.array_join("r.films", ",").alias("films"), "r.method")


@query(
    f"""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN films ELSE trim(replace(',' || films || ',', ',later,', ','), ',') END AS films
FROM (SELECT event_id, ts, label AS films FROM events JOIN {values([c[-1:] for c in FILM_CASES], "label")} ON k = event_id % {len(FILM_CASES)})"""
)
def film_listening_window(spark, sf_dir):
    found = C.within_listening(C.films(pick(FILM_CASES, 0, "event_id"), CATALOG), F.col("ts"), CATALOG)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(found, ",").alias("films"))


MOVIE_CASES = [("xem phim", True), ("movie night", True), ("vé số", True), ("hello", False), ("revenge", False), ("trailers", True)]


@query(f"SELECT k, label = 'True' AS movie, count(*) AS mentions FROM documents JOIN {values([(str(c[1]),) for c in MOVIE_CASES], 'label')} ON k = doc_id % {len(MOVIE_CASES)} GROUP BY k, label")
def movie_context(spark, sf_dir):
    d = documents(spark, sf_dir).select((F.col("doc_id") % len(MOVIE_CASES)).cast("int").alias("k"), C.movie_context(pick(MOVIE_CASES, 0)).alias("movie"))
    return d.groupBy("k", "movie").agg(F.count("*").alias("mentions"))


def _sql_any(text: str, needles: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(n)})" for n in needles) + ")"


TOPIC_CASES = [("đặt vé qua app",), ("giá vé đắt",), ("Samsung Galaxy S24 momo",), ("samsung galaxy ở rạp, bắp rang",), ("nhân viên  phục vụ tốt, gửi xe tiện",), ("IMAX laser",), ("galaxy s9 parking",), ("không có gì",)]
_TOPIC_TEXTS = f"SELECT doc_id, trim(regexp_replace(lower(phrase || ' ' || coalesce(text, '')), '\\s+', ' ', 'g')) AS t FROM documents JOIN {values(TOPIC_CASES, 'phrase')} ON k = doc_id % {len(TOPIC_CASES)}"
_TOPIC_LIST = ", ".join(f"CASE WHEN {_sql_any('t', n)} THEN '{s}' END" for s, n in P.CX_TOPICS.items())


@query(
    f"""SELECT doc_id, CASE WHEN (contains(t, 'samsung galaxy') OR regexp_matches(t, '\\bgalaxy s[0-9]')) AND NOT {_sql_any("t", P.CX_CINEMA)} THEN ''
ELSE array_to_string(list_filter([{_TOPIC_LIST}], lambda x: x IS NOT NULL), ',') END AS topics FROM ({_TOPIC_TEXTS})"""
)
def cx_topic_labels(spark, sf_dir):
    text = F.concat_ws(" ", pick(TOPIC_CASES, 0), "text")
    return documents(spark, sf_dir).select("doc_id", F.array_join(C.cx_topics(text), ",").alias("topics"))


APP_CASES = [("không đăng nhập được, OTP lỗi",), ("ghế rạp êm",), ("app đặt vé lỗi",), ("trừ tiền mà không có vé",), ("bị văng",), ("chậm quá",), ("giao diện đẹp, màn hình to",), ("tốt",)]
_APP_RULES = " ".join(f"WHEN {_sql_any('t', n)} THEN '{s}'" for s, n in P.APP_TOPICS.items())


@query(
    f"""SELECT doc_id, CASE WHEN {_sql_any("t", P.APP_FACILITY)} AND NOT {_sql_any("t", P.APP_WORDS)} THEN NULL {_APP_RULES} END AS topic
FROM (SELECT doc_id, lower(phrase || ' ' || coalesce(text, '')) AS t FROM documents JOIN {values(APP_CASES, "phrase")} ON k = doc_id % {len(APP_CASES)})"""
)
def app_review_topic(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", C.app_topic(F.concat_ws(" ", pick(APP_CASES, 0), "text")).alias("topic"))


CAMPAIGNS = [("c1", "#TheThe", "running", "glx"), ("c1", "inging", "running", "glx"), ("c2", "hathe", "ended", None), ("c3", "ing", "planned", None), ("c4", " # ", "running", None), ("c5", "the and", "running", "cgv"), ("c5", "", "running", "cgv")]


@query(
    """WITH r(campaign_id, needle, scope) AS (VALUES ('c1', 'thethe', 'glx'), ('c1', 'inging', 'glx'), ('c2', 'hathe', NULL), ('c4', '#', NULL), ('c5', 'the and', 'cgv')),
t AS (SELECT doc_id AS mention_id, CASE doc_id % 3 WHEN 0 THEN 'glx' WHEN 1 THEN 'cgv' END AS brand_slug, trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g')) AS t FROM documents)
SELECT DISTINCT mention_id, campaign_id FROM t JOIN r ON contains(t, needle) AND (scope IS NULL OR scope = brand_slug)"""
)
def campaign_match(spark, sf_dir):
    d = documents(spark, sf_dir)
    mentions = d.select(F.col("doc_id").alias("mention_id"), F.when(F.col("doc_id") % 3 == 0, "glx").when(F.col("doc_id") % 3 == 1, "cgv").alias("brand_slug"), F.col("text").alias("content_text"))
    keywords = spark.createDataFrame(CAMPAIGNS, "campaign_id string, keyword string, status string, brand_slug string")
    return C.campaign_matches(mentions, keywords)


REGION_CASES = [
    ("ở Sài Gòn", "", "HCM"), ("quận 7", "", "HCM"), ("rạp ở Hà  Nội", "", "HN"), ("Đà Nẵng", "", "Đà Nẵng"), ("can tho", "", "Cần Thơ"), ("hai phong", "", "Hải Phòng"), ("binh duong", "", "Bình Dương"),
    ("galaxy nguyễn du", "", "HCM"), ("cgv vincom bà triệu", "", "HN"), ("ninh kiều", "", "Cần Thơ"), ("phim", "VnExpress", "HN"), ("phim", "Tuổi Trẻ", "HCM"), ("phim", "x", "Khác"), ("hà nội", "thanhnien", "HN"),
]


def _when(text: str, pack: dict[str, str]) -> str:
    return " ".join(f"WHEN regexp_matches({text}, {quoted('(?i)' + p)}) THEN {quoted(name)}" for name, p in pack.items())


@query(
    f"""SELECT doc_id, CASE {_when("t", P.REGION_TEXT)} {_when("t", P.REGION_CINEMA)} {_when("author", P.REGION_AUTHOR)} ELSE 'Khác' END AS region
FROM (SELECT doc_id, phrase || chr(10) || coalesce(text, '') || chr(10) || author AS t, author FROM documents JOIN {values([c[:2] for c in REGION_CASES], "phrase", "author")} ON k = doc_id % {len(REGION_CASES)})"""
)
def mention_region(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", C.region(F.concat(pick(REGION_CASES, 0), F.lit("\n"), "text"), pick(REGION_CASES, 1)).alias("region"))


PROFILES = [("facebook", "Customer#000000001", "p1", "owned", True, 1), ("facebook", "customer 00000002", "p2", "paid", True, 2), ("tiktok", "000000003", "p3", "paid", True, 1), ("tiktok", "", "p4", "owned", True, 2), ("news", "customer", "p5", "owned", False, 1)]
_SQUEEZE = "regexp_replace(lower({}), '[\\s._-]+', '', 'g')"


@query(
    f"""WITH m AS (SELECT c_custkey AS mention_id, CASE c_custkey % 3 WHEN 0 THEN 'facebook' WHEN 1 THEN 'tiktok' ELSE 'news' END AS platform_code, c_name AS author_key,
  CASE WHEN c_custkey % 11 = 0 THEN 'Galaxy Cinema' ELSE '' END AS author_name FROM customer),
p(platform_code, key, source_profile_id, type, position) AS (VALUES ('facebook', 'customer#000000001', 'p1', 'owned', 1), ('facebook', 'customer00000002', 'p2', 'paid', 2), ('tiktok', '000000003', 'p3', 'paid', 1)),
h AS (SELECT mention_id, min_by(type, position) AS type, min_by(source_profile_id, position) AS source_profile_id FROM m JOIN p USING (platform_code)
  WHERE contains({_SQUEEZE.format("author_key")}, key) OR contains({_SQUEEZE.format("author_name")}, key) OR contains(key, {_SQUEEZE.format("author_key")}) GROUP BY mention_id)
SELECT mention_id, CASE WHEN coalesce(type, 'earned') <> 'earned' THEN type WHEN author_name <> '' THEN 'owned' ELSE 'earned' END AS media_type, source_profile_id FROM m LEFT JOIN h USING (mention_id)"""
)
def media_type_resolve(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    m = c.select(
        F.col("c_custkey").alias("mention_id"),
        F.when(F.col("c_custkey") % 3 == 0, "facebook").when(F.col("c_custkey") % 3 == 1, "tiktok").otherwise("news").alias("platform_code"),
        F.col("c_name").alias("author_key"),
        F.when(F.col("c_custkey") % 11 == 0, "Galaxy Cinema").otherwise("").alias("author_name"),
    )
    profiles = spark.createDataFrame(PROFILES, "platform_code string, source_key string, source_profile_id string, media_type string, is_active boolean, position int")
    return C.media_types(m, profiles).select("mention_id", "media_type", "source_profile_id")


KEEP_CASES = [
    ("Galaxy Cinema vui", "glx", True), ("galaxy cinema india", "glx", False), ("cgv", "cgv", True), ("cgv", "glx", False), ("lotte cinema", "lotte", True), ("lotte cinema gần lotte mart", "lotte", False),
    ("beta", "beta", False), ("rạp nào có beta", "beta", True), ("bhd", "bhd", False), ("xem phim bhd", "bhd", True), ("cine star", "cinestar", True), ("cgv", "none", False),
]


@query(f"SELECT doc_id AS mention_id FROM documents JOIN {values([(str(c[2]),) for c in KEEP_CASES], 'label')} ON k = doc_id % {len(KEEP_CASES)} WHERE label = 'True' OR doc_id % 5 = 0")
def purge_competitive(spark, sf_dir):
    """Every fifth mention is linked to a second brand that its text proves."""
    d = documents(spark, sf_dir)
    second = F.when(F.col("doc_id") % 5 == 0, " cinestar").otherwise("")
    m = d.select(F.col("doc_id").alias("mention_id"), F.concat(pick(KEEP_CASES, 0), second).alias("content_text"))
    bridge = d.select(F.col("doc_id").alias("mention_id"), pick(KEEP_CASES, 1).alias("brand_slug")).union(d.where("doc_id % 5 = 0").select("doc_id", F.lit("cinestar")))
    return C.purge_unproved(m, bridge).select("mention_id")


@query("SELECT p_name AS term, brand FROM part JOIN (VALUES ('a', 'red'), ('a', 'blue'), ('b', 'green')) AS h(brand, hint) ON contains(lower(p_name), hint) GROUP BY ALL")
def brand_term_split(spark, sf_dir):
    terms = table(spark, sf_dir, "part").select(F.col("p_name").alias("term")).distinct()
    return C.split_terms(terms, {"a": ["red", "blue"], "b": ["green"]})


@query(
    """WITH x AS (SELECT event_id, (event_id % 4)::INT AS b, (user_id % 4)::INT AS a FROM events)
SELECT CASE WHEN b > 0 AND a = 0 THEN 'losing_all' WHEN b = 0 AND a > 0 THEN 'gaining' WHEN a = 3 AND b IN (1, 2) THEN 'adding' WHEN b = 3 AND a IN (1, 2) THEN 'losing' WHEN a <> b THEN 'replacement' ELSE 'unchanged' END AS category, count(*) AS mentions FROM x GROUP BY 1"""
)
def rebuild_categories(spark, sf_dir):
    sets = F.array(*[F.array(*[F.lit(x) for x in s]).cast("array<string>") for s in ([], ["glx"], ["cgv"], ["glx", "cgv"])])
    e = table(spark, sf_dir, "events")
    both = e.select(F.get(sets, (F.col("event_id") % 4).cast("int")).alias("b"), F.get(sets, (F.col("user_id") % 4).cast("int")).alias("a"))
    return both.groupBy(C.rebuild_category(F.col("b"), F.col("a")).alias("category")).agg(F.count("*").alias("mentions"))
