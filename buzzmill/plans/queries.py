"""Registered queries of the mention engine, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from buzzmill.functions import text as X
from buzzmill.functions import times as D
from buzzmill.operators import freshness, metrics, rules, tables
from buzzmill.sources.tables import crawl_log, links, mentions, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

MENTIONS = """WITH e AS (SELECT *, regexp_extract(props, '([0-9]+)', 1)::INT AS k FROM events),
m AS (SELECT event_id AS mention_id, ts AS occurred_at, CASE event_id % 5 WHEN 0 THEN 'facebook' WHEN 1 THEN 'tiktok' WHEN 2 THEN 'youtube' WHEN 3 THEN 'threads' ELSE 'news' END AS platform_code,
  CASE WHEN event_type IN ('view', 'click') THEN 'post' ELSE 'comment' END AS mention_kind,
  CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' ELSE 'neutral' END AS sentiment,
  CASE WHEN k < 10 THEN 'owned' WHEN k < 25 THEN 'paid' ELSE 'earned' END AS media_type, k >= 95 AS is_spam,
  CASE WHEN k % 10 < 2 THEN 'want_to_see' WHEN k % 10 = 2 THEN 'not_interested' END AS intent,
  CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN '' ELSE user_id::VARCHAR END AS author_key, user_id, k,
  (ts + INTERVAL 7 HOUR)::DATE AS day FROM e)"""


def links_sql(entity: str, n: int, shift: int, every: int) -> str:
    return f"b AS (SELECT mention_id, user_id % {n} AS {entity} FROM m UNION SELECT mention_id, (user_id + {shift}) % {n} FROM m WHERE mention_id % {every} = 0)"


COUNTS = {
    "buzz_count": "count(*)",
    **{f"{v}_count": f"count(*) FILTER (WHERE {c} = '{v}')" for c, vs in (("mention_kind", ("post", "comment")), ("sentiment", ("positive", "negative", "neutral")), ("media_type", ("owned", "paid", "earned"))) for v in vs},
}


INTENT_COUNTS = {"intent_want_count": "count(*) FILTER (WHERE intent = 'want_to_see')", "intent_total": "count(intent)"}


def daily_sql(bridge: tuple, names: list[str] | None = None, authors: bool = True, share: bool = True) -> str:
    """As WITH ..., d AS (...): the daily table of an entity."""
    key = bridge[0]
    parts = [f"{(COUNTS | INTENT_COUNTS)[n]} AS {n}" for n in (names or COUNTS)] + (["count(DISTINCT author_key) AS unique_authors"] if authors else [])
    sov = ", round(100.0::DOUBLE * buzz_count / sum(buzz_count) OVER (PARTITION BY metric_date, platform_code), 3) AS sov_pct" if share else ""
    return f"""{MENTIONS}, {links_sql(*bridge)},
a AS (SELECT day AS metric_date, {key}, coalesce(platform_code, 'all') AS platform_code, {", ".join(parts)}
  FROM m JOIN b USING (mention_id) WHERE NOT is_spam GROUP BY GROUPING SETS ((day, {key}, platform_code), (day, {key}))),
d AS (SELECT *{sov} FROM a)"""


def query(sql: str | None = None):
    """Register a function under its name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


BRANDS, TOPICS, CAMPAIGNS, FILMS = ("brand_id", 7, 3, 3), ("topic_id", 8, 5, 4), ("campaign_id", 12, 7, 5), ("film_id", 9, 4, 3)
TOPIC_COUNTS = ["buzz_count", "positive_count", "negative_count", "neutral_count"]
AS_OF, WEEK_BEFORE = "2024-01-28", "2024-01-21"


@query(daily_sql(BRANDS) + " SELECT * FROM d")
def daily_brand_metrics(spark, sf_dir):
    m = mentions(spark, sf_dir)
    return metrics.daily_metrics(m, links(m, *BRANDS), ["brand_id"])


TOPIC_SQL = f"""{MENTIONS}, b AS (SELECT mention_id, user_id % 7 AS brand_id FROM m), t AS (SELECT mention_id, user_id % 8 AS topic_id FROM m UNION SELECT mention_id, (user_id + 5) % 8 FROM m WHERE mention_id % 4 = 0)
SELECT day AS metric_date, brand_id, topic_id, coalesce(platform_code, 'all') AS platform_code, {", ".join(f"{COUNTS[c]} AS {c}" for c in TOPIC_COUNTS)}
FROM m JOIN b USING (mention_id) JOIN t USING (mention_id) WHERE NOT is_spam GROUP BY GROUPING SETS ((day, brand_id, topic_id, platform_code), (day, brand_id, topic_id))"""


@query(TOPIC_SQL)
def daily_topic_metrics(spark, sf_dir):
    m = mentions(spark, sf_dir)
    both = m.select("mention_id", (F.col("user_id") % 7).alias("brand_id")).join(links(m, *TOPICS), "mention_id")
    return metrics.daily_metrics(m, both, ["brand_id", "topic_id"], TOPIC_COUNTS, authors=False, share=False)


@query(daily_sql(CAMPAIGNS, TOPIC_COUNTS) + " SELECT * FROM d")
def daily_campaign_metrics(spark, sf_dir):
    m = mentions(spark, sf_dir)
    return metrics.daily_metrics(m, links(m, *CAMPAIGNS), ["campaign_id"], TOPIC_COUNTS)


FILM_COUNTS = ["buzz_count", "post_count", "comment_count", "positive_count", "negative_count", "neutral_count", "intent_want_count", "intent_total"]
FILM_SQL = (
    daily_sql(FILMS, FILM_COUNTS)
    + """, v AS (SELECT day AS metric_date, film_id, coalesce(platform_code, 'all') AS platform_code, sum(view_count)::BIGINT AS view_count
  FROM (SELECT DISTINCT day, film_id, platform_code, mention_id, floor(o_totalprice)::BIGINT AS view_count FROM m JOIN b USING (mention_id) JOIN orders ON o_orderkey = mention_id WHERE NOT is_spam)
  GROUP BY GROUPING SETS ((day, film_id, platform_code), (day, film_id)))
SELECT d.*, coalesce(view_count, 0) AS view_count FROM d LEFT JOIN v USING (metric_date, film_id, platform_code)"""
)


@query(FILM_SQL)
def daily_film_metrics(spark, sf_dir):
    return film_metrics(spark, sf_dir)


def film_metrics(spark, sf_dir, first=None, last=None):
    m = mentions(spark, sf_dir)
    bridge = links(m, *FILMS)
    views = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.floor("o_totalprice").cast("long").alias("view_count"))
    seen = metrics.post_views(m, bridge, views, "film_id", first, last)
    out = metrics.daily_metrics(m, bridge, ["film_id"], FILM_COUNTS, first=first, last=last).join(seen, ["metric_date", "film_id", "platform_code"], "left")
    return out.withColumn("view_count", F.coalesce("view_count", F.lit(0)))


def health_sql(key: str) -> str:
    told = "nullif(sum(positive_count) + sum(negative_count) + sum(neutral_count), 0)"
    return f""" SELECT {key}, {", ".join(f"sum({c})::BIGINT AS {c}" for c in TOPIC_COUNTS)},
round(100.0::DOUBLE * sum(positive_count)::DOUBLE / {told}::DOUBLE, 2) AS positive_pct, round(100.0::DOUBLE * sum(negative_count)::DOUBLE / {told}::DOUBLE, 2) AS negative_pct
FROM d WHERE platform_code = 'all' AND metric_date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' GROUP BY {key}"""


@query(daily_sql(BRANDS) + health_sql("brand_id"))
def brand_health_7d(spark, sf_dir):
    m = mentions(spark, sf_dir)
    daily = metrics.daily_metrics(m, links(m, *BRANDS), ["brand_id"], TOPIC_COUNTS, authors=False, share=False, first=WEEK_BEFORE, last=AS_OF)
    return metrics.health(daily, "brand_id", AS_OF)


@query(daily_sql(FILMS) + health_sql("film_id"))
def film_health_7d(spark, sf_dir):
    return metrics.health(film_metrics(spark, sf_dir, WEEK_BEFORE, AS_OF), "film_id", AS_OF)


@query(f"{MENTIONS}, {links_sql(*FILMS)} SELECT film_id, platform_code, mention_kind, count(*) AS n, count(DISTINCT mention_id) AS mentions FROM m JOIN b USING (mention_id) GROUP BY ALL")
def inventory_by_film_platform(spark, sf_dir):
    m = mentions(spark, sf_dir)
    return m.join(links(m, *FILMS), "mention_id").groupBy("film_id", "platform_code", "mention_kind").agg(F.count("*").alias("n"), F.count_distinct("mention_id").alias("mentions"))


@query(f"{MENTIONS}, {links_sql(*FILMS)} SELECT film_id, count(*) FILTER (WHERE sentiment = 'positive') AS praise, count(*) FILTER (WHERE sentiment = 'negative') AS criticism FROM m JOIN b USING (mention_id) WHERE occurred_at >= TIMESTAMP '2024-01-28' - INTERVAL 30 DAY GROUP BY film_id")
def wom_inventory_30d(spark, sf_dir):
    m = mentions(spark, sf_dir).where(f"occurred_at >= timestamp_ntz'{AS_OF} 00:00:00' - interval 30 days")
    return m.join(links(m, *FILMS), "mention_id").groupBy("film_id").agg(F.count_if(F.col("sentiment") == "positive").alias("praise"), F.count_if(F.col("sentiment") == "negative").alias("criticism"))


LOG = "WITH e AS (SELECT *, regexp_extract(props, '([0-9]+)', 1)::INT AS k FROM events), l AS (SELECT event_id, 'u' || user_id || '/' || k AS url, event_type AS keyword, CASE WHEN k % 11 <> 0 THEN ts END AS content_ts, ts AS seen_at FROM e)"


@query(f"{LOG} SELECT keyword, count(*) AS discovered, count(DISTINCT url) AS urls, count(content_ts) AS dated, min(seen_at) AS first_seen, max(seen_at) AS last_seen FROM l GROUP BY keyword")
def crawl_state_summary(spark, sf_dir):
    return crawl_log(spark, sf_dir).groupBy("keyword").agg(F.count("*").alias("discovered"), F.count_distinct("url").alias("urls"), F.count("content_ts").alias("dated"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"))


@query(f"{LOG} SELECT url, arg_min(keyword, event_id) AS keyword, min(seen_at) AS first_seen, max(seen_at) AS last_seen, max(content_ts) AS content_ts, count(*) AS crawl_count FROM l GROUP BY url")
def crawled_urls_upsert(spark, sf_dir):
    """Crawl state by URL: the first keyword stays, times widen, the count grows."""
    return crawl_log(spark, sf_dir).groupBy("url").agg(F.min_by("keyword", "event_id").alias("keyword"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.max("content_ts").alias("content_ts"), F.count("*").alias("crawl_count"))


DELTA = f"""{MENTIONS}, o AS (SELECT mention_id, user_id % 7 AS brand FROM m), n AS (SELECT mention_id, (user_id + CASE WHEN mention_id % 10 = 0 THEN 1 ELSE 0 END) % 7 AS brand FROM m),
c AS (SELECT coalesce(o.brand, n.brand) AS brand, o.mention_id IS NOT NULL AS was, n.mention_id IS NOT NULL AS is_now FROM o FULL JOIN n ON o.mention_id = n.mention_id AND o.brand = n.brand)
SELECT brand, count(*) FILTER (WHERE NOT was) AS added, count(*) FILTER (WHERE NOT is_now) AS removed, count(*) FILTER (WHERE was AND is_now) AS unchanged FROM c GROUP BY brand"""


@query(DELTA)
def brand_delta_report(spark, sf_dir):
    """Links added, removed and unchanged by brand between two taggings."""
    m = mentions(spark, sf_dir)
    old = m.select("mention_id", (F.col("user_id") % 7).alias("brand"), F.lit(1).alias("was"), F.lit(0).alias("is_now"))
    new = m.select("mention_id", ((F.col("user_id") + F.when(F.col("mention_id") % 10 == 0, 1).otherwise(0)) % 7).alias("brand"), F.lit(0).alias("was"), F.lit(1).alias("is_now"))
    each = old.union(new).groupBy("mention_id", "brand").agg(F.max("was").alias("was"), F.max("is_now").alias("is_now"))
    return each.groupBy("brand").agg(F.count_if(F.col("was") == 0).alias("added"), F.count_if(F.col("is_now") == 0).alias("removed"), F.count_if((F.col("was") == 1) & (F.col("is_now") == 1)).alias("unchanged"))


@query("WITH c AS (SELECT o_custkey, o_orderdate::DATE AS d, count(*) AS n, min(o_orderkey) AS first_at FROM orders GROUP BY ALL) SELECT o_custkey, d AS premiere, n FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first_at) = 1")
def milestone_mode(spark, sf_dir):
    """The commonest candidate date of each entity, ties to the first seen."""
    c = table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_at"))
    return c.groupBy("o_custkey").agg(F.max_by(F.struct("d", "n"), F.struct("n", -F.col("first_at"))).alias("r")).select("o_custkey", F.col("r.d").alias("premiere"), "r.n")


@query("SELECT region, count(c_custkey) AS n FROM (SELECT r_name AS region, r_regionkey FROM region UNION ALL VALUES ('ANTARCTICA', -1)) LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY region")
def region_distribution(spark, sf_dir):
    """Counts over a fixed list of regions, zero-filled: one of them has no nation."""
    found = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("k")).join(table(spark, sf_dir, "nation"), "n_nationkey")
    counts = found.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.sum("k").alias("k"))
    fixed = table(spark, sf_dir, "region").select("r_name", "r_regionkey").union(spark.createDataFrame([("ANTARCTICA", -1)], "r_name string, r_regionkey int"))
    return fixed.join(counts, "r_regionkey", "left").select(F.col("r_name").alias("region"), F.coalesce("k", F.lit(0)).alias("n"))


STALE = "CASE WHEN content_ts IS NULL THEN 'unknown' WHEN content_ts < TIMESTAMP '2024-01-28' - INTERVAL 14 DAY THEN 'stale' ELSE 'fresh' END AS freshness"


@query(f"{LOG} SELECT event_id, {STALE} FROM l")
def freshness_annotate(spark, sf_dir):
    return crawl_log(spark, sf_dir).select("event_id", freshness.state(F.col("content_ts"), AS_OF).alias("freshness"))


@query(f"{LOG}, s AS (SELECT *, {STALE} FROM l) SELECT keyword, count(*) AS discovered, count(*) FILTER (WHERE freshness = 'stale') AS stale, count(*) FILTER (WHERE freshness = 'fresh') AS fresh, count(*) FILTER (WHERE freshness = 'unknown') AS unknown FROM s GROUP BY keyword")
def keyword_crawl_stats(spark, sf_dir):
    s = crawl_log(spark, sf_dir).withColumn("freshness", freshness.state(F.col("content_ts"), AS_OF))
    return s.groupBy("keyword").agg(F.count("*").alias("discovered"), *[F.count_if(F.col("freshness") == v).alias(v) for v in ("stale", "fresh", "unknown")])


@query(f"""{LOG}, s AS (SELECT *, {STALE}, split_part(url, '/', 1) AS crawler FROM l),
r AS (SELECT *, sum((freshness = 'fresh')::INT) OVER (PARTITION BY crawler ORDER BY event_id) AS reset FROM s),
u AS (SELECT *, sum((freshness = 'stale')::INT) OVER (PARTITION BY crawler, reset ORDER BY event_id) AS run FROM r),
t AS (SELECT *, min(CASE WHEN run >= 12 THEN event_id END) OVER (PARTITION BY crawler) AS stop FROM u)
SELECT event_id, crawler FROM t WHERE stop IS NULL OR event_id <= stop""")
def stale_run_cutoff(spark, sf_dir):
    s = crawl_log(spark, sf_dir).withColumn("freshness", freshness.state(F.col("content_ts"), AS_OF)).withColumn("crawler", F.substring_index("url", "/", 1))
    return freshness.cut_after_stale(s, "crawler", "event_id", "freshness", 12).select("event_id", "crawler")


@query(f"{LOG}, r AS (SELECT *, split_part(url, '/', 1) AS crawler, row_number() OVER (PARTITION BY split_part(url, '/', 1) ORDER BY content_ts DESC NULLS LAST, event_id) AS newest_rank FROM l) SELECT event_id, newest_rank, newest_rank <= 10 AS in_final FROM r WHERE newest_rank <= 30")
def newest_rank_final(spark, sf_dir):
    """Newest items of each crawler: ranked, cut at 30, final at 10."""
    s = crawl_log(spark, sf_dir).withColumn("crawler", F.substring_index("url", "/", 1))
    return freshness.newest(s, "crawler", "content_ts", "event_id", 10).where("newest_rank <= 30").select("event_id", "newest_rank", "in_final")


@query(f"{LOG} SELECT event_id, url, content_ts FROM l ORDER BY content_ts DESC NULLS LAST, event_id LIMIT 100")
def select_newest(spark, sf_dir):
    """The 100 newest items (a top-k report), whose times are in any of three fields, in seconds, milliseconds or as text."""
    log, k = crawl_log(spark, sf_dir).select("event_id", "url", "content_ts"), F.col("event_id") % 3
    at = F.unix_micros(F.col("content_ts").cast("timestamp"))
    text = F.date_format(F.col("content_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    rows = log.select("*", F.when(k == 0, text).when(k == 1, "soon").alias("created_at"), F.when(k > 0, text).otherwise("1").alias("timestamp"), F.when(at < 0, at).alias("taken_at_timestamp"))
    return freshness.select_newest(rows, 100, "event_id").select("event_id", "url", "content_ts")


@query(f"{LOG}, seen AS (SELECT DISTINCT url FROM l WHERE event_id % 3 = 0) SELECT DISTINCT url FROM l WHERE event_id % 3 <> 0 AND url NOT IN (SELECT url FROM seen)")
def incremental_new_urls(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    return log.where("event_id % 3 <> 0").select("url").distinct().join(log.where("event_id % 3 = 0").select("url"), "url", "left_anti")


@query(f"{LOG} SELECT url, keyword, content_ts, event_id FROM l QUALIFY row_number() OVER (PARTITION BY url ORDER BY event_id DESC) = 1")
def url_merge_last_wins(spark, sf_dir):
    return tables.latest_rows(crawl_log(spark, sf_dir).select("url", "keyword", "content_ts", "event_id"), "url", "event_id")


@query(f"{LOG}, f AS (SELECT url, keyword, min(event_id) AS pos FROM l GROUP BY ALL) SELECT url, string_agg(keyword, ',' ORDER BY pos) AS keywords FROM f GROUP BY url")
def url_keyword_lists(spark, sf_dir):
    return tables.ordered_values(crawl_log(spark, sf_dir), "url", "keyword", "event_id").select("url", F.array_join("keywords", ",").alias("keywords"))


@query("SELECT doc_id, source, text IS NULL AS empty FROM documents QUALIFY row_number() OVER (PARTITION BY md5(source || '|' || substr(lower(text), 1, 160)) ORDER BY doc_id) = 1")
def content_dedupe_md5(spark, sf_dir):
    """The first document of each source with the same first 160 characters."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").isNull().alias("empty"), tables.content_key(F.col("source"), text=F.lower("text")).alias("content"))
    return d.groupBy("content").agg(F.min_by(F.struct("doc_id", "source", "empty"), "doc_id").alias("r")).select("r.*")


@query(f"{MENTIONS} SELECT mention_id, user_id, day FROM m QUALIFY row_number() OVER (PARTITION BY user_id, day, mention_kind ORDER BY occurred_at, mention_id) = 1")
def dedupe_mentions(spark, sf_dir):
    m = mentions(spark, sf_dir).withColumn("day", D.business_day(F.col("occurred_at")))
    return tables.first_rows(m, ["user_id", "day", "mention_kind"], ["occurred_at", "mention_id"]).select("mention_id", "user_id", "day")


@query(f"{MENTIONS} SELECT mention_id, author_key FROM m QUALIFY row_number() OVER (PARTITION BY author_key ORDER BY mention_id) = 1 OR coalesce(author_key, '') = ''")
def dedupe_keep_blank(spark, sf_dir):
    """First mention of each author; those without an author all stay."""
    m = mentions(spark, sf_dir)
    blank = F.coalesce("author_key", F.lit("")) == ""
    return tables.first_rows(m.where(~blank), ["author_key"], ["mention_id"]).unionByName(m.where(blank)).select("mention_id", "author_key")


@query(f"{MENTIONS}, {links_sql(*CAMPAIGNS)}, c AS (SELECT campaign_id, platform_code, count(*) AS n FROM m JOIN b USING (mention_id) GROUP BY ALL) SELECT campaign_id, string_agg(platform_code, ',' ORDER BY n DESC, platform_code) AS platforms FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY n DESC, platform_code) <= 2) GROUP BY campaign_id")
def campaign_primary_platforms(spark, sf_dir):
    m = mentions(spark, sf_dir)
    c = m.join(links(m, *CAMPAIGNS), "mention_id").groupBy("campaign_id", "platform_code").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "platform_code")))
    return c.groupBy("campaign_id").agg(F.array_join(F.transform(F.slice(ranked, 1, 2), lambda x: x["platform_code"]), ",").alias("platforms"))


@query(daily_sql(BRANDS) + " SELECT metric_date, brand_id, platform_code, buzz_count FROM d ORDER BY metric_date DESC, brand_id, platform_code LIMIT 5000")
def latest_metrics_limit(spark, sf_dir):
    """The latest 5000 metric rows (an export report)."""
    d = daily_brand_metrics(spark, sf_dir).select("metric_date", "brand_id", "platform_code", "buzz_count")
    return d.orderBy(F.desc("metric_date"), "brand_id", "platform_code").limit(5000)


@query("SELECT e.event_id, coalesce(o.o_orderstatus, '') AS status, coalesce(o.o_orderpriority, 'none') AS priority FROM events e LEFT JOIN orders o ON o.o_orderkey = e.event_id AND o.o_totalprice > 100000")
def mention_export_left_join(spark, sf_dir):
    """Left join with a predicate in ON: mentions without a match stay."""
    o = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("event_id"), "o_orderstatus", "o_orderpriority")
    return table(spark, sf_dir, "events").select("event_id").join(o, "event_id", "left").select("event_id", F.coalesce("o_orderstatus", F.lit("")).alias("status"), F.coalesce("o_orderpriority", F.lit("none")).alias("priority"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 30) AND NOT EXISTS (SELECT 1 FROM events WHERE event_id = o_orderkey)")
def orphan_posts_anti(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    o = o.join(table(spark, sf_dir, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    return o.join(table(spark, sf_dir, "events").select(F.col("event_id").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def tagged_mentions_semi(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(r, "o_orderkey", "left_semi")


@query(f"{MENTIONS}, a AS (SELECT DISTINCT day, platform_code FROM m WHERE is_spam), b AS (SELECT DISTINCT day, platform_code FROM m WHERE mention_id % 40 = 0) SELECT * FROM a EXCEPT SELECT * FROM b")
def metric_key_difference(spark, sf_dir):
    m = mentions(spark, sf_dir).withColumn("day", D.business_day(F.col("occurred_at")))
    return tables.key_difference(m.where("is_spam"), m.where("mention_id % 40 = 0"), ["day", "platform_code"])


UPSERT = f"""{MENTIONS}, r AS (SELECT user_id, mention_id AS seq, mention_id % 2 AS fresh, author_key, CASE WHEN k % 3 = 0 THEN NULL ELSE k END AS likes, sentiment AS post_text FROM m)
SELECT user_id, arg_max(post_text, (fresh, seq)) AS post_text, arg_max(likes, (fresh, seq)) FILTER (WHERE likes IS NOT NULL) AS likes,
  arg_min(author_key, (fresh, seq)) FILTER (WHERE author_key IS NOT NULL) AS author_key FROM r GROUP BY user_id"""


@query(UPSERT)
def upsert_posts(spark, sf_dir):
    """Text always last, likes the last known, author the first known."""
    rows = mentions(spark, sf_dir).select("user_id", F.col("mention_id").alias("seq"), "author_key", F.when(F.col("k") % 3 != 0, F.col("k")).alias("likes"), F.col("sentiment").alias("post_text"))
    return tables.upsert(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1"), ["user_id"], "seq", latest=["post_text"], keep=["author_key"])


@query(f"{MENTIONS}, o AS (SELECT day, platform_code, count(*) AS n FROM m WHERE mention_id % 2 = 0 GROUP BY ALL), f AS (SELECT day, platform_code, count(*) AS n FROM m WHERE NOT is_spam GROUP BY ALL) SELECT * FROM o WHERE day < DATE '2024-01-15' UNION ALL SELECT * FROM f WHERE day >= DATE '2024-01-15'")
def prune_upsert_scope(spark, sf_dir):
    m = mentions(spark, sf_dir).withColumn("day", D.business_day(F.col("occurred_at")))
    count = lambda rows: rows.groupBy("day", "platform_code").agg(F.count("*").alias("n"))
    return tables.prune_and_upsert(count(m.where("mention_id % 2 = 0")), count(m.where("not is_spam")), ["day", "platform_code"], F.col("day") >= F.lit("2024-01-15").cast("date"))


@query(f"{MENTIONS}, o AS (SELECT mention_id, user_id % 7 AS brand FROM m), n AS (SELECT mention_id, (user_id + 1) % 7 AS brand FROM m), t AS (SELECT mention_id FROM m WHERE k < 20) SELECT * FROM o WHERE mention_id NOT IN (SELECT mention_id FROM t) UNION SELECT * FROM n WHERE mention_id IN (SELECT mention_id FROM t)")
def replace_brand_links(spark, sf_dir):
    m = mentions(spark, sf_dir)
    return tables.replace_links(m.select("mention_id", (F.col("user_id") % 7).alias("brand")), m.select("mention_id", ((F.col("user_id") + 1) % 7).alias("brand")), m.where("k < 20"), "mention_id")


@query("WITH p AS (SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS post_text, list(text ORDER BY turn) FILTER (WHERE turn > 0) AS comments FROM conversations GROUP BY conv_id) SELECT conv_id, contains(lower(coalesce(post_text, '')), 'the') AS post_match, len(list_filter(coalesce(comments, []), lambda c: contains(lower(c), 'the') AND NOT contains(lower(c), 'hathe')))::INT AS comment_matches FROM p WHERE NOT contains(lower(coalesce(post_text, '')), 'hathe') AND (contains(lower(coalesce(post_text, '')), 'the') OR len(list_filter(coalesce(comments, []), lambda c: contains(lower(c), 'the') AND NOT contains(lower(c), 'hathe'))) > 0)")
def keyword_filter_nested(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").where("turn >= 0")
    return rules.keyword_filter_rows(rows, "conv_id", F.col("turn") == 0, ["the"], ["hathe"]).select("conv_id", "post_match", "comment_matches")


@query("SELECT doc_id FROM documents WHERE NOT (length(trim(text)) < 40 OR regexp_matches(text, '^[^A-Za-z]*$'))")
def noise_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.where(~((F.length(F.trim("text")) < 40) | F.col("text").rlike("^[^A-Za-z]*$"))).select("doc_id")


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^a-z0-9#]+', ' ', 'g'), ' +', ' ', 'g')) AS folded FROM documents")
def fold_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.fold(F.col("text")).alias("folded"))


TOPIC_PACK = {"service": ["the ", "and "], "price": ["que ", "des "], "place": ["und ", "der "], "film": ["los ", "con "]}


@query("SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN {' OR '.join(f'contains(lower(text), {n!r})' for n in ns)} THEN '{t}' END" for t, ns in TOPIC_PACK.items()) + ") AS topics FROM documents")
def cx_topics(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(rules.labels_of(F.lower("text"), TOPIC_PACK), ",").alias("topics"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(text), {n!r})' for n in ns)} THEN '{t}'" for t, ns in TOPIC_PACK.items()) + " ELSE 'other' END AS topic FROM documents")
def app_topic(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rules.first_label(F.lower("text"), TOPIC_PACK, "other").alias("topic"))


@query("WITH c AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(' ' || replace(lower(text), ' ', '  '), '[.!?;,\n]+|[^\\p{L}\\p{N}_](?:but|however|nhưng|tuy  nhiên)(?:[^\\p{L}\\p{N}_]|$)'), lambda p: CASE WHEN contains(p, 'der') OR contains(p, 'ing') THEN 'negative' WHEN contains(p, 'que') OR contains(p, 'and') THEN 'positive' END), lambda x: x IS NOT NULL) AS s FROM documents) SELECT doc_id, coalesce(s[-1], 'neutral') AS sentiment FROM c")
def clause_sentiment(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", rules.clause_sentiment(F.col("text"), ["que", "and"], ["der", "ing"]).alias("sentiment"))


@query("SELECT page_id, rtrim(regexp_replace(url, '[?#].*$', ''), '/') AS url FROM pages")
def url_canonical(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.canonical_url(F.col("url")).alias("url"))


@query("SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang FROM pages")
def html_embedded_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"))


@query("SELECT o_orderkey, o_orderdate::DATE AS by_iso, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE END AS by_format FROM orders")
def parse_dt(spark, sf_dir):
    """Dates written in two formats and as junk, parsed back."""
    o = table(spark, sf_dir, "orders")
    label = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "MMM d, yyyy")).otherwise("soon")
    now = F.lit("2024-01-28").cast("timestamp")
    return o.select("o_orderkey", F.to_date(D.parse_time(F.date_format("o_orderdate", "yyyy-MM-dd"), now)).alias("by_iso"), F.to_date(D.parse_time(label, now)).alias("by_format"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN round(l_extendedprice)::BIGINT ELSE (l_quantity * 1000)::BIGINT END AS n FROM lineitem")
def compact_count(spark, sf_dir):
    """Counts written as 1,234 and as 12K, read back."""
    li = table(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_orderkey") % 2 == 0, F.format_number(F.round("l_extendedprice"), 0)).otherwise(F.concat(F.col("l_quantity").cast("long"), F.lit("K")))
    return li.select("l_orderkey", "l_linenumber", D.compact_count(label).alias("n"))


@query("SELECT event_id, date_trunc('second', ts) AS content_ts FROM events")
def content_timestamp(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))
    value = F.when(F.col("event_id") % 2 == 0, F.col("s").cast("string")).otherwise((F.col("s") * 1000).cast("string"))
    return e.select("event_id", D.content_time(value).cast("timestamp_ntz").alias("content_ts"))


@query("SELECT s_nationkey, round(100.0::DOUBLE * sum(s_acctbal) / nullif(sum(sum(s_acctbal)) OVER (), 0), 4) AS share_pct, count(*) AS cinemas FROM supplier GROUP BY s_nationkey")
def gbo_share(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.sum("s_acctbal").alias("box"), F.count("*").alias("cinemas"))
    total = F.sum("box").over(Window.partitionBy(F.lit(1)))
    return s.select("s_nationkey", F.round(100.0 * F.col("box") / F.nullif(total, F.lit(0.0)), 4).alias("share_pct"), "cinemas")
