"""Queries of imports, crawl records, exports and configuration, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.functions import records as R
from buzzmill.operators import crawl, exports, imports, tables
from buzzmill.plans.labels import now
from buzzmill.plans.queries import LOG, MENTIONS, query
from buzzmill.plans.texts import pick, quoted, values
from buzzmill.sources import config
from buzzmill.sources.tables import crawl_log, mentions, table

POSTS = [
    ("Galaxy Cinema rất hay", "2026-09-01", "positive", "glx", "parsed"), ("CGV Việt Nam tệ", "13h", None, None, None), ("không có gì", "2026-09-01", None, None, None), ("CGV Korea Seoul", "2026-09-01", None, None, None),
    ("rạp cgv và lotte cinema", "07/31/26", "neutral", "cgv,lotte", "parsed"), ("Pass vé Galaxy Cinema", "2026-09-01", None, None, None), ("rạp galaxy ổn", "hôm qua", None, None, None),
]


def _posts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("event_id") % 10 == 9, "google").otherwise("tiktok").alias("platform"), F.col("event_id").cast("string").alias("post_id"), F.col("user_id").cast("string").alias("author_key"),
        pick(POSTS, 0, "event_id").alias("post_text"), F.concat(F.lit("https://x/"), F.col("event_id").cast("string")).alias("post_url"), pick(POSTS, 1, "event_id").alias("post_created_at"), F.lit("1.2K").alias("like_count"),
    )


@query(
    f"""SELECT event_id::VARCHAR AS post_id, sentiment, brands, CASE WHEN brands = 'glx' THEN TIMESTAMP '2026-09-01' ELSE TIMESTAMP '2026-07-31' END AS occurred_at, source AS date_source, '1200' AS likes, true AS verified
FROM events JOIN {values([c[2:] for c in POSTS], "sentiment", "brands", "source")} ON k = event_id % {len(POSTS)} WHERE brands IS NOT NULL AND event_id % 10 <> 9"""
)
def import_posts(spark, sf_dir):
    m = imports.post_mentions(_posts(spark, sf_dir), now())
    return m.select("post_id", "sentiment", F.array_join("brands", ",").alias("brands"), F.col("occurred_at").cast("timestamp_ntz").alias("occurred_at"), F.try_element_at("metadata", F.lit("date_source")).alias("date_source"), F.try_element_at("metadata", F.lit("like_count")).alias("likes"), "verified")


@query(
    """WITH e AS (SELECT event_id, user_id AS post_id, event_id % 3 AS k, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS s, ts, event_id % 2 = 0 AS v FROM events),
o AS (SELECT * FROM e WHERE k = 0), n AS (SELECT * FROM e WHERE k <> 0), a AS (SELECT *, 0 AS g, true AS w FROM o UNION ALL SELECT *, 1, v FROM n)
SELECT post_id, max_by('t' || event_id, (g, event_id)) AS content_text, max_by(s, (g, event_id)) FILTER (WHERE s IS NOT NULL) AS sentiment, max_by(ts, (g, event_id)) FILTER (WHERE w) AS occurred_at,
  max_by(event_id::VARCHAR, (g, event_id)) AS last, max_by(event_id::VARCHAR, (g, event_id)) FILTER (WHERE k = 1) AS k1 FROM a GROUP BY post_id HAVING bool_or(g = 0 OR v)"""
)
def upsert_mentions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    meta = F.create_map(F.lit("last"), F.col("event_id").cast("string"), F.concat(F.lit("k"), (F.col("event_id") % 3).cast("string")), F.col("event_id").cast("string"))
    rows = e.select(F.col("user_id").alias("post_id"), F.col("event_id").alias("seq"), F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("content_text"), F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("sentiment"), F.col("ts").alias("occurred_at"), F.lit(None).cast("string").alias("permalink"), meta.alias("metadata"), (F.col("event_id") % 2 == 0).alias("verified"))
    out = imports.upsert_mentions(rows.where("seq % 3 = 0").drop("verified"), rows.where("seq % 3 <> 0"))
    return out.select("post_id", "content_text", "sentiment", "occurred_at", F.try_element_at("metadata", F.lit("last")).alias("last"), F.try_element_at("metadata", F.lit("k1")).alias("k1"))


@query(f"{LOG} SELECT url, min_by(keyword, event_id) AS keyword, min(event_id) AS pos, 'View' AS filter_keyword FROM l WHERE keyword IN ('view', 'click') GROUP BY url")
def search_filter(spark, sf_dir):
    rows = crawl_log(spark, sf_dir).select("url", F.col("event_id").alias("pos"), "keyword")
    return crawl.search_filter(rows, "View", ["  CLICK ", "view", ""]).select("url", "keyword", "pos", "filter_keyword")


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false ELSE false END AS retry FROM events"""
)
def detail_retries(spark, sf_dir):
    e, k = table(spark, sf_dir, "events"), F.col("event_id") % 5
    retry = crawl.retries(F.when(k != 4, "timeout").otherwise(""), F.when(k == 2, "<html>"), F.when(k == 2, "u"), k == 0, F.when(k == 3, False))
    return e.select("event_id", retry.alias("retry"))


@query(
    f"""{LOG}, r AS (SELECT CASE WHEN event_id % 13 = 0 THEN '' ELSE url END AS url, event_id AS seq, event_id % 2 AS g FROM l),
k AS (SELECT url, CASE WHEN bool_or(g = 1) THEN max(seq) FILTER (WHERE g = 1) ELSE min(seq) END AS seq FROM r WHERE url <> '' GROUP BY url) SELECT url, seq FROM k UNION ALL SELECT url, seq FROM r WHERE url = ''"""
)
def merge_details(spark, sf_dir):
    """Odd events are new details."""
    rows = crawl_log(spark, sf_dir).select(F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("url")).alias("url"), F.col("event_id").alias("seq"))
    return crawl.merge_records(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1"), "url", "seq").select("url", "seq")


@query(f"{LOG}, r AS (SELECT CASE WHEN event_id % 13 = 0 THEN '' ELSE url END AS url, event_id AS seq FROM l) SELECT url, min(seq) AS seq FROM r WHERE url <> '' GROUP BY url UNION ALL SELECT url, seq FROM r WHERE url = ''")
def dedupe_urls(spark, sf_dir):
    rows = crawl_log(spark, sf_dir).select(F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("url")).alias("url"), F.col("event_id").alias("seq"))
    return crawl.dedupe_records(rows, "url", "seq")


@query(
    f"""{LOG}, s AS (SELECT event_id, keyword, CASE WHEN content_ts IS NULL THEN 'unknown' WHEN content_ts < TIMESTAMP '2024-01-14' THEN 'stale' ELSE 'fresh' END AS state FROM l),
c AS (SELECT *, sum((state = 'stale')::INT) OVER w AS stale, row_number() OVER w AS n FROM s WINDOW w AS (PARTITION BY keyword ORDER BY event_id)),
k AS (SELECT *, max(n) OVER (PARTITION BY keyword) AS most FROM c WHERE stale - (state = 'stale')::INT < 25 AND n <= 300)
SELECT event_id, keyword, state, CASE WHEN n = most THEN CASE WHEN stale >= 25 THEN 'stale_limit' WHEN n = 300 THEN 'max_items' ELSE 'exhausted' END END AS stop_reason FROM k"""
)
def stop_rules(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    state = F.when(F.col("content_ts").isNull(), "unknown").when(F.col("content_ts") < "2024-01-14", "stale").otherwise("fresh")
    return crawl.stop_details(log.select("event_id", "keyword", state.alias("state")), "keyword", "event_id", "state", 25, 300)


@query("SELECT event_id FROM events WHERE event_id % 4 NOT IN (0, 1, 2)")
def format_input(spark, sf_dir):
    k = F.col("event_id") % 4
    rows = table(spark, sf_dir, "events").select("event_id", (k == 0).alias("stale"), F.when(k == 1, False).alias("coverage"), F.when(k == 2, "stale").alias("freshness"))
    return crawl.without_stale(rows).select("event_id")


@query(
    """SELECT user_id AS run_id, event_type AS platform, min(ts) FILTER (WHERE event_id % 2 = 0) AS started_at, max(ts) FILTER (WHERE event_id % 2 = 1) AS completed_at, max(event_id) FILTER (WHERE event_id % 2 = 1) AS urls_crawled,
  epoch(max(ts) FILTER (WHERE event_id % 2 = 1))::BIGINT - epoch(min(ts) FILTER (WHERE event_id % 2 = 0))::BIGINT AS duration_seconds FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events) GROUP BY ALL"""
)
def crawl_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("platform"), F.when(F.col("event_id") % 2 == 0, "start").otherwise("complete").alias("kind"), F.date_trunc("second", "ts").cast("timestamp").alias("at"), F.col("event_id").alias("discovered"), F.col("event_id").alias("crawled"))
    runs = crawl.run_log(e)
    return runs.select("run_id", "platform", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started_at", "completed_at")], "urls_crawled", "duration_seconds")


@query("SELECT event_id AS run_id, event_type AS platform, recency FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY CASE WHEN event_id % 10 <> 0 THEN ts END DESC NULLS LAST, event_id DESC) AS recency FROM events) WHERE recency <= 5")
def recent_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("platform"), F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("started_at"))
    return crawl.recent_runs(e, 5).select("run_id", "platform", "recency")


@query(f"{LOG} SELECT DISTINCT url FROM l WHERE keyword IN ('view', 'purchase')")
def known_urls(spark, sf_dir):
    return crawl_log(spark, sf_dir).where(F.col("keyword").isin("view", "purchase")).select("url").distinct()


@query(f"{LOG}, f AS (SELECT url AS post_id, min_by(event_id, (event_id % 7, event_id)) AS event_id FROM l WHERE event_id % 7 < 5 AND keyword <> 'error' GROUP BY url) SELECT post_id, event_id FROM f")
def news_merge(spark, sf_dir):
    found = crawl_log(spark, sf_dir).select(F.col("url").alias("post_id"), (F.col("event_id") % 7 * 10**9 + F.col("event_id")).alias("term_pos"), "event_id", "keyword")
    known = spark.createDataFrame([("old", 0, 0, "view")], "post_id string, term_pos long, event_id long, keyword string")
    return crawl.news_merge(found, known, F.col("keyword") != "error", 5 * 10**9).select("post_id", "event_id")


@query("SELECT DISTINCT p_name AS term FROM part WHERE contains(regexp_replace(lower(p_name), '[ _-]', '', 'g'), 'red')")
def brand_terms(spark, sf_dir):
    return crawl.galaxy_terms(table(spark, sf_dir, "part").select(F.col("p_name").alias("term")), "red").distinct()


@query(
    f"""{MENTIONS}, kept AS (SELECT DISTINCT user_id AS post_id FROM m WHERE mention_kind = 'post' AND k < 30)
SELECT mention_id FROM m WHERE user_id IN (SELECT post_id FROM kept) OR (mention_kind = 'comment' AND k % 10 = 0)"""
)
def export_selection(spark, sf_dir):
    m = mentions(spark, sf_dir).withColumn("post_id", F.col("user_id")).withColumn("kind", F.col("mention_kind"))
    posts = m.where("kind = 'post'").select("post_id", (F.col("k") < 30).alias("kept"))
    return exports.export_rows(m, posts, F.col("k") % 10 == 0).select("mention_id")


@query(f"{MENTIONS}, d AS (SELECT platform_code, user_id, k FROM m GROUP BY ALL) SELECT platform_code, a.n AS rows_before, b.n AS rows_after, a.n - b.n AS removed FROM (SELECT platform_code, count(*) AS n FROM m GROUP BY 1) a JOIN (SELECT platform_code, count(*) AS n FROM d GROUP BY 1) b USING (platform_code)")
def export_summary(spark, sf_dir):
    m = mentions(spark, sf_dir)
    after = exports.deduped(m, tables.content_key(F.col("platform_code"), F.col("user_id").cast("string"), text=F.col("k").cast("string")), "mention_id")
    return exports.summary(m, after, ["platform_code"])


@query("SELECT event_type AS platform, event_id::VARCHAR AS id FROM events ORDER BY event_type DESC, ts::VARCHAR DESC, event_id::VARCHAR DESC LIMIT 50")
def export_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("platform"), "ts", F.col("event_id").cast("string").alias("id"))
    return exports.newest_first(e, ["platform", "ts", "id"]).limit(50).select("platform", "id")


@query("SELECT url, min(event_id) AS first FROM (SELECT 'u' || user_id AS url, event_id FROM events) GROUP BY url ORDER BY url")
def discovery_by_url(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url")).agg(F.min("event_id").alias("first")).orderBy("url")


@query(
    """WITH b AS (SELECT c_mktsegment AS brand_slug, c_mktsegment = 'BUILDING' AS is_primary, CASE c_custkey % 3 WHEN 0 THEN 'keywords' WHEN 1 THEN 'campaign_hashtags' ELSE 'listening_keywords' END AS field, c_custkey AS position, CASE WHEN c_custkey % 2 = 0 THEN upper('t' || c_nationkey) ELSE 't' || c_nationkey END AS term FROM customer),
l AS (SELECT field AS list, * FROM b UNION ALL SELECT 'listening_keywords', * FROM b WHERE field = 'campaign_hashtags' UNION ALL SELECT 'competitor_keywords', * FROM b WHERE field = 'keywords' AND NOT is_primary),
f AS (SELECT list, min_by(term, (brand_slug, position)) AS term, min((brand_slug, position)) AS place FROM l GROUP BY list, lower(term))
SELECT list, (row_number() OVER (PARTITION BY list ORDER BY place) - 1)::INT AS position, term FROM f"""
)
def config_terms(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    field = F.when(F.col("c_custkey") % 3 == 0, "keywords").when(F.col("c_custkey") % 3 == 1, "campaign_hashtags").otherwise("listening_keywords")
    term = F.concat(F.lit("t"), F.col("c_nationkey").cast("string"))
    b = c.select(F.col("c_mktsegment").alias("brand_slug"), (F.col("c_mktsegment") == "BUILDING").alias("is_primary"), field.alias("field"), F.col("c_custkey").alias("position"), F.when(F.col("c_custkey") % 2 == 0, F.upper(term)).otherwise(term).alias("term"))
    return config.merged_terms(b)


@query(
    """WITH q AS (SELECT o_custkey AS slug, max_by(o_orderpriority, o_orderkey) AS p, max(o_orderkey) AS updated_at FROM orders GROUP BY 1)
SELECT c_custkey AS slug, CASE WHEN p IS NULL OR p = '1-URGENT' THEN '1-URGENT' ELSE '1-URGENT,' || p END AS keywords, updated_at FROM customer LEFT JOIN q ON slug = c_custkey"""
)
def film_payloads(spark, sf_dir):
    films = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slug"), F.array(F.lit("1-URGENT")).alias("keywords"))
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("slug"), F.col("o_orderkey").alias("updated_at"), F.array("o_orderpriority").alias("keywords"))
    return config.latest_film_payload(films, found).select("slug", F.array_join("keywords", ",").alias("keywords"), "updated_at")


@query("SELECT conv_id, max(make_timestamp((1700000000 + turn * 60) * 1000000)) AS latest FROM conversations WHERE turn % 2 = 1 GROUP BY conv_id")
def latest_comment(spark, sf_dir):
    """Odd turns are comments."""
    c = table(spark, sf_dir, "conversations").where("turn % 2 = 1")
    at = F.timestamp_seconds(1700000000 + F.col("turn") * 60)
    return c.groupBy("conv_id").agg(F.max(at).cast("timestamp_ntz").alias("latest"))


@query(f"{MENTIONS} SELECT mention_id FROM m QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY occurred_at, mention_id) = 1")
def dedupe_post_mentions(spark, sf_dir):
    """Of the mentions of a post (user and k) the earliest stays, combined before the shuffle."""
    m = mentions(spark, sf_dir)
    return m.groupBy("user_id", "k").agg(F.min(F.struct("occurred_at", "mention_id")).alias("r")).select("r.mention_id")


@query(f"{MENTIONS}, x AS (SELECT *, CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN NULL ELSE k::VARCHAR END AS ext FROM m) SELECT mention_id FROM x QUALIFY row_number() OVER (PARTITION BY user_id, coalesce(nullif(ext, ''), 'own' || mention_id) ORDER BY occurred_at, mention_id) = 1")
def dedupe_comments(spark, sf_dir):
    """Of comments with the same post and external id the earliest stays; blank ids never collapse."""
    m = mentions(spark, sf_dir)
    ext = F.when(F.col("k") % 4 == 0, "").when(F.col("k") % 4 == 1, None).otherwise(F.col("k").cast("string"))
    own = F.coalesce(F.nullif(ext, F.lit("")), F.concat(F.lit("own"), F.col("mention_id").cast("string")))
    return m.groupBy("user_id", own.alias("ext")).agg(F.min(F.struct("occurred_at", "mention_id")).alias("r")).select("r.mention_id")


KNOWN = ("view", "click", "purchase")


@query(f"SELECT event_id FROM events WHERE event_type IN ({', '.join(map(quoted, KNOWN))})")
def known_platforms(spark, sf_dir):
    """Items of unknown platforms go: a semi-join with the table of platforms."""
    known = spark.createDataFrame([(k,) for k in KNOWN], "event_type string")
    return table(spark, sf_dir, "events").join(known, "event_type", "left_semi").select("event_id")
