"""Queries of filters, reports and table rebuilds, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.operators import filters, metrics, reports, tables
from buzzmill.plans.queries import BRANDS, COUNTS, LOG, MENTIONS, TOPIC_COUNTS, daily_sql, links_sql, query
from buzzmill.plans.texts import CATALOG, FILM_CASES, pick, values
from buzzmill.sources.tables import crawl_log, links, mentions, table

_CONV = "SELECT conv_id, turn, turn = 0 AS is_post, coalesce(text, '') AS text, trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g')) AS t FROM conversations"


@query(
    f"""WITH c AS ({_CONV}), h AS (SELECT *, list_filter(['the', 'ing a', 'zzz'], lambda x: contains(t, x)) AS m, contains(t, 'hathe') AS gone FROM c),
k AS (SELECT conv_id FROM h GROUP BY 1 HAVING bool_or(len(m) > 0 AND NOT gone) AND NOT bool_or(is_post AND gone))
SELECT conv_id, turn, array_to_string(m, ',') AS matches FROM h WHERE conv_id IN (SELECT conv_id FROM k) AND (is_post OR NOT gone)"""
)
def term_filter(spark, sf_dir):
    """The first turn of a conversation is its post."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    out = filters.filtered(rows, "conv_id", F.col("turn") == 0, ["The", " ing  a ", "zzz", ""], ["hathe"])
    return out.select("conv_id", "turn", F.array_join("matches", ",").alias("matches"))


@query(
    f"""WITH c AS (SELECT doc_id, doc_id // 4 AS rec, doc_id % 4 = 0 AS is_post, contains(label, 'the_odyssey') AS about, contains(lower(phrase), 'odyssey') AS hit
  FROM documents JOIN {values([(c[0], c[1]) for c in FILM_CASES], "phrase", "label")} ON k = doc_id % {len(FILM_CASES)}),
r AS (SELECT rec FROM c GROUP BY 1 HAVING bool_or(about AND hit)) SELECT doc_id, CASE WHEN hit AND about THEN 'odyssey' ELSE '' END AS matches FROM c WHERE rec IN (SELECT rec FROM r) AND (is_post OR (about AND hit))"""
)
def relevance_gate(spark, sf_dir):
    """Four documents are a record, the first its post; posts that are not about the film lose their matches."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 4).alias("rec"), pick(FILM_CASES, 0).alias("text"))
    out = filters.filtered(rows, "rec", F.col("doc_id") % 4 == 0, ["odyssey"], film=CATALOG[2], blank_posts=True)
    return out.select("doc_id", F.array_join("matches", ",").alias("matches"))


PLACE_CASES = [("ghế êm", "Galaxy Cinema Nguyễn Du", True), ("đi galaxy cinema", "Quán x", True), ("#galaxycinema", "Quán x", False), ("ngon", "Quán x", False)]


@query(f"SELECT doc_id, label = 'True' AS counts FROM documents JOIN {values([(str(c[2]),) for c in PLACE_CASES], 'label')} ON k = doc_id % {len(PLACE_CASES)}")
def place_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", filters.place_matches(pick(PLACE_CASES, 0), pick(PLACE_CASES, 1), ["galaxy cinema", "#galaxycinema"]).alias("counts"))


@query(
    """SELECT 'p' || c_custkey AS post_id, c_custkey || '-' || n AS external_id, CASE WHEN n > 0 THEN c_custkey || '-0' END AS parent_comment_id, CASE WHEN n = 0 THEN 1200 ELSE n END AS likes,
  'https://f/' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '?a=1&' ELSE '?' END || 'comment_id=' || c_custkey || '-' || n AS url FROM customer, (SELECT unnest(range(0, 3)) AS n) WHERE n = 0 OR c_custkey % 3 = 0"""
)
def facebook_comments(spark, sf_dir):
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey").cast("string")
    one = lambda n, likes, other: F.struct(F.concat(key, F.lit(f"-{n}")).alias("id"), F.lit("m").alias("message"), F.lit("t").alias("created_time"), likes.cast("string").alias("like_count"), other.cast("string").alias("reaction_count"))
    replies = F.when(F.col("c_custkey") % 3 == 0, F.array(one(1, F.lit(1), F.lit(None)), one(2, F.lit(None), F.lit(2))))
    comment = one(0, F.lit("1.2K"), F.lit(5))
    whole = F.struct(*[comment[f].alias(f) for f in ("id", "message", "created_time", "like_count", "reaction_count")], replies.alias("replies"))
    url = F.concat(F.lit("https://f/"), key, F.when(F.col("c_custkey") % 2 == 0, "?a=1").otherwise(""))
    posts = c.select(F.concat(F.lit("p"), key).alias("id"), url.alias("permalink_url"), F.array(whole).alias("comments"))
    return filters.flat_comments(posts).select("post_id", "external_id", "parent_comment_id", "likes", "url")


@query("SELECT c_custkey, (contains(lower(c_name), '0001'))::INT + (contains(lower(c_mktsegment), '0001'))::INT AS kept FROM customer")
def nested_keyword_hits(spark, sf_dir):
    items = F.array(F.to_json(F.struct("c_name")), F.to_json(F.struct(F.struct("c_mktsegment").alias("a"))))
    return table(spark, sf_dir, "customer").select("c_custkey", F.size(filters.keyword_hits(items, "0001")).alias("kept"))


@query(f"{MENTIONS} SELECT mention_id FROM m WHERE platform_code = 'tiktok' AND mention_kind = 'comment' AND NOT (k % 2 = 0)")
def optional_conditions(spark, sf_dir):
    m = mentions(spark, sf_dir).withColumn("metadata", F.when(F.col("k") % 2 == 0, F.create_map(F.lit("dis_region"), F.lit("HN"))).otherwise(F.create_map().cast("map<string,string>")))
    return filters.narrowed(m, {"platform_code": "tiktok", "mention_kind": "comment", "is_spam": None}, "dis_region").select("mention_id")


_SETS = "CASE {} WHEN 0 THEN [] WHEN 1 THEN ['glx'] WHEN 2 THEN ['cgv'] ELSE ['cgv', 'glx'] END"
_CHANGES = f"WITH x AS (SELECT event_id, {_SETS.format('event_id % 4')} AS b, {_SETS.format('user_id % 4')} AS a FROM events)"


def _changes(spark, sf_dir):
    sets = F.array(*[F.array(*[F.lit(x) for x in s]).cast("array<string>") for s in ([], ["glx"], ["cgv"], ["cgv", "glx"])])
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("text "), F.col("event_id").cast("string")).alias("text"), F.get(sets, (F.col("event_id") % 4).cast("int")).alias("b"), F.get(sets, (F.col("user_id") % 4).cast("int")).alias("a"))


@query(f"{_CHANGES} SELECT brand, count(*) FILTER (WHERE list_contains(a, brand) AND NOT list_contains(b, brand)) AS added, count(*) FILTER (WHERE list_contains(b, brand) AND NOT list_contains(a, brand)) AS removed, count(*) FILTER (WHERE list_contains(a, brand) AND list_contains(b, brand)) AS unchanged FROM x, (VALUES ('glx'), ('cgv')) v(brand) GROUP BY brand")
def brand_changes(spark, sf_dir):
    return reports.brand_changes(_changes(spark, sf_dir), F.col("b"), F.col("a"))


@query(
    f"""{_CHANGES}, c AS (SELECT event_id, CASE WHEN len(b) > 0 AND len(a) = 0 THEN 'losing_all' WHEN len(b) = 0 AND len(a) > 0 THEN 'gaining' WHEN len(b) = 1 AND len(a) = 1 AND a <> b THEN 'replacement' WHEN len(b) > len(a) THEN 'losing' WHEN len(a) > len(b) THEN 'adding' ELSE 'unchanged' END AS category FROM x)
SELECT category, count(*) AS mentions, 'text ' || min(event_id) AS example, array_to_string(list_sort(list(event_id))[1:50], ',') AS samples FROM c GROUP BY category"""
)
def change_examples(spark, sf_dir):
    out = reports.change_examples(_changes(spark, sf_dir), F.col("b"), F.col("a"), "event_id", "text")
    return out.withColumn("samples", F.array_join(F.transform("samples", lambda x: x.cast("string")), ","))


@query(f"{_CHANGES} SELECT o AS old, n AS new, count(*) AS mentions FROM x, LATERAL (SELECT unnest(b) AS o) p, LATERAL (SELECT unnest(a) AS n) q WHERE NOT list_contains(a, o) AND NOT list_contains(b, n) GROUP BY ALL")
def brand_replacements(spark, sf_dir):
    return reports.replacements(_changes(spark, sf_dir), F.col("b"), F.col("a"))


@query(
    f"""{LOG} SELECT keyword, count(*) AS discovered, count(*) FILTER (WHERE event_id % 3 <> 0) AS "new", count(*) FILTER (WHERE event_id % 3 = 0) AS already_seen, count(*) FILTER (WHERE content_ts < TIMESTAMP '2024-01-14') AS stale,
  count(*) FILTER (WHERE event_id % 4 = 1) AS detail_ok, count(*) FILTER (WHERE event_id % 4 = 2) AS detail_failed, coalesce(sum(event_id % 7) FILTER (WHERE event_id % 4 = 1), 0)::BIGINT AS comments FROM l GROUP BY keyword"""
)
def crawl_keyword_report(spark, sf_dir):
    k = F.col("event_id")
    log = crawl_log(spark, sf_dir).select("keyword", (k % 3 == 0).alias("seen_before"), F.when(F.col("content_ts") < "2024-01-14", "stale").alias("state"), F.when(k % 4 == 1, "ok").when(k % 4 == 2, "failed").alias("detail"), F.when(k % 4 == 1, k % 7).alias("comments"))
    return reports.keyword_stats(log)


@query(
    """WITH n AS (SELECT o_custkey AS film, o_orderkey AS pos, CASE WHEN o_orderkey % 2 = 0 THEN 'trailer' ELSE 'premiere' END AS kind, o_orderdate::DATE AS day, (o_orderdate::DATE - (o_orderkey % 5)::INT) AS day2 FROM orders),
t AS (SELECT film, min(day) FILTER (WHERE kind = 'trailer') AS trailer_date FROM n GROUP BY 1),
e AS (SELECT film, day AS d, pos, 0 AS at2 FROM n WHERE kind = 'premiere' UNION ALL SELECT film, day2, pos, 1 FROM n WHERE kind = 'premiere' AND day2 <> day),
c AS (SELECT film, d, count(*) AS n, min((pos, at2)) AS first FROM e GROUP BY 1, 2)
SELECT t.film, trailer_date, r.d AS release_date FROM t LEFT JOIN (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY film ORDER BY n DESC, first) = 1) r USING (film)"""
)
def film_news_dates(spark, sf_dir):
    o, day = table(spark, sf_dir, "orders"), F.to_date("o_orderdate")
    dates = F.array_distinct(F.array(day, F.date_sub(day, (F.col("o_orderkey") % 5).cast("int"))))
    news = o.select(F.col("o_custkey").alias("film"), F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 2 == 0, "trailer").otherwise("premiere").alias("kind"), F.col("o_orderdate").alias("published"), dates.alias("dates"))
    return reports.film_dates(news)


@query(f"{LOG}, s AS (SELECT event_id, CASE WHEN content_ts IS NULL THEN 'unknown' WHEN content_ts < TIMESTAMP '2024-01-14' THEN 'stale' ELSE 'fresh' END AS freshness FROM l) SELECT event_id, freshness, event_id % 300 <= 100 AS in_final_limit, freshness <> 'stale' AND event_id % 300 <= 100 AS coverage FROM s")
def freshness_fields(spark, sf_dir):
    state = F.when(F.col("content_ts").isNull(), "unknown").when(F.col("content_ts") < "2024-01-14", "stale").otherwise("fresh")
    return reports.annotated(crawl_log(spark, sf_dir), state, F.col("event_id") % 300, 100).select("event_id", "freshness", "in_final_limit", "coverage")


@query(f"{MENTIONS} SELECT user_id, array_to_string(list_sort(coalesce(list(DISTINCT platform_code) FILTER (WHERE k < 3), [])), ',') AS platforms FROM m GROUP BY user_id")
def platforms_or_none(spark, sf_dir):
    out = reports.grouped_values(mentions(spark, sf_dir), "user_id", "platform_code", F.col("k") < 3)
    return out.select("user_id", F.array_join("platform_codes", ",").alias("platforms"))


@query(f"{LOG} SELECT event_id, rank, rank <= 10 AS in_final FROM (SELECT event_id, row_number() OVER (PARTITION BY keyword ORDER BY content_ts DESC NULLS LAST, event_id) AS rank FROM l) WHERE rank <= 30")
def capped_candidates(spark, sf_dir):
    n = reports.limits({"CRAWL_DISCOVERY_LIMIT": "30", "CRAWL_FINAL_LIMIT": "10"})
    return reports.capped(crawl_log(spark, sf_dir), "keyword", [F.col("content_ts").desc_nulls_last(), "event_id"], n["discovery"], n["final"]).select("event_id", "rank", "in_final")


@query(daily_sql(BRANDS, TOPIC_COUNTS, authors=False, share=False) + " SELECT * FROM d UNION ALL BY NAME SELECT DATE '2020-01-01' AS metric_date, 1 AS brand_id, 'all' AS platform_code, 5 AS buzz_count, 0 AS positive_count, 0 AS negative_count, 0 AS neutral_count")
def upsert_without_prune(spark, sf_dir):
    """A fresh table over an older one: its rows win, and rows that it lacks stay."""
    m = mentions(spark, sf_dir)
    fresh = metrics.daily_metrics(m, links(m, *BRANDS), ["brand_id"], TOPIC_COUNTS, authors=False, share=False)
    old = fresh.limit(1).withColumn("buzz_count", F.lit(99).cast("long")).unionByName(spark.sql("SELECT DATE '2020-01-01' AS metric_date, 1L AS brand_id, 'all' AS platform_code, 5L AS buzz_count, 0L AS positive_count, 0L AS negative_count, 0L AS neutral_count"))
    return tables.replace_keys(old, fresh, ["metric_date", "brand_id", "platform_code"])


@query("SELECT user_id AS app, ts::DATE AS day, coalesce(max(event_id) FILTER (WHERE event_id % 2 = 1), max(event_id)) AS ratings FROM events GROUP BY ALL")
def snapshot_upsert(spark, sf_dir):
    """One row an app and day; the last new snapshot (odd ones) counts, else the last old one."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("app"), F.to_date("ts").alias("day"), F.col("event_id").alias("seq"), F.col("event_id").alias("ratings"))
    return tables.upsert(e.where("seq % 2 = 0"), e.where("seq % 2 = 1"), ["app", "day"], "seq", latest=["ratings"])


@query(f"{MENTIONS}, {links_sql(*BRANDS)} SELECT brand_id, {', '.join(f'{COUNTS[c]} AS {c}' for c in TOPIC_COUNTS)} FROM m JOIN b USING (mention_id) WHERE NOT is_spam GROUP BY brand_id")
def full_rebuild(spark, sf_dir):
    """A table made anew from all mentions; nothing of the old one stays."""
    m = mentions(spark, sf_dir)
    wanted = {k: v for k, v in metrics.measures().items() if k in TOPIC_COUNTS}
    return m.where("not is_spam").join(links(m, *BRANDS), "mention_id").groupBy("brand_id").agg(*[v.alias(k) for k, v in wanted.items()])


@query("SELECT c_custkey AS campaign_id, 'new' || (c_custkey % 3) AS keyword FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'old' FROM customer WHERE c_custkey % 2 = 1")
def seed_campaigns(spark, sf_dir):
    """Seeded campaigns get the seed's keywords alone; keywords of others stay."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("campaign_id"))
    seed = c.where("campaign_id % 2 = 0").withColumn("keyword", F.concat(F.lit("new"), (F.col("campaign_id") % 3).cast("string")))
    return tables.replace_keys(c.withColumn("keyword", F.lit("old")), seed, ["campaign_id"])


SEEDS = [("BUILDING", "b1"), ("MACHINERY", "m1"), ("NONE", "n1")]


@query("SELECT c_custkey, slug FROM customer JOIN (VALUES ('BUILDING', 'b1'), ('MACHINERY', 'm1'), ('NONE', 'n1')) v(seg, slug) ON seg = c_mktsegment")
def seed_join(spark, sf_dir):
    seeds = spark.createDataFrame(SEEDS, "c_mktsegment string, slug string")
    return table(spark, sf_dir, "customer").join(seeds, "c_mktsegment").select("c_custkey", "slug")


@query("SELECT event_id FROM events WHERE list_contains(['view', 'click'], event_type)")
def any_of_array(spark, sf_dir):
    wanted = F.array(F.lit("view"), F.lit("click"))
    return table(spark, sf_dir, "events").where(F.array_contains(wanted, F.col("event_type"))).select("event_id")
