"""Registered queries of table changes, nested records and counts, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.functions import text as X
from buzzmill.operators import tables
from buzzmill.plans.queries import FILMS, MENTIONS, links_sql, query
from buzzmill.sources.tables import links, mentions, table

REGIONS = ("north", "central", "south", "east", "west")


@query(f"{MENTIONS}, {links_sql(*FILMS)} SELECT mention_id, film_id FROM m JOIN b USING (mention_id) WHERE occurred_at >= CASE film_id % 3 WHEN 0 THEN TIMESTAMP '2024-01-10' WHEN 1 THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '1970-01-01' END")
def listening_window(spark, sf_dir):
    """Links to films that were listened to at the mention's time; a film without a start always was."""
    m = mentions(spark, sf_dir)
    begins = F.when(F.col("film_id") % 3 == 0, "2024-01-10").when(F.col("film_id") % 3 == 1, "2024-01-20").cast("timestamp")
    films = spark.range(9).select(F.col("id").alias("film_id")).withColumn("listening_from", begins)
    linked = m.join(links(m, *FILMS), "mention_id").join(films, "film_id")
    return linked.where("listening_from is null or occurred_at >= listening_from").select("mention_id", "film_id")


@query(f"{MENTIONS} SELECT user_id % 50 AS app, author_key, k % 5 AS rating, sentiment AS review, arg_max(mention_id, (mention_id % 2, mention_id)) AS mention_id, count(*) FILTER (WHERE mention_id % 2 = 1) AS merged FROM m GROUP BY ALL")
def twin_reviews(spark, sf_dir):
    """Reviews alike in app, author, rating and text are one, with the newer id."""
    r = mentions(spark, sf_dir).select((F.col("user_id") % 50).alias("app"), "author_key", (F.col("k") % 5).alias("rating"), F.col("sentiment").alias("review"), "mention_id")
    return tables.merge_twins(r.where("mention_id % 2 = 0"), r.where("mention_id % 2 = 1"), ["app", "author_key", "rating", "review"], "mention_id")


@query("SELECT p_partkey, p_size > 25 OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS is_active FROM part")
def guard_keep_active(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") > 25).alias("is_active"))
    return tables.keep_active(p, table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")


@query("WITH o AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS period, o_orderkey FROM orders) SELECT * FROM o WHERE o_orderkey % 2 = 1 UNION ALL SELECT * FROM o WHERE o_orderkey % 2 = 0 AND NOT EXISTS (SELECT 1 FROM o n WHERE n.o_orderkey % 2 = 1 AND n.o_custkey = o.o_custkey AND n.period = o.period)")
def replace_periods(spark, sf_dir):
    """Periods that the new rows name are replaced as a whole."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("period"), "o_orderkey")
    return tables.replace_keys(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey", "period"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def cascade_delete(spark, sf_dir):
    """Children of rows that were deleted go too."""
    left = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(left, "l_orderkey", "left_semi")


@query("WITH s AS (SELECT o_custkey AS c_custkey, arg_max(o_orderpriority, o_orderkey) AS v FROM orders GROUP BY 1) SELECT c_custkey, coalesce(v, c_mktsegment) AS value, v IS NOT NULL AND v IS DISTINCT FROM c_mktsegment AS changed FROM customer LEFT JOIN s USING (c_custkey)")
def mirror_column(spark, sf_dir):
    source = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("value"))
    return tables.mirror(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("value")), source, "c_custkey", "value")


@query("SELECT conv_id, string_agg(turn, ',' ORDER BY turn % 2, turn) AS turns FROM (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, turn % 3 ORDER BY turn % 2, turn) = 1) GROUP BY conv_id")
def merge_comments(spark, sf_dir):
    """Comments of two crawls, the first one's before the other's; each external id once."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") % 2).alias("crawl"), (F.col("turn") % 3).alias("external_id"))
    merged = tables.merge_first_rows(c, "conv_id", "external_id", ["crawl", "turn"])
    return merged.select("conv_id", F.nullif(F.array_join(F.transform("items", lambda x: x["turn"].cast("string")), ","), F.lit("")).alias("turns"))


@query(f"{MENTIONS}, c AS (SELECT platform_code, sentiment AS before, CASE k % 3 WHEN 0 THEN 'positive' WHEN 1 THEN NULL ELSE sentiment END AS after FROM m) SELECT platform_code, count(*) FILTER (WHERE after IS NOT NULL AND after IS DISTINCT FROM before) AS updated, count(*) FILTER (WHERE after IS NULL AND before IS NOT NULL) AS cleared FROM c GROUP BY platform_code")
def classification_changes(spark, sf_dir):
    after = F.when(F.col("k") % 3 == 0, "positive").when(F.col("k") % 3 == 1, None).otherwise(F.col("sentiment"))
    return tables.change_counts(mentions(spark, sf_dir).withColumn("after", after), "platform_code", "sentiment", "after")


@query(f"{MENTIONS} SELECT platform_code, count(*) AS n FROM m WHERE is_spam GROUP BY platform_code")
def purge_dry_run(spark, sf_dir):
    return mentions(spark, sf_dir).where("is_spam").groupBy("platform_code").agg(F.count("*").alias("n"))


COUNTED = ", ".join(f"count(*) FILTER (WHERE r = {k}) AS {name}" for k, name in enumerate(REGIONS))


@query(f"{MENTIONS}, c AS (SELECT user_id % 9 AS film_id, user_id % 8 AS r FROM m) SELECT film_id, {COUNTED}, count(*) FILTER (WHERE r >= {len(REGIONS)}) AS other FROM c GROUP BY film_id")
def screens_by_region(spark, sf_dir):
    """Counts over a fixed list of regions, the unmapped in `other`."""
    m, r = mentions(spark, sf_dir), F.col("user_id") % 8
    named = [F.count_if(r == k).alias(name) for k, name in enumerate(REGIONS)]
    return m.groupBy((F.col("user_id") % 9).alias("film_id")).agg(*named, F.count_if(r >= len(REGIONS)).alias("other"))


@query("SELECT p_partkey, (unnest(range(len(x))))::INT AS sort_order, unnest(x) AS milestone FROM (SELECT p_partkey, string_split(p_name, ' ') AS x FROM part)")
def milestone_order(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("sort_order", "milestone"))


@query(r"SELECT p_partkey, regexp_replace(lower(p_name), '[\s._-]+', '', 'g') AS squeezed FROM part")
def key_squeeze(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.squeeze(F.col("p_name")).alias("squeezed"))


@query("SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'comment_id=' || page_id AS comment_url FROM pages")
def comment_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.with_parameter(F.col("url"), "comment_id", F.col("page_id").cast("string")).alias("comment_url"))
