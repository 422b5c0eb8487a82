"""Queries of film seeds: parts as a catalogue of films, every second of them known before."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.operators import seeds
from buzzmill.plans.queries import query
from buzzmill.sources.tables import table


def _catalog(spark, sf_dir):
    """Films by part: every third slug comes twice, every seventh has no title, every fourth is not active, every fifth has no release."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    slug = F.concat(F.lit(" f"), (k - F.when(k % 3 == 1, 1).otherwise(0)).cast("string"))
    release = F.when(k % 5 != 0, F.date_add(F.lit("2026-01-01").cast("date"), F.col("p_size")))
    return p.select(k.alias("pos"), slug.alias("slug"), F.when(k % 7 != 0, F.col("p_name")).otherwise("  ").alias("title"), F.col("p_type").alias("short_title"), F.when(k % 2 == 0, "showing").otherwise("").alias("status"), F.when(k % 4 == 0, False).alias("active"), release.alias("release_date"), F.lit(None).cast("date").alias("trailer_date"), F.lit(None).cast("date").alias("press_date"), F.col("p_brand").alias("distributor"), F.lit("a").alias("compare_group"), F.array("p_brand", F.lit("x"), F.lit(None)).alias("aliases"))


CATALOG = """c AS (SELECT p_partkey AS pos, 'f' || (p_partkey - CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END) AS slug, p_name AS title, p_type AS short_title, p_brand, CASE WHEN p_partkey % 2 = 0 THEN 'showing' ELSE 'upcoming' END AS status, p_partkey % 4 <> 0 AS active,
  CASE WHEN p_partkey % 5 <> 0 THEN DATE '2026-01-01' + p_size END AS r FROM part WHERE p_partkey % 7 <> 0), l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY slug ORDER BY pos DESC) = 1)"""


@query(f"WITH {CATALOG} SELECT slug AS film_slug, title AS film_title, status, active AS is_active, r::DATE AS release_date FROM l UNION ALL SELECT 'old', 'An old film', 'gone', false, NULL")
def seed_films(spark, sf_dir):
    old = spark.sql("SELECT slug AS film_slug, 'An old film' AS film_title, '' AS short_title, 'gone' AS status, false AS is_active, date(null) AS release_date, date(null) AS trailer_date, '' AS distributor, '' AS compare_group FROM VALUES ('old'), ('f3') AS t(slug)")
    return seeds.seed_films(old, _catalog(spark, sf_dir)).select("film_slug", "film_title", "status", "is_active", "release_date")


@query(f"WITH {CATALOG}, e AS (SELECT pos, slug, unnest([title, short_title, p_brand, 'x']) AS alias, unnest([0, 1, 2, 3]) AS n FROM c), g AS (SELECT *, trim(regexp_replace(lower(alias), '[^a-z0-9#]+', ' ', 'g')) AS alias_norm FROM e) SELECT alias_norm, trim(alias) AS alias, slug AS film_slug FROM g WHERE length(alias_norm) >= 3 QUALIFY row_number() OVER (PARTITION BY alias_norm ORDER BY pos DESC, n DESC) = 1")
def seed_film_aliases(spark, sf_dir):
    old = spark.sql("SELECT alias_norm, 'old' AS alias, 'old' AS film_slug FROM VALUES ('zzz') AS t(alias_norm)").limit(0)
    return seeds.seed_aliases(old, _catalog(spark, sf_dir))


@query(
    f"""WITH {CATALOG}, a AS (SELECT * FROM l WHERE active), o AS (SELECT slug FROM a WHERE pos % 10 = 1),
m AS (SELECT slug, unnest(['announcement', 'trailer', 'press_sneak', 'premiere', 'w1_decay']) AS kind, unnest([r - 59, r - 45, r - 1, r, r + 5]) AS day, unnest([0, 1, 2, 3, 4]) AS sort_order FROM a WHERE r IS NOT NULL AND pos % 10 <> 1)
SELECT slug AS film_slug, kind, day::DATE AS day, sort_order FROM m UNION ALL SELECT slug, 'custom', DATE '2026-05-02', 1 FROM o UNION ALL SELECT 'old', 'premiere', DATE '2020-01-01', 0"""
)
def seed_film_milestones(spark, sf_dir):
    """Films of every tenth part have two milestones of their own, the first of which has no label."""
    catalog = _catalog(spark, sf_dir)
    tenth = seeds.listed(catalog).where("pos % 10 = 1").select(F.col("slug").alias("film_slug"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"))
    own = tenth.select("film_slug", "pos", F.lit(None).cast("string").alias("kind"), F.when(F.col("pos") == 1, "Own").otherwise(" ").alias("label"), F.lit("2026-05-02").cast("date").alias("day"), F.lit("#000").alias("color"))
    old = spark.sql("SELECT slug AS film_slug, 'premiere' AS kind, 'Old' AS label, DATE '2020-01-01' AS day, '#1' AS color, 0 AS sort_order FROM VALUES ('old'), ('f6') AS t(slug)")
    return seeds.seed_milestones(old, catalog, own).select("film_slug", "kind", "day", "sort_order")


@query(f"WITH {CATALOG} SELECT slug AS film_slug, CASE WHEN pos % 2 = 0 THEN 'known' WHEN pos % 6 = 1 THEN 'k1|k2' ELSE title END AS keywords FROM l UNION ALL SELECT 'old', 'known'")
def seed_movie_queries(spark, sf_dir):
    """Films of even parts have a query already; every sixth film has terms of its own."""
    catalog = _catalog(spark, sf_dir)
    films = seeds.listed(catalog)
    known = films.where("pos % 2 = 0").select("slug").union(spark.sql("SELECT 'old'"))
    old = known.select(F.col("slug").alias("film_slug"), F.lit("q").alias("query_name"), F.array(F.lit("known")).alias("keywords"), F.array().cast("array<string>").alias("hashtags"), F.array(F.lit("p")).alias("platforms"), F.lit(True).alias("is_active"))
    payloads = films.where("pos % 6 = 1").select("slug", F.array(F.lit(" k1 "), F.lit("k2"), F.lit(""), F.lit("k1")).alias("keywords"), F.lit(None).cast("array<string>").alias("hashtags"))
    return seeds.seed_movie_queries(old, catalog, payloads).select("film_slug", F.array_join("keywords", "|").alias("keywords"))
