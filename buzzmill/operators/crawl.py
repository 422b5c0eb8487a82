"""Records of crawls: which results to keep, how to merge and dedupe details, when to stop, and the log of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buzzmill.functions.text import collapse
from buzzmill.operators.freshness import Limits, stopped_rows


def search_filter(results: DataFrame, title: str, terms: Sequence[str]) -> DataFrame:
    """Results (pos, keyword, url) whose keyword is the title or a term, the first of each address; blank addresses go."""
    spark = results.sparkSession
    wanted = spark.createDataFrame([(t,) for t in dict.fromkeys((title, *terms)) if t], "t string").select(collapse(F.col("t")).alias("_term")).distinct()
    rows = results.withColumn("url", F.trim("url")).where("url <> ''").withColumn("_term", collapse(F.col("keyword"))).join(wanted, "_term", "left_semi").drop("_term")
    first = rows.groupBy("url").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "url"]), "pos").alias("r"))
    kept = F.lit(title) if title else F.col("keyword")
    return first.select("url", "r.*").withColumn("filter_keyword", kept).withColumn("filter_status", F.lit("selected_by_exact_title_variants"))


def retries(error: Column, html: Column, current_url: Column, stale: Column, coverage: Column) -> Column:
    """Whether a detail is to be fetched again: it failed, and was neither stale nor got its page."""
    done = F.coalesce(stale, F.lit(False)) | ~F.coalesce(coverage, F.lit(True)) | (html.isNotNull() & (html != "") & current_url.isNotNull() & (current_url != ""))
    return ~done & F.coalesce(error != "", F.lit(False))


def merge_records(records: DataFrame, new: DataFrame, url: str, seq: str) -> DataFrame:
    """records with those of new: an address in both takes the new record, at the old one's place; rows without address all stay.

    `place` orders the result. seq orders both tables; of several new records of an address the last counts, of several old ones the first place.
    """
    rows = records.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    blank = F.coalesce(F.trim(url), F.lit("")) == ""
    rest = [c for c in rows.columns if c != "_new"]
    keyed = rows.where(~blank).groupBy(url).agg(F.max_by(F.struct(*rest), F.struct("_new", F.when(F.col("_new") == 1, F.col(seq)).otherwise(-F.col(seq)))).alias("r"), F.min(F.struct("_new", seq)).alias("place"))
    merged = keyed.select("r.*", F.col("place._new").alias("_new"), F.col(f"place.{seq}").alias("_place"))
    return merged.unionByName(rows.where(blank).withColumn("_place", F.col(seq))).withColumn("place", F.struct("_new", "_place")).drop("_new", "_place")


def dedupe_records(records: DataFrame, url: str, seq: str) -> DataFrame:
    """The first record of each address; records without one all stay."""
    blank = F.coalesce(F.trim(url), F.lit("")) == ""
    rest = [c for c in records.columns if c != url]
    first = records.where(~blank).groupBy(url).agg(F.min_by(F.struct(*rest), seq).alias("r")).select(url, "r.*")
    return first.unionByName(records.where(blank))


def stop_details(rows: DataFrame, key: str, order: str, state: str, most_stale: int = 25, most: int | None = None) -> DataFrame:
    """Rows of each key until most_stale of them were stale, at most `most`, with stop_reason on the last: stale_limit, max_items or exhausted."""
    return stopped_rows(rows, key, order, state, Limits(0, most_stale, most or 0))


#: Why a search is left, in the order in which a round asks.
ROUND_REASONS = ("keyword_runtime_limit", "runtime_limit", "max_items", "idle_limit", "empty_limit")


def stopped_rounds(log: DataFrame, key: str, number: str, most: int, idle: int, empty: int, key_seconds: float, seconds: float) -> DataFrame:
    """Rounds of a search (key, number, elapsed seconds at its start, found: new items, known: items seen before) up to the one that ends it.

    Adds `total` (new items so far, at most `most`) and stop_reason on the last round: the key's time or all time is over at its start
    (such a round finds nothing), `most` items are found, `idle` rounds in a row found nothing new, or `empty` rounds in a row had found nothing at
    all, new or known; else scroll_exhausted. A key's rounds are few (a search scrolls a few hundred times).
    """
    along = Window.partitionBy(key).orderBy(number)
    late = F.when(F.col("elapsed") >= key_seconds, "keyword_runtime_limit").when(F.col("elapsed") >= seconds, "runtime_limit")
    rounds = log.withColumn("_late", late).withColumn("total", F.sum("found").over(along)).withColumn("_any", F.sum(F.col("found") + F.col("known")).over(along))
    rounds = rounds.withColumn("_at", F.row_number().over(along))
    rounds = rounds.withColumn("_idle", F.col("_at") - F.coalesce(F.max(F.when(F.col("found") > 0, F.col("_at"))).over(along), F.lit(0)))
    rounds = rounds.withColumn("_empty", F.when(F.col("_any") == 0, F.col("_at")).otherwise(0))
    reason = F.coalesce("_late", F.when(F.col("total") >= most, "max_items").when(F.col("_idle") >= idle, "idle_limit").when(F.col("_empty") >= empty, "empty_limit"))
    rounds = rounds.withColumn("stop_reason", reason).withColumn("_stops", F.count("stop_reason").over(along))
    kept = rounds.where((F.col("_stops") == 0) | ((F.col("_stops") == 1) & F.col("stop_reason").isNotNull()))
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(number))) == 1
    total = F.least(F.when(F.col("_late").isNotNull(), F.col("total") - F.col("found")).otherwise(F.col("total")), F.lit(most))
    return kept.withColumn("stop_reason", F.when(last & F.col("stop_reason").isNull(), "scroll_exhausted").otherwise(F.col("stop_reason"))).withColumn("total", total).drop("_late", "_any", "_at", "_idle", "_empty", "_stops")


def without_stale(records: DataFrame) -> DataFrame:
    """Records to be formatted: neither stale nor left uncovered."""
    return records.where(~F.coalesce("stale", F.lit(False)) & F.coalesce("coverage", F.lit(True)) & (F.coalesce("freshness", F.lit("")) != "stale"))


def run_log(events: DataFrame) -> DataFrame:
    """Runs (run_id, platform) from start and complete events (at, discovered, crawled): times, duration, counts; completed is null for open ones."""
    done = F.col("kind") == "complete"
    runs = events.groupBy("run_id", "platform").agg(F.min(F.when(~done, F.col("at"))).alias("started_at"), F.max(F.when(done, F.col("at"))).alias("completed_at"), F.max(F.when(done, F.col("discovered"))).alias("urls_discovered"), F.max(F.when(done, F.col("crawled"))).alias("urls_crawled"))
    return runs.withColumn("duration_seconds", F.unix_timestamp("completed_at") - F.unix_timestamp("started_at"))


def recent_runs(runs: DataFrame, n: int) -> DataFrame:
    """The n last started runs of each platform; unknown starts last, ties to the larger run_id."""
    rank = F.row_number().over(Window.partitionBy("platform").orderBy(F.col("started_at").desc_nulls_last(), F.desc("run_id")))
    return runs.withColumn("recency", rank).where(F.col("recency") <= n)


def news_merge(found: DataFrame, known: DataFrame, relevant: Column, most_terms: int | None = None) -> DataFrame:
    """News (post_id, term_pos, ...) of the first most_terms terms, the first of each id, relevant ones alone; known if none is left.

    A good table is never replaced by nothing: whether anything was found is one row, joined to what is known.
    """
    rows = found if most_terms is None else found.where(F.col("term_pos") < most_terms)
    rest = [c for c in rows.columns if c != "post_id"]
    fresh = rows.where(relevant).groupBy("post_id").agg(F.min_by(F.struct(*rest), "term_pos").alias("r")).select("post_id", "r.*")
    any_fresh = fresh.limit(1).agg(F.count("*").alias("_n"))
    return fresh.unionByName(known.join(F.broadcast(any_fresh), F.col("_n") == 0).drop("_n"))


def galaxy_terms(terms: DataFrame, hint: str = "galaxy") -> DataFrame:
    """Terms of a list that name the brand, spaces or not."""
    return terms.where(F.regexp_replace(F.lower("term"), r"[\s_-]+", "").contains(hint))


# The brand's word in a place's name, and words of other places.
PLACE, OTHER_PLACES = "galaxy", ("tourist", "cgv", "lotte", "bhd", "cinestar")


def is_place_of(url: Column, name: str = PLACE, others: Sequence[str] = OTHER_PLACES) -> Column:
    """Whether a map's address is a place of the name: what stands between /maps/place/ and /data= holds it, and none of the others."""
    plain = F.lower(F.coalesce(F.try_url_decode(url), url))
    place = F.get(F.split(F.element_at(F.split(plain, "/maps/place/", 2), -1), "/data=", 2), F.lit(0))
    out = plain.contains("maps/place/") & place.contains(name)
    for other in others:
        out = out & ~place.contains(other)
    return F.coalesce(out, F.lit(False))


def with_language(url: Column, language: str = "vi") -> Column:
    """The address with its hl parameter set."""
    bare = F.regexp_replace(url, r"([?&])hl=[^&#]*&?", "$1")
    bare = F.regexp_replace(bare, r"[?&]$", "")
    return F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit(f"hl={language}"))
