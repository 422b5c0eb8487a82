"""Statistics of whole texts as Spark expressions, used by the quality operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that do not depend on a text's length; the learners use these alone.
RATIOS = ("mean_word", "symbols", "bangs", "capitals", "distinct_words", "dup_lines", "repeats")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _twins(items: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Of sorted items those that equal a neighbour."""
    return F.filter(items, lambda x, k: F.coalesce(same(F.get(items, k - 1), x), F.lit(False)) | F.coalesce(same(F.get(items, k + 1), x), F.lit(False)))


def _repeat_words(words: Column, grams: Column) -> Column:
    """Words in windows found twice or more; equal hashes only choose the windows that are then compared as text."""
    placed = F.sort_array(F.transform(grams, lambda h, k: F.struct(h.alias("h"), k.alias("p"))))
    hashed = let(placed, lambda s: _twins(s, lambda a, b: a["h"] == b["h"]))
    texts = let(hashed, lambda s: F.sort_array(F.transform(s, lambda x: F.struct(F.array_join(F.slice(words, x["p"] + 1, WINDOW_WORDS), " ").alias("t"), x["p"].alias("p")))))
    starts = let(texts, lambda s: F.sort_array(F.transform(_twins(s, lambda a, b: a["t"] == b["t"]), lambda x: x["p"])))
    steps = let(starts, lambda s: F.transform(s, lambda p, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW_WORDS)))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def with_stats(docs: DataFrame) -> DataFrame:
    """docs' doc_id with BASE as longs and RATIOS as doubles; null text counts as empty, ratios of nothing are 0."""
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    split = split.withColumn("w", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), ""))
    split = split.withColumn("l", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    split = split.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    windows = F.when(F.size("w") >= WINDOW_WORDS, F.transform(F.sequence(F.lit(0), F.size("w") - WINDOW_WORDS), lambda k: F.xxhash64(*[F.get("h", k + j) for j in range(WINDOW_WORDS)]))).otherwise(F.array().cast("array<bigint>"))
    split = split.withColumn("g", windows)
    count = lambda pattern: F.regexp_count("t", F.lit(pattern))
    base = split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("g") == F.size(F.array_distinct("g")), F.lit(0)).otherwise(_repeat_words(F.col("w"), F.col("g"))).cast("long").alias("n_repeat_words"),
        count("!").alias("n_bangs"),
        count(r"\p{Lu}").alias("n_capitals"),
        F.size(F.array_distinct("h")).alias("n_distinct"),
        F.size("l").alias("n_lines"),
    )
    ratio = lambda a, b: (F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("double")
    return base.select(
        "doc_id",
        *BASE,
        ratio("word_chars", "n_words").alias("mean_word"),
        ratio("n_symbols", "n_words").alias("symbols"),
        ratio("n_bangs", "n_words").alias("bangs"),
        ratio("n_capitals", "word_chars").alias("capitals"),
        # per root of the words: vocabularies grow more slowly than texts
        (F.col("n_distinct") / F.greatest(F.pow(F.col("n_words").cast("double"), F.lit(0.8)), F.lit(1.0))).alias("distinct_words"),
        ratio("n_dup_lines", "n_lines").alias("dup_lines"),
        ratio("n_repeat_words", "n_words").alias("repeats"),
    )


def labelled(labels: DataFrame, kind: str = "quality") -> DataFrame:
    """doc_id and label 0 or 1, one row a document; documents without an id or whose labels disagree are left out."""
    known = labels.where(f"doc_id is not null and {kind} in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return known.agg(F.min(kind).cast("int").alias("label"), F.max(kind).alias("other")).where("label = other").drop("other")
