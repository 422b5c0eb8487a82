"""Mixing sources to target weights with hash-threshold histograms.

Words are summed by source and hash bucket; in each source's cumulative histogram the bucket where its budget runs out
is found, only that bucket is split into finer buckets, and at last documents are taken by comparing their hash with
the source's threshold. Nothing is sorted by document. Thresholds are nested: a larger budget takes a superset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buzzmill.llm.shared import WORD, materialize

HASH_BITS, LEVEL_BITS = 60, 12
#: Rows (one a source) up to which a per-source table is broadcast: at most some 10 MB.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column, text: Column) -> Column:
    """60 bits of md5, which other engines compute alike."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """sizes (source, source_size) with target: share of all words by weight; a source stops at cap times its size and the others share the excess by weight.

    Weights repeat over the sources by name, null last. In the order of what a source holds for its weight, a source is capped
    if the level that the others would share without it is above its own; windows over one row a source find the last level that holds.
    """
    by_name, whole = Window.orderBy(F.asc_nulls_last("source")), Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    before = Window.orderBy(F.col("source_size").cast("double") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level).withColumn("water", F.max(F.when(F.col("weight") * F.col("level") <= F.col("most"), F.col("level"))).over(whole))
    return rows.select("source", "source_size", F.coalesce(F.least("most", F.col("weight") * F.col("water")), "most").alias("target"))


def _per_source(df: DataFrame, budgets: DataFrame, sources: int) -> DataFrame:
    """df beside its source's row of budgets, which is broadcast where `sources` rows are few."""
    table = budgets.withColumnRenamed("source", "_source")
    table = F.broadcast(table) if sources <= BROADCAST_ROWS else table
    return df.join(table, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def thresholds(sized: DataFrame, budgets: DataFrame, sources: int) -> DataFrame:
    """budgets with threshold and share of each source: one aggregation a level, over the boundary buckets alone."""
    budgets = budgets.select("*", *[F.lit(0).cast("long").alias(c) for c in ("prefix", "threshold", "share")])
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        open_ones = budgets.where("rest > 0")
        if open_ones.isEmpty():
            break
        inside = _per_source(sized, open_ones.select("source", "prefix", "rest"), sources).where(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        histogram = inside.groupBy("source", "rest", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high"), F.count("*").alias("n"))
        upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        found = histogram.withColumn("upto", upto).where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
        found = found.select(F.col("source").alias("_of"), "bucket", (F.col("rest") - F.col("upto") + F.col("size")).alias("left"), "low", "high", "n", F.lit(True).alias("hit"))
        settled, hit = F.col("low") == F.col("high"), F.coalesce("hit", F.lit(False))
        both = budgets.join(found, F.col("source").eqNullSafe(F.col("_of")), "left")
        budgets = materialize(
            both.select(
                "source", "source_size", "target", "passes",
                F.when(hit, F.when(settled, 0).otherwise(F.col("left"))).otherwise(F.col("rest")).cast("long").alias("rest"), F.when(hit, F.col("bucket")).otherwise(F.col("prefix")).alias("prefix"),
                F.when(hit & settled, F.col("low")).otherwise(F.col("threshold")).alias("threshold"), F.when(hit & settled, F.expr("left div n")).otherwise(F.col("share")).alias("share"),
            ),
            "mix-budgets",
        )
    return budgets


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Columns doc_id, source, h, size, source_size, target and taken, one row for each row of docs.

    taken is the number of words that the mix takes from the document, repeats counted: its size once for each whole
    pass over its source, once more if its hash is below the source's threshold, and of the document at the threshold
    the first words that the budget still holds. So every source meets its target to a word, and none exceeds
    cap * size. Rows with equal id and text tie in their hash; at a threshold they share the rest evenly, which is
    short by fewer words than there are ties. Null text has size 0; null is a source of its own and comes last; an
    empty table gives an empty result; a very long text is one row and counts like others. Other columns of docs are ignored. A
    table of one row a source is worked out in one task; nothing of it reaches the driver.
    """
    return _with_taken(sized(docs), *plan(docs, weights, share, cap)).select("doc_id", "source", "h", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mix itself: docs' columns, a row for every time that a document is taken, with its first words alone at a threshold.

    Where a text is cut its words are joined by one space; n_chars, if there, is counted anew. Documents of which
    nothing is taken are not in it.
    """
    held = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "source", "text")
    held = held.select("doc", F.col("source").cast("string").alias("source"), hash60(F.col("doc_id"), F.col("text")).alias("h"), word_count(F.col("text")).alias("size"))
    taken = _with_taken(held, *plan(docs, weights, share, cap)).where("taken > 0")
    part = F.when(F.col("taken") % F.col("size") > 0, F.array(F.col("taken") % F.col("size"))).otherwise(F.array().cast("array<bigint>"))
    rows = taken.select("doc", "size", F.explode(F.concat(F.array_repeat("size", F.expr("cast(taken div size as int)")), part)).alias("words"))
    first = F.array_join(F.slice(F.array_remove(F.split("doc.text", r"[\x20\x09-\x0D]+"), ""), F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") == F.col("size"), F.col("doc.text")).otherwise(first)
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[(new[c] if c in new else F.col("doc")[c]).alias(c) for c in docs.columns])


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), hash60(F.col("doc_id"), F.col("text")).alias("h"), word_count(F.col("text")).alias("size"))


def plan(docs: DataFrame, weights: Sequence[float], share: float, cap: float) -> tuple[DataFrame, int]:
    """The budget of every source with its threshold, one row each, and their number."""
    rows = materialize(sized(docs).drop("doc_id"), "mix-sizes")
    aimed = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    aimed = aimed.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    aimed = aimed.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0).cast("long")))
    budgets = materialize(aimed.select("source", "source_size", "target", "passes", (F.col("words") - F.col("passes") * F.col("source_size")).alias("rest")), "mix-budgets")
    sources = budgets.count()
    return thresholds(rows, budgets, sources), sources


def _with_taken(rows: DataFrame, budgets: DataFrame, sources: int) -> DataFrame:
    """rows (source, h, size) with source_size, target and taken."""
    joined = _per_source(rows, budgets.select("source", "source_size", "target", "passes", "threshold", "share"), sources)
    last = F.when(F.col("h") < F.col("threshold"), F.col("size")).when(F.col("h") == F.col("threshold"), F.least("share", "size")).otherwise(0)
    return joined.withColumn("taken", (F.col("passes") * F.col("size") + last).cast("long"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
    1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT *, max(CASE WHEN weight * level <= 2.0 * source_size THEN level END) OVER () AS water FROM levels),
aimed AS (SELECT source, source_size, coalesce(least(2.0::DOUBLE * source_size, weight * water), 2.0::DOUBLE * source_size) AS target FROM water),
budgets AS (SELECT *, floor(target + 0.5)::BIGINT AS words, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS passes FROM aimed),
run AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.passes, b.words - b.passes * b.source_size AS rest, s.h,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS upto, sum(s.size) OVER (PARTITION BY s.source, s.h) AS tied, count(*) OVER (PARTITION BY s.source, s.h) AS ties
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (passes * size + CASE WHEN upto < rest THEN size WHEN upto - tied < rest THEN least(size, (rest - upto + tied) // ties) ELSE 0 END)::BIGINT AS taken
FROM run
"""
