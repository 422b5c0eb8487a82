"""Importance resampling towards a target: documents whose word features are likelier in the target than in the corpus.

Words are rows with their position; a window over each document leads to the words that follow, so a row holds the runs of
every order that start there. Runs are hashed to buckets at once, and only buckets are stored, counted and joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buzzmill.llm.shared import forget_shuffles, keyed, materialize
from buzzmill.operators.ranks import numbered

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDERS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), WORD.replace("[^", "[")), "")


def feature_buckets(docs: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """row_key and b1, b2, ...: one row a word, with the bucket of the run of 1, 2, ... words that starts there, null beyond the end.

    docs has row_key and text. Rows of one document are one window, so no more than a document's words are held together.
    """
    split = docs.repartition("row_key").select("row_key", _words(F.col("text")).alias("words"))
    # not posexplode: before it Spark would split every text once more, to drop those without words ahead of the shuffle
    placed = split.select("row_key", F.posexplode_outer("words").alias("place", "w1")).where("w1 is not null")
    along = Window.partitionBy("row_key").orderBy("place")
    for order in range(2, orders + 1):
        placed = placed.withColumn(f"w{order}", F.lead("w1", order - 1).over(along))
    bucket = lambda order: F.when(F.col(f"w{order}").isNotNull(), F.crc32(F.concat_ws(" ", *[f"w{k}" for k in range(1, order + 1)])) % buckets).cast("int")
    return placed.select("row_key", *[bucket(order).alias(f"b{order}") for order in range(1, orders + 1)])


def counts(features: DataFrame, orders: int = ORDERS) -> DataFrame:
    """bucket and n, of the features of every order together: at most one row a bucket, added up before the shuffle."""
    runs = [features.groupBy(F.col(f"b{order}").alias("bucket")).agg(F.count("*").alias("n")) for order in range(1, orders + 1)]
    together = runs[0]
    for more in runs[1:]:
        together = together.unionByName(more)
    return together.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and gain, for each bucket of own: at most one row a bucket."""
    total = lambda c: float(c.agg(F.sum("n")).first()[0] or 0)
    s, t = total(own) + buckets, total(target) + buckets
    both = own.select("bucket", F.col("n").cast("double").alias("s")).join(target.select("bucket", F.col("n").cast("double").alias("t")), "bucket", "left")
    ratio = (F.coalesce("t", F.lit(0.0)) + 1) * F.lit(s) / ((F.col("s") + 1) * F.lit(t))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A long that follows a Gumbel distribution times 1000, the same for an id whenever it is asked for; a null id is an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is 1, 2, ... for those drawn and null for the others.

    Features of a null or empty text, or one without words: none, weight 0. Rows with equal or null ids are documents of their
    own, ranked after equal scores by id (null last). An empty table gives no rows; an empty target counts as no features.
    Other columns are ignored. Texts are split into rows of one word, so a very long one needs the memory of one window.
    """
    spark = docs.sparkSession
    if buckets > 1_000_000:
        raise ValueError("gains are broadcast: at most 1,000,000 buckets")
    rows = keyed(docs)
    features = materialize(feature_buckets(rows, orders, buckets), "features")
    forget_shuffles(spark)
    aimed = feature_buckets(target.select(F.monotonically_increasing_id().alias("row_key"), "text"), orders, buckets)
    gain = materialize(gains(counts(features, orders), counts(aimed, orders), buckets), "gains")
    names = [f"b{k}" for k in range(1, orders + 1)]
    for b in names:
        features = features.join(F.broadcast(gain.select(F.col("bucket").alias(b), F.col("gain").alias(f"gain_{b}"))), b, "left")
    add = lambda columns: sum(columns[1:], columns[0])
    sums = features.groupBy("row_key").agg(F.count("b1").alias("n_words"), add([F.count(b) for b in names]).alias("n_features"), add([F.coalesce(F.sum(f"gain_{b}"), F.lit(0)) for b in names]).alias("total"))
    found = rows.select("row_key", "doc_id").join(sums, "row_key", "left").select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_words", "n_features", "total")])
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0).cast("long"))
    scored = materialize(found.withColumn("weight", weight).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).drop("total"), "scored")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    ranked = numbered(scored.where(enough), [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features"])
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def _sql_words(key: str, table: str) -> str:
    return f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM {table}"


_SQL_RUNS = "unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS f"

#: The checksum goes bit by bit, lowest first; its polynomial is a fixed value.
ORACLE = f"""
WITH d AS ({_sql_words("doc_id", "documents")}), a AS (SELECT doc_id, {_SQL_RUNS} FROM d), b AS (SELECT {_SQL_RUNS} FROM ({_sql_words("item_id", "benchmark")})),
bytes AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM a UNION SELECT f FROM b)),
bits AS (SELECT f, [((instr('0123456789ABCDEF', x[2 * (i // 8) + CASE WHEN i % 8 < 4 THEN 2 ELSE 1 END]) - 1) >> (i % 4)::INT) & 1 for i in range(0, 4 * len(x))] AS b FROM bytes),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % {BUCKETS} AS bucket FROM bits),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM a JOIN hashed USING (f) GROUP BY ALL), t AS (SELECT bucket, count(*)::DOUBLE AS t FROM b JOIN hashed USING (f) GROUP BY ALL),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + {BUCKETS}) / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM a JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY ALL),
h AS (SELECT doc_id, len(w) AS n_words, ('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d),
z AS (SELECT doc_id, n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM h LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * {PERCENT} // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (doc_id)
"""
