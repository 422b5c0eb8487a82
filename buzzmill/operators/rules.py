"""Rule packs as data, and classifiers of text built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.text import clauses


def labels_of(text: Column, pack: Mapping[str, Sequence[str]]) -> Column:
    """All labels of which a needle is in the text, in the pack's order."""
    return F.array_compact(F.array(*[F.when(_any(text, needles), F.lit(label)) for label, needles in pack.items()]))


def first_label(text: Column, pack: Mapping[str, Sequence[str]], other: str) -> Column:
    out = F
    for label, needles in pack.items():
        out = out.when(_any(text, needles), F.lit(label))
    return out.otherwise(F.lit(other))


def _any(text: Column, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | text.contains(n)
    return out


def clause_sentiment(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """The last clause that is not neutral decides; within a clause a negative word outweighs."""
    told = F.filter(F.transform(clauses(text), lambda c: F.when(_any(c, negative), "negative").when(_any(c, positive), "positive").otherwise("neutral")), lambda x: x != "neutral")
    return F.coalesce(F.try_element_at(told, F.lit(-1)), F.lit("neutral"))


def keyword_filter(posts: DataFrame, terms: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Posts of which the text or a comment has a term; comments and posts with an excluded term go first."""
    rows = posts.where(~_any(F.lower(F.coalesce("post_text", F.lit(""))), exclude))
    rows = rows.withColumn("comments", F.filter("comments", lambda c: ~_any(F.lower(F.coalesce(c["text"], F.lit(""))), exclude)))
    rows = rows.withColumn("post_match", _any(F.lower(F.coalesce("post_text", F.lit(""))), terms))
    rows = rows.withColumn("comment_matches", F.size(F.filter("comments", lambda c: _any(F.lower(F.coalesce(c["text"], F.lit(""))), terms))))
    return rows.where("post_match or comment_matches > 0")


def keyword_filter_rows(rows: DataFrame, key: str, is_post: Column, terms: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """keyword_filter where posts and comments are rows: post_text, post_match and comment_matches by key, one text held a key."""
    text = F.lower(F.coalesce("text", F.lit("")))
    hit = ~is_post & _any(text, terms) & ~_any(text, exclude)
    found = rows.groupBy(key).agg(F.max(F.when(is_post, F.col("text"))).alias("post_text"), F.count_if(hit).cast("int").alias("comment_matches"))
    post = F.lower(F.coalesce("post_text", F.lit("")))
    return found.where(~_any(post, exclude)).withColumn("post_match", _any(post, terms)).where("post_match or comment_matches > 0")
