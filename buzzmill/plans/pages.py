"""Queries of what pages hold: comments from lines, counts near a mark, embedded objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from buzzmill.functions import pages as G
from buzzmill.plans.queries import query
from buzzmill.plans.texts import documents, expected, pick, values
from buzzmill.sources.tables import table

# A page's text and its comments, "author/label/text" parted by bars.
INSTAGRAM_CASES = [
    ("owner.x\n2d\ncaption here\nanna\n3h\nGreat film\n12 likes\nReply\nsecond line\n7\nben_1\nJuly 2\nNice\nMeta\nAbout", "anna/3h/Great film second line|ben_1/July 2/Nice"),
    ("owner\n1w\ncaption\nanna\n5 giờ trước\nhay quá\nanna\n5 giờ trước\nhay quá", "anna/5 giờ trước/hay quá"),
    ("owner\n1w\nonly a caption", ""), ("", ""), ("a\nb", ""), ("owner\n1w\ncaption\nanna\n2h\nReply\nlost", ""),
]


@query(expected(INSTAGRAM_CASES, "comments"))
def instagram_body_comments(spark, sf_dir):
    found = G.instagram_comments(pick(INSTAGRAM_CASES, 0), F.lit("https://i/p/1"))
    return documents(spark, sf_dir).select("doc_id", F.array_join(F.transform(found, lambda c: F.concat_ws("/", c["author"], c["created_at_label"], c["text"])), "|").alias("comments"))


THREADS_CASES = [
    ("Thread\nowner\n07/31/26\npost text\nTop\nView activity\nanna\n3h\nfirst comment\n12\n1.2K\nben\n·\nTác giả\n2d\nsecond\nline", "anna/3h/first comment|ben/2d/second line"),
    ("a b\nc d\ne f\ng h\nanna\nĐã chỉnh sửa\n07/30/26\nedited comment", "anna/07/30/26/edited comment"), ("", ""), ("owner\n3h\ntext\nTop", ""),
]


@query(expected(THREADS_CASES, "comments"))
def threads_body_comments(spark, sf_dir):
    found = G.threads_comments(pick(THREADS_CASES, 0), F.lit("P1"))
    return documents(spark, sf_dir).select("doc_id", F.array_join(F.transform(found, lambda c: F.concat_ws("/", c["author"], c["created_at"], c["text"])), "|").alias("comments"))


DATE_CASES = [("Thread\nowner\n07/31/26\nx", "07/31/26"), ("seen 1/2/2026 by\n3h", "1/2/2026"), ("a\n3h\nb", "3h"), ("posted 13h ago", "13h"), ("none", None)]


@query(expected(DATE_CASES, "label"))
def page_date_labels(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", G.date_label(pick(DATE_CASES, 0)).alias("label"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id END AS likes, CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id + 1 END AS replies, CASE WHEN page_id % 2 = 0 THEN 1200 ELSE 3 END AS views FROM pages")
def engagement_counts(spark, sf_dir):
    p, n = table(spark, sf_dir, "pages"), F.col("page_id").cast("string")
    mark = F.concat(F.lit('"code":"X('), n, F.lit(')"'))
    near = F.concat(F.lit('{"like_count":1} "code":"other" '), mark, F.lit(', "a":1} '), mark, F.lit(', "like_count": '), n, F.lit(', "direct_reply_count":"'), (F.col("page_id") + 1).cast("string"), F.lit('"'))
    html = F.concat(F.coalesce("html", F.lit("")), F.when(F.col("page_id") % 3 == 0, "").otherwise(near))
    views = G.views_of(F.concat(F.lit("x\n"), F.when(F.col("page_id") % 2 == 0, "1.2K views").otherwise("3 lượt xem")))
    c = G.counts_near(html, mark, {"likes": "like_count", "replies": "direct_reply_count"})
    return p.withColumn("c", c).select("page_id", "c.likes", "c.replies", views.alias("views"))


JSON_CASES = [
    ('<script>var data = {"a": {"b": "}{"}, "c": [1]}; more }', '{"a": {"b": "}{"}, "c": [1]}'), ('var data = {"a": "x\\"}"} }', '{"a": "x\\"}"}'), ('var data = {"a": {', None), ("nothing", None), ("var data = {}", "{}"),
]


@query(f"SELECT page_id, label AS object FROM pages JOIN {values([c[1:] for c in JSON_CASES], 'label')} ON k = page_id % {len(JSON_CASES)}")
def embedded_objects(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", G.balanced_json(F.concat(F.coalesce("html", F.lit("")), pick(JSON_CASES, 0, "page_id")), "var data").alias("object"))
