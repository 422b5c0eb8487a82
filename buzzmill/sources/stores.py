"""Reviews and ratings out of app stores' pages: nodes of embedded JSON, however deep they lie."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.sources.files import store_histogram

#: How a page names its data, and the nodes that count.
SERVER_DATA = r'(?s)<script[^>]*id="serialized-server-data"[^>]*>(.*?)</script>'
REVIEW_FIELDS = ("rating", "contents", "reviewerName")


@F.udtf(returnType="n long, kind string, node string")
class Nodes:
    """Review and rating nodes of a JSON text at any depth, in the order in which a reader meets them; none of what is no JSON."""

    def eval(self, text: str):
        try:
            left = [json.loads(text)] if text else []
        except (ValueError, RecursionError):
            return
        n = 0
        while left:
            node = left.pop()
            if isinstance(node, dict):
                kind = node.get("$kind")
                if kind == "Review" or all(f in node for f in REVIEW_FIELDS):
                    yield n, "review", json.dumps(node, ensure_ascii=False)
                if kind == "Ratings" and "ratingCounts" in node:
                    yield n, "ratings", json.dumps(node, ensure_ascii=False)
                n += 1
            children = list(node.values()) if isinstance(node, dict) else node if isinstance(node, list) else []
            left += reversed(children)


def server_data(html: Column) -> Column:
    """The embedded data of a page, as text; null if it has none."""
    return F.nullif(F.regexp_extract(html, SERVER_DATA, 1), F.lit(""))


def page_nodes(pages: DataFrame, data: Column, keep: tuple[str, ...]) -> DataFrame:
    """Columns `keep` of pages, n, kind and node (a variant) of every node."""
    rows = pages.select(*keep, data.alias("_data")).where("_data is not null")
    found = rows.lateralJoin(Nodes(F.col("_data").outer()))
    return found.select(*keep, "n", "kind", F.try_parse_json("node").alias("node"))


def _of(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("node", path, kind)


def page_reviews(nodes: DataFrame, app: str, order: tuple[str, ...]) -> DataFrame:
    """Reviews (app, id, rating, title, review, author, updated, reply) of nodes, each id of an app once: the first by order and n.

    Nodes without an id, or without one to five stars, are none.
    """
    rows = nodes.where("kind = 'review'").select(app, F.struct(*order, "n").alias("_at"), _of("$.id").alias("id"), _of("$.rating", "int").alias("rating"), _of("$.title").alias("title"), _of("$.contents").alias("review"), _of("$.reviewerName").alias("author"), _of("$.date").alias("updated"), _of("$.response.contents").alias("reply"))
    rest = ["rating", "title", "review", "author", "updated", "reply"]
    good = rows.where("id <> '' and rating between 1 and 5")
    return good.groupBy(app, "id").agg(F.min_by(F.struct(*rest), "_at").alias("r")).select(app, "id", "r.*")


def page_ratings(nodes: DataFrame, app: str, order: tuple[str, ...]) -> DataFrame:
    """score, ratings and histogram (from one star to five) of each app: the last node with five counts, which the page lists from five stars to one."""
    rows = nodes.where("kind = 'ratings'").select(app, F.struct(*order, "n").alias("_at"), _of("$.ratingAverage", "double").alias("score"), _of("$.totalNumberOfRatings", "long").alias("ratings"), _of("$.ratingCounts", "array<long>").alias("counts"))
    first = F.transform(F.slice("counts", 1, 5), lambda c: F.coalesce(c, F.lit(0)))
    rows = rows.where(F.size("counts") >= 5).withColumn("histogram", store_histogram(first, descending=True))
    return rows.groupBy(app).agg(F.max_by(F.struct("score", "ratings", "histogram"), "_at").alias("r")).select(app, "r.*")


FEED = "struct<feed:struct<entry:array<struct<id:struct<label:string>,`im:rating`:struct<label:string>,title:struct<label:string>,content:struct<label:string>,author:struct<name:struct<label:string>>,`im:version`:struct<label:string>,updated:struct<label:string>>>>>"


def feed_reviews(pages: DataFrame, app: str, page: str, feed: Column) -> DataFrame:
    """Reviews of a store's feed by page: entries with a rating, each id of an app once, at its first page and place; those without an id all stay."""
    entries = F.from_json(feed, FEED)["feed"]["entry"]
    rows = pages.select(app, page, F.posexplode(entries).alias("n", "e")).where(F.col("e")["im:rating"].isNotNull())
    label = lambda c: F.col("e")[c]["label"]
    rows = rows.select(app, page, "n", F.nullif(label("id"), F.lit("")).alias("id"), F.coalesce(label("im:rating").try_cast("int"), F.lit(0)).alias("rating"), label("title").alias("title"), label("content").alias("review"), F.col("e.author.name.label").alias("author"), label("im:version").alias("version"), label("updated").alias("updated"))
    rest = ["rating", "title", "review", "author", "version", "updated"]
    first = rows.where("id is not null").groupBy(app, "id").agg(F.min_by(F.struct(*rest), F.struct(page, "n")).alias("r")).select(app, "id", "r.*")
    return first.unionByName(rows.where("id is null").select(app, "id", *rest))
