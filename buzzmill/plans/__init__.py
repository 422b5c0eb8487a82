"""plans of the mention engine."""

from buzzmill.plans import cleaning, crawl, feeds, labels, pages, posts, queries, records, reports, seeds, streams, texts

__all__ = ["cleaning", "crawl", "feeds", "labels", "pages", "posts", "queries", "records", "reports", "seeds", "streams", "texts"]
