"""Scans of single texts: rules against plain readings of them, and texts of the size that a page or an archive has."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from buzzmill.functions import pages, scans
from buzzmill.operators import classify
from buzzmill.operators import packs as P

FEELING = scans.Sentiment(P.GOOD, P.BAD, P.NEGATIONS, P.CONTRAST, 6)


def plain_sentiment(text):
    """Clause by clause, each phrase looked for on its own, and the words before each hit split anew."""

    def hits(blob, terms, bad):
        taken, out = [], []
        for term in sorted(terms, key=lambda t: len(scans.folded(t)), reverse=True):
            t = scans.folded(term)
            pattern = re.escape(t) if " " in t or len(t) >= 4 or t.startswith("#") else rf"(?<![a-z0-9#]){re.escape(t)}(?![a-z0-9])"
            for m in re.finditer(pattern, blob):
                before = blob[max(0, m.start() - 5) : m.start()]
                if bad and (before.endswith("sau ") or before.endswith("sau")) or any(m.start() < b and a < m.end() for a, b in taken):
                    continue
                taken.append(m.span())
                out.append(m.start())
        return out

    for clause in reversed([p for p in re.split(rf"[.!?;…]+|\n+|\s+(?:{'|'.join(P.CONTRAST)})\s+", text or "", flags=re.I) if p.strip()] or [text or ""]):
        blob = scans.folded(clause)
        turned = lambda at: sum(w in P.NEGATIONS for w in blob[:at].split()[-6:]) % 2  # noqa: B023, E731
        told = sum(-1 if turned(h) else 1 for h in hits(blob, P.GOOD, False)) - sum(-1 if turned(h) else 1 for h in hits(blob, P.BAD, True))
        if told:
            return "positive" if told > 0 else "negative"
    return "neutral"


def test_sentiment_on_random_texts():
    rng, parts = random.Random(6), [*P.GOOD[::3], *P.BAD[::3], *P.NEGATIONS, "sau", "phim", "nhưng", "MÀ", ".", "\n", " \n", "!", "và", "hay", "dở", "x"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "  ", "", "\n"]) for _ in range(rng.randint(0, 14)))
        assert FEELING(text) == plain_sentiment(text), text
    assert FEELING(None) == FEELING("") == "neutral"


def seconds(f, *args):
    began = time.process_time()
    f(*args)
    return time.process_time() - began


def test_sentiment_reads_from_the_end(monkeypatch):
    """Blocks of any size give the same clauses; 1 MB before the clause that tells is not folded, and folding 1 MB is quick."""
    rng, parts = random.Random(7), [*P.GOOD[::3], *P.BAD[::3], "khong", "nhưng", "mà", ".", "…", "?!", "\n", "\u0301", "x"]
    for size in (1, 5, 20):
        monkeypatch.setattr(scans, "BLOCK", size, raising=False)
        for _ in range(500):
            text = "".join(rng.choice(parts) + rng.choice([" ", "  ", "", "\n"]) for _ in range(rng.randint(0, 20)))
            assert FEELING(text) == plain_sentiment(text), text
    assert seconds(FEELING, "phim Điện ảnh. " * 70_000 + "hay") < 0.5
    assert seconds(FEELING, "phim Điện ảnh. " * 70_000) < 3 and scans.folded("Điện e\u0301중\u0301 #9") == "dien e #9"


def test_film_sentiment_reads_from_the_end(spark):
    """The last clause that tells decides, near the end or far from it; 4 MB before it cost no scan of every clause."""
    far = "x. " * (2 * classify.LAST_STOPS)
    cases = [("dở. hay", "positive"), (f"hay. dở. {far}", "negative"), (f"hay, {far}", "positive"), (f"{far}. mà ", "neutral"), (" nhưng ", "neutral"), ("", "neutral"), (None, "neutral"), ("hay...", "positive"), ("dở nhưng hay. x", "positive")]
    got = spark.createDataFrame([(t,) for t, _ in cases], "t string").select(classify.film_sentiment(F.col("t")).alias("s")).collect()
    assert [r["s"] for r in got] == [s for _, s in cases]
    texts = spark.range(0, 40, 1, 1).select(F.concat(F.repeat(F.lit("phim mới ra, rạp gần nhà. "), 4000), F.lit("hay")).alias("t"))
    began = time.time()
    assert texts.where(classify.film_sentiment(F.col("t")) == "positive").count() == 40
    assert time.time() - began < 6


def test_long_texts_take_time_in_proportion():
    """100 KB with 10,000 hits, white space without end, an object of 1 MB, pages of 5,000 comments."""
    hit = scans.folded(P.GOOD[0])
    assert seconds(FEELING, f"khong {hit} " * 10_000) < 2
    assert seconds(FEELING, f"{hit} {' ' * 100_000}x") < 1 and seconds(FEELING, f"{hit}{' ' * 3}\n" * 30_000) < 3
    assert seconds(FEELING, "a" * 300_000 + hit) < 2
    inner = ",".join(f'{{"k{k}": "}}{{ \\" {k}"}}' for k in range(50_000))
    text = f'<script>var data = {{"a": [{inner}]}}; more }}'
    assert len(text) > 10**6 and seconds(scans.balanced, text, "var data") < 1
    assert scans.balanced(text, "var data") == f'{{"a": [{inner}]}}'
    assert scans.balanced("var data = {" + '"' * 9, "var data") is None and seconds(scans.balanced, "var data = {" + '"\\' * 200_000, "var data") < 1
    lines = ["owner", "2d", "caption", *[x for k in range(5000) for x in (f"name_{k}", "3h", f"comment {k}")]]
    assert seconds(scans.blocks, lines, pages.NAME, [pages.AGO, pages.DATE], pages.INSTAGRAM_SKIP, pages.INSTAGRAM_FOOTER) < 1
    assert len(scans.blocks(lines, pages.NAME, [pages.AGO, pages.DATE], pages.INSTAGRAM_SKIP, pages.INSTAGRAM_FOOTER)) == 5001
    found = scans.threads(["Top", *lines[3:]], frozenset(pages.THREADS_NOISE), frozenset(pages.THREADS_TOP), pages.THREADS_DATE)
    assert len(found) == 5000 and found[7] == ("name_7", "3h", "comment 7")


@pytest.mark.parametrize("rows", [[], [(None,)], [("",), (None,), ("owner\n1d\ncaption",)]])
def test_pages_without_comments(spark, rows):
    df = spark.createDataFrame(rows, "body string")
    got = df.select(pages.instagram_comments(F.col("body"), F.lit("u")).alias("i"), pages.threads_comments(F.col("body"), F.lit("p")).alias("t"), pages.balanced_json(F.col("body"), "x").alias("j"), classify.sentiment(F.col("body")).alias("s")).collect()
    assert [tuple(r) for r in got] == [([], [], None, "neutral")] * len(rows)


def test_repeated_comments(spark):
    body = "\n".join(["owner", "2d", "caption", "anna", "3h", "same words", "anna", "3h", "Same Words", "anna", "4h", "same words"])
    got = spark.createDataFrame([(body,)], "body string").select(pages.instagram_comments(F.col("body"), F.lit("u")).alias("c")).first()["c"]
    assert [(c["author"], c["created_at_label"], c["text"], c["url"]) for c in got] == [("anna", "3h", "same words", "u#comment-1"), ("anna", "4h", "same words", "u#comment-2")]


def test_thread_pages():
    """Rules one by one, and a page of many lines."""
    date, chrome = re.compile(pages.THREADS_DATE), re.compile(pages.THREADS_CHROME)
    page = lambda text: scans.ThreadPage(text, frozenset(pages.THREADS_NOISE), frozenset(pages.THREADS_TOP), frozenset(pages.THREADS_ACTIVITY), date, chrome)
    read = lambda lines, owner="": page("\n".join(lines)).read(owner)
    assert read(["a b", "c d", "e f", "g h", "07/30/26", "text", "Top", "anna", "3h", "hi"]) == ("07/30/26", "text", [("anna", "3h", "hi")])
    assert read(["a b", "c d", "e f", "g h i", "j k", "anna", "3h", "hi"]) == ("", "g h i j k", [("anna", "3h", "hi")])
    assert read(["parent", "1d", "quoted", "@Owner", "Translate", "note of hers", "2d", "own text", "anna", "3h", "hi", "1.2K", "there"], "owner") == ("2d", "own text", [("anna", "3h", "hi there")])
    assert read(["owner", "2d", "View activity", "x y", "07/30/26", "a long enough text here"], "owner")[1] == "x y a long enough text here"
    assert page("x\nposted 7/3/2026 by\n5h").label() == "7/3/2026" and page("x\n5h\n07/03/26").label() == "07/03/26" and page("x\n5h").label() == "5h" and page("x y").label() == ""
    assert page("seen").written_date('aria-label="3 tháng 7, 2026"') == "3 tháng 7, 2026" and page("07/31/26").written_date("") == "07/31/26"
    assert page(None).lines == [] and page("\n \r\n").lines == []
    lines = ["owner", "2d", "text", *["Top"] * 20_000, *[x for k in range(5000) for x in (f"name_{k}", "Tác giả", "3h", f"comment {k}")]]
    began = time.process_time()
    assert len(read(lines, "owner")[2]) == 5000 and time.process_time() - began < 3
