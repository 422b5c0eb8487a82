"""Resampling, ranked search and token counts against brute force, on rows with nulls, ties, repeats and clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, prose

from buzzmill.llm import resampling, search, token_counts
from buzzmill.llm.queries import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
TEXTS = [None, "", " \n", prose(1, 40), prose(2, 30), prose(1, 40), prose(3, 25, 60), "Été À la PLAGE, w001 w002" * 5, "one", "w001 " * 60, prose(4, 9_000), "日本 日本語 w001\x00w002  x_y-z", prose(2, 30)]
#: Of the rows two have no id, and two the same.
IDS = [30, 29, None, 7, 8, 9, 10, 11, 12, 13, 14, 7, None]
ITEMS = [(1, prose(1, 12)), (2, None), (None, "w001 W001 plage été"), (4, "nowhere"), (4, "日本 w002"), (5, "")]


def table(spark, texts=TEXTS, ids=IDS):
    return spark.createDataFrame([(i, t, "en", "s", 1, "k", k, "n") for k, (i, t) in enumerate(zip(ids, texts, strict=True))], DOCS).repartition(3)


def aims(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 3, "x") for i, t in items], "item_id long, text string, rank int, term string")


def runs(text, orders):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[k : k + n]) for n in range(1, orders + 1) for k in range(len(words) - n + 1)]


@pytest.mark.parametrize(("orders", "buckets", "percent"), [(2, 10_000, 25), (3, 7, 60), (1, 10_000, 100)])
def test_resampling(spark, orders, buckets, percent):
    got = resampling.resample(table(spark), aims(spark), percent=percent, orders=orders, buckets=buckets).collect()
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(of(f) for x in TEXTS for f in runs(x, orders)[1]), Counter(of(f) for _, x in ITEMS for f in runs(x, orders)[1])
    a, b = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * a / ((s[k] + 1) * b))) for k in s}
    rows = []
    for i, x in zip(IDS, TEXTS, strict=True):
        words, features = runs(x, orders)
        weight = sum(gain[of(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    want = [(*r[:4], k if k <= len(able) * percent // 100 else None) for k, r in enumerate(able, 1)] + [(*r[:4], None) for r in rows if not r[4]]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize(("k", "block_docs", "at_once"), [(20, 64, 100_000), (3, 2, 100_000), (2, 1, 5)])
def test_ranked_search(spark, monkeypatch, k, block_docs, at_once):
    monkeypatch.setattr(search, "PASS_TERMS", at_once)
    got = search.ranked(search.build(table(spark), block_docs), aims(spark), k).collect()
    docs = [(i, Counter(terms(x)), len(terms(x))) for i, x in zip(IDS, TEXTS, strict=True) if terms(x)]
    n, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for d in docs for t in d[1])
    want = []
    for item, text in ITEMS:
        found = []
        for i, counts, size in docs:
            m = 75 + (25 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m)) for t in terms(text) if t in counts)
            found += [(-score, i is None, i)] * (score > 0)
        want += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_search_skips_blocks(spark, monkeypatch):
    """Blocks whose bound is too low are not scored, and the result stays whole: one pass of the first round is enough here."""
    texts = [prose(k, 30, 5000) for k in range(600)] + ["needle hay needle"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    block, scored = search.Block, []
    index = search.build(docs, 8)
    monkeypatch.setattr(search, "FIRST_BLOCKS", 3)
    got = search.ranked(index, spark.createDataFrame([(1, "needle")], "item_id long, text string"), 20).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(600, 620))
    items = search.Items.of([(1, "needle", 5)])
    with search.batch_rows(spark, 1000):
        batch = index.blocks.orderBy("block").toArrow().to_batches()[0]
    best = search.Best(1, 20, np.zeros(1, np.int64))
    held = list(search._blocks(batch, items, index.docs, index.terms))
    bounds = np.array([b.bounds(items)[0] for b in held])
    assert (bounds > 0).sum() <= 5 and len(held) > 70 and isinstance(held[0], block)
    for at in np.argsort(-bounds, kind="stable"):
        if bounds[at] < best.least[0]:
            break
        scored.append(at)
        scores = held[at].scores(0)
        assert scores.max() <= bounds[at]
        best.add(0, scores, held[at].doc_ids)
    assert len(scored) <= 5


def test_search_decodes_few_blocks_at_once(spark, monkeypatch):
    """A task holds a few rows of a file of the index, not the 4,096 that Spark decodes at once by default: one row is a whole block."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" all")).alias("text")).coalesce(1)
    index, batches = search.build(docs, 2), []

    def seen(real):
        def run(blocks, *rest):
            plan = blocks._jdf.queryExecution().executedPlan()
            blocks._jdf.queryExecution().toRdd().count()
            while "ColumnarToRow" not in plan.getClass().getSimpleName():
                plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan.children().head()
            batches.append(plan.metrics().apply("numInputBatches").value())
            return real(blocks, *rest)

        return run

    for name in ("_first_blocks", "_scored"):
        monkeypatch.setattr(search, name, seen(getattr(search, name)))
    got = search.ranked(index, spark.createDataFrame([(1, "w7")], "item_id long, text string")).collect()
    assert [tuple(r)[:3] for r in got] == [(1, 1, 7)]
    assert len(batches) == 3 and batches[0] >= 200 // 64 and batches[2] >= 200 // 64
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "4096"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


ODD = ["<s>x</s><0x0A>", "▁▁ a  ▁b ", " " * 40 + "x", "\t\n\r\n  \x00 ", "a" * 3000, "😀é" * 9, "if(a[i]!=b){\n        return;\n}", "1,234.5 ².", "don't,stop... (x). ''", "नमस्ते दुनिया", "　ﬁ"]


def test_token_counts(spark, library):
    texts, ids = TEXTS + ODD, IDS + list(range(100, 100 + len(ODD)))
    got = token_counts.measured(table(spark, texts, ids), MODEL, 50).collect()
    want = [(i, len((x or "").encode()), n := len(library.encode(x or "")), n > 50) for i, x in zip(ids, texts, strict=True)]
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(want, key=repr)
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncated(table(spark, texts, ids), MODEL, 50).collect()}
    for i, x in zip(ids, texts, strict=True):
        if x and i not in (None, 7):
            assert x.startswith(cut[i]) and len(library.encode(cut[i])) <= 50
            assert all(len(library.encode(x[:n])) > 50 for n in range(len(cut[i]) + 1, min(len(x), len(cut[i]) + 80) + 1))
    assert cut[30] is None


def test_every_prefix(library):
    counter, rng = token_counts.PrefixCounter(MODEL), np.random.default_rng(8)
    pieces = [p.replace("▁", " ") for p in list(counter.score)[::7]]
    for k in range(400):
        text = "".join(pieces[x] for x in rng.integers(0, len(pieces), 6)) if k % 2 else "".join("  abcdeinrst,.('\n"[x] for x in rng.integers(0, 17, 30))
        counts = np.cumsum(np.frombuffer(counter.steps(text), np.int8)).tolist()
        assert counts == [len(library.encode(text[:n])) for n in range(1, len(text) + 1)], text


def test_pieces_that_stay_apart():
    counter, rng = token_counts.PrefixCounter(MODEL), np.random.default_rng(9)
    pieces = list(counter.halves)
    blanks = [p for p in pieces if p.startswith("▁")]
    for _ in range(4000):
        a, b = (group[rng.integers(len(group))] for group in (pieces if rng.random() < 0.5 else blanks, pieces if rng.random() < 0.7 else blanks))
        assert counter.stay_apart(a, b) == (counter.merged(a + b) == [a, b]), (a, b)


def test_empty_tables(spark):
    none, nothing = table(spark, [], []), aims(spark, [])
    assert resampling.resample(none, aims(spark)).collect() == []
    assert {r["weight"] for r in resampling.resample(table(spark, TEXTS[:3], IDS[:3]), nothing).collect()} == {0}
    assert len(resampling.resample(table(spark), nothing).collect()) == len(TEXTS)
    assert search.search(none, aims(spark)).collect() == [] and search.search(table(spark), nothing).collect() == []
    assert search.search(table(spark), aims(spark, [(1, "nowhere at all")])).collect() == []
    assert token_counts.measured(none, MODEL).collect() == []
    assert token_counts.prefix_counts(none.withColumn("extra", F.lit(1)), MODEL, ["extra"]).columns == ["doc_id", "n_bytes", "n_chars", "steps", "extra"]
