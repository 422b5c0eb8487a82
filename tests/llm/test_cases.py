"""Cases of the operators' contracts: long texts, ties, few rows, empty tables, broken files, random strings, and twins in numpy."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import WORDS, brute_windows, prose

from buzzmill.llm import ann, classifier, fingerprints, mixing, packing, pii, rules, setjoin, shared, suffix_dedup, warc
from buzzmill.llm.queries import tokenizer_path
from buzzmill.llm.windows import Shape


@pytest.fixture(scope="module")
def long_texts(spark):
    """A text above the size of a kernel's chunk, one that repeats its end, and short ones between."""
    rng = np.random.default_rng(2)
    words = [f"w{k:05d}" for k in rng.integers(0, 30_000, 190_000)]
    texts = [" ".join(words), "short one", " ".join(words[-60:] + words[:40]), "", " ".join(words[1000:1030])]
    assert len(texts[0]) > shared.CHUNK_BYTES
    return texts, spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string").repartition(2)


def test_long_texts(spark, long_texts):
    texts, docs = long_texts
    words = [WORDS.findall(t) for t in texts]
    got = {r["doc_id"]: r for r in fingerprints.dedup(docs, batches=2).collect()}
    for k, (w, gone) in enumerate(zip(words, brute_windows(words, 20), strict=True)):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[k]["n_words"], got[k]["n_removed"], got[k]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    raw = [t.encode() for t in texts]
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(docs).collect()}
    for k, (r, gone) in enumerate(zip(raw, brute_windows(raw, 100), strict=True)):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        assert (got[k]["n_removed"], got[k]["n_spans"]) == (sum(gone), spans)
        assert got[k]["kept_sha256"] == hashlib.sha256(bytes(c for c, g in zip(r, gone, strict=True) if not g)).hexdigest()
    assert {r["doc_id"]: r["n_shingles"] for r in setjoin.join_components(docs).collect()} == {k: len({tuple(w[i : i + 4]) for i in range(len(w) - 3)}) or int(bool(w)) for k, w in enumerate(words)}
    stats = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in rules.judge(docs, docs.select("doc_id", F.lit(1).alias("quality")).limit(0))[0].collect()}
    assert stats[0][0] == len(words[0]) and stats[1] == (2, 0)
    assert [r["n_email"] for r in pii.find_spans(docs.withColumn("text", F.concat("text", F.lit(" a@b.co")))).orderBy("doc_id").collect()] == [1] * 5
    assert mixing.mix(docs).where("doc_id = 0").first()["size"] == len(words[0])


def test_base_kinds_on_random_strings():
    """The base spans against plain regular expressions, applied from left to right."""
    plain = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19 and pii.luhn(re.sub("[ -]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= sum(c.isdigit() for c in m) <= 15),
    }
    rng = np.random.default_rng(11)
    parts = ["a", "B.", "@", "x@y.z", ".", "-", " ", "1", "22", "255", "256", "0.0.0.", "+4", "+49 (170) ", "4111 1111 1111 1111", "4111111111111111", "(", ")", "é", "%", "1.2.3.4", "@b.c", "\n", "0"]
    for _ in range(20_000):
        text = "".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(1, 14)))
        want = [(kind, m.start(), m.end()) for kind, (p, ok) in plain.items() for m in re.finditer(p, text) if ok(m.group())]
        assert [s[1:] for s in pii.spans_of(text) if s[1] in plain] == want, text


def test_ties_and_few_neighbours(spark):
    rows = [(k, [1.0, 0.0]) for k in range(8)] + [(8, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(df, F.col("vec_id") == 3).collect())
    assert got == [(3, 1, 0), (3, 2, 1), (3, 3, 2), (3, 4, 4), (3, 5, 5)]
    few = ann.search(df.where("vec_id in (0, 1, 8)"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in few] == [(1, 1), (2, 8)]
    assert ann.search(df.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def test_blocks_are_searched_by_all_queries(spark):
    x = np.random.default_rng(4).standard_normal((900, 32))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 50 == 0, block_bytes=8 * 32 * 100).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(q, v) for q in range(0, 900, 50) for v in [n for n in np.argsort(-(u @ u[q])) if n != q][:5]}
    assert len(got) == 90 and len(want & {(r["query_id"], r["vec_id"]) for r in got}) >= 81


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")
    assert mixing.mix(none).count() == mixing.mixed(none).count() == pii.find_spans(none).count() == pii.redact(none).count() == 0
    assert setjoin.deduplicate(none).count() == 0


def test_rows_that_tie_in_hash(spark):
    rows = [(1, "a b c d", "s")] * 5 + [(2, "e f", "t")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5).toPandas()
    assert set(got[got.doc_id == 1].taken) == {int(got[got.doc_id == 1].target.iloc[0] + 0.5) // 5}


def test_documents_with_equal_ids(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "three"), (None, "four"), (1, None)], "doc_id long, text string")
    got = packing.pack(df, tokenizer_path(), size=8).toPandas()
    assert got.length.sum() == got.drop_duplicates(["doc_id", "doc_tokens", "sequence_id", "offset"]).length.sum()
    assert got.groupby("sequence_id").length.sum().isin([1, 2, 4, 8]).all() and got.doc_id.isna().sum() >= 1


def test_more_than_one_archive(spark, monkeypatch, tmp_path):
    rows = [(k, f"u{k}", "x" * 400 + str(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    files = warc.write_archives(warc.mark_revisits(df), f"file://{tmp_path}/raw")
    assert sum(r["records"] for r in files.collect()) == 40
    name = files.first()["file"]
    whole = (tmp_path / "raw" / name).read_bytes()
    (tmp_path / "raw" / name).write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="the archive ends|incomplete|Error"):
        warc.normalise(spark, files, f"file://{tmp_path}/raw", f"file://{tmp_path}/out").count()


def test_score_is_the_density_ratio(spark):
    """The classifier's score against class densities computed with numpy from the same statistics."""
    good = [(k, prose(k, 60)) for k in range(90)]
    bad = [(k, " ".join(f"{w}##" for w in prose(k, 50 + k % 7).split())) for k in range(90, 160)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 90).cast("int").alias("quality"))
    stats = classifier.with_stats(docs).select("doc_id", F.array(*classifier.transformed()).alias("x"))
    rows = classifier.pulled(stats).orderBy("doc_id").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([int(r["doc_id"] < 90) for r in rows])
    taught = np.array([zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in rows])
    m = {c: x[taught & (y == c)].mean(axis=0) for c in (0, 1)}
    v = {c: np.cov(x[taught & (y == c)].T, bias=True) for c in (0, 1)}
    n = {c: (taught & (y == c)).sum() for c in (0, 1)}
    scale = np.sqrt(np.maximum((np.diag(v[0]) + np.diag(v[1])) / 2 + ((m[0] - m[1]) / 2) ** 2, 1e-12))
    logs = []
    for c in (0, 1):
        own = v[c] / np.outer(scale, scale)
        own = 0.8 * own + 0.2 * np.diag(np.diag(own)) + 0.02 * np.eye(len(scale))
        z = (x - m[c]) / scale
        logs.append(np.log(n[c] / (n[0] + n[1])) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(own), z))
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    got = [r["score"] for r in classifier.classify(docs, labels).orderBy("doc_id").collect()]
    assert np.allclose(got, want, atol=1e-6)
    kept = classifier.accepted(docs.withColumn("_id", F.lit(1)).withColumn("_hash", F.lit(2)), labels)
    assert kept.columns == ["doc_id", "text", "_id", "_hash"] and kept.count() == sum(s >= 0.5 for s in got)


def test_verdict_of_the_list(spark):
    """`kept` is what the learned conditions say, applied by hand."""
    good, bad = [(k, prose(k, 60)) for k in range(120)], [(k, " ".join(f"{w}!!" for w in prose(k, 60).split())) for k in range(120, 200)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    judged, learned = rules.judge(docs, docs.select("doc_id", (F.col("doc_id") < 120).cast("int").alias("quality")))
    rows = judged.collect()
    assert learned.rules
    for r in rows:
        hit = any(all(r[c.statistic] > c.cut if c.above else r[c.statistic] <= c.cut for c in rule) for rule in learned.rules)
        assert r["kept"] == (not r["base_failed"] and not hit)


@pytest.mark.parametrize("how", [{}, {"hot_rows": 1}, {"block_bytes": 2000}])
def test_spans_are_maximal_runs(spark, how):
    rng = np.random.default_rng(9)
    shared_part = "".join(map(chr, rng.integers(97, 123, 130)))
    texts = [f"{'x' * k}{shared_part}{k}" * (1 + k % 3) for k in range(12)]
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), Shape(100, 32), **how).collect()}
    raw = [t.encode() for t in texts]
    for k, gone in enumerate(brute_windows(raw, 100)):
        assert got[k]["n_removed"] == sum(gone) and got[k]["n_spans"] == sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
