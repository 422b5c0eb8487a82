"""Operators on small tables with nulls, empty and repeated rows, and clashing columns, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from buzzmill.llm import ann, classifier, fingerprints, mixing, packing, pii, rules, setjoin, suffix_dedup, warc
from buzzmill.llm.queries import tokenizer_path
from buzzmill.llm.windows import Shape

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_key string, label int, n string"


def prose(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k:03d}" for k in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def texts():
    a, b = prose(1, 300), prose(2, 120)
    near = a.split()
    near[150] = "changed"
    odd = [None, "", " ", "one", "one two three", "é" * 40 + " x", "same line here\n" * 12]
    return [a, b, a, " ".join(near), b + " " + a[:400], prose(3, 30) + " " + b, *odd, "short words of a few here", "short words of a few here", "A@B.co 1.2.3.4 +49 (170) 1234-567"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(3 * k, t, "en", ["s1", "s2", None][k % 3], None, "x", 1, "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows[::-1], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_windows(units, width):
    """For each sequence: which units lie in a window that starts earlier too."""
    seen, out = set(), []
    for u in units:
        gone = [False] * len(u)
        for k in range(len(u) - width + 1):
            w = tuple(u[k : k + width])
            if w in seen:
                gone[k : k + width] = [True] * width
            seen.add(w)
        out.append(gone)
    return out


@pytest.mark.parametrize("how", [{}, {"hot_rows": 1}])
def test_suffix_dedup(docs, texts, how):
    raw = [(t or "").encode() for t in texts]
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(docs, **how).collect()}
    assert len(got) == len(texts)
    for k, (r, gone) in enumerate(zip(raw, brute_windows(raw, 100), strict=True)):
        kept = bytes(c for c, g in zip(r, gone, strict=True) if not g)
        assert (got[3 * k]["n_bytes"], got[3 * k]["n_removed"], got[3 * k]["kept_sha256"]) == (len(r), sum(gone), hashlib.sha256(kept).hexdigest())


def test_run_index_finds_all_repeats():
    rng = np.random.default_rng(5)
    for _ in range(20):
        texts = [bytes(rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8)) for _ in range(6)]
        want = np.concatenate(brute_starts(texts, 5))
        index = suffix_dedup.RunIndex(texts)
        assert (index.repeats(5) == want).all()
        assert len(index.run_starts) <= len(index.data)


def brute_starts(texts, width):
    seen, out = set(), []
    for t in texts:
        flags = np.zeros(len(t), bool)
        for k in range(len(t) - width + 1):
            flags[k] = t[k : k + width] in seen
            seen.add(t[k : k + width])
        out.append(flags)
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_substring_dedup(docs, texts, batches):
    words = [WORDS.findall(t or "") for t in texts]
    got = {r["doc_id"]: r for r in fingerprints.dedup(docs, batches=batches).collect()}
    for k, (w, gone) in enumerate(zip(words, brute_windows(words, 20), strict=True)):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[3 * k]["n_words"], got[3 * k]["n_removed"], got[3 * k]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_repeated_and_null_ids(spark, empty):
    t = prose(9, 60)
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, None)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in fingerprints.dedup(df).collect()) == [0, 0, 60, 60]
    assert sorted(r["n_removed"] for r in suffix_dedup.dedup(df, Shape(50, 20)).collect()) == [0, 0, len(t), len(t)]
    assert {r["component_id"] for r in setjoin.join_components(df).where("n_shingles > 0").collect()} == {1}
    assert fingerprints.dedup(empty).count() == suffix_dedup.dedup(empty).count() == setjoin.join_components(empty).count() == 0


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = WORDS.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    comp = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]) and comp[i] != comp[j]:
                low, high = sorted((comp[i], comp[j]))
                comp = [low if c == high else c for c in comp]
    return [len(s) for s in sets], comp


def test_set_join(spark, docs, texts):
    sizes, comp = brute_components(texts, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.join_components(docs).collect()}
    assert got == {3 * k: (sizes[k], 3 * comp[k]) for k in range(len(texts))}
    many = [" ".join(f"v{x}" for x in np.random.default_rng(k).permutation(9 + k % 14)) for k in range(40)]
    many += [" ".join(t.split()[:-1]) for t in many] + [t + " more" for t in many]
    sizes, comp = brute_components(many, 2, 60)
    df = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in setjoin.join_components(df, percent=60, size=2).collect()} == dict(enumerate(comp))


def test_small_sets_share_exact_subsets():
    assert setjoin.need(20, 20, 85) == 19 and list(setjoin.partners(20, 85)) == [17, 18, 19, 20, 21, 22, 23]
    assert setjoin.subset_rows(12, 85) == sum(1 for _ in setjoin._subsets(list(range(12)), 85))


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(600, None), (601, [0.0] * 16), (602, [float("nan")] * 16), (603, [1.0]), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 50 == 0, block_bytes=128 * 200).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        s = u @ u[q]
        s[q] = -2
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert len(mine) == 5
        hits += len({v for _, v in mine} & set(np.argsort(-s)[:5].tolist()))
    assert hits >= 0.9 * 60 and len(got) == 60
    assert ann.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_far_neighbours(spark):
    """All others are owed where there are at most k, however far."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((8, 64))
    for v in x:
        far = np.stack([v, *(-v + s * rng.standard_normal(64) for s in (0.01, 0.1, 0.3, 0.5, 1))])
        got = ann.Block(np.arange(6), far, ann.Hashing()).search(np.array([0]), far[:1], 5)
        s = far @ v / np.linalg.norm(far, axis=1)
        assert [i for _, i, _ in got] == np.argsort(-s)[1:].tolist()
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(far)], "vec_id long, embedding array<double>")
    assert [r["rank"] for r in ann.search(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), size=256, most_open=2).toPandas()
    for k, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in got[got.doc_id == 3 * k].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    lengths = got.groupby("sequence_id").length.sum()
    assert lengths.max() <= 256 and all(n & (n - 1) == 0 for n in lengths)
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_mixing(spark, docs, texts):
    got = mixing.mix(docs).toPandas()
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == len(texts)
    for _, g in got.groupby(got.source.fillna("-")):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1 + len(g)
    held = docs.sparkSession.createDataFrame([("a", 10), ("b", 90), (None, 0)], "source string, source_size long")
    assert {r["source"]: r["target"] for r in mixing.targets(held, (3, 1, 2), 1.5, 2.0).collect()} == {"a": 20.0, "b": 130.0, None: 0.0}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORDS.findall(r["text"])) for r in mixed.collect()) == got.taken.sum()


def test_personal_data(docs, texts):
    cases = {
        "a.b+c@x-y.de.com, a@b.c@d.e": ["email:0:16", "email:18:23"],
        "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3": ["ip:0:7", "ip:8:15"],
        "4111 1111-1111 1111 4111111111111112": [],
        "card 4111111111111111.": ["card:5:21"],
        "call +49 (170) 1234-567 now": ["phone:5:23"],
        'token = "abcdef1234567890"': ["secret:9:25"],
        "IBAN: GB82 WEST 1234 5698 7654 32 x": ["account:6:33"],
    }
    for text, want in cases.items():
        assert [f"{k}:{a}:{b}" for _, k, a, b in pii.spans_of(text)] == want, text
    assert pii.find_spans(docs).count() == len(texts)
    assert pii.redacted("mail a@b.cd!") == "mail [EMAIL]!" and pii.redacted(None) is None
    assert pii.redact(docs).columns == docs.columns


def test_long_secrets_go_whole():
    long = "ab1-" * 500
    assert pii.redacted(f'token = "{long}" end') == 'token = "[SECRET]" end'
    assert pii.redacted(f"see ssh://{'u' * 300}:p1@host/x end") == "see [URL] end"
    assert pii.spans_of("token=" * 20000 + " password=hunter22") == [(6, "secret", 120001, 120018)]
    assert [s[2:] for s in pii.spans_of("token=abcdefgh_token= secret99 token=abcdefgh,token=secret99")] == [(22, 30), (52, 60)]


def test_archives(spark):
    pages = [(4, "http://a b", "x"), (2, None, "x"), (9, "u", None), (1, "u", ""), (5, "u", "é" * 5000), (None, "u", "x")]
    df = spark.createDataFrame([(*p, 7) for p in pages], "page_id long, url string, html string, file int")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(df).collect()}
    assert got == {4: (1, "revisit", 2), 2: (1, "response", None), 9: (0, "revisit", 1), 1: (0, "response", None), 5: (10000, "response", None), None: (1, "revisit", 2)}
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def stats(text):
    w = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    grams, inside = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7)), set()
    for k in range(len(w) - 7):
        if grams[tuple(w[k : k + 8])] > 1:
            inside.update(range(k, k + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(k, prose(k, 60)) for k in range(150)]
    bad = [(k, " ".join(f"{w}###" for w in prose(k, 60).split())) for k in range(150, 260)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    return docs, docs.select("doc_id", (F.col("doc_id") < 150).cast("int").alias("quality"), F.lit(0).alias("toxic"), F.lit("x").alias("text"))


def test_quality_rules(spark, docs, texts, labelled, empty):
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in rules.judge(docs, labelled[1].limit(0))[0].collect()}
    assert got == {3 * k: stats(t) for k, t in enumerate(texts)}
    judged, learned = rules.judge(*labelled)
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert len(learned.rules) >= 1 and sum(kept[k] for k in range(150)) >= 148 and sum(kept[k] for k in range(150, 260)) <= 2
    assert rules.judge(empty, labelled[1])[0].count() == 0


def test_quality_classifier(docs, texts, labelled, empty):
    got = classifier.classify(*labelled).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert ((held.predicted == 1) == (held.index < 150)).mean() >= 0.95
    assert [bool(got.held_out[k]) for k in range(9)] == [zlib.crc32(str(k).encode()) % 3 == 1 for k in range(9)]
    assert classifier.classify(docs, labelled[1].limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert classifier.classify(empty, labelled[1]).count() == 0
    assert classifier.accepted(*labelled).count() == int((got.predicted == 1).sum())


def test_pipeline(spark, tmp_path, docs, texts):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "PII", "mixing", "packing"]
    sizes, comp = brute_components(texts, 5, 80)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(3 * k for k in range(len(texts)) if comp[k] == k)
    table = defaultdict(int)
    for r in kept:
        table[r["lang"]] += 1
    assert table["en"] == len(kept)


def test_pipeline_stages(spark, tmp_path, monkeypatch):
    """run() over a folder: what every stage keeps of the stage before it, and the pieces, against brute force."""
    import duckdb
    import pandas as pd
    from tokenizers import Tokenizer

    import corpus_pipeline

    texts = [prose(k, 60) for k in range(150)]
    for k in range(0, 150, 10):
        texts[k] += f" mail a.b{k}@ex-{k}.org or 10.0.0.{k}"
    for k in range(3, 150, 7):
        texts[k] = texts[k - 2] + " more"
    texts += [" ".join(f"{w}###" for w in prose(k, 60).split()) for k in range(150, 260)]
    rows = [(k, t, "en", ["s1", "s2", "s3", None][k * k % 7 % 4], len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k < 150), 0) for k in range(260)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stored, store = [], corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, label: stored.append(store(df, label)) or stored[-1])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(stored) == 4
    got = [sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str) for df in stored]

    kept = [r for r in rows if "###" not in r[1]]
    assert got[0] == sorted(kept, key=str) and len(kept) == 150
    comp = brute_components([r[1] for r in kept], 5, 80)[1]
    kept = [r for k, r in enumerate(kept) if comp[k] == k]
    assert got[1] == sorted(kept, key=str) and len(kept) < 150
    clean = [re.sub(r"10\.0\.0\.\d+", "[IP]", re.sub(r"\S+@\S+", "[EMAIL]", r[1])) for r in kept]
    kept = [(r[0], t, *r[2:4], len(t)) for r, t in zip(kept, clean, strict=True)]
    assert got[2] == sorted(kept, key=str) and sum("[EMAIL]" in t and "[IP]" in t for t in clean) > 5
    documents = pd.DataFrame(kept, columns=["doc_id", "text", "lang", "source", "n_chars"])  # noqa: F841 - read by the SQL
    taken = {r[0]: r[4] for r in duckdb.sql(mixing.ORACLE).fetchall()}
    mix = []
    for doc_id, text, lang, source, _ in kept:
        words = WORDS.findall(text)
        times, part = divmod(taken[doc_id], len(words))
        mix += [(doc_id, t, lang, source, len(t)) for t in [text] * times + [" ".join(words[:part])] * (part > 0)]
    assert got[3] == sorted(mix, key=str) and len(mix) > len(kept)

    t = Tokenizer.from_file(tokenizer_path())
    owed, ids_of = defaultdict(Counter), {}
    for doc_id, text, *_ in mix:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        ids_of[doc_id, len(ids)] = ids
        owed[doc_id, len(ids)].update(range(len(ids)))
    for p in pieces.itertuples():
        ids = ids_of[p.doc_id, p.doc_tokens][p.start : p.start + p.length]
        assert len(ids) == p.length and zlib.crc32(ids.tobytes()) == p.ids_crc32
        owed[p.doc_id, p.doc_tokens].subtract(range(p.start, p.start + p.length))
    assert not any(n for c in owed.values() for n in c.values())
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 4096
