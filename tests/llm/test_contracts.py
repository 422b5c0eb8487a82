"""Columns of results against plain readings of their contracts, and how the fingerprint index merges its runs."""

import base64
import hashlib
import re

from pyspark.sql import functions as F
from test_operators import WORDS, brute_windows, prose

from buzzmill.llm import fingerprints, pii, warc


def test_base_spans_of_find_spans(spark):
    """base_sha256 and spans as the query gives them, the base kinds by plain regular expressions from left to right."""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19 and pii.luhn(re.sub("[ -]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= sum(c.isdigit() for c in m) <= 15),
    }
    part = "é😀 mail a.b+c@d-e.fg or +49 (170) 1234-567, 4111 1111 1111 1111 and 10.0.0.255; 1.2.3.4.5 "
    texts = [None, "", "none here", part, part * 40, "x@y", "a@b.c@d.e", "+1 2 3", "4111 1111 1111 1112"]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in pii.find_spans(docs).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        base = {kind: [(m.start(), m.end()) for m in re.finditer(p, text or "") if ok(m.group())] for kind, (p, ok) in kinds.items()}
        told = [f"{kind}:{a}:{b}" for kind, found in base.items() for a, b in found]
        assert tuple(got[k][f"n_{kind}"] for kind in kinds) == tuple(map(len, base.values()))
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        spans = [s for s in got[k]["spans"].split(",") if s]
        assert [s for s in spans if s.split(":")[0] in kinds] == told
        assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in (s.split(":") for s in spans))


def test_digests_of_the_archives(spark):
    pages = [(5, "u", "é same"), (2, "u", "é same"), (9, None, None), (7, "", ""), (3, "v\r\n", "x" * 100_000), (11, "w", "é same")]
    for least, small in ((0, False), (7, False), (8, True)):
        got = {r["page_id"]: r for r in warc.archive_round_trip(spark.createDataFrame(pages, "page_id long, url string, html string"), least).collect()}
        for page, _, html in pages:
            raw = (html or "").encode()
            assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        same = None if small else 2
        assert [(got[k]["record_type"], got[k]["refers_to"]) for k in (2, 5, 11)] == [("response", None), *[("response" if small else "revisit", same)] * 2]
        assert (got[9]["record_type"], got[9]["refers_to"]) == (("revisit", 7) if least == 0 else ("response", None))


def test_runs_are_merged_where_they_lie(spark):
    """Only the batch is shuffled: the files of the runs are read bucket by bucket, and a compaction replaces them."""
    docs = spark.range(600).select(F.col("id").alias("row_key"), F.concat_ws(" ", *[F.md5(F.concat(F.col("id") % 40, F.lit(f"-{k}"))) for k in range(30)]).alias("text"))
    index = fingerprints.FingerprintIndex(docs, buckets=3)
    index.add(docs.where("row_key < 20"))
    index.add(docs.where("row_key between 20 and 39"))
    assert len(index.runs) == 2 and all(r.inputFiles() and len(r.inputFiles()) <= 3 for r in index.runs)
    fresh = fingerprints.scan_segments(docs.where("row_key >= 40"), fingerprints.symbols, index.shape).withColumn("fresh", F.lit(True)).withColumn("deal", fingerprints.dealt_by())
    with fingerprints.settings(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        plan = index.merge(fresh)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 2
    spans = index.add(docs.where("row_key >= 40"))
    assert len(index.runs) == 1 and spans.select("row_key").distinct().count() == 560


def test_one_anchor_in_every_text(spark):
    """A licence line in all documents, and texts around it that differ: in many batches, with compactions."""
    line = prose(77, 24)
    texts = [f"{prose(k, 15 + k % 9)} {line} {prose(k + 500, 12)}" for k in range(90)] + [line, line]
    words = [WORDS.findall(t) for t in texts]
    got = {r["doc_id"]: r for r in fingerprints.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), batches=6).collect()}
    for k, (w, gone) in enumerate(zip(words, brute_windows(words, 20), strict=True)):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[k]["n_removed"], got[k]["kept_sha256"]) == (sum(gone), hashlib.sha256(kept.encode()).hexdigest())
