"""Incremental removal of repeated word windows with a log-structured index of fingerprints.

Documents come in batches of ascending keys. Each batch's fingerprints (of segments around content-chosen anchors of
word windows) are sorted and merged with the sorted, immutable runs of all earlier batches. A run is a table of buckets
of the anchor's hash, each a sorted file; only the batch is shuffled, to the same buckets, and each task merges its part of
the batch with its file of every run. A segment met before is
repeated as a whole. Where only the anchor was met before, the words of both places are read again and every window is
compared by two independent hashes of its words, which verifies the match. The batch's new fingerprints become another
run; when fan_in runs are there already, the merge writes them all as one, which replaces them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import BASE_A, BASE_B, forget_shuffles, keyed, materialize, materialize_buckets, mix, only_keys, release, rolling, settings, text_chunks, words_of
from buzzmill.llm.windows import Shape, beside_texts, covered, dealt_by, in_order, resolve, runs, scan_segments

WIDTH, GRAM = 20, 6
RUN = ["anchor", "seg", "row_key", "start", "n"]
MERGED = "dup boolean, anchor long, seg long, row_key long, start int, n int, fresh boolean, deal long, first boolean, open_ boolean"
ORDER = ["dup", "anchor", "seg", "row_key", "start"]
WINDOWS = "dup boolean, anchor long, seg long, row_key long, start int, fresh boolean"


def symbols(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for at, _, data, offsets in text_chunks(column):
        _, _, hashes, before = words_of(data, offsets)
        yield at, hashes, before


class FingerprintIndex:
    """Sorted runs of fingerprints over `corpus` (row_key, text), which must hold every batch that is added."""

    def __init__(self, corpus: DataFrame, shape: Shape = Shape(WIDTH, GRAM), fan_in: int = 2, buckets: int | None = None):
        self.corpus, self.shape, self.fan_in = corpus, shape, fan_in
        self.buckets = buckets or int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[DataFrame] = []

    def merge(self, fresh: DataFrame) -> DataFrame:
        """Rows of the batch with those of every run, in order, a task a bucket. The runs' files are read where they lie.

        The union of tables of equal buckets and of rows shuffled to them has the buckets' partitions, so the last repartition
        moves nothing; where Spark doesn't see that, it shuffles, with the same result.
        """
        rows = fresh.repartition(self.buckets, "deal")
        for run in self.runs:
            rows = rows.unionByName(run.where("first and (fresh or whole)").select(F.lit(False).alias("dup"), *RUN, F.lit(False).alias("fresh"), "deal"))
        return rows.repartition(self.buckets, "deal").sortWithinPartitions(*ORDER)

    def _resolver(self):
        buckets = self.buckets

        def rows(batches):
            if TaskContext.get().partitionId() >= buckets:
                raise RuntimeError("runs and batch are not merged by bucket")
            yield from resolve(batches)

        return rows

    def add(self, batch: DataFrame) -> DataFrame:
        """Spans (row_key, start, n windows) of the batch that repeat earlier ones; keys must exceed all earlier keys.

        Leaves behind the spans and the runs alone: runs that a compaction replaced are deleted.
        """
        fresh = scan_segments(batch, symbols, self.shape).withColumn("fresh", F.lit(True)).withColumn("deal", dealt_by())
        compacts = len(self.runs) >= self.fan_in
        with settings(batch.sparkSession, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
            merged = self.merge(fresh).mapInArrow(self._resolver(), MERGED)
            merged = (merged if compacts else merged.where("fresh or open_")).withColumn("whole", F.lit(compacts))
            merged = materialize_buckets(merged, "fingerprint-run", self.buckets, "deal", ORDER)
        replaced, self.runs = (self.runs, [merged]) if compacts else ([], [*self.runs, merged])
        repeated = merged.where("fresh and not first").select("row_key", "start", "n")
        # anchors of which something new came; of those with old segments alone, all windows are known
        asks = merged.where("open_").groupBy("anchor").agg(F.bool_or("fresh").alias("asks")).where("asks").drop("asks")
        unsettled = materialize(merged.where("open_").join(asks, "anchor", "left_semi").select("row_key", "start", "n", "fresh"), "fingerprint-open")
        spans = materialize(repeated.unionByName(self._verify(unsettled)), "fingerprint-spans")
        release(unsettled, *replaced)
        forget_shuffles(batch.sparkSession)
        return spans

    def _verify(self, unsettled: DataFrame) -> DataFrame:
        """Compare the windows of segments that share no more than their anchor, by the words in the texts."""
        width = self.shape.width

        def hashes(batches):
            for batch in batches:
                found = batch.column(2).to_pylist()
                keys = batch.column(0).to_pylist()
                out = []
                for at, end, data, offsets in text_chunks(batch.column(1)):
                    _, _, words, before = words_of(data, offsets)
                    others = words_of(data, offsets, BASE_B)[2]  # another hash of each word, so that no collision fools both
                    a, b = mix(rolling(words, width, BASE_A)).view(np.int64), mix(rolling(others, width, BASE_B)).view(np.int64)
                    for k in range(at, end):
                        base = int(before[k - at])
                        for r in found[k]:
                            places = np.arange(r["start"], r["start"] + r["n"])
                            out.append((a[base + places], b[base + places], np.full(r["n"], keys[k]), places, np.full(r["n"], r["fresh"])))
                one, two, key, start, fresh = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 5
                arrays = [np.zeros(len(one), bool), one, two, key.astype(np.int64), start.astype(np.int32), fresh.astype(bool)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["dup", "anchor", "seg", "row_key", "start", "fresh"])

        texts = only_keys(self.corpus, unsettled, "row_key")
        beside = beside_texts(texts, unsettled, ["start", "n", "fresh"]).select("row_key", "text", "found")
        windows = in_order(beside.mapInArrow(hashes, WINDOWS)).mapInArrow(resolve, f"{WINDOWS}, first boolean, open_ boolean")
        return windows.where("fresh and not first").select("row_key", "start", F.lit(1).alias("n"))


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def dedup(docs: DataFrame, batches: int = 3, shape: Shape = Shape(WIDTH, GRAM), with_text: bool = False) -> DataFrame:
    """One row for each row of docs: words, words removed, and sha256 of the words left, joined by one space (text too if asked).

    A word goes if a window of shape.width words that covers it also starts earlier: in a row of smaller doc_id or
    earlier in the same one; windows are judged on the input. docs is added to an empty index in `batches` parts of
    ascending keys, which changes no result. Null and empty texts have no words. Rows with a null id come last; rows
    with equal ids are ordered by their text's hash. An empty table gives no rows. Other columns are ignored.
    """
    docs = keyed(docs)
    index, spans = FingerprintIndex(docs, shape), []
    cuts = docs.agg(F.percentile_approx("row_key", F.array(*[F.lit(k / batches) for k in range(1, batches)]), F.lit(1000)).alias("q")).first()["q"] if batches > 1 else []
    edges = [None, *sorted(set(cuts or [])), None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = docs if low is None else docs.where(F.col("row_key") > low)
        spans.append(index.add(part if high is None else part.where(F.col("row_key") <= high)))

    def strip(batches):
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "found")), strict=True):
                words = (text or "").encode().split()
                kept = words
                if found:
                    gone = covered(found, len(words), shape.width)
                    starts, lengths = runs(~gone)
                    kept = [w for a, n in zip(starts.tolist(), lengths.tolist(), strict=True) for w in words[a : a + n]]
                left = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest(), left.decode() if with_text else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "text"])

    beside = beside_texts(docs, reduce(DataFrame.unionByName, spans), ["start", "n"], "left").select("doc_id", "text", "found")
    out = beside.mapInArrow(strip, f"{RESULT}, text string")
    return out if with_text else out.drop("text")


#: Every window as text: for small tables.
ORACLE = r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
later AS (SELECT doc_id, i FROM x QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM later, (SELECT unnest(range(0, 20)) AS k)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""
