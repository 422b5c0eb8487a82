"""Removal of repeated long byte strings with a run-length index.

Segments around content-chosen anchors bring equal windows together; segments that are equal as a whole are settled by
their hash. For the rest, segments with a common anchor meet in blocks of bounded size. A block's texts get a
run-compressed Burrows-Wheeler transform with the suffix positions at run starts and their predecessors sampled. From
these samples alone the positions are streamed: each gets its preceding suffix and the length that it shares with it
(its matching statistic), and windows whose match is long enough are chained to their first occurrence.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import keyed, materialize, only_keys, text_chunks
from buzzmill.llm.windows import Shape, beside_texts, covered, in_order, resolve, runs, scan_segments

WIDTH, GRAM = 100, 32
#: Bytes of the texts of one block, and rows of an anchor from which its windows are compared by hash instead.
BLOCK_BYTES, HOT_ROWS = 2 << 20, 10_000
SPANS = "row_key long, start int, n int"
PACKED = 7


class RunIndex:
    """Run-compressed BWT of texts laid end to end, each ended by a mark of its own that sorts before every byte.

    Kept for each run start j: the position SA[j], its predecessor SA[j - 1], and the length that both share. For a
    position i, the nearest sample at p <= i in its text gives predecessor + (i - p) and shared length - (i - p).
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.repeat(np.cumsum(lengths), lengths)
        starts = np.cumsum(lengths) - lengths
        n, longest = len(self.data), int(lengths.max(initial=0))
        packs = self._packs()
        order = self._suffix_order(packs, longest)
        before = self.data[order - 1].astype(np.int64)
        at_start = np.zeros(n, bool)
        at_start[starts[lengths > 0]] = True
        before[at_start[order]] = -1  # the mark before each text differs from all other symbols
        new = np.ones(n, bool)
        new[1:] = (before[1:] != before[:-1]) | (before[1:] < 0)
        run = np.flatnonzero(new)
        self.run_symbols, self.run_starts = before[run], run
        here, previous = order[run], order[np.maximum(run - 1, 0)]
        shared = self._shared(packs, here, previous)
        shared[run == 0] = 0
        by_position = np.argsort(here)
        self.samples, self.previous, self.shared = here[by_position], previous[by_position], shared[by_position]

    def _packs(self) -> np.ndarray:
        """The next 7 symbols at each position in 63 bits, 0 beyond the text's end."""
        n, out = len(self.data), np.zeros(len(self.data), np.uint64)
        index = np.arange(n)
        for k in range(PACKED):
            here = np.zeros(n, np.uint64)
            here[: n - k] = self.data[k:].astype(np.uint64) + np.uint64(1)
            here[index + k >= self.ends] = 0
            out = (out << np.uint64(9)) | here
        return out

    def _suffix_order(self, packs: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes by content, those that end alike by position; ranks double the length that they tell apart."""
        order = np.argsort(packs)
        rank = self._ranks(packs[order], order)
        depth = PACKED
        index = np.arange(len(packs))
        while depth < longest:
            ahead = index + depth
            inside = ahead < self.ends
            keys = (rank + 1) * np.int64(len(packs) + 1)
            keys[inside] += rank[ahead[inside]] + 1
            order = np.argsort(keys)
            rank = self._ranks(keys[order], order)
            depth *= 2
            if rank.max(initial=0) == len(packs) - 1:
                break
        return np.argsort(rank, kind="stable")

    @staticmethod
    def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1]))) if len(order) else []
        return rank

    def _shared(self, packs: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at a and b share."""
        out, most = np.zeros(len(a), np.int64), np.minimum(self.ends[a] - a, self.ends[b] - b)
        going = np.flatnonzero(most > 0)
        while len(going):
            differ = packs[a[going] + out[going]] ^ packs[b[going] + out[going]]
            same = np.full(len(going), PACKED, np.int64)
            for k in range(PACKED - 1, -1, -1):
                same[(differ >> np.uint64(9 * (PACKED - 1 - k))) & np.uint64(511) != 0] = k
            out[going] = np.minimum(out[going] + same, most[going])
            going = going[(same == PACKED) & (out[going] < most[going])]
        return out

    def matches(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position, streamed from the samples: the preceding suffix's position, and the length shared with it."""
        n = len(self.data)
        sample = np.zeros(n, np.int64)
        sample[self.samples] = np.arange(len(self.samples))
        sample = np.maximum.accumulate(sample)
        past = np.arange(n) - self.samples[sample]
        return self.previous[sample] + past, np.maximum(self.shared[sample] - past, 0)

    def repeats(self, width: int) -> np.ndarray:
        """Positions of windows of `width` symbols that also occur at a smaller position."""
        n = len(self.data)
        previous, length = self.matches()
        index = np.arange(n)
        root = np.where(length >= width, previous, index)
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
        first = index.copy()
        chained = np.flatnonzero(length >= width)
        np.minimum.at(first, root[chained], chained)
        out = first[root] != index
        out[index + width > self.ends] = False
        return out


def symbols(column: pa.Array):
    for at, _, data, offsets in text_chunks(column):
        yield at, data, offsets


def _spans(keys, starts, flags_by_row) -> pa.Table:
    rows, at, n = [], [], []
    for k, start, flags in zip(keys, starts, flags_by_row, strict=True):
        for a, length in zip(*runs(flags), strict=True):
            rows.append(k)
            at.append(start + int(a))
            n.append(int(length))
    return pa.table([pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int32())], names=["row_key", "start", "n"])


def repeated_spans(docs: DataFrame, shape: Shape = Shape(WIDTH, GRAM), block_bytes: int = BLOCK_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """row_key, start and n: windows start ... start + n - 1 of that row also start earlier. docs has row_key and text."""
    width = shape.width
    settled = materialize(in_order(scan_segments(docs, symbols, shape)).mapInArrow(resolve, "dup boolean, anchor long, seg long, row_key long, start int, n int, first boolean, open_ boolean").where("not first or open_").drop("dup"), "suffix-settled")
    whole, unsettled = settled.where("not first").select("row_key", "start", "n"), settled.where("open_").select("anchor", "row_key", "start", "n")
    # an anchor with many segments does not fit a block: its windows are compared one by one, by a hash of their bytes
    hot = unsettled.groupBy("anchor").agg(F.count("*").alias("rows")).where(F.col("rows") > hot_rows).select("anchor", F.lit(True).alias("hot"))
    size = unsettled.agg(F.sum(F.col("n") + (width - 1))).first()[0] or 0
    rows = unsettled.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))

    def cut(batches):
        for batch in batches:
            out = []
            for key, text, found in zip(*(batch.column(c).to_pylist() for c in ("row_key", "text", "found")), strict=True):
                raw = text.encode()
                out += [(r["anchor"], r["hot"], key, r["start"], raw[r["start"] : r["start"] + r["n"] - 1 + width]) for r in found]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "hot", "row_key", "start", "bytes"])

    beside = beside_texts(only_keys(docs, unsettled, "row_key"), rows, ["anchor", "start", "n", "hot"]).select("row_key", "text", "found")
    pieces = materialize(beside.mapInArrow(cut, "anchor long, hot boolean, row_key long, start int, bytes binary"), "suffix-segments")

    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row_key", "ascending"), ("start", "ascending")])
        texts = table.column("bytes").to_pylist()
        repeated = RunIndex(texts).repeats(width)
        edges = np.cumsum([0, *map(len, texts)])
        flags = [repeated[a : b - width + 1] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return _spans(table.column("row_key").to_pylist(), table.column("start").to_pylist(), flags)

    blocks = max(1, -(-size // block_bytes))
    indexed = pieces.where("not hot").groupBy(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block")).applyInArrow(block, SPANS)

    each = pieces.where("hot").select("row_key", "start", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - width)).alias("k"))
    each = each.select("row_key", (F.col("start") + F.col("k")).alias("start"), F.sha2(F.substring("bytes", F.col("k") + 1, F.lit(width)), 256).alias("window"))
    firsts = each.groupBy("window").agg(F.min(F.struct("row_key", "start")).alias("least"), F.count("*").alias("times")).where("times > 1")
    later = each.join(firsts, "window").where(F.struct("row_key", "start") != F.col("least")).select("row_key", "start", F.lit(1).alias("n"))
    return whole.unionByName(indexed).unionByName(later)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup(docs: DataFrame, shape: Shape = Shape(WIDTH, GRAM), with_text: bool = False, **how) -> DataFrame:
    """One row for each row of docs: bytes, bytes removed, runs removed, and sha256 of what is left (text too if asked).

    A byte goes if a string of shape.width bytes that covers it also starts earlier: in a row of smaller doc_id or
    earlier in the same one. Null and empty texts have no bytes. Rows with a null id come last; rows with equal ids
    are ordered by their text's hash. An empty table gives no rows. Other columns are ignored. Cutting at bytes can
    split a character; such bytes become the replacement character in `text`, while kept_sha256 is of the bytes.
    """
    docs = keyed(docs)
    spans = repeated_spans(docs, shape, **how)

    def strip(batches):
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "found")), strict=True):
                raw = (text or "").encode()
                gone = covered(found, len(raw), shape.width)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if found else raw
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(runs(gone)[0]) if found else 0, hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace") if with_text else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    beside = beside_texts(docs, spans, ["start", "n"], "left").select("doc_id", "text", "found")
    out = beside.mapInArrow(strip, f"{RESULT}, text string")
    return out if with_text else out.drop("text")


#: Every window as bytes: for small tables.
ORACLE = r"""
WITH b AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT doc_id, i, b[i:i + 99] AS g FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS i FROM b)),
later AS (SELECT doc_id, i FROM x QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
spans AS MATERIALIZED (SELECT doc_id, k, min(i) AS s, max(i) + 99 AS e FROM numbered GROUP BY doc_id, k),
pieces AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) + 1 AS s, s - 1 AS e FROM spans
  UNION ALL SELECT doc_id, max(spans.e) + 1, octet_length(any_value(b)) FROM spans JOIN b USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, unhex(string_agg(hex(b[s:e]), '' ORDER BY s)) AS kept FROM pieces JOIN b USING (doc_id) WHERE e >= s GROUP BY doc_id),
removed AS (SELECT doc_id, sum(e - s + 1) AS n, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN n IS NULL THEN b ELSE coalesce(kept, ''::BLOB) END) AS kept_sha256
FROM b LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
