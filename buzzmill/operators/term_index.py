"""Which of many terms a text holds.

Pairs: terms and texts meet by runs of bytes that both choose by the same order, rare ones first. Lists: a text is looked through
once, and gives its windows that a filter of the terms lets pass; nothing of the texts is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import BASE_A, CHUNK_BYTES, mix, only_keys, rolling, text_chunks
from buzzmill.sources.scratch import stored

#: Spans of bytes, and the bytes of a run in them: a term is of the longest span that it fills. In each span a text chooses its first run.
SPANS = {24: 8, 12: 6, 6: 4, 3: 3, 2: 2, 1: 1}
#: Texts (about) whose runs are counted to tell rare ones, and the bits of their counters. Any counts give the same pairs.
SAMPLE, SAMPLE_BITS = 4000, 20
#: Bits of a filter for each of its keys, at least, and the bits that a key sets: of 1,000 other windows about one passes.
KEY_BITS, PROBES = 32, 3
#: Windows of more bytes are named by the digits of their SHA-256, which are longer than any other window.
WIDE = 63
#: What makes BASE_A 1, modulo 2**64.
INVERSE = pow(BASE_A, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _hashes(data: np.ndarray, run: int) -> np.ndarray:
    return mix(rolling(data, run, BASE_A) + np.uint64(run))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << SAMPLE_BITS) - 1)).astype(np.int64)


def _levels(texts: DataFrame, spans: list[int]) -> dict[int, np.ndarray]:
    """16 times the logarithm of how many texts of a sample hold a run, by run length and hash: 1 MB a length."""
    runs = sorted({SPANS[s] for s in spans})

    def count(batches):
        sums = {r: np.zeros(1 << SAMPLE_BITS, np.uint32) for r in runs}
        for batch in batches:
            for at, end, data, offsets in text_chunks(batch.column(0)):
                for r in runs:
                    hashes = _hashes(data, r)
                    for k in range(end - at):
                        sums[r][np.unique(_bucket(hashes[offsets[k] : max(offsets[k], offsets[k + 1] - r + 1)]))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(runs, pa.int32()), pa.array([sums[r].tobytes() for r in runs], pa.binary())], ["run", "sums"])

    share = min(1.0, SAMPLE / max(1, texts.count()))
    found = stored(texts.select("_text").sample(share, seed=7), "sample").coalesce(2).mapInArrow(count, "run int, sums binary").collect()
    total = {r: sum((np.frombuffer(x["sums"], np.uint32).astype(np.int64) for x in found if x["run"] == r), np.zeros(1 << SAMPLE_BITS, np.int64)) for r in runs}
    return {r: np.minimum(16 * np.log2(total[r] + 1.0), 255).astype(np.uint8) for r in runs}


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _chosen(rows: DataFrame, key: str, text: str, levels, spans: list[int], whole: bool) -> DataFrame:
    """key and run: of each text's spans the least run, or (whole) of a term the least of all, in the order of level and hash."""
    kind = rows.schema[key].dataType

    def choose(batches):
        for batch in batches:
            keys, runs = [], []
            for at, end, data, offsets in text_chunks(batch.column(1)):
                sizes = np.diff(offsets)
                for span in spans:
                    run = SPANS[span]
                    hashes = _hashes(data, run)
                    order = (levels.value[run][_bucket(hashes)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
                    least = order if whole else _least(order, span - run + 1)
                    for k in np.flatnonzero(sizes >= span):
                        a, b = offsets[k], offsets[k + 1]
                        if whole and any(s > span and sizes[k] >= s for s in SPANS):  # of a longer span
                            continue
                        own = least[a : b - run + 1].min(keepdims=True) if whole else np.unique(least[a : b - span + 1])
                        runs.append(own ^ np.uint64(span))
                        keys.append(np.full(len(own), at + k))
            at = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            made = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(made.view(np.int64), pa.int64())], [key, "run"])

    return rows.select(key, text).mapInArrow(choose, f"{key} {kind.simpleString()}, run long")


def matches(texts: DataFrame, key: str, text: str, terms: DataFrame, term_key: str, term: str) -> DataFrame:
    """Pairs (key, term_key) of texts and the terms that they hold as substrings.

    texts and terms have unique keys. A term is filed under the first of its runs in one order of all runs: rare ones in a sample
    of texts first, then by hash. A text gives the first run of each of its spans of bytes, so wherever it holds a term that fills a span,
    the term's run is among them: for terms of 24 bytes some ninth of all its runs. Each candidate is looked for in
    the text. Everything is a join on equal values, so neither side need be small. Null or empty terms are in no text, null texts
    hold nothing.
    """
    texts = texts.select(key, F.col(text).alias("_text")).where("_text <> ''")
    terms = stored(terms.select(term_key, F.col(term).alias("_term")).where("_term <> ''"), "terms")
    span = F.lit(None).cast("int")
    for s in SPANS:
        span = F.coalesce(span, F.when(F.octet_length("_term") >= s, s))
    spans = sorted((r[0] for r in terms.select(span).distinct().collect()), reverse=True)  # one of SPANS each
    if not spans:
        return texts.select(key, F.lit(None).cast(terms.schema[term_key].dataType).alias(term_key)).limit(0)
    levels = texts.sparkSession.sparkContext.broadcast(_levels(texts, spans))
    filed = stored(_chosen(terms, term_key, "_term", levels, spans, True), "filed")
    known = stored(filed.select("run", F.xxhash64("run", F.lit(1)).alias("other")).distinct(), "known")
    of_texts = only_keys(_chosen(texts, key, "_text", levels, spans, False), known, "run")
    of_texts = only_keys(of_texts.withColumn("other", F.xxhash64("run", F.lit(1))), known, "other").select(key, "run")
    candidates = of_texts.join(filed, "run").select(key, term_key).join(terms, term_key)
    return candidates.join(texts, key).where(F.col("_text").contains(F.col("_term"))).select(key, term_key)


def _power(base: int, n: int) -> np.ndarray:
    """1, base, its square and so on, n of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(n, np.uint64(base), np.uint64)
        steps[:1] = 1
        known = steps.cumprod()
        if n <= 2 * CHUNK_BYTES:
            _powers[base] = known
    return known[:n]


class _Sums:
    """Hashes of any windows of some bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(BASE_A, len(data)), out=self.sums[1:])
        self.back = _power(INVERSE, len(data) + 1)

    def at(self, starts: np.ndarray, lengths) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self.back[starts] + np.asarray(lengths).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of the windows at every place that has `length` bytes."""
        return mix((self.sums[length:] - self.sums[: len(self.sums) - length]) * self.back[: len(self.sums) - length] + np.uint64(length))


def _probe(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    moved = hashes + np.uint64(k) * ((hashes >> np.uint64(32)) | np.uint64(1)) if k else hashes
    return (moved & np.uint64(bits - 1)).view(np.int64)


def _span(length: int) -> int:
    """The bytes by which a term of so many is looked for first: 1, 2, 3 and their doubles."""
    span = 3
    while 2 * span <= length:
        span *= 2
    return min(span, length)


@dataclass
class Filter:
    """Of the terms of one span: their lengths, and a set bit for each probe of the hash of their first bytes and of the whole one's, inverted."""

    lengths: list[int]
    bits: np.ndarray

    def marked(self, hashes: np.ndarray, k: int) -> np.ndarray:
        at = _probe(hashes, k, 8 * len(self.bits))
        return np.flatnonzero((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)

    def passed(self, hashes: np.ndarray) -> np.ndarray:
        """Which of some hashes have all their bits set."""
        kept = self.marked(hashes, 0)
        for k in range(1, PROBES):
            kept = kept[self.marked(hashes[kept], k)]
        return kept


def _filters(terms: DataFrame, term: str) -> dict[int, Filter]:
    """Filters by span. The driver holds them and the terms' lengths, nothing of a term."""
    lengths = {r[0]: r[1] for r in terms.groupBy(F.octet_length(term)).count().collect() if r[0]}
    spans: dict[int, list[int]] = {}
    for n in sorted(lengths):
        spans.setdefault(_span(n), []).append(n)
    sizes = {s: max(64, 1 << (2 * KEY_BITS * sum(lengths[n] for n in own) - 1).bit_length()) for s, own in spans.items()}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                sums, own = _Sums(data), np.diff(offsets)
                of = np.array([_span(n) if n else 0 for n in own])
                for span, size in sizes.items():
                    at = offsets[:-1][of == span]
                    hashes = np.unique(np.concatenate((sums.at(at, span), ~sums.at(at, own[of == span]))))
                    bit = np.unique(np.concatenate([_probe(hashes, k, size) for k in range(PROBES)]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bit), span), pa.int32()), pa.array(bit, pa.int64())], ["span", "bit"])

    found = terms.select(term).mapInArrow(keys, "span int, bit long").groupBy("span", F.shiftright("bit", 6).alias("word"))
    words = found.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow()
    of, word, bits = (words.column(k).to_numpy() for k in range(3))
    out = {}
    for span, own in spans.items():
        held = np.zeros(sizes[span] >> 6, np.dtype("<i8"))
        held[word[of == span]] = bits[of == span]
        out[span] = Filter(own, held.view(np.uint8))
    return out


def _windows(data: np.ndarray, offsets: np.ndarray, filters: dict[int, Filter]) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the windows that pass, each within a row; long rows are looked through piece by piece."""
    most, starts, sizes = max(f.lengths[-1] for f in filters.values()), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(data), CHUNK_BYTES):
        piece = data[low : low + CHUNK_BYTES + most - 1]
        sums, ends = _Sums(piece), offsets[1:]
        for span, f in filters.items():
            if len(piece) < span:
                continue
            places = f.passed(sums.all(span)[:CHUNK_BYTES])
            rest = ends[np.searchsorted(ends, places + low, "right")] - low - places
            for n in f.lengths:
                own = places[rest >= n]
                own = own[f.passed(~sums.at(own, n))]
                starts.append(own + low)
                sizes.append(np.full(len(own), n))
    return np.concatenate(starts), np.concatenate(sizes)


def window_key(term: Column) -> Column:
    """How `held` names a term: its bytes, or the digits of their SHA-256 where there are more than WIDE."""
    return F.when(F.octet_length(term) > WIDE, F.sha2(term, 256)).otherwise(term).cast("binary")


def held(texts: DataFrame, text: str, terms: DataFrame, term: str) -> DataFrame:
    """The other columns of each text that holds any of the terms, and `held`: window_key of all that it holds, each once, in order.

    A few windows that are no terms are among them, so a join with the terms has to follow. Terms are different; null and empty
    ones are in no text. The filters, of 8 to 16 bytes a term, go to every worker; texts stay where they are read.
    """
    rest = [c for c in texts.columns if c != text]
    filters = _filters(terms, term)
    schema = ", ".join([*(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in rest), "held array<binary>"])
    if not filters:
        return texts.select(*rest, F.array().cast("array<binary>").alias("held")).limit(0)
    known = texts.sparkSession.sparkContext.broadcast(filters)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ends, names = [], [0], []
            for low, high, data, offsets in text_chunks(batch.column(len(rest))):
                starts, sizes = _windows(data, offsets, known.value)
                order = np.argsort(starts, kind="stable")
                starts, sizes = starts[order], sizes[order]
                edges, raw = np.searchsorted(starts, offsets), data.tobytes()
                for k in np.flatnonzero(np.diff(edges)).tolist():
                    at = slice(edges[k], edges[k + 1])
                    own = {raw[a : a + n] if n <= WIDE else sha256(raw[a : a + n]).hexdigest().encode() for a, n in zip(starts[at].tolist(), sizes[at].tolist(), strict=True)}
                    names += sorted(own)
                    rows.append(low + k)
                    ends.append(len(names))
            kept = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(kept) for k in range(len(rest))), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(names, pa.binary()))], [*rest, "held"])

    return texts.select(*rest, text).mapInArrow(look, schema)
