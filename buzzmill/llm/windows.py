"""Repeated windows of symbols: content-chosen anchors, first occurrences in sorted streams, and rows brought to their texts.

A window is a run of `width` symbols (bytes or words) of one text. Its anchor is the run of `gram` symbols in it whose
hash is least, leftmost among equals, so windows of equal content have equal anchors at equal places. Neighbouring
windows with the same anchor form a segment of at most 2 * width - gram symbols. Instead of a row for each window there
is one for each segment, about 2 / (width - gram + 2) of the symbols.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import BASE_A, BASE_B, mix, ranges, rolling, sliding_min

HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0xFFFFFFFF)
SEGMENTS = "dup boolean, anchor long, seg long, row_key long, start int, n int"


@dataclass(frozen=True)
class Shape:
    """Symbols of a window and of the gram that anchors it."""

    width: int
    gram: int


def segments(symbols: np.ndarray, offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """Row, start (in its row), windows, anchor's hash and segment's hash."""
    lengths = np.diff(offsets)
    windows = np.maximum(lengths - shape.width + 1, 0)
    if not windows.sum():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = mix(rolling(symbols, shape.gram, BASE_A))
    least = sliding_min((grams & HIGH) | np.arange(len(grams), dtype=np.uint64), shape.width - shape.gram + 1)
    at = ranges(offsets[:-1], windows)
    anchors = (least[at] & LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    n = np.diff(np.append(first, len(at)))
    start, anchor = at[first], anchors[first]
    cover = [*range(0, shape.width - shape.gram, shape.gram), shape.width - shape.gram]
    seg = n.astype(np.uint64)
    for shift in cover:
        seg = mix(seg * np.uint64(BASE_B) + grams[start + shift])
    for shift in cover:
        seg = mix(seg * np.uint64(BASE_B) + grams[start + n - 1 + shift])
    row = np.searchsorted(offsets, start, "right") - 1
    return row, start - offsets[row], n, grams[anchor], seg


def segment_batch(keys: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Rows of SEGMENTS; of segments that are equal within the batch, all but the first are marked dup."""
    row, start, n, anchor, seg = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
    key, anchor, seg = keys[row.astype(np.int64)], anchor.astype(np.uint64).view(np.int64), seg.astype(np.uint64).view(np.int64)
    order = np.lexsort((start, key, seg, anchor))
    same = np.zeros(len(order), bool)
    if len(order):
        same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (seg[order][1:] == seg[order][:-1])
    columns = [same, anchor[order], seg[order], key[order], start[order].astype(np.int32), n[order].astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dup", "anchor", "seg", "row_key", "start", "n"])


def dealt_by() -> Column:
    """What rows of SEGMENTS are dealt to tasks by: equal anchors together; dups, which need no company, anywhere."""
    return F.when(F.col("dup"), F.xxhash64("row_key", "start")).otherwise(F.col("anchor"))


def in_order(rows: DataFrame) -> DataFrame:
    """Equal anchors together and sorted; dups are spread evenly."""
    return rows.repartition(dealt_by()).sortWithinPartitions("dup", "anchor", "seg", "row_key", "start")


def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add `first` (the first of its segment) and `open_` (a first whose anchor has other segments too) to sorted rows.

    A stream in bounded memory: only the last first row is held back, until it is known what follows it.
    """
    held: pa.RecordBatch | None = None
    held_open = False

    def flags(batch: pa.RecordBatch, first, open_) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(first), pa.array(open_)], [*batch.schema.names, "first", "open_"])

    for batch in batches:
        if not batch.num_rows:
            continue
        dup, anchor, seg = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("dup", "anchor", "seg"))
        first = ~dup
        first[1:] &= (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1]) | dup[:-1]
        if held is not None and not dup[0]:
            h = held.to_pylist()[0]
            first[0] &= anchor[0] != h["anchor"] or seg[0] != h["seg"]
        at = np.flatnonzero(first)
        open_ = np.zeros(len(first), bool)
        if len(at):
            near = anchor[at][1:] == anchor[at][:-1]
            open_[at[1:]] |= near
            open_[at[:-1]] |= near
            if held is not None:
                joined = anchor[at[0]] == held.column(held.schema.get_field_index("anchor"))[0].as_py()
                open_[at[0]] |= joined
                yield flags(held, [True], [held_open or joined])
            last = at[-1]
            held, held_open = batch.slice(last, 1), bool(open_[last])
            keep = np.ones(len(first), bool)
            keep[last] = False
            yield flags(batch.filter(pa.array(keep)), first[keep], open_[keep])
        else:
            yield flags(batch, first, open_)
    if held is not None:
        yield flags(held, [True], [held_open])


def beside_texts(docs: DataFrame, rows: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """docs joined with the list `found` of their rows; texts are shuffled, never sorted."""
    lists = rows.groupBy("row_key").agg(F.collect_list(F.struct(*columns)).alias("found"))
    return docs.join(lists.hint("shuffle_hash"), "row_key", how)


def covered(found: list[dict] | None, length: int, width: int) -> np.ndarray:
    """Which of `length` symbols lie in a window that `found` (start and n of its windows) lists."""
    steps = np.zeros(length + 1, np.int64)
    for r in found or ():
        steps[r["start"]] += 1
        steps[r["start"] + r["n"] - 1 + width] -= 1
    return np.cumsum(steps[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


Kernel = Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def scan_segments(docs: DataFrame, symbols: Kernel, shape: Shape) -> DataFrame:
    """SEGMENTS of all texts. symbols gives, for chunks of rows, the first row, symbols and their offsets by row."""

    def task(batches):
        for batch in batches:
            found = []
            for at, values, offsets in symbols(batch.column(1)):
                row, *rest = segments(values, offsets, shape)
                found.append((row + at, *rest))
            yield segment_batch(batch.column(0).to_numpy(zero_copy_only=False), found)

    return docs.select("row_key", "text").mapInArrow(task, SEGMENTS)
