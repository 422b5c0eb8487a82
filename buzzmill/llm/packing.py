"""Bounded-space online packing of tokenised documents into fixed windows.

Each task keeps a fixed number of open windows. A document longer than a window fills whole ones; its remainder goes
to the open window that it fits best. When none fits and no more may be opened, the fullest is topped up with the head
of the remainder and emitted, so no emitted window holds padding. What stays open at the end of each task, less than
one window, is merged with that of other tasks; the last remainder of a merge is cut at powers of two, which need no
padding either.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import batch_rows, materialize, text_buffers

WINDOW, OPEN, END_ID = 4096, 32, 2
#: Tasks whose leftovers are merged by one task: 8 MB of ids at most.
MERGED_TASKS = 512
#: Distinct words that a worker remembers in each of two generations: some 70 MB each. Frequent words pass on to the next.
CACHED_WORDS = 500_000
#: Documents handed to Python at once: a worker keeps the memory that its largest batch took.
BATCH_DOCS = 2000
#: A mark that ends a word but belongs to what stands before it: after neither letter, digit nor white space.
BOUND = re.compile(rb"[.,](?<=[^a-z0-9\x20\x09-\x0D].)(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)[\x20\n]", re.S)
#: A word that is one id and part of no other.
MARK = b"|"
#: Rules of tokenizers that treat each word apart and in lower case. Fixed values, as such a tokenizer's file states them.
LOWERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordIds:
    """Ids of texts. If no rule of the tokenizer reaches across white space each word is encoded once; else whole texts are encoded."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        self.cached_words = cached_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        rules = json.loads(self.tokenizer.to_str())
        parts = (rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.by_word = (rules["normalizer"] or {}).get("normalizers") == LOWERS and parts[0].get("pattern") == {"Regex": PARTS} and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True and rules["post_processor"] is None
        mark = self._encode([MARK.decode()])[0]
        self.by_word, self.mark = self.by_word and len(mark) == 1, mark[:1]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_word:
            yield from (e.tobytes() for e in self._encode([t.decode() for t in texts]))
            return
        split = [plain(t).split() for t in texts]
        self._learn(set().union(*split))
        for words in split:
            yield b"".join(map(self.known.__getitem__, words))

    def _learn(self, words: set[bytes]) -> None:
        """Encode unknown words, many in one text (each text costs some 20 microseconds), parted by a mark of one id of its own."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.cached_words:
            self.older, self.known = self.known, {}
            new = words
        self.known.update((w, self.older[w]) for w in new & self.older.keys())
        new = new.difference(self.known)
        odd = [w for w in new if MARK in w]
        new = list(new.difference(odd))
        parts = [new[at : at + 1000] for at in range(0, len(new), 1000)]
        for part, ids in zip(parts, self._encode([(b" " + MARK + b" ").join(p).decode() for p in parts]), strict=True):
            raw, edges = ids.tobytes(), np.concatenate(([-1], np.flatnonzero(ids == self.mark), [len(ids)])).tolist()
            for word, low, high in zip(part, edges[:-1], edges[1:], strict=True):
                self.known[word] = raw[4 * low + 4 : 4 * high]
        for word, ids in zip(odd, self._encode([w.decode() for w in odd]), strict=True):
            self.known[word] = ids.tobytes()


_encoders: dict[tuple[str, int], WordIds] = {}


def plain(text: bytes) -> bytes:
    """Fewer distinct words with the same ids: the tokenizer lower-cases, and parts a word from the mark that ends it."""
    if b"<|" in text:
        return text
    text = text.lower()
    if BOUND.search(text):
        return text
    return text.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n").replace(b",\n", b" ,\n")


def encoded(texts: pa.Array, path: str, cached_words: int = CACHED_WORDS) -> Iterator[bytes]:
    """Ids of each text with the closing id, about 4 MB of text at a time."""
    encode = _encoders.get((path, cached_words))
    if encode is None:
        encode = _encoders[path, cached_words] = WordIds(path, cached_words)
    data, offsets = text_buffers(texts)
    raw, end = data.tobytes(), END_ID.to_bytes(4, "little")
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), "right")) - 1)
        for ids in encode([raw[offsets[k] : offsets[k + 1]] for k in range(at, to)]):
            yield ids + end
        at = to


class Packer:
    """Online packing of pieces (doc_id, start, ids, doc_tokens) into windows; `done` holds emitted rows."""

    def __init__(self, first_sequence: int, size: int = WINDOW, most_open: int = OPEN):
        self.next, self.size, self.most_open = first_sequence, size, most_open
        self.open: list[tuple[int, list]] = []
        self.done: list[tuple] = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.done.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        while len(ids) >= 4 * self.size:
            self.emit([(doc_id, start, ids[: 4 * self.size], doc_tokens)])
            start, ids = start + self.size, ids[4 * self.size :]
        n = len(ids) // 4
        if not n:
            return
        best, least, fullest = -1, self.size + 1, 0
        for k, (used, _) in enumerate(self.open):
            if n <= self.size - used < least:
                best, least = k, self.size - used
            if used > self.open[fullest][0]:
                fullest = k
        if best < 0 and len(self.open) >= self.most_open:
            used, pieces = self.open.pop(fullest)
            head = self.size - used
            self.emit([*pieces, (doc_id, start, ids[: 4 * head], doc_tokens)])
            start, ids, n = start + head, ids[4 * head :], n - head
        if best < 0:
            self.open.append((n, [(doc_id, start, ids, doc_tokens)]))
        elif least == n:
            self.emit([*self.open.pop(best)[1], (doc_id, start, ids, doc_tokens)])
        else:
            used, pieces = self.open[best]
            pieces.append((doc_id, start, ids, doc_tokens))
            self.open[best] = (used + n, pieces)

    def drain(self) -> list:
        """Fill windows with what is open, fullest first; returns the pieces of the last, partial one."""
        held = [p for _, pieces in sorted(self.open, key=lambda w: -w[0]) for p in pieces]
        self.open, filled, used = [], [], 0
        for doc_id, start, ids, doc_tokens in held:
            while used + len(ids) // 4 >= self.size:
                head = self.size - used
                self.emit([*filled, (doc_id, start, ids[: 4 * head], doc_tokens)])
                start, ids, filled, used = start + head, ids[4 * head :], [], 0
            if ids:
                filled.append((doc_id, start, ids, doc_tokens))
                used += len(ids) // 4
        return filled

    def close(self) -> None:
        """Drain, and emit the last partial window as sequences of power-of-two lengths, longest first."""
        pieces = self.drain()
        left = sum(len(p[2]) // 4 for p in pieces)
        while left:
            room, taken = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                doc_id, start, ids, doc_tokens = pieces.pop(0)
                head = min(room, len(ids) // 4)
                taken.append((doc_id, start, ids[: 4 * head], doc_tokens))
                if len(ids) > 4 * head:
                    pieces.insert(0, (doc_id, start + head, ids[4 * head :], doc_tokens))
                room -= head
            self.emit(taken)


def _batch(done: list[tuple], task: int, left: list = ()) -> pa.RecordBatch:
    rows = [(*d, None, None) for d in done] + [(doc_id, start, len(ids) // 4, None, doc_tokens, None, place, ids, task) for place, (doc_id, start, ids, doc_tokens) in enumerate(left)]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "task"])


def pack(docs: DataFrame, tokenizer: str, size: int = WINDOW, most_open: int = OPEN, cached_words: int = CACHED_WORDS) -> DataFrame:
    """One row a piece: doc_id, start and length of its ids, crc32 of them, the document's ids, sequence and offset in it.

    A null or empty text is the closing id alone. Every id is in one piece, so no row is dropped; equal and null ids of
    documents are carried as they are. An empty table gives no pieces. Other columns of docs are ignored.
    Very long texts are cut like others. A piece left over at a task's end carries its place there, so a rerun of the
    same partitions merges leftovers in the same order. cached_words bounds what a worker remembers, and keeps after the job. tokenizer is a path of any tokenizer file that every executor can read. A task holds most_open windows, whatever the size of its input.
    """

    def task(batches):
        number = TaskContext.get().partitionId()
        packer = Packer(number << 40, size, most_open)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), tokenizer, cached_words), strict=True):
                packer.add(doc_id, 0, ids, len(ids) // 4)
            yield _batch(packer.done, number)
            packer.done = []
        left = packer.drain()
        yield _batch(packer.done, number, left)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        packer = Packer((1 << 62) + (int(key[0]) << 24), size, most_open)
        rows = rows.sort_values(["task", "offset"])
        for r in rows.itertuples():
            packer.add(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), bytes(r.ids), int(r.doc_tokens))
        packer.close()
        out = pd.DataFrame(packer.done, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return out.astype({"doc_id": "Int64"})

    packed = docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(task, f"{PIECES}, ids binary, task long")
    with batch_rows(docs.sparkSession, BATCH_DOCS):
        packed = materialize(packed, "packed")
    names = [c.split()[0] for c in PIECES.split(", ")]
    merged = packed.where("ids is not null").groupBy(F.floor(F.col("task") / MERGED_TASKS).alias("part")).applyInPandas(merge, PIECES)
    return packed.where("ids is null").select(*names).unionByName(merged)
