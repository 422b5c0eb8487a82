"""Token counts of every prefix of a text, by dynamic programming over the pieces that may end it.

A pair-merging tokenizer gives each prefix one last piece: the piece t that ends it such that what stands before t, encoded
on its own, ends with a piece u that stays apart from t when the two are encoded together. So the count of a prefix is the
count of the shorter prefix before t, and one more; the text is never encoded again to learn where a limit falls. The table
of a document holds the steps from each prefix's count to the next one's, one signed byte a character, in Parquet a small part
of the text. Counts are not monotone (a longer piece may replace several), so questions read the whole table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How the tokenizer writes a space. A fixed value of its file format.
BLANK = "▁"
#: Words, and pairs of pieces, that a worker remembers at once; then it forgets the older half or all.
CACHED_WORDS, CACHED_PAIRS = 500_000, 1_000_000
#: Texts whose tables are made at once have at most so many bytes, or are one text.
CHUNK_BYTES = 4 << 20


class PrefixCounter:
    """Steps of a text's token counts, for a sentencepiece model of pair merges that leaves texts as they are."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " ﬁ Å\t　Å  x "
        if model.normalize(probe) != (BLANK + probe).replace(" ", BLANK):
            raise ValueError("the model rewrites texts, or adds no blank before them")
        kept = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in kept) or not any(model.is_byte(i) for i in range(model.vocab_size())):
            raise ValueError("the model has unused pieces, or no bytes to fall back on")
        self.score = {model.id_to_piece(i): model.get_score(i) for i in kept}
        if any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError("a piece reaches across words")
        self.letters = {p for p in self.score if len(p) == 1}
        if len({c for p in self.score for c in p} - self.letters):
            raise ValueError("a piece holds a character that is no piece")
        self.words = re.compile(self._words())
        self.ends = ahocorasick.Automaton()
        self.halves: dict[str, tuple[str, str]] = {}
        for piece in self.score:
            parts = self.merged(piece, most=2)
            if len(piece) == 1 or self.merged(piece) == [piece]:
                self.ends.add_word(piece, piece)
                self.halves[piece] = (parts[0], parts[-1])
                if any(len(p) > 1 and self.score[p] < self.score[piece] for p in parts):
                    raise ValueError(f"{piece} scores more than a part of it")
        self.ends.make_automaton()
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _words(self) -> str:
        """A pattern of the words of a text, none of whose edges any piece reaches across: as the vocabulary shows."""
        follows = {(a, b) for p in self.score for a, b in zip(p, p[1:], strict=False)}
        marks = {c for c in self.letters if not (c.isalpha() or c.isdecimal() or c == BLANK)}
        while joined := {b for a, b in follows if b in marks and a not in marks and a != BLANK}:
            marks -= joined
        line = "" if "\n" in self.letters else "\n"
        of = "".join(map(re.escape, sorted(marks))) or BLANK
        return f"{line + '|' if line else ''}{BLANK}*[^{BLANK}{line}{of}]+|{BLANK}*[{of}]+[^{BLANK}{line}{of}]*|{BLANK}+"

    def merged(self, text: str, most: int = 1) -> list[str]:
        """Pieces of a short text, or its `most` parts before the last joins: of neighbours whose join is a piece, those of the best score join first, leftmost first."""
        parts = list(text)
        while len(parts) > most:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether two pieces side by side stay as they are.

        Seen backwards, the joins that made them are undone, latest first, as far as they touch the edge. What then meets at the
        edge would have joined if its join comes before the one undone last: by score, and of equal ones the leftmost first.
        """
        if (known := self.apart.get((left, right))) is not None:
            return known
        a, b, undone, of_left = left, right, -math.inf, False
        while True:
            score = self.score.get(a + b)
            if score is not None and (score > undone or score == undone and not of_left):
                out = False
                break
            if len(a) == 1 == len(b):
                out = True
                break
            of_left = len(b) == 1 or len(a) > 1 and self.score[a] < self.score[b]
            if of_left:
                undone, a = self.score[a], self.halves[a][1]
            else:
                undone, b = self.score[b], self.halves[b][0]
        if len(self.apart) >= CACHED_PAIRS:
            self.apart.clear()
        self.apart[left, right] = out
        return out

    def counts(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, from none of its characters to all; the work grows with its length."""
        ending: dict[int, list[str]] = {}
        for at, piece in self.ends.iter(word):
            ending.setdefault(at + 1, []).append(piece)
        last: list[str | None] = [None] * (len(word) + 1)
        counts = [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            if end not in ending:  # no piece holds this character: it is bytes, and nothing joins across it
                counts[end] = counts[end - 1] + len(word[end - 1].encode("utf-8", "replace"))
                continue
            for piece in ending[end]:
                before = last[end - len(piece)]
                if before is None or self.stay_apart(before, piece):
                    last[end], counts[end] = piece, counts[end - len(piece)] + 1
                    break
            else:
                raise ValueError("the model's merges don't follow its scores")
        return counts

    def steps_of(self, word: str) -> bytes:
        if (steps := self.known.get(word)) is not None:
            return steps
        if len(self.known) >= CACHED_WORDS:
            self.older, self.known = self.known, {}
        if (steps := self.older.get(word)) is None:
            counts = self.counts(word)
            steps = bytes([(b - a) & 255 for a, b in pairwise(counts)])
        if len(word) <= 64:
            self.known[word] = steps
        return steps

    def steps(self, text: str) -> bytes:
        """One signed byte for each character: the count of the prefix that it ends, less the count of the one before."""
        if not text:
            return b""
        found = self.words.findall(BLANK + text.replace(" ", BLANK))
        out = b"".join(map(self.steps_of, found))
        first = np.frombuffer(out[:2], np.int8).sum(dtype=np.int8).tobytes()
        return first + out[2:]


_counters: dict[str, PrefixCounter] = {}


def _runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `most` in all, or of one row."""
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


def prefix_counts(docs: DataFrame, model: str, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_bytes, n_chars and steps: the token count of a prefix of k characters is the sum of the first k steps (signed bytes).

    The counts are those of the library without begin, end or added special tokens; strings that look like special tokens are
    ordinary text. A null text is an empty one, which has no tokens. Rows are kept as they are, ids null or repeated
    too; an empty table gives no rows. Other columns of docs are ignored but for those in keep, which are carried along. A
    text is handled word by word, and a text of one word in time that grows with its length, so very long texts need some
    memory of their own size. model is a path that executors can read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"), *keep)
    fields = [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_chars", T.LongType()), ("steps", T.BinaryType()))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _counters:
            _counters[model] = PrefixCounter(model)
        steps = _counters[model].steps
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, to in _runs(sizes, CHUNK_BYTES):
                part = batch.slice(at, to - at)
                texts = [t or "" for t in part.column(1).to_pylist()]
                own = [part.column(0), pa.array(sizes[at:to]), pa.array([len(t) for t in texts], pa.int64()), pa.array([steps(t) for t in texts], pa.binary())]
                yield pa.RecordBatch.from_arrays([*own, *part.columns[2:]], [*(f.name for f in fields), *keep])

    return rows.mapInArrow(counted, T.StructType(fields + rows.schema.fields[2:]))


def _answers(name: str, answer) -> Column:
    """A column of longs out of the column steps, each row's counts given to answer as an array."""

    @F.pandas_udf("long")
    def of(steps):
        return steps.map(lambda raw: answer(np.cumsum(np.frombuffer(raw, np.int8), dtype=np.int64)))

    return of("steps").alias(name)


def count_at(chars: int | None = None) -> Column:
    """Tokens of the first `chars` characters of each row of prefix_counts (None, or more than there are: of the whole text)."""
    return _answers("n_tokens", lambda counts: int(counts[min(len(counts), len(counts) if chars is None else chars) - 1]) if len(counts) and chars != 0 else 0)


def fitting(limit: int) -> Column:
    """Characters of the longest prefix of at most `limit` tokens of each row of prefix_counts."""

    def answer(counts: np.ndarray) -> int:
        fit = np.flatnonzero(counts <= limit)
        return int(fit[-1]) + 1 if len(fit) else 0

    return _answers("fit_chars", answer)


def truncated(docs: DataFrame, model: str, limit: int) -> DataFrame:
    """doc_id and text, cut to its longest prefix of at most `limit` tokens; a null text stays null."""
    cut = prefix_counts(docs, model, ["text"]).select("doc_id", "text", fitting(limit))
    return cut.select("doc_id", F.col("text").substr(F.lit(1), F.col("fit_chars").cast("int")).alias("text"))


def measured(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens) and fit_chars, all read from the table of prefixes."""
    table = prefix_counts(docs, model).select("doc_id", "n_bytes", count_at(), fitting(limit))
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")
