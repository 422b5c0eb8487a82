"""Ranked lexical search: a forward index in blocks of documents, with each block's greatest impact of a term.

A document's score for an item adds, over the item's terms, the term's weight times its impact in the document. A block of
consecutive documents keeps its documents' terms and, for each term, the greatest impact in the block; weights times these
bound the score of every document in it. A first round scores for each item the few blocks of the highest bounds, which gives a
score that enough documents reach. A second round goes over all blocks: each task sorts its blocks by an item's bound
and scores them from the highest down, until the bound is below the least score that may still count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buzzmill.llm.shared import batch_rows, decoded_rows, materialize, ranges, text_chunks
from buzzmill.operators.tables import first_rows

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that part terms become spaces, A-Z become a-z; bytes of other characters stay.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: A block holds so many documents, or fewer when they have so many terms (a term counts once a document).
BLOCK_DOCS, BLOCK_TERMS = 64, 100_000
#: Blocks that a task sorts at once, and blocks an item scores in the first round.
SORTED_BLOCKS, FIRST_BLOCKS = 64, 4
#: Blocks that a task decodes at once: one takes some hundred KB, so that a file of the index does not fit a task.
DECODED_BLOCKS = 16
#: Terms of items (once an item) that a pass over the index answers together; its list, of some MB, goes to each task.
PASS_TERMS = 100_000
#: Constants of the score: a fixed value each.
UNIT, TERM_PART, SIZE_PART, PERCENT = 1_000_000_000, 1000, 12, 25
BLOCK = "block long, doc_ids array<long>, sizes array<long>, n_terms array<int>, places array<int>, times array<int>, terms array<string>, docs array<int>, most array<long>"


def size_factor(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """A document's m, from its number of terms and the corpus's numbers of documents and terms."""
    return 100 - PERCENT + (PERCENT * n * docs) // max(terms, 1)


def impact(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (UNIT * times) // (TERM_PART * times + SIZE_PART * m)


def _block(number: int, held: list[tuple], docs: int, terms: int) -> dict:
    """One row of the index: documents of (doc_id, n, {term: times})."""
    known: dict[bytes, int] = {}
    places = np.array([known.setdefault(t, len(known)) for _, _, c in held for t in c], np.int64)
    times = np.array([x for _, _, c in held for x in c.values()], np.int64)
    counts = np.array([len(c) for _, _, c in held])
    sizes = np.array([n for _, n, _ in held], np.int64)
    most = np.zeros(len(known), np.int64)
    np.maximum.at(most, places, impact(times, np.repeat(size_factor(sizes, docs, terms), counts)))
    return {"block": number, "doc_ids": [d for d, _, _ in held], "sizes": sizes, "n_terms": counts, "places": places, "times": times, "terms": list(known), "docs": np.bincount(places, minlength=len(known)), "most": most}


@dataclass
class Index:
    """Blocks as a stored table, and the corpus's numbers of documents with a term and of terms."""

    blocks: DataFrame
    docs: int
    terms: int


def build(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> Index:
    """The index of all texts; documents without a term are in no block. Nothing is shuffled.

    Scores depend on the corpus's average size, so that is counted first, and a grown corpus is indexed again.
    """
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TERM)).cast("long")
    with_terms, terms = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, many, done = TaskContext.get().partitionId() << 32, [], 0, []
        schema = pa.schema([("block", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("doc_ids", "sizes")], *[(c, pa.list_(pa.int32())) for c in ("n_terms", "places", "times")], ("terms", pa.list_(pa.binary())), ("docs", pa.list_(pa.int32())), ("most", pa.list_(pa.int64()))])

        def batch(done: list[dict]) -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(done, schema)
            at = out.schema.get_field_index("terms")
            return out.set_column(at, "terms", out.column(at).cast(pa.list_(pa.string())))

        for given in batches:
            ids = given.column(0).to_pylist()
            for low, high, data, offsets in text_chunks(given.column(1)):
                raw = data.tobytes().translate(FOLDED)
                for k in range(low, high):
                    words = raw[offsets[k - low] : offsets[k - low + 1]].split()
                    if not words:
                        continue
                    held.append((ids[k], len(words), Counter(words)))
                    many += len(held[-1][2])
                    if len(held) >= block_docs or many >= BLOCK_TERMS:
                        done.append(_block(number, held, with_terms, terms))
                        number, held, many = number + 1, [], 0
                        if len(done) >= 8:
                            yield batch(done)
                            done = []
        if held:
            done.append(_block(number, held, with_terms, terms))
        if done:
            yield batch(done)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return Index(materialize(texts.mapInArrow(rows, BLOCK), "forward-index"), with_terms, terms)


@dataclass
class Items:
    """Items that a pass answers: their terms in one sorted list, and for each term the items that hold it with their weights."""

    keys: np.ndarray
    terms: pa.Array
    starts: np.ndarray
    holders: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, str, int]]) -> Items:
        """From (item, term, weight), each item and term once; the weight counts repeats of the term in the item."""
        keys = sorted({r[0] for r in rows})
        place = {k: i for i, k in enumerate(keys)}
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        terms = sorted({r[1] for r in rows})
        at = {t: i for i, t in enumerate(terms)}
        counts = np.bincount([at[r[1]] for r in rows], minlength=len(terms))
        return Items(np.array(keys), pa.array(terms, pa.string()), np.concatenate(([0], np.cumsum(counts))), np.array([place[r[0]] for r in rows]), np.array([r[2] for r in rows], np.int64))

    def found(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each item and term that the block holds: item, place of the term in the block, weight."""
        known = np.flatnonzero(block.own >= 0)
        term = block.own[known]
        counts = self.starts[term + 1] - self.starts[term]
        flat = ranges(self.starts[term], counts)
        return self.holders[flat], np.repeat(known, counts), self.weights[flat]


@dataclass
class Block:
    """One block in a task: own is each term's place among the items' terms, or -1."""

    number: int
    own: np.ndarray
    most: np.ndarray
    doc_ids: list | None = None
    n_terms: np.ndarray | None = None
    places: np.ndarray | None = None
    impacts: np.ndarray | None = None
    by_item: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def bounds(self, items: Items) -> np.ndarray:
        holder, place, weight = items.found(self)
        out = np.zeros(len(items.keys), np.int64)
        np.add.at(out, holder, weight * self.most[place])
        order = np.argsort(holder, kind="stable")
        edges = np.searchsorted(holder[order], np.arange(len(items.keys) + 1))
        self.by_item = {i: (place[order[a:b]], weight[order[a:b]]) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b}
        return out

    def scores(self, item: int) -> np.ndarray:
        """Of every document of the block, for an item, after bounds."""
        weights = np.zeros(len(self.most), np.int64)
        place, weight = self.by_item[item]
        weights[place] = weight
        return np.add.reduceat(weights[self.places] * self.impacts, np.concatenate(([0], np.cumsum(self.n_terms)[:-1])))


def _numbers(column: pa.ListArray, k: int) -> np.ndarray:
    return column[k].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(batch: pa.RecordBatch, items: Items, index_docs: int = 0, index_terms: int = 0) -> Iterator[Block]:
    column = {n: batch.column(n) for n in batch.schema.names}
    for k, number in enumerate(column["block"].to_pylist()):
        own = pc.fill_null(pc.index_in(column["terms"][k].values, value_set=items.terms), -1).to_numpy(zero_copy_only=False)
        block = Block(number, own, _numbers(column["most"], k))
        if "places" in column:
            block.doc_ids, block.n_terms, block.places = column["doc_ids"][k].as_py(), _numbers(column["n_terms"], k), _numbers(column["places"], k)
            m = size_factor(_numbers(column["sizes"], k), index_docs, index_terms)
            block.impacts = impact(_numbers(column["times"], k), np.repeat(m, block.n_terms))
        yield block


class Best:
    """The k best documents seen of each item, and the least score that still counts."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.least = k, np.maximum(least, 1)
        self.rows: list[list[tuple]] = [[] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, doc_ids: list) -> None:
        at = np.flatnonzero(scores >= self.least[item])
        if not len(at):
            return
        # highest score first, then the least id, no id last
        held = self.rows[item] + [(-int(scores[x]), doc_ids[x] is None, doc_ids[x] or 0) for x in at]
        held.sort()
        self.rows[item] = held[: self.k]
        if len(held) >= self.k:
            self.least[item] = max(self.least[item], -self.rows[item][-1][0])

    def batch(self, items: Items) -> pa.RecordBatch:
        rows = [(int(items.keys[i]), None if none else d, -s) for i, held in enumerate(self.rows) for s, none, d in held]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_item", "doc_id", "score"])


def _scored(blocks: DataFrame, items: Items, k: int, least: np.ndarray, index: Index) -> DataFrame:
    """_item, doc_id and score: of each task the k best documents of each item among those that reach `least`, and score above 0."""
    docs, terms = index.docs, index.terms

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.keys), k, least.copy())
        for batch in batches:
            held = list(_blocks(batch, items, docs, terms))
            bounds = np.stack([b.bounds(items) for b in held])
            for item in np.flatnonzero((bounds >= best.least).any(axis=0)):
                for at in np.argsort(-bounds[:, item], kind="stable"):
                    if bounds[at, item] < best.least[item]:
                        break
                    best.add(item, held[at].scores(item), held[at].doc_ids)
        yield best.batch(items)

    return blocks.mapInArrow(rows, "_item long, doc_id long, score long")


def _first_blocks(blocks: DataFrame, items: Items) -> DataFrame:
    """_item, block and bound: of each task the FIRST_BLOCKS blocks of the highest bounds of each item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros((0, len(items.keys)), np.int64)
        number = np.zeros((0, len(items.keys)), np.int64)
        for batch in batches:
            held = list(_blocks(batch, items))
            top = np.vstack([top, *[b.bounds(items) for b in held]])
            number = np.vstack([number, *[np.full(len(items.keys), b.number) for b in held]])
            order = np.argsort(-top, axis=0, kind="stable")[:FIRST_BLOCKS]
            top, number = np.take_along_axis(top, order, 0), np.take_along_axis(number, order, 0)
        kept = top > 0
        columns = [np.broadcast_to(items.keys, top.shape)[kept], number[kept], top[kept]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_item", "block", "bound"])

    return blocks.select("block", "terms", "most").mapInArrow(rows, "_item long, block long, bound long")


def _passes(rows: DataFrame) -> Iterator[Items]:
    """Items in order, as many at a time as have PASS_TERMS terms; the driver holds one pass at a time."""
    held: list[tuple] = []
    for r in rows.orderBy("_item").toLocalIterator():
        if len(held) >= PASS_TERMS and held[-1][0] != r[0]:
            yield Items.of(held)
            held = []
        held.append((r[0], r[1], r[2]))
    if held:
        yield Items.of(held)


def _best_rows(rows: DataFrame, k: int) -> DataFrame:
    return first_rows(rows, ["_item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)


def ranked(index: Index, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score: of each row of items (item_id, text) the k documents of the highest score above 0, ties to the smaller id."""
    spark = index.blocks.sparkSession
    words = F.array_remove(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), TERM.replace("[^", "[")), "")
    asked = materialize(items.select(F.monotonically_increasing_id().alias("_item"), "item_id", words.alias("words")), "items")
    terms = asked.select("_item", F.explode("words").alias("term")).groupBy("_item", "term").agg(F.count("*").alias("repeats"))
    held = index.blocks.select(F.explode(F.arrays_zip("terms", "docs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.docs").alias("docs"))
    df = held.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    with decoded_rows(spark, DECODED_BLOCKS):
        weighed = materialize(terms.join(df, "term").select("_item", "term", (weight * F.col("repeats")).alias("weight")), "weights")
    found = [spark.createDataFrame([], "_item long, doc_id long, score long")]
    with batch_rows(spark, SORTED_BLOCKS), decoded_rows(spark, DECODED_BLOCKS):
        for part in _passes(weighed):
            first = first_rows(_first_blocks(index.blocks, part), ["_item"], [F.desc("bound"), "block"], FIRST_BLOCKS)
            # FIRST_BLOCKS rows an item of the pass at most
            few = index.blocks.join(F.broadcast(first.select("block").distinct()), "block", "left_semi")
            reached = _best_rows(_scored(few, part, k, np.zeros(len(part.keys), np.int64), index), k)
            enough = {r[0]: r[1] for r in reached.groupBy("_item").agg(F.min("score"), F.count("*").alias("n")).where(F.col("n") >= k).collect()}
            least = np.array([enough.get(int(key), 0) for key in part.keys], np.int64)
            found.append(materialize(_best_rows(_scored(index.blocks, part, k, least, index), k), "found"))
    best = reduce(DataFrame.unionByName, found)
    rank = F.row_number().over(Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))).alias("rank")
    return best.select("_item", rank, "doc_id", "score").join(asked.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """ranked over the index of docs (doc_id, text).

    A null or empty text, or one without terms, is never found and asks for nothing. Rows with equal or null ids are documents or
    items of their own; among equal scores a null id comes last. An empty table on either side gives no rows; other columns
    are ignored. A very long text is one document of one block, and a task holds SORTED_BLOCKS blocks, however long
    the files of the index are.
    """
    return ranked(build(docs), items, k)


_SQL_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_SQL_TERMS} AS t FROM documents), c AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
m AS (SELECT doc_id, {100 - PERCENT} + ({PERCENT} * len(t) * n_docs) // l AS m FROM d, c WHERE len(t) > 0),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT item_id, term, times * floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN f USING (term), c),
s AS (SELECT item_id, doc_id, sum(w * (({UNIT} * tf) // ({TERM_PART} * tf + {SIZE_PART} * m)))::BIGINT AS score FROM w JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
