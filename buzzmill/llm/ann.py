"""Approximate nearest neighbours by collision counting.

Vectors are dealt to blocks by hash. In a block every random projection has one sorted array, built once; all queries
are then streamed past it. A query opens a window around its own projection in each array; virtual rehashing widens
all windows by the same ratio and counts only what is new. A vector that lies in at least `threshold` of the windows
is verified with its exact cosine. A block is done with a query when as many verified vectors as asked for lie well
within the current radius; after the last radius, a block that still owes some verifies all its vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HITS = "query_id long, vec_id long, score double"
#: Queries whose windows' edges, at every radius, are worked out together: some 6 MB.
QUERIES_AT_ONCE = 256


@dataclass(frozen=True)
class Hashing:
    """projections and seed; half-width of a window at radius 1; share of windows that a candidate must be in; radii.

    A vector at the radius is in 0.84 of the windows on average. The search goes on until the
    radius is `margin` times the distance of the last of the k found. Of 51,282 independent directions in 64 dimensions
    13 of 100 are verified for a query, and 0.98 of the five nearest are found; a larger margin finds and verifies more.
    """

    projections: int = 96
    half: float = 1.4
    threshold: float = 0.8
    margin: float = 1.0
    first_radius: float = 0.6
    ratio: float = 1.06
    seed: int = 42

    def radii(self) -> list[float]:
        out = [self.first_radius]
        while self.half * out[-1] < 2:
            out.append(out[-1] * self.ratio)
        return out


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Block:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, how: Hashing):
        self.ids, self.vectors, self.how = ids, vectors, how
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        axes = np.random.default_rng(how.seed).standard_normal((vectors.shape[1], how.projections))
        self.axes, self.verified = axes, 0
        projected = (vectors / self.norms[:, None]) @ axes
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(projected, order, axis=0).T)
        self.order = np.ascontiguousarray(order.T.astype(np.int32))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        how, n = self.how, len(self.ids)
        need, radii = int(np.ceil(how.threshold * how.projections)), how.radii()
        norms = np.sqrt((queries * queries).sum(axis=1))
        centres = (queries / norms[:, None]) @ self.axes
        wide = how.half * np.array(radii)[:, None]
        edges = np.empty((len(radii), how.projections, 2, len(queries)), np.int64)
        for p, (row, centre) in enumerate(zip(self.sorted, centres.T, strict=True)):
            edges[:, p, 0] = np.searchsorted(row, (centre - wide).ravel()).reshape(len(radii), -1)
            edges[:, p, 1] = np.searchsorted(row, (centre + wide).ravel(), "right").reshape(len(radii), -1)
        found = []
        for j, query_id in enumerate(query_ids):
            counts, open_ = np.zeros(n, np.int64), self.ids != query_id
            wanted = min(k, int(open_.sum()))
            scores, places = np.zeros(0), np.zeros(0, np.int64)
            low = high = edges[0, :, 0, j]
            for level, radius in enumerate(radii):
                to_low, to_high = edges[level, :, 0, j], edges[level, :, 1, j]
                new = [row[a:b] for row, a, b in zip(self.order, to_low, low, strict=True) if a < b] + [row[a:b] for row, a, b in zip(self.order, high, to_high, strict=True) if a < b]
                low, high = to_low, to_high
                if new:
                    counts += np.bincount(np.concatenate(new), minlength=n)
                fresh = np.flatnonzero((counts >= need) & open_)
                if len(fresh):
                    open_[fresh] = False
                    self.verified += len(fresh)
                    exact = (self.vectors[fresh] * queries[j]).sum(axis=1) / (self.norms[fresh] * norms[j])
                    scores, places = np.concatenate((scores, exact)), np.concatenate((places, fresh))
                    best = top(scores, self.ids[places], k)
                    scores, places = scores[best], places[best]
                # on unit vectors, a distance of at most r is a cosine of at least 1 - r * r / 2
                if len(scores) >= wanted and (scores[:wanted] >= 1 - (radius / how.margin) ** 2 / 2).all():
                    break
            if len(scores) < wanted:  # even the widest windows miss far vectors, so all that are left are verified
                left = np.flatnonzero(open_)
                exact = (self.vectors[left] * queries[j]).sum(axis=1) / (self.norms[left] * norms[j])
                scores, places = np.concatenate((scores, exact)), np.concatenate((places, left))
                best = top(scores, self.ids[places], k)
                scores, places = scores[best], places[best]
            found += [(int(query_id), int(self.ids[p]), float(s)) for p, s in zip(places, scores, strict=True)]
        return found


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), np.float64).reshape(-1, dim)


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", how: Hashing = Hashing(), block_bytes: int = 32 << 20) -> DataFrame:
    """The k nearest by cosine of each row that is_query holds for, among all other rows: query_id, rank, vec_id, score.

    Each row is shuffled once, to its block; each query goes to every block, behind the block's rows. A task holds one
    block (block_bytes of vectors and three times that of arrays) and a batch of queries, whatever the table's size.
    Vectors that are null, zero, of another length than most, or that hold a null or a non-finite component take no
    part, nor do rows with a null id. Rows with equal id and vector count once; with equal ids and different vectors,
    the best score of each pair of ids counts. Ties go to the smaller id. Where fewer than k other vectors exist, all
    are returned. A table without valid vectors or queries gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("asks"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = base.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    dims = base.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("ids")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n, ids = dims["dim"], dims["n"], dims["ids"]
    base = base.where(F.size("vec") == dim)
    base = base.dropDuplicates(["vec_id", "vec"]) if ids < n else base
    # few blocks, but work for every core where there are vectors enough
    blocks = max(-(-8 * dim * n // block_bytes), min(2 * spark.sparkContext.defaultParallelism, -(-n // 16384)))
    place = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int")
    rows = base.select(place.alias("block"), F.lit(False).alias("query"), "vec_id", "vec")
    asked = base.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1))).alias("block"), F.lit(True).alias("query"), "vec_id", "vec")
    ordered = rows.unionByName(asked).repartitionByRange(int(blocks), "block").sortWithinPartitions("block", "query")

    def cells(batches):
        number, ids, parts, block = None, [], [], None
        for batch in batches:
            places, queries, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            matrix = _matrix(batch.column(3), dim)
            edges = np.flatnonzero((places[1:] != places[:-1]) | (queries[1:] != queries[:-1])) + 1
            found = []
            for low, high in zip([0, *edges], [*edges, len(places)], strict=True):
                if low == high:
                    continue
                if places[low] != number:
                    number, ids, parts, block = places[low], [], [], None
                if not queries[low]:
                    ids.append(keys[low:high])
                    parts.append(matrix[low:high].copy())
                elif ids:
                    if block is None:
                        block = Block(np.concatenate(ids), np.concatenate(parts), how)
                        parts = []
                    for at in range(low, high, QUERIES_AT_ONCE):
                        to = min(high, at + QUERIES_AT_ONCE)
                        found += block.search(keys[at:to], matrix[at:to], k)
            columns = list(zip(*found, strict=True)) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    hits = ordered.mapInArrow(cells, HITS)
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
