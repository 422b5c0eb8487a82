"""Jaccard self-join of shingle sets, size-aware: small sets by subsets, large ones by inverted lists.

Two sets of sizes n and m are linked when they share at least need(n, m) shingles. Small sets enumerate all their
subsets of exactly that size for each partner size: a common subset is a link. Large sets are found by scanning the
inverted lists of their rarest shingles (a prefix that every linked partner must meet). The boundary between both is
the size at which enumerating costs more rows than scanning. Equal sets are one set from the start.

A long list is never squared. First every set is compared with the most central set of the lists it is in; lists that
then hold one component need nothing more. In a longer list that is still mixed, each set is written as its difference
from the list's head: removed and added shingles. Two sets that are not both linked to the head must share some of
these differences, at least as many as their sizes tell, so rare differences give new and much shorter lists. This
repeats while reading the sets costs less than pairing the rows; what remains is paired, pruned by exact bounds and verified.
"""

import math
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import BASE_A, BASE_B, batch_rows, forget_shuffles, keyed, materialize, mix, only_keys, release, rolling, spread_join, text_chunks, words_of

#: Counters of the sketch of shingle frequencies (4 MB), its parts, and the shingles of least hash that it counts exactly.
SKETCH_BITS, SKETCH_PARTS, EXACT = 20, 16, 4096
#: Sizes that the cost rule looks at. A set of 64 has some 10**10 subsets, more than any scan costs.
SIZES = 64
MERGED_TASKS = 256
#: Lists of up to PAIRED rows are always paired; longer ones are written as differences from a head, ROUNDS times at most.
PAIRED, ROUNDS = 16, 6
#: Rows with a text each that go to Python at once.
TEXT_ROWS = 1000


def need(n, m, percent: int):
    """Least number of common elements with which sets of sizes n and m are linked."""
    return -(-percent * (n + m) // (100 + percent))


def prefix(n: np.ndarray | int, percent: int):
    """Elements of a set of size n of which a linked set has at least one."""
    return n - (-(-percent * n // 100)) + 1


def partners(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_rows(n: int, percent: int) -> int:
    return sum(math.comb(n, need(n, m, percent)) for m in partners(n, percent) if need(n, m, percent) <= min(n, m))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text: runs of `size` words, or all words where there are fewer."""
    for at, end, data, offsets in text_chunks(column):
        upper = (data >= 65) & (data <= 90)
        _, _, words, before = words_of(data + 32 * upper.astype(np.uint8), offsets)
        grams = mix(rolling(words, size, BASE_A))
        for k in range(end - at):
            a, b = before[k], before[k + 1]
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:
                yield mix(rolling(words[a:b], int(b - a), BASE_B) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def _least(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The EXACT least distinct tokens with the sums of their counts."""
    distinct, at = np.unique(tokens, return_inverse=True)
    return distinct[:EXACT], np.bincount(at, counts, len(distinct)).astype(np.uint64)[:EXACT]


def sketch(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Sets by hash bucket of their shingles, by their size up to SIZES, and the mean number of sets of a shingle.

    The last is exact over the EXACT shingles of least hash, which every task knows. 4 MB, whatever the size of docs.
    """
    cells = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        counts, sizes = np.zeros(1 << SKETCH_BITS, np.int64), np.zeros(SIZES + 1, np.int64)
        least = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for batch in batches:
            sets = shingle_sets(batch.column(0), size)
            while found := list(islice(sets, 1000)):
                tokens = np.concatenate(found)
                counts += np.bincount((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                sizes += np.bincount([len(s) for s in found if 0 < len(s) <= SIZES], minlength=SIZES + 1)
                tokens = tokens[tokens <= least[0][-1]] if len(least[0]) == EXACT else tokens
                least = _least(np.concatenate((least[0], tokens)), np.concatenate((least[1], np.ones(len(tokens), np.uint64))))
        parts = [counts[k * cells : (k + 1) * cells].astype(np.uint32).tobytes() for k in range(SKETCH_PARTS)] + [sizes.astype(np.uint32).tobytes(), np.concatenate(least).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([task] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["part", "task", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] == SKETCH_PARTS + 1:
            halves = [np.frombuffer(c, np.uint64).reshape(2, -1) for c in rows["counts"]]
            made = np.concatenate(_least(np.concatenate([h[0] for h in halves]), np.concatenate([h[1] for h in halves])))
        else:
            made = np.minimum(sum(np.frombuffer(c, np.uint32).astype(np.uint64) for c in rows["counts"]), 2**32 - 1).astype(np.uint32)
        return pd.DataFrame({"part": [key[0]], "task": [key[1]], "counts": [made.tobytes()]})

    kind = "part int, task int, counts binary"
    rows = materialize(docs.select("text").mapInArrow(count, kind), "sketch")
    tasks = (rows.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:  # a group holds MERGED_TASKS parts of 256 kB at most
        rows = rows.groupBy("part", F.floor(F.col("task") / MERGED_TASKS).cast("int").alias("task")).applyInPandas(add, kind)
        tasks = -(-tasks // MERGED_TASKS)
    found = {r["part"]: bytes(r["counts"]) for r in rows.collect()}
    of = lambda k, n: np.frombuffer(found[k], np.uint32).astype(np.int64) if k in found else np.zeros(n, np.int64)
    times = np.frombuffer(found.get(SKETCH_PARTS + 1, b""), np.uint64).reshape(2, -1)[1]
    return np.concatenate([of(k, cells) for k in range(SKETCH_PARTS)]), of(SKETCH_PARTS, SIZES + 1), float(times.mean()) if len(times) else 0.0


def boundary(sizes: np.ndarray, length: float, percent: int) -> int:
    """The size up to which sets enumerate subsets, with least rows in all: subsets against prefixes times lists of mean length."""
    scan = [float(sizes[n]) * prefix(n, percent) * (1 + length) for n in range(len(sizes))]
    subsets = [float(sizes[n]) * subset_rows(n, percent) for n in range(len(sizes))]
    return min(range(len(sizes)), key=lambda x: (sum(subsets[: x + 1]) + sum(scan[x + 1 :]), x))


SETS = "row_key long, doc_id long, n int, sig_a long, sig_b long, tokens array<long>, subsets array<struct<low int, high int, hash long>>"


def levels_of(counts: np.ndarray) -> np.ndarray:
    """16 times the logarithm of the counters: 2 MB."""
    return np.minimum(16 * np.log2(counts + 1.0), 65535).astype(np.uint16)


def _level(levels: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return levels[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]


def prefixes(docs: DataFrame, levels, small: int, percent: int, size: int) -> DataFrame:
    """Size, signature, prefix (rarest shingles first, by the sketch; ties by hash) or subsets of every text's set."""

    def task(batches):
        for batch in batches:
            n, sig_a, sig_b, tokens, subsets = [], [], [], [], []
            for s in shingle_sets(batch.column(2), size):
                n.append(len(s))
                sig_a.append(int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0)
                sig_b.append(int((s * np.uint64(BASE_A)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                # lists hold every set that a large one may be linked to
                if len(s) and 100 * len(s) >= percent * (small + 1):
                    tokens.append(s[np.argsort(_level(levels.value, s), kind="stable")[: prefix(len(s), percent)]].view(np.int64))
                else:
                    tokens.append(np.zeros(0, np.int64))
                subsets.append(list(_subsets(s.tolist(), percent)) if 0 < len(s) <= small else [])
            arrays = [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(sig_a, pa.int64()), pa.array(sig_b, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.array(subsets, pa.list_(pa.struct({"low": pa.int32(), "high": pa.int32(), "hash": pa.int64()})))]
            yield pa.RecordBatch.from_arrays(arrays, ["row_key", "doc_id", "n", "sig_a", "sig_b", "tokens", "subsets"])

    return docs.select("row_key", "doc_id", "text").mapInArrow(task, SETS)


def _subsets(s: list[int], percent: int) -> Iterator[dict]:
    n = len(s)
    for m in partners(n, percent):
        k = need(n, m, percent)
        if k <= min(n, m):
            chosen = combinations(s, k)
            while some := list(islice(chosen, 4096)):
                hashes = mix((mix(np.array(some, np.uint64)) * np.uint64(BASE_B)).sum(axis=1, dtype=np.uint64) + np.uint64(k)).view(np.int64)
                yield from ({"low": min(n, m), "high": max(n, m), "hash": h} for h in hashes.tolist())


def _common(n: int, h: int, removed: int, percent: int) -> int:
    """Least number of differences from a head of size h that a set (size n, lacking `removed` of the head) shares with a linked one.

    A partner of size m that lacks r of the head shares need(n, m) - h + removed + r of them, and has m - h + 2 * r itself.
    """
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    wanted = need(n, m, percent) + removed
    return max(1, int((wanted - h + np.maximum(np.maximum(0, h - m), wanted - m)).min()))


DELTA = "head long, row_key long, linked boolean, n int, adj int, rest int, d int, tokens array<long>"


def against_heads(docs: DataFrame, pairs: DataFrame, percent: int, size: int, levels=None) -> DataFrame:
    """For stored pairs (head, row_key): whether both sets are linked; with levels also the differences from the head.

    Texts are sent once for each pair, and a head's text once for each 1,000 of its pairs (or 10,000th part of all),
    ahead of them, so a task holds one head's set and a batch. tokens is the prefix of the differences, rarest first:
    a set y that is linked to x, though not both are linked to the head, shares at least
    need(n_x, n_y) + adj_x + adj_y of all d differences, and one of tokens. rest is the number of differences beyond.
    """
    spark, n = docs.sparkSession, pairs.count()
    limit = max(1000, n // 10_000)
    hot = pairs.groupBy("head").agg(F.count("*").alias("times")).where(F.col("times") > limit)  # 10,000 rows at most
    parted = pairs.join(F.broadcast(hot), "head", "left").select("head", F.coalesce(F.pmod(F.xxhash64("row_key"), F.ceil(F.col("times") / limit)), F.lit(0)).alias("part"), "row_key", F.lit(True).alias("member"))
    wanted = materialize(parted.unionByName(parted.select("head", "part", F.col("head").alias("row_key"), F.lit(False).alias("member")).distinct()), "wanted")
    beside = only_keys(docs.select("row_key", "text"), wanted.select("row_key").distinct(), "row_key").join(wanted.hint("shuffle_hash"), "row_key")
    ordered = beside.repartition("head", "part").sortWithinPartitions("head", "part", "member").select("head", "row_key", "member", "text")

    def compare(batches):
        base = np.zeros(0, np.uint64)
        for batch in batches:
            heads, keys, members = (batch.column(k).to_pylist() for k in range(3))
            out = []
            for head, key, member, s in zip(heads, keys, members, shingle_sets(batch.column(3), size), strict=True):
                if not member:
                    base = s
                    continue
                inside = np.zeros(len(s), bool)
                if len(base):
                    inside = base[np.minimum(np.searchsorted(base, s), len(base) - 1)] == s
                both, h, n = int(inside.sum()), len(base), len(s)
                removed = h - both
                linked = 100 * both >= percent * (n + h - both)
                if levels is None:
                    out.append((head, key, linked, n, 0, 0, 0, None))
                    continue
                gone = np.ones(h, bool)
                gone[np.searchsorted(base, s[inside])] = False
                added, lost = s[~inside], base[gone]
                often = np.exp2(_level(levels.value, added) / 16.0), np.exp2(_level(levels.value, lost) / 16.0)
                most = float(np.exp2(_level(levels.value, base).max(initial=0) / 16.0))
                # a lost shingle is rare if all but a few sets have it
                rarity = np.concatenate((np.minimum(often[0], most), np.maximum(most - often[1], most / 8)))
                signed = np.concatenate((mix(added), mix(lost + np.uint64(BASE_B))))
                d, common = len(signed), _common(n, h, removed, percent)
                chosen = signed[np.lexsort((signed, rarity))[: max(0, d - common + 1)]]
                # |x & y| = |h| - removed_x - removed_y + common differences; |h| is split between both, halves doubled
                out.append((head, key, linked, n, 2 * removed - h, d - len(chosen), d, chosen.view(np.int64)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in DELTA.split(", ")])

    with batch_rows(spark, TEXT_ROWS):
        made = materialize(ordered.mapInArrow(compare, DELTA), "against-heads")
    release(wanted)
    return made


def components(links: DataFrame) -> DataFrame:
    """row_key and comp, the least key of its component, for every key in links (a, b); minima travel, then labels are followed."""
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct()
    edges = materialize(edges, "edges")
    degrees = materialize(edges.groupBy(F.col("u").alias("row_key")).agg(F.least(F.min("u"), F.min("v")).alias("comp"), F.count("*").alias("times")), "degrees")
    total, labels = edges.count(), degrees
    while True:
        theirs = labels.select(F.col("row_key").alias("v"), "comp", "times")
        near = spread_join(edges, theirs, ["v"], "times", total).groupBy(F.col("u").alias("row_key")).agg(F.min("comp").alias("near"))
        stepped = materialize(labels.join(near, "row_key").select("row_key", "times", F.least("comp", "near").alias("to"), F.col("comp").alias("old")), "steps")
        # most rows of a component point to the same row: each such row is looked up once
        aims = stepped.groupBy("to").agg(F.count("*").alias("aimed"))
        aims = materialize(aims.join(labels.select(F.col("row_key").alias("to"), F.col("comp").alias("next")), "to"), "aims")
        after = materialize(spread_join(stepped, aims, ["to"], "aimed", total).select("row_key", "times", F.least("to", "next").alias("comp"), "old"), "labels")
        release(labels, stepped, aims)
        if not after.where("comp < old").limit(1).count():
            release(edges)
            return after.select("row_key", "comp")
        labels = after


def _bounds(percent: int) -> tuple[str, str]:
    """SQL over two rows of one list: whether the set sizes and the places in it allow a link; and whether `met` lists do."""
    wanted = f"ceil({percent} * (n_a + n_b) / {100.0 + percent} - 1e-9) + (adj_a + adj_b) / 2"
    sizes = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    return f"{sizes} and least(at_a, at_b) + least(d_a - at_a, d_b - at_b) >= {wanted}", f"met + greatest(rest_a, rest_b) >= {wanted}"


LIST = ["space", "token", "row_key", "n", "at", "d", "rest", "adj"]


def _of(rows: DataFrame, side: str) -> list:
    return [F.col(c).alias(f"{c}_{side}") for c in ("row_key", "n", "at", "d", "rest", "adj")]


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """Each set with the head that it meets in most lists: one pair a set at most. rows have a struct `top` for the head."""
    fits, enough = _bounds(percent)
    both = rows.select(*_of(rows, "a"), *[F.col(f"top.{c}").alias(f"{c}_b") for c in ("row_key", "n", "at", "d", "rest", "adj")]).where("row_key_a <> row_key_b").where(fits)
    met = both.groupBy("row_key_a", "row_key_b", "n_a", "n_b", "rest_a", "rest_b", "adj_a", "adj_b").agg(F.count("*").alias("met")).where(enough)
    return met.groupBy(F.col("row_key_a").alias("row_key")).agg(F.max_by("row_key_b", F.struct("met", -F.col("row_key_b"))).alias("head")).select("head", "row_key")


def _open(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the lists in which more than one component is left, with the list's length as `times`; and the pairs in them."""
    labelled = rows.join(labels, "row_key", "left").withColumn("comp", F.coalesce("comp", "row_key"))
    mixed = labelled.groupBy("space", "token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("times")).where("low < high")
    mixed = materialize(mixed.drop("low", "high"), "mixed")
    total, work = mixed.agg(F.sum("times"), F.sum(F.col("times") * F.col("times").cast("double"))).first()
    left = materialize(spread_join(labelled, mixed, ["space", "token"], "times", total or 0).select(*LIST, "times"), "open-lists")
    release(mixed)
    return left, work or 0


def _heads(rows: DataFrame) -> DataFrame:
    """Pairs (head, row_key) of long lists, with the row's size n. Heads are central (few rarer shingles), and few: lists agree on those with most votes."""
    first = rows.groupBy("space", "token").agg(F.min(F.struct("at", "row_key")).alias("h"), F.first("times").alias("times"))
    votes = first.groupBy(F.col("h.row_key").alias("row_key")).agg(F.sum("times").alias("votes"))
    voted = rows.join(votes, "row_key", "left").withColumn("votes", F.coalesce("votes", F.lit(0)))
    chosen = voted.groupBy("space", "token").agg(F.max(F.struct("votes", (-F.col("row_key")).alias("k"))).alias("h"), F.first("times").alias("times"))
    chosen = materialize(chosen.select("space", "token", "times", (-F.col("h.k")).alias("head")), "heads")
    total = chosen.agg(F.sum("times")).first()[0] or 0
    members = spread_join(rows.select("space", "token", "row_key", "n"), chosen, ["space", "token"], "times", total)
    pairs = materialize(members.where("row_key <> head").select("head", "row_key", "n").distinct(), "head-pairs")
    release(chosen)
    return pairs


def _pairs(rows: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (head, row_key) of different components that a list and the exact bounds allow to be linked."""
    fits, enough = _bounds(percent)
    rows = rows.join(labels, "row_key", "left").withColumn("comp", F.coalesce("comp", "row_key"))
    x, y = rows.select("space", "token", *_of(rows, "a"), F.col("comp").alias("comp_a")), rows.select("space", "token", *_of(rows, "b"), F.col("comp").alias("comp_b"))
    both = x.join(y, ["space", "token"]).where("row_key_a < row_key_b and comp_a <> comp_b").where(fits)
    met = both.groupBy("space", "row_key_a", "row_key_b", "n_a", "n_b", "rest_a", "rest_b", "adj_a", "adj_b").agg(F.count("*").alias("met")).where(enough)
    return materialize(met.select(F.col("row_key_a").alias("head"), F.col("row_key_b").alias("row_key")).distinct(), "pairs")


def join_components(docs: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """One row for each row of docs: row_key, doc_id, n_shingles and component_id.

    Texts are lower-cased in A-Z; a set holds the distinct runs of `size` words, or all words of a shorter text as one.
    Rows are linked when 100 * common >= percent * united. component_id is the least doc_id that links reach. Null and
    empty texts have no shingles and are linked with nothing; texts of any length are read whole, a task holding a
    batch of TEXT_ROWS of them. Rows with a null id come last and are reached like any other; equal ids are separate
    rows. An empty table gives no rows; other columns are ignored. Links are exact, up to 64-bit hashes of shingles.
    """
    return _joined(keyed(docs), percent, size).drop("comp")


def deduplicate(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """docs without the rows that links connect to one of smaller doc_id: the first of each group stays, with all columns."""
    whole = keyed(docs.withColumnRenamed("row_key", "_row_key"), whole=True)
    kept = _joined(whole.select("row_key", "doc_id", "text"), percent, size).where("row_key = comp").select("row_key")
    out = whole.join(kept.hint("shuffle_hash"), "row_key", "left_semi").drop("row_key")
    return out.withColumnRenamed("_row_key", "row_key").select(*docs.columns)


def _joined(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """join_components over docs with row_key, and the least key of the component as comp."""
    spark = docs.sparkSession
    with batch_rows(spark, TEXT_ROWS):
        counts, sizes, length = sketch(docs, size)
        small = boundary(sizes, length, percent)
        levels = spark.sparkContext.broadcast(levels_of(counts))
        sets = materialize(prefixes(docs, levels, small, percent, size), "sets")
    signature = ["sig_a", "sig_b", "n"]
    full, total = sets.where("n > 0"), sets.count()
    kinds = materialize(full.groupBy(*signature).agg(F.min("row_key").alias("rep"), F.count("*").alias("times")).where("times > 1"), "kinds")
    copies = materialize(spread_join(full.select("row_key", *signature), kinds, signature, "times", total).where("row_key <> rep").select("row_key", "rep"), "copies")
    sources = materialize(full.join(copies, "row_key", "left_anti").select("row_key", "n", "tokens", "subsets"), "sources")
    named = materialize(sets.select("row_key", "doc_id", "n"), "sizes")
    release(sets, kinds)

    subset = sources.select("row_key", "n", F.inline("subsets"))
    lows = subset.where("n = low").groupBy("low", "high", "hash").agg(F.min("row_key").alias("a"))
    links = materialize(subset.withColumnRenamed("row_key", "b").join(lows, ["low", "high", "hash"]).where("a <> b").select("a", "b").distinct(), "subset-links")

    listed = sources.select(F.lit(0).cast("long").alias("space"), F.posexplode("tokens").alias("at", "token"), "row_key", "n", F.col("n").alias("d"), (F.col("n") - F.size("tokens")).alias("rest"), F.lit(0).alias("adj")).select(*LIST)
    repeated = materialize(listed.groupBy("token").agg(F.count("*").alias("times")).where("times > 1"), "repeated")
    entries = repeated.agg(F.sum("times")).first()[0] or 0
    forget_shuffles(spark)
    lists = materialize(spread_join(only_keys(listed, repeated, "token"), repeated, ["token"], "times", entries), "lists")
    release(repeated, sources)
    tops = materialize(lists.groupBy("token").agg(F.min(F.struct("at", "row_key", "n", "d", "rest", "adj")).alias("top"), F.count("*").alias("times")), "tops")
    stars = materialize(_stars(spread_join(lists.drop("times"), tops, ["token"], "times", entries), percent), "stars")
    links = links.unionByName(_linked(against_heads(docs, stars, percent, size)))
    labels = components(links)
    # a list of up to PAIRED rows waits for the last pairing; only lists that may be written as differences are opened, each of them once
    short = lists.where(F.col("times") <= PAIRED).select(*LIST)
    left, _ = _open(lists.where(F.col("times") > PAIRED).select(*LIST), labels)
    stored = [lists, left]
    release(tops, stars)
    forget_shuffles(spark)
    for _ in range(ROUNDS):
        squared = left.agg(F.sum("times")).first()[0] or 0
        if not squared:
            break
        pairs = _heads(left)
        if 2 * pairs.agg(F.sum("n")).first()[0] > squared:  # reading the sets once more costs more than pairing the rows
            release(pairs)
            break
        deltas = against_heads(docs, pairs, percent, size, levels)
        links = links.unionByName(_linked(deltas))
        labels = components(links)
        fresh = deltas.select(F.col("head").alias("space"), F.posexplode("tokens").alias("at", "token"), "row_key", "n", "d", "rest", "adj")
        further, work = _open(fresh.select(*LIST), labels)
        stored.append(further)
        release(pairs)
        forget_shuffles(spark)
        if work < squared:
            short = short.unionByName(further.where(F.col("times") <= PAIRED).select(*LIST))
            left = further.where(F.col("times") > PAIRED)
        if work > 0.8 * squared:  # differences are no rarer than what they replace
            break
    pairs = _pairs(short.unionByName(left.select(*LIST)), labels, percent)
    links = links.unionByName(_linked(against_heads(docs, pairs, percent, size)))
    labels = components(links)
    release(*stored, pairs)

    labels = labels.withColumnRenamed("row_key", "rep")
    aims = materialize(copies.groupBy("rep").agg(F.count("*").alias("times")).join(labels, "rep", "left").select("rep", "times", F.coalesce("comp", "rep").alias("comp")), "aims")
    of_copies = spread_join(copies, aims, ["rep"], "times", total).select("row_key", "comp")
    labelled = of_copies.unionByName(labels.select(F.col("rep").alias("row_key"), "comp"))
    out = named.join(labelled, "row_key", "left").withColumn("comp", F.coalesce("comp", "row_key"))
    if docs.where("not doc_id <=> row_key").limit(1).count():
        ids = named.select(F.col("row_key").alias("comp"), F.col("doc_id").alias("component_id"))
        out = out.join(ids, "comp")
    else:
        out = out.withColumn("component_id", F.col("comp"))
    return out.select("row_key", "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "comp")


def _linked(made: DataFrame) -> DataFrame:
    return made.where("linked").select(F.col("head").alias("a"), F.col("row_key").alias("b"))


#: Every pair with a common shingle is counted: for small tables.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
link AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach(doc_id, other) AS (SELECT a, a FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, coalesce(min(other), s.doc_id) AS component_id FROM s LEFT JOIN reach USING (doc_id) GROUP BY s.doc_id, s.s
"""
