"""What the operators of this subpackage share: scratch tables, row keys and bytes of Arrow text columns."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract here: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text that the numpy kernels take at once.
CHUNK_BYTES = 1 << 20
#: Most bits of a broadcast filter of keys: 4 MB of words.
FILTER_BITS = 24
_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir; a local one only where that is unset and Spark runs in one process."""
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return shared
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-buzzmill-")
    return _own[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{scratch_dir(spark).rstrip('/')}/buzzmill/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: computed once, lineage cut, safe when executors go."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def release(*stored: DataFrame) -> None:
    """Delete tables of materialize that nothing reads any more."""
    for df in stored:
        if name := getattr(df, "table_name", None):
            df.sparkSession.sql(f"DROP TABLE {name}")
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Spark drops the shuffle files of finished jobs when the driver collects garbage; ask for it between long steps."""
    spark.sparkContext._jvm.System.gc()


def only_keys(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key (a long) is among those of rows, and a few others, to spare a shuffle; df itself where that would not pay.

    A bit set with eight bits a key is broadcast as a table of words: at most 2**FILTER_BITS bits, 4 MB, which its size
    proves. Beyond 2**FILTER_BITS / 8 keys nothing is filtered here; the join that follows decides alone in any case.
    """
    size = max(12, (8 * rows.count()).bit_length())
    if size > FILTER_BITS:
        return df
    bit = lambda: F.pmod(F.xxhash64(key), F.lit(1 << size))
    words = rows.select(bit().alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit & 63 AS int))")).alias("_bits"))
    marked = df.withColumn("_bit", bit()).join(F.broadcast(words), F.shiftright("_bit", 6) == F.col("_word"))
    return marked.where("shiftright(_bits, cast(_bit & 63 AS int)) & 1 = 1").drop("_bit", "_word", "_bits")


def spread_join(rows: DataFrame, table: DataFrame, on: list[str], times: str, total: int) -> DataFrame:
    """rows joined with table, whose keys are unique and whose column `times` counts the rows of each key.

    Keys with more than one of 10,000 of all rows (and 1,000 at least) are at most 10,000: their part of table is
    broadcast, so that no task gets all rows of such a key. The other keys are joined as Spark sees fit.
    """
    much = F.col(times) > max(1000, total // 10_000)
    hot = table.where(much)
    if not hot.limit(1).count():
        return rows.join(table, on)
    apart = rows.join(F.broadcast(hot), on)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(table.where(~much), on)
    return apart.unionByName(rest)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Jobs run inside have these settings, named with two underscores for dots."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def batch_rows(spark: SparkSession, rows: int):
    """Jobs run inside send `rows` rows at a time to Python: for rows that are large each."""
    return settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(rows))


def decoded_rows(spark: SparkSession, rows: int):
    """Jobs run inside decode `rows` rows of a Parquet file at a time: for rows that are large each, of which Spark else holds 4,096 in every task."""
    return settings(spark, spark__sql__parquet__columnarReaderBatchSize=str(rows))


def materialize_buckets(df: DataFrame, label: str, buckets: int, key: str, order: list[str]) -> DataFrame:
    """As materialize, but a table of one file a bucket of the key's hash, each in order, which later plans need not shuffle by the key.

    df has a task for each bucket, in the order of the buckets' numbers.
    """
    spark, path, name = df.sparkSession, scratch_path(df.sparkSession, label), f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).sortBy(*order).saveAsTable(name)
    stored = spark.table(name)
    stored.scratch_path, stored.table_name = path, name
    return stored


def keyed(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Columns row_key, doc_id and text, where row_key is unique, never null and ascends with doc_id; all columns if whole.

    Where ids are unique and not null the id itself is the key. Otherwise rows are ordered by id (null last), then
    by the text's hash, and numbered once in a stored table; equal rows get keys in any order, which changes no result.
    A row_key among the columns of docs is replaced.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    n, full, distinct = docs.agg(F.count("*"), F.count("doc_id"), F.countDistinct("doc_id")).first()
    rest = [c for c in docs.columns if c not in ("row_key", "doc_id", "text")] if whole else []
    if n == full == distinct:
        return docs.select(doc_id.alias("row_key"), doc_id.alias("doc_id"), text, *rest)
    ordered = docs.orderBy(doc_id.asc_nulls_last(), F.xxhash64("text"))
    return materialize(ordered.select(F.monotonically_increasing_id().alias("row_key"), doc_id.alias("doc_id"), text, *rest), "keyed")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row in them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES):
    """Yield (first row, end row, bytes, offsets from 0) for runs of whole rows of about most bytes; a longer row is alone."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    at, n = 0, len(column)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def rolling(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every run of `length` values, built from runs of doubling length."""
    base_m, step, part = int(base), 1, values.astype(np.uint64)
    whole, have = None, 0
    while True:
        if length & step:
            if whole is None:
                whole, have = part, step
            else:
                n = len(values) - have - step + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                whole = part[:n] * np.uint64(pow(int(base), have, 1 << 64)) + whole[step : step + n]
                have += step
        if 2 * step > length:
            return whole
        if len(part) <= step:
            return np.zeros(0, np.uint64)
        part = part[:-step] * np.uint64(base_m) + part[step:]
        base_m, step = base_m * base_m % (1 << 64), 2 * step


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` consecutive keys."""
    step, out = 1, keys
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


#: Odd bases of the rolling hashes.
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def words_of(data: np.ndarray, offsets: np.ndarray, base: int = BASE_A) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of the rows, and the number of words before each row."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = ends - starts
    powers = np.full(int(lengths.max()), np.uint64(base), np.uint64).cumprod()
    in_words = np.flatnonzero(inside)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    at = np.arange(len(in_words)) - np.repeat(first, lengths)
    hashes = np.add.reduceat((data[in_words].astype(np.uint64) + np.uint64(1)) * powers[at], first)
    return starts, ends, mix(hashes), np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then those of the next start."""
    counts = np.asarray(counts, np.int64)
    if not counts.sum():
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(np.asarray(starts, np.int64) - before, counts)
