"""Changes to tables as functions of old and new rows: upserts, scoped prunes, links, dedupe and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of links that one task sorts and compares.
TASK_ROWS = 500_000


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], seq: str, latest: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Rows by key after applying `new` in the order of seq.

    latest: the last value, null or not. keep: the first non-null value, old before new. Others: the last non-null one.
    One shuffle of both tables; a key's rows are combined before it.
    """
    value = [c for c in old.columns if c not in keys and c != seq]
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True).withColumn("_at", F.struct("_new", seq))
    pick = {**{c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))) for c in value}, **{c: F.max_by(c, "_at") for c in latest}, **{c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))) for c in keep}}
    return rows.groupBy(*keys).agg(*[pick[c].alias(c) for c in value])


def prune_and_upsert(old: DataFrame, fresh: DataFrame, keys: Sequence[str], in_scope: Column) -> DataFrame:
    """old outside the scope, fresh inside: keys in scope that fresh lacks go; applying it twice changes nothing."""
    return old.where(~F.coalesce(in_scope, F.lit(False))).unionByName(fresh.where(in_scope))


def _dealt(key: str, *tables: DataFrame) -> list[DataFrame]:
    """Tables dealt by key to as many tasks as keep TASK_ROWS rows each; Spark by itself fills tasks by bytes, many millions of short rows."""
    tasks = max(tables[0].sparkSession.sparkContext.defaultParallelism, *[-(-t.count() // TASK_ROWS) for t in tables])
    return [t.repartition(tasks, key) for t in tables]


def replace_links(old: DataFrame, new: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """Links of touched keys are those of new; others stay. Both sides have different keys, so each drops its own repeated links."""
    old, new, touched = _dealt(key, old, new, touched.select(key))
    return old.join(touched, key, "left_anti").distinct().unionByName(new.join(touched, key, "left_semi").distinct())


def first_rows(rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first n rows of each key."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def latest_rows(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key by seq, without a window: combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("r")).select(key, "r.*")


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), list(keys), "left_anti")


def ordered_values(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Distinct values of each key in order of first appearance."""
    pairs = rows.groupBy(key, value).agg(F.min(order).alias("_at"))
    return pairs.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", value))), lambda x: x[value]).alias(f"{value}s"))


def content_key(*parts: Column, text: Column, n: int = 160) -> Column:
    return F.md5(F.concat_ws("|", *parts, F.substring(text, 1, n)))


def merge_twins(old: DataFrame, new: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """One row for each key, nulls alike: a new twin of an old row hands it its id. merged: new rows that went in."""
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return rows.groupBy(*keys).agg(F.max_by(id_col, F.struct("_new", id_col)).alias(id_col), F.count_if(F.col("_new") == 1).alias("merged"))


def replace_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new, and rows of old whose keys new does not have."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def keep_active(rows: DataFrame, guarded: DataFrame, key: str, flag: str = "is_active") -> DataFrame:
    """Guarded keys cannot be switched off."""
    guard = guarded.select(key).distinct().withColumn("_kept", F.lit(True))
    return rows.join(guard, key, "left").withColumn(flag, F.coalesce("_kept", flag)).drop("_kept")


def mirror(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """target with the column of source where that has a value; changed tells where it differs."""
    rows = target.join(source.select(key, F.col(column).alias("_to")), key, "left")
    changed = F.col("_to").isNotNull() & ~F.col("_to").eqNullSafe(F.col(column))
    return rows.withColumn("changed", changed).withColumn(column, F.coalesce("_to", column)).drop("_to")


def merge_first(primary: Column, secondary: Column, field: str) -> Column:
    """Array of structs: primary, then secondary, each value of the field once."""
    both = F.concat(primary, secondary)
    known = F.transform(both, lambda x: x[field])
    return F.filter(both, lambda x, i: F.array_position(known, x[field]) == i + 1)


def merge_first_rows(rows: DataFrame, key: str, field: str, order: Sequence[str]) -> DataFrame:
    """merge_first where items are rows: by key, array `items` in order, of each value of the field the first."""
    item = F.when(F.forall(F.array(*order), lambda x: x.isNotNull()), F.struct(*order))
    first = rows.groupBy(key, field).agg(F.min(item).alias("item"))
    return first.groupBy(key).agg(F.array_sort(F.collect_list("item")).alias("items"))


def change_counts(rows: DataFrame, by: str, before: str, after: str) -> DataFrame:
    """By group: values that became another, and values that went."""
    differs = ~F.col(before).eqNullSafe(F.col(after))
    return rows.groupBy(by).agg(F.count_if(differs & F.col(after).isNotNull()).alias("updated"), F.count_if(differs & F.col(after).isNull()).alias("cleared"))
