"""Ranks and run lengths over whole tables, or over groups that no task could hold: sorted ranges with carried totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buzzmill.sources.scratch import stored

#: monotonically_increasing_id keeps the partition above these bits, and the place in it below.
PLACE_BITS = 33


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """rows with a long that counts them from 1 in the given order.

    Rows are sorted by ranges of the order, so one key's rows may lie in many tasks; each range starts where the sizes of the
    ranges before it end. The sizes are one row a range. The sorted rows are stored once, so a number stays what it was. Rows
    that the order doesn't tell apart are numbered in any order.
    """
    placed = stored(rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    found = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return found.withColumn(name, F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1).drop("_part", "_place", "_before")


def placed(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """rows sorted by keys and order over ranges and stored, with _part and _place: a key's rows may lie in several ranges."""
    found = stored(rows.orderBy(*keys, *order).withColumn("_place", F.monotonically_increasing_id()), "placed")
    return found.withColumn("_part", F.shiftright("_place", PLACE_BITS))


def running(rows: DataFrame, keys: Sequence[str], add: dict[str, Column] | None = None, most: dict[str, Column] | None = None) -> DataFrame:
    """rows of placed with running sums (add) and running maxima (most) of longs over each key's rows up to each row.

    A range works out its own rows; then it takes over what the ranges before it hold of a key. Only the first key of a range
    can have begun before it, so that is one row a range at most, and broadcast.
    """
    exprs = {**(add or {}), **(most or {})}
    whole = {n: F.sum if n in (add or {}) else F.max for n in exprs}
    both = {n: (lambda a, b: a + b) if n in (add or {}) else F.greatest for n in exprs}
    rows = rows.withColumns({f"_of_{n}": c.cast("long") for n, c in exprs.items()})
    own = Window.partitionBy("_part", *keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("_part", *keys).agg(*[whole[n](f"_of_{n}").alias(f"_of_{n}") for n in exprs])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumns({f"_to_{n}": whole[n](f"_of_{n}").over(earlier) for n in exprs} | {"_before": F.count("*").over(earlier)})
    carried = carried.where("_before > 0").select("_part", F.struct(*keys).alias("_key"), *[f"_to_{n}" for n in exprs])
    rows = rows.withColumns({n: whole[n](f"_of_{n}").over(own) for n in exprs}).drop(*[f"_of_{n}" for n in exprs])
    rows = rows.join(F.broadcast(carried), "_part", "left")
    mine = F.struct(*keys).eqNullSafe(F.col("_key"))
    rows = rows.withColumns({n: F.when(mine & F.col(f"_to_{n}").isNotNull(), F.coalesce(both[n](F.col(n), F.col(f"_to_{n}")), f"_to_{n}")).otherwise(F.col(n)) for n in exprs})
    return rows.drop("_key", *[f"_to_{n}" for n in exprs])


def first_of_keys(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """rows numbered from 1 within their keys in the given order, however many rows a key has."""
    return running(placed(rows, keys, order), keys, add={name: F.lit(1)}).drop("_part", "_place")
