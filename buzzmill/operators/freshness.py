"""Freshness of discovered items: staleness, newest ranks, and the cut after a run of stale items."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.times import content_time
from buzzmill.operators.ranks import first_of_keys, placed, running


def state(at: Column, now: str, days: int = 14) -> Column:
    """fresh, stale, or unknown without a time."""
    horizon = F.lit(now).cast("timestamp") - F.expr(f"interval {int(days)} days")
    return F.when(at.isNull(), "unknown").when(at.cast("timestamp") < horizon, "stale").otherwise("fresh")


def newest(rows: DataFrame, key: str, at: str, tie: str, n: int) -> DataFrame:
    """newest_rank within key, unknown times last, and in_final for the first n; a key may hold any share of the rows."""
    return first_of_keys(rows, [key], [F.col(at).desc_nulls_last(), tie], "newest_rank").withColumn("in_final", F.col("newest_rank") <= n)


# Fields of a record that may hold its time, in the order in which they count.
TIME_FIELDS = ("created_time", "created_at", "published_at", "upload_date", "taken_at_timestamp", "timestamp", "content_timestamp")


def record_time(rows: DataFrame, fields: Sequence[str] = TIME_FIELDS) -> Column:
    """The first readable time of a record, of the fields that it has: seconds, milliseconds or ISO text; null if none."""
    return F.coalesce(*[content_time(F.col(f).cast("string")) for f in fields if f in rows.columns], F.lit(None).cast("timestamp"))


def select_newest(rows: DataFrame, n: int, tie: str, fields: Sequence[str] = TIME_FIELDS) -> DataFrame:
    """The n records of the latest times, those without one last, ties by `tie`; none for n of 0 or less."""
    return rows.orderBy(record_time(rows, fields).desc_nulls_last(), tie).limit(max(n, 0))


@dataclass(frozen=True)
class Limits:
    """When a keyword is left: after so many stale items in a row, so many stale ones, or so many items; 0 is no limit."""

    stale_run: int = 12
    stale: int = 25
    items: int = 300


#: Of several limits reached by one item, the first names the reason.
REASONS = {"stale_run": "freshness_boundary", "stale": "stale_limit", "items": "max_items"}
NEVER_STOPPED = "exhausted"


def reached(limits: Limits, run: Column, stale: Column, items: Column) -> Column:
    """The reason to stop at an item, or null."""
    out = F.lit(None).cast("string")
    for (name, reason), value in reversed(list(zip(REASONS.items(), (run, stale, items), strict=True))):
        if limit := getattr(limits, name):
            out = F.when(value >= limit, reason).otherwise(out)
    return out


def stopped_rows(rows: DataFrame, key: str, order: str, state: str, limits: Limits) -> DataFrame:
    """Rows of each key up to the first that reaches a limit, with stop_reason on that row, or `exhausted` on the last row of a key that reaches none.

    Unknown items neither count as stale nor end a run of stale ones; fresh ones end it. Rows of a null key are a key of their
    own; rows without an order come first. A key's rows are spread over ranges, so one keyword may hold most of the table.
    """
    is_stale, is_fresh = F.coalesce(F.col(state) == "stale", F.lit(False)), F.coalesce(F.col(state) == "fresh", F.lit(False))
    counted = running(placed(rows, [key], [order]), [key], add={"_items": F.lit(1), "_stale": is_stale})
    counted = running(counted, [key], most={"_base": F.when(is_fresh, F.col("_stale"))})
    reason = reached(limits, F.when(is_stale, F.col("_stale") - F.coalesce("_base", F.lit(0))).otherwise(0), F.col("_stale"), F.col("_items"))
    counted = running(counted.withColumn("stop_reason", reason), [key], add={"_stops": F.col("stop_reason").isNotNull()})
    kept = counted.where((F.col("_stops") == 0) | ((F.col("_stops") == 1) & F.col("stop_reason").isNotNull()))
    return exhausted(kept.drop("_items", "_stale", "_base", "_stops", "_part"), key, "_place").drop("_place")


def exhausted(kept: DataFrame, key: str, order: str) -> DataFrame:
    """kept with the reason `exhausted` on the last row of each key that has no other."""
    last = kept.groupBy(F.col(key).alias("_key")).agg(F.max(order).alias("_last"), F.max("stop_reason").alias("_reason")).where("_reason is null").select(F.col("_last"), F.struct("_key").alias("_own"))
    found = kept.join(last, (F.col("_last") == F.col(order)) & F.struct(F.col(key).alias("_key")).eqNullSafe(F.col("_own")), "left")
    return found.withColumn("stop_reason", F.when(F.col("_last").isNotNull(), NEVER_STOPPED).otherwise(F.col("stop_reason"))).drop("_last", "_own")


def cut_after_stale(rows: DataFrame, key: str, order: str, state_col: str, n: int) -> DataFrame:
    """Rows of each key up to the n-th stale one in a row; unknown neither counts nor resets, fresh resets."""
    return stopped_rows(rows, key, order, state_col, Limits(n, 0, 0)).drop("stop_reason")
