"""Stop rules over a stream of discoveries: each keyword's counts are kept as state, from batch to batch and over restarts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructType

from buzzmill.operators.freshness import REASONS, Limits, exhausted

STATE = "items long, stale long, run long, reason string"


def followed(rows: DataFrame, key: str, order: str, state: str, limits: Limits) -> DataFrame:
    """A stream's rows of each key up to the first that reaches a limit, with stop_reason there and null before.

    Rows are taken batch by batch, and by `order` within a batch. A stopped key's later rows are passed over; its state is four values.
    """
    columns = rows.columns

    def follow(_, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        items, stale, run, reason = kept.get if kept.exists else (0, 0, 0, None)
        given = [f for f in frames] if reason is None else [f for f in frames if False]
        if not given:
            return
        batch = pd.concat(given).sort_values(order, kind="stable", na_position="first")
        old, fresh = (batch[state] == "stale").to_numpy(), (batch[state] == "fresh").to_numpy()
        count, total = items + np.arange(1, len(batch) + 1), stale + np.cumsum(old)
        base = np.maximum.accumulate(np.where(fresh, total, stale - run))
        values = {"stale_run": np.where(old, total - base, 0), "stale": total, "items": count}
        hits = {n: np.flatnonzero(values[n] >= limit) for n in REASONS if (limit := getattr(limits, n))}
        at = min((int(h[0]) for h in hits.values() if len(h)), default=None)
        if at is not None:
            reason = next(REASONS[n] for n, h in hits.items() if len(h) and h[0] == at)
        last = len(batch) - 1 if at is None else at
        kept.update((int(count[last]), int(total[last]), int(total[last] - base[last]), reason))
        out = batch.iloc[: last + 1][columns].copy()
        out["stop_reason"] = pd.Series([None] * len(out), index=out.index, dtype=object)
        if reason is not None:
            out.iloc[-1, out.columns.get_loc("stop_reason")] = reason
        yield out

    schema = StructType([*rows.schema.fields]).add("stop_reason", StringType())
    return rows.groupBy(key).applyInPandasWithState(follow, schema, STATE, "append", GroupStateTimeout.NoTimeout)


def take(stream: DataFrame, path: str) -> StreamingQuery:
    """Append what has arrived to the table under path; the checkpoint beside it holds the state that the next call goes on from."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/rows")


def taken(spark: SparkSession, path: str, schema: StructType, key: str, order: str) -> DataFrame:
    """Rows taken so far; a key that reached no limit is `exhausted` at its last row."""
    rows = spark.read.schema(StructType([*schema.fields]).add("stop_reason", StringType())).parquet(f"{path}/rows")
    return exhausted(rows, key, order)
