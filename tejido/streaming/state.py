"""State of each key with timers, kept by Spark's state store: request spacing of hosts, and keys that are new again after a time.

Keys are dealt to parts, whose keys and times are one value. A timer takes keys away when their horizon has passed by the watermark, so the store holds keys
of the horizon only. Within a micro-batch a part's rows are put in the order of their keys and times; the batch's size (maxFilesPerTrigger, maxBytesPerTrigger)
bounds them.
A lost run goes on from the checkpoint, with its state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: The state store that large states need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: Parts that keys are dealt to by their hash; a part's keys are one value of the state store, so a key costs no calls of its own.
PARTS = 4096


def last_seen(horizon_us: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """For each row of a part's keys, in the order of a key's times (then ids): the microseconds since the key's row before, of this batch or of earlier ones;
    null for the first row, and for the first one after the horizon. Rows: (key, id, at); at is in microseconds."""

    def put(state: GroupState, held: dict[str, int]) -> None:
        """Keeps keys whose horizon hasn't passed, and sets the timer for the first that will."""
        ends = {k: (at + horizon_us) // 1000 + 1 for k, at in held.items()}
        left = [k for k, end in ends.items() if end > state.getCurrentWatermarkMs()]
        if left:
            state.update((left, [held[k] for k in left]))
            state.setTimeoutTimestamp(min(ends[k] for k in left))
        elif state.exists:
            state.remove()

    def run(part: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        if state.hasTimedOut:
            put(state, held)
            return
        batch = pd.concat([r[["key", "at", "id"]] for r in rows]).sort_values(["key", "at", "id"], kind="stable")
        key, at = batch["key"].to_numpy(), batch["at"].to_numpy()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        last = np.append(first[1:], len(key)) - 1
        known = [held.get(k) for k in key[first]]
        gap = np.diff(at, prepend=at[0])
        gap[first] = [0 if k is None else t - k for t, k in zip(at[first].tolist(), known, strict=True)]
        none = gap > horizon_us
        none[first] |= np.array([k is None for k in known])
        held.update({name: max(t, held.get(name, t)) for name, t in zip(key[last], at[last].tolist(), strict=True)})
        put(state, held)
        yield pd.DataFrame({"id": batch["id"].to_numpy(), "gap": pd.arrays.IntegerArray(gap, none)})

    return run


def gaps(stream: DataFrame, keys: list[str], row_id: str, stamp: str, horizon: str, late: str = "0 seconds") -> DataFrame:
    """id and gap (microseconds) of a stream's rows: the time since the row before of the same keys; null without one within the horizon. Null keys are
    keys. Rows that come later than the watermark allows (`late`) are dropped, as Spark does."""
    spark = stream.sparkSession
    spark.conf.set(*STORE)
    us = spark.range(1).select(F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {horizon})").alias("us")).first().us
    named = F.struct(*[F.col(k).alias(f"key{n}") for n, k in enumerate(keys)])
    rows = stream.select(F.to_json(named).alias("key"), F.pmod(F.xxhash64(*keys), F.lit(PARTS)).alias("part"), F.col(stamp).alias("stamp"), F.col(row_id).cast("long").alias("id"), F.unix_micros(stamp).alias("at"))
    known = "keys array<string>, last array<bigint>"
    return rows.withWatermark("stamp", late).groupBy("part").applyInPandasWithState(last_seen(us), "id bigint, gap bigint", known, "append", GroupStateTimeout.EventTimeTimeout)


def waits(stream: DataFrame, host: str, row_id: str, stamp: str, seconds: float) -> DataFrame:
    """id and wait: for how many seconds each request of a host must wait, so that `seconds` have passed since the one before it."""
    gap = gaps(stream, [host], row_id, stamp, f"{seconds} SECOND")
    return gap.select("id", F.greatest(F.lit(0.0), F.round(F.lit(float(seconds)) - F.coalesce(F.col("gap") / 1e6, F.lit(float(seconds))), 3)).alias("wait"))


def new_again(stream: DataFrame, keys: list[str], row_id: str, stamp: str, horizon: str) -> DataFrame:
    """ids of rows whose keys have not come within the horizon before."""
    return gaps(stream, keys, row_id, stamp, horizon).filter("gap is null").select("id")
