"""Sliding-window quotas on a stream (STR-9): a hit is let through while every window has room, and only such hits count.

A count over a range of rows can't say this, for what was refused doesn't count; a key's admitted times are its state. Hits of a
key are taken in the order of time and id in each batch; a key without hits for the longest window is forgotten by a timer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: (limit, seconds) of the hits of one key. (Fixed values.)
QUOTAS = ((5, 60), (60, 3600))


def admitted(times: list[int], now: int, quotas: tuple[tuple[int, int], ...]) -> tuple[list[int], int | None]:
    """(the times that still count with this hit if it is let through, microseconds to wait or None)."""
    longest = max(s for _, s in quotas) * 1_000_000
    kept, wait = [t for t in times if now - t < longest], None
    for limit, seconds in quotas:
        inside = [t for t in kept if now - t < seconds * 1_000_000]
        if len(inside) >= limit:
            left = seconds * 1_000_000 - (now - inside[len(inside) - limit])
            wait = left if wait is None else max(wait, left)
    return (kept if wait is not None else [*kept, now]), wait


def quota_stream(hits: DataFrame, quotas: tuple[tuple[int, int], ...] = QUOTAS, lateness: str = "0 seconds") -> DataFrame:
    """(key, id, time, let_through, wait_us) of a stream of hits (key string, id long, time timestamp)."""
    longest = max(s for _, s in quotas)

    def judge(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["us", "id"], kind="stable")
        times = list(state.get[0]) if state.exists else []
        waits = []
        for now in rows["us"]:
            times, wait = admitted(times, int(now), quotas)
            waits.append(wait)
        state.update((times,))
        state.setTimeoutTimestamp(max(int(rows["us"].max()) // 1000 + longest * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": key[0], "id": rows["id"].to_numpy(), "time": rows["time"].to_numpy(), "let_through": [w is None for w in waits], "wait_us": pd.array(waits, dtype="Int64")})

    keyed = hits.withWatermark("time", lateness).withColumn("us", F.unix_micros("time"))
    return keyed.groupBy("key").applyInPandasWithState(judge, "key string, id long, time timestamp, let_through boolean, wait_us long", "times array<long>", "append", GroupStateTimeout.EventTimeTimeout)
