"""Structured Streaming forms of batching, chunk serving, overlapping forecasts and nearest-message sync.

Each has a batch query with the same result (``r1`` to ``r4``, ``j7``); the stream keeps its state per key, so a lost executor
costs a replay from the checkpoint and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BATCH = "key long, batch long, n long, first_event long"


def count_or_timeout_batches(stream: DataFrame, size: int = 5, wait_ms: int = 1000) -> DataFrame:
    """Requests (``key``, ``event``, ``us``) in batches per key: full ones at once, an incomplete one ``wait_ms`` after its last request.

    The state of a key is what waits: at most ``size - 1`` requests and the number of its next batch.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, waiting = state.get if state.exists else (0, [])
        waiting = list(waiting)
        out = []
        if state.hasTimedOut:
            if waiting:
                out.append((key[0], number, len(waiting), min(waiting)))
                number, waiting = number + 1, []
            state.update((number, waiting))
        else:
            new = pd.concat(list(frames)).sort_values(["us", "event"])
            waiting += [int(x) for x in new["event"]]
            while len(waiting) >= size:
                out.append((key[0], number, size, min(waiting[:size])))
                number, waiting = number + 1, waiting[size:]
            state.update((number, waiting))
            if waiting:
                state.setTimeoutDuration(wait_ms)
        yield pd.DataFrame(out, columns=["key", "batch", "n", "first_event"])

    return stream.groupBy("key").applyInPandasWithState(run, BATCH, "number long, waiting array<long>", "append", GroupStateTimeout.ProcessingTimeTimeout)


def temporal_ensemble(stream: DataFrame, horizon: int = 8) -> DataFrame:
    """Mean of all predictions for the same step from overlapping chunks: (``key``, ``start``, ``chunk`` array) to (``key``, ``step``, ``votes``, ``mean``)."""
    x = stream.select("key", "start", F.posexplode(F.slice("chunk", 1, horizon)).alias("i", "v"))
    return x.groupBy("key", (F.col("start") + F.col("i")).alias("step")).agg(F.count(F.lit(1)).alias("votes"), F.avg("v").alias("mean"))


def windowed_counts(stream: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per type and window of event time; later rows than the watermark are left out. ``ts`` without a zone is taken as UTC."""
    x = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return x.groupBy(F.window("ts", length), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def nearest_in_streams(left: DataFrame, right: DataFrame, within: str = "1 day") -> DataFrame:
    """Pairs of messages of one key within a time of each other, as an interval join of two streams with watermarks; ``nearest_of`` picks the nearest.

    ``left`` and ``right``: ``key``, ``event``, ``ts`` (timestamp).
    """
    a = left.select(F.col("key").alias("lk"), F.col("event").alias("le"), F.col("ts").alias("lt")).withWatermark("lt", within)
    b = right.select(F.col("key").alias("rk"), F.col("event").alias("re"), F.col("ts").alias("rt")).withWatermark("rt", within)
    return a.join(b, F.expr(f"lk = rk and rt between lt - interval {within} and lt + interval {within}"))


def nearest_of(pairs: DataFrame) -> DataFrame:
    """Of each left message the nearest right one; the later one wins a tie."""
    dist = F.abs(F.unix_micros("lt") - F.unix_micros("rt"))
    return pairs.groupBy("le").agg(F.min_by("re", F.struct(dist, -F.unix_micros("rt"), "re")).alias("re"))
