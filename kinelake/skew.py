"""Joins that hold up when one key has a third of all rows, and broadcasts behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast after it was counted.
BROADCAST_ROWS = 500_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count finds at most ``max_rows`` rows, else as it is (a shuffled join follows)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hot_split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = 1e-3, least: int = 20_000) -> DataFrame:
    """Join ``left`` (many rows per key) with ``right`` (one row per key) on ``key``.

    A key is hot if it has more than ``max(least, share * rows)`` rows of ``left``; by that there are at most
    ``1 / share`` hot keys, whatever the size of the data, so their rows of ``right`` are broadcast and the hot
    rows never meet in one task. All other keys go through an ordinary shuffled join.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = left.count()
    limit = max(least, int(total * share))
    if total <= limit:
        return left.join(right, key, how)
    hot = [r[0] for r in counts.where(F.col("__n") > limit).select(key).collect()]  # at most total / limit keys
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    a = left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how)
    b = left.where(~is_hot).join(right.where(~is_hot), key, how)
    return a.unionByName(b)
