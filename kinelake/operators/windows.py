"""Windows inside episodes: positions, clamped chunks, shifts and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_episode(order: str = "frame_index", part: str = "episode_index") -> Window:
    return Window.partitionBy(part).orderBy(order)


def ranked(df: DataFrame, part: str = "episode_index", order: str = "frame_index") -> DataFrame:
    """Adds ``rn`` (position in the episode from 0) and ``n`` (its length)."""
    return df.withColumn("rn", F.row_number().over(in_episode(order, part)) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(part)))


def clamped_chunk(df: DataFrame, fields: list[str], before: int, after: int, part: str = "episode_index", order: str = "frame_index") -> DataFrame:
    """Adds ``chunk``: for each offset from -before to after a struct of the fields at that row of the same episode, and ``is_pad``.

    Outside of the episode its first or last row stands in, marked by ``is_pad``. Structs are collected, since bare nulls
    would be dropped. ``df`` has ``rn`` and ``n`` (see ``ranked``).
    """
    w = in_episode(order, part).rowsBetween(-before, after)
    near = F.collect_list(F.struct(*fields)).over(w)
    x = df.withColumn("__near", near)

    def at(d: Column) -> Column:
        i = F.least(F.greatest(d + F.least(F.lit(before), F.col("rn")), F.lit(0)), F.size("__near") - 1)
        s = F.get(F.col("__near"), i.cast("int"))
        outside = (F.col("rn") + d < 0) | (F.col("rn") + d >= F.col("n"))
        return F.struct(d.alias("step"), *[s[f].alias(f) for f in fields], outside.alias("is_pad"))

    return x.withColumn("chunk", F.transform(F.sequence(F.lit(-before), F.lit(after)), at)).drop("__near")


def clamped_shift(c: str, offset: int, order: str = "frame_index", part: str = "episode_index") -> Column:
    """The value ``offset`` rows later (earlier if negative), the episode's last (first) beyond its end; nulls are values."""
    w = in_episode(order, part)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if offset >= 0:
        return F.when(F.col("rn") + offset < F.col("n"), F.lead(c, offset).over(w)).otherwise(F.last(c).over(whole))
    return F.when(F.col("rn") + offset >= 0, F.lag(c, -offset).over(w)).otherwise(F.first(c).over(whole))
