"""Statistics in long form: one row per key, field and dimension; partial results that merge; exact order statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.session import materialize
from kinelake.skew import bounded_broadcast

FINITE = "v is not null and not isnan(v) and abs(v) < double('inf')"


def long_form(df: DataFrame, keys: list[str], fields: tuple[str, ...] = ("action", "state")) -> DataFrame:
    """One row per finite reading: the keys, ``field``, ``dim`` and ``v``. Both fields come from one scan."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("x")) for f in fields])).alias("z")
    x = df.select(*keys, each).select(*keys, "z.field", F.posexplode("z.x").alias("dim", "v"))
    return x.select(*keys, "field", F.col("dim").cast("long").alias("dim"), F.col("v").cast("double").alias("v")).where(FINITE)


def summarize(x: DataFrame, keys: list[str]) -> DataFrame:
    """Count, extremes, mean and population standard deviation; partial aggregates are merged by the shuffle."""
    return x.groupBy(*keys).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def merged(n: str = "n", mean: str = "mean", std: str = "std") -> tuple[Column, Column]:
    """Mean and total standard deviation of several partial results, weighted by their counts."""
    total = F.sum(n)
    m = F.sum(F.col(n) * F.col(mean)) / total
    square = F.sum(F.col(n) * (F.pow(std, 2) + F.pow(mean, 2))) / total
    return m, F.sqrt(F.greatest(square - m * m, F.lit(0.0)))


def value_bin(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises: 32 bins for each power of two, apart by sign."""
    size = F.floor(F.log2(F.abs(v)) * 32).cast("long") + 40_000
    return F.when(v == 0, F.lit(0).cast("long")).otherwise(F.when(v > 0, size).otherwise(-size))


def order_statistics(x: DataFrame, keys: list[str], quantiles: list[tuple[str, float]], weights: list[Column] | None = None) -> DataFrame:
    """The order statistic ``floor(q (n - 1))`` (from 0) of ``v`` by key: exact, and one of the values.

    No task sorts a whole key: values are counted in bins first, and only the bins that hold a wanted rank are counted by
    value and sorted, each by itself. With ``weights`` a row counts as often as each of them says, and names get ``_0``, ``_1``, ...
    """
    many = weights or [F.lit(1)]
    names = [[f"{name}_{i}" if weights else name for name, _ in quantiles] for i in range(len(many))]
    sums = [F.sum(w).cast("long").alias(f"w{i}") for i, w in enumerate(many)]
    b = x.withColumn("__bin", value_bin(F.col("v")))
    w = Window.partitionBy(*keys)
    bins = b.groupBy(*keys, "__bin").agg(*sums)
    for i in range(len(many)):
        bins = bins.withColumn(f"before{i}", F.sum(f"w{i}").over(w.orderBy("__bin")) - F.col(f"w{i}")).withColumn(f"n{i}", F.sum(f"w{i}").over(w))
    rank = {(i, q): F.floor(F.lit(q) * (F.col(f"n{i}") - 1)) for i in range(len(many)) for _, q in quantiles}
    holds = [(F.col(f"before{i}") <= r) & (r < F.col(f"before{i}") + F.col(f"w{i}")) for (i, _), r in rank.items()]
    wanted = bins.where(reduce(lambda p, q: p | q, holds)).drop(*[f"w{i}" for i in range(len(many))])
    wanted = bounded_broadcast(materialize(wanted, "bins"))
    c = b.join(wanted.select(*keys, "__bin"), [*keys, "__bin"]).groupBy(*keys, "__bin", "v").agg(*sums).join(wanted, [*keys, "__bin"])
    inner = Window.partitionBy(*keys, "__bin").orderBy("v")
    for i in range(len(many)):
        c = c.withColumn(f"upto{i}", F.col(f"before{i}") + F.sum(f"w{i}").over(inner))
    take = [F.min(F.when((F.col(f"w{i}") > 0) & (F.col(f"upto{i}") > rank[i, q]), F.col("v"))).alias(names[i][k]) for i in range(len(many)) for k, (_, q) in enumerate(quantiles)]
    return c.groupBy(*keys).agg(*take)


def look_ahead_statistics(df: DataFrame, key: str, field: str, steps: int, quantiles: list[tuple[str, float]]) -> DataFrame:
    """Statistics by key, step and dimension of the chunk of ``steps`` frames ahead of each frame, clamped at the episode's end.

    ``df`` has ``rn`` and ``n`` (see ``ranked``). No chunk is built: a frame is at step s of one anchor if ``rn`` is at least s, the last frame of
    ``min(n, s + 1)`` anchors. Both depend on small numbers only, so frames are counted by them and weighted by step.
    """
    last = F.col("rn") == F.col("n") - 1
    at = F.least(F.when(last, F.col("n")).otherwise(F.col("rn")), F.lit(steps)).cast("long")
    x = df.select(key, last.alias("last"), at.alias("at"), F.posexplode(field).alias("dim", "v"))
    # written once: three passes read it, and none shuffles the frames again
    x = materialize(x.select(key, F.col("dim").cast("int").alias("dim"), "last", F.col("at").cast("int").alias("at"), "v").where(FINITE), "readings")
    x = x.select(key, F.col("dim").cast("long").alias("dim"), "last", F.col("at").cast("long").alias("at"), F.col("v").cast("double").alias("v"))

    def weight(s: Column) -> Column:
        return F.when(F.col("last"), F.least(F.col("at"), s + 1)).otherwise((F.col("at") >= s).cast("long"))

    k = [key, "step", "dim"]
    # moments: a few rows by key, dimension, position and step are merged by weight
    p = summarize(x, [key, "dim", "last", "at"]).withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(steps - 1).cast("long"))))
    p = p.withColumn("w", F.col("n") * weight(F.col("step"))).where("w > 0")
    p = p.withColumn("m", F.sum(F.col("w") * F.col("mean")).over(Window.partitionBy(*k)) / F.sum("w").over(Window.partitionBy(*k)))
    square = F.sum(F.col("w") * (F.pow("std", F.lit(2)) + F.pow(F.col("mean") - F.col("m"), F.lit(2))))
    s = p.groupBy(*k).agg(F.sum("w").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("m").alias("mean"), F.when(F.sum("w") > 1, F.sqrt(square / (F.sum("w") - 1))).alias("std"))
    c = order_statistics(x, [key, "dim"], quantiles, [weight(F.lit(i)) for i in range(steps)])
    rows = [F.struct(F.lit(i).cast("long").alias("step"), *[F.col(f"{name}_{i}").alias(name) for name, _ in quantiles]) for i in range(steps)]
    q = c.select(key, "dim", F.explode(F.array(*rows)).alias("z")).select(key, "dim", "z.*")
    return s.join(q, k)
