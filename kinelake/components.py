"""Connected components of very large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.session import materialize
from kinelake.skew import hot_split_join


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def star_edges(members: DataFrame) -> DataFrame:
    """Edges (u > v) that link all members of a key: each to the smallest. ``members`` has ``key`` and ``node``.

    A key with a third of all rows becomes a star, never all pairs; its smallest member is found with partial
    aggregates, and its members are not brought together in one task.
    """
    first = members.groupBy("key").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    linked = hot_split_join(members, first, "key")
    return linked.where("node > v").select(F.col("node").alias("u"), "v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """The smallest node ``v`` of the component of every node ``u`` that is not smallest itself.

    Alternates large-star and small-star steps (every larger neighbour, then every smaller one, is linked to the
    smallest in sight) until nothing changes; each round is written to the shared folder. Number of rounds: about the
    logarithm of the longest path. Self-loops, repeated edges and nulls are left out; no edges give no rows.
    """
    e = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "edges")
    seen = _digest(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = hot_split_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = hot_split_join(large, least, "u")
        e = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("z")).select("z.u", "z.v").where("u <> v").distinct()
        e = materialize(e, "edges")
        now = _digest(e)
        if now == seen:
            return e
        seen = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
