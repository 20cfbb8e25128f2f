"""Components, neighbours in order and skew-safe joins against plain versions."""

import random

from pyspark.sql import functions as F

from kinelake.components import connected_components, star_edges
from kinelake.ordering import previous_in_group
from kinelake.skew import hot_split_join


def plain(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {(x, root(x)) for x in up if root(x) != x}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    assert {tuple(r) for r in connected_components(df).select("u", "v").collect()} == plain(edges)
    assert connected_components(df.limit(0)).count() == 0


def test_star_of_a_hot_key(spark):
    df = spark.range(3000).select(F.lit("k").alias("key"), F.col("id").alias("node")).unionByName(spark.createDataFrame([("z", 5)], "key string, node long"))
    assert star_edges(df).agg(F.count(F.lit(1)), F.max("v")).first() == (2999, 0)


def test_previous(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(50)]), i) for i in range(300)]
    got = {r["i"]: r["previous"] for r in previous_in_group(spark.createDataFrame(rows, "g string, t long, i long"), "g", ["t", "i"], "i").collect()}
    assert len(got) == 300
    for g in ("a", "b"):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in own] == [None, *[r[2] for r in own[:-1]]]
    assert all(got[r[2]] is None for r in rows if r[0] is None)


def test_hot_split_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 600, 1).when(F.col("id") < 990, F.col("id")).alias("k"), F.col("id").alias("x"))
    right = spark.range(995).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("y"))
    for how in ("inner", "left"):
        a = hot_split_join(left, right, "k", how, least=50).collect()
        b = left.join(right, "k", how).collect()
        assert sorted(map(str, a)) == sorted(map(str, b))
