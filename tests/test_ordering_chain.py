"""Numbering without a task per group, order statistics by bins, chains and templates, against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.functions import templates as M
from kinelake.functions.chain import Chain, Named, Step, each, transforms
from kinelake.operators.statistics import order_statistics, value_bin
from kinelake.ordering import position_in_group, spread, with_previous


def test_position_in_group(spark):
    rows = [("hot" if i % 3 else None if i % 2 else "cold", (i * 7919) % 1009, f"v{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, o long, v string")
    got = position_in_group(df, ["g"], ["o"], "k").collect()
    assert len(got) == 1000
    for g in ("hot", "cold", None):
        own = sorted(r["o"] for r in got if r["g"] == g)
        assert {r["o"]: r["k"] for r in got if r["g"] == g} == {o: i for i, o in enumerate(own)}
    assert sorted(r["k"] for r in position_in_group(df, [], ["o"], "k").collect()) == list(range(1000))
    assert position_in_group(df.limit(0), ["g"], ["o"], "k").count() == 0


def test_with_previous(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "x"), (None, 5, "q"), (None, 4, None), ("a", 2, "y")], "g string, o long, v string")
    assert {(r["g"], r["o"]): r["previous"] for r in with_previous(df, "g", "o", "v").collect()} == {("a", 1): None, ("a", 2): "x", ("a", 3): "y", (None, 4): None, (None, 5): None}


def test_spread(spark):
    df = spark.createDataFrame([("a", 5), ("b", 0), ("c", 1), ("d", None)], "g string, n long")
    got = sorted((r["g"], r["i"]) for r in spread(df, "n", "i", piece=2).collect())
    assert got == [("a", i) for i in range(5)] + [("c", 0)]


def test_order_statistics(spark):
    rng = np.random.default_rng(1)
    v = [float(x) for x in (*rng.normal(0, 1, 300), *rng.normal(0, 1e9, 50), *[0.0] * 40, -1e-300, 5e-324, 1e300)]
    df = spark.createDataFrame([("k", x, i % 3) for i, x in enumerate(v)] + [("one", 2.5, 1)], "k string, v double, w long")
    quantiles = [("a", 0.0), ("b", 0.01), ("c", 0.5), ("d", 0.999), ("e", 1.0)]
    got = {r["k"]: r for r in order_statistics(df, ["k"], quantiles).collect()}
    for name, q in quantiles:
        assert got["k"][name] == sorted(v)[math.floor(q * (len(v) - 1))] and got["one"][name] == 2.5
    weighted = sorted(x for i, x in enumerate(v) for _ in range(i % 3))
    r = {x["k"]: x for x in order_statistics(df, ["k"], quantiles, [F.col("w"), F.lit(1)]).collect()}["k"]
    for name, q in quantiles:
        assert r[f"{name}_0"] == weighted[math.floor(q * (len(weighted) - 1))] and r[f"{name}_1"] == sorted(v)[math.floor(q * (len(v) - 1))]
    bins = [x[0] for x in df.where("k = 'k'").orderBy("v").select(value_bin(F.col("v"))).collect()]
    assert bins == sorted(bins)


def test_chain(spark):
    df = spark.createDataFrame([([1.0, -2.0, 1e6], [0.5, 0.25, -3.0])], "a array<double>, s array<double>")
    c = Chain([transforms.build({"name": "relative"})(F.col("s")), transforms.build({"name": "arcsinh", "gain": 2.0})(), transforms.build({"name": "scale", "factor": 3.0})()])
    back, narrow = df.select(c.backward(c.forward(F.col("a"))), c.checked(F.col("a"), F.lit(2))).first()
    assert np.allclose(back, [1.0, -2.0, 1e6], rtol=1e-12) and narrow is None
    with pytest.raises(ValueError):
        Chain([Step("half", each(lambda x: x / 2))]).backward(F.col("a"))
    own = Named("mask")
    own.register("all")(lambda c: c)
    with pytest.raises(ValueError):
        own.register("all")(lambda c: c)
    with pytest.raises(KeyError):
        own.build({"name": "none"})


def test_templates(spark):
    pieces = M.parse("Do <task:text@3> for <who:text!> now")
    assert [(p.text, p.field, p.loss, p.limit) for p in pieces] == [("Do ", None, False, None), ("", "task", True, 3), (" for ", None, False, None), ("", "who", False, None), (" now", None, False, None)]
    df = spark.createDataFrame([("Lift it", "Ann"), (None, "")], "task string, who string")
    ids, labels, mask = M.assembled(pieces, 6)
    got = df.select(M.rendered(pieces), ids, labels, mask).collect()
    assert got[0][0] == "Do lif for ann now" and got[0][1] == ["Do", "lif", "for", "ann", "now", "<pad>"]
    assert got[0][2] == ["<ignore>", "lif"] + ["<ignore>"] * 4 and got[0][3] == [True] * 5 + [False]
    assert got[1][1] == ["Do", "for", "now"] + ["<pad>"] * 3
