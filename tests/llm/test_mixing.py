"""Mixtures keep to budgets, caps and copies."""

import numpy as np

from kinelake.llm.mixing import budgets, mix

D = "doc_id long, source string, text string, n_tokens int, w string"


def docs(spark):
    rows = [(i, " Big " if i % 2 else "big", f"word number {i} of the big source", 1, "") for i in range(3000)]
    rows += [(10_000 + i, "small", f"small text {i % 20}", 1, "") for i in range(40)]
    rows += [(20_000, None, "lost", 1, ""), (20_001, "nobody", "lost", 1, ""), (20_002, "big", None, 1, ""), (20_003, "big", "", 1, ""), (20_004, "off", "never taken", 1, "")]
    return spark.createDataFrame(rows, D)


T = "source string, target_weight double, max_repeats long"


def test_mixture(spark):
    t = spark.createDataFrame([("big", 1.0, 2), ("small", 1.0, 3), ("none here", 2.0, 3), ("off", None, 4), (None, 3.0, 1)], T)
    m, r = mix(docs(spark), t)
    rows = m.collect()
    assert len({(x["doc_id"], x["copy"]) for x in rows}) == len(rows)
    assert {x["source"] for x in rows} == {"big", "small"}
    most = {}
    for x in rows:
        most[x["source"]] = max(most.get(x["source"], 0), x["copy"])
    assert most["big"] <= 2 and most["small"] == 3
    rep = {x["source"]: x for x in r.collect()}
    assert rep["small"]["capped"] and rep["small"]["actual_tokens"] == 3 * rep["small"]["available_tokens"]
    assert rep["none here"]["available_documents"] == 0 and rep[None]["available_documents"] == 2
    total = rep["big"]["available_tokens"] + rep["small"]["available_tokens"]
    assert abs(rep["big"]["actual_tokens"] + rep["small"]["actual_tokens"] - total) < 15
    assert sum(x["n_tokens"] for x in rows if x["source"] == "big") == rep["big"]["actual_tokens"]


def test_copies_share_their_probability(spark):
    rows = [(i, "s", "one text over and over", 1, "") for i in range(50)] + [(100 + i, "s", f"text {i} of its own kind", 1, "") for i in range(50)]
    t = spark.createDataFrame([("s", 1.0, 1)], T)
    m, _ = mix(spark.createDataFrame(rows, D), t, total_tokens=200)
    same = sum(r["doc_id"] < 100 for r in m.collect())
    assert same <= 4 < m.count()


def test_budgets():
    got = budgets(np.array([1.0, 1.0, 2.0, 0.0]), np.array([10.0, 1000.0, 1000.0, 50.0]), 400.0)
    assert np.allclose(got, [10, 130, 260, 0])


def test_empty(spark):
    t = spark.createDataFrame([("big", 1.0, 2)], T)
    m, r = mix(docs(spark).limit(0), t)
    assert m.count() == 0 and r.count() == 2
    m, r = mix(docs(spark), t.limit(0))
    assert m.count() == 0
