"""Radix percentiles against sorting, and merging of parts."""

import math

import numpy as np
import pytest

from kinelake.llm.percentiles import QUANTILES, bracket, follow, key_values, merge, ordered_keys, partials, radix_percentiles, target_ranks


def frame(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(600):
        g = "hot" if i % 3 else "cold"
        v = [float(rng.normal()), float(rng.choice([0.0, -0.0, 1.5])), float(10 ** rng.uniform(-30, 30))]
        if i % 50 == 0:
            v[0] = [math.nan, math.inf, -math.inf][i // 50 % 3]
        if i % 70 == 0:
            v[1] = None
        rows.append((f"p{i % 5}", g, v if i % 40 else None, "x"))
    rows.append(("p0", None, [1.0, 2.0, 3.0], "x"))
    return spark.createDataFrame(rows, "part string, group string, v array<float>, n string"), rows


def exact(rows):
    out = {}
    for _, g, v, _ in rows:
        for d, x in enumerate(v or []):
            if g is not None and x is not None and math.isfinite(np.float32(x)):
                out.setdefault((g, d), []).append(float(np.float32(x)))
    return out


def test_keys_keep_the_order():
    v = np.array([-np.float32(3e38), -1.5, -1e-40, 0.0, -0.0, 1e-45, 2.0, 3e38], np.float32)
    k = ordered_keys(v)
    assert (np.diff(k.astype(np.int64))[[0, 1, 2, 4, 5, 6]] > 0).all() and k[3] == k[4]
    assert (key_values(k, 32) == v).all()
    w = np.array([-1e300, -5e-324, 0.0, 0.1, 0.1 + 1e-12, 1e308])
    assert (np.diff(ordered_keys(w).astype(object)) > 0).all() and (key_values(ordered_keys(w), 64) == w).all()


def test_exact(spark):
    df, rows = frame(spark)
    want = exact(rows)
    got = radix_percentiles(df, ("v",)).collect()
    assert len(got) == len(want) * len(QUANTILES)
    for r in got:
        v = np.quantile(np.sort(want[r["group"], r["dim"]]), r["q"])
        assert r["low"] == r["high"] and r["n"] == len(want[r["group"], r["dim"]])
        assert abs(r["low"] - v) <= 1e-6 * max(1.0, abs(v))


def test_merged_parts_bound_the_result(spark):
    df, rows = frame(spark, 3)
    stored = [partials(df.where(df.part == p), ("v",)) for p in ("p0", "p1", "p2", "p3", "p4")]
    counts = stored[0]
    for s in stored[1:]:
        counts = counts.unionByName(s)
    m = merge(counts)
    want = exact(rows)
    found = bracket(follow(m, target_ranks(m)), 16).collect()
    assert found
    for r in found:
        v = np.quantile(want[r["group"], r["dim"]], r["q"])
        assert r["low"] - 1e-6 * abs(r["low"]) <= v <= r["high"] + 1e-6 * abs(r["high"])


def test_empty(spark):
    df, _ = frame(spark)
    assert radix_percentiles(df.limit(0), ("v",)).count() == 0


def test_doubles_are_exact(spark):
    rng = np.random.default_rng(5)
    v = [0.1 + 1e-12 * i for i in range(101)] + [float(x) for x in rng.normal(0, 1e200, 400)] + [-0.0, 5e-324]
    df = spark.createDataFrame([("p", "g", [x], [k]) for k, x in enumerate(v)], "part string, group string, v array<double>, k array<int>")
    got = {(r["field"], r["quantile"]): r for r in radix_percentiles(df, ("v", "k")).collect()}
    for name, q in QUANTILES:
        s = sorted(v)
        at = q * (len(s) - 1)
        lo, hi = s[math.floor(at)], s[math.ceil(at)]
        r = got["v", name]
        assert r["low"] == r["high"] == lo + (hi - lo) * (at % 1.0)
        assert got["k", name]["low"] == pytest.approx(at)
    three = spark.createDataFrame([("p", "g", [0.1 + i * 1e-12]) for i in range(3)], "part string, group string, v array<double>")
    assert [r["low"] for r in radix_percentiles(three, ("v",), (("q50", 0.5),)).collect()] == [0.1 + 1e-12]


def test_longs_are_refused(spark):
    df = spark.createDataFrame([("p", "g", [1 << 60])], "part string, group string, v array<long>")
    with pytest.raises(TypeError):
        radix_percentiles(df, ("v",))
