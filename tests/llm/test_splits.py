"""Linked episodes and splits."""

import numpy as np

from kinelake.llm.splits import anneal, linked_episodes, operator_keys, recording_key, split_episodes, split_report

E = "episode_index long, operator string, recording string, parent_episode_index long, embodiment string, key string, node long"


def rows(*x):
    return [(i, op, rec, par, emb, "k", 0) for i, op, rec, par, emb in x]


def test_links(spark):
    df = spark.createDataFrame(rows(
        (1, "ve-0503", None, None, "a"), (2, "VE 503 (night shift 7)", "-1", None, "a"), (3, "ｖｅ－０５０３ & ra_7", "", None, "a"), (4, "Ra.0007", " nan", None, "b"),
        (5, None, "rec/2031-01-06/ra/00000067.mcap", None, "a"), (6, "NULL", "REC\\20310106\\RA\\67.MCAP#t=5", None, "a"), (7, "-1", "rec/2031-01-06/ve/00000067.mcap", None, "a"),
        (8, None, None, 900, "a"), (9, None, None, 900, None), (10, None, None, 5, "a"), (11, None, None, -1, "a"), (12, "", "none", None, "zz"), (12, "", "none", None, "zz"), (None, "ve-503", None, None, "a"),
    ), E)
    got = sorted(tuple(r) for r in linked_episodes(df).collect())
    assert got == [(1, 2), (1, 3), (1, 4), (5, 6), (5, 10), (8, 9)]


def test_keys(spark):
    df = spark.createDataFrame([("kx0138、 op ra‑0304", "/mnt/raw/rec/2031/03/22/tu//00000519.mcap ")], "o string, r string")
    r = df.select(operator_keys(df.o).alias("o"), recording_key(df.r).alias("r")).first()
    assert r["o"] == ["kx138", "ra304"] and r["r"] == "20310322/tu/519"


def test_whole_components_and_shares(spark):
    # one operator has a third of all rows
    x = [(i, "ve-1" if i % 3 == 0 else f"op-{i // 4}", None, None, "a" if i % 2 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows(*x, *x[:100]), E)
    m = spark.createDataFrame([("a", 0.1, 0.05), ("b", None, 0.05)], "embodiment string, val_set_proportion double, test_set_proportion double")
    s = split_episodes(df, m)
    got = s.collect()
    assert len(got) == len({r["episode_index"] for r in got}) == 3000
    by = {}
    for r in got:
        by.setdefault(r["comp"], set()).add(r["split"])
    assert all(len(v) == 1 for v in by.values())
    for r in split_report(s, m).collect():
        assert abs(r["target_share"] - r["actual_share"]) < 0.005


def test_empty(spark):
    df = spark.createDataFrame([], E)
    m = spark.createDataFrame([], "embodiment string, val_set_proportion double, test_set_proportion double")
    assert linked_episodes(df).count() == 0 and split_episodes(df, m).count() == 0


def test_annealing_keeps_the_best():
    rng = np.random.default_rng(1)
    c = rng.integers(0, 4, (300, 3)).astype(float)
    start = rng.integers(0, 3, 300)
    target = np.array([[0.1], [0.05]]) * c.sum(0)
    state, cost = anneal(c, start, target, np.ones(3), 7)
    dev = [(c[state == s].sum(0) - target[s - 1]) for s in (1, 2)]
    assert abs(cost - sum((d**2).sum() for d in dev)) < 1e-6 and max(abs(d).max() for d in dev) < 1.5
