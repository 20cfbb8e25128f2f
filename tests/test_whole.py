"""Queries that do the whole job, against plain computations over the same tables."""

import numpy as np

from kinelake.functions.sequences import RunCode, repaired
from kinelake.plans import core
from kinelake.plans.base import typed_episodes
from kinelake.tables import table


def test_whole_residual_codes(spark, small):
    e = table(spark, small, "embeddings").select("vec_id", "label", "embedding").toPandas()
    x, labels = np.stack(e["embedding"].to_numpy()).astype(float), e["label"].to_numpy()
    codes = np.unique(labels)
    book = np.stack([x[labels == c].mean(0) for c in codes])
    assert x.shape[1] == 64

    def near(v):
        return ((v[:, None] - book[None]) ** 2).sum(2).round(9).argmin(1)

    k1 = near(x)
    k2 = near(x - book[k1])
    got = core.queries["q3_residual_codes"](spark, small).toPandas().set_index("vec_id").loc[e["vec_id"]]
    assert len(got) == len(e)
    assert (got["code1"].to_numpy() == codes[k1]).all() and (got["code2"].to_numpy() == codes[k2]).all()


def plain_frames(spark, small, *columns):
    """Each frame once, in the order of episodes and frames."""
    f = table(spark, small, "frames").select("global_index", "episode_index", "frame_index", *columns).toPandas()
    return f.drop_duplicates("global_index").sort_values(["episode_index", "frame_index"])


def same(got, want):
    assert abs(got - want) <= 2e-6 + 1e-7 * abs(want), (got, want)


def test_whole_stepwise_stats(spark, small):
    kinds = {r["episode_index"]: r["embodiment_type"] for r in typed_episodes(spark, small).collect()}
    values = {}
    for e, g in plain_frames(spark, small, "action").groupby("episode_index"):
        rows = g["action"].tolist()
        for i in range(len(rows)):
            for s in range(8):
                r = rows[min(i + s, len(rows) - 1)]
                for dim, v in enumerate([] if r is None else r):
                    if e in kinds and v is not None and np.isfinite(v):
                        values.setdefault((kinds[e], s, dim), []).append(float(v))
    got = {(r["embodiment_type"], r["step"], r["dim"]): r for r in core.queries["a5_stepwise_stats"](spark, small).collect()}
    assert got.keys() == values.keys() and {k[2] for k in got} > {0}
    for k, v in values.items():
        v, r = np.sort(v), got[k]
        assert r["n"] == len(v)
        for c, x in (("lo", v[0]), ("hi", v[-1]), ("mean", v.mean()), ("std", v.std(ddof=1)), ("q01", v[int(0.01 * (len(v) - 1))]), ("q99", v[int(0.99 * (len(v) - 1))])):
            same(r[c], x)


def test_run_codes_of_all_chunks(spark, small):
    code, want = RunCode(16, 1), {}
    for e, g in plain_frames(spark, small, "action").groupby("episode_index"):
        bits = [int(r is not None and r[-1] is not None and r[-1] >= 0.5) for r in g["action"]]
        for k in range(0, len(bits), 16):
            part = bits[k : k + 16]
            want[e, k // 16] = code.rank(repaired(part + part[-1:] * (16 - len(part)), 1))
    got = core.queries["q2_run_codes"](spark, small).collect()
    assert len(got) == len(want) and {(r["episode_index"], r["chunk"]): r["code"] for r in got} == want
    assert {k for _, k in want} > {0}


def test_all_samples_located(spark, small):
    e = table(spark, small, "episodes").select("episode_index", "dataset_dir", "length").toPandas().drop_duplicates("episode_index")
    n = e.groupby("dataset_dir")["length"].sum().sort_index()
    want = [(name, i) for name, k in n.items() for i in range(k)]
    got = sorted((r["sample"], r["dataset_dir"], r["local"]) for r in core.queries["j5_locate_sample"](spark, small).collect())
    assert got == [(i, name, local) for i, (name, local) in enumerate(want)]


def test_whole_episode_stats(spark, small):
    values = {}
    for e, a, s in plain_frames(spark, small, "action", "state")[["episode_index", "action", "state"]].itertuples(index=False):
        for field, r in (("action", a), ("state", s)):
            for dim, v in enumerate([] if r is None else r):
                if v is not None and np.isfinite(v):
                    values.setdefault((e, field, dim), []).append(float(v))
    got = {(r["episode_index"], r["field"], r["dim"]): r for r in core.queries["a1_episode_stats"](spark, small).collect()}
    assert got.keys() == values.keys() and max(abs(r["hi"]) for r in got.values()) >= 10
    for k, v in values.items():
        v, r = np.array(v), got[k]
        assert r["n"] == len(v)
        for c, x in (("lo", v.min()), ("hi", v.max()), ("mean", v.mean()), ("std", v.std())):
            same(r[c], x)
