"""Implausible readings against cases put in by hand."""

import math

import numpy as np
import pytest

from kinelake.operators import implausible as I
from kinelake.operators.implausible import implausible_readings, normal_directions, robust_components, shape_products
from kinelake.tables import table

FRAMES = "global_index long, episode_index long, frame_index long, robot_id string, action array<float>, state array<float>, received_at timestamp, src string, blk int, n long"
EPISODES = "episode_index long, robot_id string, embodiment string, kind string"
RANGES = [("t1", "right_arm", 0, 0, -3.0, 3.0), ("t1", "right_arm", 1, 1, -3.0, 3.0), ("t1", "right_gripper", 0, 2, 0.0, 1.0)]


def make(episodes=30, length=40, seed=3):
    rng = np.random.default_rng(seed)
    rows, gi = {}, 0
    for e in range(episodes):
        path = np.cumsum(rng.normal(0, 0.01, (length, 2)), axis=0) + rng.uniform(-1, 1, 2)
        for k in range(length):
            v = [*map(float, path[k]), float(k >= length // 2)]
            rows[e, k] = [gi, e, k, "r1", list(v), [v[0] + rng.normal(0, 0.005), v[1] + rng.normal(0, 0.005), v[2]], None, "x", 7, 1]
            gi += 1
    return rows


def expect(rows):
    """Puts bad readings in; gives what has to be found."""
    want = set()

    def bad(e, k, field, dim, value):
        rows[e, k][4 if field == "action" else 5][dim] = value
        want.add((rows[e, k][0], field, dim))

    base = rows[2, 10][4][0]
    for k in (10, 11):
        bad(2, k, "action", 0, base + 0.6)
    bad(3, 20, "state", 1, rows[3, 20][5][1] - 0.5)
    bad(4, 5, "state", 0, math.nan)
    bad(4, 6, "action", 1, math.inf)
    bad(5, 7, "action", 1, 3.5)
    bad(5, 8, "action", 2, -0.2)
    held = rows[6, 5][5][0]
    for k in range(5, 30):
        bad(6, k, "state", 0, held)
    for k in range(12, 40):  # a lasting shift is not bad
        rows[7, k][4][0] += 0.7
    for k in range(5, 30):  # a command at rest is not bad
        rows[8, k][4][0] = rows[8, 5][4][0]
    rows[9, 3][4] = None
    rows[9, 4][5] = [None, None, None]
    return want


def tables(spark, rows):
    f = spark.createDataFrame([tuple(r) for r in rows], FRAMES)
    e = spark.createDataFrame([(i, "r1", "a", "k") for i in range(30)] * 2, EPISODES)
    m = spark.createDataFrame([("a", "t1")], "embodiment string, embodiment_type string")
    r = spark.createDataFrame(RANGES, "embodiment_type string, part_key string, part_dim long, dim long, low double, high double")
    return f, e, m, r


@pytest.mark.parametrize("block_rows", [100_000, 200])
def test_planted_cases(spark, block_rows):
    rows = make()
    want = expect(rows)
    doubled = [*rows.values(), *list(rows.values())[:300]]
    got = implausible_readings(*tables(spark, doubled), block_rows=block_rows).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == want


def test_null_robot_and_unknown_episode(spark):
    rows = make(episodes=6)
    for r in rows.values():
        r[3] = None
    rows[1, 3][4][0] = math.nan
    rows[1, 4][4][0] = 50.0  # no range without a type
    rows[1, 4][5] = None
    got = {tuple(r) for r in implausible_readings(*tables(spark, rows.values())).collect()}
    assert (rows[1, 3][0], "action", 0) in got


def test_empty(spark):
    assert implausible_readings(*(t.limit(0) for t in tables(spark, make(2).values()))).count() == 0


def test_components_find_sparse_part():
    rng = np.random.default_rng(0)
    t = np.linspace(-1, 1, 24)
    x = rng.normal(0, 20, (500, 1)) * t + rng.normal(0, 1, (500, 24))
    hits = [(3, 5), (70, 12), (200, 20)]
    for i, j in hits:
        x[i, j] += 40
    products = shape_products(x)
    found = robust_components(x, normal_directions(products, products)) > I.OFF
    assert all(found[i, j] for i, j in hits) and found.mean() < 0.05


def test_rests_of_split_source(spark):
    rows, rng = make(), np.random.default_rng(7)
    for r in rows.values():  # a third dimension that moves
        r[5][2] = float(rng.normal(0, 0.01))
    for e in range(30):  # at rest for 12 frames
        for k in range(20, 32):
            rows[e, k][5][:] = rows[e, 20][5]
    for k in range(3, 18):  # stuck
        rows[6, k][5][0] = rows[6, 3][5][0]
    f, e, m, _ = tables(spark, rows.values())
    ranges = spark.createDataFrame([("t1", "right_arm", i, i, -3.0, 3.0) for i in range(3)], "embodiment_type string, part_key string, part_dim long, dim long, low double, high double")
    whole, split = ({tuple(r) for r in implausible_readings(f, e, m, ranges, block_rows=n).collect()} for n in (10**9, 200))
    assert whole == split and {(rows[6, k][0], "state", 0) for k in range(3, 18)} <= whole


def test_null_global_index(spark):
    rows = make(episodes=6)
    for k in (3, 9, 15):
        rows[1, k][0] = None
    rows[1, 3][4][0] = rows[1, 9][4][1] = math.nan
    rows[2, 4][4][0] = math.nan
    got = sorted(map(tuple, implausible_readings(*tables(spark, rows.values())).collect()), key=str)
    assert got == sorted([(None, "action", 0), (None, "action", 1), (rows[2, 4][0], "action", 0)], key=str)


def test_components_decide(spark, monkeypatch):
    """Without the components, every reading being off the path, the exact check alone gives other and more rows."""
    frames, episodes, mixture, ranges = (table(spark, "/root/testdata/sf0.01", n) for n in ("frames", "episodes", "mixture", "joint_ranges"))
    t = frames.where("robot_id = 'rb-000000'").select("global_index", "episode_index", "frame_index", "action", "state").toArrow()
    e = episodes.where("robot_id = 'rb-000000'").join(mixture, "embodiment").select(episodes.episode_index, "embodiment_type").distinct().toArrow()
    block = I._Block(t, e, I._ranges(ranges, 1000))
    with_components = set(zip(*(c.to_pylist() for c in I.detect(block).columns)))
    monkeypatch.setattr(I, "robust_components", lambda x, basis: np.full(x.shape, np.inf))
    without = set(zip(*(c.to_pylist() for c in I.detect(block).columns)))
    assert with_components < without and len(without) >= len(with_components) + 3


def test_blocks_give_the_rows_of_whole_sources(spark):
    t = [table(spark, "/root/testdata/sf0.001", n) for n in ("frames", "episodes", "mixture", "joint_ranges")]
    whole, split = (implausible_readings(*t, block_rows=n) for n in (10**9, 60))
    assert whole.count() > 100 and whole.exceptAll(split).count() == split.exceptAll(whole).count() == 0


def test_unknown_episode_takes_the_usual_type_of_its_source(spark):
    rows = make(episodes=30)
    rows[29, 3][4][0] = 3.5
    f, e, m, r = tables(spark, rows.values())
    for n in (10**9, 100):
        got = {tuple(x) for x in implausible_readings(f, e.where("episode_index < 20"), m, r, block_rows=n).collect()}
        assert (rows[29, 3][0], "action", 0) in got
