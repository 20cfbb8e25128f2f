"""Schema changes and the table of all records on small cases."""

import json

from kinelake.operators.drift import compare, plain_dtype, plain_shape, schema_changes, unified_records


def spec(dtype="float32", shape=(1,), **more):
    return {"dtype": dtype, "shape": list(shape), **more}


def tables(spark):
    one = {"index": spec("int64"), "action": spec(shape=[3]), "wrench": spec(shape=[2]), "ok": spec("bool")}
    two = {"index": {"dtype": "torch.INT64", "shape": "(1,)", "names": ["x"]}, "teleop.action": spec("float64", [3]), "Wrench": spec(shape=[2]), "ok": spec("bool")}
    three = {"index": spec("int64"), "teleop.action": spec("float64", [4]), "ok": spec("string")}
    info = [(1, "d", json.dumps(one), 1, 1, "x"), (2, "d", json.dumps(two), 2, 2, "x"), (2, "d", json.dumps(two, indent=2), 2, 9, "x"), (3, "d", json.dumps(three), 3, 3, "x"), (4, None, json.dumps(one), 4, 4, "x"), (5, "e", None, 1, 1, "x"), (6, "e", "not json", 2, 1, "x")]
    parts = [(1, "action", "arm", "action"), (2, "action", "arm", "teleop.action"), (2, "action", "arm", "teleop.action"), (3, "action", "arm", '["teleop.action"]'), (1, "state", "w", "wrench"), (2, "state", "w_b", "Wrench")]
    recs = [(1, 0, '{"index": 5, "action": [1, "2", 3], "ok": true}', 1), (1, 0, '{"index": 5, "action": [1, "2", 3], "ok": true}', 2), (1, 1, '{"index": 6, "act', 1), (2, 0, '{"index": "7", "teleop.action": [1.5, null, 2], "Wrench": null, "unknown": 1}', 1), (3, 0, '{"index": 8.0, "teleop.action": 4, "ok": "yes"}', 1), (99, 0, "{}", 1), (3, 1, None, 1)]
    return (
        spark.createDataFrame(recs, "file_id long, line_no long, record string, received_at long"),
        spark.createDataFrame(info, "file_id long, dataset_dir string, features string, written_at long, received_at long, at string"),
        spark.createDataFrame(parts, "file_id long, category string, part_key string, lerobot_key string"),
    )


def test_spellings():
    assert plain_dtype("torch.FLOAT32") == plain_dtype("float32") == "float32"
    assert plain_shape(1) == plain_shape([1]) == plain_shape("(1,)") == (1,)
    assert plain_shape(None) is None and plain_dtype(None) is None


def test_changes(spark):
    _, info, parts = tables(spark)
    got = sorted(tuple(r)[:3] for r in schema_changes(info, parts).collect())
    assert got == sorted([(2, "teleop.action", "renamed"), (2, "teleop.action", "retyped"), (2, "Wrench", "added"), (2, "wrench", "removed"), (3, "Wrench", "removed"), (3, "teleop.action", "retyped"), (3, "ok", "retyped")])


def test_swap_in_a_list():
    old, new = {"a": ("f", (1,)), "b": ("f", (1,))}, {"x": ("f", (1,)), "y": ("f", (1,))}
    got = compare(old, new, {("s", "p"): ["a", "b"]}, {("s", "p"): ["y", "x"]})
    assert {(g[0], g[1], g[2]) for g in got} == {("y", "renamed", "a"), ("x", "renamed", "b")}


def test_records(spark):
    rows = {(r["file_id"], r["line_no"]): r.asDict() for r in unified_records(*tables(spark)).collect()}
    assert len(rows) == 6
    assert rows[1, 0]["action"] == [1.0, 2.0, 3.0] and rows[1, 0]["index"] == 5
    assert rows[1, 1]["is_corrupt"] and rows[1, 1]["index"] is None
    assert rows[2, 0]["action"] == [1.5, None, 2.0] and rows[2, 0]["index"] == 7
    assert rows[3, 0]["action"] == [4.0] and rows[3, 0]["index"] == 8 and rows[3, 0]["ok"] == "yes"
    assert rows[3, 1]["is_corrupt"]


def test_empty(spark):
    r, i, p = (t.limit(0) for t in tables(spark))
    assert schema_changes(i, p).count() == 0 and unified_records(r, i, p).count() == 0


def test_name_that_appears_anew_after_its_renaming(spark):
    def file(i, names, part):
        return (i, "d", json.dumps({n: spec() for n in names}), i, i), (i, "action", "arm", part)

    info, parts = zip(file(1, ["a"], "a"), file(2, ["b"], "b"), file(3, ["b", "a"], "b"), file(4, ["a"], "a"), file(5, ["c"], "c"), file(6, ["c", "a"], "c"))
    recs = [(1, '{"a": 1}'), (2, '{"b": 2}'), (3, '{"b": 3, "a": 30}'), (4, '{"a": 40}'), (5, '{"c": 50}'), (6, '{"c": 60, "a": 600}')]
    r = spark.createDataFrame([(i, 0, x, 1) for i, x in recs], "file_id long, line_no long, record string, received_at long")
    i = spark.createDataFrame(info, "file_id long, dataset_dir string, features string, written_at long, received_at long")
    p = spark.createDataFrame(parts, "file_id long, category string, part_key string, lerobot_key string")
    got = unified_records(r, i, p).orderBy("file_id").collect()
    assert [x["a"] for x in got] == [1.0, 2.0, 3.0, None, None, None]
    assert [x["a_2"] for x in got] == [None, None, 30.0, 40.0, 50.0, 60.0]
    assert [x["a_3"] for x in got] == [None] * 5 + [600.0]


def test_flooding_settles_which_new_name_continues_the_old(monkeypatch):
    """Two parts that read one old name read two new ones now: the scores choose, by names, types and nesting together."""
    from kinelake.operators import drift

    v = ("float32", (6,))
    old, new = {"obs.wrench": v, "index": v}, {"all.total": ("float64", (9,)), "obs.wrench_v2": v, "index": v}
    before = {("state", "p"): ["obs.wrench"], ("state", "q"): ["obs.wrench"]}
    after = {("state", "p"): ["all.total"], ("state", "q"): ["obs.wrench_v2"]}
    want = {("obs.wrench_v2", "renamed"), ("all.total", "added")}
    assert {x[:2] for x in compare(old, new, before, after)} == want
    three, come = {"m.x": v, "m.y": v, "m.z": v}, {"n.z": v, "n.y": v, "n.x": v, "b": v}
    reads = [{("s", k): [f"{side}.{k}"] for k in "xyz"} for side in "mn"]
    renamed = {(x[2], x[0]) for x in compare(three, come, *reads) if x[1] == "renamed"}
    assert renamed == {(f"m.{k}", f"n.{k}") for k in "xyz"}
    monkeypatch.setattr(drift, "flood", lambda gone, new, *_: {(a, b): 0.0 for a in gone for b in new})
    assert {x[:2] for x in compare(old, new, before, after)} != want
    assert sum(x[1] == "renamed" for x in compare(three, come, *reads)) < 3


def test_flooding_converges():
    from kinelake.operators.drift import flood

    many = {f"a.f{i}": ("f", (i % 3,)) for i in range(12)}, {f"b.f{i}": ("f", (i % 3,)) for i in range(12)}
    reads = [{("s", str(i)): [f"{side}.f{i}"] for i in range(0, 12, 2)} for side in "ab"]
    scores = flood(*many, *reads)
    assert len(scores) == 144 and max(scores.values()) <= 1 and min(scores.values()) > 0
    assert flood({}, many[1], {}, {}) == {}
