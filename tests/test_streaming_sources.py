"""Streams give what their batch forms give; files are read as they were written; sequence codes are exact."""

import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.functions.sequences import RunCode, repaired
from kinelake.operators.codebook import lloyd
from kinelake.sources import datasets as ds
from kinelake.streaming import operators as so
from kinelake.tables import table


def run(df, name, spark, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(60)
        return spark.sql(f"select * from {name}").collect()
    finally:
        q.stop()


def streamed(spark, df, tmp_path, files=1):
    path = str(tmp_path / "in")
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_count_batches(spark, tmp_path):
    e = spark.range(40).select((F.col("id") % 3).alias("key"), F.col("id").alias("event"), F.col("id").alias("us"))
    stream = so.count_or_timeout_batches(streamed(spark, e, tmp_path), wait_ms=300)
    # with timeouts a stream goes on for ever: look at the sink until the incomplete batches have come too
    q = stream.writeStream.outputMode("append").format("memory").queryName("batches").start()
    try:
        for _ in range(60):
            got = {tuple(r) for r in spark.sql("select * from batches").collect()}
            if len(got) == 9:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert {(k, b, n) for k, b, n, _ in got} == {(0, 0, 5), (0, 1, 5), (0, 2, 4), (1, 0, 5), (1, 1, 5), (1, 2, 3), (2, 0, 5), (2, 1, 5), (2, 2, 3)}


def test_ensemble(spark, tmp_path):
    rows = [(k, s, [float(s + i) + 0.1 * (s % 3) for i in range(8)]) for k in (1, 2) for s in range(0, 20, 4)]
    df = spark.createDataFrame(rows, "key long, start long, chunk array<double>")
    got = {tuple(r) for r in run(so.temporal_ensemble(streamed(spark, df, tmp_path)), "ensemble", spark, "complete")}
    assert got == {tuple(r) for r in so.temporal_ensemble(df).collect()}


def test_windowed(spark, small, tmp_path):
    e = table(spark, small, "events")
    got = run(so.windowed_counts(streamed(spark, e, tmp_path)), "windowed", spark, "complete")
    assert sum(r["n"] for r in got) == e.count()


def test_nearest(spark):
    a = spark.createDataFrame([(1, 10, 100), (1, 11, 500), (2, 12, 50)], "key long, event long, s long").withColumn("ts", F.timestamp_seconds("s"))
    b = spark.createDataFrame([(1, 20, 90), (1, 21, 110), (1, 22, 505), (2, 23, 100_000_000)], "key long, event long, s long").withColumn("ts", F.timestamp_seconds("s"))
    assert {tuple(r) for r in so.nearest_of(so.nearest_in_streams(a, b)).collect()} == {(10, 21), (11, 22)}


def test_files(spark, small, tmp_path):
    x = table(spark, small, "frames").select("episode_index", "frame_index", "action").dropDuplicates(["episode_index", "frame_index"])
    path = str(tmp_path / "set")
    ds.write_frames(x, path, frames_per_file=500)
    back = ds.read_frames(spark, path, ["episode_index", "frame_index", "action"])
    assert back.exceptAll(x).count() == 0 and back.count() == x.count()
    one = ds.read_frames(spark, path, ["frame_index"], episodes=[1])
    assert one.count() == x.where("episode_index = 1").count()
    assert "PushedFilters: [In(episode_index" in one._jdf.queryExecution().toString() or "episode_index" in one._jdf.queryExecution().toString()
    ds.write_info(spark, {"fps": 10, "features": {"a": {"dtype": "float32", "shape": [3]}}}, path)
    info = ds.read_info(spark, path)
    assert info["fps"] == 10 and ds.schema_of(info["features"]).simpleString() == "struct<a:array<float>>"


def test_features():
    a = {"grip": {"dtype": "float32", "shape": [2], "names": ["open", "force"]}, "cam": {"dtype": "image", "shape": [9, 9, 3], "names": ["h", "w", "c"]}}
    b = {"grip": {"dtype": "float32", "shape": [2], "names": ["force", "slip"]}, "cam": {"dtype": "video", "shape": [3, 8, 8], "names": ["c", "h", "w"]}, "n": {"dtype": "int64", "shape": [1], "names": None}}
    both = ds.merge_features(a, b)
    assert both["grip"]["names"] == ["open", "force", "slip"] and both["grip"]["shape"] == [3]
    assert both["cam"] == b["cam"] and ds.schema_of(b).names == ["grip", "n"]
    with pytest.raises(ValueError):
        ds.merge_features(a, {"grip": {"dtype": "int64", "shape": [1], "names": ["x"]}})


def test_versions():
    assert ds.compatible("v3.0", "3.0") == "ok" and ds.compatible("3.0", "3.1") == "older"
    assert ds.compatible("4.0", "3.1") == "newer" and ds.compatible("2.1", "3.0", enforce_major=False) == "older"
    with pytest.raises(ValueError):
        ds.compatible("2.1", "3.0")


def test_struct_paths(spark):
    df = spark.sql("select 7 as id, struct(struct(1.5 as low, 'm' as unit) as size, array(1, 2) as tags) as part")
    flat = df.select(*ds.leaf_columns(df.schema))
    assert flat.columns == ["id", "part/size/low", "part/size/unit", "part/tags"]
    assert flat.select(*ds.struct_columns(flat.columns)).collect() == df.collect()


def test_run_code():
    for length, short in ((1, 1), (7, 1), (9, 2), (6, 0)):
        code = RunCode(length, short)
        valid = [list(b) for b in itertools.product((0, 1), repeat=length) if all(len(list(g)) > short for g in [list(g) for _, g in itertools.groupby(b)][1:-1])]
        assert code.size == len(valid)
        assert [code.rank(b) for b in valid] == list(range(len(valid)))
        assert [code.unrank(i) for i in range(len(valid))] == valid
    assert repaired([0, 0, 0, 1, 0, 0, 0], 1) == [0] * 7


def test_lloyd(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(5 * (i % 2), 0.1, 3)]) for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(rows, "vec_id long, x array<double>")
    got = {r["vec_id"]: r["code"] for r in lloyd(df, "vec_id", 4, 10).collect()}
    assert got[60] is None and not {got[i] for i in range(0, 60, 2)} & {got[i] for i in range(1, 60, 2)}
    assert lloyd(df.limit(0), "vec_id", 4, 10).count() == 0
    same = spark.createDataFrame([(i, [1.0]) for i in range(5)], "vec_id long, x array<double>")
    assert {r["code"] for r in lloyd(same, "vec_id", 3, 5).collect()} == {0}  # two entries stay without vectors
