"""Reading and writing folders of recorded datasets: data, metadata, dictionaries and statistics."""

from __future__ import annotations

import json
from collections import deque
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types of a feature by dtype (fixed values of the format).
DTYPES = {
    "float16": T.FloatType(), "float32": T.FloatType(), "float64": T.DoubleType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "bool": T.BooleanType(), "string": T.StringType(), "image": T.BinaryType(),
}


def schema_of(features: dict) -> T.StructType:
    """The schema of a data file from its features; videos are no columns, shapes of more than one value are arrays."""
    fields = []
    for name, spec in features.items():
        if spec["dtype"] == "video":
            continue
        t = DTYPES[spec["dtype"]]
        shape = tuple(spec.get("shape") or (1,))
        if spec["dtype"] not in ("string", "image") and shape != (1,):
            for _ in shape:
                t = T.ArrayType(t)
        fields.append(T.StructField(name, t))
    return T.StructType(fields)


def merge_features(*all_features: dict) -> dict:
    """Features of several datasets in one.

    Vectors with named places keep the names of all in the order seen, and their shape is the number of names; they must be of one
    dtype. Of anything else, images and videos among it, the last spelling counts.
    """
    out: dict = {}
    for features in all_features:
        for name, spec in features.items():
            before = out.get(name)
            named = spec["dtype"] not in ("image", "video") and isinstance(spec.get("names"), (list, tuple))
            if before is None or not named or not isinstance(before.get("names"), (list, tuple)):
                out[name] = dict(spec)
                continue
            if before["dtype"] != spec["dtype"]:
                raise ValueError(f"{name} is {before['dtype']} and {spec['dtype']}")
            names = list(dict.fromkeys([*before["names"], *spec["names"]]))
            out[name] = {**spec, "names": names, "shape": [len(names)]}
    return out


def read_frames(spark: SparkSession, path: str, columns: list[str] | None = None, episodes: list[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The data files of a dataset (``data/chunk-*/file-*.parquet`` or one file per episode) as one table.

    Column list and episodes reach the scan as projection and pushed filter.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    df = (reader.schema(schema) if schema else reader).parquet(f"{path}/data")
    if episodes is not None:
        df = df.where(F.col("episode_index").isin(episodes))
    return df.select(*columns) if columns else df


def read_info(spark: SparkSession, path: str) -> dict:
    """The info file of a dataset: one small JSON object."""
    return json.loads("\n".join(r[0] for r in spark.read.text(f"{path}/meta/info.json").collect()))


def read_dictionary(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A side dictionary in JSON lines: ``<name>_index`` and ``<name>``."""
    return spark.read.schema(f"`{name}_index` long, `{name}` string").json(f"{path}/annotations/{name}.jsonl")


def write_frames(df: DataFrame, path: str, frames_per_file: int = 100_000, chunks: int = 1000) -> None:
    """Frames as Parquet files of at most ``frames_per_file`` rows, episodes kept together and in order, by chunk of episodes."""
    x = df.withColumn("chunk", F.expr(f"episode_index div {chunks}"))
    x.repartition("chunk").sortWithinPartitions("chunk", "episode_index", "frame_index").write.mode("error").option("maxRecordsPerFile", frames_per_file).partitionBy("chunk").parquet(f"{path}/data")


def write_info(spark: SparkSession, info: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(info),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta/info.json")


def leaf_columns(schema: T.StructType, sep: str = "/") -> list[Column]:
    """A column for every field of a schema that is no struct, named by its path; a queue of paths takes the place of nested calls."""
    waiting, out = deque((((f.name,), f.dataType) for f in schema.fields)), []
    while waiting:
        path, kind = waiting.popleft()
        if isinstance(kind, T.StructType):
            waiting.extendleft(((*path, f.name), f.dataType) for f in reversed(kind.fields))
        else:
            out.append(reduce(lambda c, name: c.getField(name), path[1:], F.col(f"`{path[0]}`")).alias(sep.join(path)))
    return out


def struct_columns(names: list[str], sep: str = "/") -> list[Column]:
    """The inverse: columns whose names are paths, gathered into structs."""
    groups: dict[str, list[tuple[str, list[str]]]] = {}
    for name in names:
        head, *rest = name.split(sep)
        groups.setdefault(head, []).append((name, rest))

    def gathered(items: list[tuple[str, list[str]]]) -> Column:
        if len(items) == 1 and not items[0][1]:
            return F.col(f"`{items[0][0]}`")
        inner: dict[str, list[tuple[str, list[str]]]] = {}
        for name, rest in items:
            inner.setdefault(rest[0], []).append((name, rest[1:]))
        return F.struct(*[gathered(v).alias(k) for k, v in inner.items()])

    return [gathered(v).alias(k) for k, v in groups.items()]


def compatible(version: str, current: str, enforce_major: bool = True) -> str:
    """How a dataset's version stands to that of the reader: ``ok``, ``older`` or ``newer``. An older major version is an error if ``enforce_major``."""
    theirs, ours = (tuple(int(x) for x in v.strip().lstrip("v").split(".")[:2]) for v in (version, current))
    if theirs[0] < ours[0] and enforce_major:
        raise ValueError(f"version {version} is too old for {current}")
    return "ok" if theirs == ours else "older" if theirs < ours else "newer"


def write_episodes(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """The rows of episodes, in order, as files of metadata."""
    df.repartitionByRange("episode_index").sortWithinPartitions("episode_index").write.mode("error").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/meta/episodes")


def write_stats(df: DataFrame, path: str) -> None:
    """Statistics as JSON lines."""
    df.write.mode("error").json(f"{path}/meta/stats")


def write_dictionary(df: DataFrame, path: str, name: str) -> None:
    """A side dictionary: ``<name>_index`` and ``<name>`` in JSON lines."""
    df.select(f"{name}_index", name).write.mode("error").json(f"{path}/annotations/{name}.jsonl")


def load_metadata(spark: SparkSession, path: str, stats_schema: str, dictionaries: tuple[str, ...] = ()) -> dict:
    """All that a dataset says of itself: ``info`` (one object), and as tables ``episodes``, ``stats`` and the dictionaries by name."""
    tables = {n: read_dictionary(spark, path, n) for n in dictionaries}
    return {"info": read_info(spark, path), "episodes": spark.read.parquet(f"{path}/meta/episodes"), "stats": spark.read.schema(stats_schema).json(f"{path}/meta/stats"), **tables}
