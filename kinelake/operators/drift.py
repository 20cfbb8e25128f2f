"""Schemas that drift from file to file: changes, correspondences, and one table of all records.

Method: similarity flooding. The features of a file and of its predecessor become two graphs of names, name prefixes
(nesting), types, shapes and the parts that read them. A pair of features starts with the likeness of their names; pairs
pass their score on to pairs of neighbours over equal edges until the scores converge. Of all pairs of a vanished and a new feature the
best are selected one by one, each feature once. A selected pair is a renaming if it passes the exact check that a part
reads the new name at the place of the old; so of two new names that parts read at the place of one old name the scores choose one.
Origins of names are then followed back over all files of a dataset, values are cast to the common type and united.

Defined results: copies of a file (same ``file_id``) count once; files are ordered by ``written_at``, then ``file_id``, nulls first; a
file without dataset has no predecessor; features that are null or no JSON object are an empty schema; a feature that is no
object has neither dtype nor shape; a first file has no changes; empty tables give empty results.
"""

from __future__ import annotations

import json
import re
import warnings
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.ordering import previous_in_group
from kinelake.session import materialize
from kinelake.skew import hot_split_join

CHANGES = "file_id long, field string, change string, old_name string, old_type string, new_type string"
#: Scores have converged when none changes by more than this.
EPSILON = 1e-6
#: Rounds after which a warning says that they have not; a few dozen are usual.
MOST_ROUNDS = 10_000
#: Weight of an edge label in passing on scores.
EDGE_WEIGHT = {"reads": 2.0, "dtype": 0.5, "shape": 0.5, "inside": 0.5}

#: Other names of dtypes (fixed values of the array libraries).
DTYPE_ALIASES = {
    "float": "float32", "double": "float64", "half": "float16", "long": "int64", "int": "int32", "short": "int16",
    "boolean": "bool", "str": "string",
}


def plain_dtype(x: object) -> str | None:
    """A dtype in one spelling: lower case, without a library's prefix."""
    if x is None:
        return None
    s = re.sub(r"^(torch|numpy|np|jnp|tf)\.", "", str(x).strip().lower())
    return DTYPE_ALIASES.get(s, s)


def plain_shape(x: object) -> tuple[int, ...] | None:
    """A shape in one spelling: ``1``, ``[1]``, ``(1,)`` and ``"[1]"`` are the same."""
    if x is None:
        return None
    if isinstance(x, bool):
        return None
    if isinstance(x, (int, float)):
        return (int(x),)
    if isinstance(x, str):
        return tuple(int(v) for v in re.findall(r"\d+", x))
    if isinstance(x, (list, tuple)):
        return tuple(int(float(v)) for v in x if isinstance(v, (int, float)) or str(v).strip().isdigit())
    return None


def read_features(text: str | None) -> dict[str, tuple[str | None, tuple[int, ...] | None]]:
    try:
        o = json.loads(text) if text else {}
    except ValueError:
        o = {}
    if not isinstance(o, dict):
        return {}
    return {k: (plain_dtype(v.get("dtype")), plain_shape(v.get("shape"))) if isinstance(v, dict) else (None, None) for k, v in o.items()}


def read_names(text: str | None) -> list[str]:
    """The feature names of a part: one name or a JSON list of names."""
    if not text:
        return []
    if text.lstrip().startswith("["):
        try:
            got = json.loads(text)
            if isinstance(got, list):
                return [x if isinstance(x, str) else "" for x in got]
        except ValueError:
            pass
    return [text]


def _likeness(a: str, b: str) -> float:
    """Dice coefficient of the letter pairs of two names, without case and separators."""
    x, y = (re.sub(r"[^a-z0-9]", "", s.lower()) for s in (a, b))
    p, q = ({s[i : i + 2] for i in range(len(s) - 1)} for s in (x, y))
    return 2 * len(p & q) / (len(p) + len(q)) if p and q else float(x == y)


def flood(gone: dict[str, tuple], new: dict[str, tuple], before: dict[tuple, list[str]], after: dict[tuple, list[str]]) -> dict[tuple[str, str], float]:
    """Similarity of each vanished and each new feature name after flooding, between 0 and 1."""
    pairs = [(a, b) for a in gone for b in new]
    if not pairs:
        return {}
    sigma0: dict[tuple, float] = {("f", a, b): 0.05 + 0.5 * _likeness(a, b) for a, b in pairs}
    edges: dict[tuple, list[tuple[tuple, float]]] = defaultdict(list)

    def connect(x: tuple, y: tuple, w: float) -> None:
        edges[x].append((y, w))
        edges[y].append((x, w))

    readers_before, readers_after = defaultdict(list), defaultdict(list)
    for side, own in ((before, readers_before), (after, readers_after)):
        for part, names in side.items():
            for i, name in enumerate(names):
                own[name].append((part, i))
    for a, b in pairs:
        f = ("f", a, b)
        for k, label in ((0, "dtype"), (1, "shape")):
            if gone[a][k] == new[b][k]:
                node = (label, gone[a][k])
                sigma0[node] = 0.2
                connect(f, node, EDGE_WEIGHT[label])
        p, q = a.rpartition(".")[0], b.rpartition(".")[0]
        node = ("inside", p, q)
        sigma0.setdefault(node, 0.3 * _likeness(p, q))
        connect(f, node, EDGE_WEIGHT["inside"])
        for part, i in readers_before[a]:
            if (part, i) in readers_after[b]:
                node = ("part", part, i)
                sigma0[node] = 1.0
                connect(f, node, EDGE_WEIGHT["reads"])
    # an edge's weight is shared out among the edges of its kind that leave a node
    nodes = list(sigma0)
    at = {x: i for i, x in enumerate(nodes)}
    push = np.zeros((len(nodes), len(nodes)))
    for x, ys in edges.items():
        kinds = Counter(y[0] for y, _ in ys)
        for y, w in ys:
            push[at[y], at[x]] += w / kinds[y[0]]
    # one round adds what the neighbours of start and score push; the largest score is 1. Every node keeps its own score, so rounds can't swing for ever
    start = np.array([sigma0[x] for x in nodes])
    step = push + np.eye(len(nodes))
    sigma = start
    for _ in range(MOST_ROUNDS):
        nxt = step @ (start + sigma)
        nxt /= nxt.max()
        moved = np.abs(nxt - sigma).max()
        sigma = nxt
        if moved < EPSILON:
            break
    else:
        warnings.warn(f"similarity flooding still moves by {moved} after {MOST_ROUNDS} rounds", stacklevel=2)
    return {(a, b): float(sigma[at["f", a, b]]) for a, b in pairs}


def correspondences(scores: dict[tuple[str, str], float]) -> list[tuple[str, str]]:
    """Pairs in which each old and each new name occurs once: the best pair, then the best of the rest, and so on; ties go by name."""
    old, new, out = set(), set(), []
    for a, b in sorted(scores, key=lambda p: (-round(scores[p], 9), p)):
        if a not in old and b not in new:
            out.append((a, b))
            old.add(a)
            new.add(b)
    return out


def compare(old: dict, new: dict, before: dict[tuple, list[str]], after: dict[tuple, list[str]]) -> list[tuple[str, str, str | None, str | None, str | None]]:
    """Changes between two schemas: field, change, old name, old type, new type."""
    gone = {k: v for k, v in old.items() if k not in new}
    come = {k: v for k, v in new.items() if k not in old}
    renamed: dict[str, str] = {}
    used: set[str] = set()
    if gone and come:
        reads = {(x, y) for part, names in before.items() for x, y in zip(names, after.get(part, ()))}
        scores = flood(gone, come, before, after)
        for a, b in correspondences(scores):
            if (a, b) in reads:
                renamed[b] = a
                used.add(a)

    def spelled(t: tuple) -> str:
        return f"{t[0]}{'' if t[1] is None else list(t[1])}"

    out = []
    for b in sorted(come):
        if b in renamed:
            a = renamed[b]
            out.append((b, "renamed", a, spelled(old[a]), spelled(come[b])))
            if old[a] != come[b]:
                out.append((b, "retyped", a, spelled(old[a]), spelled(come[b])))
        else:
            out.append((b, "added", None, None, spelled(come[b])))
    out += [(a, "removed", a, spelled(gone[a]), None) for a in sorted(gone) if a not in used]
    out += [(k, "retyped", k, spelled(old[k]), spelled(new[k])) for k in sorted(old) if k in new and old[k] != new[k]]
    return out


def _files(info_files: DataFrame) -> DataFrame:
    """One row per file; copies differ in the layout of their JSON only."""
    f = info_files.where("file_id is not null").groupBy("file_id").agg(F.min(F.struct(F.col("received_at").isNull().alias("n"), "received_at", "dataset_dir", "written_at", "features")).alias("z"))
    return f.select("file_id", "z.dataset_dir", "z.written_at", "z.features")


def _part_list(shape_meta: DataFrame) -> DataFrame:
    part = F.struct(F.coalesce("category", F.lit("")).alias("category"), F.coalesce("part_key", F.lit("")).alias("part_key"), "lerobot_key")
    return shape_meta.where("file_id is not null and lerobot_key is not null").groupBy("file_id").agg(F.array_sort(F.collect_set(part)).alias("parts"))


def schema_changes(info_files: DataFrame, shape_meta: DataFrame) -> DataFrame:
    """Every change of a file's features against the previous file of its dataset; columns as in ``CHANGES``."""
    files = materialize(_files(info_files), "files")
    order = previous_in_group(files.select("dataset_dir", "written_at", "file_id"), "dataset_dir", ["written_at", "file_id"], "file_id")
    full = files.select("file_id", "features").join(_part_list(shape_meta), "file_id", "left")
    old = full.select(F.col("file_id").alias("previous"), F.col("features").alias("old_features"), F.col("parts").alias("old_parts"))
    pairs = order.where("previous is not null").select("file_id", "previous").join(full, "file_id").join(old, "previous")

    def parts(rows: object) -> dict[tuple, list[str]]:
        return {(r["category"], r["part_key"]): read_names(r["lerobot_key"]) for r in rows} if rows is not None else {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for fid, o, n, op, np_ in zip(b["file_id"], b["old_features"], b["features"], b["old_parts"], b["parts"]):
                a, c = read_features(o), read_features(n)
                if a != c:
                    out += [(fid, *x) for x in compare(a, c, parts(op), parts(np_))]
            yield pd.DataFrame(out, columns=["file_id", "field", "change", "old_name", "old_type", "new_type"])

    return pairs.mapInPandas(run, CHANGES)


def name_origins(changes: DataFrame, files: DataFrame) -> DataFrame:
    """For every renamed name the name it had at first: dataset_dir, name, origin, origin_at, since, until (exclusive).

    ``origin_at`` is the file in which the origin appeared, null if it is in the dataset's first file.

    ``since`` and ``until`` are structs of ``written_at`` and ``file_id``. Renamings are followed back by doubling, so a
    chain of k renamings takes about log2(k) rounds.
    """
    where = F.struct("written_at", "file_id").alias("at")
    place = files.select("file_id", "dataset_dir", where)
    ev = changes.where("change in ('renamed', 'added', 'removed')").join(place, "file_id")
    born = ev.where("change <> 'removed'").select("dataset_dir", F.col("field").alias("name"), "at", F.when(F.col("change") == "renamed", F.col("old_name")).alias("old"))
    ends = ev.where("change <> 'added'").select("dataset_dir", F.coalesce("old_name", "field").alias("name"), F.col("at").alias("until"))
    born = born.join(ends, ["dataset_dir", "name"], "left").groupBy("dataset_dir", "name", "at", "old").agg(F.min(F.when(F.col("until") > F.col("at"), F.col("until"))).alias("until"))
    # the birth of the old name that a renaming continues: the last one before it, unless the name is there from the first file on
    b = born.select("dataset_dir", F.col("name").alias("old"), F.col("at").alias("old_at"))
    step = born.where("old is not null").join(b, ["dataset_dir", "old"], "left").groupBy("dataset_dir", "name", "at", "old", "until").agg(F.max(F.when(F.col("old_at") < F.col("at"), F.col("old_at"))).alias("old_at"))
    step = materialize(step, "renamings")
    for _ in range(40):
        nxt = step.select("dataset_dir", F.col("name").alias("old"), F.col("at").alias("old_at"), F.col("old").alias("old2"), F.col("old_at").alias("old_at2"), F.lit(True).alias("more"))
        jumped = step.join(nxt, ["dataset_dir", "old", "old_at"], "left")
        new = jumped.select("dataset_dir", "name", "at", F.when(F.col("more"), F.col("old2")).otherwise(F.col("old")).alias("old"), "until", F.when(F.col("more"), F.col("old_at2")).otherwise(F.col("old_at")).alias("old_at"), F.coalesce("more", F.lit(False)).alias("moved"))
        new = materialize(new, "renamings")
        step = new.drop("moved")
        if not new.where("moved").limit(1).count():
            break
    return step.select("dataset_dir", "name", F.col("old").alias("origin"), F.col("old_at").alias("origin_at"), F.col("at").alias("since"), "until")


def _kind(types: list[tuple[str, bool]]) -> str:
    """The common type of (dtype, is one value) spellings."""
    names = {t for t, _ in types}
    if names & {"string", "image", "video", ""} or not names:
        return "string"
    if not all(one for _, one in types):
        return "array<double>"
    if names == {"bool"}:
        return "boolean"
    if all(re.match(r"u?int\d*$", t) for t in names):
        return "bigint"
    return "double"


def _value(text: Column, kind: str) -> Column:
    """A JSON value's text as ``kind``; null where it can't be. Numbers may be strings."""
    if kind == "string":
        return text
    if kind == "array<double>":
        many = F.transform(F.from_json(text, "array<string>"), lambda x: x.try_cast("double"))
        one = F.when(text.try_cast("double").isNotNull(), F.array(text.try_cast("double")))
        return F.when(F.ltrim(text).startswith("["), many).otherwise(one)
    bare = F.when(F.ltrim(text).startswith("["), F.get(F.from_json(text, "array<string>"), F.lit(0))).otherwise(text)
    if kind == "bigint":
        return F.coalesce(bare.try_cast("bigint"), bare.try_cast("double").try_cast("bigint"))
    return bare.try_cast(kind)


def unified_records(raw_records: DataFrame, info_files: DataFrame, shape_meta: DataFrame, changes: DataFrame | None = None, max_columns: int = 2000) -> DataFrame:
    """All records in one table: ``file_id``, ``line_no``, ``dataset_dir``, ``is_corrupt`` and a column per feature.

    A feature's column has the name that the feature had first in its dataset, and the type that holds all its
    values: long, double, boolean, string or array of double. A line delivered twice counts once (a complete copy
    before a cut-off one); a cut-off line stays with ``is_corrupt`` and nulls; a value that isn't of its column's
    type is null; values of names that the file's features do not list are left out. More than ``max_columns`` columns
    are an error. Names are written with underscores; where two become the same, the later one gets a number, and so does a
    name that appears anew after the feature that had it was renamed.
    """
    files = materialize(_files(info_files), "files")
    changes = materialize(changes if changes is not None else schema_changes(info_files, shape_meta), "changes")
    origins = materialize(name_origins(changes, files), "origins")
    spelled = F.from_json("features", "map<string,struct<dtype:string,shape:string>>")
    listed = files.select("file_id", "dataset_dir", F.struct("written_at", "file_id").alias("at"), F.explode_outer(spelled).alias("name", "t")).where("name is not null")
    found = listed.join(origins, ["dataset_dir", "name"], "left").where("since is null or (at >= since and (until is null or at < until))")
    # a name can be renamed to more than once; rows outside of all its spans keep the name as it is
    named = listed.join(found.where("origin is not null").select("file_id", "name", "origin", "origin_at"), ["file_id", "name"], "left")
    # a name that was renamed away and then appears anew is another feature: the number of renamings before it came tells them apart
    away = changes.where("change = 'renamed'").join(files.select("file_id", "dataset_dir", F.struct("written_at", "file_id").alias("away_at")), "file_id").select("dataset_dir", F.col("old_name").alias("origin"), "away_at")
    named = named.withColumn("born", F.when(F.col("origin").isNull(), F.col("at")).otherwise(F.col("origin_at"))).withColumn("origin", F.coalesce("origin", "name"))
    number = named.select("dataset_dir", "origin", "born").where("born is not null").distinct().join(away, ["dataset_dir", "origin"]).where("away_at < born").groupBy("dataset_dir", "origin", "born").agg(F.count(F.lit(1)).alias("before"))
    named = named.join(number, ["dataset_dir", "origin", "born"], "left")
    named = named.withColumn("column", F.when(F.col("before") > 0, F.concat("origin", F.lit("~"), (F.col("before") + 1).cast("string"))).otherwise(F.col("origin")))
    dtype = F.regexp_replace(F.lower(F.trim(F.coalesce("t.dtype", F.lit("")))), r"^(torch|numpy|np|jnp|tf)\.", "")
    one = F.coalesce(F.regexp_extract_all(F.col("t.shape"), F.lit(r"([0-9]+)"), F.lit(1)) == F.array(F.lit("1")), F.lit(False))
    named = materialize(named.select("file_id", "dataset_dir", "name", "column", dtype.alias("dtype"), one.alias("one")), "names")
    types = named.groupBy("column").agg(F.collect_set(F.struct("dtype", "one")).alias("t")).orderBy("column").limit(max_columns + 1).collect()
    if len(types) > max_columns:
        raise ValueError(f"more than {max_columns} columns")
    per_file = named.groupBy("file_id", "dataset_dir", "column").agg(F.min("name").alias("name"))
    per_file = per_file.groupBy("file_id", "dataset_dir").agg(F.map_from_entries(F.collect_list(F.struct("column", "name"))).alias("names"))
    per_file = files.select("file_id").join(per_file, "file_id", "left").withColumn("dataset_dir", F.col("dataset_dir"))
    parsed = F.from_json("record", "map<string,string>")
    rows = raw_records.where("file_id is not null").select("file_id", "line_no", "record", parsed.alias("m"), "received_at")
    rows = rows.groupBy("file_id", "line_no").agg(F.min_by("record", F.struct(F.col("m").isNull().alias("bad"), F.col("received_at").isNull().alias("n"), "received_at", "record")).alias("record"))
    rows = hot_split_join(rows, per_file, "file_id", "left").withColumn("m", parsed)
    out, taken = [], {"file_id", "line_no", "dataset_dir", "is_corrupt"}
    for r in types:
        base = re.sub(r"[^0-9A-Za-z_]", "_", r["column"]).lower() or "_"
        name, k = base, 2
        while name in taken:
            name, k = f"{base}_{k}", k + 1
        taken.add(name)
        kind = _kind([(DTYPE_ALIASES.get(x["dtype"], x["dtype"]), x["one"]) for x in r["t"]])
        out.append(_value(F.col("m")[F.col("names")[F.lit(r["column"])]], kind).alias(name))
    return rows.select("file_id", "line_no", "dataset_dir", F.col("m").isNull().alias("is_corrupt"), *out)
