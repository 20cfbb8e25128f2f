"""The processing chain with its inverse, access to parts, and statistics by part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import normalize as N
from kinelake.functions import vectors as V
from kinelake.functions.chain import Chain, transforms
from kinelake.operators import statistics as st
from kinelake.operators.windows import clamped_shift
from kinelake.plans.analytics import finite
from kinelake.plans.base import RF, SQL_D, SQL_E, SQL_F, SQL_G, SQL_T, by_dimension, episodes, frames, ranked_frames, rf, typed_episodes
from kinelake.plans.registry import query
from kinelake.plans.transforms import _ST, norm_stats
from kinelake.tables import table

S = SparkSession
GAIN, FACTOR = 4.0, 2.0


def chain(base: str = "state") -> Chain:
    """Commands relative to the state, squeezed, scaled: what a configuration would list by name."""
    return Chain([transforms.build({"name": "relative"})(V.doubles(F.col(base))), transforms.build({"name": "arcsinh", "gain": GAIN})(), transforms.build({"name": "scale", "factor": FACTOR})()])


def _both(spark: S, d: str) -> DataFrame:
    """Frames with command and state of one width and of finite readings only."""
    x = frames(spark, d, "action", "state").where("action is not null and state is not null and size(action) = size(state) and size(action) > 0")
    return x.where(F.forall("action", lambda v: finite(v)) & F.forall("state", lambda v: finite(v)))


_BOTH = f"{SQL_F}, b AS (SELECT * FROM f WHERE len(action) = len(state) AND len(action) > 0 AND len(list_filter(action, lambda y: y IS NOT NULL AND isfinite(y))) = len(action) AND len(list_filter(state, lambda y: y IS NOT NULL AND isfinite(y))) = len(state)), l AS (SELECT global_index, CAST(unnest(action) AS DOUBLE) AS a, CAST(unnest(state) AS DOUBLE) AS s FROM b)"


@query("t9_chain", f"WITH {_BOTH} SELECT global_index, count(*) AS width, {rf('sum(2 * sign(a - s) * ln(abs(a - s) * 4 + sqrt((a - s) * (a - s) * 16 + 1)))')} AS total FROM l GROUP BY global_index")
def t9(spark: S, d: str) -> DataFrame:
    """The chain of transforms in order, with a check of the width at both ends."""
    y = _both(spark, d).select("global_index", chain().checked(V.doubles(F.col("action")), F.size("state")).alias("y")).where("y is not null")
    return y.select("global_index", F.size("y").cast("long").alias("width"), RF(V.total(F.col("y"))).alias("total"))


@query("t10_chain_undone", f"WITH {_BOTH} SELECT global_index, count(*) AS width, TRUE AS restored FROM l GROUP BY global_index")
def t10(spark: S, d: str) -> DataFrame:
    """The inverse steps in reverse order give the commands back, to twelve digits of the largest number that went in."""
    c = chain()
    a, s = V.doubles(F.col("action")), V.doubles(F.col("state"))
    y = _both(spark, d).select("global_index", a.alias("a"), s.alias("s"), c.backward(c.forward(a)).alias("back"))
    close = F.forall(F.arrays_zip("a", "s", "back"), lambda z: F.abs(z["a"] - z["back"]) <= 1e-12 * (1 + F.abs(z["a"]) + F.abs(z["s"])))
    return y.select("global_index", F.size("a").cast("long").alias("width"), close.alias("restored"))


_PART = "r AS (SELECT embodiment_type, part_key, dim, part_dim FROM joint_ranges)"
_MODE = "CASE WHEN part_key LIKE '%gripper' THEN 'min/max' WHEN part_key LIKE '%ee_pose' THEN 'z-score' ELSE 'q01/q99' END"
_SCALE = "CASE WHEN mode = 'none' THEN 1 WHEN mode = 'min/max' THEN CASE WHEN hi - lo < 1e-4 THEN 1 ELSE 2 / (hi - lo) END WHEN mode = 'z-score' THEN CASE WHEN hi - lo < 1e-4 THEN 1 ELSE 1 / (std + 1e-8) END ELSE CASE WHEN q99 - q01 < 1e-4 THEN 1 ELSE 2 / (q99 - q01) END END"
_OFFSET = "CASE WHEN mode = 'none' THEN 0 WHEN mode = 'min/max' THEN CASE WHEN hi - lo < 1e-4 THEN -lo ELSE -1 - lo * (2 / (hi - lo)) END WHEN mode = 'z-score' THEN -mean * (CASE WHEN hi - lo < 1e-4 THEN 1 ELSE 1 / (std + 1e-8) END) ELSE CASE WHEN q99 - q01 < 1e-4 THEN -q01 ELSE -1 - q01 * (2 / (q99 - q01)) END END"
_N1 = f"""{SQL_G}, {SQL_T}, {_ST}, {_PART}, {SQL_D.format('state')},
k AS (SELECT d.global_index, t.embodiment_type, r.part_key, d.dim, d.v, CASE WHEN s.lo IS NULL THEN 'none' ELSE {_MODE} END AS mode, s.lo, s.hi, s.mean, s.std, s.q01, s.q99
  FROM d JOIN t USING (episode_index) JOIN r ON r.embodiment_type = t.embodiment_type AND r.dim = d.dim LEFT JOIN s ON s.dataset_dir = t.dataset_dir AND s.field = 'state' AND s.dim = d.dim),
y AS (SELECT *, {_SCALE} AS sc, {_OFFSET} AS os FROM k), z AS (SELECT *, CASE WHEN v IS NULL THEN 0 ELSE least(greatest(v * sc + os, -5), 5) END AS y FROM y)"""


def _parts_normalized(spark: S, d: str) -> DataFrame:
    """States by frame and dimension with their part's mode, scale and offset, and the normalized value; dimensions without statistics stay as they are.

    A value that is missing or not finite becomes 0.
    """
    r = F.broadcast(table(spark, d, "joint_ranges").select("embodiment_type", "part_key", "dim", "part_dim"))
    x = by_dimension(frames(spark, d, "state"), "state").join(typed_episodes(spark, d, "dataset_dir"), "episode_index").join(r, ["embodiment_type", "dim"])
    x = x.join(norm_stats(spark, d).where("field = 'state'").drop("field", "embodiment_type"), ["dataset_dir", "dim"], "left")
    part = F.col("part_key")
    mode = F.when(F.col("lo").isNull(), "none").when(part.like("%gripper"), "min/max").when(part.like("%ee_pose"), "z-score").otherwise("q01/q99")
    x = x.withColumn("mode", mode)
    sc, os = F.lit(1.0), F.lit(0.0)
    for m in ("min/max", "z-score", "q01/q99"):
        a, b = N.scale_and_offset(m, {c: F.col(c) for c in ("lo", "hi", "mean", "std", "q01", "q99")})
        sc, os = F.when(F.col("mode") == m, a).otherwise(sc), F.when(F.col("mode") == m, b).otherwise(os)
    x = x.withColumn("sc", sc).withColumn("os", os)
    return x.withColumn("y", F.when(F.col("v").isNull(), 0.0).otherwise(N.forward(F.col("v"), F.col("sc"), F.col("os"))))


@query("n1_part_modes", f"WITH {_N1} SELECT embodiment_type, part_key, mode, count(*) AS n, count(v) AS usable, {rf('avg(y)')} AS mean, {rf('max(y)')} AS hi FROM z GROUP BY ALL")
def n1(spark: S, d: str) -> DataFrame:
    """States normalized by a mode for each part; a part without statistics is left as it is within the limits."""
    g = _parts_normalized(spark, d).groupBy("embodiment_type", "part_key", "mode")
    return g.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("usable"), RF(F.avg("y")).alias("mean"), RF(F.max("y")).alias("hi"))


@query("n7_denormalized", f"WITH {_N1} SELECT embodiment_type, part_key, count(*) AS n, {rf('sum(abs(v))')} AS size, {rf('max(v)')} AS hi FROM z WHERE v IS NOT NULL AND abs(v * sc + os) <= 5 GROUP BY ALL")
def n7(spark: S, d: str) -> DataFrame:
    """Normalized values taken back by the statistics of their own sample; within the limits the states come back."""
    x = _parts_normalized(spark, d).where(F.col("v").isNotNull() & (F.abs(F.col("v") * F.col("sc") + F.col("os")) <= 5))
    x = x.withColumn("back", N.backward(F.col("y"), F.col("sc"), F.col("os")))
    return x.groupBy("embodiment_type", "part_key").agg(F.count(F.lit(1)).alias("n"), RF(F.sum(F.abs("back"))).alias("size"), RF(F.max("back")).alias("hi"))


@query("t11_preprocessed", f"WITH {_N1} SELECT global_index, count(*) AS width, count(*) - count(v) AS missing, 16 - least(count(*), 16) AS filled, {rf('sum(CASE WHEN part_key LIKE ' + chr(39) + '%gripper' + chr(39) + ' THEN 0 ELSE y END)')} AS total FROM z GROUP BY global_index")
def t11(spark: S, d: str) -> DataFrame:
    """The whole way of a state: filter (grippers are left out), check for missing values, normalization, merging into sixteen places."""
    kept = F.when(F.col("part_key").like("%gripper"), 0.0).otherwise(F.col("y"))
    g = _parts_normalized(spark, d).groupBy("global_index").agg(F.count(F.lit(1)).alias("width"), (F.count(F.lit(1)) - F.count("v")).alias("missing"), RF(F.sum(kept)).alias("total"))
    return g.select("global_index", "width", "missing", (F.lit(16) - F.least("width", F.lit(16))).alias("filled"), "total")


# parts and their sources

_SRC = """p AS (SELECT DISTINCT file_id, category, part_key, coalesce(time_offset, 0) AS time_offset, unnest(names) AS source, generate_subscripts(names, 1) - 1 AS place
  FROM (SELECT file_id, category, part_key, time_offset, CASE WHEN lerobot_key LIKE '[%' THEN from_json(lerobot_key, '["VARCHAR"]') ELSE [lerobot_key] END AS names FROM shape_meta WHERE lerobot_key IS NOT NULL))"""


def sources(spark: S, d: str) -> DataFrame:
    """The source columns of each part of a file, one row each."""
    k = F.col("lerobot_key")
    names = F.when(k.startswith("["), F.from_json(k, "array<string>")).otherwise(F.array(k))
    x = table(spark, d, "shape_meta").where(k.isNotNull()).select("file_id", "category", "part_key", F.coalesce("time_offset", F.lit(0).cast("long")).alias("time_offset"), F.posexplode(names).alias("place", "source"))
    return x.withColumn("place", F.col("place").cast("long")).distinct()


@query("proj3_part_sources", f"WITH {_SRC} SELECT file_id, category, part_key, place, source FROM p GROUP BY ALL")
def proj3(spark: S, d: str) -> DataFrame:
    """One or many source columns of a part, in order."""
    return sources(spark, d).select("file_id", "category", "part_key", "place", "source").distinct()


@query("proj4_shared_offsets", f"""WITH {_SRC}, o AS (SELECT DISTINCT file_id, source, category, part_key, s AS step, time_offset + s AS off FROM p CROSS JOIN range(4) r(s))
SELECT file_id, source, category, part_key, step, dense_rank() OVER (PARTITION BY file_id, source ORDER BY off) - 1 AS position FROM o""")
def proj4(spark: S, d: str) -> DataFrame:
    """Offsets that parts ask of a source, each once, and where each part finds its own among them."""
    o = sources(spark, d).select("file_id", "source", "category", "part_key", "time_offset", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("step"))
    o = o.select("file_id", "source", "category", "part_key", "step", (F.col("time_offset") + F.col("step")).alias("off")).distinct()
    w = Window.partitionBy("file_id", "source").orderBy("off")
    return o.select("file_id", "source", "category", "part_key", "step", (F.dense_rank().over(w) - 1).cast("long").alias("position"))


@query("proj6_source_columns", f"WITH {_SRC}, m AS (SELECT file_id, source, min(struct_pack(a := category, b := part_key, c := place)) AS r FROM p WHERE category IN ('action', 'state') GROUP BY ALL) SELECT file_id, string_agg(source, ',' ORDER BY r, source) AS columns FROM m GROUP BY file_id")
def proj6(spark: S, d: str) -> DataFrame:
    """The distinct source columns that the wanted parts of a file need, by their first use; a file has a few dozen at most."""
    m = sources(spark, d).where("category in ('action', 'state')").groupBy("file_id", "source").agg(F.min(F.struct("category", "part_key", "place")).alias("r"))
    return m.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "source"))), lambda z: z["source"]), ",").alias("columns"))


@query("proj14_part_ahead", f"""WITH {SQL_G}, {SQL_T}, q AS (SELECT embodiment_type, part_key, min(dim) AS start, count(*) AS width FROM joint_ranges GROUP BY ALL)
SELECT a.global_index, q.part_key, q.width, len(b.action) >= q.start + q.width AS fits, {rf('list_sum(list_transform(list_filter(b.action[q.start + 1 : q.start + q.width], lambda y: isfinite(y)), lambda y: CAST(y AS DOUBLE)))')} AS total
FROM g a JOIN g b ON b.episode_index = a.episode_index AND b.rn = least(a.rn + 1, a.n - 1) JOIN t ON t.episode_index = a.episode_index JOIN q USING (embodiment_type) WHERE b.action IS NOT NULL""")
def proj14(spark: S, d: str) -> DataFrame:
    """Each part of the command one frame ahead, cut out of its vector, with a check of the width."""
    q = table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.min("dim").alias("start"), F.count(F.lit(1)).alias("width"))
    x = ranked_frames(spark, d, "action").select("global_index", "episode_index", clamped_shift("action", 1).alias("action")).where("action is not null")
    x = x.join(typed_episodes(spark, d), "episode_index").join(F.broadcast(q), "embodiment_type")
    own = F.filter(V.doubles(F.slice("action", F.col("start").cast("int") + 1, F.col("width").cast("int"))), lambda y: finite(y))
    return x.select("global_index", "part_key", "width", (F.size("action") >= F.col("start") + F.col("width")).alias("fits"), RF(F.when(F.size(own) > 0, V.total(own))).alias("total"))


@query("w10_part_pad_mask", f"WITH {SQL_G} SELECT global_index, count(*) FILTER (WHERE part = 'action' AND rn + s >= n) AS action_pads, count(*) FILTER (WHERE part = 'state' AND rn - s < 0) AS state_pads FROM g CROSS JOIN range(4) r(s) CROSS JOIN (VALUES ('action'), ('state')) v(part) GROUP BY global_index")
def w10(spark: S, d: str) -> DataFrame:
    """Padding of each part by the window of its first source: commands look ahead, states back."""
    steps = F.sequence(F.lit(0), F.lit(3))

    def pads(outside):
        return F.size(F.filter(steps, outside)).cast("long")

    return ranked_frames(spark, d).select("global_index", pads(lambda s: F.col("rn") + s >= F.col("n")).alias("action_pads"), pads(lambda s: F.col("rn") - s < 0).alias("state_pads"))


@query("w11_task_window", f"WITH {SQL_G} SELECT a.global_index, string_agg(coalesce(CAST(b.task_index AS VARCHAR), '-'), ' ' ORDER BY s.step) AS tasks FROM g a CROSS JOIN range(4) s(step) JOIN g b ON b.episode_index = a.episode_index AND b.rn = least(a.rn + s.step, a.n - 1) GROUP BY a.global_index")
def w11(spark: S, d: str) -> DataFrame:
    """The task over the window of the commands."""
    ahead = [F.coalesce((clamped_shift("task_index", k) if k else F.col("task_index")).cast("string"), F.lit("-")).alias(f"t{k}") for k in range(4)]
    return ranked_frames(spark, d, "task_index").select("global_index", *ahead).select("global_index", F.concat_ws(" ", "t0", "t1", "t2", "t3").alias("tasks"))


_A4 = f"""{SQL_G}, {SQL_T}, {SQL_D.format('action')}, b AS (SELECT a.global_index, a.episode_index, s.step, x.dim, x.v - CAST(a.state[x.dim + 1] AS DOUBLE) AS v
  FROM g a CROSS JOIN range(4) s(step) JOIN d x ON x.episode_index = a.episode_index AND x.rn = least(a.rn + s.step, a.n - 1) WHERE isfinite(a.state[x.dim + 1]) AND x.v IS NOT NULL),
k AS (SELECT embodiment_type, step, dim, count(*) AS n, min(v) AS lo, max(v) AS hi, avg(v) AS mean, stddev_pop(v) AS std FROM b JOIN t USING (episode_index) GROUP BY ALL)"""


def _chunk_statistics(spark: S, d: str) -> DataFrame:
    """Statistics by type, step and dimension of four commands ahead, relative to the anchor's state; every frame is an anchor.

    The command of a step is found by a shift inside of the episode; no chunk is built.
    """
    x = ranked_frames(spark, d, "action", "state")
    steps = F.array(*[F.struct(F.lit(k).cast("long").alias("step"), (clamped_shift("action", k)).alias("a")) for k in range(4)])
    x = x.withColumn("steps", steps).select("episode_index", "state", F.explode("steps").alias("z"))
    rel = F.transform("z.a", lambda v, i: v.cast("double") - F.get("state", i).cast("double"))
    x = x.select("episode_index", "z.step", F.posexplode(rel).alias("dim", "v")).where(finite(F.col("v"))).withColumn("dim", F.col("dim").cast("long"))
    return st.summarize(x.join(typed_episodes(spark, d), "episode_index"), ["embodiment_type", "step", "dim"])


@query("a4_chunk_statistics", f"WITH {_A4} SELECT embodiment_type, step, dim, n, {rf('lo')} AS lo, {rf('hi')} AS hi, {rf('mean')} AS mean, {rf('std')} AS std FROM k")
def a4(spark: S, d: str) -> DataFrame:
    """Plan, load, transform and aggregate: statistics of relative commands by step and dimension."""
    return _chunk_statistics(spark, d).select("embodiment_type", "step", "dim", "n", *[RF(F.col(c)).alias(c) for c in ("lo", "hi", "mean", "std")])


@query("a7_statistics_by_part", f"""WITH {_A4}, m AS (SELECT k.*, sum(n * mean) OVER w / sum(n) OVER w AS m FROM k WINDOW w AS (PARTITION BY embodiment_type, dim)),
o AS (SELECT embodiment_type, dim, CAST(sum(n) AS BIGINT) AS n, min(lo) AS lo, max(hi) AS hi, any_value(m) AS mean, sqrt(sum(n * (std * std + (mean - m) * (mean - m))) / sum(n)) AS std FROM m GROUP BY ALL)
SELECT embodiment_type, part_key, part_dim, n, {rf('lo')} AS lo, {rf('hi')} AS hi, {rf('mean')} AS mean, {rf('std')} AS std FROM o JOIN joint_ranges USING (embodiment_type, dim)""")
def a7(spark: S, d: str) -> DataFrame:
    """Statistics of all steps together from those by step, split by part."""
    k = _chunk_statistics(spark, d)
    w = Window.partitionBy("embodiment_type", "dim")
    k = k.withColumn("m", F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w))  # a few rows by type and dimension
    square = F.sum(F.col("n") * (F.pow("std", F.lit(2)) + F.pow(F.col("mean") - F.col("m"), F.lit(2))))
    o = k.groupBy("embodiment_type", "dim").agg(F.sum("n").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("m").alias("mean"), F.sqrt(square / F.sum("n")).alias("std"))
    r = F.broadcast(table(spark, d, "joint_ranges").select("embodiment_type", "dim", "part_key", "part_dim"))
    return o.join(r, ["embodiment_type", "dim"]).select("embodiment_type", "part_key", "part_dim", F.col("total").alias("n"), *[RF(F.col(c)).alias(c) for c in ("lo", "hi", "mean", "std")])


@query("a11_statistics_by_type", f"WITH {_ST} SELECT embodiment_type, field, dim, count(DISTINCT dataset_dir) AS sources, {rf('min(lo)')} AS lo, {rf('max(hi)')} AS hi FROM s GROUP BY ALL")
def a11(spark: S, d: str) -> DataFrame:
    """Stored statistics of all sources of a type together."""
    return norm_stats(spark, d).groupBy("embodiment_type", "field", "dim").agg(F.countDistinct("dataset_dir").alias("sources"), RF(F.min("lo")).alias("lo"), RF(F.max("hi")).alias("hi"))


@query("j6_dataset_number", f"""WITH {SQL_E}, c AS (SELECT dataset_dir, CAST(sum(length) AS BIGINT) AS n FROM e GROUP BY dataset_dir)
SELECT dataset_dir, row_number() OVER (ORDER BY dataset_dir) - 1 AS dataset_index, CAST(sum(n) OVER (ORDER BY dataset_dir) AS BIGINT) - n AS first_sample, n FROM c""")
def j6(spark: S, d: str) -> DataFrame:
    """Number of each dataset and its first sample; the windows run over one row per dataset."""
    c = episodes(spark, d).groupBy("dataset_dir").agg(F.sum("length").alias("n"))
    w = Window.orderBy("dataset_dir")
    return c.select("dataset_dir", (F.row_number().over(w) - 1).cast("long").alias("dataset_index"), (F.sum("n").over(w) - F.col("n")).alias("first_sample"), "n")
