"""Further queries: active masks, codes of sequences, clusters, tails, prompts with boxes, episode writing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import normalize as N
from kinelake.functions import vectors as V
from kinelake.functions.sequences import RunCode, repaired
from kinelake.operators.codebook import lloyd
from kinelake.plans.analytics import finite
from kinelake.plans.base import RF, SQL_D, SQL_E, SQL_F, SQL_G, SQL_T, by_dimension, episodes, frames, ranked_frames, rf, typed_episodes
from kinelake.plans.registry import query
from kinelake.plans.transforms import _BOX, _LOC, _ST, _loc, boxes, norm_stats
from kinelake.tables import table

S = SparkSession


@query("f18_active_mask", f"""WITH {SQL_G}, {SQL_D.format('action')}
SELECT a.global_index, a.dim, max(CASE WHEN b.v IS NOT NULL AND a.v IS NOT NULL AND abs(b.v - a.v) >= 0.01 THEN 1 ELSE 0 END) = 1 AS active
FROM d a CROSS JOIN range(4) s(step) JOIN d b ON b.episode_index = a.episode_index AND b.dim = a.dim AND b.rn = least(a.rn + s.step, a.n - 1) GROUP BY a.global_index, a.dim""")
def f18(spark: S, d: str) -> DataFrame:
    """Whether a dimension moves in the first half of a chunk of eight, against its first step; every dimension of the episode."""
    x = by_dimension(ranked_frames(spark, d, "action"), "action")
    ahead = Window.partitionBy("episode_index", "dim").orderBy("rn").rowsBetween(0, 3)
    far = F.greatest(F.max("v").over(ahead) - F.col("v"), F.col("v") - F.min("v").over(ahead))
    return x.select("global_index", "dim", F.coalesce(far >= 0.01, F.lit(False)).alias("active"))


@query("q7_inactive_keys", f"""WITH {SQL_F}, {SQL_T}, x AS (SELECT f.episode_index, j.part_key, CAST(action[j.dim + 1] AS DOUBLE) >= 0.5 AS b FROM f JOIN t USING (episode_index) JOIN (SELECT * FROM joint_ranges WHERE part_key LIKE '%gripper') j USING (embodiment_type) WHERE action IS NOT NULL AND isfinite(action[j.dim + 1]))
SELECT episode_index, part_key, count(DISTINCT b) < 2 AS inactive FROM x GROUP BY ALL""")
def q7(spark: S, d: str) -> DataFrame:
    """Keys that never change after binarization; the two values are compared, not counted apart."""
    j = F.broadcast(table(spark, d, "joint_ranges").where("part_key like '%gripper'").select("embodiment_type", "part_key", "dim"))
    x = frames(spark, d, "action").where("action is not null").join(typed_episodes(spark, d), "episode_index").join(j, "embodiment_type")
    v = F.get("action", F.col("dim").cast("int")).cast("double")
    x = x.where(finite(v)).select("episode_index", "part_key", (v >= 0.5).alias("b"))
    return x.groupBy("episode_index", "part_key").agg((F.min("b") == F.max("b")).alias("inactive"))


@query("q2_run_codes")
def q2(spark: S, d: str) -> DataFrame:
    """The grip of each 16 frames of an episode as one number: runs of one frame are repaired, then the sequence is ranked.

    The episode's last frame fills up its last chunk.
    """
    code = RunCode(16, 1)

    @F.pandas_udf("long")
    def rank(bits: pd.Series) -> pd.Series:
        return pd.Series([code.rank(repaired([int(x) for x in b], 1)) for b in bits])

    grip = F.coalesce((F.element_at("action", -1) >= 0.5).cast("int"), F.lit(0))
    g = ranked_frames(spark, d, "action").select("episode_index", F.expr("rn div 16").alias("chunk"), "rn", grip.alias("b"))
    seq = g.groupBy("episode_index", "chunk").agg(F.array_sort(F.collect_list(F.struct("rn", "b"))).alias("s"))
    bits = F.transform("s", lambda x: x["b"])
    full = F.concat(bits, F.array_repeat(F.element_at(bits, -1), F.lit(16) - F.size("s")))
    return seq.select("episode_index", "chunk", rank(full).alias("code"))


@query("q4_codebook_clusters")
def q4(spark: S, d: str) -> DataFrame:
    """A codebook of sixteen entries by Lloyd's rounds, and how many vectors each holds; an entry without vectors stays where it is."""
    x = table(spark, d, "embeddings").select("vec_id", V.doubles(F.col("embedding")).alias("x"))
    return lloyd(x, "vec_id", 16, 10).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("m2_aligned_parts", f"WITH {SQL_F} SELECT global_index, least(len(state), 8) AS kept, greatest(8 - len(state), 0) AS filled FROM f WHERE state IS NOT NULL")
def m2(spark: S, d: str) -> DataFrame:
    """Vectors cut or filled up to eight places, with the mask."""
    x = frames(spark, d, "state").where("state is not null")
    filled = F.size(F.filter(V.pad_mask(F.col("state"), 8), lambda m: m))
    return x.select("global_index", (F.size(V.pad_right(V.doubles(F.col("state")), 8)) - filled).cast("long").alias("kept"), filled.cast("long").alias("filled"))


@query("n5_tail_roundtrip", f"""WITH {_ST} SELECT dataset_dir, field, dim, {rf('q99 + greatest(abs(q99 - mean), 1e-3) * ln(1 + (hi + 1 - q99) / greatest(abs(q99 - mean), 1e-3))')} AS squeezed, {rf('hi + 1')} AS back FROM s WHERE hi + 1 > q99""")
def n5(spark: S, d: str) -> DataFrame:
    """Values beyond a quantile squeezed by a logarithm, and back."""
    x = norm_stats(spark, d).where("hi + 1 > q99")
    c = F.greatest(F.abs(F.col("q99") - F.col("mean")), F.lit(1e-3))
    y = N.tail_forward(F.col("hi") + 1, F.col("q01"), F.col("q99"), c)
    return x.select("dataset_dir", "field", "dim", RF(y).alias("squeezed"), RF(N.tail_backward(y, F.col("q01"), F.col("q99"), c)).alias("back"))


@query("b8_box_prompt", f"WITH {_BOX} SELECT doc_id, 'Command: find; BBox: object ' || {_LOC.format('b[2]')} || {_LOC.format('b[1]')} || {_LOC.format('b[4]')} || {_LOC.format('b[3]')} || '; Action: ' AS prompt FROM b")
def b8(spark: S, d: str) -> DataFrame:
    """A prompt with a box."""
    at = [F.get("b", F.lit(i)) for i in (1, 0, 3, 2)]
    return boxes(spark, d).select("doc_id", F.concat(F.lit("Command: find; BBox: object "), *[_loc(x) for x in at], F.lit("; Action: ")).alias("prompt"))


@query("b11_hint_prompt", f"WITH {SQL_E}, p AS (SELECT episode_index, tasks[1] AS task, CASE WHEN length > 60 THEN 'slow' ELSE 'quick' END AS hint FROM e) SELECT episode_index, 'Command: ' || task || '; Hint: ' || hint || '; Action: ' AS prompt FROM p WHERE task IS NOT NULL")
def b11(spark: S, d: str) -> DataFrame:
    """A prompt with a hint at how to act."""
    t = F.get("tasks", F.lit(0))
    hint = F.when(F.col("length") > 60, "slow").otherwise("quick")
    return episodes(spark, d).where(t.isNotNull()).select("episode_index", F.concat(F.lit("Command: "), t, F.lit("; Hint: "), hint, F.lit("; Action: ")).alias("prompt"))


@query("j13_loaded_positions", f"WITH {SQL_F} SELECT global_index, row_number() OVER (PARTITION BY episode_index ORDER BY global_index) - 1 AS position FROM f WHERE action IS NOT NULL")
def j13(spark: S, d: str) -> DataFrame:
    """The place of each loaded row, those with a command, among those of its episode."""
    x = frames(spark, d, "action").where("action is not null")
    return x.select("global_index", (F.row_number().over(Window.partitionBy("episode_index").orderBy("global_index")) - 1).cast("long").alias("position"))


@query("k2_saved_episodes", f"WITH {SQL_F}, {SQL_E} SELECT f.global_index, e.dataset_from_index + f.frame_index AS assigned, t.task FROM f JOIN e USING (episode_index) LEFT JOIN tasks t ON t.task_index = f.task_index")
def k2(spark: S, d: str) -> DataFrame:
    """Episodes as they are saved: global index from the episode's offset, tasks by name."""
    t = F.broadcast(table(spark, d, "tasks"))
    x = frames(spark, d, "task_index").join(episodes(spark, d).select("episode_index", "dataset_from_index"), "episode_index").join(t, "task_index", "left")
    return x.select("global_index", (F.col("dataset_from_index") + F.col("frame_index")).alias("assigned"), "task")


_Q = (("q00001", 0.00001), ("q0001", 0.0001), ("q001", 0.001), ("q01", 0.01), ("q99", 0.99), ("q999", 0.999), ("q9999", 0.9999), ("q99999", 0.99999))


@query("a8_quantile_ranks", f"WITH {SQL_F}, {SQL_T}, c AS (SELECT embodiment_type, count(*) AS n FROM f JOIN t USING (episode_index) GROUP BY ALL) SELECT embodiment_type, name, n, CAST(floor(q * (n - 1)) AS BIGINT) AS place FROM c CROSS JOIN (VALUES {', '.join(f'({chr(39)}{a}{chr(39)}, {b:.5f}::DOUBLE)' for a, b in _Q)}) v(name, q)")
def a8(spark: S, d: str) -> DataFrame:
    """The rank of each named quantile among the frames of a type."""
    n = frames(spark, d).join(typed_episodes(spark, d), "episode_index").groupBy("embodiment_type").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("name"), F.lit(b).alias("q")) for a, b in _Q])).alias("z")
    return n.select("embodiment_type", "n", each).select("embodiment_type", "z.name", "n", F.floor(F.col("z.q") * (F.col("n") - 1)).alias("place"))


@query("proj10_flat_struct", "SELECT DISTINCT file_id, category, part_key, raw_shape[1] AS raw_first, shape[1] AS shape_first FROM shape_meta")
def proj10(spark: S, d: str) -> DataFrame:
    """A nested record flattened to columns."""
    nested = table(spark, d, "shape_meta").select("file_id", F.struct("category", "part_key", F.struct(F.get("raw_shape", F.lit(0)).alias("raw_first"), F.get("shape", F.lit(0)).alias("shape_first")).alias("size")).alias("part"))
    return nested.select("file_id", "part.*").select("file_id", "category", "part_key", "size.*").distinct()
