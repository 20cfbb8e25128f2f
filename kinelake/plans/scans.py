"""Scans, bounds, paths, writers' arithmetic, projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import vectors as V
from kinelake.operators.windows import in_episode
from kinelake.operators import statistics as st
from kinelake.ordering import position_in_group
from kinelake.plans.base import R6, RF, SQL_E, SQL_F, SQL_G, SQL_T, episodes, frames, r6, ranked_frames, rf, typed_episodes
from kinelake.plans.registry import query
from kinelake.tables import table

S = SparkSession


@query("s1_scan_selected", f"WITH {SQL_E} SELECT DISTINCT global_index, f.episode_index, task_index FROM frames f SEMI JOIN (SELECT * FROM e WHERE length >= 100) x USING (episode_index)")
def s1(spark: S, d: str) -> DataFrame:
    """Column list and a predicate on episodes: only three columns are read, rows of long episodes are kept."""
    long_ones = table(spark, d, "episodes").where("length >= 100").select("episode_index").distinct()
    return table(spark, d, "frames").select("global_index", "episode_index", "task_index").join(long_ones, "episode_index", "left_semi").distinct()


@query("s4_required_rows", f"WITH {SQL_G} SELECT global_index, len(action) AS width, {rf('list_sum(list_transform(list_filter(action, lambda y: isfinite(y)), lambda y: CAST(y AS DOUBLE)))')} AS total FROM g WHERE rn IN (0, n // 2, n - 1)")
def s4(spark: S, d: str) -> DataFrame:
    """Rows by number, whole vectors: the first, middle and last frame of every episode."""
    x = ranked_frames(spark, d, "action").where("rn in (0, n div 2, n - 1)")
    ok = F.filter(V.doubles(F.col("action")), lambda y: ~F.isnan(y) & (F.abs(y) < float("inf")))
    return x.select("global_index", F.size("action").cast("long").alias("width"), RF(F.when(F.size(ok) > 0, V.total(ok))).alias("total"))


@query("s5_dataset_offsets", f"""WITH {SQL_E}, c AS (SELECT dataset_dir, sum(dataset_to_index - dataset_from_index) AS frames FROM e GROUP BY dataset_dir)
SELECT dataset_dir, CAST(frames AS BIGINT) AS frames, CAST(sum(frames) OVER (ORDER BY dataset_dir) - frames AS BIGINT) AS first_index FROM c""")
def s5(spark: S, d: str) -> DataFrame:
    """Global offset of every dataset in the order of names; the window runs over one row per dataset."""
    c = episodes(spark, d).groupBy("dataset_dir").agg(F.sum(F.col("dataset_to_index") - F.col("dataset_from_index")).alias("frames"))
    return c.withColumn("first_index", F.sum("frames").over(Window.orderBy("dataset_dir")) - F.col("frames"))


@query("s6_episode_rows", f"WITH {SQL_F} SELECT episode_index, count(*) AS n, min(global_index) AS first_index, max(global_index) AS last_index FROM f GROUP BY episode_index")
def s6(spark: S, d: str) -> DataFrame:
    """What each episode's file part holds."""
    return frames(spark, d).groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), F.min("global_index").alias("first_index"), F.max("global_index").alias("last_index"))


@query("s8_dictionary", "SELECT task_index, lower(trim(task)) AS name FROM tasks WHERE lower(trim(task)) NOT IN ('', 'null', 'none', 'nan', '-1')")
def s8(spark: S, d: str) -> DataFrame:
    """A dictionary of names, without spellings of no value."""
    return table(spark, d, "tasks").where(V.is_text(F.col("task"))).select("task_index", F.lower(F.trim("task")).alias("name"))


@query("s9_manifest", f"WITH {SQL_E} SELECT dataset_dir, min(episode_index) AS first_seen FROM e WHERE dataset_dir IN (SELECT dataset_dir FROM info_files) GROUP BY dataset_dir")
def s9(spark: S, d: str) -> DataFrame:
    """Datasets in the order they were first seen, only those that have an info file."""
    known = table(spark, d, "info_files").select("dataset_dir").distinct()
    return episodes(spark, d).join(known, "dataset_dir", "left_semi").groupBy("dataset_dir").agg(F.min("episode_index").alias("first_seen"))


@query("s14_episode_bounds", f"""WITH {SQL_E} SELECT dataset_dir, episode_index, CAST(sum(length) OVER w - length AS BIGINT) AS from_index, CAST(sum(length) OVER w AS BIGINT) AS to_index
FROM e WINDOW w AS (PARTITION BY dataset_dir ORDER BY episode_index)""")
def s14(spark: S, d: str) -> DataFrame:
    """Half-open range of every episode within its dataset, from the running sum of lengths."""
    w = Window.partitionBy("dataset_dir").orderBy("episode_index")
    return episodes(spark, d).select("dataset_dir", "episode_index", (F.sum("length").over(w) - F.col("length")).alias("from_index"), F.sum("length").over(w).alias("to_index"))


@query("s17_file_path", f"""WITH {SQL_E} SELECT episode_index, 'data/chunk-' || lpad(CAST(data_chunk_index AS VARCHAR), 3, '0') || '/file-' || lpad(CAST(data_file_index AS VARCHAR), 3, '0') || '.parquet' AS path,
'data/chunk-' || lpad(CAST(episode_index // 1000 AS VARCHAR), 3, '0') || '/episode_' || lpad(CAST(episode_index AS VARCHAR), 6, '0') || '.parquet' AS old_path FROM e""")
def s17(spark: S, d: str) -> DataFrame:
    """File of an episode: by pointer in the newer layout, by arithmetic in the older one."""

    def pad(c: str, n: int):
        return F.lpad(F.expr(c).cast("string"), n, "0")

    return episodes(spark, d).select(
        "episode_index", F.concat(F.lit("data/chunk-"), pad("data_chunk_index", 3), F.lit("/file-"), pad("data_file_index", 3), F.lit(".parquet")).alias("path"),
        F.concat(F.lit("data/chunk-"), pad("episode_index div 1000", 3), F.lit("/episode_"), pad("episode_index", 6), F.lit(".parquet")).alias("old_path"),
    )


@query("k1_default_timestamps", f"""WITH {SQL_G}, {SQL_T} SELECT g.global_index, g.rn AS frame_number, {r6('coalesce(CAST(g.timestamp_s AS DOUBLE), g.rn / CAST(m.fps AS DOUBLE))')} AS timestamp_s
FROM g JOIN t USING (episode_index) JOIN mixture m ON m.embodiment = t.embodiment""")
def k1(spark: S, d: str) -> DataFrame:
    """Frame numbers, and times by the frame rate where none was recorded."""
    m = F.broadcast(table(spark, d, "mixture").select("embodiment", "fps"))
    x = ranked_frames(spark, d, "timestamp_s").join(episodes(spark, d).select("episode_index", "embodiment"), "episode_index").join(m, "embodiment")
    return x.select("global_index", F.col("rn").cast("long").alias("frame_number"), R6(F.coalesce(F.col("timestamp_s").cast("double"), F.col("rn") / F.col("fps").cast("double"))).alias("timestamp_s"))


@query("k3_rolling_files", f"""WITH {SQL_E}, s AS (SELECT dataset_dir, episode_index, length, sum(length) OVER (PARTITION BY dataset_dir ORDER BY episode_index) - length AS before FROM e)
SELECT dataset_dir, CAST(before // 200 AS BIGINT) AS file_number, count(*) AS episodes, CAST(sum(length) AS BIGINT) AS frames FROM s GROUP BY dataset_dir, before // 200""")
def k3(spark: S, d: str) -> DataFrame:
    """Episodes appended to rolling files: a new file begins once 200 frames lie before."""
    w = Window.partitionBy("dataset_dir").orderBy("episode_index")
    s = episodes(spark, d).select("dataset_dir", "length", (F.sum("length").over(w) - F.col("length")).alias("before"))
    return s.groupBy("dataset_dir", F.expr("before div 200").alias("file_number")).agg(F.count(F.lit(1)).alias("episodes"), F.sum("length").alias("frames"))


@query("k5_chunk_index", "SELECT DISTINCT file_id, file_id // 1000 AS chunk, file_id % 1000 AS file FROM info_files")
def k5(spark: S, d: str) -> DataFrame:
    """Chunk and file number of the n-th file at 1000 files a chunk."""
    return table(spark, d, "info_files").select("file_id", F.expr("file_id div 1000").alias("chunk"), (F.col("file_id") % 1000).alias("file")).distinct()


@query("k6_task_registry", f"""WITH {SQL_E}, seen AS (SELECT DISTINCT unnest(tasks) AS task FROM e), new AS (SELECT task FROM seen WHERE task IS NOT NULL AND task NOT IN (SELECT task FROM tasks WHERE task IS NOT NULL))
SELECT task, (SELECT max(task_index) FROM tasks) + row_number() OVER (ORDER BY task) AS task_index FROM new""")
def k6(spark: S, d: str) -> DataFrame:
    """Tasks of episodes that the dictionary lacks, numbered on from its largest index."""
    known = table(spark, d, "tasks")
    new = episodes(spark, d).select(F.explode("tasks").alias("task")).where("task is not null").distinct().join(known.select("task"), "task", "left_anti")
    top = known.agg(F.max("task_index").alias("top"))
    numbered = position_in_group(new, [], ["task"], "k")
    return numbered.crossJoin(F.broadcast(top)).select("task", (F.col("top") + F.col("k") + 1).alias("task_index"))


@query("k8_stats_json", """SELECT dataset_dir, field, dim, round(CAST(json_extract(to_json({'min': stat_min, 'max': stat_max}), '$.min') AS DOUBLE), 6) + 0.0 AS low,
round(CAST(json_extract(to_json({'min': stat_min, 'max': stat_max}), '$.max') AS DOUBLE), 6) + 0.0 AS high FROM stats""")
def k8(spark: S, d: str) -> DataFrame:
    """Statistics written as JSON and read again."""
    text = F.to_json(F.struct(F.col("stat_min").alias("min"), F.col("stat_max").alias("max")))
    back = F.from_json(text, "min double, max double")
    return table(spark, d, "stats").select("dataset_dir", "field", "dim", R6(back["min"]).alias("low"), R6(back["max"]).alias("high"))


@query("k9_cache_key", f"""WITH {SQL_E} SELECT embodiment, sha256('{{"dataset_dirs":[' || string_agg('"' || dataset_dir || '"', ',' ORDER BY dataset_dir) || ']}}') AS cache_key
FROM (SELECT DISTINCT embodiment, dataset_dir FROM e) GROUP BY embodiment""")
def k9(spark: S, d: str) -> DataFrame:
    """The key of a statistics cache: a hash of the canonical JSON of what went in."""
    x = episodes(spark, d).groupBy("embodiment").agg(F.sort_array(F.collect_set("dataset_dir")).alias("dirs"))
    text = F.concat(F.lit('{"dataset_dirs":['), F.array_join(F.transform("dirs", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ","), F.lit("]}"))
    return x.select("embodiment", F.sha2(text, 256).alias("cache_key"))


@query("proj1_vector_slice", f"""WITH {SQL_F}, {SQL_T}, p AS (SELECT embodiment_type, part_key, min(dim) AS start, count(*) AS width FROM joint_ranges GROUP BY ALL)
SELECT global_index, part_key, len(state[start + 1:start + width]) AS width, {r6('CAST(state[start + 1] AS DOUBLE)')} AS first_value, {r6('CAST(state[start + width] AS DOUBLE)')} AS last_value
FROM f JOIN t USING (episode_index) JOIN p USING (embodiment_type) WHERE state IS NOT NULL AND isfinite(state[start + 1]) AND isfinite(state[start + width])""")
def proj1(spark: S, d: str) -> DataFrame:
    """Named slices of a vector column by the layout of its embodiment type."""
    p = table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.min("dim").cast("int").alias("start"), F.count(F.lit(1)).cast("int").alias("width"))
    x = frames(spark, d, "state").where("state is not null").join(typed_episodes(spark, d), "episode_index").join(F.broadcast(p), "embodiment_type")
    x = x.select("global_index", "part_key", F.slice("state", F.col("start") + 1, F.col("width")).alias("v"))
    a, b = F.get("v", F.lit(0)).cast("double"), F.element_at("v", -1).cast("double")
    finite = ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    return x.where(finite).select("global_index", "part_key", F.size("v").cast("long").alias("width"), R6(a).alias("first_value"), R6(b).alias("last_value"))


@query("proj2_multi_source", f"WITH {SQL_F} SELECT global_index, len(list_concat(action[1:2], state[1:3])) AS width, {r6('CAST(list_concat(action[1:2], state[1:3])[4] AS DOUBLE)')} AS fourth FROM f WHERE action IS NOT NULL AND state IS NOT NULL AND isfinite(state[2])")
def proj2(spark: S, d: str) -> DataFrame:
    """A part of two source columns: slices of both, one after the other."""
    v = F.concat(V.part(F.col("action"), 0, 2), V.part(F.col("state"), 0, 3))
    x = frames(spark, d, "action", "state").where("action is not null and state is not null").select("global_index", v.alias("v"))
    x = x.where(~F.isnan(F.get("v", F.lit(3))) & (F.abs(F.get("v", F.lit(3))) < float("inf")))
    return x.select("global_index", F.size("v").cast("long").alias("width"), R6(F.get("v", F.lit(3)).cast("double")).alias("fourth"))


@query("proj5_gather", f"WITH {SQL_F} SELECT global_index, action[3] AS a, action[1] AS b, action[2] AS c FROM f WHERE action IS NOT NULL AND isfinite(action[1]) AND isfinite(action[2]) AND isfinite(action[3])")
def proj5(spark: S, d: str) -> DataFrame:
    """Elements by position."""
    v = V.gather(F.col("action"), [2, 0, 1])
    ok = F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    x = frames(spark, d, "action").where("action is not null").select("global_index", v.alias("v"), ok.alias("ok")).where("ok")
    return x.select("global_index", *[F.get("v", F.lit(i)).alias(n) for i, n in enumerate("abc")])


@query("proj7_pass_through", "SELECT DISTINCT global_index, episode_index, frame_index, robot_id, task_index FROM frames")
def proj7(spark: S, d: str) -> DataFrame:
    """Columns that no vector part takes; which ones is computed from the schema."""
    x = table(spark, d, "frames")
    taken = ("action", "observation", "state", "timestamp_s", "received_at", "coarse_task_index", "quality_index")
    return x.select(*[c for c in x.columns if not any(c.startswith(t) for t in taken)]).distinct()


@query("proj9_pack_names", "SELECT embodiment_type, dim, [low, high][1] AS low, [low, high][2] AS high, len([low, high]) AS n FROM joint_ranges")
def proj9(spark: S, d: str) -> DataFrame:
    """Named scalars packed into one vector in the order of names."""
    v = F.array("low", "high")
    return table(spark, d, "joint_ranges").select("embodiment_type", "dim", F.get(v, F.lit(0)).alias("low"), F.get(v, F.lit(1)).alias("high"), F.size(v).cast("long").alias("n"))


@query("proj11_inverted_gripper", f"""WITH {SQL_F}, {SQL_T} SELECT global_index, dim, {r6('1 - CAST(action[dim + 1] AS DOUBLE)')} AS opening FROM f JOIN t USING (episode_index)
JOIN (SELECT embodiment_type, dim FROM joint_ranges WHERE part_key LIKE '%gripper') USING (embodiment_type) WHERE action IS NOT NULL AND isfinite(action[dim + 1])""")
def proj11(spark: S, d: str) -> DataFrame:
    """Gripper columns turned round: 1 - x."""
    g = F.broadcast(table(spark, d, "joint_ranges").where("part_key like '%gripper'").select("embodiment_type", "dim"))
    x = frames(spark, d, "action").where("action is not null").join(typed_episodes(spark, d), "episode_index").join(g, "embodiment_type")
    v = F.get("action", F.col("dim").cast("int")).cast("double")
    return x.where(~F.isnan(v) & (F.abs(v) < float("inf"))).select("global_index", "dim", R6(1 - v).alias("opening"))


@query("proj12_concat_split", f"WITH {SQL_F} SELECT global_index, len(action) + len(state) AS width, list_concat(action, state)[1:len(action)] = action AS first_back, list_concat(action, state)[len(action) + 1:] = state AS second_back FROM f WHERE action IS NOT NULL AND state IS NOT NULL")
def proj12(spark: S, d: str) -> DataFrame:
    """Vectors concatenated and split again."""
    v = F.concat("action", "state")
    n = F.size("action")
    return frames(spark, d, "action", "state").where("action is not null and state is not null").select(
        "global_index", F.size(v).cast("long").alias("width"), (F.slice(v, F.lit(1), n) == F.col("action")).alias("first_back"), (F.slice(v, n + 1, F.size("state")) == F.col("state")).alias("second_back")
    )


@query("proj13_reorder", f"""WITH {SQL_F}, {SQL_T} SELECT global_index, {r6('CAST(list_concat(state[9:10], state[8:8])[1] AS DOUBLE)')} AS x0, {r6('CAST(list_concat(state[9:10], state[8:8])[3] AS DOUBLE)')} AS x2
FROM f JOIN t USING (episode_index) WHERE embodiment_type = 'rovarm_b9' AND state IS NOT NULL AND isfinite(state[8]) AND isfinite(state[9])""")
def proj13(spark: S, d: str) -> DataFrame:
    """The lower body's parts exchanged: base and trunk become trunk and base."""
    x = frames(spark, d, "state").where("state is not null").join(typed_episodes(spark, d).where("embodiment_type = 'rovarm_b9'"), "episode_index")
    v = V.rotate(V.part(F.col("state"), 7, 3), 1)
    ok = [~F.isnan(F.get("v", F.lit(i))) & (F.abs(F.get("v", F.lit(i))) < float("inf")) for i in (0, 2)]
    return x.select("global_index", v.alias("v")).where(ok[0] & ok[1]).select("global_index", R6(F.get("v", F.lit(0)).cast("double")).alias("x0"), R6(F.get("v", F.lit(2)).cast("double")).alias("x2"))


@query("proj15_split_by_parts", """WITH v AS (SELECT vec_id, embedding AS x FROM embeddings) SELECT vec_id, p.part, """ + r6("list_sum(list_transform(x[p.s:p.e], lambda y: CAST(y AS DOUBLE)))") + """ AS total
FROM v CROSS JOIN (VALUES ('left_control', 1, 9), ('left_gripper', 10, 10), ('right_control', 11, 19), ('right_gripper', 20, 20), ('lower_body', 21, 27)) p(part, s, e)""")
def proj15(spark: S, d: str) -> DataFrame:
    """A flat vector cut by an ordered layout of widths."""
    layout = {"left_control": 9, "left_gripper": 1, "right_control": 9, "right_gripper": 1, "lower_body": 7}
    cut = V.parts(V.doubles(F.col("embedding")), list(layout.values()))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), V.total(c).alias("total")) for k, c in zip(layout, cut)])).alias("z")
    return table(spark, d, "embeddings").select("vec_id", rows).select("vec_id", "z.part", R6(F.col("z.total")).alias("total"))


@query("f1_success_filter", f"""WITH {SQL_F}, {SQL_E}, ok AS (SELECT dataset_dir, episode_index FROM e WHERE lower(is_episode_successful) IN ('true', '1')), has AS (SELECT DISTINCT dataset_dir FROM ok),
kept AS (SELECT episode_index FROM ok UNION ALL SELECT episode_index FROM e WHERE dataset_dir NOT IN (SELECT dataset_dir FROM has))
SELECT episode_index, count(*) AS frames FROM f SEMI JOIN kept USING (episode_index) GROUP BY episode_index""")
def f1(spark: S, d: str) -> DataFrame:
    """Frames of successful episodes; a dataset without any successful one keeps all of its episodes."""
    e = episodes(spark, d).select("dataset_dir", "episode_index", F.coalesce(F.lower("is_episode_successful").isin("true", "1"), F.lit(False)).alias("ok"))
    has = e.where("ok").select("dataset_dir").distinct().withColumn("has", F.lit(True))
    kept = e.join(has, "dataset_dir", "left").where("ok or has is null").select("episode_index")
    return frames(spark, d).join(kept, "episode_index", "left_semi").groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"))


@query("f2_quality_gate", f"WITH {SQL_F} SELECT episode_index, count(*) AS kept FROM f WHERE coalesce(quality_index, 1) >= 1 GROUP BY episode_index")
def f2(spark: S, d: str) -> DataFrame:
    """Quality gate; a frame without a mark passes."""
    return frames(spark, d, "quality_index").where(F.coalesce("quality_index", F.lit(1)) >= 1).groupBy("episode_index").agg(F.count(F.lit(1)).alias("kept"))


_MOVED = "sqrt(pow(a1 - p1, 2) + pow(a2 - p2, 2) + pow(a3 - p3, 2))"
_F3 = f"""{SQL_G}, s AS (SELECT episode_index, rn, n, CAST(action[1] AS DOUBLE) AS a1, CAST(action[2] AS DOUBLE) AS a2, CAST(action[3] AS DOUBLE) AS a3 FROM g),
l AS (SELECT *, lag(a1) OVER w AS p1, lag(a2) OVER w AS p2, lag(a3) OVER w AS p3 FROM s WINDOW w AS (PARTITION BY episode_index ORDER BY rn)),
first AS (SELECT episode_index, coalesce(min(CASE WHEN {_MOVED} > 0.02 AND isfinite({_MOVED}) THEN rn END), max(n) - 1) AS start FROM l GROUP BY episode_index)"""


def _starts(spark: S, d: str) -> tuple[DataFrame, DataFrame]:
    g = ranked_frames(spark, d, "action")
    a = [F.get("action", F.lit(i)).cast("double") for i in range(3)]
    s = g.select("global_index", "episode_index", "frame_index", "rn", "n", *[x.alias(f"a{i}") for i, x in enumerate(a)])
    moved = F.sqrt(sum((F.pow(F.col(f"a{i}") - F.lag(f"a{i}").over(in_episode()), 2) for i in range(3)), F.lit(0.0)))
    s = s.withColumn("moved", moved)
    go = (F.col("moved") > 0.02) & ~F.isnan("moved") & (F.col("moved") < float("inf"))
    return s, s.groupBy("episode_index").agg(F.coalesce(F.min(F.when(go, F.col("rn"))), F.max("n") - 1).alias("start"))


@query("f3_trim_static_prefix", f"WITH {_F3} SELECT episode_index, CAST(start AS BIGINT) AS start FROM first")
def f3(spark: S, d: str) -> DataFrame:
    """The first frame at which the command moves by more than a threshold; the last one if it never does."""
    return _starts(spark, d)[1].select("episode_index", F.col("start").cast("long").alias("start"))


@query("f4_dense_index", f"WITH {_F3} SELECT g.global_index, g.rn - start AS dense FROM g JOIN first USING (episode_index) WHERE g.rn >= start")
def f4(spark: S, d: str) -> DataFrame:
    """Frames after the static prefix, numbered again within their episode."""
    s, first = _starts(spark, d)
    return s.join(first, "episode_index").where("rn >= start").select("global_index", (F.col("rn") - F.col("start")).cast("long").alias("dense"))


@query("f5_split_by_episode", f"""WITH {SQL_E}, c AS (SELECT dataset_dir, episode_index, row_number() OVER (PARTITION BY dataset_dir ORDER BY episode_index) AS k, count(*) OVER (PARTITION BY dataset_dir) AS n FROM e)
SELECT dataset_dir, episode_index, CASE WHEN k <= greatest(1, CAST(floor(n * 0.95) AS BIGINT)) THEN 'train' ELSE 'val' END AS split FROM c""")
def f5(spark: S, d: str) -> DataFrame:
    """Train and validation by episode within each dataset; at least one episode trains."""
    w = Window.partitionBy("dataset_dir")
    c = episodes(spark, d).select("dataset_dir", "episode_index", F.row_number().over(w.orderBy("episode_index")).alias("k"), F.count(F.lit(1)).over(w).alias("n"))
    return c.select("dataset_dir", "episode_index", F.when(F.col("k") <= F.greatest(F.lit(1), F.floor(F.col("n") * 0.95)), "train").otherwise("val").alias("split"))


@query("f6_episodes_in_range", f"WITH {SQL_E}, b AS (SELECT max(dataset_to_index) // 4 AS lo, 3 * (max(dataset_to_index) // 4) AS hi FROM e) SELECT episode_index FROM e, b WHERE dataset_from_index >= lo AND dataset_to_index <= hi")
def f6(spark: S, d: str) -> DataFrame:
    """Episodes wholly inside a range of frames: the middle half."""
    e = episodes(spark, d)
    b = e.agg(F.expr("max(dataset_to_index) div 4").alias("q"))
    return e.crossJoin(F.broadcast(b)).where("dataset_from_index >= q and dataset_to_index <= 3 * q").select("episode_index")


@query("f7_first_per_group", f"WITH {SQL_E} SELECT embodiment, dataset_dir FROM (SELECT embodiment, dataset_dir, row_number() OVER (PARTITION BY embodiment ORDER BY min(episode_index)) AS k FROM e GROUP BY embodiment, dataset_dir) WHERE k <= 3")
def f7(spark: S, d: str) -> DataFrame:
    """The first three datasets of each embodiment."""
    g = episodes(spark, d).groupBy("embodiment", "dataset_dir").agg(F.min("episode_index").alias("m"))
    return g.withColumn("k", F.row_number().over(Window.partitionBy("embodiment").orderBy("m"))).where("k <= 3").select("embodiment", "dataset_dir")


_TEXT = "({0} IS NOT NULL AND lower(trim({0})) NOT IN ('', 'null', 'none', 'nan', '-1'))"


@query("f8_required_fields", f"WITH {SQL_E} SELECT episode_index FROM e WHERE {_TEXT.format('operator')} AND {_TEXT.format('recording')} AND {_TEXT.format('is_episode_successful')}")
def f8(spark: S, d: str) -> DataFrame:
    """Episodes that have all required fields; spellings of no value do not count."""
    return episodes(spark, d).where(V.is_text(F.col("operator")) & V.is_text(F.col("recording")) & V.is_text(F.col("is_episode_successful"))).select("episode_index")


@query("f9_valid_json", "SELECT file_id, line_no, bool_or(json_valid(record)) AS valid FROM raw_records GROUP BY file_id, line_no")
def f9(spark: S, d: str) -> DataFrame:
    """Which records are complete JSON objects."""
    ok = F.from_json("record", "map<string,string>").isNotNull()
    return table(spark, d, "raw_records").groupBy("file_id", "line_no").agg(F.max(ok).alias("valid"))


@query("f10_nan_report", f"""WITH {SQL_F}, x AS (SELECT robot_id, 'action' AS field, unnest(action) AS v FROM f UNION ALL SELECT robot_id, 'state', unnest(state) FROM f)
SELECT robot_id, field, count(*) FILTER (WHERE isnan(v)) AS n_nan, count(*) FILTER (WHERE isinf(v)) AS n_inf FROM x GROUP BY ALL""")
def f10(spark: S, d: str) -> DataFrame:
    """NaN and infinite values by robot and field; counted inside the arrays, so nothing is exploded."""
    def bad(c: str, test):
        return F.sum(F.size(F.filter(c, test)).cast("long"))

    f = frames(spark, d, "robot_id", "action", "state")
    out = None
    for c in ("action", "state"):
        g = f.where(F.col(c).isNotNull()).groupBy("robot_id").agg(bad(c, F.isnan).alias("n_nan"), bad(c, lambda x: ~F.isnan(x) & (F.abs(x) == float("inf"))).alias("n_inf")).withColumn("field", F.lit(c))
        out = g if out is None else out.unionByName(g)
    return out


@query("f11_timestamp_gaps", f"""WITH {SQL_F}, {SQL_E}, x AS (SELECT f.episode_index, f.frame_index, e.embodiment, CAST(timestamp_s AS DOUBLE) - lag(CAST(timestamp_s AS DOUBLE)) OVER (PARTITION BY f.episode_index ORDER BY f.frame_index) AS step FROM f JOIN e USING (episode_index) WHERE timestamp_s IS NOT NULL)
SELECT episode_index, count(*) AS gaps, {r6('max(step)')} AS longest FROM x JOIN mixture m USING (embodiment) WHERE abs(step - 1.0 / m.fps) > 0.002 GROUP BY episode_index""")
def f11(spark: S, d: str) -> DataFrame:
    """Steps between frames that differ from the frame rate's by more than a tolerance."""
    m = F.broadcast(table(spark, d, "mixture").select("embodiment", "fps"))
    x = frames(spark, d, "timestamp_s").where("timestamp_s is not null").withColumn("ts", F.col("timestamp_s").cast("double"))
    x = x.withColumn("step", F.col("ts") - F.lag("ts").over(in_episode())).join(episodes(spark, d).select("episode_index", "embodiment"), "episode_index").join(m, "embodiment")
    return x.where(F.abs(F.col("step") - 1.0 / F.col("fps")) > 0.002).groupBy("episode_index").agg(F.count(F.lit(1)).alias("gaps"), R6(F.max("step")).alias("longest"))


@query("f12_offsets_on_grid", "SELECT embodiment, step, abs(step * 0.1 * fps - round_even(step * 0.1 * fps, 0)) <= 0.001 AS on_grid FROM mixture CROSS JOIN range(-5, 6) s(step)")
def f12(spark: S, d: str) -> DataFrame:
    """Which time offsets are multiples of the frame interval."""
    x = table(spark, d, "mixture").select("embodiment", "fps", F.explode(F.sequence(F.lit(-5).cast("long"), F.lit(5).cast("long"))).alias("step"))
    v = F.col("step") * F.lit(0.1) * F.col("fps")
    return x.select("embodiment", "step", (F.abs(v - F.bround(v, 0)) <= 0.001).alias("on_grid"))


@query("f13_width_check", f"""WITH {SQL_F}, {SQL_T}, w AS (SELECT embodiment_type, count(*) AS want FROM joint_ranges GROUP BY embodiment_type)
SELECT embodiment_type, count(*) FILTER (WHERE action IS NULL) AS no_action, count(*) FILTER (WHERE state IS NULL) AS no_state, count(*) FILTER (WHERE len(action) <> want OR len(state) <> want) AS wrong
FROM f JOIN t USING (episode_index) JOIN w USING (embodiment_type) GROUP BY embodiment_type""")
def f13(spark: S, d: str) -> DataFrame:
    """Conformance of vectors to the width of their layout."""
    w = F.broadcast(table(spark, d, "joint_ranges").groupBy("embodiment_type").agg(F.count(F.lit(1)).alias("want")))
    x = frames(spark, d, "action", "state").join(typed_episodes(spark, d), "episode_index").join(w, "embodiment_type")
    wrong = (F.col("action").isNotNull() & (F.size("action") != F.col("want"))) | (F.col("state").isNotNull() & (F.size("state") != F.col("want")))

    def n(c):
        return F.sum(c.cast("long"))

    return x.groupBy("embodiment_type").agg(n(F.col("action").isNull()).alias("no_action"), n(F.col("state").isNull()).alias("no_state"), n(wrong).alias("wrong"))


@query("f14_error_registry", """WITH b AS (SELECT file_id, line_no, received_at FROM raw_records WHERE NOT json_valid(record))
SELECT file_id, count(*) AS errors, arg_min(line_no, struct_pack(a := received_at, b := line_no)) AS first_line FROM b GROUP BY file_id""")
def f14(spark: S, d: str) -> DataFrame:
    """Broken records by file: how many, and the first one that came in."""
    b = table(spark, d, "raw_records").where(F.from_json("record", "map<string,string>").isNull())
    return b.groupBy("file_id").agg(F.count(F.lit(1)).alias("errors"), F.min_by("line_no", F.struct("received_at", "line_no")).alias("first_line"))


@query("f15_missing_episodes", "SELECT DISTINCT parent_episode_index AS episode_index FROM episodes WHERE parent_episode_index IS NOT NULL AND parent_episode_index NOT IN (SELECT episode_index FROM episodes)")
def f15(spark: S, d: str) -> DataFrame:
    """Episodes that are referred to and absent."""
    e = table(spark, d, "episodes")
    return e.select(F.col("parent_episode_index").alias("episode_index")).where("episode_index is not null").distinct().join(e.select("episode_index"), "episode_index", "left_anti")


@query("f16_overfit_subset", f"WITH {SQL_F}, {SQL_E} SELECT dataset_dir, global_index FROM (SELECT dataset_dir, global_index, row_number() OVER (PARTITION BY dataset_dir ORDER BY global_index) AS k FROM f JOIN e USING (episode_index) WHERE coalesce(quality_index, 1) >= 1) WHERE k <= 16")
def f16(spark: S, d: str) -> DataFrame:
    """The first 16 qualified frames of each dataset; the limit per group keeps the window's sort small."""
    x = frames(spark, d, "quality_index").where(F.coalesce("quality_index", F.lit(1)) >= 1).join(episodes(spark, d).select("episode_index", "dataset_dir"), "episode_index")
    return x.withColumn("k", F.row_number().over(Window.partitionBy("dataset_dir").orderBy("global_index"))).where("k <= 16").select("dataset_dir", "global_index")


@query("f17_full_mask", f"WITH {SQL_F} SELECT global_index, len(action) AS width, len(list_filter(action, lambda y: y IS NOT NULL AND isfinite(y))) AS usable FROM f WHERE action IS NOT NULL")
def f17(spark: S, d: str) -> DataFrame:
    """The filter that leaves every dimension of a command active, and how many of them have a reading that can be used."""
    x = frames(spark, d, "action").where("action is not null")
    active = F.transform("action", lambda _: F.lit(True))
    usable = F.zip_with(active, F.col("action"), lambda m, y: m & y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    return x.select("global_index", F.size(active).cast("long").alias("width"), F.size(F.filter(usable, lambda m: m)).cast("long").alias("usable"))


@query("f19_thresholds", "SELECT embodiment_type, part_key, dim, CAST(CASE WHEN part_key LIKE '%gripper' THEN 0.05 WHEN part_key = 'lower_body' THEN 0.01 WHEN part_key LIKE '%ee_pose' THEN 0.002 ELSE 0.005 END AS DOUBLE) AS threshold FROM joint_ranges")
def f19(spark: S, d: str) -> DataFrame:
    """The threshold of motion of each part by its kind."""
    k = F.col("part_key")
    t = F.when(k.like("%gripper"), 0.05).when(k == "lower_body", 0.01).when(k.like("%ee_pose"), 0.002).otherwise(0.005)
    return table(spark, d, "joint_ranges").select("embodiment_type", "part_key", "dim", t.alias("threshold"))


@query("f21_unit_guess", f"""WITH {SQL_F}, x AS (SELECT robot_id, unnest(action) AS v FROM f), m AS (SELECT robot_id, list_sort(list(abs(CAST(v AS DOUBLE))))[CAST(floor(0.9 * (count(*) - 1)) AS BIGINT) + 1] AS q FROM x WHERE v IS NOT NULL AND isfinite(v) GROUP BY robot_id)
SELECT robot_id, CASE WHEN q <= 1.5 THEN 'normalized' WHEN q > 10 THEN 'degrees' ELSE 'radians' END AS unit FROM m""")
def f21(spark: S, d: str) -> DataFrame:
    """A guess at a robot's unit from the size of its commands."""
    x = frames(spark, d, "robot_id", "action").select("robot_id", F.explode("action").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    q = st.order_statistics(x.select("robot_id", F.abs(F.col("v").cast("double")).alias("v")), ["robot_id"], [("q", 0.9)])
    return q.select("robot_id", F.when(F.col("q") <= 1.5, "normalized").when(F.col("q") > 10, "degrees").otherwise("radians").alias("unit"))
