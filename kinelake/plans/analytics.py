"""Lookups, aggregations, windows, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import vectors as V
from kinelake.operators import statistics as st
from kinelake.operators.windows import clamped_chunk, clamped_shift, in_episode
from kinelake.ordering import position_in_group, spread
from kinelake.plans.base import R6, RF, SQL_D, SQL_E, SQL_F, SQL_G, SQL_T, by_dimension, episodes, frames, r6, ranked_frames, rf, typed_episodes
from kinelake.plans.registry import query
from kinelake.tables import table

S = SparkSession


def finite(c):
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


# lookups


@query("j1_task_lookup", f"WITH {SQL_F} SELECT global_index, task FROM f JOIN tasks USING (task_index)")
def j1(spark: S, d: str) -> DataFrame:
    """Text of the task by its index; the dictionary is a fixed table."""
    return frames(spark, d, "task_index").join(F.broadcast(table(spark, d, "tasks")), "task_index").select("global_index", "task")


@query("j2_left_lookup_default", f"WITH {SQL_F} SELECT global_index, coalesce(task, '') AS coarse FROM f LEFT JOIN tasks ON tasks.task_index = f.coarse_task_index")
def j2(spark: S, d: str) -> DataFrame:
    """An optional lookup: a missing index or name gives an empty text."""
    t = F.broadcast(table(spark, d, "tasks").withColumnRenamed("task_index", "coarse_task_index"))
    return frames(spark, d, "coarse_task_index").join(t, "coarse_task_index", "left").select("global_index", F.coalesce("task", F.lit("")).alias("coarse"))


@query("j3_future_task", f"WITH {SQL_G} SELECT a.global_index, CASE WHEN a.rn + 16 < a.n THEN t.task END AS future FROM g a LEFT JOIN g b ON b.episode_index = a.episode_index AND b.rn = a.rn + 16 LEFT JOIN tasks t ON t.task_index = b.task_index")
def j3(spark: S, d: str) -> DataFrame:
    """The task 16 frames later, if the episode lasts that long."""
    x = ranked_frames(spark, d, "task_index").withColumn("later", F.lead("task_index", 16).over(in_episode()))
    t = F.broadcast(table(spark, d, "tasks").select(F.col("task_index").alias("later"), F.col("task").alias("future")))
    return x.join(t, "later", "left").select("global_index", "future")


@query("j4_frame_to_episode", f"WITH {SQL_E}, f AS (SELECT DISTINCT global_index FROM frames) SELECT f.global_index, e.episode_index FROM f JOIN e ON f.global_index >= e.dataset_from_index AND f.global_index < e.dataset_to_index")
def j4(spark: S, d: str) -> DataFrame:
    """Frame to episode by index range, as an equi-join: ranges are cut into buckets of 512 indexes."""
    e = episodes(spark, d).where("dataset_to_index > dataset_from_index").select("episode_index", "dataset_from_index", "dataset_to_index")
    e = e.withColumn("b", F.explode(F.sequence(F.expr("dataset_from_index div 512"), F.expr("(dataset_to_index - 1) div 512"))))
    f = table(spark, d, "frames").select("global_index").distinct().withColumn("b", F.expr("global_index div 512"))
    return f.join(e, "b").where("global_index >= dataset_from_index and global_index < dataset_to_index").select("global_index", "episode_index")


@query("j5_locate_sample", f"""WITH {SQL_E}, c AS (SELECT dataset_dir, CAST(sum(length) AS BIGINT) AS n FROM e GROUP BY dataset_dir), o AS (SELECT dataset_dir, CAST(sum(n) OVER (ORDER BY dataset_dir) - n AS BIGINT) AS start, n FROM c)
SELECT dataset_dir, start + i AS sample, i AS local FROM o, LATERAL (SELECT unnest(range(n)) AS i)""")
def j5(spark: S, d: str) -> DataFrame:
    """Every global sample number to dataset and local number, generated from each dataset's own range in pieces; the window runs over one row per dataset."""
    c = episodes(spark, d).groupBy("dataset_dir").agg(F.sum("length").alias("n"))
    o = c.withColumn("start", F.sum("n").over(Window.orderBy("dataset_dir")) - F.col("n"))
    return spread(o, "n", "local").select("dataset_dir", (F.col("start") + F.col("local")).alias("sample"), "local")


@query("j7_nearest_asof", """WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), b AS (SELECT event_id AS other, user_id, ts AS at FROM events WHERE event_type = 'click'),
n AS (SELECT a.event_id, b.other, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(epoch_us(a.ts) - epoch_us(b.at)), b.at DESC, b.other) AS k FROM a JOIN b ON a.user_id = b.user_id AND abs(epoch_us(a.ts) - epoch_us(b.at)) <= 86400000000)
SELECT event_id, other FROM n WHERE k = 1""")
def j7(spark: S, d: str) -> DataFrame:
    """The click nearest in time to each purchase of the same user, within a day; the later one wins a tie.

    Both streams are merged and sorted by user and time, once each way, so both frames grow by a row at a time: the nearest click is the last one before or the first one after.
    """
    e = table(spark, d, "events").where("event_type in ('purchase', 'click')").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    click = F.when(F.col("event_type") == "click", F.struct("us", "event_id"))
    back = Window.partitionBy("user_id").orderBy("us").rangeBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("user_id").orderBy(F.desc("us")).rangeBetween(Window.unboundedPreceding, 0)
    # among clicks of one time the smallest id counts
    key_b = F.when(F.col("event_type") == "click", F.struct("us", (-F.col("event_id")).alias("neg")))
    x = e.withColumn("b", F.max(key_b).over(back)).withColumn("a", F.min(click).over(ahead)).where("event_type = 'purchase'")
    db, da = F.col("us") - F.col("b.us"), F.col("a.us") - F.col("us")
    later = F.col("a").isNotNull() & (F.col("b").isNull() | (da <= db))
    other, dist = F.when(later, F.col("a.event_id")).otherwise(-F.col("b.neg")), F.when(later, da).otherwise(db)
    return x.select("event_id", other.alias("other"), dist.alias("dist")).where("other is not null and dist <= 86400000000").select("event_id", "other")


@query("j8_first_instruction", "SELECT lower(trim(task)) AS instruction, min(task_index) AS task_index FROM tasks WHERE task IS NOT NULL GROUP BY lower(trim(task))")
def j8(spark: S, d: str) -> DataFrame:
    """Distinct instructions; the first row of each wins."""
    return table(spark, d, "tasks").where("task is not null").groupBy(F.lower(F.trim("task")).alias("instruction")).agg(F.min("task_index").alias("task_index"))


@query("j9_override", f"WITH {SQL_E}, o AS (SELECT episode_index, max(text) AS text FROM documents WHERE doc_kind = 'task_instruction' AND episode_index IS NOT NULL GROUP BY episode_index) SELECT e.episode_index, coalesce(nullif(trim(o.text, ' '), ''), e.tasks[1]) AS instruction FROM e LEFT JOIN o USING (episode_index)")
def j9(spark: S, d: str) -> DataFrame:
    """An annotation takes the place of the task unless it is blank."""
    o = table(spark, d, "documents").where("doc_kind = 'task_instruction' and episode_index is not null").groupBy("episode_index").agg(F.max("text").alias("text"))
    return episodes(spark, d).join(o, "episode_index", "left").select("episode_index", F.coalesce(F.nullif(F.trim("text"), F.lit("")), F.get("tasks", F.lit(0))).alias("instruction"))


@query("j10_resolve_processor", "SELECT e.embodiment, coalesce(m.embodiment_type, e.embodiment, 'default') AS processor, count(DISTINCT e.episode_index) AS episodes FROM episodes e LEFT JOIN mixture m ON m.embodiment = e.embodiment GROUP BY ALL")
def j10(spark: S, d: str) -> DataFrame:
    """The processor of a source: by type, else by its own name, else the default."""
    m = F.broadcast(table(spark, d, "mixture").select("embodiment", "embodiment_type"))
    x = table(spark, d, "episodes").select("embodiment", "episode_index").join(m, "embodiment", "left")
    return x.groupBy("embodiment", F.coalesce("embodiment_type", "embodiment", F.lit("default")).alias("processor")).agg(F.countDistinct("episode_index").alias("episodes"))


@query("j11_layout_difference", """WITH a AS (SELECT embodiment_type, part_key, count(*) AS w FROM joint_ranges GROUP BY ALL), b AS (SELECT * FROM (VALUES ('left_arm', 6), ('left_gripper', 1), ('right_arm', 6), ('right_gripper', 1), ('torso', 4)) v(part_key, want)),
t AS (SELECT DISTINCT embodiment_type FROM joint_ranges)
SELECT t.embodiment_type, b.part_key, CASE WHEN w IS NULL THEN 'missing' WHEN w <> want THEN 'mismatch' ELSE 'same' END AS verdict FROM t CROSS JOIN b LEFT JOIN a ON a.embodiment_type = t.embodiment_type AND a.part_key = b.part_key
UNION ALL SELECT embodiment_type, part_key, 'extra' FROM a WHERE part_key NOT IN (SELECT part_key FROM b)""")
def j11(spark: S, d: str) -> DataFrame:
    """Each type's layout held against a model's: missing, extra and differing parts; both are fixed tables."""
    want = spark.createDataFrame([("left_arm", 6), ("left_gripper", 1), ("right_arm", 6), ("right_gripper", 1), ("torso", 4)], "part_key string, want long")
    r = table(spark, d, "joint_ranges")
    a = r.groupBy("embodiment_type", "part_key").agg(F.count(F.lit(1)).alias("w"))
    per = r.groupBy("embodiment_type").agg(F.collect_set("part_key").alias("have")).crossJoin(F.broadcast(want))
    x = per.join(a, ["embodiment_type", "part_key"], "left").select("embodiment_type", "part_key", F.when(F.col("w").isNull(), "missing").when(F.col("w") != F.col("want"), "mismatch").otherwise("same").alias("verdict"))
    return x.unionByName(a.join(F.broadcast(want), "part_key", "left_anti").select("embodiment_type", "part_key", F.lit("extra").alias("verdict")))


_CAM = r"lower(regexp_replace(regexp_replace(list_last(string_split(lerobot_key, '.')), '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g'))"


@query("j12_camera_slot", f"""WITH c AS (SELECT DISTINCT file_id, lerobot_key, {_CAM} AS cam FROM shape_meta WHERE category = 'images'),
p AS (SELECT *, CASE WHEN cam LIKE '%wrist%' THEN 'wrist' ELSE 'exterior' END AS slot, CASE WHEN cam LIKE 'head%' THEN 0 WHEN cam LIKE 'wrist%' THEN 1 ELSE 2 END AS priority FROM c)
SELECT file_id, slot, arg_min(lerobot_key, struct_pack(a := priority, b := lerobot_key)) AS camera FROM p GROUP BY file_id, slot""")
def j12(spark: S, d: str) -> DataFrame:
    """Camera names to slots; of several candidates the one of the lowest priority and name."""
    cam = V.camera_name(F.col("lerobot_key"))
    c = table(spark, d, "shape_meta").where("category = 'images'").select("file_id", "lerobot_key", cam.alias("cam")).distinct()
    slot = F.when(F.col("cam").contains("wrist"), "wrist").otherwise("exterior")
    rank = F.when(F.col("cam").startswith("head"), 0).when(F.col("cam").startswith("wrist"), 1).otherwise(2)
    return c.groupBy("file_id", slot.alias("slot")).agg(F.min_by("lerobot_key", F.struct(rank, "lerobot_key")).alias("camera"))


# aggregations

_L = "x AS (SELECT {k}, 'action' AS field, generate_subscripts(action, 1) - 1 AS dim, CAST(unnest(action) AS DOUBLE) AS v FROM {t} UNION ALL SELECT {k}, 'state', generate_subscripts(state, 1) - 1, CAST(unnest(state) AS DOUBLE) FROM {t})"
_LX = f"{SQL_F}, {_L.format(k='episode_index', t='f')}, y AS (SELECT * FROM x WHERE v IS NOT NULL AND isfinite(v))"


@query("a1_episode_stats", f"WITH {_LX} SELECT episode_index, field, CAST(dim AS BIGINT) AS dim, count(*) AS n, {rf('min(v)')} AS lo, {rf('max(v)')} AS hi, {rf('avg(v)')} AS mean, {rf('stddev_pop(v)')} AS std FROM y GROUP BY ALL")
def a1(spark: S, d: str) -> DataFrame:
    """Extremes, mean, deviation and count of each dimension by episode, of all finite readings."""
    s = st.summarize(st.long_form(frames(spark, d, "action", "state"), ["episode_index"]), ["episode_index", "field", "dim"])
    return s.select("episode_index", "field", "dim", "n", *[RF(F.col(c)).alias(c) for c in ("lo", "hi", "mean", "std")])


@query("a2_merged_partials", f"""WITH {_LX}, p AS (SELECT episode_index, field, dim, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std FROM y GROUP BY ALL), {SQL_T},
q AS (SELECT embodiment_type, field, dim, p.n, p.mean, p.std, sum(p.n * p.mean) OVER w / sum(p.n) OVER w AS m FROM p JOIN t USING (episode_index) WINDOW w AS (PARTITION BY embodiment_type, field, dim))
SELECT embodiment_type, field, CAST(dim AS BIGINT) AS dim, CAST(sum(n) AS BIGINT) AS n, {rf('any_value(m)')} AS mean, {rf('sqrt(sum(n * (std * std + (mean - m) * (mean - m))) / sum(n))')} AS std FROM q GROUP BY embodiment_type, field, dim""")
def a2(spark: S, d: str) -> DataFrame:
    """Episode statistics merged by count into those of each type, without going back to the readings."""
    p = st.summarize(st.long_form(frames(spark, d, "action", "state"), ["episode_index"]), ["episode_index", "field", "dim"])
    m, s = st.merged()
    return p.join(typed_episodes(spark, d), "episode_index").groupBy("embodiment_type", "field", "dim").agg(F.sum("n").alias("n"), RF(m).alias("mean"), RF(s).alias("std"))


@query("a3_episode_quantiles", f"""WITH {_LX}, {SQL_T}, p AS (SELECT episode_index, field, dim, quantile_cont(v, 0.01) AS q01, quantile_cont(v, 0.99) AS q99, stddev_samp(v) AS std, avg(v) AS mean FROM y GROUP BY ALL)
SELECT embodiment_type, field, CAST(dim AS BIGINT) AS dim, {rf('min(q01)')} AS q01, {rf('max(q99)')} AS q99, {rf('avg(mean)')} AS mean FROM p JOIN t USING (episode_index) GROUP BY embodiment_type, field, dim""")
def a3(spark: S, d: str) -> DataFrame:
    """Interpolated quantiles of each episode and their extremes by type; every episode counts the same."""
    x = st.long_form(frames(spark, d, "action", "state"), ["episode_index"])
    p = x.groupBy("episode_index", "field", "dim").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.99))).alias("q"), F.avg("v").alias("mean"))
    p = p.join(typed_episodes(spark, d), "episode_index")
    return p.groupBy("embodiment_type", "field", "dim").agg(RF(F.min(F.get("q", F.lit(0)))).alias("q01"), RF(F.max(F.get("q", F.lit(1)))).alias("q99"), RF(F.avg("mean")).alias("mean"))


_CH = f"{SQL_G}, h AS (SELECT a.episode_index, a.global_index, s.step, generate_subscripts(b.action, 1) - 1 AS dim, CAST(unnest(b.action) AS DOUBLE) AS v, a.rn + s.step >= a.n AS pad FROM g a CROSS JOIN range(8) s(step) JOIN g b ON b.episode_index = a.episode_index AND b.rn = least(a.rn + s.step, a.n - 1))"


@query("a5_stepwise_stats", f"""WITH {_CH}, {SQL_T}, z AS (SELECT embodiment_type, step, dim, v, row_number() OVER (PARTITION BY embodiment_type, step, dim ORDER BY v) AS k, count(*) OVER (PARTITION BY embodiment_type, step, dim) AS n FROM h JOIN t USING (episode_index) WHERE v IS NOT NULL AND isfinite(v))
SELECT embodiment_type, step, CAST(dim AS BIGINT) AS dim, any_value(n) AS n, {rf('min(v)')} AS lo, {rf('max(v)')} AS hi, {rf('avg(v)')} AS mean, {rf('stddev_samp(v)')} AS std,
{rf('max(CASE WHEN k = floor(0.01 * (n - 1)) + 1 THEN v END)')} AS q01, {rf('max(CASE WHEN k = floor(0.99 * (n - 1)) + 1 THEN v END)')} AS q99 FROM z GROUP BY embodiment_type, step, dim""")
def a5(spark: S, d: str) -> DataFrame:
    """Statistics of a clamped look-ahead chunk by step and dimension, of all finite readings."""
    g = ranked_frames(spark, d, "action").join(typed_episodes(spark, d), "episode_index")
    s = st.look_ahead_statistics(g, "embodiment_type", "action", 8, [("q01", 0.01), ("q99", 0.99)])
    return s.select("embodiment_type", "step", "dim", "n", *[RF(F.col(c)).alias(c) for c in ("lo", "hi", "mean", "std", "q01", "q99")])


@query("a6_state_stats", f"""WITH {_LX}, {SQL_T}, z AS (SELECT embodiment_type, dim, v, row_number() OVER (PARTITION BY embodiment_type, dim ORDER BY v) AS k, count(*) OVER (PARTITION BY embodiment_type, dim) AS n FROM y JOIN t USING (episode_index) WHERE field = 'state')
SELECT embodiment_type, CAST(dim AS BIGINT) AS dim, any_value(n) AS n, {rf('avg(v)')} AS mean, {rf('stddev_samp(v)')} AS std, {rf('max(CASE WHEN k = floor(0.001 * (n - 1)) + 1 THEN v END)')} AS q001, {rf('max(CASE WHEN k = floor(0.999 * (n - 1)) + 1 THEN v END)')} AS q999 FROM z GROUP BY embodiment_type, dim""")
def a6(spark: S, d: str) -> DataFrame:
    """Statistics of the state by type and dimension, with exact order statistics."""
    x = st.long_form(frames(spark, d, "state"), ["episode_index"], ("state",)).join(typed_episodes(spark, d), "episode_index")
    k = ["embodiment_type", "dim"]
    s = x.groupBy(*k).agg(F.count("v").alias("n"), RF(F.avg("v")).alias("mean"), RF(F.stddev_samp("v")).alias("std"))
    q = st.order_statistics(x, k, [("q001", 0.001), ("q999", 0.999)])
    return s.join(q, k).select(*k, "n", "mean", "std", RF(F.col("q001")).alias("q001"), RF(F.col("q999")).alias("q999"))


@query("a9_order_statistics", "SELECT event_type, " + ", ".join(f"max(CASE WHEN k = floor({q} * (n - 1)) + 1 THEN value END) AS {c}" for c, q in (("q01", 0.01), ("q50", 0.5), ("q99", 0.99))) + " FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) GROUP BY event_type")
def a9(spark: S, d: str) -> DataFrame:
    """Order statistics by rank floor(q (n - 1)), which differs from discrete percentiles."""
    x = table(spark, d, "events").where("value is not null").select("event_type", F.col("value").alias("v"))
    return st.order_statistics(x, ["event_type"], [("q01", 0.01), ("q50", 0.5), ("q99", 0.99)])


@query("a10_weighted_merge", f"""WITH s AS (SELECT embodiment_type, field, dim, n_rows, stat_min, stat_max, stat_mean, stat_std, q01, q99, sum(n_rows * stat_mean) OVER w / sum(n_rows) OVER w AS m FROM (SELECT * FROM stats WHERE stat_mean IS NOT NULL AND stat_std IS NOT NULL AND n_rows > 0 AND isfinite(stat_mean) AND isfinite(stat_std)) WINDOW w AS (PARTITION BY embodiment_type, field, dim))
SELECT embodiment_type, field, dim, {r6('min(stat_min)')} AS lo, {r6('max(stat_max)')} AS hi, {r6('any_value(m)')} AS mean, {r6('sqrt(sum(n_rows * (stat_std * stat_std + (stat_mean - m) * (stat_mean - m))) / sum(n_rows))')} AS std,
{r6('sum(n_rows * q01) / sum(CASE WHEN q01 IS NOT NULL THEN n_rows END)')} AS q01 FROM s GROUP BY embodiment_type, field, dim""")
def a10(spark: S, d: str) -> DataFrame:
    """Stored statistics of several datasets merged by weight; quantiles are averaged by weight."""
    s = table(spark, d, "stats").where("n_rows > 0").where(finite(F.col("stat_mean")) & finite(F.col("stat_std")))
    k = ["embodiment_type", "field", "dim"]
    m = s.groupBy(*k).agg((F.sum(F.col("n_rows") * F.col("stat_mean")) / F.sum("n_rows")).alias("m"))
    j = s.join(m, k)
    var = F.sum(F.col("n_rows") * (F.col("stat_std") * F.col("stat_std") + F.pow(F.col("stat_mean") - F.col("m"), 2))) / F.sum("n_rows")
    q = F.sum(F.col("n_rows") * F.col("q01")) / F.sum(F.when(F.col("q01").isNotNull(), F.col("n_rows")))
    return j.groupBy(*k).agg(R6(F.min("stat_min")).alias("lo"), R6(F.max("stat_max")).alias("hi"), R6(F.first("m")).alias("mean"), R6(F.sqrt(var)).alias("std"), R6(q).alias("q01"))


@query("a12_stats_to_compute", f"WITH {SQL_E} SELECT DISTINCT dataset_dir FROM e WHERE dataset_dir NOT IN (SELECT dataset_dir FROM stats WHERE dataset_dir IS NOT NULL)")
def a12(spark: S, d: str) -> DataFrame:
    """Datasets whose statistics are not stored yet."""
    return table(spark, d, "episodes").select("dataset_dir").distinct().join(table(spark, d, "stats").select("dataset_dir"), "dataset_dir", "left_anti")


@query("a13_initial_state", f"WITH {SQL_G}, {SQL_T}, x AS (SELECT embodiment_type, generate_subscripts(state, 1) - 1 AS dim, CAST(unnest(state) AS DOUBLE) AS v FROM g JOIN t USING (episode_index) WHERE rn = 0 AND state IS NOT NULL) SELECT embodiment_type, CAST(dim AS BIGINT) AS dim, {rf('avg(v)')} AS mean FROM x WHERE isfinite(v) GROUP BY ALL")
def a13(spark: S, d: str) -> DataFrame:
    """Mean of the first frame's state over episodes."""
    x = ranked_frames(spark, d, "state").where("rn = 0").join(typed_episodes(spark, d), "episode_index")
    return st.long_form(x, ["embodiment_type"], ("state",)).groupBy("embodiment_type", "dim").agg(RF(F.avg("v")).alias("mean"))


@query("a14_sample_indices", f"""WITH {SQL_E}, c AS (SELECT dataset_dir, CAST(sum(length) AS BIGINT) AS n FROM e GROUP BY dataset_dir), m AS (SELECT *, greatest(least(100, n), least(CAST(floor(pow(n, 0.75)) AS BIGINT), 10000)) AS k FROM c)
SELECT dataset_dir, i AS i, CAST(round_even(i * (n - 1) / greatest(k - 1, 1)::DOUBLE, 0) AS BIGINT) AS position FROM m, LATERAL (SELECT unnest(range(k)) AS i)""")
def a14(spark: S, d: str) -> DataFrame:
    """Evenly spaced sample positions of each dataset: n to the power 0.75, at least 100, rounded half to even."""
    c = episodes(spark, d).groupBy("dataset_dir").agg(F.sum("length").alias("n"))
    m = c.withColumn("k", F.greatest(F.least(F.lit(100), F.col("n")), F.least(F.floor(F.pow("n", F.lit(0.75))), F.lit(10000))))
    x = m.select("dataset_dir", "n", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("i"))
    return x.select("dataset_dir", "i", F.bround(F.col("i") * (F.col("n") - 1) / F.greatest(F.col("k") - 1, F.lit(1)).cast("double"), 0).cast("long").alias("position"))


@query("a15_weight_normalization", f"WITH {SQL_E}, c AS (SELECT m.embodiment, weight, CAST(sum(length) AS DOUBLE) AS n FROM e JOIN mixture m USING (embodiment) GROUP BY m.embodiment, weight) SELECT embodiment, {r6('weight * sum(n) OVER () / sum(n * weight) OVER ()')} AS weight FROM c")
def a15(spark: S, d: str) -> DataFrame:
    """Weights scaled so that the effective total equals the actual one; the window runs over one row per source."""
    m = F.broadcast(table(spark, d, "mixture").select("embodiment", "weight"))
    c = episodes(spark, d).select("embodiment", "length").join(m, "embodiment").groupBy("embodiment", "weight").agg(F.sum("length").cast("double").alias("n"))
    w = Window.partitionBy(F.lit(0))
    return c.select("embodiment", R6(F.col("weight") * F.sum("n").over(w) / F.sum(F.col("n") * F.col("weight")).over(w)).alias("weight"))


@query("a16_totals_over_ranks", f"WITH {SQL_E}, r AS (SELECT episode_index % 8 AS rank, sum(length) AS n, count(*) AS episodes FROM e GROUP BY episode_index % 8) SELECT CAST(sum(n) AS BIGINT) AS total, CAST(min(n) AS BIGINT) AS least, CAST(min(n) * 8 AS BIGINT) AS usable FROM r")
def a16(spark: S, d: str) -> DataFrame:
    """Sums and minima over shards: what every shard can deliver."""
    r = episodes(spark, d).groupBy((F.col("episode_index") % 8).alias("rank")).agg(F.sum("length").alias("n"))
    return r.agg(F.sum("n").alias("total"), F.min("n").alias("least"), (F.min("n") * 8).alias("usable"))


# windows


@query("w1_delta_offsets", "SELECT embodiment, o AS offset_frames, " + r6("o / fps::DOUBLE") + " AS offset_seconds FROM mixture CROSS JOIN range(-3, 9) r(o)")
def w1(spark: S, d: str) -> DataFrame:
    """Offsets of a chunk with three past and nine future frames, in frames and seconds."""
    x = table(spark, d, "mixture").select("embodiment", "fps", F.explode(F.sequence(F.lit(-3).cast("long"), F.lit(8).cast("long"))).alias("offset_frames"))
    return x.select("embodiment", "offset_frames", R6(F.col("offset_frames") / F.col("fps").cast("double")).alias("offset_seconds"))


@query("w2_delta_indices", "SELECT embodiment, s AS tenths, CAST(round_even(s * 0.1::DOUBLE * fps, 0) AS BIGINT) AS frames FROM mixture CROSS JOIN range(-10, 11) r(s)")
def w2(spark: S, d: str) -> DataFrame:
    """Seconds to whole frames, half to even."""
    x = table(spark, d, "mixture").select("embodiment", "fps", F.explode(F.sequence(F.lit(-10).cast("long"), F.lit(10).cast("long"))).alias("tenths"))
    return x.select("embodiment", "tenths", F.bround(F.col("tenths") * F.lit(0.1) * F.col("fps"), 0).cast("long").alias("frames"))


@query("w3_clamped_chunk", f"""WITH {SQL_G}, h AS (SELECT a.episode_index, a.global_index, s.step, b.task_index AS v, a.rn + s.step < 0 OR a.rn + s.step >= a.n AS pad FROM g a CROSS JOIN range(-2, 6) s(step) JOIN g b ON b.episode_index = a.episode_index AND b.rn = greatest(least(a.rn + s.step, a.n - 1), 0))
SELECT global_index, CAST(sum(v * (step + 3)) AS BIGINT) AS checksum, count(*) FILTER (WHERE pad) AS pads FROM h GROUP BY global_index""")
def w3(spark: S, d: str) -> DataFrame:
    """A window from two frames back to five ahead, clamped to the episode, with its padding mask."""
    x = clamped_chunk(ranked_frames(spark, d, "task_index"), ["task_index"], 2, 5)
    check = F.aggregate("chunk", F.lit(0).cast("long"), lambda a, c: a + c["task_index"] * (c["step"] + 3))
    return x.select("global_index", check.alias("checksum"), F.size(F.filter("chunk", lambda c: c["is_pad"])).cast("long").alias("pads"))


@query("w4_forward_window", f"WITH {_CH} SELECT global_index, CAST(dim AS BIGINT) AS dim, count(*) FILTER (WHERE pad) AS repeated, {rf('sum(v)')} AS total FROM h WHERE v IS NOT NULL AND isfinite(v) GROUP BY global_index, dim")
def w4(spark: S, d: str) -> DataFrame:
    """A forward window of eight frames in every dimension, whose last row is repeated at the end of the episode.

    No chunk is built: a frame over eight rows gives the sum, and the last reading counts once more for each row beyond the end.
    """
    x = by_dimension(ranked_frames(spark, d, "action"), "action")
    w = Window.partitionBy("episode_index", "dim").orderBy("rn")
    ahead, whole = w.rowsBetween(0, 7), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.select("global_index", "dim", F.count("v").over(ahead).alias("k"), F.sum("v").over(ahead).alias("s"), F.last("v").over(whole).alias("end"), F.greatest(F.col("rn") + 8 - F.col("n"), F.lit(0)).cast("long").alias("pads"))
    pads = F.when(F.col("end").isNotNull(), F.col("pads")).otherwise(F.lit(0).cast("long"))
    x = x.select("global_index", "dim", (F.col("k") + pads).alias("k"), pads.alias("repeated"), (F.coalesce("s", F.lit(0.0)) + pads * F.coalesce("end", F.lit(0.0))).alias("total"))
    return x.where("k > 0").select("global_index", "dim", "repeated", RF(F.col("total")).alias("total"))


@query("w5_clamped_shift", f"WITH {SQL_G} SELECT a.global_index, b.task_index AS later, c.coarse_task_index AS earlier FROM g a JOIN g b ON b.episode_index = a.episode_index AND b.rn = least(a.rn + 3, a.n - 1) JOIN g c ON c.episode_index = a.episode_index AND c.rn = greatest(a.rn - 2, 0)")
def w5(spark: S, d: str) -> DataFrame:
    """Values three frames later and two earlier, clamped at the episode's ends; nulls are kept as values."""
    return ranked_frames(spark, d, "task_index", "coarse_task_index").select("global_index", clamped_shift("task_index", 3).alias("later"), clamped_shift("coarse_task_index", -2).alias("earlier"))


@query("w6_run_bounds", f"WITH {SQL_F} SELECT global_index, min(global_index) OVER w AS first_index, max(global_index) OVER w AS last_index FROM f WINDOW w AS (PARTITION BY episode_index)")
def w6(spark: S, d: str) -> DataFrame:
    """First and last frame of each row's episode."""
    w = Window.partitionBy("episode_index")
    return frames(spark, d).select("global_index", F.min("global_index").over(w).alias("first_index"), F.max("global_index").over(w).alias("last_index"))


@query("w7_sampling_plan", f"""WITH {SQL_G}, a AS (SELECT episode_index, rn, n FROM g WHERE rn % 10 = 0), k AS (SELECT episode_index, greatest(least(least(rn + s, n - 1) + o, n - 1), 0) AS row_number FROM a CROSS JOIN range(4) x(s) CROSS JOIN (VALUES (-1), (0), (2)) y(o))
SELECT DISTINCT episode_index, row_number FROM k""")
def w7(spark: S, d: str) -> DataFrame:
    """Rows that anchors, steps and time offsets need: clamped by the chunk, then by the offset, each once."""
    a = ranked_frames(spark, d).where("rn % 10 = 0").select("episode_index", "rn", "n")
    s = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("s")
    k = a.select("episode_index", "rn", "n", s).select("episode_index", "rn", "n", "s", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(2))).alias("o"))
    at = F.greatest(F.least(F.least(F.col("rn") + F.col("s"), F.col("n") - 1) + F.col("o"), F.col("n") - 1), F.lit(0))
    return k.select("episode_index", at.cast("long").alias("row_number")).distinct()


@query("w8_subtask_truncate", f"""WITH {SQL_G}, h AS (SELECT a.global_index, s.step, b.rn AS spot, b.task_index = a.task_index AS same FROM g a CROSS JOIN range(8) s(step) JOIN g b ON b.episode_index = a.episode_index AND b.rn = least(a.rn + s.step, a.n - 1)),
l AS (SELECT global_index, step, same, max(CASE WHEN same THEN spot END) OVER (PARTITION BY global_index) AS last_same FROM h) SELECT global_index, count(*) FILTER (WHERE NOT same) AS padded, any_value(last_same) AS last_same FROM l GROUP BY global_index""")
def w8(spark: S, d: str) -> DataFrame:
    """Steps of another task than the first are padded with the last step of the whole chunk that still matches."""
    x = clamped_chunk(ranked_frames(spark, d, "task_index"), ["task_index", "rn"], 0, 7)
    same = F.filter("chunk", lambda c: c["task_index"] == F.col("task_index"))
    return x.select("global_index", (F.lit(8) - F.size(same)).cast("long").alias("padded"), F.array_max(F.transform(same, lambda c: c["rn"])).cast("long").alias("last_same"))


@query("w9_mask_or", f"WITH {SQL_G}, m AS (SELECT global_index, s.step, (rn + s.step >= n) OR (rn + 2 * s.step >= n) AS masked FROM g CROSS JOIN range(8) s(step)) SELECT global_index, count(*) FILTER (WHERE masked) AS masked FROM m GROUP BY global_index")
def w9(spark: S, d: str) -> DataFrame:
    """Padding masks of two parts of different stride, joined by or."""
    steps = F.sequence(F.lit(0), F.lit(7))

    def mask(stride: int):
        return F.transform(steps, lambda s: F.col("rn") + stride * s >= F.col("n"))

    a, b = mask(1), mask(2)
    both = F.zip_with(a, b, lambda x, y: x | y)
    return ranked_frames(spark, d).select("global_index", F.size(F.filter(both, lambda x: x)).cast("long").alias("masked"))


@query("w12_backtrack", f"WITH {SQL_F} SELECT global_index, lag(task_index, 1) OVER w AS previous, lead(task_index, 2) OVER w AS ahead FROM f WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)")
def w12(spark: S, d: str) -> DataFrame:
    """One row back and two ahead."""
    return frames(spark, d, "task_index").select("global_index", F.lag("task_index", 1).over(in_episode()).alias("previous"), F.lead("task_index", 2).over(in_episode()).alias("ahead"))


@query("w13_delta_roundtrip", f"""WITH {SQL_G}, {SQL_D.format('action')}, x AS (SELECT global_index, episode_index, frame_index, dim, v FROM d WHERE v IS NOT NULL),
y AS (SELECT *, v - coalesce(lag(v) OVER (PARTITION BY episode_index, dim ORDER BY frame_index), 0) AS delta FROM x)
SELECT global_index, dim, {rf('delta')} AS delta, {rf('v')} AS back FROM y""")
def w13(spark: S, d: str) -> DataFrame:
    """First differences of every dimension, and the running sum that undoes them; in decimals, so huge readings leave nothing behind."""
    x = by_dimension(frames(spark, d, "action"), "action").where("v is not null").withColumn("v", F.col("v").try_cast("decimal(38,12)"))
    w = Window.partitionBy("episode_index", "dim").orderBy("frame_index")
    y = x.withColumn("delta", (F.col("v") - F.coalesce(F.lag("v").over(w), F.lit(0).cast("decimal(38,12)"))).cast("decimal(38,12)"))
    back = F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return y.select("global_index", "dim", RF(F.col("delta").cast("double")).alias("delta"), RF(back.cast("double")).alias("back"))


@query("w14_run_validity", f"""WITH {SQL_F}, b AS (SELECT episode_index, frame_index, task_index, CASE WHEN task_index = lag(task_index) OVER w THEN 0 ELSE 1 END AS new FROM f WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
r AS (SELECT *, sum(new) OVER (PARTITION BY episode_index ORDER BY frame_index) AS run FROM b), c AS (SELECT episode_index, run, count(*) AS len, max(run) OVER (PARTITION BY episode_index) AS runs FROM r GROUP BY episode_index, run)
SELECT episode_index, CAST(max(runs) AS BIGINT) AS runs, count(*) FILTER (WHERE run > 1 AND run < runs AND len <= 4) AS too_short FROM c GROUP BY episode_index""")
def w14(spark: S, d: str) -> DataFrame:
    """Runs of one task; inner runs of at most four frames are invalid."""
    new = F.when(F.col("task_index") == F.lag("task_index").over(in_episode()), 0).otherwise(1)
    r = frames(spark, d, "task_index").withColumn("new", new).withColumn("run", F.sum("new").over(in_episode()))
    c = r.groupBy("episode_index", "run").agg(F.count(F.lit(1)).alias("len")).withColumn("runs", F.max("run").over(Window.partitionBy("episode_index")))
    short = (F.col("run") > 1) & (F.col("run") < F.col("runs")) & (F.col("len") <= 4)
    return c.groupBy("episode_index").agg(F.max("runs").alias("runs"), F.sum(short.cast("long")).alias("too_short"))


@query("w16_carry_forward", f"WITH {SQL_F} SELECT global_index, coalesce(last_value(quality_index IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY frame_index ROWS UNBOUNDED PRECEDING), 0) AS quality FROM f")
def w16(spark: S, d: str) -> DataFrame:
    """The last value that was given is carried forward; before the first one a default stands."""
    w = in_episode().rowsBetween(Window.unboundedPreceding, 0)
    return frames(spark, d, "quality_index").select("global_index", F.coalesce(F.last("quality_index", ignorenulls=True).over(w), F.lit(0).cast("long")).alias("quality"))


@query("w17_rate_chunk", f"""WITH {SQL_G}, {SQL_E}, {SQL_D.format('state')}, x AS (SELECT d.global_index, d.episode_index, d.frame_index, d.dim, e.embodiment, v FROM d JOIN e USING (episode_index) WHERE v IS NOT NULL)
SELECT global_index, dim, {rf('(v - coalesce(lag(v) OVER (PARTITION BY episode_index, dim ORDER BY frame_index), v)) * m.fps')} AS rate FROM x JOIN mixture m USING (embodiment)""")
def w17(spark: S, d: str) -> DataFrame:
    """Positions to velocities in every dimension: first differences, seeded by the first position, over the frame interval."""
    m = F.broadcast(table(spark, d, "mixture").select("embodiment", "fps"))
    x = by_dimension(frames(spark, d, "state"), "state").where("v is not null")
    x = x.withColumn("diff", F.col("v") - F.coalesce(F.lag("v").over(Window.partitionBy("episode_index", "dim").orderBy("frame_index")), F.col("v")))
    return x.join(episodes(spark, d).select("episode_index", "embodiment"), "episode_index").join(m, "embodiment").select("global_index", "dim", RF(F.col("diff") * F.col("fps")).alias("rate"))


# sampling and sharding


@query("o1_distinct_sorted", "SELECT DISTINCT robot_id, embodiment FROM episodes ORDER BY robot_id")
def o1(spark: S, d: str) -> DataFrame:
    """Distinct values in order."""
    return table(spark, d, "episodes").select("robot_id", "embodiment").distinct().orderBy("robot_id")


@query("o2_top_k_top_p", f"""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id)::DOUBLE AS p, rank() OVER (PARTITION BY user_id ORDER BY n DESC) AS r FROM c),
q AS (SELECT *, sum(p) OVER (PARTITION BY user_id ORDER BY n DESC, event_type) - p AS before FROM p)
SELECT user_id, event_type, {r6('p')} AS p FROM q WHERE r <= 3 AND before <= 0.8 + 1e-9""")
def o2(spark: S, d: str) -> DataFrame:
    """Top k with ties, and the smallest prefix whose probability passes p."""
    w = Window.partitionBy("user_id")
    c = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    p = c.withColumn("p", F.col("n") / F.sum("n").over(w).cast("double")).withColumn("r", F.rank().over(w.orderBy(F.desc("n"))))
    q = p.withColumn("before", F.sum("p").over(w.orderBy(F.desc("n"), "event_type")) - F.col("p"))
    return q.where((F.col("r") <= 3) & (F.col("before") <= 0.8 + 1e-9)).select("user_id", "event_type", R6(F.col("p")).alias("p"))


@query("o3_penalties", f"WITH h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, event_type, {r6('ln(n) / 0.7 - 0.5 - 0.1 * n')} AS score FROM h")
def o3(spark: S, d: str) -> DataFrame:
    """Scores under temperature, presence and frequency penalties of the tokens seen so far."""
    h = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return h.select("user_id", "event_type", R6(F.log(F.col("n").cast("double")) / 0.7 - 0.5 - 0.1 * F.col("n")).alias("score"))


_O4 = f"""{SQL_E}, c AS (SELECT m.embodiment, weight, CAST(sum(length) AS BIGINT) AS n FROM e JOIN mixture m USING (embodiment) GROUP BY m.embodiment, weight),
w AS (SELECT *, greatest(1, CAST(floor(n * weight) AS BIGINT)) AS eff FROM c)"""


@query("o5_effective_lengths", f"WITH {_O4} SELECT embodiment, n, eff, CAST(sum(eff) OVER (ORDER BY embodiment) - eff AS BIGINT) AS first_index FROM w")
def o5(spark: S, d: str) -> DataFrame:
    """Effective lengths of weighted sources and where each begins."""
    return _effective(spark, d).withColumn("first_index", F.sum("eff").over(Window.orderBy("embodiment")) - F.col("eff")).select("embodiment", "n", "eff", "first_index")


def _effective(spark: S, d: str) -> DataFrame:
    m = F.broadcast(table(spark, d, "mixture").select("embodiment", "weight"))
    c = episodes(spark, d).select("embodiment", "length").join(m, "embodiment").groupBy("embodiment", "weight").agg(F.sum("length").alias("n"))
    return c.withColumn("eff", F.greatest(F.lit(1), F.floor(F.col("n") * F.col("weight"))))


@query("o4_golden_sampling", f"""WITH {_O4}, s AS (SELECT *, greatest(1, CAST(floor(n * 0.61803398875) AS BIGINT)) AS s0 FROM w),
g AS (SELECT embodiment, n, eff, (SELECT min(k) FROM range(s0, s0 + 132) r(k) WHERE gcd(k, n) = 1) AS stride FROM s)
SELECT embodiment, i AS draw, CASE WHEN eff >= n THEN i % n ELSE (i * stride + 3 * 1000003) % n END AS local FROM g, LATERAL (SELECT unnest(range(eff)) AS i)""")
def o4(spark: S, d: str) -> DataFrame:
    """Deterministic weighted sampling: a stride near the golden section, coprime to the length, visits a source evenly.

    The stride is found in SQL: the first of the following numbers whose greatest common divisor with the length is 1. Of 132 successive numbers
    one is coprime to any length of up to 64 bits: a length without one would need 18 prime factors. Draws are made in pieces, so a source of any size is spread over tasks.
    """
    e = _effective(spark, d).withColumn("s0", F.greatest(F.lit(1), F.floor(F.col("n") * 0.61803398875)))
    rounds = 96

    def gcd(a, b):
        pair = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(a.alias("a"), b.alias("b")), lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.when(s["b"] == 0, 1).otherwise(s["b"])).alias("b"))))
        return pair["a"]

    near = F.filter(F.sequence(F.col("s0"), F.col("s0") + 131), lambda k: gcd(k, F.col("n")) == 1)
    g = e.withColumn("stride", F.get(near, F.lit(0)))
    x = spread(g.select("embodiment", "n", "eff", "stride"), "eff", "draw")
    local = F.when(F.col("eff") >= F.col("n"), F.col("draw") % F.col("n")).otherwise((F.col("draw") * F.col("stride") + 3 * 1000003) % F.col("n"))
    return x.select("embodiment", "draw", local.alias("local"))


@query("o6_shard_resume", f"WITH {SQL_E} SELECT episode_index, (k - 1) % 4 AS shard, (k - 1) // 4 AS position FROM (SELECT episode_index, dataset_dir, row_number() OVER (PARTITION BY dataset_dir ORDER BY episode_index) AS k FROM e) WHERE (k - 1) // 4 >= 2")
def o6(spark: S, d: str) -> DataFrame:
    """Round-robin shards of each dataset, resumed after two batches."""
    x = position_in_group(episodes(spark, d).select("dataset_dir", "episode_index"), ["dataset_dir"], ["episode_index"], "k")
    return x.select("episode_index", (F.col("k") % 4).alias("shard"), F.expr("k div 4").alias("position")).where("position >= 2")


@query("o7_grouped_batches", f"WITH {SQL_E}, k AS (SELECT embodiment, episode_index, row_number() OVER (PARTITION BY embodiment ORDER BY (episode_index * 7919 + 13) % 1000003, episode_index) - 1 AS k FROM e) SELECT embodiment, k // 8 AS batch, count(*) AS n, min(episode_index) AS first_episode FROM k GROUP BY ALL")
def o7(spark: S, d: str) -> DataFrame:
    """Batches that never mix embodiments, in an order shuffled by arithmetic on the index."""
    x = episodes(spark, d).select("embodiment", "episode_index", ((F.col("episode_index") * 7919 + 13) % 1000003).alias("place"))
    k = position_in_group(x, ["embodiment"], ["place", "episode_index"], "k")
    return k.groupBy("embodiment", F.expr("k div 8").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.min("episode_index").alias("first_episode"))


@query("o8_weighted_choice", f"WITH {SQL_E}, u AS (SELECT episode_index, ((episode_index * 48271 + 11) % 2147483647) / 2147483647.0::DOUBLE AS u FROM e) SELECT episode_index, CASE WHEN u < 0.5 THEN 'base' WHEN u < 0.8 THEN 'subtask' ELSE 'plan' END AS builder FROM u")
def o8(spark: S, d: str) -> DataFrame:
    """A weighted choice by a number that depends on the key alone."""
    u = ((F.col("episode_index") * 48271 + 11) % 2147483647) / F.lit(2147483647.0)
    return episodes(spark, d).select("episode_index", F.when(u < 0.5, "base").when(u < 0.8, "subtask").otherwise("plan").alias("builder"))


@query("o9_camera_swap", f"WITH {SQL_F} SELECT global_index, ((global_index * 16807 + 5) % 2147483647) % 2 = 0 AS swapped FROM f")
def o9(spark: S, d: str) -> DataFrame:
    """A fair coin per frame."""
    return frames(spark, d).select("global_index", (((F.col("global_index") * 16807 + 5) % 2147483647) % 2 == 0).alias("swapped"))


@query("o10_episode_dropout", f"WITH {SQL_E} SELECT episode_index, (episode_index * 69621 + 17) % 2147483647 % 100 < 10 AS camera_dropped, (episode_index * 69621 + 17) % 2147483647 % 3 AS slot FROM e")
def o10(spark: S, d: str) -> DataFrame:
    """Camera dropout and slot by episode, the same for all its frames."""
    h = (F.col("episode_index") * 69621 + 17) % 2147483647
    return episodes(spark, d).select("episode_index", (h % 100 < 10).alias("camera_dropped"), (h % 3).alias("slot"))


@query("o12_epoch_shift", f"WITH {SQL_E} SELECT episode_index, epoch, (episode_index + epoch * 1000003) % 97 AS slot FROM e CROSS JOIN range(3) r(epoch)")
def o12(spark: S, d: str) -> DataFrame:
    """The epoch enters the sampling as a number."""
    x = episodes(spark, d).select("episode_index", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("epoch"))
    return x.select("episode_index", "epoch", ((F.col("episode_index") + F.col("epoch") * 1000003) % 97).alias("slot"))


# set operations


@query("u1_union_sources", "SELECT source, count(*) AS n, count(text) AS with_text FROM (SELECT 'documents' AS source, text FROM documents UNION ALL BY NAME SELECT 'records' AS source, record AS text FROM raw_records UNION ALL BY NAME SELECT 'tasks' AS source FROM tasks) GROUP BY source")
def u1(spark: S, d: str) -> DataFrame:
    """Sources of different columns put together; missing columns are null."""
    a = table(spark, d, "documents").select(F.lit("documents").alias("source"), "text")
    b = table(spark, d, "raw_records").select(F.lit("records").alias("source"), F.col("record").alias("text"))
    c = table(spark, d, "tasks").select(F.lit("tasks").alias("source"))
    return a.unionByName(b).unionByName(c, allowMissingColumns=True).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("text").alias("with_text"))


@query("u2_weighted_union", f"WITH {SQL_E} SELECT embodiment, weight, count(*) AS episodes FROM e JOIN mixture USING (embodiment) GROUP BY ALL")
def u2(spark: S, d: str) -> DataFrame:
    """All weighted groups of all embodiments together."""
    return episodes(spark, d).select("embodiment").join(F.broadcast(table(spark, d, "mixture").select("embodiment", "weight")), "embodiment").groupBy("embodiment", "weight").agg(F.count(F.lit(1)).alias("episodes"))


@query("u4_concat_first_wins", "WITH a AS (SELECT doc_id, text, received_at FROM documents WHERE text IS NOT NULL) SELECT text, arg_min(doc_id, struct_pack(a := received_at, b := doc_id)) AS doc_id FROM a GROUP BY text")
def u4(spark: S, d: str) -> DataFrame:
    """Repeated texts once; the one that came first wins."""
    return table(spark, d, "documents").where("text is not null").groupBy("text").agg(F.min_by("doc_id", F.struct("received_at", "doc_id")).alias("doc_id"))


@query("u5_unknown_keys", "SELECT DISTINCT lower(trim(source, ' ')) AS source FROM documents WHERE source IS NOT NULL AND lower(trim(source, ' ')) NOT IN (SELECT source FROM source_targets)")
def u5(spark: S, d: str) -> DataFrame:
    """Keys that the configuration does not know."""
    x = table(spark, d, "documents").where("source is not null").select(F.lower(F.trim("source")).alias("source")).distinct()
    return x.join(F.broadcast(table(spark, d, "source_targets").select("source")), "source", "left_anti")
