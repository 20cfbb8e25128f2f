"""Prompts, collation, evaluation and the batch forms of streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import vectors as V
from kinelake.operators.windows import clamped_shift, in_episode
from kinelake.plans.analytics import finite
from kinelake.ordering import position_in_group, with_previous
from kinelake.plans.base import R6, RF, SQL_D, SQL_E, SQL_F, SQL_G, SQL_T, by_dimension, episodes, frames, r6, ranked_frames, rf, typed_episodes
from kinelake.plans.registry import query
from kinelake.tables import table

S = SparkSession


def at(c: str, i: int):
    return F.get(F.col(c), F.lit(i))


_TASKS = "k AS (SELECT DISTINCT episode_index, task FROM f JOIN tasks USING (task_index))"


def episode_tasks(spark: S, d: str) -> DataFrame:
    """Each episode's tasks by name; the dictionary is a fixed table."""
    t = F.broadcast(table(spark, d, "tasks"))
    return frames(spark, d, "task_index").select("episode_index", "task_index").distinct().join(t, "task_index").select("episode_index", "task").distinct()


def prompt(command, *pieces):
    """A template: the command, then labelled pieces, then the call for the action."""
    return F.concat(F.lit("Command: "), command, *[x for label, c in pieces for x in (F.lit(f"; {label}: "), c)], F.lit("; Action: "))


@query("b1_base_prompt", f"WITH {SQL_F}, {_TASKS} SELECT episode_index, task, 'Command: ' || task || '; Action: ' AS prompt FROM k WHERE task IS NOT NULL")
def b1(spark: S, d: str) -> DataFrame:
    """The plain template."""
    return episode_tasks(spark, d).where("task is not null").select("episode_index", "task", prompt(F.col("task")).alias("prompt"))


@query("b2_flow_only", f"WITH {SQL_F}, {_TASKS} SELECT episode_index, task, 'Command: ' || task AS prompt FROM k WHERE task IS NOT NULL")
def b2(spark: S, d: str) -> DataFrame:
    """The template without action tokens."""
    return episode_tasks(spark, d).where("task is not null").select("episode_index", "task", F.concat(F.lit("Command: "), "task").alias("prompt"))


_NOTE = "o AS (SELECT episode_index, max(text) AS note FROM documents WHERE doc_kind = 'episode_note' AND episode_index IS NOT NULL GROUP BY episode_index)"


def notes(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").where("doc_kind = 'episode_note' and episode_index is not null").groupBy("episode_index").agg(F.max("text").alias("note"))


_OK = "({0} IS NOT NULL AND lower(trim({0}, ' ')) NOT IN ('', 'null', 'none', 'nan', '-1'))"


@query("b3_memory_prompt", f"WITH {SQL_F}, {_TASKS}, {_NOTE} SELECT episode_index, task, 'Command: ' || task || '; Memory: ' || note || '; Action: ' AS prompt FROM k JOIN o USING (episode_index) WHERE {_OK.format('note')} AND task IS NOT NULL")
def b3(spark: S, d: str) -> DataFrame:
    """With a memory, where there is one."""
    x = episode_tasks(spark, d).join(notes(spark, d), "episode_index").where(V.is_text(F.col("note")) & F.col("task").isNotNull())
    return x.select("episode_index", "task", prompt(F.col("task"), ("Memory", F.col("note"))).alias("prompt"))


_COARSE = f"{SQL_F}, c AS (SELECT DISTINCT f.episode_index, a.task AS task, b.task AS sub FROM f JOIN tasks a ON a.task_index = f.task_index JOIN tasks b ON b.task_index = f.coarse_task_index)"


def coarse(spark: S, d: str) -> DataFrame:
    t = table(spark, d, "tasks")
    x = frames(spark, d, "task_index", "coarse_task_index").select("episode_index", "task_index", "coarse_task_index").distinct()
    x = x.join(F.broadcast(t), "task_index").join(F.broadcast(t.select(F.col("task_index").alias("coarse_task_index"), F.col("task").alias("sub"))), "coarse_task_index")
    return x.select("episode_index", "task", "sub").distinct()


@query("b4_subtask_prompt", f"WITH {_COARSE} SELECT episode_index, 'Command: ' || task || '; Subtask: ' || sub || '; Action: ' AS prompt FROM c WHERE {_OK.format('task')} AND {_OK.format('sub')}")
def b4(spark: S, d: str) -> DataFrame:
    """With a sub-task; both have to be given."""
    x = coarse(spark, d).where(V.is_text(F.col("task")) & V.is_text(F.col("sub")))
    return x.select("episode_index", prompt(F.col("task"), ("Subtask", F.col("sub"))).alias("prompt"))


@query("b5_task_as_subtask", f"WITH {SQL_F}, {_TASKS} SELECT episode_index, 'Command: ' || task || '; Subtask: ' || task || '; Action: ' AS prompt FROM k WHERE {_OK.format('task')}")
def b5(spark: S, d: str) -> DataFrame:
    """The task stands for its own sub-task."""
    x = episode_tasks(spark, d).where(V.is_text(F.col("task")))
    return x.select("episode_index", prompt(F.col("task"), ("Subtask", F.col("task"))).alias("prompt"))


@query("b6_subtask_flow_only", f"WITH {_COARSE} SELECT episode_index, 'Command: ' || task || '; Subtask: ' || sub AS prompt FROM c WHERE {_OK.format('task')} AND {_OK.format('sub')}")
def b6(spark: S, d: str) -> DataFrame:
    """With a sub-task, without action tokens."""
    x = coarse(spark, d).where(V.is_text(F.col("task")) & V.is_text(F.col("sub")))
    return x.select("episode_index", F.concat(F.lit("Command: "), "task", F.lit("; Subtask: "), "sub").alias("prompt"))


@query("b7_future_prompt", f"WITH {SQL_G} SELECT a.global_index, 'Command: ' || x.task || '; Next: ' || y.task || '; Action: ' AS prompt FROM g a JOIN g b ON b.episode_index = a.episode_index AND b.rn = a.rn + 16 JOIN tasks x ON x.task_index = a.task_index JOIN tasks y ON y.task_index = b.task_index WHERE {_OK.format('x.task')} AND {_OK.format('y.task')}")
def b7(spark: S, d: str) -> DataFrame:
    """With the task 16 frames later."""
    t = table(spark, d, "tasks").where(V.is_text(F.col("task")))
    x = frames(spark, d, "task_index").withColumn("later", F.lead("task_index", 16).over(in_episode()))
    x = x.join(F.broadcast(t), "task_index").join(F.broadcast(t.select(F.col("task_index").alias("later"), F.col("task").alias("next"))), "later")
    return x.select("global_index", prompt(F.col("task"), ("Next", F.col("next"))).alias("prompt"))


@query("b13_subtask_as_command", f"WITH {_COARSE} SELECT DISTINCT episode_index, 'Command: ' || sub || '; Action: ' AS prompt FROM c WHERE {_OK.format('sub')}")
def b13(spark: S, d: str) -> DataFrame:
    """The sub-task is the command."""
    return coarse(spark, d).where(V.is_text(F.col("sub"))).select("episode_index", prompt(F.col("sub")).alias("prompt")).distinct()


@query("b14_memory_update", f"WITH {SQL_E}, n AS (SELECT e.robot_id, e.episode_index, coalesce(e.tasks[1], '') AS t FROM e) SELECT episode_index, 'Memory: ' || coalesce(lag(t) OVER w, 'none') || '; Update: ' || t AS prompt FROM n WINDOW w AS (PARTITION BY robot_id ORDER BY episode_index)")
def b14(spark: S, d: str) -> DataFrame:
    """The memory so far and what is added to it."""
    n = episodes(spark, d).select("robot_id", "episode_index", F.coalesce(at("tasks", 0), F.lit("")).alias("t"))
    n = with_previous(n, "robot_id", "episode_index", "t")
    before = F.coalesce("previous", F.lit("none"))
    return n.select("episode_index", F.concat(F.lit("Memory: "), before, F.lit("; Update: "), "t").alias("prompt"))


@query("b16_plan_step_prompt", "WITH p AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: starts_with(l, '1.'))[1] AS one FROM documents WHERE doc_kind = 'plan' AND text IS NOT NULL) SELECT doc_id, 'Step: ' || trim(substr(one, 3), ' ') || '; Action: ' AS prompt FROM p WHERE one IS NOT NULL")
def b16(spark: S, d: str) -> DataFrame:
    """With the first step of a plan."""
    one = F.get(F.filter(F.split("text", "\n"), lambda x: x.startswith("1.")), F.lit(0))
    x = table(spark, d, "documents").where("doc_kind = 'plan' and text is not null").select("doc_id", one.alias("one")).where("one is not null")
    return x.select("doc_id", F.concat(F.lit("Step: "), F.trim(F.expr("substr(one, 3)")), F.lit("; Action: ")).alias("prompt"))


@query("b17_mixed_builder", f"WITH {SQL_E}, {_NOTE}, x AS (SELECT episode_index, tasks[1] AS task, {_OK.format('o.note')} AS has_note, (episode_index * 48271 + 11) % 2147483647 % 100 AS u FROM e LEFT JOIN o USING (episode_index)) SELECT episode_index, CASE WHEN has_note AND u < 40 THEN 'memory' WHEN {_OK.format('task')} AND u < 80 THEN 'subtask' ELSE 'base' END AS builder FROM x")
def b17(spark: S, d: str) -> DataFrame:
    """A weighted choice among the builders whose fields are there."""
    u = (F.col("episode_index") * 48271 + 11) % 2147483647 % 100
    x = episodes(spark, d).select("episode_index", at("tasks", 0).alias("task")).join(notes(spark, d), "episode_index", "left")
    return x.select("episode_index", F.when(V.is_text(F.col("note")) & (u < 40), "memory").when(V.is_text(F.col("task")) & (u < 80), "subtask").otherwise("base").alias("builder"))


_CODES = "array_to_string(list_transform(g.state, lambda y: CASE WHEN y IS NULL OR NOT isfinite(y) THEN 'na' WHEN y < -1 THEN '-1' ELSE CAST(CAST(floor(least((CAST(y AS DOUBLE) + 1) * 128, 255)) AS BIGINT) AS VARCHAR) END), ' ')"


@query("b18_processed_sample", f"WITH {SQL_G}, {SQL_T} SELECT g.global_index, 'Command: ' || k.task || '; State: ' || {_CODES} || '; Robot: ' || t.embodiment_type AS sample FROM g JOIN t USING (episode_index) JOIN tasks k ON k.task_index = g.task_index WHERE g.state IS NOT NULL AND {_OK.format('k.task')}")
def b18(spark: S, d: str) -> DataFrame:
    """The whole row: lookup, quantized state of all dimensions and template."""
    t = F.broadcast(table(spark, d, "tasks").where(V.is_text(F.col("task"))))

    def code(y):
        v = y.cast("double")
        return F.when(y.isNull() | ~finite(v), "na").when(v < -1, "-1").otherwise(F.floor(F.least((v + 1) * 128, F.lit(255.0))).cast("string"))

    x = frames(spark, d, "state", "task_index").where("state is not null").join(t, "task_index").join(typed_episodes(spark, d), "episode_index")
    return x.select("global_index", F.concat(F.lit("Command: "), "task", F.lit("; State: "), F.concat_ws(" ", F.transform("state", code)), F.lit("; Robot: "), "embodiment_type").alias("sample"))


# collation and evaluation: the command is taken as a prediction of the state

_PAIR = f"{SQL_F}, {SQL_T}, p AS (SELECT embodiment_type, f.episode_index, generate_subscripts(action, 1) - 1 AS dim, CAST(unnest(action) AS DOUBLE) AS a, CAST(unnest(state) AS DOUBLE) AS s FROM f JOIN t USING (episode_index) WHERE action IS NOT NULL AND state IS NOT NULL AND len(action) = len(state)), w AS (SELECT * FROM p WHERE isfinite(a) AND isfinite(s))"


def pairs(spark: S, d: str) -> DataFrame:
    x = frames(spark, d, "action", "state").where("action is not null and state is not null and size(action) = size(state)").join(typed_episodes(spark, d), "episode_index")
    x = x.select("embodiment_type", "episode_index", F.posexplode(F.arrays_zip("action", "state")).alias("dim", "z"))
    x = x.select("embodiment_type", "episode_index", F.col("dim").cast("long").alias("dim"), F.col("z.action").cast("double").alias("a"), F.col("z.state").cast("double").alias("s"))
    return x.where(finite(F.col("a")) & finite(F.col("s")))


@query("c1_collated", f"WITH {SQL_E}, k AS (SELECT episode_index, embodiment, length, (row_number() OVER (PARTITION BY embodiment ORDER BY episode_index) - 1) // 16 AS batch FROM e) SELECT embodiment, batch, count(*) AS n, max(length) AS padded_to, CAST(sum(length) AS BIGINT) AS total FROM k GROUP BY ALL")
def c1(spark: S, d: str) -> DataFrame:
    """Batches of 16 and the length their ragged fields are padded to."""
    x = position_in_group(episodes(spark, d).select("embodiment", "length", "episode_index"), ["embodiment"], ["episode_index"], "k")
    return x.groupBy("embodiment", F.expr("k div 16").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("padded_to"), F.sum("length").alias("total"))


@query("e1_masked_l1", f"WITH {_PAIR} SELECT episode_index, count(*) AS cells, {rf('sum(abs(a - s)) / greatest(count(*), 1)')} AS l1 FROM w GROUP BY episode_index")
def e1(spark: S, d: str) -> DataFrame:
    """Mean absolute error over the cells that count."""
    return pairs(spark, d).groupBy("episode_index").agg(F.count(F.lit(1)).alias("cells"), RF(F.sum(F.abs(F.col("a") - F.col("s"))) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("l1"))


@query("e2_threshold_accuracy", f"WITH {_PAIR} SELECT embodiment_type, {rf('avg(CASE WHEN abs(a - s) < 0.00390625 THEN 1 ELSE 0 END)')} AS accuracy, {rf('avg(abs(a - s))')} AS l1 FROM w GROUP BY embodiment_type")
def e2(spark: S, d: str) -> DataFrame:
    """Share of cells within a threshold, and the error."""
    err = F.abs(F.col("a") - F.col("s"))
    return pairs(spark, d).groupBy("embodiment_type").agg(RF(F.avg(F.when(err < 1 / 256, 1).otherwise(0))).alias("accuracy"), RF(F.avg(err)).alias("l1"))


@query("e3_per_part_metrics", f"WITH {_PAIR} SELECT embodiment_type, part_key, {rf('avg(abs(a - s))')} AS l1, {rf('avg(CASE WHEN (a > 0.5) = (s > 0.5) THEN 1 ELSE 0 END)')} AS agreement FROM w JOIN joint_ranges j USING (embodiment_type, dim) GROUP BY ALL")
def e3(spark: S, d: str) -> DataFrame:
    """Errors by part, and agreement of the binary side."""
    j = F.broadcast(table(spark, d, "joint_ranges").select("embodiment_type", "dim", "part_key"))
    g = pairs(spark, d).join(j, ["embodiment_type", "dim"]).groupBy("embodiment_type", "part_key")
    return g.agg(RF(F.avg(F.abs(F.col("a") - F.col("s")))).alias("l1"), RF(F.avg(F.when((F.col("a") > 0.5) == (F.col("s") > 0.5), 1).otherwise(0))).alias("agreement"))


@query("e4_partial_then_final", f"WITH {_PAIR} SELECT embodiment_type, count(*) AS cells, {rf('sum(abs(a - s)) / count(*)')} AS l1, count(DISTINCT episode_index) AS episodes FROM w GROUP BY embodiment_type")
def e4(spark: S, d: str) -> DataFrame:
    """Sums and counts by episode, merged into those by type."""
    part = pairs(spark, d).groupBy("embodiment_type", "episode_index").agg(F.sum(F.abs(F.col("a") - F.col("s"))).alias("s"), F.count(F.lit(1)).alias("n"))
    return part.groupBy("embodiment_type").agg(F.sum("n").alias("cells"), RF(F.sum("s") / F.sum("n")).alias("l1"), F.count(F.lit(1)).alias("episodes"))


@query("e5_reduced_metrics", f"WITH {SQL_E}, m AS (SELECT episode_index % 4 AS rank, 'sample_count' AS metric, count(*)::DOUBLE AS v FROM e GROUP BY ALL UNION ALL SELECT episode_index % 4, 'mean_length', avg(length) FROM e GROUP BY ALL) SELECT metric, {r6('CASE WHEN metric = ' + chr(39) + 'sample_count' + chr(39) + ' THEN sum(v) ELSE avg(v) END')} AS v FROM m GROUP BY metric")
def e5(spark: S, d: str) -> DataFrame:
    """Metrics of several ranks: counts are added, the others averaged."""
    x = episodes(spark, d).groupBy((F.col("episode_index") % 4).alias("rank")).agg(F.count(F.lit(1)).cast("double").alias("sample_count"), F.avg("length").alias("mean_length"))
    m = x.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("v")) for c in ("sample_count", "mean_length")])).alias("z")).select("z.metric", "z.v")
    return m.groupBy("metric").agg(R6(F.when(F.col("metric") == "sample_count", F.sum("v")).otherwise(F.avg("v"))).alias("v"))


@query("e7_token_accuracy", f"WITH {SQL_E}, w AS (SELECT episode_index, string_split(coalesce(tasks[1], ''), ' ') AS t, string_split(coalesce(lag(tasks[1]) OVER (PARTITION BY robot_id ORDER BY episode_index), ''), ' ') AS g FROM e) SELECT episode_index, len(t) AS tokens, len(list_filter(range(1, len(t) + 1), lambda i: g[i] = t[i])) AS right_ones FROM w")
def e7(spark: S, d: str) -> DataFrame:
    """Tokens that match place by place over the target's length; short predictions count as wrong at the end."""
    x = with_previous(episodes(spark, d).select("robot_id", "episode_index", at("tasks", 0).alias("task")), "robot_id", "episode_index", "task")
    x = x.select("episode_index", F.split(F.coalesce("task", F.lit("")), " ").alias("t"), F.split(F.coalesce("previous", F.lit("")), " ").alias("g"))
    hit = F.size(F.filter(F.arrays_zip("t", F.slice("g", 1, 1000000).alias("g")), lambda z: (z["t"] == z["g"])))
    return x.select("episode_index", F.size("t").cast("long").alias("tokens"), hit.cast("long").alias("right_ones"))


@query("e8_two_level_l1", f"WITH {_PAIR}, m AS (SELECT embodiment_type, episode_index, avg(abs(a - s)) AS l1 FROM w GROUP BY ALL) SELECT t.embodiment_type, {rf('coalesce(avg(m.l1), -1)')} AS l1 FROM (SELECT DISTINCT embodiment_type FROM mixture) t LEFT JOIN m USING (embodiment_type) GROUP BY t.embodiment_type")
def e8(spark: S, d: str) -> DataFrame:
    """Mean of the episodes' means; -1 where there is none."""
    m = pairs(spark, d).groupBy("embodiment_type", "episode_index").agg(F.avg(F.abs(F.col("a") - F.col("s"))).alias("l1"))
    t = table(spark, d, "mixture").select("embodiment_type").distinct()
    return t.join(m.groupBy("embodiment_type").agg(F.avg("l1").alias("l1")), "embodiment_type", "left").select("embodiment_type", RF(F.coalesce("l1", F.lit(-1.0))).alias("l1"))


@query("e9_mean_since_flush", f"WITH {SQL_E} SELECT robot_id, (k - 1) // 8 AS flush, {r6('avg(length)')} AS mean FROM (SELECT robot_id, length, row_number() OVER (PARTITION BY robot_id ORDER BY episode_index) AS k FROM e) GROUP BY ALL")
def e9(spark: S, d: str) -> DataFrame:
    """Means since the last flush, one every eight episodes."""
    x = position_in_group(episodes(spark, d).select("robot_id", "length", "episode_index"), ["robot_id"], ["episode_index"], "k")
    return x.groupBy("robot_id", F.expr("k div 8").alias("flush")).agg(R6(F.avg("length")).alias("mean"))


@query("e10_batch_averages", f"WITH {_PAIR}, b AS (SELECT embodiment_type, episode_index // 32 AS batch, avg(abs(a - s)) AS l1 FROM w GROUP BY ALL) SELECT embodiment_type, count(*) AS batches, {rf('avg(l1)')} AS l1 FROM b GROUP BY embodiment_type")
def e10(spark: S, d: str) -> DataFrame:
    """Metrics averaged over batches, not over cells."""
    b = pairs(spark, d).groupBy("embodiment_type", F.expr("episode_index div 32").alias("batch")).agg(F.avg(F.abs(F.col("a") - F.col("s"))).alias("l1"))
    return b.groupBy("embodiment_type").agg(F.count(F.lit(1)).alias("batches"), RF(F.avg("l1")).alias("l1"))


@query("e11_success_rates", f"""WITH {SQL_E}, s AS (SELECT embodiment, dataset_dir, lower(is_episode_successful) IN ('true', '1') AS ok FROM e WHERE is_episode_successful IS NOT NULL)
SELECT embodiment, dataset_dir, count(*) AS trials, count(*) FILTER (WHERE ok) AS wins, {r6('count(*) FILTER (WHERE ok) / count(*)')} AS rate FROM s GROUP BY ROLLUP (embodiment, dataset_dir)""")
def e11(spark: S, d: str) -> DataFrame:
    """Success rates by dataset, embodiment and in all; totals are ratios of sums."""
    s = episodes(spark, d).where("is_episode_successful is not null").select("embodiment", "dataset_dir", F.lower("is_episode_successful").isin("true", "1").cast("long").alias("ok"))
    return s.rollup("embodiment", "dataset_dir").agg(F.count(F.lit(1)).alias("trials"), F.sum("ok").alias("wins"), R6(F.sum("ok") / F.count(F.lit(1))).alias("rate"))


@query("e12_mean_or_none", f"WITH {SQL_F} SELECT robot_id, {r6('avg(quality_index)')} AS quality, {r6('avg(coarse_task_index)')} AS coarse FROM f GROUP BY robot_id")
def e12(spark: S, d: str) -> DataFrame:
    """Means that skip nulls."""
    return frames(spark, d, "robot_id", "quality_index", "coarse_task_index").groupBy("robot_id").agg(R6(F.avg("quality_index")).alias("quality"), R6(F.avg("coarse_task_index")).alias("coarse"))


# streaming operators in batch form


@query("r1_count_batches", "SELECT user_id, (k - 1) // 5 AS batch, count(*) AS n, min(event_id) AS first_event FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) GROUP BY ALL")
def r1(spark: S, d: str) -> DataFrame:
    """Requests in batches of five by user."""
    x = position_in_group(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "k")
    return x.groupBy("user_id", F.expr("k div 5").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query("r2_chunk_schedule", f"WITH {SQL_G} SELECT global_index, rn // 8 AS chunk, rn % 8 AS step, rn % 8 = 0 AS recompute FROM g")
def r2(spark: S, d: str) -> DataFrame:
    """Which chunk serves a step, and when it is made anew."""
    x = ranked_frames(spark, d).withColumn("rn", F.col("rn").cast("long"))
    return x.select("global_index", F.expr("rn div 8").alias("chunk"), (F.col("rn") % 8).alias("step"), (F.col("rn") % 8 == 0).alias("recompute"))


@query("r3_temporal_ensemble", f"""WITH {SQL_G}, {SQL_D.format('action')}, c AS (SELECT episode_index, rn + s.step AS goal, dim, v + 0.01 * s.step AS v FROM d CROSS JOIN range(8) s(step) WHERE rn + s.step < n AND v IS NOT NULL)
SELECT episode_index, goal, dim, count(*) AS votes, CAST(round(avg(v), 9) AS FLOAT) + CAST(0 AS FLOAT) AS mean FROM c GROUP BY ALL""")
def r3(spark: S, d: str) -> DataFrame:
    """Overlapping chunks of eight: all predictions for one step are averaged, by dimension.

    No chunk is built: step t hears the anchors t-7 to t, so a frame over eight rows has their number and sums.
    """
    x = by_dimension(ranked_frames(spark, d, "action"), "action").withColumn("rn", F.col("rn").cast("long"))
    w = Window.partitionBy("episode_index", "dim").orderBy("rn").rangeBetween(-7, 0)
    drift = F.sum(F.when(F.col("v").isNotNull(), F.col("rn"))).over(w)
    c = x.select("episode_index", F.col("rn").alias("goal"), "dim", F.count("v").over(w).alias("votes"), F.avg("v").over(w).alias("m"), drift.alias("drift")).where("votes > 0")
    return c.select("episode_index", "goal", "dim", "votes", (F.round(F.col("m") + 0.01 * (F.col("goal") - F.col("drift") / F.col("votes")), 9).cast("float") + F.lit(0.0).cast("float")).alias("mean"))


@query("r4_history_buffer", f"WITH {SQL_G}, h AS (SELECT a.global_index, s.back, b.task_index FROM g a CROSS JOIN range(4) s(back) JOIN g b ON b.episode_index = a.episode_index AND b.rn = greatest(a.rn - s.back, 0)) SELECT global_index, CAST(sum(task_index * (back + 1)) AS BIGINT) AS checksum FROM h GROUP BY global_index")
def r4(spark: S, d: str) -> DataFrame:
    """The last four observations; the first one fills up a new buffer."""
    terms = [clamped_shift("task_index", -k) * (k + 1) if k else F.col("task_index") for k in range(4)]
    return ranked_frames(spark, d, "task_index").select("global_index", sum(terms[1:], terms[0]).alias("checksum"))


@query("r7_request_errors", f"WITH {SQL_F}, {SQL_T}, w AS (SELECT embodiment_type, count(*) AS want FROM joint_ranges GROUP BY ALL) SELECT CASE WHEN state IS NULL THEN 'no_state' WHEN len(state) <> want THEN 'width' WHEN len(list_filter(state, lambda y: NOT isfinite(y))) > 0 THEN 'not_finite' ELSE 'ok' END AS code, count(*) AS n FROM f JOIN t USING (episode_index) JOIN w USING (embodiment_type) GROUP BY ALL")
def r7(spark: S, d: str) -> DataFrame:
    """Requests by error code."""
    w = F.broadcast(table(spark, d, "joint_ranges").groupBy("embodiment_type").agg(F.count(F.lit(1)).alias("want")))
    x = frames(spark, d, "state").join(typed_episodes(spark, d), "episode_index").join(w, "embodiment_type")
    code = F.when(F.col("state").isNull(), "no_state").when(F.size("state") != F.col("want"), "width").when(F.exists("state", lambda y: F.isnan(y) | (F.abs(y) == float("inf"))), "not_finite").otherwise("ok")
    return x.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("r8_task_changes", f"WITH {SQL_F} SELECT episode_index, frame_index FROM (SELECT *, lag(task_index) OVER (PARTITION BY episode_index ORDER BY frame_index) AS p FROM f) WHERE p IS NULL OR p <> task_index")
def r8(spark: S, d: str) -> DataFrame:
    """Steps at which the task changes and everything is computed anew."""
    p = F.lag("task_index").over(in_episode())
    return frames(spark, d, "task_index").withColumn("p", p).where("p is null or p <> task_index").select("episode_index", "frame_index")
