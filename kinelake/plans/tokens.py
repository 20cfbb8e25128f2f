"""Templates, labels, serializers, further prompts, layouts and rotations, files written and read again."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import rotations as R
from kinelake.functions import templates as M
from kinelake.functions import vectors as V
from kinelake.ordering import position_in_group
from kinelake.plans.analytics import finite
from kinelake.plans.base import R6, RF, SQL_E, SQL_F, SQL_G, SQL_T, episodes, frames, r6, ranked_frames, rf, typed_episodes
from kinelake.plans.prompts import _NOTE, _OK, notes, prompt
from kinelake.plans.registry import query
from kinelake.plans.transforms import _BOX, _LOC, _V, _loc, at, boxes, vec
from kinelake.session import scratch
from kinelake.sources import datasets as ds
from kinelake.tables import table

S = SparkSession

# templates

TEMPLATE = "Robot <robot_id:text!@8> does <task:text@12> among <tasks:set!> in <length:number> ."


def _template_rows(spark: S, d: str) -> DataFrame:
    return episodes(spark, d).select("episode_index", "robot_id", "tasks", "length", F.get("tasks", F.lit(0)).alias("task"))


_FIELDS = """r AS (SELECT episode_index, coalesce(substr(lower(trim(robot_id, ' ')), 1, 8), '') AS robot, coalesce(substr(lower(trim(tasks[1], ' ')), 1, 12), '') AS task,
coalesce(array_to_string(list_sort(list_distinct(list_filter(tasks, lambda x: x IS NOT NULL))), '|'), '') AS many, coalesce('<n' || CAST(length AS VARCHAR) || '>', '') AS num FROM e)"""


@query("q10_template", f"WITH {SQL_E}, {_FIELDS} SELECT episode_index, 'Robot ' || robot || ' does ' || task || ' among ' || many || ' in ' || num || ' .' AS text FROM r")
def q10(spark: S, d: str) -> DataFrame:
    """A template parsed on the driver into column expressions: fields by rule, with limits, and static text."""
    return _template_rows(spark, d).select("episode_index", M.rendered(M.parse(TEMPLATE)).alias("text"))


_TOK = "list_filter(string_split({0}, ' '), lambda x: x <> '')"


@query("q11_labels", f"""WITH {SQL_E}, {_FIELDS}, k AS (SELECT episode_index, list_concat(['Robot'], {_TOK.format('robot')}, ['does'], {_TOK.format('task')}, ['among'], {_TOK.format('many')}, ['in', num, '.']) AS ids, {_TOK.format('task')} AS a, len({_TOK.format('robot')}) AS r, len({_TOK.format('many')}) AS m, num FROM r),
l AS (SELECT episode_index, ids, list_concat(list_transform(range(2 + r), lambda i: '<ignore>'), a, list_transform(range(2 + m), lambda i: '<ignore>'), [num, '<ignore>']) AS labels FROM k)
SELECT episode_index, array_to_string(list_concat(ids[1:16], list_transform(range(greatest(16 - len(ids), 0)), lambda i: '<pad>')), ' ') AS ids,
array_to_string(list_concat(labels[1:16], list_transform(range(greatest(16 - len(labels), 0)), lambda i: '<ignore>')), ' ') AS labels, least(len(ids), 16) AS kept FROM l""")
def q11(spark: S, d: str) -> DataFrame:
    """Tokens, labels and mask of a template in sixteen places; static text and quiet fields bear no loss."""
    ids, labels, mask = M.assembled(M.parse(TEMPLATE), 16)
    x = _template_rows(spark, d).select("episode_index", F.array_join(ids, " ").alias("ids"), F.array_join(labels, " ").alias("labels"), F.size(F.filter(mask, lambda m: m)).cast("long").alias("kept"))
    return x


@query("q12_modalities", f"WITH {SQL_E} SELECT episode_index, coalesce(lower(trim(operator, ' ')), '') AS as_text, '<n' || CAST(CAST(floor(length / 25.0) AS BIGINT) AS VARCHAR) || '>' AS as_number, len(list_distinct(list_filter(tasks, lambda x: x IS NOT NULL))) AS in_set FROM e WHERE length IS NOT NULL")
def q12(spark: S, d: str) -> DataFrame:
    """Fields by the rules of their modality, which are found by name."""
    rule = M.modalities.build
    x = episodes(spark, d).where("length is not null")
    many = F.size(F.array_distinct(F.filter("tasks", lambda t: t.isNotNull()))).cast("long")
    return x.select("episode_index", F.coalesce(rule({"name": "text"})(F.col("operator")), F.lit("")).alias("as_text"), rule({"name": "number", "step": 25.0})(F.col("length")).alias("as_number"), F.when(F.col("tasks").isNotNull(), many).alias("in_set"))


@query("q13_token_registry", "WITH k AS (SELECT DISTINCT '<' || part_key || '>' AS token FROM joint_ranges UNION SELECT DISTINCT '<' || embodiment_type || '>' FROM joint_ranges) SELECT token, 50000 + row_number() OVER (ORDER BY token) - 1 AS id FROM k")
def q13(spark: S, d: str) -> DataFrame:
    """Tokens added behind a vocabulary of fifty thousand, each once; the table is fixed."""
    r = table(spark, d, "joint_ranges")
    k = r.select(F.concat(F.lit("<"), "part_key", F.lit(">")).alias("token")).union(r.select(F.concat(F.lit("<"), "embodiment_type", F.lit(">")))).distinct()
    return position_in_group(k, [], ["token"], "k").select("token", (F.col("k") + 50_000).alias("id"))


# serializers: codes of the first and last state of an episode's parts

_CODES = f"""{SQL_G}, {SQL_T}, q AS (SELECT embodiment_type, part_key, min(dim) AS start FROM joint_ranges GROUP BY ALL),
b AS (SELECT t.episode_index, q.part_key, CASE WHEN rn = 0 THEN 0 ELSE 1 END AS block, CAST(g.state[q.start + 1] AS DOUBLE) AS v FROM g JOIN t USING (episode_index) JOIN q USING (embodiment_type) WHERE rn IN (0, n - 1)),
c AS (SELECT *, CASE WHEN v IS NULL OR NOT isfinite(v) OR abs(v) > 4 THEN -1 ELSE least(CAST(floor((v + 4) * 32) AS BIGINT), 255) END AS code FROM b),
p AS (SELECT episode_index, part_key, max(CASE WHEN block = 0 THEN code END) AS c0, coalesce(max(CASE WHEN block = 1 THEN code END), max(CASE WHEN block = 0 THEN code END)) AS c1 FROM c GROUP BY ALL),
u AS (SELECT * FROM p WHERE c0 >= 0 AND c1 >= 0)"""


def part_codes(spark: S, d: str) -> DataFrame:
    """A code of the first and the last state of each part's first dimension; -1 where it can't be coded. An episode of one frame has the same twice."""
    q = F.broadcast(table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.min("dim").alias("start")))
    x = ranked_frames(spark, d, "state").where("rn in (0, n - 1)").join(typed_episodes(spark, d), "episode_index").join(q, "embodiment_type")
    v = F.get("state", F.col("start").cast("int")).cast("double")
    code = F.when(v.isNull() | ~finite(v) | (F.abs(v) > 4), F.lit(-1)).otherwise(F.least(F.floor((v + 4) * 32), F.lit(255))).cast("long")
    x = x.select("episode_index", "part_key", "rn", code.alias("code"))
    return x.groupBy("episode_index", "part_key").agg(F.min_by("code", "rn").alias("c0"), F.max_by("code", "rn").alias("c1"))


def serialized(codes: DataFrame) -> DataFrame:
    """One stream per episode: a sign for each part, then its codes, coarse level of all blocks first; parts with a code that isn't used are left out."""
    def level(f):
        return [f(F.col("c0")), f(F.col("c1"))]

    body = F.concat_ws(" ", F.concat(F.lit("<"), "part_key", F.lit(">")), *[x.cast("string") for x in (*level(lambda c: F.floor(c / 16)), *level(lambda c: c % 16))])
    used = codes.where("c0 >= 0 and c1 >= 0").select("episode_index", F.struct("part_key", body.alias("body")).alias("z"))
    return used.groupBy("episode_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list("z")), lambda z: z["body"]), " ").alias("stream"))


@query("q6_part_stream", f"WITH {_CODES} SELECT episode_index, string_agg('<' || part_key || '> ' || (c0 // 16) || ' ' || (c1 // 16) || ' ' || (c0 % 16) || ' ' || (c1 % 16), ' ' ORDER BY part_key) AS stream FROM u GROUP BY episode_index")
def q6(spark: S, d: str) -> DataFrame:
    """Parts of an episode as a stream of tokens; an episode has a handful of parts."""
    return serialized(part_codes(spark, d))


@query("q8_decoded_stream", f"WITH {_CODES}, w AS (SELECT DISTINCT embodiment_type, part_key FROM joint_ranges), s AS (SELECT DISTINCT episode_index FROM u) SELECT s.episode_index, w.part_key, u.c0 IS NULL AS absent, {r6('coalesce((u.c0 + 0.5) / 32 - 4, 0)')} AS first_value, {r6('coalesce((u.c1 + 0.5) / 32 - 4, 0)')} AS last_value FROM s JOIN t USING (episode_index) JOIN w USING (embodiment_type) LEFT JOIN u ON u.episode_index = s.episode_index AND u.part_key = w.part_key")
def q8(spark: S, d: str) -> DataFrame:
    """Streams read back by their signs: parts that are absent get 0 and are named."""
    s = q6(spark, d).join(typed_episodes(spark, d), "episode_index")
    w = F.broadcast(table(spark, d, "joint_ranges").select("embodiment_type", "part_key").distinct())
    x = s.join(w, "embodiment_type")
    t = F.split("stream", " ")
    sign = F.array_position(t, F.concat(F.lit("<"), F.col("part_key"), F.lit(">"))).cast("int")

    def value(block: int) -> Column:
        code = F.try_element_at(t, sign + 1 + block).cast("double") * 16 + F.try_element_at(t, sign + 3 + block).cast("double")
        return F.when(sign > 0, (code + 0.5) / 32 - 4).otherwise(0.0)

    return x.select("episode_index", "part_key", (sign == 0).alias("absent"), R6(value(0)).alias("first_value"), R6(value(1)).alias("last_value"))


# prompts

_DOC = "x AS (SELECT d.doc_id, coalesce(e.tasks[1], '') AS task, b FROM b JOIN documents d USING (doc_id) LEFT JOIN e ON e.episode_index = d.episode_index)"


@query("b9_box_subtask_prompt", f"WITH {SQL_E}, {_BOX}, {_DOC} SELECT doc_id, 'Command: find; BBox: object ' || {_LOC.format('b[2]')} || {_LOC.format('b[1]')} || {_LOC.format('b[4]')} || {_LOC.format('b[3]')} || '; Subtask: ' || task || '; Action: ' AS prompt FROM x")
def b9(spark: S, d: str) -> DataFrame:
    """With a box and the task at hand."""
    x = boxes(spark, d).join(table(spark, d, "documents").select("doc_id", "episode_index"), "doc_id")
    x = x.join(episodes(spark, d).select("episode_index", F.get("tasks", F.lit(0)).alias("task")), "episode_index", "left")
    box = F.concat(F.lit("object "), *[_loc(F.get("b", F.lit(i))) for i in (1, 0, 3, 2)])
    return x.select("doc_id", prompt(F.lit("find"), ("BBox", box), ("Subtask", F.coalesce("task", F.lit("")))).alias("prompt"))


@query("b10_trace_prompt", f"WITH {_BOX} SELECT doc_id, 'Command: follow; Trace: left ' || {_LOC.format('b[1]')} || {_LOC.format('b[2]')} || CASE WHEN b[3] > 0 AND b[4] > 0 THEN ' right ' || {_LOC.format('b[3]')} || {_LOC.format('b[4]')} ELSE '' END || '; Action: ' AS prompt FROM b")
def b10(spark: S, d: str) -> DataFrame:
    """With the traced points of both hands; a hand that isn't seen is left out."""
    b = [F.get("b", F.lit(i)) for i in range(4)]
    right = F.when((b[2] > 0) & (b[3] > 0), F.concat(F.lit(" right "), _loc(b[2]), _loc(b[3]))).otherwise("")
    return boxes(spark, d).select("doc_id", prompt(F.lit("follow"), ("Trace", F.concat(F.lit("left "), _loc(b[0]), _loc(b[1]), right))).alias("prompt"))


@query("b12_high_level_prompt", f"WITH {SQL_E} SELECT episode_index, 'Command: ' || dataset_dir || '; Subtask: ' || tasks[1] || '; Action: ' AS prompt FROM e WHERE dataset_dir IS NOT NULL AND {_OK.format('tasks[1]')}")
def b12(spark: S, d: str) -> DataFrame:
    """The instruction of the higher level is the command, the task at hand is what is thought first."""
    t = F.get("tasks", F.lit(0))
    return episodes(spark, d).where(F.col("dataset_dir").isNotNull() & V.is_text(t)).select("episode_index", prompt(F.col("dataset_dir"), ("Subtask", t)).alias("prompt"))


@query("b15_memory_subtask_prompt", f"WITH {SQL_E}, {_NOTE} SELECT episode_index, 'Command: ' || dataset_dir || '; Memory: ' || note || '; Subtask: ' || tasks[1] || '; Action: ' AS prompt FROM e JOIN o USING (episode_index) WHERE dataset_dir IS NOT NULL AND {_OK.format('note')} AND {_OK.format('tasks[1]')}")
def b15(spark: S, d: str) -> DataFrame:
    """With the memory and the task at hand."""
    t = F.get("tasks", F.lit(0))
    x = episodes(spark, d).join(notes(spark, d), "episode_index").where(F.col("dataset_dir").isNotNull() & V.is_text(F.col("note")) & V.is_text(t))
    return x.select("episode_index", prompt(F.col("dataset_dir"), ("Memory", F.col("note")), ("Subtask", t)).alias("prompt"))


# layouts

@query("c2_layout_lookup", f"WITH {SQL_E}, w AS (SELECT m.embodiment, count(*) AS width FROM mixture m JOIN joint_ranges r USING (embodiment_type) GROUP BY m.embodiment) SELECT k.embodiment, coalesce(w.width, 16) AS width, w.width IS NULL AS defaulted FROM (SELECT DISTINCT embodiment FROM e) k LEFT JOIN w ON w.embodiment = k.embodiment")
def c2(spark: S, d: str) -> DataFrame:
    """The width of each embodiment's layout, a default where there is none."""
    w = table(spark, d, "mixture").select("embodiment", "embodiment_type").join(table(spark, d, "joint_ranges"), "embodiment_type").groupBy("embodiment").agg(F.count(F.lit(1)).alias("width"))
    k = episodes(spark, d).select("embodiment").distinct().join(F.broadcast(w), "embodiment", "left")
    return k.select("embodiment", F.coalesce("width", F.lit(16).cast("long")).alias("width"), F.col("width").isNull().alias("defaulted"))


@query("m4_identity_merge", f"WITH {SQL_F} SELECT global_index, len(action) AS action_width, len(state) AS state_width, CAST(list_max(list_filter(action, lambda y: isfinite(y))) AS DOUBLE) AS top FROM f WHERE action IS NOT NULL AND state IS NOT NULL")
def m4(spark: S, d: str) -> DataFrame:
    """Merging that leaves vectors as they are."""
    x = frames(spark, d, "action", "state").where("action is not null and state is not null")
    top = F.array_max(F.filter(V.doubles(F.col("action")), lambda y: finite(y)))
    return x.select("global_index", F.size("action").cast("long").alias("action_width"), F.size("state").cast("long").alias("state_width"), top.alias("top"))


@query("m8_canonical_parts", f"""WITH {SQL_F}, {SQL_T}, q AS (SELECT embodiment_type, part_key, min(dim) AS start, count(*) AS width FROM joint_ranges GROUP BY ALL), k AS (SELECT part_key, max(width) AS most FROM q GROUP BY part_key),
x AS (SELECT f.global_index, k.part_key, k.most, q.width, CASE WHEN q.width IS NULL THEN 0 ELSE coalesce(list_sum(list_transform(list_filter(f.state[q.start + 1 : q.start + q.width], lambda y: isfinite(y)), lambda y: CAST(y AS DOUBLE))), 0) END AS total FROM f JOIN t USING (episode_index) CROSS JOIN k LEFT JOIN q ON q.embodiment_type = t.embodiment_type AND q.part_key = k.part_key WHERE f.state IS NOT NULL)
SELECT global_index, CAST(sum(most) AS BIGINT) AS width, CAST(sum(most - coalesce(width, 0)) AS BIGINT) AS filled, {rf('sum(total)')} AS total FROM x GROUP BY global_index""")
def m8(spark: S, d: str) -> DataFrame:
    """States spread over the parts of all types, zeros where a type lacks a part; readings that are not finite become 0.

    The layout of a type is one row, made from a fixed table; no part is a row of its own.
    """
    q = table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.min("dim").cast("int").alias("start"), F.count(F.lit(1)).cast("int").alias("width"))
    k = q.groupBy("part_key").agg(F.max("width").alias("most"))
    types = q.select("embodiment_type").distinct()
    full = types.crossJoin(F.broadcast(k)).join(q, ["embodiment_type", "part_key"], "left")
    layout = full.groupBy("embodiment_type").agg(F.array_sort(F.collect_list(F.struct("part_key", "start", "width", "most"))).alias("parts"))
    x = frames(spark, d, "state").where("state is not null").join(typed_episodes(spark, d), "episode_index").join(F.broadcast(layout), "embodiment_type")

    def spread(p: Column) -> Column:
        own = F.when(p["width"].isNotNull(), F.slice("state", p["start"] + 1, p["width"])).otherwise(F.array().cast("array<float>"))
        clean = F.transform(own, lambda y: F.when(finite(y), y.cast("double")).otherwise(0.0))
        return F.concat(clean, F.array_repeat(F.lit(0.0), p["most"] - F.size(clean)))

    y = x.select("global_index", F.flatten(F.transform("parts", spread)).alias("v"), F.aggregate("parts", F.lit(0), lambda a, p: a + p["most"] - F.coalesce(p["width"], F.lit(0))).alias("filled"))
    return y.select("global_index", F.size("v").cast("long").alias("width"), F.col("filled").cast("long").alias("filled"), RF(V.total(F.col("v"))).alias("total"))


@query("m9_missing_cameras", "WITH w AS (SELECT * FROM (VALUES ('head_rgb'), ('wrist_rgb'), ('rig1_rgb')) v(slot)), f AS (SELECT DISTINCT file_id FROM shape_meta), i AS (SELECT file_id, part_key, min(lerobot_key) AS k FROM shape_meta WHERE category = 'images' GROUP BY ALL) SELECT f.file_id, w.slot, coalesce(i.k, 'zeros') AS camera FROM f CROSS JOIN w LEFT JOIN i ON i.file_id = f.file_id AND i.part_key = w.slot")
def m9(spark: S, d: str) -> DataFrame:
    """Cameras that a layout wants; a missing one is filled with zeros."""
    s = table(spark, d, "shape_meta").select("file_id", "category", "part_key", "lerobot_key")
    slots = ("head_rgb", "wrist_rgb", "rig1_rgb")
    g = s.groupBy("file_id").agg(*[F.min(F.when((F.col("category") == "images") & (F.col("part_key") == c), F.col("lerobot_key"))).alias(c) for c in slots])
    return g.select("file_id", F.explode(F.array(*[F.struct(F.lit(c).alias("slot"), F.coalesce(c, F.lit("zeros")).alias("camera")) for c in slots])).alias("z")).select("file_id", "z.*")


@query("u3_concatenated", f"WITH {SQL_E}, x AS (SELECT dataset_dir, episode_index, unnest(tasks) AS task, generate_subscripts(tasks, 1) AS i FROM e) SELECT dataset_dir, row_number() OVER (PARTITION BY dataset_dir ORDER BY episode_index, i) - 1 AS position, task FROM x")
def u3(spark: S, d: str) -> DataFrame:
    """Lists of all episodes of a dataset one behind the other, by place; no row holds a whole list."""
    x = episodes(spark, d).select("dataset_dir", "episode_index", F.posexplode("tasks").alias("i", "task"))
    return position_in_group(x, ["dataset_dir"], ["episode_index", "i"], "position").select("dataset_dir", "position", "task")


# rotations

_QN = "q AS (SELECT vec_id, x[1] AS w, x[2] AS i, x[3] AS j, x[4] AS k FROM v), n AS (SELECT vec_id, w / s AS w, i / s AS i, j / s AS j, k / s AS k FROM (SELECT *, sqrt(w * w + i * i + j * j + k * k + 4e-8) AS s FROM q))"


@query("xmath8_fused_six", f"WITH {_V}, {_QN} SELECT vec_id, {r6('1 - 2 * (j * j + k * k)')} AS a, {r6('2 * (i * j - k * w)')} AS b, {r6('2 * (i * k + j * w)')} AS c, {r6('2 * (i * j + k * w)')} AS d, {r6('1 - 2 * (i * i + k * k)')} AS e, {r6('2 * (j * k - i * w)')} AS f FROM n")
def xmath8(spark: S, d: str) -> DataFrame:
    """Six numbers of a quaternion of any length in one expression; each square gets 1e-8, so a zero quaternion divides by no zero."""
    q = [at("x", i) for i in range(4)]
    s = F.sqrt(sum((x * x for x in q), F.lit(4e-8)))
    w, i, j, k = (x / s for x in q)
    six = (1 - 2 * (j * j + k * k), 2 * (i * j - k * w), 2 * (i * k + j * w), 2 * (i * j + k * w), 1 - 2 * (i * i + k * k), 2 * (j * k - i * w))
    return vec(spark, d).select("vec_id", *[R6(c).alias(n) for n, c in zip("abcdef", six)])


def _uniform(key: str, salt: int) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    return ((F.col(key) * 48271 + salt) % 2147483647 + 0.5) / F.lit(2147483648.0)


def _normal(key: str, salt: int) -> Column:
    return F.sqrt(-2 * F.log(_uniform(key, 7919 * salt + 11))) * F.cos(2 * math.pi * _uniform(key, 104729 * salt + 17))


def _sql_normal(key: str, salt: int) -> str:
    return f"(sqrt(-2 * ln((({key} * 48271 + {7919 * salt + 11}) % 2147483647 + 0.5) / 2147483648.0::DOUBLE)) * cos({2 * math.pi!r}::DOUBLE * ((({key} * 48271 + {104729 * salt + 17}) % 2147483647 + 0.5) / 2147483648.0::DOUBLE)))"


@query("xmath9_random_rotations", f"WITH g AS (SELECT vec_id, {', '.join(f'{_sql_normal(chr(118) + chr(101) + chr(99) + chr(95) + chr(105) + chr(100), s)} AS g{s}' for s in range(4))} FROM embeddings), n AS (SELECT *, sqrt(g0 * g0 + g1 * g1 + g2 * g2 + g3 * g3) * CASE WHEN g0 < 0 THEN -1 ELSE 1 END AS s FROM g) SELECT vec_id, {', '.join(r6(f'g{s} / s') + f' AS q{s}' for s in range(4))} FROM n")
def xmath9(spark: S, d: str) -> DataFrame:
    """Random unit quaternions with a real part that isn't negative: four normal numbers of the key, normalized."""
    g = [_normal("vec_id", s) for s in range(4)]
    x = table(spark, d, "embeddings").select("vec_id", *[c.alias(f"g{s}") for s, c in enumerate(g)])
    q = R.positive(R.unit([F.col(f"g{s}") for s in range(4)]))
    return x.select("vec_id", *[R6(c).alias(f"q{s}") for s, c in enumerate(q)])


_EUL = """e AS (SELECT vec_id, x[1] AS px, x[2] AS py, x[3] AS pz, cos(x[4] / 2) AS cr, sin(x[4] / 2) AS sr, cos(x[5] / 2) AS cp, sin(x[5] / 2) AS sp, cos(x[6] / 2) AS cy, sin(x[6] / 2) AS sy FROM v)"""


@query("t7_euler_quaternion", f"WITH {_V}, {_EUL} SELECT vec_id, {r6('px + py + pz')} AS place, {r6('sr * cp * cy - cr * sp * sy')} AS qx, {r6('cr * sp * cy + sr * cp * sy')} AS qy, {r6('cr * cp * sy - sr * sp * cy')} AS qz, {r6('cr * cp * cy + sr * sp * sy')} AS qw FROM e")
def t7(spark: S, d: str) -> DataFrame:
    """Poses of place and Euler angles as places and quaternions, the real part last."""
    q = quaternion_of_euler([at("x", i) for i in (3, 4, 5)])
    return vec(spark, d).select("vec_id", R6(at("x", 0) + at("x", 1) + at("x", 2)).alias("place"), *[R6(c).alias(n) for n, c in zip(("qx", "qy", "qz", "qw"), (*q[1:], q[0]))])


def quaternion_of_euler(angles: list[Column]) -> list[Column]:
    """Product of the rotations about z, y and x, the real part first."""
    half = [(F.cos(a / 2), F.sin(a / 2)) for a in angles]
    zero = F.lit(0.0)
    x, y, z = ([half[0][0], half[0][1], zero, zero], [half[1][0], zero, half[1][1], zero], [half[2][0], zero, zero, half[2][1]])
    return R.multiply(z, R.multiply(y, x))


@query("t7_euler_back", f"WITH {_V} SELECT vec_id, {r6('x[4]')} AS roll, {r6('x[5]')} AS pitch, {r6('x[6]')} AS yaw FROM v WHERE abs(x[5]) < 1.5 AND abs(x[4]) < 3 AND abs(x[6]) < 3")
def t7_back(spark: S, d: str) -> DataFrame:
    """Quaternions back to Euler angles, where these are unique."""
    e = R.euler_of(R.matrix(quaternion_of_euler([at("x", i) for i in (3, 4, 5)])))
    x = vec(spark, d).where((F.abs(at("x", 4)) < 1.5) & (F.abs(at("x", 3)) < 3) & (F.abs(at("x", 5)) < 3))
    return x.select("vec_id", *[R6(c).alias(n) for n, c in zip(("roll", "pitch", "yaw"), e)])


@query("t8_pose_noise", f"WITH {_V} SELECT vec_id, {', '.join(r6(f'x[{i + 1}] + 0.05 * ' + _sql_normal('vec_id', i + 4)) + f' AS p{i}' for i in range(3))} FROM v")
def t8(spark: S, d: str) -> DataFrame:
    """Places with normal noise of 0.05 that depends on the key alone."""
    return vec(spark, d).select("vec_id", *[R6(at("x", i) + 0.05 * _normal("vec_id", i + 4)).alias(f"p{i}") for i in range(3)])


# requests and configuration

@query("r6_isolated_errors", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN props IS NULL THEN 'empty' WHEN NOT json_valid(props) THEN 'syntax' WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL THEN 'field' WHEN value < 0 THEN 'value' ELSE 'ok' END AS code FROM events""")
def r6_errors(spark: S, d: str) -> DataFrame:
    """A request that can't be read fails alone: its code says why, all others go on."""
    m = F.from_json("props", "map<string,string>")
    k = m["k"].try_cast("bigint")
    code = F.when(F.col("props").isNull(), "empty").when(m.isNull(), "syntax").when(k.isNull(), "field").when(F.col("value") < 0, "value").otherwise("ok")
    return table(spark, d, "events").select("event_id", k.alias("k"), code.alias("code"))


_FEATURES = "f AS (SELECT file_id, arg_min(codebase_version, received_at) AS v FROM info_files GROUP BY file_id)"


@query("f20_versions", f"WITH {_FEATURES}, n AS (SELECT file_id, v, TRY_CAST(split_part(ltrim(v, 'v'), '.', 1) AS BIGINT) AS a, coalesce(TRY_CAST(split_part(ltrim(v, 'v'), '.', 2) AS BIGINT), 0) AS b FROM f) SELECT file_id, CASE WHEN a IS NULL THEN 'unknown' WHEN a < 3 THEN 'too_old' WHEN a = 3 AND b = 0 THEN 'ok' ELSE 'newer' END AS verdict FROM n")
def f20(spark: S, d: str) -> DataFrame:
    """Versions of files against that of the reader, 3.0: an older major version can't be read."""
    f = table(spark, d, "info_files").groupBy("file_id").agg(F.min_by("codebase_version", "received_at").alias("v"))
    p = F.split(F.regexp_replace("v", "^v+", ""), r"\.")
    a, b = F.get(p, F.lit(0)).try_cast("bigint"), F.coalesce(F.get(p, F.lit(1)).try_cast("bigint"), F.lit(0))
    return f.select("file_id", F.when(a.isNull(), "unknown").when(a < 3, "too_old").when((a == 3) & (b == 0), "ok").otherwise("newer").alias("verdict"))


@query("f22_configuration", "WITH p AS (SELECT embodiment, CASE WHEN weight IS NULL OR weight <= 0 THEN 'weight' WHEN coalesce(val_set_proportion, 0.05) + coalesce(test_set_proportion, 0.05) >= 1 THEN 'proportions' WHEN fps IS NULL OR fps <= 0 THEN 'fps' WHEN embodiment_type NOT IN (SELECT embodiment_type FROM joint_ranges) THEN 'layout' ELSE 'ok' END AS problem FROM mixture) SELECT embodiment, problem FROM p")
def f22(spark: S, d: str) -> DataFrame:
    """Consistency of the configuration: the first thing that is wrong with each source; fixed tables."""
    known = F.broadcast(table(spark, d, "joint_ranges").select("embodiment_type").distinct().withColumn("known", F.lit(True)))
    m = table(spark, d, "mixture").join(known, "embodiment_type", "left")
    share = F.coalesce("val_set_proportion", F.lit(0.05)) + F.coalesce("test_set_proportion", F.lit(0.05))
    problem = F.when(F.col("weight").isNull() | (F.col("weight") <= 0), "weight").when(share >= 1, "proportions").when(F.col("fps").isNull() | (F.col("fps") <= 0), "fps")
    return m.select("embodiment", problem.when(F.col("known").isNull() & F.col("embodiment_type").isNotNull(), "layout").otherwise("ok").alias("problem"))


@query("s15_merged_configuration", "SELECT embodiment, coalesce(val_set_proportion, 0.05) AS val, coalesce(test_set_proportion, 0.05) AS test, CASE WHEN fps > 20 THEN 20 ELSE fps END AS fps, (SELECT max(c) FROM (SELECT count(*) AS c FROM joint_ranges GROUP BY embodiment_type)) AS max_width FROM mixture")
def s15(spark: S, d: str) -> DataFrame:
    """Defaults, overridden by what a source says, with a resolved value: the widest layout."""
    widest = table(spark, d, "joint_ranges").groupBy("embodiment_type").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c").alias("max_width"))
    m = table(spark, d, "mixture").crossJoin(F.broadcast(widest))
    return m.select("embodiment", F.coalesce("val_set_proportion", F.lit(0.05)).alias("val"), F.coalesce("test_set_proportion", F.lit(0.05)).alias("test"), F.least("fps", F.lit(20)).cast("long").alias("fps"), "max_width")


# files written and read again

@query("s2_files_of_features", f"WITH {SQL_F}, {SQL_E} SELECT f.global_index, f.episode_index, f.frame_index, len(f.action) AS width FROM f JOIN e USING (episode_index) WHERE e.length >= 60")
def s2(spark: S, d: str) -> DataFrame:
    """Frames written in a dataset's layout and read by its features: image columns are none, columns and rows of frames are selected in the scan."""
    path = scratch(spark, "dataset")
    ds.write_frames(frames(spark, d, "action", "task_index"), path)
    features = {"global_index": {"dtype": "int64", "shape": [1]}, "episode_index": {"dtype": "int64", "shape": [1]}, "frame_index": {"dtype": "int64", "shape": [1]}, "action": {"dtype": "float32", "shape": [14]}, "camera": {"dtype": "video", "shape": [3, 4, 4]}}
    x = ds.read_frames(spark, path, list(ds.schema_of(features).names), schema=ds.schema_of(features))
    long_ones = episodes(spark, d).where("length >= 60").select("episode_index")
    return x.join(long_ones, "episode_index", "left_semi").select("global_index", "episode_index", "frame_index", F.when(F.col("action").isNotNull(), F.size("action")).cast("long").alias("width"))


@query("k4_episode_metadata", f"WITH {SQL_E} SELECT episode_index, length, dataset_from_index, dataset_to_index FROM e")
def k4(spark: S, d: str) -> DataFrame:
    """Rows of episodes written as metadata files and read back."""
    path = scratch(spark, "dataset")
    ds.write_episodes(episodes(spark, d).select("episode_index", "length", "dataset_from_index", "dataset_to_index"), path)
    return spark.read.parquet(f"{path}/meta/episodes")


@query("s7_metadata", f"WITH {SQL_E} SELECT 'episodes' AS what, count(*) AS n FROM e UNION ALL SELECT 'stats', count(*) FROM stats WHERE stat_mean IS NOT NULL UNION ALL SELECT 'task', count(*) FROM tasks UNION ALL SELECT 'info', 15")
def s7(spark: S, d: str) -> DataFrame:
    """All metadata of a dataset written and loaded: info, episodes, statistics and a dictionary."""
    path = scratch(spark, "dataset")
    ds.write_info(spark, {"fps": 15, "features": {}}, path)
    ds.write_episodes(episodes(spark, d).select("episode_index", "length"), path)
    ds.write_stats(table(spark, d, "stats").select("dataset_dir", "field", "dim", "stat_mean"), path)
    ds.write_dictionary(table(spark, d, "tasks"), path, "task")
    m = ds.load_metadata(spark, path, "dataset_dir string, field string, dim long, stat_mean double", ("task",))
    counts = [m["episodes"].agg(F.lit("episodes").alias("what"), F.count(F.lit(1)).alias("n")), m["stats"].where("stat_mean is not null").agg(F.lit("stats"), F.count(F.lit(1))), m["task"].agg(F.lit("task"), F.count(F.lit(1)))]
    return counts[0].union(counts[1]).union(counts[2]).union(spark.createDataFrame([("info", int(m["info"]["fps"]))], "what string, n long"))
