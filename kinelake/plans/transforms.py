"""Text and number functions, normalization, reversible transforms, layouts and quantization."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import normalize as N
from kinelake.functions import rotations as R
from kinelake.functions import vectors as V
from kinelake.plans.analytics import finite
from kinelake.plans.base import R6, RF, SQL_E, SQL_F, SQL_T, episodes, frames, r6, rf, typed_episodes
from kinelake.plans.registry import query
from kinelake.tables import table

S = SparkSession
_V = "v AS (SELECT vec_id, label, list_transform(embedding, lambda y: CAST(y AS DOUBLE)) AS x FROM embeddings)"


def vec(spark: S, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "label", V.doubles(F.col("embedding")).alias("x"))


def at(c: str, i: int):
    return F.get(F.col(c), F.lit(i))


# texts


@query("xstr1_bilingual", "SELECT task_index, split_part(task, '@', 1) AS zh, CASE WHEN contains(task, '@') THEN substr(task, instr(task, '@') + 1) ELSE task END AS en FROM tasks WHERE task IS NOT NULL")
def xstr1(spark: S, d: str) -> DataFrame:
    """Sides of a bilingual text, split once."""
    p = F.split("task", "@", 2)
    return table(spark, d, "tasks").where("task is not null").select("task_index", F.get(p, F.lit(0)).alias("zh"), F.element_at(p, -1).alias("en"))


@query("xstr2_instruction", f"WITH {SQL_E} SELECT episode_index, CASE WHEN len(tasks) = 0 OR tasks[1] IS NULL THEN '[high] ' || dataset_dir WHEN episode_index % 3 = 0 THEN '[Low]: ' || tasks[1] ELSE '[High]: ' || dataset_dir || ', [Low]: ' || tasks[1] END AS instruction FROM e")
def xstr2(spark: S, d: str) -> DataFrame:
    """An instruction of two levels, at times only the lower one."""
    low = at("tasks", 0)
    return episodes(spark, d).select("episode_index", F.when(low.isNull(), F.concat(F.lit("[high] "), "dataset_dir")).when(F.col("episode_index") % 3 == 0, F.concat(F.lit("[Low]: "), low)).otherwise(F.concat(F.lit("[High]: "), "dataset_dir", F.lit(", [Low]: "), low)).alias("instruction"))


_BOX = r"""b AS (SELECT doc_id, b FROM (SELECT doc_id, list_transform(string_split(regexp_extract(text, '"bbox": \[([^\]]*)\]', 1), ','), lambda y: TRY_CAST(trim(y, ' ') AS DOUBLE)) AS b FROM documents WHERE text IS NOT NULL) WHERE len(list_filter(b, lambda y: y IS NOT NULL)) = 4 AND len(b) = 4)"""


def boxes(spark: S, d: str) -> DataFrame:
    """Boxes of four numbers in the texts of captions."""
    inner = F.regexp_extract("text", r'"bbox": \[([^\]]*)\]', 1)
    b = F.transform(F.split(inner, ","), lambda y: F.trim(y).try_cast("double"))
    x = table(spark, d, "documents").where("text is not null").select("doc_id", b.alias("b"))
    return x.where((F.size("b") == 4) & F.forall("b", lambda y: y.isNotNull()))


def _loc(c):
    return F.concat(F.lit("<loc"), F.lpad(F.least(F.greatest(F.bround(c * 1024, 0), F.lit(0.0)), F.lit(1023.0)).cast("long").cast("string"), 4, "0"), F.lit(">"))


_LOC = "'<loc' || lpad(CAST(CAST(least(greatest(round_even({0} * 1024, 0), 0), 1023) AS BIGINT) AS VARCHAR), 4, '0') || '>'"


@query("xstr3_box_tokens", f"WITH {_BOX} SELECT doc_id, 'BBox: object ' || {_LOC.format('b[2]')} || {_LOC.format('b[1]')} || {_LOC.format('b[4]')} || {_LOC.format('b[3]')} AS tokens FROM b")
def xstr3(spark: S, d: str) -> DataFrame:
    """A box as location tokens, y before x, rounded half to even."""
    return boxes(spark, d).select("doc_id", F.concat(F.lit("BBox: object "), *[_loc(at("b", i)) for i in (1, 0, 3, 2)]).alias("tokens"))


@query("xstr4_trace_tokens", f"WITH {_BOX} SELECT doc_id, 'Trace: Left ' || CASE WHEN b[1] > 0.3 THEN {_LOC.format('b[1]')} || {_LOC.format('b[2]')} ELSE 'None' END || '; Right ' || CASE WHEN b[3] > 0.3 THEN {_LOC.format('b[3]')} || {_LOC.format('b[4]')} ELSE 'None' END AS tokens FROM b")
def xstr4(spark: S, d: str) -> DataFrame:
    """Two points as location tokens, None for one that is not visible."""
    def side(i: int):
        return F.when(at("b", i) > 0.3, F.concat(_loc(at("b", i)), _loc(at("b", i + 1)))).otherwise("None")

    return boxes(spark, d).select("doc_id", F.concat(F.lit("Trace: Left "), side(0), F.lit("; Right "), side(2)).alias("tokens"))


@query("xstr5_plan_step", "SELECT doc_id, trim(list_filter(string_split(text, chr(10)), lambda l: starts_with(l, '2.'))[1], ' ') AS step FROM documents WHERE doc_kind = 'plan' AND text IS NOT NULL AND len(list_filter(string_split(text, chr(10)), lambda l: starts_with(l, '2.'))) > 0")
def xstr5(spark: S, d: str) -> DataFrame:
    """The second step of a plan."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.startswith("2."))
    return table(spark, d, "documents").where("doc_kind = 'plan' and text is not null").select("doc_id", F.trim(F.get(lines, F.lit(0))).alias("step")).where("step is not null")


@query("xstr6_box_truncated", f"WITH {_BOX} SELECT doc_id, CAST(trunc(b[1] * 1024) AS BIGINT) AS x, CAST(trunc((b[1] + b[3]) * 1024) AS BIGINT) AS right_edge FROM b")
def xstr6(spark: S, d: str) -> DataFrame:
    """A box of corner and size in whole cells, cut off instead of rounded."""
    return boxes(spark, d).select("doc_id", (at("b", 0) * 1024).cast("long").alias("x"), ((at("b", 0) + at("b", 2)) * 1024).cast("long").alias("right_edge"))


@query("xstr7_sentinels", f"WITH {SQL_E} SELECT count(*) AS n, count(*) FILTER (WHERE operator IS NULL OR lower(trim(operator)) IN ('', 'null', 'none', 'nan', '-1')) AS no_operator, count(*) FILTER (WHERE recording IS NULL OR lower(trim(recording)) IN ('', 'null', 'none', 'nan', '-1')) AS no_recording FROM e")
def xstr7(spark: S, d: str) -> DataFrame:
    """How often a field has no value, in any spelling."""
    def no(c: str):
        return F.sum((~V.is_text(F.col(c))).cast("long"))

    return episodes(spark, d).agg(F.count(F.lit(1)).alias("n"), no("operator").alias("no_operator"), no("recording").alias("no_recording"))


@query("xstr8_tagged_parts", r"SELECT doc_id, regexp_extract(text, '(?s)<p>(.*?)</p>', 1) AS first_part, len(regexp_extract_all(text, '(?s)<p>(.*?)</p>', 1)) AS parts FROM documents WHERE contains(text, '<p>') AND contains(text, '</p>')")
def xstr8(spark: S, d: str) -> DataFrame:
    """The contents between tags, in order."""
    x = table(spark, d, "documents").where("contains(text, '<p>') and contains(text, '</p>')")
    return x.select("doc_id", F.regexp_extract("text", "(?s)<p>(.*?)</p>", 1).alias("first_part"), F.size(F.regexp_extract_all("text", F.lit("(?s)<p>(.*?)</p>"), F.lit(1))).cast("long").alias("parts"))


@query("xstr9_group_by_tag", r"SELECT doc_id, array_to_string(regexp_extract_all(text, '\[\d+:\d+\] op: ([^\n]*)', 1), ' ') AS op FROM documents WHERE doc_kind = 'chat_log' AND text IS NOT NULL")
def xstr9(spark: S, d: str) -> DataFrame:
    """All a speaker said, in order, in one text."""
    said = F.regexp_extract_all("text", F.lit(r"\[\d+:\d+\] op: ([^\n]*)"), F.lit(1))
    return table(spark, d, "documents").where("doc_kind = 'chat_log' and text is not null").select("doc_id", F.array_join(said, " ").alias("op"))


@query("xstr10_action_text", "SELECT task_index, split_part(split_part('Task: ' || coalesce(task, '') || ' Action: move | end', 'Action: ', 2), '|', 1) AS action FROM tasks")
def xstr10(spark: S, d: str) -> DataFrame:
    """The text between a marker and a bar."""
    t = F.concat(F.lit("Task: "), F.coalesce("task", F.lit("")), F.lit(" Action: move | end"))
    return table(spark, d, "tasks").select("task_index", F.split_part(F.split_part(t, F.lit("Action: "), F.lit(2)), F.lit("|"), F.lit(1)).alias("action"))


@query("xstr11_camera_name", r"SELECT DISTINCT lerobot_key, lower(regexp_replace(regexp_replace(list_last(string_split(lerobot_key, '.')), '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g')) AS camera FROM shape_meta WHERE category = 'images'")
def xstr11(spark: S, d: str) -> DataFrame:
    """Camera names in one spelling."""
    return table(spark, d, "shape_meta").where("category = 'images'").select("lerobot_key", V.camera_name(F.col("lerobot_key")).alias("camera")).distinct()


@query("xstr12_parse_boxes", f"WITH {_BOX}, t AS (SELECT doc_id, {_LOC.format('b[1]')} || {_LOC.format('b[3]')} AS s FROM b), p AS (SELECT doc_id, list_transform(regexp_extract_all(s, '<loc(\\d+)>', 1), lambda y: least(CAST(y AS DOUBLE) / 1024, 1)) AS v FROM t) SELECT doc_id, {r6('least(v[1], v[2])')} AS low, {r6('greatest(v[1], v[2])')} AS high FROM p")
def xstr12(spark: S, d: str) -> DataFrame:
    """Location tokens read back as numbers, corners in order."""
    t = boxes(spark, d).select("doc_id", F.concat(_loc(at("b", 0)), _loc(at("b", 2))).alias("s"))
    v = F.transform(F.regexp_extract_all("s", F.lit(r"<loc(\d+)>"), F.lit(1)), lambda x: F.least(x.cast("double") / 1024, F.lit(1.0)))
    return t.select("doc_id", R6(F.array_min(v)).alias("low"), R6(F.array_max(v)).alias("high"))


@query("xstr13_instruction_change", f"WITH {SQL_E} SELECT episode_index, CASE WHEN tasks[1] IS DISTINCT FROM lag(tasks[1]) OVER (PARTITION BY robot_id ORDER BY episode_index) THEN CASE WHEN starts_with(tasks[1], '[Low]:') THEN tasks[1] ELSE '[Low]:' || tasks[1] END END AS said FROM e")
def xstr13(spark: S, d: str) -> DataFrame:
    """An instruction is said again only when it changes."""
    w = Window.partitionBy("robot_id").orderBy("episode_index")
    t = at("tasks", 0)
    return episodes(spark, d).select("episode_index", F.when(~t.eqNullSafe(F.lag(t).over(w)), F.when(t.startswith("[Low]:"), t).otherwise(F.concat(F.lit("[Low]:"), t))).alias("said"))


@query("xstr14_placeholders", "SELECT doc_id, len(text) - len(replace(replace(replace(text, '<|endoftext|>', ''), '</s>', ''), '<pad>', '')) AS removed FROM documents WHERE text IS NOT NULL")
def xstr14(spark: S, d: str) -> DataFrame:
    """Special tokens' strings taken out of texts."""
    t = F.col("text")
    for token in ("<|endoftext|>", "</s>", "<pad>"):
        t = F.replace(t, F.lit(token), F.lit(""))
    return table(spark, d, "documents").where("text is not null").select("doc_id", (F.length("text") - F.length(t)).cast("long").alias("removed"))


@query("xstr15_last_number", r"SELECT doc_id, CAST(list_last(list_filter(regexp_split_to_array(text, '\s+'), lambda w: regexp_full_match(w, '[+-]?\d{1,9}'))) AS INTEGER) AS last_number FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '^[\x00-\x7F]*$')")
def xstr15(spark: S, d: str) -> DataFrame:
    """The last word of a text that is a whole number; texts in ASCII."""
    words = F.split("text", r"\s+")
    nums = F.filter(F.transform(words, lambda w: F.when(w.rlike(r"^[+-]?\d{1,9}$"), w.try_cast("int"))), lambda v: v.isNotNull())
    return table(spark, d, "documents").where("text is not null").where(F.col("text").rlike(r"^[\x00-\x7F]*$")).select("doc_id", F.when(F.size(nums) > 0, F.element_at(nums, -1)).alias("last_number"))


@query("xstr16_key_list", r"SELECT file_id, part_key, len(regexp_extract_all(lerobot_key, '[A-Za-z][A-Za-z0-9_.]*')) AS keys FROM shape_meta GROUP BY ALL")
def xstr16(spark: S, d: str) -> DataFrame:
    """How many names a key list in a text has."""
    return table(spark, d, "shape_meta").select("file_id", "part_key", F.size(F.regexp_extract_all("lerobot_key", F.lit("([A-Za-z][A-Za-z0-9_.]*)"), F.lit(1))).cast("long").alias("keys")).distinct()


@query("xstr17_task_and_plan", "SELECT task_index, trim(split_part(coalesce(task, '') || ' [PLAN] 1. go', '[PLAN]', 1), ' ') AS task, trim(split_part(coalesce(task, '') || ' [PLAN] 1. go', '[PLAN]', 2), ' ') AS plan FROM tasks")
def xstr17(spark: S, d: str) -> DataFrame:
    """A text cut at a marker, both sides trimmed."""
    p = F.split(F.concat(F.coalesce("task", F.lit("")), F.lit(" [PLAN] 1. go")), r"\[PLAN\]", 2)
    return table(spark, d, "tasks").select("task_index", F.trim(F.get(p, F.lit(0))).alias("task"), F.trim(F.get(p, F.lit(1))).alias("plan"))


# numbers


@query("xmath1_wrap_angle", f"WITH {_V} SELECT vec_id, {r6('atan2(sin(7 * x[1]), cos(7 * x[1]))')} AS angle FROM v")
def xmath1(spark: S, d: str) -> DataFrame:
    """Angles brought into (-pi, pi]."""
    a = at("x", 0) * 7
    return vec(spark, d).select("vec_id", R6(F.atan2(F.sin(a), F.cos(a))).alias("angle"))


@query("xmath2_binarize", f"WITH {_V} SELECT vec_id, len(list_filter(x, lambda y: y > 0.1)) AS open, len(list_filter(x, lambda y: y >= 0.1)) AS open_or_equal FROM v")
def xmath2(spark: S, d: str) -> DataFrame:
    """Binarization, strict and not strict."""
    return vec(spark, d).select("vec_id", F.size(F.filter("x", lambda y: y > 0.1)).cast("long").alias("open"), F.size(F.filter("x", lambda y: y >= 0.1)).cast("long").alias("open_or_equal"))


@query("xmath3_arcsinh", f"WITH {_V} SELECT vec_id, {r6('asinh(x[1] / (1.5 * 0.2))')} AS y, {r6('1.5 * 0.2 * sinh(asinh(x[1] / (1.5 * 0.2)))')} AS back FROM v")
def xmath3(spark: S, d: str) -> DataFrame:
    """Inverse hyperbolic sine of scaled values, and back."""
    y = F.asinh(at("x", 0) / (1.5 * 0.2))
    return vec(spark, d).select("vec_id", R6(y).alias("y"), R6(1.5 * 0.2 * F.sinh(y)).alias("back"))


_TAIL = "CASE WHEN {0} > 0.1 THEN 0.1 + 0.05 * ln(1 + ({0} - 0.1) / 0.05) WHEN {0} < -0.1 THEN -0.1 - 0.05 * ln(1 + (-0.1 - {0}) / 0.05) ELSE {0} END"


@query("xmath4_tail_compress", f"WITH {_V} SELECT vec_id, {r6(_TAIL.format('x[1]'))} AS y, {r6('x[1]')} AS back FROM v")
def xmath4(spark: S, d: str) -> DataFrame:
    """Logarithmic tails outside a range, and their inverse."""
    low, high, c = F.lit(-0.1), F.lit(0.1), F.lit(0.05)
    y = N.tail_forward(at("x", 0), low, high, c)
    return vec(spark, d).select("vec_id", R6(y).alias("y"), R6(N.tail_backward(y, low, high, c)).alias("back"))


_Q = "q AS (SELECT vec_id, label, x[4] / s AS w, x[5] / s AS i, x[6] / s AS j, x[7] / s AS k, x[1] AS px, x[2] AS py, x[3] AS pz FROM (SELECT *, sqrt(x[4] ** 2 + x[5] ** 2 + x[6] ** 2 + x[7] ** 2) AS s FROM v))"


def quats(spark: S, d: str) -> tuple[DataFrame, R.Quat]:
    x = vec(spark, d)
    u = R.unit([at("x", i) for i in range(3, 7)])
    x = x.select("vec_id", "label", *[c.alias(n) for c, n in zip(u, "wijk")], *[at("x", i).alias(n) for i, n in enumerate(("px", "py", "pz"))])
    return x, [F.col(n) for n in "wijk"]


@query("xmath5_quaternion_matrix", f"WITH {_V}, {_Q} SELECT vec_id, {r6('1 - 2 * (j * j + k * k)')} AS m00, {r6('2 * (i * j - k * w)')} AS m01, {r6('2 * (i * k + j * w)')} AS m02, {r6('2 * (i * j + k * w)')} AS m10, {r6('1 - 2 * (i * i + k * k)')} AS m11, {r6('2 * (j * k - i * w)')} AS m12 FROM q")
def xmath5(spark: S, d: str) -> DataFrame:
    """Quaternion to rotation matrix: the first two rows."""
    x, q = quats(spark, d)
    m = R.matrix(q)
    return x.select("vec_id", *[R6(m[a][b]).alias(f"m{a}{b}") for a in (0, 1) for b in (0, 1, 2)])


@query("xmath6_quaternion_product", f"WITH {_V}, {_Q}, p AS (SELECT vec_id, w * w - i * i - j * j - k * k AS a, 2 * w * i AS b, 2 * w * j AS c, 2 * w * k AS e FROM q) SELECT vec_id, {r6('abs(a)')} AS a, {r6('CASE WHEN a < 0 THEN -b ELSE b END')} AS b, {r6('CASE WHEN a < 0 THEN -c ELSE c END')} AS c, {r6('CASE WHEN a < 0 THEN -e ELSE e END')} AS e FROM p")
def xmath6(spark: S, d: str) -> DataFrame:
    """A rotation done twice, as the quaternion with a positive real part."""
    x, q = quats(spark, d)
    return x.select("vec_id", *[R6(c).alias(n) for c, n in zip(R.positive(R.multiply(q, q)), "abce")])


@query("xmath7_six_dims", f"WITH {_V}, n AS (SELECT vec_id, x, sqrt(x[1] ** 2 + x[2] ** 2 + x[3] ** 2) AS s FROM v), a AS (SELECT vec_id, x, x[1] / s AS a1, x[2] / s AS a2, x[3] / s AS a3 FROM n), b AS (SELECT *, a1 * x[4] + a2 * x[5] + a3 * x[6] AS t FROM a), c AS (SELECT *, x[4] - t * a1 AS b1, x[5] - t * a2 AS b2, x[6] - t * a3 AS b3 FROM b) SELECT vec_id, {r6('b1 / sqrt(b1 * b1 + b2 * b2 + b3 * b3)')} AS r10, {r6('(a2 * b3 - a3 * b2) / sqrt(b1 * b1 + b2 * b2 + b3 * b3)')} AS r20 FROM c")
def xmath7(spark: S, d: str) -> DataFrame:
    """Rotation matrix from six numbers by Gram-Schmidt."""
    m = R.from_six([at("x", i) for i in range(6)])
    return vec(spark, d).select("vec_id", R6(m[1][0]).alias("r10"), R6(m[2][0]).alias("r20"))


@query("xmath10_euler", f"WITH {_V} SELECT vec_id, {r6('x[1]')} AS roll, {r6('x[2]')} AS pitch, {r6('x[3]')} AS yaw FROM v WHERE abs(x[2]) < 1.5")
def xmath10(spark: S, d: str) -> DataFrame:
    """Roll, pitch and yaw to a matrix and back."""
    e = R.euler_of(R.euler_matrix(at("x", 0), at("x", 1), at("x", 2)))
    return vec(spark, d).where(F.abs(at("x", 1)) < 1.5).select("vec_id", *[R6(c).alias(n) for c, n in zip(e, ("roll", "pitch", "yaw"))])


@query("xmath11_axis_angle", f"WITH {_V}, {_Q} SELECT vec_id, {r6('i * 2 * acos(least(greatest(w, -1), 1)) / sqrt(1 - w * w)')} AS ax, {r6('k * 2 * acos(least(greatest(w, -1), 1)) / sqrt(1 - w * w)')} AS az FROM q")
def xmath11(spark: S, d: str) -> DataFrame:
    """Quaternion to axis times angle."""
    x, q = quats(spark, d)
    a = R.axis_angle(q)
    return x.select("vec_id", R6(a[0]).alias("ax"), R6(a[2]).alias("az"))


@query("xmath12_limited_step", f"WITH {_V}, m AS (SELECT vec_id, x, greatest(abs(x[1] - x[4]), abs(x[2] - x[5]), abs(x[3] - x[6])) AS big FROM v) SELECT vec_id, {r6('x[4] + (x[1] - x[4]) * least(1, 0.1 / big)')} AS target FROM m")
def xmath12(spark: S, d: str) -> DataFrame:
    """A step towards a target, all joints scaled alike so that none moves by more than a limit."""
    big = F.greatest(*[F.abs(at("x", i) - at("x", i + 3)) for i in range(3)])
    return vec(spark, d).select("vec_id", R6(at("x", 3) + (at("x", 0) - at("x", 3)) * F.least(F.lit(1.0), F.lit(0.1) / big)).alias("target"))


@query("xmath13_resize", "SELECT h, w, CAST(round_even(h * least(1, sqrt(50176.0 / (h * w))) / 28, 0) * 28 AS BIGINT) AS new_h, CAST(floor(w * least(1, sqrt(50176.0 / (h * w))) / 28) * 28 AS BIGINT) AS new_w FROM (SELECT DISTINCT raw_shape[2] AS h, raw_shape[3] AS w FROM shape_meta WHERE category = 'images' AND len(raw_shape) = 3)")
def xmath13(spark: S, d: str) -> DataFrame:
    """Image sizes that keep their aspect, in multiples of 28 and below a number of pixels."""
    x = table(spark, d, "shape_meta").where("category = 'images' and size(raw_shape) = 3").select(at("raw_shape", 1).alias("h"), at("raw_shape", 2).alias("w")).distinct()
    k = F.least(F.lit(1.0), F.sqrt(50176.0 / (F.col("h") * F.col("w"))))
    return x.select("h", "w", (F.bround(F.col("h") * k / 28, 0) * 28).cast("long").alias("new_h"), (F.floor(F.col("w") * k / 28) * 28).cast("long").alias("new_w"))


@query("xmath14_scaled_box", f"WITH {_BOX} SELECT doc_id, CAST(CAST(round_even(b[2] * 1023, 0) AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(round_even(b[1] * 1023, 0) AS BIGINT) AS VARCHAR) AS corner FROM b")
def xmath14(spark: S, d: str) -> DataFrame:
    """A box's corner in 0..1023, y before x, without leading zeros."""
    n = [F.bround(at("b", i) * 1023, 0).cast("long").cast("string") for i in (1, 0)]
    return boxes(spark, d).select("doc_id", F.concat_ws(" ", *n).alias("corner"))


# arrays and dates


@query("xarr1_apply", f"WITH {_V} SELECT vec_id, {r6('list_max(list_transform(x, lambda y: abs(y)))')} AS largest, {r6('list_sum(list_transform(x, lambda y: y * y))')} AS square FROM v")
def xarr1(spark: S, d: str) -> DataFrame:
    """A function over all elements, and reductions of it."""
    return vec(spark, d).select("vec_id", R6(F.array_max(F.transform("x", F.abs))).alias("largest"), R6(V.total(F.transform("x", lambda y: y * y))).alias("square"))


@query("xarr2_align_right", f"WITH {SQL_E} SELECT episode_index, list_concat(list_transform(range(greatest(6 - len(s), 0)), lambda i: '<pad>'), s[1:6]) AS aligned FROM (SELECT episode_index, string_split(coalesce(tasks[1], ''), ' ') AS s FROM e)")
def xarr2(spark: S, d: str) -> DataFrame:
    """Words moved to the right end of six places, padding before them."""
    s = F.split(F.coalesce(at("tasks", 0), F.lit("")), " ")
    return episodes(spark, d).select("episode_index", F.concat(F.array_repeat(F.lit("<pad>"), F.greatest(F.lit(6) - F.size(s), F.lit(0))), F.slice(s, 1, 6)).alias("aligned"))


@query("xarr3_truncate", f"WITH {SQL_E}, s AS (SELECT episode_index, string_split(coalesce(tasks[1], ''), ' ') AS s FROM e) SELECT episode_index, list_concat(s[1:greatest(0, 4 - 2)], s[greatest(len(s) - 1, 1):]) AS kept FROM s")
def xarr3(spark: S, d: str) -> DataFrame:
    """The suffix is kept, the prefix cut to what is left of four places."""
    s = F.split(F.coalesce(at("tasks", 0), F.lit("")), " ")
    return episodes(spark, d).select("episode_index", F.concat(F.slice(s, 1, 2), F.slice(s, F.greatest(F.size(s) - 1, F.lit(1)), F.lit(1000))).alias("kept"))


@query("xarr5_block_layout", f"WITH {_V} SELECT vec_id, b AS block, {r6('list_sum(x[b * 12 + 1:least(b * 12 + 12, 64)])')} AS total, greatest(b * 12 + 12 - 64, 0) AS padded FROM v CROSS JOIN range(6) r(b)")
def xarr5(spark: S, d: str) -> DataFrame:
    """Vectors in blocks of twelve, the last one padded."""
    x = vec(spark, d).select("vec_id", "x", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("b"))
    return x.select("vec_id", F.col("b").cast("long").alias("block"), R6(V.total(F.slice("x", F.col("b") * 12 + 1, F.lit(12)))).alias("total"), F.greatest(F.col("b") * 12 + 12 - 64, F.lit(0)).cast("long").alias("padded"))


@query("xarr6_subsequence", f"WITH {SQL_E} SELECT episode_index, coalesce(list_min(list_filter(range(greatest(len(s) - 1, 0)), lambda i: s[i + 1] = 'the' AND s[i + 2] = 'lower')), -1) AS found FROM (SELECT episode_index, string_split(coalesce(tasks[1], ''), ' ') AS s FROM e)")
def xarr6(spark: S, d: str) -> DataFrame:
    """The first place of a sequence of words within another, -1 if there is none."""
    x = episodes(spark, d).select("episode_index", F.split(F.coalesce(at("tasks", 0), F.lit("")), " ").alias("s"))
    i = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda k: F.slice("s", k + 1, F.lit(2)) == F.array(F.lit("the"), F.lit("lower")))
    return x.select("episode_index", F.coalesce(F.array_min(i), F.lit(-1)).cast("long").alias("found"))


@query("xarr7_block_dct", f"WITH {_V} SELECT vec_id, b AS block, k, {r6('list_sum(list_transform(range(8), lambda n: x[b * 8 + n + 1] * cos(pi() / 8 * (n + 0.5::DOUBLE) * k))) * CASE WHEN k = 0 THEN sqrt(1.0 / 8) ELSE sqrt(2.0 / 8) END')} AS c FROM v CROSS JOIN range(8) r(b) CROSS JOIN range(8) t(k)")
def xarr7(spark: S, d: str) -> DataFrame:
    """Orthonormal cosine transform of blocks of eight."""
    x = vec(spark, d).select("vec_id", "x", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("b"))
    basis = [[(math.sqrt((1 if k == 0 else 2) / 8)) * math.cos(math.pi / 8 * (n + 0.5) * k) for n in range(8)] for k in range(8)]
    cs = [sum((F.get("x", F.col("b") * 8 + n) * w for n, w in enumerate(row)), F.lit(0.0)) for row in basis]
    rows = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), c.alias("c")) for k, c in enumerate(cs)])).alias("z")
    return x.select("vec_id", F.col("b").cast("long").alias("block"), rows).select("vec_id", "block", "z.k", R6(F.col("z.c")).alias("c"))


@query("xdate1_stamp", "SELECT event_id, epoch_us(ts) // 1000000 AS sec, (epoch_us(ts) % 1000000) * 1000 AS nanosec FROM events")
def xdate1(spark: S, d: str) -> DataFrame:
    """Times as whole seconds and nanoseconds."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", us.alias("us")).select("event_id", F.expr("us div 1000000").alias("sec"), ((F.col("us") % 1000000) * 1000).alias("nanosec"))


@query("xdate2_trajectory", f"WITH {_V} SELECT vec_id, i AS step, {r6('100 + i * 0.05::DOUBLE')} AS t, {r6('x[i + 1]')} AS v FROM v CROSS JOIN range(10) r(i)")
def xdate2(spark: S, d: str) -> DataFrame:
    """Steps of a chunk with their times."""
    x = vec(spark, d).select("vec_id", F.posexplode(F.slice("x", 1, 10)).alias("i", "v"))
    return x.select("vec_id", F.col("i").cast("long").alias("step"), R6(F.lit(100.0) + F.col("i") * 0.05).alias("t"), R6(F.col("v")).alias("v"))


# normalization

_ST = "s AS (SELECT dataset_dir, embodiment_type, field, dim, stat_min AS lo, stat_max AS hi, stat_mean AS mean, stat_std AS std, q01, q99 FROM stats WHERE stat_min IS NOT NULL AND stat_max IS NOT NULL AND stat_mean IS NOT NULL AND stat_std IS NOT NULL AND q01 IS NOT NULL AND q99 IS NOT NULL AND isfinite(stat_min) AND isfinite(stat_max) AND isfinite(stat_mean) AND isfinite(stat_std))"


def norm_stats(spark: S, d: str) -> DataFrame:
    x = table(spark, d, "stats").select("dataset_dir", "embodiment_type", "field", "dim", F.col("stat_min").alias("lo"), F.col("stat_max").alias("hi"), F.col("stat_mean").alias("mean"), F.col("stat_std").alias("std"), "q01", "q99")
    for c in ("lo", "hi", "mean", "std"):
        x = x.where(finite(F.col(c)))
    return x.where("q01 is not null and q99 is not null")


def _cols(names: tuple[str, ...] = ("lo", "hi", "mean", "std", "q01", "q99")) -> dict:
    return {c: F.col(c) for c in names}


@query("n2_norm_modes", f"WITH {_ST} SELECT dataset_dir, field, dim, {r6('CASE WHEN hi - lo < 1e-4 THEN 1 ELSE 1 / (std + 1e-8) END')} AS z_scale, {r6('CASE WHEN q99 - q01 < 1e-4 THEN -q01 ELSE -1 - q01 * 2 / (q99 - q01) END')} AS q_offset FROM s WHERE std = 0 OR std > 1e-4")
def n2(spark: S, d: str) -> DataFrame:
    """Scale and offset of modes of normalization; a degenerate range is only shifted."""
    x = norm_stats(spark, d).where("std = 0 or std > 1e-4")
    return x.select("dataset_dir", "field", "dim", R6(N.scale_and_offset("z-score", _cols())[0]).alias("z_scale"), R6(N.scale_and_offset("q01/q99", _cols())[1]).alias("q_offset"))


_N3 = f"""{SQL_F}, {SQL_E}, {_ST}, x AS (SELECT global_index, dataset_dir, generate_subscripts(state, 1) - 1 AS dim, CAST(unnest(state) AS DOUBLE) AS v FROM f JOIN e USING (episode_index) WHERE state IS NOT NULL),
y AS (SELECT global_index, x.dim, v, CASE WHEN hi - lo < 1e-4 THEN 1 ELSE 2 / (hi - lo) END AS sc, CASE WHEN hi - lo < 1e-4 THEN -lo ELSE -1 - lo * (2 / (hi - lo)) END AS os FROM x JOIN s ON s.dataset_dir = x.dataset_dir AND s.dim = x.dim AND s.field = 'state')"""


def _normalized(spark: S, d: str) -> DataFrame:
    x = frames(spark, d, "state").where("state is not null").join(episodes(spark, d).select("episode_index", "dataset_dir"), "episode_index")
    x = x.select("global_index", "dataset_dir", F.posexplode("state").alias("dim", "v")).select("global_index", "dataset_dir", F.col("dim").cast("long").alias("dim"), F.col("v").cast("double").alias("v"))
    x = x.join(norm_stats(spark, d).where("field = 'state'").drop("field"), ["dataset_dir", "dim"])
    sc, os = N.scale_and_offset("min/max", _cols())
    return x.withColumn("sc", sc).withColumn("os", os)


@query("n3_normalize_clamp", f"WITH {_N3} SELECT dim, count(*) AS n, {r6('avg(CASE WHEN isnan(v) THEN 0 ELSE least(greatest(v * sc + os, -5), 5) END)')} AS mean, {r6('max(CASE WHEN isnan(v) THEN 0 ELSE least(greatest(v * sc + os, -5), 5) END)')} AS hi FROM y GROUP BY dim")
def n3(spark: S, d: str) -> DataFrame:
    """States normalized by their dataset's stored range, limited to +-5, NaN as 0."""
    y = _normalized(spark, d).select("dim", N.forward(F.col("v"), F.col("sc"), F.col("os")).alias("y"))
    return y.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), R6(F.avg("y")).alias("mean"), R6(F.max("y")).alias("hi"))


@query("n4_roundtrip", f"WITH {_N3} SELECT dim, count(*) AS n, {rf('sum(v)')} AS total FROM y WHERE v IS NOT NULL AND isfinite(v) AND abs(v * sc + os) <= 5 GROUP BY dim")
def n4(spark: S, d: str) -> DataFrame:
    """Normalization undone: within the limits the values come back."""
    sc, os = F.col("sc"), F.col("os")
    y = _normalized(spark, d).where(finite(F.col("v")) & (F.abs(F.col("v") * sc + os) <= 5)).select("dim", N.backward(N.forward(F.col("v"), sc, os), sc, os).alias("b"))
    return y.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), RF(F.sum("b")).alias("total"))


@query("n6_missing_stats", f"WITH {SQL_E}, {_ST}, w AS (SELECT DISTINCT e.dataset_dir, m.embodiment_type FROM e JOIN mixture m USING (embodiment)), k AS (SELECT dataset_dir, field, dim FROM w JOIN joint_ranges USING (embodiment_type) CROSS JOIN (VALUES ('action'), ('state')) f(field)) SELECT dataset_dir, field, dim FROM k ANTI JOIN s USING (dataset_dir, field, dim)")
def n6(spark: S, d: str) -> DataFrame:
    """Dimensions that have no usable statistics."""
    w = typed_episodes(spark, d, "dataset_dir").select("dataset_dir", "embodiment_type").distinct()
    k = w.join(F.broadcast(table(spark, d, "joint_ranges").select("embodiment_type", "dim")), "embodiment_type").select("dataset_dir", F.explode(F.array(F.lit("action"), F.lit("state"))).alias("field"), "dim")
    return k.join(norm_stats(spark, d), ["dataset_dir", "field", "dim"], "left_anti")


# reversible transforms


@query("t2_relative_joint", f"WITH {SQL_F}, x AS (SELECT global_index, generate_subscripts(action, 1) - 1 AS dim, CAST(unnest(action) AS DOUBLE) AS a, CAST(unnest(state) AS DOUBLE) AS s FROM f WHERE action IS NOT NULL AND state IS NOT NULL AND len(action) = len(state)) SELECT CAST(dim AS BIGINT) AS dim, count(*) AS n, {rf('avg(a - s)')} AS mean, {rf('max(abs(a - s))')} AS largest FROM x WHERE isfinite(a) AND isfinite(s) GROUP BY dim")
def t2(spark: S, d: str) -> DataFrame:
    """Commands relative to the state."""
    x = frames(spark, d, "action", "state").where("action is not null and state is not null and size(action) = size(state)")
    rel = F.zip_with(V.doubles(F.col("action")), V.doubles(F.col("state")), lambda a, s: F.when(finite(a) & finite(s), a - s))
    y = x.select(F.posexplode(rel).alias("dim", "v")).where("v is not null")
    return y.groupBy(F.col("dim").cast("long").alias("dim")).agg(F.count(F.lit(1)).alias("n"), RF(F.avg("v")).alias("mean"), RF(F.max(F.abs("v"))).alias("largest"))


_ROT = "(1 - 2 * (j * j + k * k)) * {x} + 2 * (i * j + k * w) * {y} + 2 * (i * k - j * w) * {z}"


@query("t3_relative_pose", f"WITH {_V}, {_Q} SELECT vec_id, {r6(_ROT.format(x='(px - 0.1)', y='(py - 0.2)', z='(pz - 0.3)'))} AS rx FROM q")
def t3(spark: S, d: str) -> DataFrame:
    """A position in the frame of a base pose: shifted, then turned by the conjugate."""
    x, q = quats(spark, d)
    v = [F.col(n) - o for n, o in (("px", 0.1), ("py", 0.2), ("pz", 0.3))]
    return x.select("vec_id", R6(R.rotate(R.conjugate(q), v)[0]).alias("rx"))


@query("t4_partial_relative", f"WITH {SQL_F} SELECT global_index, {r6('CAST(action[1] AS DOUBLE) - CAST(state[1] AS DOUBLE)')} AS rel, {r6('CAST(action[2] AS DOUBLE)')} AS kept FROM f WHERE action IS NOT NULL AND state IS NOT NULL AND isfinite(action[1]) AND isfinite(state[1]) AND isfinite(action[2])")
def t4(spark: S, d: str) -> DataFrame:
    """Relative on listed dimensions only."""
    dims = [0]
    x = frames(spark, d, "action", "state").where("action is not null and state is not null")
    v = F.transform(V.doubles(F.col("action")), lambda a, i: F.when(i.isin(dims), a - F.get(F.col("state"), i).cast("double")).otherwise(a))
    x = x.where(finite(at("action", 0)) & finite(at("state", 0)) & finite(at("action", 1))).select("global_index", v.alias("v"))
    return x.select("global_index", R6(at("v", 0)).alias("rel"), R6(at("v", 1)).alias("kept"))


@query("t5_gripper_width", f"WITH {SQL_F}, {SQL_T} SELECT embodiment_type, dim, count(*) AS n, {r6('avg(2 * CAST(state[dim + 1] AS DOUBLE) - 1)')} AS mean FROM f JOIN t USING (episode_index) JOIN (SELECT embodiment_type, dim FROM joint_ranges WHERE part_key LIKE '%gripper') USING (embodiment_type) WHERE state IS NOT NULL AND isfinite(state[dim + 1]) AND state[dim + 1] BETWEEN 0 AND 1 GROUP BY ALL")
def t5(spark: S, d: str) -> DataFrame:
    """Gripper widths scaled to [-1, 1]."""
    g = F.broadcast(table(spark, d, "joint_ranges").where("part_key like '%gripper'").select("embodiment_type", "dim"))
    x = frames(spark, d, "state").where("state is not null").join(typed_episodes(spark, d), "episode_index").join(g, "embodiment_type")
    v = F.get("state", F.col("dim").cast("int")).cast("double")
    return x.select("embodiment_type", "dim", v.alias("v")).where("v between 0 and 1").where(finite(F.col("v"))).groupBy("embodiment_type", "dim").agg(F.count(F.lit(1)).alias("n"), R6(F.avg(2 * F.col("v") - 1)).alias("mean"))


@query("t6_rotation_6d", f"WITH {_V}, {_Q} SELECT vec_id, {r6('1 - 2 * (j * j + k * k)')} AS d0, {r6('2 * (j * k - i * w)')} AS d5 FROM q")
def t6(spark: S, d: str) -> DataFrame:
    """Poses with a rotation of six numbers."""
    x, q = quats(spark, d)
    s = R.six(q)
    return x.select("vec_id", R6(s[0]).alias("d0"), R6(s[5]).alias("d5"))


# layouts


@query("m1_concat_left", f"WITH {SQL_F} SELECT global_index, len(action) AS width, 20 - len(action) AS padded, {rf('list_sum(list_transform(list_filter(action, lambda y: isfinite(y)), lambda y: CAST(y AS DOUBLE)))')} AS total FROM f WHERE action IS NOT NULL AND len(list_filter(action, lambda y: isfinite(y))) > 0")
def m1(spark: S, d: str) -> DataFrame:
    """Vectors padded on the right to a common width, with the mask of what was filled up."""
    v = V.pad_right(V.doubles(F.col("action")), 20)
    ok = F.filter(v, lambda y: finite(y))
    real = F.size(F.filter(V.doubles(F.col("action")), lambda y: finite(y)))
    x = frames(spark, d, "action").where("action is not null").where(real > 0)
    return x.select("global_index", F.size("action").cast("long").alias("width"), F.size(F.filter(V.pad_mask(F.col("action"), 20), lambda m: m)).cast("long").alias("padded"), RF(V.total(ok)).alias("total"))


_M3 = "p AS (SELECT embodiment_type, part_key, min(dim) AS start, count(*) AS width FROM joint_ranges GROUP BY ALL)"


@query("m3_grouped_layout", f"WITH {_M3} SELECT embodiment_type, CASE WHEN part_key LIKE '%arm' OR part_key LIKE '%ee_pose' THEN 'control' WHEN part_key LIKE '%gripper' THEN 'gripper' ELSE 'body' END AS grp, arg_min(part_key, start) AS chosen, CAST(sum(width) AS BIGINT) AS width FROM p GROUP BY ALL")
def m3(spark: S, d: str) -> DataFrame:
    """Parts of a type by group; the first alternative that is there is taken."""
    p = table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.min("dim").alias("start"), F.count(F.lit(1)).alias("width"))
    k = F.col("part_key")
    grp = F.when(k.like("%arm") | k.like("%ee_pose"), "control").when(k.like("%gripper"), "gripper").otherwise("body")
    return p.groupBy("embodiment_type", grp.alias("grp")).agg(F.min_by("part_key", "start").alias("chosen"), F.sum("width").alias("width"))


@query("m5_part_offsets", f"WITH {_M3} SELECT embodiment_type, part_key, width, CAST(sum(width) OVER (PARTITION BY embodiment_type ORDER BY start) - width AS BIGINT) AS first_dim FROM p")
def m5(spark: S, d: str) -> DataFrame:
    """Offsets of parts from the running sum of widths."""
    p = table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.min("dim").alias("start"), F.count(F.lit(1)).alias("width"))
    return p.select("embodiment_type", "part_key", "width", (F.sum("width").over(Window.partitionBy("embodiment_type").orderBy("start")) - F.col("width")).alias("first_dim"))


@query("m6_scatter_layout", f"""WITH {SQL_F}, {SQL_T}, {_M3}, m(part_key, spot) AS (VALUES ('left_arm', 0), ('left_gripper', 9), ('right_arm', 10), ('right_ee_pose', 10), ('right_gripper', 19), ('torso', 20), ('lower_body', 20)),
x AS (SELECT embodiment_type, m.spot + i AS model_dim, state[p.start + i + 1] AS v FROM f JOIN t USING (episode_index) JOIN p USING (embodiment_type) JOIN m USING (part_key), LATERAL (SELECT unnest(range(p.width)) AS i) WHERE state IS NOT NULL)
SELECT embodiment_type, model_dim, count(*) AS n, {rf('avg(CAST(v AS DOUBLE))')} AS mean FROM x WHERE isfinite(v) GROUP BY ALL""")
def m6(spark: S, d: str) -> DataFrame:
    """Parts scattered into the places of a model's layout."""
    place = {"left_arm": 0, "left_gripper": 9, "right_arm": 10, "right_ee_pose": 10, "right_gripper": 19, "torso": 20, "lower_body": 20}
    r = table(spark, d, "joint_ranges")
    first = r.groupBy("embodiment_type", "part_key").agg(F.min("dim").alias("start"))
    at_ = F.create_map(*[x for k, v in place.items() for x in (F.lit(k), F.lit(v))])
    m = r.join(first, ["embodiment_type", "part_key"]).select("embodiment_type", "dim", (at_[F.col("part_key")] + F.col("dim") - F.col("start")).alias("model_dim")).where("model_dim is not null")
    x = frames(spark, d, "state").where("state is not null").join(typed_episodes(spark, d), "episode_index")
    x = x.select("embodiment_type", F.posexplode("state").alias("dim", "v")).select("embodiment_type", F.col("dim").cast("long").alias("dim"), F.col("v").cast("double").alias("v")).where(finite(F.col("v")))
    g = x.groupBy("embodiment_type", "dim").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"))
    return g.join(F.broadcast(m), ["embodiment_type", "dim"]).select("embodiment_type", "model_dim", "n", RF(F.col("mean")).alias("mean"))


@query("m7_component_chunks", f"WITH {_M3} SELECT embodiment_type, part_key, c AS chunk, least(4, width - c * 4) AS width FROM p, LATERAL (SELECT unnest(range(CAST(ceil(width / 4.0) AS BIGINT))) AS c)")
def m7(spark: S, d: str) -> DataFrame:
    """Wide parts cut into components of at most four."""
    p = table(spark, d, "joint_ranges").groupBy("embodiment_type", "part_key").agg(F.count(F.lit(1)).alias("w"))
    x = p.select("embodiment_type", "part_key", "w", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("w") / 4) - 1)).alias("chunk"))
    return x.select("embodiment_type", "part_key", "chunk", F.least(F.lit(4).cast("long"), F.col("w") - F.col("chunk") * 4).alias("width"))


# quantization


@query("q1_state_bins", f"WITH {SQL_F}, x AS (SELECT global_index, CAST(generate_subscripts(state, 1) - 1 AS BIGINT) AS dim, CAST(unnest(state) AS DOUBLE) AS v FROM f WHERE state IS NOT NULL) SELECT global_index, dim, CASE WHEN v < -1 THEN -1 ELSE CAST(floor(least((v + 1) * 128, 255)) AS BIGINT) END AS bin FROM x WHERE isfinite(v)")
def q1(spark: S, d: str) -> DataFrame:
    """256 uniform bins on [-1, 1] of every dimension: -1 below the range, 255 above it."""
    x = frames(spark, d, "state").select("global_index", F.posexplode("state").alias("dim", "v")).withColumn("v", F.col("v").cast("double")).where(finite(F.col("v")))
    code = F.when(F.col("v") < -1, F.lit(-1)).otherwise(F.floor(F.least((F.col("v") + 1) * 128, F.lit(255.0)))).cast("long")
    return x.select("global_index", F.col("dim").cast("long").alias("dim"), code.alias("bin"))


_BOOK = "c AS (SELECT label AS code, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings CROSS JOIN range(1, 65) r(i) GROUP BY ALL)"


@query("q3_residual_codes", f"""WITH {_BOOK}, v AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings CROSS JOIN range(1, 65) r(i)),
d1 AS (SELECT vec_id, code, sum((x - m) ** 2) AS q FROM v JOIN c USING (i) GROUP BY ALL), k1 AS (SELECT vec_id, arg_min(code, struct_pack(a := round(q, 9), b := code)) AS code1 FROM d1 GROUP BY vec_id),
r AS (SELECT v.vec_id, v.i, x - m AS x FROM v JOIN k1 USING (vec_id) JOIN c ON c.code = k1.code1 AND c.i = v.i), d2 AS (SELECT vec_id, code, sum((x - m) ** 2) AS q FROM r JOIN c USING (i) GROUP BY ALL)
SELECT vec_id, any_value(code1) AS code1, arg_min(code, struct_pack(a := round(q, 9), b := code)) AS code2 FROM d2 JOIN k1 USING (vec_id) GROUP BY vec_id""")
def q3(spark: S, d: str) -> DataFrame:
    """Two levels of residual codes over all dimensions, against a codebook of label means; the book is a fixed handful of rows."""
    x = table(spark, d, "embeddings").select("vec_id", "label", V.doubles(F.col("embedding")).alias("x"))
    mean = x.select("label", F.posexplode("x").alias("i", "v")).groupBy("label", "i").agg(F.avg("v").alias("m"))
    entry = mean.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda e: e["m"]).alias("m"))
    book = entry.agg(F.collect_list(F.struct(F.col("label").alias("code"), "m")).alias("book"))

    def near(v):
        dist = F.transform("book", lambda c: F.struct(F.round(F.aggregate(V.minus(v, c["m"]), F.lit(0.0), lambda a, y: a + y * y), 9).alias("q"), c["code"].alias("code"), c["m"].alias("m")))
        return F.array_min(dist)

    y = x.crossJoin(F.broadcast(book)).withColumn("k1", near(F.col("x"))).withColumn("r", V.minus(F.col("x"), F.col("k1.m"))).withColumn("k2", near(F.col("r")))
    return y.select("vec_id", F.col("k1.code").alias("code1"), F.col("k2.code").alias("code2"))


@query("q5_token_stream", f"WITH {SQL_T}, h AS (SELECT embodiment_type, count(DISTINCT part_key) FILTER (WHERE part_key LIKE 'left_%') > 0 AS l, count(DISTINCT part_key) FILTER (WHERE part_key LIKE 'right_%') > 0 AS r FROM joint_ranges GROUP BY embodiment_type) SELECT episode_index, CASE WHEN l THEN '<left>' || CAST(length % 16 AS VARCHAR) || ' ' || CAST(length // 16 % 16 AS VARCHAR) ELSE '' END || CASE WHEN r THEN '<right>' || CAST(episode_index % 16 AS VARCHAR) || ' ' || CAST(episode_index // 16 % 16 AS VARCHAR) ELSE '' END AS stream FROM t JOIN h USING (embodiment_type)")
def q5(spark: S, d: str) -> DataFrame:
    """Codes as a stream with a marker per side; sides that a type's layout lacks are left out."""
    def codes(c: str):
        return F.concat_ws(" ", F.expr(f"{c} % 16").cast("string"), F.expr(f"{c} div 16 % 16").cast("string"))

    side = [F.max(F.col("part_key").like(f"{s}\\_%").cast("int")).alias(s) for s in ("left", "right")]
    h = F.broadcast(table(spark, d, "joint_ranges").groupBy("embodiment_type").agg(*side))
    x = typed_episodes(spark, d, "length").join(h, "embodiment_type")
    pieces = [F.when(F.col(s) == 1, F.concat(F.lit(f"<{s}>"), codes(c))).otherwise("") for s, c in (("left", "length"), ("right", "episode_index"))]
    return x.select("episode_index", F.concat(*pieces).alias("stream"))


@query("q9_token_offsets", f"WITH {SQL_F}, x AS (SELECT global_index, least(greatest(task_index, 0), 255) AS code FROM f) SELECT global_index, 32000 + code AS forward, 31999 - code AS backward FROM x")
def q9(spark: S, d: str) -> DataFrame:
    """Codes to ids of a vocabulary, counted up from an offset or down from one."""
    c = F.least(F.greatest("task_index", F.lit(0)), F.lit(255))
    return frames(spark, d, "task_index").select("global_index", (F.lit(32000) + c).cast("long").alias("forward"), (F.lit(31999) - c).cast("long").alias("backward"))


@query("q14_finite_scalar_codes", f"WITH {_V}, h AS (SELECT vec_id, round_even(3.5 * tanh(8 * x[1]) + 3.5, 0) AS a, round_even(2 * tanh(8 * x[2]) + 2, 0) AS b, round_even(2 * tanh(8 * x[3]) + 2, 0) AS c FROM v) SELECT vec_id, CAST(a + 8 * b + 40 * c AS BIGINT) AS code FROM h")
def q14(spark: S, d: str) -> DataFrame:
    """Finite scalar quantization with 8, 5 and 5 levels, as one mixed-radix code."""
    levels, code, radix = (8, 5, 5), F.lit(0.0), 1
    for i, n in enumerate(levels):
        half = (n - 1) / 2
        code = code + radix * F.bround(half * F.tanh(8 * at("x", i)) + half, 0)
        radix *= n
    return vec(spark, d).select("vec_id", code.cast("long").alias("code"))


@query("q15_flat_order", "SELECT part_key, level, position, row_number() OVER (ORDER BY level, part_key, position) - 1 AS flat FROM (SELECT DISTINCT part_key FROM joint_ranges) CROSS JOIN range(3) l(level) CROSS JOIN range(4) p(position)")
def q15(spark: S, d: str) -> DataFrame:
    """Codes of keys, levels and positions in level-major order; a fixed layout of a few rows."""
    def seq(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    x = table(spark, d, "joint_ranges").select("part_key").distinct().select("part_key", seq(3).alias("level")).select("part_key", "level", seq(4).alias("position"))
    return x.withColumn("flat", (F.row_number().over(Window.orderBy("level", "part_key", "position")) - 1).cast("long"))
