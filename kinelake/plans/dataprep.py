"""Queries that prepare raw recordings: drifting schemas and implausible readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.operators.drift import schema_changes, unified_records
from kinelake.operators.implausible import implausible_readings
from kinelake.plans.registry import query
from kinelake.tables import table


@query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spikes, stuck and impossible readings of ``frames``, judged per robot and dimension."""
    return implausible_readings(*(table(spark, sf_dir, n) for n in ("frames", "episodes", "mixture", "joint_ranges")))


_P2 = r"""
WITH f AS (
  SELECT file_id, arg_min(dataset_dir, received_at) AS d, arg_min(written_at, received_at) AS w, arg_min(features, received_at) AS j
  FROM info_files GROUP BY file_id),
o AS (SELECT file_id, lag(file_id) OVER (PARTITION BY d ORDER BY w, file_id) AS prev FROM f WHERE d IS NOT NULL),
n AS (SELECT file_id, j, unnest(json_keys(j)) AS name FROM f),
t AS (
  SELECT file_id, name, regexp_replace(lower(json_extract_string(j, '$."' || name || '".dtype')), '^torch\.', '') AS dtype,
    array_to_string(regexp_extract_all(CAST(json_extract(j, '$."' || name || '".shape') AS VARCHAR), '\d+'), ',') AS shape
  FROM n),
a AS (SELECT o.file_id, t.name, t.dtype, t.shape FROM o JOIN t ON t.file_id = o.prev),
b AS (SELECT o.file_id, t.name, t.dtype, t.shape FROM o JOIN t USING (file_id) WHERE o.prev IS NOT NULL),
gone AS (SELECT * FROM a ANTI JOIN b USING (file_id, name)),
come AS (SELECT * FROM b ANTI JOIN a USING (file_id, name)),
p AS (
  SELECT DISTINCT file_id, category, part_key, unnest(names) AS name, generate_subscripts(names, 1) AS place
  FROM (SELECT file_id, category, part_key, CASE WHEN lerobot_key LIKE '[%' THEN from_json(lerobot_key, '["VARCHAR"]') ELSE [lerobot_key] END AS names FROM shape_meta)),
r AS (
  SELECT DISTINCT o.file_id, x.name AS old, y.name AS new
  FROM o JOIN p x ON x.file_id = o.prev
  JOIN p y ON y.file_id = o.file_id AND y.category = x.category AND y.part_key = x.part_key AND y.place = x.place
  JOIN gone g ON g.file_id = o.file_id AND g.name = x.name
  JOIN come c ON c.file_id = o.file_id AND c.name = y.name)
SELECT DISTINCT file_id, new AS field, 'renamed' AS change FROM r
UNION ALL SELECT DISTINCT r.file_id, new, 'retyped' FROM r JOIN gone g ON g.file_id = r.file_id AND g.name = r.old JOIN come c ON c.file_id = r.file_id AND c.name = r.new
  WHERE g.dtype IS DISTINCT FROM c.dtype OR g.shape IS DISTINCT FROM c.shape
UNION ALL SELECT file_id, name, 'added' FROM come WHERE (file_id, name) NOT IN (SELECT file_id, new FROM r)
UNION ALL SELECT file_id, name, 'removed' FROM gone WHERE (file_id, name) NOT IN (SELECT file_id, old FROM r)
UNION ALL SELECT file_id, name, 'retyped' FROM a JOIN b USING (file_id, name) WHERE a.dtype IS DISTINCT FROM b.dtype OR a.shape IS DISTINCT FROM b.shape
"""


@query("p2_found", _P2)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of a file's features against the previous file of its dataset."""
    return schema_changes(table(spark, sf_dir, "info_files"), table(spark, sf_dir, "shape_meta")).select("file_id", "field", "change")


@query("p2_changes")
def p2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes with old names and types."""
    return schema_changes(table(spark, sf_dir, "info_files"), table(spark, sf_dir, "shape_meta"))


@query("p2_records")
def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw records in one table of stable columns and types."""
    return unified_records(*(table(spark, sf_dir, n) for n in ("raw_records", "info_files", "shape_meta")))


_P2_VALUES = r"""
WITH f AS (
  SELECT file_id, arg_min(dataset_dir, received_at) AS dataset_dir, arg_min(features, received_at) AS j FROM info_files GROUP BY file_id),
d AS (SELECT DISTINCT file_id, line_no, record, received_at, coalesce(json_valid(record), false) AS ok FROM raw_records WHERE file_id IS NOT NULL),
r AS (
  SELECT file_id, line_no, record, ok FROM d
  QUALIFY row_number() OVER (PARTITION BY file_id, line_no ORDER BY NOT ok, received_at NULLS LAST, record NULLS FIRST) = 1)
SELECT r.file_id, line_no, dataset_dir, NOT ok AS is_corrupt,
  CASE WHEN ok AND list_contains(json_keys(j), 'task_index') THEN TRY_CAST(json_extract_string(record, '$.task_index') AS BIGINT) END AS task_index,
  CASE WHEN ok AND list_contains(json_keys(j), 'frame_index') THEN TRY_CAST(json_extract_string(record, '$.frame_index') AS BIGINT) END AS frame_index,
  CASE WHEN ok AND list_contains(json_keys(j), 'timestamp') THEN round(TRY_CAST(json_extract_string(record, '$.timestamp') AS DOUBLE), 6) END AS timestamp_s
FROM r LEFT JOIN f ON f.file_id = r.file_id
"""


@query("p2_record_values", _P2_VALUES)
def p2_record_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record once, with the columns of the united table that all data sets have."""
    u = unified_records(*(table(spark, sf_dir, n) for n in ("raw_records", "info_files", "shape_meta")))
    return u.select("file_id", "line_no", "dataset_dir", "is_corrupt", "task_index", "frame_index", F.round("timestamp", 6).alias("timestamp_s"))
