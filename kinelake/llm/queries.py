"""Queries of the training-data operators, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinelake.llm import encode, mixing, percentiles, splits, subjects
from kinelake.plans.registry import Registry
from kinelake.tables import table

llm = Registry()
query = llm.query

_P4 = """
WITH f AS (
  SELECT global_index, any_value(episode_index) AS episode_index, any_value(action) AS action, any_value(state) AS state
  FROM frames GROUP BY global_index),
e AS (
  SELECT episode_index, any_value(embodiment_type) AS embodiment_type
  FROM episodes JOIN mixture USING (embodiment) GROUP BY episode_index),
r AS (
  SELECT embodiment_type, 'action' AS field, unnest(action) AS v, generate_subscripts(action, 1) - 1 AS dim FROM f JOIN e USING (episode_index)
  UNION ALL
  SELECT embodiment_type, 'state', unnest(state), generate_subscripts(state, 1) - 1 FROM f JOIN e USING (episode_index)),
p AS (
  SELECT embodiment_type, field, dim, count(*) AS n,
    quantile_cont(CAST(v AS DOUBLE), [0.0001, 0.001, 0.01, 0.5, 0.99, 0.999, 0.9999]) AS x
  FROM r WHERE v IS NOT NULL AND isfinite(v) GROUP BY embodiment_type, field, dim)
SELECT embodiment_type, field, CAST(dim AS BIGINT) AS dim, unnest(['q0001', 'q001', 'q01', 'q50', 'q99', 'q999', 'q9999']) AS quantile,
  CAST(unnest([0.0001, 0.001, 0.01, 0.5, 0.99, 0.999, 0.9999]) AS DOUBLE) AS q, n, round(unnest(x), 6) AS value, CAST(0 AS DOUBLE) AS error_bound
FROM p
"""


@query("p4_percentiles", _P4)
def p4_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per embodiment type, field and dimension over all rows of ``frames``."""
    return percentiles.type_percentiles(*(table(spark, sf_dir, n) for n in ("frames", "episodes", "mixture")))


@query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of episodes linked by operator, recording or derivation."""
    return splits.linked_episodes(table(spark, sf_dir, "episodes"))


@query("p1_splits")
def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of every episode; linked episodes share theirs."""
    return splits.split_episodes(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "mixture")).select("episode_index", "split")


@query("p1_report")
def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of the splits per embodiment."""
    m = table(spark, sf_dir, "mixture")
    return splits.split_report(splits.split_episodes(table(spark, sf_dir, "episodes"), m), m)


@query("p5_ids")
def p5_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k."""
    return encode.encoded(table(spark, sf_dir, "documents"))


@query("p6_mixture")
def p6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture: one row per document and copy."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets"))[0]


@query("p6_report")
def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, feasible and actual shares of every source."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets"))[1]


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.assign_subjects(*(table(spark, sf_dir, n) for n in ("documents", "subjects", "subject_labels")))


@query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects of every document."""
    return _subjects(spark, sf_dir)


@query("p7_shares")
def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each subject in the corpus."""
    return subjects.subject_shares(_subjects(spark, sf_dir))
