"""Inputs that many queries share, and the SQL for the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.operators.windows import ranked
from kinelake.tables import table


def r6(x: str) -> str:
    """SQL that rounds as the queries do; a negative zero becomes zero."""
    return f"(round({x}, 6) + 0.0)"


def R6(c):  # noqa: N802 - the column twin of r6
    return F.round(c, 6) + F.lit(0.0)


def rf(x: str) -> str:
    """SQL for statistics of readings of any size: six decimals at most, and the digits of a float."""
    return f"(CAST(round({x}, 6) AS FLOAT) + CAST(0 AS FLOAT))"


def RF(c):  # noqa: N802 - the column twin of rf
    return F.round(c, 6).cast("float") + F.lit(0.0).cast("float")


def frames(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Each frame once. One shuffle by episode serves the removal of copies and windows inside episodes."""
    cols = dict.fromkeys(("global_index", "episode_index", "frame_index", *columns))
    return table(spark, sf_dir, "frames").select(*cols).repartition("episode_index").dropDuplicates(["episode_index", "global_index"])


def ranked_frames(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return ranked(frames(spark, sf_dir, *columns))


def by_dimension(df: DataFrame, field: str) -> DataFrame:
    """One row per frame and dimension of its episode: adds ``dim`` and ``v``, null where the reading is missing or not finite."""
    width = F.max(F.size(F.coalesce(field, F.array().cast("array<float>")))).over(Window.partitionBy("episode_index"))
    x = df.withColumn("__width", width).where("__width > 0")
    v = F.transform(F.sequence(F.lit(0), F.col("__width") - 1), lambda i: F.get(field, i).cast("double"))
    x = x.select(*[c for c in df.columns if c != field], F.posexplode(v).alias("dim", "v")).withColumn("dim", F.col("dim").cast("long"))
    return x.withColumn("v", F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v")))


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each episode once, without the time it came in."""
    return table(spark, sf_dir, "episodes").drop("received_at").dropDuplicates(["episode_index"])


def typed_episodes(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Episodes with their embodiment type; the mixture is a fixed table."""
    m = table(spark, sf_dir, "mixture").select("embodiment", "embodiment_type")
    return episodes(spark, sf_dir).select("episode_index", "embodiment", *columns).join(F.broadcast(m), "embodiment")


#: Readings by frame and dimension, as in by_dimension: {0} is the vector's name.
SQL_D = "w AS (SELECT episode_index, max(len({0})) AS width FROM g GROUP BY episode_index), d AS (SELECT g.*, i AS dim, CASE WHEN isfinite({0}[i + 1]) THEN CAST({0}[i + 1] AS DOUBLE) END AS v FROM g JOIN w USING (episode_index), LATERAL (SELECT unnest(range(width)) AS i))"
#: Common table expressions: f frames, g frames with position and length, e episodes, t episodes with type.
SQL_F = "f AS (SELECT DISTINCT ON (global_index) * EXCLUDE (received_at) FROM frames)"
SQL_G = SQL_F + ", g AS (SELECT f.*, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS rn, count(*) OVER (PARTITION BY episode_index) AS n FROM f)"
SQL_E = "e AS (SELECT DISTINCT ON (episode_index) * EXCLUDE (received_at) FROM episodes)"
SQL_T = SQL_E + ", t AS (SELECT e.*, m.embodiment_type FROM e JOIN (SELECT embodiment, embodiment_type FROM mixture) m USING (embodiment))"
