"""Access to the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_received(df: DataFrame, *keys: str, order: str = "received_at") -> DataFrame:
    """One row per key: the one received first, ties broken by the whole row, so the result is the same every time."""
    rest = [c for c in df.columns if c not in keys and c != order]
    tie = F.xxhash64(*[F.col(c).cast("string") if df.schema[c].dataType.typeName() == "map" else F.col(c) for c in rest]) if rest else F.lit(0)
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last(), tie)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
