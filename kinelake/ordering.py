"""Neighbours in a global order, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.session import materialize
from kinelake.skew import bounded_broadcast


def previous_in_group(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Adds ``previous``: the ``value`` of the row before in the ``order`` within the same ``group``; null for its first.

    Rows are sorted by range over group and order, so a group of any size is spread over tasks; only the first and
    last row of each task meet to close the gaps between tasks. Nulls in ``order`` come first; ``value`` is a long. A null group has no order:
    its rows have no previous one.
    """
    cols = list(dict.fromkeys([group, *order, value]))
    named = df.select(*cols, F.when(F.col(group).isNotNull(), F.xxhash64(group)).alias("__g"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["__g", group, *order]
    sorted_ = named.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("__pid", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.drop("__g").schema.fields) + ", previous long, __pid int, __first boolean, __last boolean"

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*cols, "previous", "__pid", "__first", "__last"]
        held: list | None = None  # the row that is not known to be the last yet
        types = None
        first = True

        def emit(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        at = cols.index(group), cols.index(value)
        for b in batches:
            types = [b.schema.field(c).type for c in cols] + [pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
            data = [b.column(cols_at).to_pylist() for cols_at in range(len(cols))]
            pid = b.column(b.schema.get_field_index("__pid")).to_pylist()
            out = []
            for i in range(b.num_rows):
                row = [c[i] for c in data]
                before = held[at[1]] if held is not None and row[at[0]] is not None and held[at[0]] == row[at[0]] else None
                if held is not None:
                    out.append(held)
                held = [*row, before, pid[i], first, False]
                first = False
            if out:
                yield emit(out)
        if held is not None:
            held[-1] = True
            yield emit([held])

    linked = materialize(sorted_.mapInArrow(link, schema), "ordered")
    ends = linked.where("__first or __last").select("__pid", "__first", "__last", F.col(group).alias("g"), F.col(value).alias("v"))
    # as many rows as there are tasks with rows
    lasts = ends.where("__last").select(F.col("__pid").alias("lp"), F.col("g").alias("lg"), F.col("v").alias("lv"))
    nexts = lasts.withColumn("np", F.lead("lp").over(Window.partitionBy(F.lit(0)).orderBy("lp"))).where("np is not null").select(F.col("np").alias("__pid"), F.lit(True).alias("__first"), "lg", "lv")
    j = linked.join(F.broadcast(nexts), ["__pid", "__first"], "left")
    closed = F.coalesce("previous", F.when(F.col("lg") == F.col(group), F.col("lv")))
    return j.select(*cols, closed.alias("previous"))


def position_in_group(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: the place of each row, from 0, in the ``order`` of its group; no task holds a whole group.

    Rows are cut into ranges of group and order; each range numbers its own rows, and the few counts by range and group give the offsets. Null groups
    are a group. ``order`` must tell the rows of a group apart, or ties are numbered in any order.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = materialize(df.repartitionByRange(n, *group, *order).withColumn("__pid", F.spark_partition_id()), "ranges")
    own = F.row_number().over(Window.partitionBy("__pid", *group).orderBy(*order)) - 1
    counts = x.groupBy("__pid", *group).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy(*(group or [F.lit(0)])).orderBy("__pid")) - F.col("__n"))
    before = bounded_broadcast(before.select(F.col("__pid").alias("__p"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__before"))
    same = F.col("__pid") == F.col("__p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return x.withColumn("__own", own).join(before, same).select(*df.columns, (F.col("__own") + F.col("__before")).cast("long").alias(name))


def spread(df: DataFrame, count: str, name: str, piece: int = 65_536) -> DataFrame:
    """Each row ``count`` times, with ``name`` from 0 on; made in pieces over all tasks, so no row holds a long array."""
    p = df.where(F.col(count) > 0).withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{count}` - 1) div {piece}")))).repartition("__b", *df.columns)
    last = F.least((F.col("__b") + 1) * piece, F.col(count)) - 1
    return p.withColumn(name, F.explode(F.sequence(F.col("__b") * piece, last))).drop("__b")


def with_previous(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Adds ``previous``: the ``value``, of any type, of the row before in the order of its group, by a join on group and place."""
    x = materialize(position_in_group(df, [group], [order], "__at"), "places")
    y = x.select(F.col(group).alias("__g"), (F.col("__at") + 1).alias("__next"), F.col(value).alias("previous"))
    return x.join(y, x["__at"].eqNullSafe(y["__next"]) & x[group].eqNullSafe(y["__g"]), "left").select(*df.columns, "previous")
