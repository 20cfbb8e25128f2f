"""A codebook of vectors by Lloyd's rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nearest(df: DataFrame, book: np.ndarray) -> DataFrame:
    """Adds ``code``: the number of the entry nearest to ``x``, the first of several; null where ``x`` is null or not of the book's width."""
    width = book.shape[1]
    halves = (book * book).sum(1) / 2
    schema = T.StructType([*df.schema.fields, T.StructField("code", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(b.schema.get_field_index("x"))
            rows = x.to_pandas()
            ok = np.array([v is not None and len(v) == width for v in rows], bool)
            code = np.zeros(b.num_rows, np.int64)
            if ok.any():
                code[ok] = np.argmax(np.round(np.stack(rows[ok].to_numpy()).astype(float) @ book.T - halves, 9), axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code, mask=~ok)], names=[*b.schema.names, "code"])

    return df.mapInArrow(run, schema)


def lloyd(df: DataFrame, key: str, entries: int, rounds: int, max_entries: int = 65_536) -> DataFrame:
    """Adds ``code``: the entry of a codebook for each vector ``x`` (array of double).

    The first entries are the vectors of the smallest hashes of ``key``. Each round moves an entry to the mean of its vectors; one
    without vectors stays. Only the entries come to the driver, one row each, at most ``max_entries``. Fewer vectors than entries leave entries unused; null vectors get none.
    """
    if entries > max_entries:
        raise ValueError(f"more than {max_entries} entries")
    known = df.where("x is not null").select(key, "x")
    first = [r["x"] for r in known.select("x", F.xxhash64(key).alias("h"), key).orderBy("h", key).limit(entries).collect()]
    if not first:
        return df.withColumn("code", F.lit(None).cast("long"))
    book = np.array(first, float)
    for _ in range(rounds):
        means = nearest(known, book).where("code is not null").groupBy("code").agg(F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(book.shape[1])]).alias("m")).collect()
        new = book.copy()
        for r in means:
            new[r["code"]] = r["m"]
        if np.array_equal(new, book):
            break
        book = new
    return nearest(df, book)
