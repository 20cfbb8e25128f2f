"""Percentiles of very large numeric columns by radix selection.

Method: floating values become integers of the same order, of 32 bits for float and of 64 for double; the first digit (``DIGIT`` leading bits) is counted in
a histogram per part (a dataset, a day), which is the partial result that is stored and combined later. From the sum
of any parts' histograms each target rank is followed into the one digit that holds it, the next bits are counted only
for values with that prefix, and so on until all bits are known: two passes for float, four for double.

Error bound: after any number of digits the percentile lies between the smallest and the largest value with the
prefix found (``low``, ``high``); after the last digit both are the same, so the result is exact. Merged partials
alone (``bracket``) bound it within one first digit: for float, values of the same sign differ by less than 1/128 of a
power of two, for double by less than 1/16.

The percentile q of n values is linearly interpolated between the order statistics ``floor(q (n-1))`` and
``ceil(q (n-1))``, counted from 0.

Defined results: null, NaN and infinite values are left out, and so are null vectors; -0.0 counts as 0.0; a group
without values has no row; an empty table gives an empty result; rows without a group are left out. Fields of integers of up to 32 bits count as
double; long and decimal fields are refused, since not all their values are doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.operators.implausible import matrix
from kinelake.session import materialize
from kinelake.skew import bounded_broadcast

#: Bits of a digit.
DIGIT = 16
#: Names and ranks of the percentiles.
QUANTILES = (("q0001", 0.0001), ("q001", 0.001), ("q01", 0.01), ("q50", 0.5), ("q99", 0.99), ("q999", 0.999), ("q9999", 0.9999))

_COUNTS = "part string, group string, field string, dim int, prefix long, digits array<int>, counts array<long>"
_COUNTS_ARROW = pa.schema(
    [("part", pa.string()), ("group", pa.string()), ("field", pa.string()), ("dim", pa.int32()), ("prefix", pa.int64()), ("digits", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
)


def ordered_keys(v: np.ndarray) -> np.ndarray:
    """float32 or float64 values as unsigned integers of the same order and width."""
    kind = np.uint32 if v.dtype == np.float32 else np.uint64
    top = kind(8 * v.dtype.itemsize - 1)
    bits = (v + v.dtype.type(0)).view(kind)  # -0.0 becomes 0.0
    return np.where(bits >> top == 1, ~bits, bits | kind(1) << top)


def key_values(k: np.ndarray, width: int) -> np.ndarray:
    """The values of ordered integers of 32 or 64 bits."""
    kind, real = (np.uint32, np.float32) if width == 32 else (np.uint64, np.float64)
    k, top = k.astype(kind), kind(width - 1)
    return np.where(k >> top == 1, k & ~(kind(1) << top), ~k).astype(kind).view(real)


def _width(df: DataFrame, fields: tuple[str, ...]) -> int:
    """Bits of the keys: 32 if all fields are arrays of float, else 64."""
    kinds = {df.schema[f].dataType.elementType.typeName() for f in fields}
    if not kinds <= {"float", "double", "integer", "short", "byte"}:
        raise TypeError(f"fields of {sorted(kinds)}: cast them to double, if that keeps their values")
    return 32 if kinds == {"float"} else 64


def _count(df: DataFrame, fields: tuple[str, ...], width: int, done: int, targets: tuple[np.ndarray, np.ndarray] | None, groups: list[str] | None, parts: bool) -> DataFrame:
    """Histograms of the digit after the first ``done`` bits, of all values or only of those with a target's prefix.

    ``targets``: the sorted prefixes there are, and the sorted codes ``((group * len(fields) + field) * 2**16 + dim) << 24 | prefix's number``.
    """
    bits, shift = DIGIT, width - done - DIGIT
    real = np.float32 if width == 32 else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple[str | None, str], int] = {}
        group_code = {g: i for i, g in enumerate(groups)} if groups is not None else {}
        seen, counts, waiting = [], [], 0

        def squeeze() -> tuple[np.ndarray, np.ndarray]:
            if not seen:
                return np.zeros(0, np.uint64), np.zeros(0, np.int64)
            u, back = np.unique(np.concatenate(seen), return_inverse=True)
            return u, np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            every = np.arange(batch.num_rows)
            part = t.column("part").combine_chunks().dictionary_encode() if parts else None
            group = t.column("group").combine_chunks().dictionary_encode()
            part, group = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (part, group))
            names = group.dictionary.to_pylist()
            g = group.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            if parts:
                p, dirs = part.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), part.dictionary.to_pylist() + [None]
            else:
                p, dirs = np.zeros(len(every), np.int64), [None]
            pair = (p % len(dirs)) * max(len(names), 1) + g
            local = np.zeros(len(every), np.uint64)
            for u in np.unique(pair[g >= 0]):
                key = (dirs[u // len(names)], names[u % len(names)])
                local[pair == u] = codes.setdefault(key, len(codes)) if targets is None else group_code.get(key[1], (1 << 14) - 1)
            for f, field in enumerate(fields):
                v, there, _ = matrix(t.column(field), every, real)
                use = there & np.isfinite(v) & (g >= 0)[:, None]
                if not use.any():
                    continue
                head = (local[:, None] * np.uint64(len(fields)) + np.uint64(f)) * np.uint64(1 << 16) + np.arange(v.shape[1], dtype=np.uint64)
                key = ordered_keys(v[use]).astype(np.uint64)
                code = head[use]
                if targets is not None:
                    prefixes, wanted = targets
                    prefix = key >> np.uint64(width - done)
                    at = np.minimum(np.searchsorted(prefixes, prefix), len(prefixes) - 1)
                    hit = prefixes[at] == prefix
                    code, key = code[hit] << np.uint64(24) | at[hit].astype(np.uint64), key[hit]
                    at = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
                    hit = wanted[at] == code
                    code, key = at[hit].astype(np.uint64), key[hit]
                code = (code << np.uint64(bits)) | ((key >> np.uint64(shift)) & np.uint64((1 << bits) - 1))
                u, n = np.unique(code, return_counts=True)
                seen.append(u)
                counts.append(n)
                waiting += len(u)
            if waiting > 2_000_000:
                u, n = squeeze()
                seen, counts, waiting = [u], [n], len(u)
        u, n = squeeze()
        if not len(u):
            return
        digit = (u & np.uint64((1 << bits) - 1)).astype(np.int32)
        owner = u >> np.uint64(bits)
        cut = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(u)])).astype(np.int32)
        first = owner[cut[:-1]]
        if targets is None:
            head, prefix = first, np.zeros(len(first), np.int64)
        else:
            first = targets[1][first.astype(np.int64)]
            head, prefix = first >> np.uint64(24), targets[0][(first & np.uint64((1 << 24) - 1)).astype(np.int64)].view(np.int64)
        dim, rest = (head & np.uint64(0xFFFF)).astype(np.int32), head >> np.uint64(16)
        field = [fields[int(x)] for x in rest % np.uint64(len(fields))]
        who = (rest // np.uint64(len(fields))).astype(np.int64)
        if targets is None:
            named = list(codes)
            part_names, group_names = [named[x][0] for x in who], [named[x][1] for x in who]
        else:
            part_names, group_names = [None] * len(who), [groups[x] for x in who]
        offsets = pa.array(cut)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part_names, pa.string()), pa.array(group_names, pa.string()), pa.array(field, pa.string()), pa.array(dim), pa.array(prefix), pa.ListArray.from_arrays(offsets, pa.array(digit)), pa.ListArray.from_arrays(offsets, pa.array(n))],
            schema=_COUNTS_ARROW,
        )

    return df.mapInArrow(run, _COUNTS)


def partials(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The partial result of each part: one row per part, group, field and dimension with the histogram of the first digit.

    ``df`` has ``part``, ``group`` and the ``fields``, which are arrays of floats. Rows of one key may come more than
    once (one per task); ``merge`` adds them up, now or later, together with those of any other parts.
    """
    return _count(df.select("part", "group", *fields), fields, _width(df, fields), 0, None, None, True)


def merge(counts: DataFrame) -> DataFrame:
    """The sum of partial histograms over all their parts: group, field, dim, prefix, digit, n."""
    flat = counts.select("group", "field", "dim", "prefix", F.explode(F.arrays_zip("digits", "counts")).alias("z"))
    return flat.groupBy("group", "field", "dim", "prefix", F.col("z.digits").alias("digit")).agg(F.sum("z.counts").alias("n"))


def follow(merged: DataFrame, ranks: DataFrame) -> DataFrame:
    """The digit that holds each target rank: the ranks with a longer prefix, and the rank left inside it.

    ``ranks``: group, field, dim, prefix, rank (from 0 within the prefix) and further columns, which are kept.
    """
    w = Window.partitionBy("group", "field", "dim", "prefix").orderBy("digit")
    cum = merged.withColumn("upto", F.sum("n").over(w)).withColumn("before", F.col("upto") - F.col("n"))
    hit = ranks.join(cum, ["group", "field", "dim", "prefix"]).where("rank >= before and rank < upto")
    return hit.withColumn("rank", F.col("rank") - F.col("before")).withColumn("prefix", F.shiftleft("prefix", DIGIT).bitwiseOR(F.col("digit").cast("long"))).drop("digit", "n", "upto", "before")


def target_ranks(merged: DataFrame, quantiles: tuple[tuple[str, float], ...] = QUANTILES) -> DataFrame:
    """The two order statistics that each percentile lies between: rank ``lower`` (side 0) and the next (side 1)."""
    n = merged.groupBy("group", "field", "dim").agg(F.sum("n").cast("long").alias("total"))
    q = F.explode(F.array(*[F.struct(F.lit(a).alias("quantile"), F.lit(b).alias("q")) for a, b in quantiles])).alias("t")
    at = F.col("t.q") * (F.col("total") - 1)
    t = n.select("group", "field", "dim", "total", q).select("group", "field", "dim", "total", "t.quantile", "t.q", at.alias("at"))
    both = t.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    rank = F.when(F.col("side") == 0, F.floor("at")).otherwise(F.ceil("at")).cast("long")
    return both.select("group", "field", "dim", F.lit(0).cast("long").alias("prefix"), "total", "quantile", "q", "at", "side", rank.alias("rank"))


def bracket(found: DataFrame, bits_known: int, width: int = 32) -> DataFrame:
    """Percentiles with bounds from ranks whose first ``bits_known`` of ``width`` bits were followed: low <= percentile <= high."""
    shift = width - bits_known
    key_low = F.shiftleft("prefix", shift)
    key_high = key_low.bitwiseOR(F.lit((1 << shift) - 1))
    a = found.where("side = 0").select("group", "field", "dim", "quantile", "q", "total", "at", key_low.alias("k0"), key_high.alias("k1"))
    b = found.where("side = 1").select("group", "field", "dim", "quantile", key_low.alias("k2"), key_high.alias("k3"))
    j = a.join(b, ["group", "field", "dim", "quantile"])

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            k = [key_values(x.column(c).to_numpy(zero_copy_only=False).view(np.uint64), width).astype(np.float64) for c in ("k0", "k1", "k2", "k3")]
            share = x.column("at").to_numpy(zero_copy_only=False) % 1.0
            low, high = (lo + (hi - lo) * share for lo, hi in ((k[0], k[2]), (k[1], k[3])))
            cols = [x.column(c) for c in ("group", "field", "dim", "quantile", "q", "total")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(low), pa.array(high)], names=["group", "field", "dim", "quantile", "q", "n", "low", "high"])

    return j.mapInArrow(values, "group string, field string, dim int, quantile string, q double, n long, low double, high double")


def radix_percentiles(df: DataFrame, fields: tuple[str, ...], quantiles: tuple[tuple[str, float], ...] = QUANTILES, max_targets: int = 5_000_000) -> DataFrame:
    """Exact percentiles per group, field and dimension: group, field, dim, quantile, q, n, low, high.

    One pass over ``df`` per digit. What the tasks get to know between passes is the targets' prefixes, at most two
    per group, field, dimension and percentile; more than ``max_targets`` are an error, not a guess.
    """
    width = _width(df, fields)
    merged = materialize(merge(partials(df, fields)), "digits")
    ranks = follow(merged, target_ranks(merged, quantiles))
    done = DIGIT
    while done < width:
        ranks = materialize(ranks, "ranks")
        wanted = ranks.select("group", "field", "dim", "prefix").distinct().limit(max_targets + 1).toPandas()
        if len(wanted) > max_targets:
            raise ValueError(f"more than {max_targets} targets")
        if not len(wanted):
            break
        groups = sorted(wanted["group"].unique())
        code = {g: i for i, g in enumerate(groups)}
        head = (wanted["group"].map(code).to_numpy(np.uint64) * np.uint64(len(fields)) + wanted["field"].map({f: i for i, f in enumerate(fields)}).to_numpy(np.uint64)) * np.uint64(1 << 16)
        prefixes, number = np.unique(wanted["prefix"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        targets = np.unique((head + wanted["dim"].to_numpy(np.uint64)) << np.uint64(24) | number.astype(np.uint64))
        ranks = follow(merge(_count(df.select("group", *fields), fields, width, done, (prefixes, targets), groups, False)), ranks)
        done += DIGIT
    return bracket(ranks, done, width)


def readings_by_type(frames: DataFrame, episodes: DataFrame, mixture: DataFrame, fields: tuple[str, ...] = ("action", "state")) -> DataFrame:
    """Each ``global_index`` of ``frames`` once, with its dataset as ``part`` and its embodiment type as ``group``.

    Only the keys are shuffled to find the rows delivered more than once; those few are fetched and reduced to one
    copy, all others pass through. Rows without ``global_index`` are no copies of each other.
    """
    f = frames.select("global_index", "episode_index", *fields)
    twice = materialize(f.where("global_index is not null").groupBy("global_index").count().where("count > 1").select("global_index"), "twice")
    twice = bounded_broadcast(twice)
    copies = materialize(f.join(twice, "global_index", "left_semi").dropDuplicates(["global_index"]), "copies")
    types = mixture.select("embodiment", F.col("embodiment_type").alias("group")).where("embodiment_type is not null").dropDuplicates(["embodiment"])
    e = episodes.groupBy("episode_index").agg(F.min("dataset_dir").alias("part"), F.min("embodiment").alias("embodiment"))
    e = bounded_broadcast(materialize(e.join(F.broadcast(types), "embodiment").drop("embodiment"), "episodes"))
    return f.join(twice, "global_index", "left_anti").unionByName(copies).join(e, "episode_index").select("part", "group", *fields)


def type_percentiles(frames: DataFrame, episodes: DataFrame, mixture: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Percentiles of every dimension of ``action`` and ``state`` per embodiment type, with their error bound."""
    p = radix_percentiles(readings_by_type(frames, episodes, mixture), ("action", "state"))
    return p.select(
        F.col("group").alias("embodiment_type"), "field", F.col("dim").cast("long").alias("dim"), "quantile", "q", "n",
        F.round((F.col("low") + F.col("high")) / 2, 6).alias("value"), F.round((F.col("high") - F.col("low")) / 2, 6).alias("error_bound"),
    )
