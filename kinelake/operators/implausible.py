"""Implausible readings of vector-valued time series, judged per source and dimension.

Method: the valid readings of an episode are cut into profiles of ``WIDTH`` successive readings, which take the place of the profiles of a day. The profiles
of a source and dimension, scaled by its usual scatter, are the rows of a matrix. Robust principal components give its normal behaviour:
the leading directions of the profiles taken by their shape (spherical components, so no spike becomes a component), those of the source's
other dimensions lending weight where there are few. Alternating projections then split each profile into its low-rank part, estimated
without the sparse one, and a sparse part of deviations. A reading is off the path if its deviation from the low-rank part exceeds ``OFF`` units of scatter; an exact
check follows that the jump is over after a few frames, which rules out lasting shifts. Ranges and constant runs are tested separately.

A source whose rows exceed ``block_rows`` is split by episode into blocks; its scatter, the sums of squares and products that give its components, and its usual holding
times are then merged from all its blocks, so a hot source is treated like any other and never meets in one task. All these are
whole numbers and come from one pass, so blocks and whole sources give the same rows.

Defined results: null vectors and null elements are no readings and are never flagged; NaN and infinite values are
flagged; rows delivered twice (same ``global_index``) count once; rows without ``global_index`` are all kept, and reported without it; a null ``robot_id`` is a source of its own; an
episode that ``episodes`` does not have for that source takes the embodiment type of the source's other episodes; a type or
dimension without a range has no range test; an empty table gives an empty result; further columns of the inputs are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.session import materialize
from kinelake.skew import bounded_broadcast

#: Readings in a profile (a row of the matrix), components of normal behaviour, rounds of alternating projections.
WIDTH, RANK, ROUNDS = 24, 2, 6
#: Deviation from the low-rank part, in units of scatter, from which a reading is off the path.
OFF = 4.5
#: Shapes count in steps of 1 / SHAPE_STEPS; the source's other dimensions, and smooth paths, count as so many profiles of a dimension.
SHAPE_STEPS, POOLED, SMOOTH = 256, 20.0, 5.0
#: A jump is over after this many frames at most, and stands out by RETURN units of scatter from the line between its neighbours.
LONGEST_JUMP, RETURN = 5, 3.0
#: A run is stuck if it has at least SHORTEST_RUN readings and FACTOR times the length that chance allows once in ODDS such series.
SHORTEST_RUN, FACTOR, ODDS = 8, 1.8, 1e3

OUT = "global_index long, field string, dim long"
_OUT_ARROW = pa.schema([("global_index", pa.int64()), ("field", pa.string()), ("dim", pa.int64())])
_STATS_ARROW = pa.schema([("src", pa.string()), ("field", pa.string()), ("dim", pa.int32()), ("kind", pa.string()), ("bin", pa.int64()), ("n", pa.int64())])
_STATS = "src string, field string, dim int, kind string, bin long, n long"


def matrix(column: pa.ChunkedArray, order: np.ndarray, dtype: type = np.float32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a list column in the given row order: values (rows, widest), NaN where there is none; what is there; the widths."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    offsets = lists.offsets.to_numpy()
    null = np.asarray(lists.is_null()) if lists.null_count else np.zeros(len(lists), bool)
    width = np.where(null, 0, np.diff(offsets))[order]
    start = offsets[:-1][order]
    flat = lists.values
    there = ~np.asarray(flat.is_null()) if flat.null_count else None
    values = flat.to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    most = int(width.max()) if len(width) else 0
    at = start[:, None] + np.arange(most)
    inside = np.arange(most) < width[:, None]
    at = np.where(inside, at, 0)
    if not len(values):
        return np.full(at.shape, np.nan, dtype), np.zeros(at.shape, bool), width
    return values[at], inside if there is None else inside & there[at], width


def shape_products(x: np.ndarray) -> np.ndarray:
    """The sums of products of the positions of profiles (rows), each profile by its shape and not by its size; whole numbers."""
    size = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
    shape = np.rint(x * (SHAPE_STEPS / np.maximum(size, 1e-30))[:, None])
    return np.rint(shape.T @ shape).astype(np.int64)


def normal_directions(own: np.ndarray, pooled: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading directions of a dimension's profiles; those of all dimensions and smooth paths lend weight as few profiles do."""
    total = own / SHAPE_STEPS**2
    size = max(float(np.trace(pooled)), 1.0)
    t = np.linspace(-1, 1, WIDTH)
    smooth, _ = np.linalg.qr(np.stack([np.ones(WIDTH), t, t * t], axis=1))
    _, v = np.linalg.eigh(total + POOLED * pooled / size + SMOOTH / 3 * (smooth @ smooth.T))
    return v[:, -rank:].astype(np.float32)


def robust_components(x: np.ndarray, basis: np.ndarray, rounds: int = ROUNDS, threshold: float = OFF) -> np.ndarray:
    """The size of the deviation of each reading of ``x`` (profiles, in units of scatter) from the low-rank part.

    Alternating projections: the low-rank part is the projection of ``x`` without its sparse part on the normal
    directions, the sparse part keeps what deviates from it by more than a threshold that falls from round to round to ``threshold``.
    What a reading itself adds to its low-rank part is taken out of the deviation.
    """
    x = x.astype(np.float32, copy=False)
    sparse = np.zeros_like(x)
    own = np.float32(1) - np.einsum("ij,ij->i", basis, basis)
    residual = x
    for k in range(rounds):
        low = ((x - sparse) @ basis) @ basis.T
        residual = np.where(sparse != 0, x - low, (x - low) / own)
        sparse = np.where(np.abs(residual) > threshold * 2.0 ** max(rounds - 3 - k, 0), x - low, np.float32(0))
    return np.abs(residual)


def _median_bin(bins: np.ndarray, n: np.ndarray) -> float:
    """The median of a histogram over the leading 16 bits of positive floats, as the middle of its bin."""
    order = np.argsort(bins)
    cum = np.cumsum(n[order])
    b = bins[order][np.searchsorted(cum, (cum[-1] + 1) // 2)]
    lo, hi = (np.array([b, b + 1], np.uint32) << 16).view(np.float32)
    return float(lo + hi) / 2


def _longest_chance_run(lengths: np.ndarray, n: np.ndarray) -> float:
    """The run length that a series of this holding behaviour shows by chance about once in ODDS such series.

    Holding is taken as geometric; its rate is estimated twice, the second time without the runs found far too long.
    """
    keep, most = np.ones(len(lengths), bool), np.inf
    for _ in range(2):
        total, runs = float((lengths * n)[keep].sum()), float(n[keep].sum())
        if runs == 0:
            return float(most)
        rate = min(max((total - runs) / total, 1e-6), 0.95)
        most = 1 + np.log(max(total, 2) * ODDS) / -np.log(rate)
        keep = lengths <= max(SHORTEST_RUN, FACTOR * most)
    return float(most)


#: By field, dimension and kind: bins, and how many are in each.
Histograms = dict[tuple[str, int, str], tuple[np.ndarray, np.ndarray]]


class _Block:
    """The readings of one source (or a block of its episodes), ordered by episode and frame."""

    def __init__(self, t: pa.Table, lookup: pa.Table, ranges: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        index, episode, frame = (t.column(c).fill_null(-1).to_numpy() for c in ("global_index", "episode_index", "frame_index"))
        order = np.lexsort((index, frame, episode))
        # one row per global_index; copies are equal but for the time they came in. Without one a row is not known as a copy
        null = np.asarray(t.column("global_index").is_null())
        same = null[order]
        if len(order):
            known = np.flatnonzero(~same)
            _, first = np.unique(index[order][known], return_index=True)
            same[known[first]] = True
        order = order[same]
        self.index, self.unknown, self.episode = index[order], null[order], episode[order]
        self.values, self.there, self.bad_range = {}, {}, {}
        self.held = {}
        kinds = np.full(len(order), "", object)
        if lookup.num_rows and len(order):
            e, k = lookup.column("episode_index"), np.array(lookup.column("embodiment_type").to_pylist(), object)
            of_source = np.asarray(e.is_null())
            usual = k[of_source][0] if of_source.any() else None
            e, k = e.filter(e.is_valid()).to_numpy(), k[~of_source]
            by = np.argsort(e, kind="stable")
            e, k = e[by], k[by]
            if len(e):
                at = np.minimum(np.searchsorted(e, self.episode), len(e) - 1)
                kinds = np.where(e[at] == self.episode, k[at], None)
            else:
                kinds = np.full(len(order), None, object)
            kinds = np.array([usual or "" if x is None else x for x in kinds], object)
        groups = {x: kinds == x for x in set(kinds)} if len(kinds) else {}
        for field in ("action", "state"):
            v, there, _ = matrix(t.column(field), order)
            bad = there & ~np.isfinite(v)
            static = np.zeros(v.shape, bool)
            for kind, rows in groups.items():
                if kind in ranges:
                    low, high, moves = ranges[kind]
                    d = min(len(low), v.shape[1])
                    part = v[rows][:, :d]
                    with np.errstate(invalid="ignore"):
                        out = (part < low[:d]) | (part > high[:d])
                    bad[np.ix_(rows, np.arange(d))] |= there[rows][:, :d] & out
                    static[np.ix_(rows, np.arange(d))] = ~moves[:d]
            self.values[field], self.there[field], self.bad_range[field] = v, there, bad
            self.held[field] = there & ~static if field == "state" else np.zeros(v.shape, bool)

    def series(self, field: str, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, values and episode starts (positions, with the end) of the readings of a dimension that can be used."""
        rows = np.flatnonzero(self.there[field][:, dim] & ~self.bad_range[field][:, dim])
        ep = self.episode[rows]
        cuts = np.flatnonzero(ep[1:] != ep[:-1]) + 1
        return rows, self.values[field][rows, dim], np.concatenate(([0], cuts, [len(rows)])) if len(rows) else np.zeros(1, int)

    def profiles(self, field: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the readings of the profiles of a dimension, and the profiles less their medians."""
        _, v, starts = self.series(field, dim)
        at = _windows(starts, WIDTH)
        profile = v[at]
        return at, profile - np.partition(profile, WIDTH // 2, axis=1)[:, WIDTH // 2][:, None]

    def stats(self) -> Histograms:
        """What is merged over the blocks of a source: by field, dimension and kind, bins and whole numbers.

        ``step``: sizes of steps between successive readings (their leading 16 bits); ``products``: shapes of the profiles; ``run`` and ``rest``: lengths of constant
        runs, and of those at rest.
        """
        out: Histograms = {}
        for field in ("action", "state"):
            for dim in range(self.values[field].shape[1]):
                rows, v, starts = self.series(field, dim)
                if len(v) < 2:
                    continue
                step = np.abs(np.diff(v))
                inner = np.ones(len(step), bool)
                inner[starts[1:-1] - 1] = False
                moved = step[inner & (step > 0)]
                if len(moved):
                    out[field, dim, "step"] = np.unique(moved.view(np.uint32) >> 16, return_counts=True)
                    products = shape_products(self.profiles(field, dim)[1]).ravel()
                    out[field, dim, "products"] = (np.flatnonzero(products), products[products != 0])
                if self.held[field][:, dim].any():
                    use = self.held[field][rows, dim]
                    _, lengths = _runs(v[use], self.episode[rows][use])
                    out[field, dim, "run"] = np.unique(lengths, return_counts=True)  # at most as many lengths as the root of twice the readings
        for dim, runs in _long_runs(self, self.bad_range["state"]).items():
            rests = np.array([len(r) for r, rest in runs if rest], np.int64)
            if len(rests):
                out["state", dim, "rest"] = np.unique(rests, return_counts=True)
        return out


def _runs(v: np.ndarray, episode: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values within an episode."""
    if not len(v):
        return np.zeros(0, int), np.zeros(0, int)
    new = np.flatnonzero((v[1:] != v[:-1]) | (episode[1:] != episode[:-1])) + 1
    starts = np.concatenate(([0], new))
    return starts, np.diff(np.concatenate((starts, [len(v)])))


def _windows(starts: np.ndarray, width: int) -> np.ndarray:
    """Positions of the profiles of all episodes: consecutive windows, the last one moved back to end with its episode."""
    begin, end = starts[:-1], starts[1:]
    many = -(-(end - begin) // width)
    ep = np.repeat(np.arange(len(begin)), many)
    k = np.arange(len(ep)) - np.repeat(np.cumsum(many) - many, many)
    first = np.maximum(np.minimum(begin[ep] + k * width, end[ep] - width), begin[ep])
    return np.minimum(first[:, None] + np.arange(width), end[ep][:, None] - 1)


def _jumps(v: np.ndarray, starts: np.ndarray, off: np.ndarray, scatter: float) -> np.ndarray:
    """Exact check of the readings that are ``off`` the path: which belong to a jump that returns to it within LONGEST_JUMP frames.

    Readings p .. p+m-1 do if all are off the path and further than RETURN units of scatter from the line between their neighbours p-1 and
    p+m, while these are less than half as far apart: a lasting shift has no way back and does not count.
    """
    flagged = np.zeros(len(v), bool)
    first = np.flatnonzero(off)
    if not len(first):
        return flagged
    v = v.astype(np.float64)
    seg = np.searchsorted(starts, first, side="right") - 1
    begin, end = starts[seg], starts[seg + 1]
    many = np.concatenate(([0], np.cumsum(off)))
    for m in range(1, LONGEST_JUMP + 1):
        p = first[(first - 1 >= begin) & (first + m < end)]
        p = p[many[p + m] - many[p] == m]
        if not len(p):
            continue
        a, b = v[p - 1], v[p + m]
        least = np.full(len(p), np.inf)
        for j in range(m):
            np.minimum(least, np.abs(v[p + j] - (a + (b - a) * ((j + 1) / (m + 1)))), out=least)
        hit = p[(least > RETURN * scatter) & (np.abs(b - a) < 0.5 * least)]
        for j in range(m):
            flagged[hit + j] = True
    return flagged


def _judged(block: _Block, field: str, shared: Histograms) -> np.ndarray:
    """The readings of a field that are out of range or in a jump. ``shared``: the statistics of the whole source."""
    bad = block.bad_range[field].copy()
    products = {dim: _square(*x) for (f, dim, kind), x in shared.items() if f == field and kind == "products"}
    pooled = sum(products.values(), np.zeros((WIDTH, WIDTH), np.int64))
    for dim in range(block.values[field].shape[1]):
        rows, v, starts = block.series(field, dim)
        if (field, dim, "step") not in shared or len(v) < 3:
            continue
        scatter = 1.4826 * _median_bin(*shared[field, dim, "step"])
        at, profile = block.profiles(field, dim)
        far = robust_components(profile / np.float32(scatter), normal_directions(products[dim], pooled)) > OFF
        # a reading in two profiles is off the path if it is in both
        off = np.ones(len(v), bool)
        off[at[~far]] = False
        bad[rows[_jumps(v, starts, off, scatter)], dim] = True
    return bad


def _square(bins: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(WIDTH * WIDTH, np.int64)
    out[bins] = n
    return out.reshape(WIDTH, WIDTH)


def detect(block: _Block, shared: Histograms | None = None) -> pa.Table:
    """All bad readings of a block. ``shared``: the statistics of the whole source, if the block is not all of it."""
    shared = block.stats() if shared is None else shared
    found: list[tuple[np.ndarray, str, int]] = []
    for field in ("action", "state"):
        bad = _judged(block, field, shared)
        if field == "state":
            bad |= _stuck(block, bad, shared)
        for dim in range(bad.shape[1]):
            hit = np.flatnonzero(bad[:, dim])
            if len(hit):
                found.append((hit, field, dim))
    if not found:
        return _OUT_ARROW.empty_table()
    n = [len(x) for x, _, _ in found]
    hits = np.concatenate([x for x, _, _ in found])
    return pa.table(
        [pa.array(block.index[hits], mask=block.unknown[hits]), pa.array(np.repeat([f for _, f, _ in found], n).tolist(), pa.string()), np.repeat(np.array([d for _, _, d in found], np.int64), n)],
        schema=_OUT_ARROW,
    )


def _long_runs(block: _Block, bad: np.ndarray) -> dict[int, list[tuple[np.ndarray, bool]]]:
    """By dimension of ``state`` the rows of its long constant runs, and whether the robot is at rest in them.

    Bad readings are left out first, so a spike does not end a run. A run during which at least half of the other
    dimensions hold as well is a robot at rest.
    """
    held, v = block.held["state"] & ~bad, block.values["state"]
    long_runs, holds = {}, np.zeros(v.shape, bool)
    for dim in range(v.shape[1]):
        rows = np.flatnonzero(held[:, dim])
        starts, n = _runs(v[rows, dim], block.episode[rows])
        pick = n >= SHORTEST_RUN
        if not pick.any():
            continue
        long_runs[dim] = [rows[s : s + k] for s, k in zip(starts[pick], n[pick])]
        for r in long_runs[dim]:
            holds[r[0] : r[-1] + 1, dim] = True
    movable = np.maximum(block.held["state"].sum(1) - 1, 1)
    out = {}
    for dim, runs in long_runs.items():
        rest = ((holds.sum(1) - holds[:, dim]) >= 0.5 * movable) & (movable > 1)
        out[dim] = [(r, float(rest[r].mean()) >= 0.5) for r in runs]
    return out


def _stuck(block: _Block, bad: np.ndarray, shared: Histograms) -> np.ndarray:
    """Readings of ``state`` in runs far longer than their dimension otherwise holds a value.

    A robot at rest, which its source does as a matter of course, is not stuck, and rests say nothing about how long a
    moving dimension holds a value.
    """
    out = np.zeros(block.values["state"].shape, bool)
    for dim, runs in _long_runs(block, bad).items():
        own, n = (x.astype(np.int64) for x in shared.get(("state", dim, "run"), (np.zeros(0), np.zeros(0))))
        for length, many in zip(*shared.get(("state", dim, "rest"), ((), ()))):
            n[own == length] -= int(many)
        least = max(SHORTEST_RUN, FACTOR * _longest_chance_run(own, n)) if n.sum() else SHORTEST_RUN
        for r, rest in runs:
            if not rest and len(r) >= least:
                out[r, dim] = True
    return out


def implausible_readings(frames: DataFrame, episodes: DataFrame, mixture: DataFrame, ranges: DataFrame, block_rows: int = 100_000, max_range_rows: int = 100_000) -> DataFrame:
    """One row (``global_index``, ``field``, ``dim``) per bad reading of ``action`` and ``state``; see the module for the rules.

    ``block_rows``: rows of a source from which it is split into blocks. ``ranges`` and ``mixture`` are fixed tables; more
    than ``max_range_rows`` ranges are an error, since they are sent to every task.
    """
    limits = _ranges(ranges, max_range_rows)
    src = F.coalesce(F.col("robot_id"), F.lit("\0")).alias("src")
    f = frames.select(src, "global_index", "episode_index", "frame_index", "action", "state")
    sizes = f.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("src", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")).where("blocks > 1")
    sizes = bounded_broadcast(sizes)
    blk = F.pmod(F.xxhash64("episode_index"), F.coalesce(F.col("blocks"), F.lit(1))).cast("int")
    f = f.join(sizes, "src", "left").select("src", blk.alias("blk"), F.col("blocks").isNotNull().alias("split"), "global_index", "episode_index", "frame_index", "action", "state")
    e = episodes.select(src, "episode_index", "embodiment").join(F.broadcast(mixture.select("embodiment", "embodiment_type").dropDuplicates(["embodiment"])), "embodiment", "left")
    e = materialize(e.where("episode_index is not null").groupBy("src", "episode_index").agg(F.min("embodiment_type").alias("embodiment_type")), "types")
    # the type of most of a source's episodes, for those that are unknown: a row without episode_index in each of its blocks
    usual = e.where("embodiment_type is not null").groupBy("src", "embodiment_type").agg(F.count(F.lit(1)).alias("n"))
    usual = usual.groupBy("src").agg(F.min_by("embodiment_type", F.struct(-F.col("n"), "embodiment_type")).alias("embodiment_type")).join(sizes, "src", "left")
    usual = usual.select("src", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("blk"), F.lit(None).cast("long").alias("episode_index"), "embodiment_type")
    e = e.join(sizes, "src", "left").select("src", blk.alias("blk"), F.col("episode_index").cast("long").alias("episode_index"), "embodiment_type").unionByName(usual)

    def histograms(right: pa.Table) -> Histograms:
        s, out = right.filter(pc.is_valid(right.column("kind"))).to_pandas(), {}
        for (field, dim, kind), g in s.groupby(["field", "dim", "kind"]):
            out[field, int(dim), kind] = (g["bin"].to_numpy(np.int64), g["n"].to_numpy(np.int64))
        return out

    def block_stats(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _STATS_ARROW.empty_table()
        got = _Block(left, right, limits).stats()
        n = [len(bins) for bins, _ in got.values()]
        if not sum(n):
            return _STATS_ARROW.empty_table()
        names = [np.repeat(np.array(x, object), n).tolist() for x in zip(*got)]
        bins, many = (np.concatenate([x[i] for x in got.values()]).astype(np.int64) for i in (0, 1))
        return pa.table([[key[0].as_py()] * sum(n), names[0], names[1], names[2], bins, many], schema=_STATS_ARROW)

    def block_found(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _OUT_ARROW.empty_table()
        shared = histograms(right) if left.column("split")[0].as_py() else None
        return detect(_Block(left, right.filter(pc.is_null(right.column("kind"))), limits), shared)

    # only the sources that were split need their statistics merged beforehand
    hot = f.where("split").drop("split").groupBy("src", "blk")
    stats = hot.cogroup(e.join(sizes.select("src"), "src", "left_semi").groupBy("src", "blk")).applyInArrow(block_stats, _STATS)
    merged = stats.groupBy("src", "field", "dim", "kind", "bin").agg(F.sum("n").alias("n"))
    to_blocks = merged.join(sizes, "src").select("src", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"), "field", "dim", "kind", "bin", "n")
    right = e.unionByName(to_blocks, allowMissingColumns=True)
    return f.groupBy("src", "blk").cogroup(right.groupBy("src", "blk")).applyInArrow(block_found, OUT)


def _ranges(ranges: DataFrame, most: int) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By embodiment type: low, high (as the float32 that readings are) and whether a dimension can be stuck, by position."""
    rows = ranges.select("embodiment_type", "part_key", "dim", "low", "high").where("embodiment_type is not null and dim >= 0").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} ranges")
    out: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for kind in {r["embodiment_type"] for r in rows}:
        own = [r for r in rows if r["embodiment_type"] == kind]
        d = max(r["dim"] for r in own) + 1
        low, high, moves = np.full(d, -np.inf, np.float32), np.full(d, np.inf, np.float32), np.ones(d, bool)
        for r in own:
            low[r["dim"]] = -np.inf if r["low"] is None else r["low"]
            high[r["dim"]] = np.inf if r["high"] is None else r["high"]
            part = (r["part_key"] or "").lower()
            moves[r["dim"]] = not (part.endswith("gripper") or part == "lower_body")
        out[kind] = (low, high, moves)
    return out

