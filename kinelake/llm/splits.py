"""Train, validation and test splits that keep linked records together.

Records that share an author (``operator``), a source (``recording``) or an entity (the episode they were derived from)
form components, which are found first. Method for the splits: component swap search. It starts from a hashed
assignment and exchanges or moves whole components to reduce the deviation of every label's split sizes from their
targets, by annealing several chains per block of components in parallel, and keeps the best chain.

Components of more than 1/``LARGE_SHARE`` of all records (so at most that many) are assigned first, in one block; blocks of at most about ``BLOCK`` small
components then make up for what these leave over, and one last block is annealed again against the remaining
deviation of the whole. Nothing about the components reaches the driver but the sums per label and split.

Defined results: each ``episode_index`` counts once; null, empty and sentinel operators and recordings link nothing, nor
does a null or negative parent; an absent parent links its children; a record without links is a component of its own; a
null or unknown embodiment is a label of its own with default proportions; a null proportion is 0.05, one below 1e-6 none;
an empty table gives empty results; null episode indexes are left out.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.components import connected_components, star_edges
from kinelake.session import materialize

SPLITS = ("train", "val", "test")
DEFAULT_SHARE, NO_SHARE = 0.05, 1e-6
BLOCK, LARGE_SHARE, CHAINS, SEED = 2048, 1000, 4, 17

#: Full-width forms of ASCII, dashes of several kinds and the wide blank, with what they stand for.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "‐‑‒–—―−﹣" + "　 "
_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + "-" * 8 + "  "


def _folded(c: Column) -> Column:
    return F.lower(F.translate(c, _WIDE, _PLAIN))


def operator_keys(c: Column) -> Column:
    """All persons named, as letters and number without leading zeros: ``Kx.0138 & RA 7`` gives ``kx7``-like keys. Remarks in brackets do not count."""
    text = F.regexp_replace(_folded(c), r"\([^)]*\)", " ")
    found = F.regexp_extract_all(text, F.lit(r"([a-z]+[^a-z0-9+&/,;]{0,3}[0-9]+)"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"^([a-z]+)[^a-z0-9]*0*([0-9]+)$", "$1$2")))


def recording_key(c: Column) -> Column:
    """Day, site and number of a recording's path, however it is written; null if it has none."""
    text = F.regexp_replace(_folded(c), r"\\", "/")
    pattern = r"([0-9]{4})[-/_.]?([0-9]{2})[-/_.]?([0-9]{2})/+([a-z]+)/+0*([0-9]+)"
    part = [F.regexp_extract(text, pattern, i) for i in range(1, 6)]
    return F.when(part[0] != "", F.concat_ws("/", F.concat(*part[:3]), part[3], part[4]))


def memberships(episodes: DataFrame) -> DataFrame:
    """One row (``key``, ``node``) per episode and thing that links it to others."""
    keys = F.concat(
        F.coalesce(F.transform(operator_keys(F.col("operator")), lambda x: F.concat(F.lit("o:"), x)), F.array()),
        F.array(F.concat(F.lit("r:"), recording_key(F.col("recording"))), F.concat(F.lit("p:"), F.when(F.col("parent_episode_index") >= 0, F.col("parent_episode_index")).cast("long").cast("string")), F.concat(F.lit("p:"), F.col("episode_index").cast("string"))),
    )
    rows = episodes.where("episode_index is not null").select(F.explode(keys).alias("key"), F.col("episode_index").cast("long").alias("node"))
    return rows.where("key is not null").distinct()


def linked_episodes(episodes: DataFrame) -> DataFrame:
    """Per group of linked episodes one row per member but the smallest: ``episode_a`` the smallest, ``episode_b`` the member."""
    e = connected_components(star_edges(materialize(memberships(episodes), "members")))
    return e.select(F.col("v").alias("episode_a"), F.col("u").alias("episode_b"))


def anneal(counts: np.ndarray, start: np.ndarray, target: np.ndarray, weight: np.ndarray, seed: int, steps: int | None = None) -> tuple[np.ndarray, float]:
    """Assign components to splits 0, 1, 2 so that the sums of their label counts come near ``target`` (splits 1 and 2 by label).

    ``counts``: components by labels; ``weight``: of a label's deviation. Moves a component or exchanges two of them;
    worse states are accepted with a probability that falls with the temperature. Gives the best state and its cost.
    """
    n, labels = counts.shape
    rng = random.Random(seed)
    own = [[(int(j), float(c[j])) for j in np.flatnonzero(c)] for c in counts]
    dev = [[0.0] * labels] + [[float(counts[start == s, j].sum()) - float(target[s - 1, j]) for j in range(labels)] for s in (1, 2)]
    w = [float(x) for x in weight]
    cost = sum(w[j] * dev[s][j] ** 2 for s in (1, 2) for j in range(labels))
    state = start.tolist()
    best, best_cost = list(state), cost
    steps = steps or min(120_000, 4000 + 60 * n)
    hot = max(cost / max(n, 1), 1e-12)
    cold = hot * 1e-5

    def shift(i: int, a: int, b: int) -> float:
        """Take component i from split a to b; the change of cost."""
        d = 0.0
        for j, c in own[i]:
            if a:
                x = dev[a][j]
                d += w[j] * ((x - c) ** 2 - x * x)
                dev[a][j] = x - c
            if b:
                x = dev[b][j]
                d += w[j] * ((x + c) ** 2 - x * x)
                dev[b][j] = x + c
        return d

    for k in range(steps):
        heat = hot * (cold / hot) ** (k / steps)
        i = rng.randrange(n)
        a = state[i]
        j = -1
        if n > 1 and rng.random() < 0.5:
            j = rng.randrange(n)
            b = state[j]
            if a == b:
                continue
            d = shift(i, a, b) + shift(j, b, a)
        else:
            b = (a + 1 + (rng.random() < 0.5)) % 3
            d = shift(i, a, b)
        if d <= 0 or rng.random() < math.exp(-d / heat):
            state[i] = b
            if j >= 0:
                state[j] = a
            cost += d
            if cost < best_cost - 1e-15:
                best, best_cost = list(state), cost
        else:
            shift(i, b, a)
            if j >= 0:
                shift(j, a, b)
    return np.array(best), best_cost


def _annealed(blocks: DataFrame, labels: list[str], target: dict[tuple[int, int], float], weight: np.ndarray, share: np.ndarray, chains: int, seed: int) -> DataFrame:
    """The best of ``chains`` chains of each ``block``: comp, split, counts.

    ``target``: what a split of a label may get, as a share of the block's own count of that label.
    """
    goal = np.array([[target[s, j] for j in range(len(labels))] for s in (1, 2)])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, chain = key
        pdf = pdf.sort_values("comp", ignore_index=True)
        c = np.zeros((len(pdf), len(labels)))
        for i, (ls, ns) in enumerate(zip(pdf["labels"], pdf["counts"])):
            c[i, np.asarray(ls, int)] = ns
        # the hashed start: a component goes where its hash falls among the shares of its most frequent label
        most = c.argmax(1)
        u = pdf["hash"].to_numpy()
        start = np.where(u < share[0, most], 1, np.where(u < share[0, most] + share[1, most], 2, 0))
        got, cost = anneal(c, start, goal * c.sum(0), weight, seed * 1000 + int(chain) + 31 * int(block))
        return pd.DataFrame({"block": block, "chain": chain, "cost": cost, "comp": pdf["comp"], "split": got.astype("int32")})

    many = blocks.withColumn("chain", F.explode(F.array(*[F.lit(i) for i in range(chains)])))
    tried = materialize(many.groupBy("block", "chain").applyInPandas(run, "block long, chain int, cost double, comp long, split int"), "chains")
    best = tried.groupBy("block").agg(F.min_by("chain", F.struct("cost", "chain")).alias("chain"))
    return tried.join(best, ["block", "chain"], "left_semi").select("comp", "split").join(blocks, "comp")


def split_episodes(episodes: DataFrame, mixture: DataFrame, links: DataFrame | None = None, block: int = BLOCK, chains: int = CHAINS, seed: int = SEED, max_labels: int = 10_000) -> DataFrame:
    """Each ``episode_index`` once with its ``embodiment``, component (``comp``) and ``split``."""
    one = episodes.where("episode_index is not null").groupBy(F.col("episode_index").cast("long").alias("episode_index")).agg(F.min("embodiment").alias("embodiment"))
    links = links if links is not None else linked_episodes(episodes)
    node = materialize(one.join(links.select(F.col("episode_b").alias("episode_index"), "episode_a"), "episode_index", "left").withColumn("comp", F.coalesce("episode_a", "episode_index")).drop("episode_a"), "nodes")
    wanted = {r["embodiment"]: r for r in mixture.select("embodiment", "val_set_proportion", "test_set_proportion").dropDuplicates(["embodiment"]).collect()}
    sums = {r[0]: r[1] for r in node.groupBy("embodiment").count().limit(max_labels + 1).collect()}  # a row per label
    if len(sums) > max_labels:
        raise ValueError(f"more than {max_labels} embodiments")
    if not sums:
        return node.select("episode_index", "embodiment", "comp", F.lit(None).cast("string").alias("split"))
    labels = sorted(sums, key=lambda x: (x is None, x or ""))
    code = {x: i for i, x in enumerate(labels)}
    share = np.array([[_share(wanted.get(x), c) for x in labels] for c in ("val_set_proportion", "test_set_proportion")])
    total = np.array([float(sums[x]) for x in labels])
    weight = 1.0 / np.maximum(total, 1.0)
    pairs = [p for x in labels if x is not None for p in (F.lit(x), F.lit(code[x]))]
    label = F.coalesce(F.create_map(*pairs)[F.col("embodiment")] if pairs else F.lit(None), F.lit(code.get(None, -1)))
    sizes = node.groupBy("comp", label.alias("label")).agg(F.count(F.lit(1)).alias("n")).groupBy("comp").agg(F.collect_list("label").alias("labels"), F.collect_list("n").alias("counts"), F.sum("n").alias("size"))
    u = (F.pmod(F.xxhash64("comp", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("hash")
    sizes = materialize(sizes.select("comp", "labels", "counts", "size", u), "components")
    big = max(float(total.sum()) / LARGE_SHARE, 8.0)
    many = sizes.where(F.col("size") <= big).count()
    blocks = max(1, -(-many // block))
    large = sizes.where(F.col("size") > big).withColumn("block", F.lit(-1).cast("long"))
    small = sizes.where(F.col("size") <= big).withColumn("block", F.pmod(F.xxhash64("comp", F.lit(seed + 1)), F.lit(blocks)))

    def sums_of(df: DataFrame) -> np.ndarray:
        got = df.select("split", F.explode(F.arrays_zip("labels", "counts")).alias("z")).groupBy("split", F.col("z.labels").alias("j")).agg(F.sum("z.counts").alias("n")).collect()  # splits x labels
        out = np.zeros((3, len(labels)))
        for r in got:
            out[r["split"], r["j"]] = r["n"]
        return out

    def goal(left: np.ndarray, own: np.ndarray) -> dict[tuple[int, int], float]:
        return {(s, j): float(np.clip(left[s - 1, j] / own[j], 0, 1)) if own[j] else 0.0 for s in (1, 2) for j in range(len(labels))}

    same = goal(share * total, total)
    first = materialize(_annealed(large, labels, same, weight, share, chains, seed), "large")
    in_large = sums_of(first)
    rest = _annealed(small, labels, goal(share * total - in_large[1:], total - in_large.sum(0)), weight, share, chains, seed + 1)
    rest = materialize(rest, "small")
    # the deviation that is left is made up for by one block of small components
    got = in_large + sums_of(rest)
    last = rest.where("block = 0")
    in_last = sums_of(last)
    own = in_last.sum(0)
    fixed = _annealed(last.drop("split"), labels, goal(share * total - got[1:] + in_last[1:], own), weight, share, chains, seed + 2)
    final = first.select("comp", "split").unionByName(rest.where("block <> 0").select("comp", "split")).unionByName(fixed.select("comp", "split"))
    name = F.element_at(F.array(*[F.lit(x) for x in SPLITS]), F.col("split") + 1)
    return node.join(final, "comp").select("episode_index", "embodiment", "comp", name.alias("split"))


def _share(row: object, column: str) -> float:
    x = row[column] if row is not None else None
    if x is None or math.isnan(x):
        return DEFAULT_SHARE
    return 0.0 if x < NO_SHARE else float(x)


def split_report(assigned: DataFrame, mixture: DataFrame) -> DataFrame:
    """Target and actual share of every split of every embodiment, counted in episodes."""

    def share(c: str) -> Column:
        x = F.coalesce(F.col(c), F.lit(DEFAULT_SHARE))
        return F.when(x < NO_SHARE, 0.0).otherwise(x)

    m = mixture.dropDuplicates(["embodiment"]).select(F.col("embodiment").alias("label"), share("val_set_proportion").alias("t_val"), share("test_set_proportion").alias("t_test"))
    n = assigned.groupBy("embodiment").agg(F.count(F.lit(1)).alias("total"), *[F.sum((F.col("split") == s).cast("long")).alias(f"n_{s}") for s in SPLITS])
    j = n.join(F.broadcast(m), F.col("embodiment").eqNullSafe(F.col("label")), "left").na.fill(DEFAULT_SHARE, ["t_val", "t_test"])
    target = {"train": 1 - F.col("t_val") - F.col("t_test"), "val": F.col("t_val"), "test": F.col("t_test")}
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("split"), F.col(f"n_{s}").alias("episodes"), target[s].alias("target")) for s in SPLITS])).alias("z")
    return j.select("embodiment", "total", rows).select("embodiment", "z.split", "z.episodes", F.round("z.target", 6).alias("target_share"), F.round(F.col("z.episodes") / F.col("total"), 6).alias("actual_share"))
