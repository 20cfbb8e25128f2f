"""Mixing sources to target weights, in tokens of a public tokenizer.

Method: Pareto order sampling. A source's budget in tokens divided by its tokens is the expected number of
copies of each of its documents. The whole copies are certain; what remains is an inclusion probability p. A document with the uniform
number u gets the rank ``[u / (1 - u)] / [p / (1 - p)]``, and the documents of the smallest ranks are taken until the
source's budget is met. Documents can have unequal probabilities: by default one in a group of ``k`` exact copies
counts ``1 / k``, so copied texts don't crowd out others, and expected copies never exceed ``max_repeats``.

Budgets: the total is ``total_tokens`` (by default what all usable sources hold). A source whose share exceeds ``max_repeats`` times
its tokens gets that much; what it lacks is shared out among the others by their weights, again and again, so that the total is kept as long as anything is left to repeat.

The cut between taken and left documents is found by radix selection on the ranks: histograms of the tokens by leading bits of
the rank, then of the next bits within the one bucket that holds the cut. No source is sorted in one task.

Defined results: source names are compared without case and outer blanks; documents of a null or unlisted source take no
part and are reported together under a null source; null and empty texts have no tokens and take no part; a null or
non-positive weight or ``max_repeats`` means no share; doubled targets of a source count once (the largest weight); equal ranks are taken or
left together; a source without documents is reported with none; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.llm.encode import token_counts
from kinelake.session import materialize
from kinelake.skew import hot_split_join

SEED = 29
#: Bits per step of the search for the cut; three steps know 48 of the rank's 52 bits.
STEP_BITS = 16


def source_name(c: Column) -> Column:
    """A source as it is compared: lower case, without outer blanks; null if empty."""
    x = F.lower(F.regexp_replace(c, r"^[\s 　]+|[\s 　]+$", ""))
    return F.when(x != "", x)


def budgets(weight: np.ndarray, limit: np.ndarray, total: float) -> np.ndarray:
    """Tokens of each source: shares of ``total`` by ``weight``, none above its ``limit``, the rest shared out again."""
    got = np.zeros(len(weight))
    open_ = (weight > 0) & (limit > 0)
    while open_.any():
        left = total - got[~open_].sum()
        want = left * weight / weight[open_].sum()
        full = open_ & (want >= limit)
        if not full.any():
            got[open_] = want[open_]
            break
        got[full] = limit[full]
        open_ &= ~full
    return got


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str | None = None, total_tokens: int | None = None, even_copies: bool = True, seed: int = SEED, max_sources: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """The mixture (one row per document and copy: ``source``, ``doc_id``, ``copy``, ``n_tokens``) and the report per source.

    ``targets`` (``source``, ``target_weight``, ``max_repeats``) is a fixed table of at most ``max_sources`` rows.
    """
    spark = documents.sparkSession
    t = targets.select(source_name(F.col("source")).alias("source"), "target_weight", "max_repeats").where("source is not null")
    t = t.groupBy("source").agg(F.max("target_weight").alias("weight"), F.max("max_repeats").alias("cap"))
    wanted = t.orderBy("source").limit(max_sources + 1).collect()
    if len(wanted) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), source_name(F.col("source")).alias("source"), "text")
    sizes = token_counts(docs.withColumn("same", F.md5("text")), tokenizer, keep=("doc_id", "source", "same"))
    sizes = materialize(sizes, "sizes")
    listed = F.broadcast(t.select("source"))
    held = {r["source"]: r for r in sizes.join(listed, "source", "left_semi").groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).collect()}
    weight = np.array([max(0.0, float(r["weight"] or 0.0)) if (r["cap"] or 0) > 0 else 0.0 for r in wanted])
    cap = np.array([float(max(0, r["cap"] or 0)) for r in wanted])
    tokens = np.array([float(held[r["source"]]["tokens"]) if r["source"] in held else 0.0 for r in wanted])
    total = float(total_tokens) if total_tokens is not None else float(tokens[weight > 0].sum())
    budget = budgets(weight, cap * tokens, total)

    used = sizes.join(listed, "source", "left_semi").where("n_tokens > 0")
    if even_copies:
        many = used.groupBy("source", "same").agg(F.count(F.lit(1)).alias("k"))
        # a group of copies can be large, but its rows are only counted, and join as one row
        key = F.md5(F.concat("same", F.lit("|"), "source")).alias("copy_key")
        many = many.select(key, "k").groupBy("copy_key").agg(F.max("k").alias("k"))
        used = hot_split_join(used.withColumn("copy_key", F.md5(F.concat("same", F.lit("|"), "source"))), many, "copy_key").withColumn("w", 1.0 / F.col("k")).drop("copy_key", "k")
    else:
        used = used.withColumn("w", F.lit(1.0))
    used = materialize(used.select("source", "doc_id", "n_tokens", "w"), "used")
    # factor: sum over documents of tokens * min(cap, factor * w) = budget; piecewise linear, by the few distinct w of a source
    groups = used.groupBy("source", "w").agg(F.sum("n_tokens").alias("x"))
    knots = groups.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("w", "x"))).alias("g")).collect()
    at = {r["source"]: i for i, r in enumerate(wanted)}
    factors = [(k["source"], float(_factor(np.array([g["w"] for g in k["g"]]), np.array([float(g["x"]) for g in k["g"]]), cap[at[k["source"]]], budget[at[k["source"]]]))) for k in knots]
    plan = spark.createDataFrame(factors, "source string, factor double")
    caps = spark.createDataFrame([(r["source"], int(c)) for r, c in zip(wanted, cap)], "source string, cap long")
    x = used.join(F.broadcast(plan), "source").join(F.broadcast(caps), "source").withColumn("expected", F.least(F.col("cap").cast("double"), F.col("factor") * F.col("w")))
    x = x.withColumn("whole", F.floor(F.col("expected") + 1e-9).cast("long")).withColumn("p", F.greatest(F.lit(0.0), F.col("expected") - F.col("whole")))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = F.when(F.col("p") > 1e-9, (u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    # odds in 0 .. inf become an integer of the same order
    key = F.floor(odds / (1 + odds) * float(1 << 52)).cast("long")
    x = materialize(x.select("source", "doc_id", "n_tokens", "whole", key.alias("key")), "ranked")
    done = {r["source"]: float(r["n"]) for r in x.groupBy("source").agg(F.sum(F.col("whole") * F.col("n_tokens")).alias("n")).collect()}
    need = {s: max(0.0, float(budget[at[s]]) - n) for s, n in done.items()}
    cuts = _cuts(x, need)
    cut = spark.createDataFrame(list(cuts.items()) or [("", -1)], "source string, cut long")
    y = x.join(F.broadcast(cut), "source", "left").withColumn("copies", F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0))
    y = materialize(y.where("copies > 0").select("source", "doc_id", "n_tokens", "copies"), "copies")
    mixture = y.select("source", "doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"), "n_tokens")

    actual = y.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("actual_tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies"))
    rows = [(r["source"], float(w), int(c), held[r["source"]]["docs"] if r["source"] in held else 0, int(n), float(b), bool(w > 0 and b >= c * n - 0.5)) for r, w, c, n, b in zip(wanted, weight, cap, tokens, budget)]
    rest = sizes.join(listed, "source", "left_anti").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).first()
    rows.append((None, 0.0, 0, rest["docs"], rest["tokens"], 0.0, False))
    base = spark.createDataFrame(rows, "source string, weight double, max_repeats long, available_documents long, available_tokens long, budget double, capped boolean")
    reached = actual.agg(F.sum("actual_tokens")).first()[0] or 0
    sum_w = float(weight.sum()) or 1.0
    report = base.join(F.broadcast(actual), "source", "left").select(
        "source", F.round(F.col("weight") / sum_w, 6).alias("target_share"), F.round(F.col("budget") / max(total, 1.0), 6).alias("feasible_share"),
        F.round(F.coalesce("actual_tokens", F.lit(0)) / float(max(reached, 1)), 6).alias("actual_share"), "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "capped",
        "available_documents", "available_tokens", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("actual_tokens", F.lit(0)).alias("actual_tokens"),
    )
    return mixture, report


def _factor(w: np.ndarray, x: np.ndarray, cap: float, budget: float) -> float:
    """The factor at which documents of weight ``w`` and ``x`` tokens get ``budget`` in all, none more than ``cap`` copies."""
    if budget <= 0 or cap <= 0:
        return 0.0
    order = np.argsort(-w)
    w, x = w[order], x[order]
    full = 0.0
    for i in range(len(w)):  # weights from i on are below the cap
        f = (budget - full) / float((w[i:] * x[i:]).sum())
        if f * w[i] <= cap + 1e-12:
            return f
        full += cap * x[i]
    return cap / float(w[-1])


def _cuts(ranked: DataFrame, need: dict[str, float]) -> dict[str, int]:
    """For each source the largest key such that the tokens up to it come nearest to what it needs; -1 for none."""
    spark = ranked.sparkSession
    state = {s: (0, n) for s, n in need.items() if n > 0}  # prefix so far, tokens still needed behind what lies before it
    width = 52
    while state and width > 0:
        bits = min(STEP_BITS, width)
        width -= bits
        now = spark.createDataFrame([(s, p) for s, (p, _) in state.items()], "source string, prefix long")
        top = F.shiftright("key", width + bits)
        got = ranked.where("key is not null").join(F.broadcast(now), "source").where(top == F.col("prefix"))
        h = got.groupBy("source", F.shiftright("key", width).alias("bucket")).agg(F.sum("n_tokens").alias("n"))
        # per source the bucket in which the sum passes the need; at most 2**STEP_BITS buckets each
        wants = spark.createDataFrame([(s, float(n)) for s, (_, n) in state.items()], "source string, need double")
        cum = h.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))).join(F.broadcast(wants), "source")
        hit = cum.groupBy("source").agg(F.min(F.when(F.col("upto") >= F.col("need"), F.struct("bucket", "upto", "n"))).alias("hit"), F.max("bucket").alias("last")).collect()
        new: dict[str, tuple[int, float]] = {}
        for r in hit:
            s = r["source"]
            if r["hit"] is None:  # all together are not enough: everything is taken
                new[s] = (r["last"], float("inf"))
            else:
                new[s] = (r["hit"]["bucket"], state[s][1] - (r["hit"]["upto"] - r["hit"]["n"]))
            if width == 0 and r["hit"] is not None:
                # the last bucket holds the documents at the cut; take them if that is nearer
                inside = float(r["hit"]["n"])
                new[s] = (r["hit"]["bucket"] if inside - new[s][1] <= new[s][1] else r["hit"]["bucket"] - 1, 0.0)
        state = {s: (p, n if n != float("inf") else 1e300) for s, (p, n) in new.items()}
    return {s: p for s, (p, _) in state.items()}
