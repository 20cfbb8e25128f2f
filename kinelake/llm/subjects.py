"""Subject areas of documents.

Method: documents are cut into paragraphs and sentences. Terms that discriminate between subjects span the space in which
a paragraph is a vector: the evidence of its sentences, summed by the subject that their discriminative terms speak for and normalised. All
paragraph vectors are clustered by bisecting k-means. Each leaf is labelled by its discriminative terms (likelihood ratio of the
leaf against all leaves), and its mixture of subjects is the mean of what these terms mean. A paragraph has the subjects of its
leaf's mixture, a document those of all its paragraphs; the robot's own subject stays only where there is no other. There is no other way to a subject.

What a term means is settled in two steps: on a sample of at most ``max_labels`` documents labelled by hand (a bound, chosen by a hash of the id),
by counts of labels and of the subjects of the other sentences of its paragraphs; then once more by such counts over all documents. Expressions that mostly stand where they
don't fit mention in passing; their sentences are no evidence.

Vectors are kept in steps of one in ``units(k)`` of the evidence, at most ``MAX_CELLS`` different ones whatever the size of the corpus, so k-means
runs over cells that hold all paragraphs by their counts, in a pass over the data for all levels together. Terms are hashed into ``1 << TERM_BITS`` buckets, so the tables sent to tasks have a fixed
size. Counts and clusters cover all documents.

Defined results: null, empty and wordless texts have no row; labels that are null or no subject are left out; doubled labels count once;
a text that deals with no other subject, or in which no term is known, is about the robot (``robot``); texts in JSON are read by their string values, markup is left
out; without any labels terms of the subjects' names and descriptions stand in for them; empty tables give empty results.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.session import discard, materialize

TERM_BITS, PAIR_BITS = 18, 22
#: Leaves of the clustering, rounds of each split, and the least paragraphs of a cluster that is split.
LEAVES, SPLIT_ROUNDS, LEAST_SPLIT = 48, 8, 20
#: Most different vectors there can be.
MAX_CELLS = 250_000
#: Discriminative terms that label a leaf, and the share of its mixture from which a leaf has a further subject.
LEAF_TERMS, FURTHER = 30, 0.4
#: Rounds of settling terms on the labelled sample.
ROUNDS = 3
#: A term speaks for a subject if this share of its contexts does and it was seen so often; a sentence needs EVIDENCE in all.
CONCENTRATED, SEEN, EVIDENCE = 0.5, 4.0, 1.5
#: An expression mentions in passing if its sentences do not fit their paragraph for at least this share, with 95% confidence.
PASSING = 0.79
#: Weight of a sentence about the robot against one about another subject with full evidence.
ROBOT_WEIGHT = 0.2
#: Counts of pairs of neighbouring terms and of terms share one table.
_TERMS, _PAIRS = 1 << TERM_BITS, 1 << PAIR_BITS

_TAG = re.compile(r"<[^<>]{1,40}>|0x[0-9a-fA-F]+")
_KEY = re.compile(r'"\w+"\s*:')
_BROKEN = re.compile(r"(\w)-\s*\n\s*(\w)")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_PLAIN = re.compile(r"[a-z]+(?:'[a-z]+)?")
_HAN = regex.compile(r"\p{Han}+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|[。！？@\n]+")
_PARAGRAPH = re.compile(r"\n\s*\n")


def _strings(o: object) -> Iterator[str]:
    if isinstance(o, str):
        yield o
    elif isinstance(o, dict):
        for v in o.values():
            yield from _strings(v)
    elif isinstance(o, list):
        for v in o:
            yield from _strings(v)


def terms(text: str) -> list[str]:
    """Words of at least two letters, and pairs of neighbouring Han characters, of a text in lower case."""
    if text.isascii():
        return [w for w in _PLAIN.findall(text) if len(w) > 1]
    out = []
    for m in _WORD.finditer(text):
        w = m.group()
        if w.isascii():
            if len(w) > 1:
                out.append(w)
            continue
        han = _HAN.findall(w)
        if han:
            for g in han:
                out += [g[i : i + 2] for i in range(len(g) - 1)] if len(g) > 1 else [g]
        elif len(w) > 1:
            out.append(w)
    return out


def paragraphs(text: str | None) -> list[list[list[str]]]:
    """The terms of the sentences of the paragraphs of a text; those without terms are left out."""
    if not text:
        return []
    t = text.strip()
    if t[:1] in ("{", "["):
        try:
            t = "\n".join(_strings(json.loads(t)))
        except ValueError:
            t = _KEY.sub(" ", t)
    if "-" in t:
        t = _BROKEN.sub(r"\1\2", t)
    t = _TAG.sub(" ", t if t.isascii() else unicodedata.normalize("NFKC", t)).lower()
    out = []
    for p in _PARAGRAPH.split(t):
        sents = [x for x in (terms(s) for s in _SENTENCE.split(p)) if x]
        if sents:
            out.append(sents)
    return out


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "replace")) >> (32 - TERM_BITS)


def split_texts(documents: DataFrame) -> DataFrame:
    """One row per paragraph: ``doc_id``, ``par`` and ``sents``, the buckets of the terms of each sentence in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in batches:
            ids, par, per_par, per_sent, flat = [], [], [0], [0], []
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for k, sents in enumerate(paragraphs(text)):
                    ids.append(d)
                    par.append(k)
                    for s in sents:
                        for w in s:
                            h = known.get(w)
                            if h is None:
                                if len(known) > 500_000:
                                    known.clear()
                                h = known[w] = bucket(w)
                            flat.append(h)
                        per_sent.append(len(flat))
                    per_par.append(len(per_sent) - 1)
            inner = pa.ListArray.from_arrays(pa.array(per_sent, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(par, pa.int32()), pa.ListArray.from_arrays(pa.array(per_par, pa.int32()), inner)], names=["doc_id", "par", "sents"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").mapInArrow(run, "doc_id long, par int, sents array<array<int>>")


class _Batch:
    """The sentences of a batch of paragraphs in flat arrays."""

    def __init__(self, sents: pa.Array):
        lists = sents.combine_chunks() if isinstance(sents, pa.ChunkedArray) else sents
        inner = lists.flatten()
        self.per_par = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
        self.flat = inner.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        n = pc.list_value_length(inner).to_numpy(zero_copy_only=False).astype(np.int64)
        self.n, self.pars = len(n), len(self.per_par) - 1
        self.starts = np.cumsum(n) - n  # every sentence has terms
        self.sent = np.repeat(np.arange(self.n), n)
        self.par = np.repeat(np.arange(self.pars), np.diff(self.per_par))

    def evidence(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.flat], self.starts, axis=0) if self.n else np.zeros((0, weights.shape[1]), np.float32)

    def labels(self, weights: np.ndarray, robot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each sentence: its subject (the robot's if no other has enough evidence), the evidence, and the robot's evidence."""
        c = self.evidence(weights)
        r = c[:, robot].copy()
        c[:, robot] = -np.inf
        best = c.argmax(1)
        e = c[np.arange(self.n), best] if self.n else np.zeros(0)
        return np.where((e >= EVIDENCE) & (e > r), best, robot), e, r

    def others(self, z: np.ndarray, subjects: int) -> np.ndarray:
        """Of each sentence: how many other sentences of its paragraph have which subject."""
        count = np.bincount(self.par * subjects + z, minlength=self.pars * subjects).reshape(self.pars, subjects).astype(np.float32)
        out = count[self.par]
        out[np.arange(self.n), z] -= 1
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sentence and hashed pair of its neighbouring terms."""
        same = self.sent[1:] == self.sent[:-1]
        code = ((self.flat[:-1] * 0x9E3779B1 + self.flat[1:] + 1) % (_PAIRS - _TERMS)) + _TERMS
        return self.sent[1:][same], code[same]


def term_weights(table: np.ndarray) -> np.ndarray:
    """What a term says for each subject, from its counts by subject: log of share over prior, 0 for terms that are spread or rare."""
    prior = (table.sum(0) + 1e-9) / (table.sum() + 1e-9)
    seen = table.sum(1, keepdims=True)
    share = (table + prior) / (seen + 1.0)
    w = np.log(share / prior)
    w[(share.max(1) < CONCENTRATED) | (seen[:, 0] < SEEN)] = 0
    return w.astype(np.float32)


def _least_share(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The lower end of the 95% interval (Wilson) of a share."""
    z2 = 1.96**2
    n = np.maximum(n, 1e-9)
    p = hits / n
    return (p + z2 / (2 * n) - 1.96 * np.sqrt(np.maximum(p * (1 - p), 0) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _contexts(pars: DataFrame, weights: np.ndarray, robot: int, subjects: int, passing: bool) -> tuple[np.ndarray, np.ndarray]:
    """How often each term stands in a paragraph whose other sentences deal with each subject, and the expressions that mention in passing.

    Counts are summed up in each task; at most buckets times subjects (and buckets of expressions) rows come together, whatever
    the size of the corpus. Without ``passing`` the second is empty.
    """
    shared = pars.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        table, seen, odd = np.zeros(_TERMS * subjects, np.int64), np.zeros(_PAIRS if passing else 0, np.int64), np.zeros(_PAIRS if passing else 0, np.int64)
        for b in batches:
            x = _Batch(b.column(0))
            if not x.n:
                continue
            z, _, _ = x.labels(w, robot)
            other = x.others(z, subjects)
            if passing:
                use = (z != robot) & (other.sum(1) >= 2)
                alone = use & (other[np.arange(x.n), z] == 0)
                s, e = x.pairs()
                for at, code in ((x.sent, x.flat), (s, e)):
                    # sorted runs of few codes are cheaper than tables of all of them
                    for mask, into in ((use, seen), (alone, odd)):
                        u, n = np.unique(code[mask[at]], return_counts=True)
                        into[u] += n
            idle = other[:, robot] > 0
            other[:, robot] = 0
            context = np.where(other.max(1) > 0, other.argmax(1), np.where(idle, robot, -1))
            own = context[x.sent]
            table += np.bincount((x.flat * subjects + own)[own >= 0], minlength=len(table))
        t = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(table[t]), pa.array(np.zeros(len(t), np.int64))], names=["key", "n", "m"])
        e = np.flatnonzero(seen)
        if len(e):
            yield pa.RecordBatch.from_arrays([pa.array(-1 - e), pa.array(seen[e]), pa.array(odd[e])], names=["key", "n", "m"])

    got = pars.select("sents").mapInArrow(run, "key long, n long, m long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    got = got.where((F.col("key") >= 0) | (F.col("m") >= PASSING * F.col("n"))).toPandas()
    shared.destroy()
    key, n, m = (got[c].to_numpy(np.int64) for c in ("key", "n", "m"))
    table = np.zeros(_TERMS * subjects)
    table[key[key >= 0]] = n[key >= 0]
    mask = np.zeros(_PAIRS, bool)
    e = key < 0
    mask[-1 - key[e]] = _least_share(m[e], n[e]) >= PASSING
    return table.reshape(_TERMS, subjects), mask


def units(subjects: int) -> int:
    """The most equal parts of a vector for which there are at most MAX_CELLS different vectors of so many subjects; 9 at most."""
    u = 1
    while u < 9 and math.comb(u + subjects, u + 1) <= MAX_CELLS:
        u += 1
    return u


def paragraph_vectors(pars: DataFrame, weights: np.ndarray, passing: np.ndarray, robot: int) -> DataFrame:
    """Adds ``cell``, the vector of each paragraph: the parts of its evidence by subject, one digit each; all 0 if nothing in it is known."""
    k = weights.shape[1]
    parts = units(k)
    shared = pars.sparkSession.sparkContext.broadcast((weights, passing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, skip = shared.value
        for b in batches:
            x = _Batch(b.column(2))
            z, e, r = x.labels(w, robot)
            s, q = x.pairs()
            aside = np.zeros(x.n, bool)
            aside[x.sent[skip[x.flat]]] = True
            aside[s[skip[q]]] = True
            use = ~aside & ((e > 0) | (r != 0))
            one = np.where(z == robot, ROBOT_WEIGHT, np.minimum(e, 6.0) / 6.0)
            v = np.bincount(x.par[use] * k + z[use], weights=one[use], minlength=x.pars * k).reshape(x.pars, k)
            total = v.sum(1, keepdims=True)
            share = np.where(total > 0, v / np.maximum(total, 1e-12), 0) * parts
            digits = np.floor(share + 1e-9)
            # largest remainders get the parts that are left
            left = np.where(total[:, 0] > 0, parts - digits.sum(1), 0)
            rank = np.argsort(np.argsort(-(share - digits), axis=1, kind="stable"), axis=1, kind="stable")
            digits = (digits + (rank < left[:, None])).astype(np.uint8) + 48
            cell = pa.StringArray.from_buffers(x.pars, pa.py_buffer(np.arange(0, (x.pars + 1) * k, k, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(digits)))
            yield pa.RecordBatch.from_arrays([b.column(0), cell, b.column(2)], names=["doc_id", "cell", "sents"])

    return pars.select("doc_id", "par", "sents").mapInArrow(run, "doc_id long, cell string, sents array<array<int>>")


def bisecting_kmeans(vectors: np.ndarray, weights: np.ndarray, leaves: int = LEAVES, rounds: int = SPLIT_ROUNDS, least: float = LEAST_SPLIT) -> np.ndarray:
    """The leaf of every unit vector by bisecting k-means with cosine distance; ``weights`` counts how often each occurs.

    The cluster with the largest loss (paragraphs less the length of their sum) is split next, from the vector furthest from
    its mean and the one furthest from that, until there are ``leaves`` or none has loss and at least ``least`` paragraphs. Ties go to the first.
    """
    leaf, n = np.zeros(len(vectors), np.int64), 1

    def loss(c: int) -> float:
        own = leaf == c
        many = weights[own].sum()
        return float(many - np.linalg.norm(weights[own] @ vectors[own])) if many >= least and own.sum() > 1 else 0.0

    losses = [loss(0)]
    while n < leaves and max(losses) > 1e-9:
        c = int(np.argmax(losses))
        own = np.flatnonzero(leaf == c)
        v, w = vectors[own], weights[own]
        first = v[np.argmin(v @ (w @ v))]
        centers = np.stack([first, v[np.argmin(v @ first)]])
        side = np.zeros(len(own), np.int64)
        for _ in range(rounds):
            side = np.argmax(v @ centers.T, axis=1)
            for j in (0, 1):
                total = w[side == j] @ v[side == j]
                size = np.linalg.norm(total)
                if size > 0:
                    centers[j] = total / size
        if side.min() == side.max():
            losses[c] = 0.0
            continue
        leaf[own[side == 1]] = n
        n += 1
        losses[c] = loss(c)
        losses.append(loss(n - 1))
    return leaf


def cluster(vectors: DataFrame, leaves: int = LEAVES) -> dict[str, int]:
    """The leaf of each cell of ``paragraph_vectors``; cells without evidence have none. At most MAX_CELLS rows come to the driver."""
    rows = vectors.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("cell")
    cells = rows["cell"].to_list()
    if not cells:
        return {}
    v = np.array([[ord(c) - 48 for c in x] for x in cells], float)
    some = v.sum(1) > 0
    unit = v[some] / np.linalg.norm(v[some], axis=1, keepdims=True)
    return dict(zip([c for c, s in zip(cells, some) if s], map(int, bisecting_kmeans(unit, rows["n"].to_numpy(float)[some], leaves))))


def leaf_terms(vectors: DataFrame, leaf_of: dict[str, int]) -> DataFrame:
    """How often each term occurs in each leaf: ``t``, ``leaf``, ``n``."""
    shared = vectors.sparkSession.sparkContext.broadcast(leaf_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _Batch(b.column(1))
            d = b.column(0).dictionary_encode()
            own = np.array([shared.value.get(c, -1) for c in d.dictionary.to_pylist()], np.int64)[d.indices.to_numpy(zero_copy_only=False)] if b.num_rows else np.zeros(0, np.int64)
            own = own[x.par][x.sent]
            u, n = np.unique((own * _TERMS + x.flat)[own >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u % _TERMS), pa.array((u // _TERMS).astype(np.int32)), pa.array(n)], names=["t", "leaf", "n"])

    return vectors.select("cell", "sents").mapInArrow(run, "t long, leaf int, n long").groupBy("t", "leaf").agg(F.sum("n").alias("n"))


def leaf_mixtures(by_leaf: DataFrame, meaning: np.ndarray) -> dict[int, np.ndarray]:
    """The subject mixture of each leaf from its discriminative terms. ``by_leaf``: t, leaf, n; ``meaning``: counts of each term by subject."""
    in_leaf = by_leaf.groupBy("leaf").agg(F.sum("n").alias("leaf_n"))  # as many rows as leaves
    in_all = by_leaf.groupBy("t").agg(F.sum("n").alias("t_n"))  # at most as many rows as buckets
    total = by_leaf.agg(F.sum("n")).first()[0] or 0
    x = by_leaf.join(in_all, "t").join(F.broadcast(in_leaf), "leaf")
    expected = F.col("leaf_n") * F.col("t_n") / float(max(total, 1))
    x = x.where(F.col("n") > expected).withColumn("g", F.col("n") * F.log(F.col("n") / expected))  # likelihood ratio
    top = x.withColumn("r", F.row_number().over(Window.partitionBy("leaf").orderBy(F.desc("g"), "t"))).where(F.col("r") <= LEAF_TERMS).select("leaf", "t", "g").toPandas()
    prior = (meaning.sum(0) + 1e-9) / (meaning.sum() + 1e-9)
    out = {}
    for leaf, own in top.groupby("leaf"):
        rows = meaning[own["t"].to_numpy(np.int64)]
        seen = rows.sum(1, keepdims=True)
        share = np.where(seen > 0, (rows / np.maximum(seen, 1e-9)) / np.maximum(prior, 1e-6), 0)  # subjects with more labels count no more
        share = share / np.maximum(share.sum(1, keepdims=True), 1e-9)
        m = (share * np.log1p(own["g"].to_numpy())[:, None]).sum(0) + 1e-6
        out[int(leaf)] = m / m.sum()
    return out


def leaf_subjects(mixture: np.ndarray) -> list[int]:
    """The subjects of a leaf: the largest of its mixture, and others from FURTHER on."""
    return sorted({int(mixture.argmax()), *map(int, np.flatnonzero(mixture >= FURTHER))})


def assign_subjects(documents: DataFrame, subjects: DataFrame, labels: DataFrame, robot: str = "robotics", leaves: int = LEAVES, max_labels: int = 50_000, max_subjects: int = 1000) -> DataFrame:
    """One row (``doc_id``, ``subject``) per document and subject.

    ``subjects`` (``subject``, ``description``) is a fixed table; ``labels`` (``doc_id``, ``subject``) is made by hand for a
    sample of documents. ``robot`` is the subject of texts that deal with nothing else.
    """
    rows = subjects.where("subject is not null").select("subject", "description").orderBy("subject").limit(max_subjects + 1).collect()
    if len(rows) > max_subjects:
        raise ValueError(f"more than {max_subjects} subjects")
    names = sorted({r["subject"] for r in rows} | {robot})
    code = {s: i for i, s in enumerate(names)}
    k, home = len(names), code[robot]
    pars = materialize(split_texts(documents), "paragraphs")
    if not pars.limit(1).count():
        return pars.select("doc_id", F.lit("").alias("subject"))

    index = F.create_map(*[x for s in names for x in (F.lit(s), F.lit(code[s]))])
    lab = labels.where(F.col("subject").isin(names) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.collect_set("subject").alias("ss"))
    lab = lab.select("doc_id", F.when(F.size("ss") == 1, index[F.col("ss")[0]]).cast("long").alias("s"))
    # the bound on the sample of labelled documents
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    sample = materialize(pars.join(F.broadcast(lab), "doc_id").select("sents", "s"), "sample")
    counted = sample.where("s is not null").select("s", F.explode(F.flatten("sents")).alias("t")).groupBy("t", "s").agg(F.count(F.lit(1)).alias("n")).toPandas()  # at most buckets times subjects rows
    known = np.zeros((_TERMS, k))
    known[counted["t"].to_numpy(np.int64), counted["s"].to_numpy(np.int64)] = counted["n"].to_numpy(float)
    for r in rows:
        for w in set(terms(f"{r['subject']} {r['description'] or ''}".lower())):
            known[bucket(w), code[r["subject"]]] += 1.0
    weights = term_weights(known)
    for _ in range(ROUNDS):
        weights = term_weights(known + _contexts(sample, weights, home, k, False)[0])
    table, passing = _contexts(pars, weights, home, k, True)
    meaning = table + 2.0 * known
    vectors = materialize(paragraph_vectors(pars, term_weights(meaning), passing, home), "vectors")
    discard(pars, sample)
    leaf_of = cluster(vectors, leaves)
    mixtures = leaf_mixtures(materialize(leaf_terms(vectors, leaf_of), "leaf-terms"), meaning)
    # paragraphs without evidence are in no leaf; a document of such paragraphs only is about the robot
    found = [(c, leaf_subjects(mixtures[leaf]) if leaf in mixtures else []) for c, leaf in leaf_of.items()]
    by_cell = documents.sparkSession.createDataFrame(found, "cell string, ss array<int>")  # at most MAX_CELLS rows
    got = vectors.select("doc_id", "cell").join(F.broadcast(by_cell), "cell", "left")
    got = got.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_set(F.coalesce("ss", F.array().cast("array<int>"))))).alias("ss"))
    others = F.filter("ss", lambda v: v != home)
    name = F.element_at(F.array(*[F.lit(s) for s in names]), F.col("s") + 1)
    return got.select("doc_id", F.explode(F.when(F.size(others) > 0, others).otherwise(F.array(F.lit(home)))).alias("s")).select("doc_id", name.alias("subject"))


def subject_shares(assigned: DataFrame) -> DataFrame:
    """The share of each subject in the corpus; a document with several subjects counts for each in equal parts."""
    k = assigned.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
    x = assigned.join(k, "doc_id")
    total = k.count()
    return x.groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.round(F.sum(1.0 / F.col("k")) / float(max(total, 1)), 6).alias("share"))
