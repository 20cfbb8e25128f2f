"""Subjects: accuracy on labels that were held out, and defined results."""

from pyspark.sql import functions as F

import numpy as np

from kinelake.llm import subjects as S
from kinelake.llm.subjects import assign_subjects, bisecting_kmeans, paragraphs, subject_shares, terms, units
from kinelake.tables import table


def test_terms():
    assert terms("the gripper's 2 arms 机械臂") == ["the", "gripper's", "arms", "机械", "械臂"]
    assert paragraphs('{"caption": "Peel the egg.", "n": 3}') == [[["peel", "the", "egg"]]]
    assert paragraphs("a b\n\n <p>one two.</p> three") == [[["one", "two"], ["three"]]]
    assert paragraphs(None) == paragraphs("") == paragraphs("000 -- ") == []


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, subs, labels = (table(spark, d, n) for n in ("documents", "subjects", "subject_labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = assign_subjects(docs, subs, labels.where(~held)).groupBy("doc_id").agg(F.collect_set("subject").alias("got"))
    want = labels.where(held & F.col("subject").isNotNull()).groupBy("doc_id").agg(F.collect_set("subject").alias("want"))
    n, right = want.join(got, "doc_id").agg(F.count(F.lit(1)), F.sum((F.size(F.array_intersect("got", "want")) > 0).cast("int"))).first()
    assert n >= 20 and right / n >= 0.75  # some labels are wrong


def test_small_and_empty(spark):
    s = spark.createDataFrame([("robotics", "gripper arm joint"), ("cooking", "egg soup pan")], "subject string, description string")
    lab = spark.createDataFrame([(1, "cooking"), (1, "cooking"), (2, None), (2, "nonsense")], "doc_id long, subject string")
    rows = [(1, "Whisk the egg. Stir the soup."), (2, None), (3, ""), (4, "123 --"), (5, "The gripper arm and joint moved.")]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, leaf string, sents int")
    got = assign_subjects(d, s, lab).collect()
    assert {r["doc_id"] for r in got} == {1, 5} and {r["subject"] for r in got} <= {"robotics", "cooking"}
    assert assign_subjects(d.limit(0), s, lab).count() == 0
    assert assign_subjects(d, s, lab.limit(0)).count() >= 2


def test_shares(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "doc_id long, subject string")
    assert {r["subject"]: (r["documents"], r["share"]) for r in subject_shares(a).collect()} == {"x": (2, 0.75), "y": (1, 0.25)}


def test_rows_come_from_the_leaves(spark):
    """With a single leaf every document with evidence has the same subject; with leaves held-out labels are met."""
    d = "/root/testdata/sf0.01"
    docs, subs, labels = (table(spark, d, n) for n in ("documents", "subjects", "subject_labels"))
    one = assign_subjects(docs, subs, labels, leaves=1).where("subject <> 'robotics'")
    assert one.select("subject").distinct().count() <= 1
    many = assign_subjects(docs, subs, labels)
    assert many.select("subject").distinct().count() == 12
    assert many.exceptAll(one).count() > 0.5 * many.count()


def test_bisecting_kmeans_separates_directions():
    rng = np.random.default_rng(3)
    axis = rng.integers(0, 5, 400)
    v = np.abs(rng.normal(0, 0.05, (400, 5)))
    v[np.arange(400), axis] += 1
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    leaf = bisecting_kmeans(v, np.ones(400), 5)
    assert len(set(leaf)) == 5 and len(set(zip(leaf, axis))) == 5
    assert len(set(bisecting_kmeans(v[:1].repeat(30, 0), np.ones(30), 4))) == 1  # nothing to split
    assert len(set(bisecting_kmeans(v[:0], np.ones(0), 4))) == 0


def test_number_of_vectors_is_bounded():
    assert units(12) == 9 and units(1000) == 1 and units(1) == 9


def test_tokens_of_plain_text_are_those_of_any_text():
    t = "the gripper's arm - isn't x stuck'"
    assert terms(t) == [w for w in terms(t + " é\u4e00") if not S._HAN.search(w)]
