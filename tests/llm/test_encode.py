"""The encoder against another implementation of the same vocabulary."""

import random

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from kinelake.llm import encode as E
from kinelake.tables import table

V = E.vocabulary(E.default_vocabulary())
OTHER = tiktoken.Encoding("other", pat_str=E.PATTERN, mergeable_ranks=V.rank, special_tokens={})


def test_all_documents(spark, small):
    text = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    got = {r["doc_id"]: r["ids"] for r in E.encoded(table(spark, small, "documents")).collect()}
    assert got == {k: OTHER.encode_ordinary(v) if v else [] for k, v in text.items()}


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_any_text(s):
    assert E.Encoder(E.default_vocabulary()).encode(s) == OTHER.encode_ordinary(s.encode("utf-8", "replace").decode())


def test_appends_and_edits():
    rng = random.Random(4)
    alphabet = "abcdefgh etaoin  \n\t'lsvred0123.,!éß汉字🎉"
    for _ in range(300):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        p, at = E.PrefixEncoder(V), 0
        while at < len(s):
            step = rng.randrange(1, 6)
            p.append(s[at : at + step])
            at += step
        assert p.ids == OTHER.encode_ordinary(s)
        a = rng.randrange(len(s) + 1)
        b = rng.randrange(a, min(len(s), a + 8) + 1)
        new = "".join(rng.choice(alphabet) for _ in range(rng.randrange(6)))
        p.replace(a, b, new)
        assert p.text == s[:a] + new + s[b:] and p.ids == OTHER.encode_ordinary(p.text)


def test_edit_is_local():
    p = E.PrefixEncoder(V, "the gripper closed later than commanded. " * 200)
    assert p.replace(4000, 4004, "arm") < 12


def test_long_pieces():
    for s in ("a" * 5000, "!" * 5000, "的" * 2000, " " * 5000):
        assert E.Encoder(E.default_vocabulary()).encode(s) == OTHER.encode_ordinary(s)


def test_empty_null_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "<|endoftext|>", 5), (3, "x", 5)], "doc_id long, text string, ids int")
    got = [(r["doc_id"], r["ids"]) for r in E.encoded(df).collect()]
    assert got[0] == (1, []) and got[1] == (2, []) and len(got) == 4 and 50256 not in got[2][1]
    assert E.encoded(df.limit(0)).count() == 0
