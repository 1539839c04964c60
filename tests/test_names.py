from __future__ import annotations

import random

import duckdb
import pandas as pd
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordtrust.functions.names import _may_exceed, names_agree, similar_udf

WORD = st.text(alphabet="abcd ", max_size=14)
PAIRS = [
    ("same", "same", 1),
    ("MARTHA", "MARHTA", 1),
    ("abc", "abd", 0),
    ("", "", 1),
    ("", "a", 0),
    ("Acme", "acme", 0),
    ("ab", "abc", 1),
    (None, "a", -1),
    ("a", None, -1),
]


def near_copies(n: int) -> list[tuple[str, str]]:
    rng = random.Random(7)
    out = []
    for _ in range(n):
        a = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 24)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            spot = rng.randint(0, len(b))
            if rng.random() < 0.5:
                b.insert(spot, rng.choice("abcdefgh "))
            elif b and spot < len(b):
                b.pop(spot)
        out.append((a, "".join(b)))
    return out


def duck_similar(pairs, threshold):
    pdf = pd.DataFrame(pairs, columns=["s", "t"])  # noqa: F841
    con = duckdb.connect()
    con.register("pdf", pdf)
    rows = con.execute("SELECT s, t, jaro_winkler_similarity(s, t) FROM pdf").fetchall()
    return {(s, t): j > threshold for s, t, j in rows}


def test_edge_pairs(spark):
    df = spark.createDataFrame([(s, t) for s, t, _ in PAIRS], "s string, t string")
    got = [r[0] for r in df.select(names_agree(F.col("s"), F.col("t"))).collect()]
    assert got == [label for _, _, label in PAIRS]


def test_agrees_with_duckdb_on_near_copies(spark):
    pairs = near_copies(5000)
    expected = duck_similar(pairs, 0.9)
    df = spark.createDataFrame(pairs, "s string, t string")
    for s, t, label in df.select("s", "t", names_agree(F.col("s"), F.col("t"))).collect():
        assert label == int(s == t or expected[s, t]), (s, t)


def test_bound_drops_no_match(spark):
    for threshold in (0.8, 0.9, 0.95):
        pairs = near_copies(3000)
        expected = duck_similar(pairs, threshold)
        df = spark.createDataFrame(pairs, "s string, t string")
        kept = df.select("s", "t", _may_exceed(F.col("s"), F.col("t"), threshold).alias("open")).collect()
        assert all(r.open for r in kept if r.s != r.t and expected[r.s, r.t])
        assert not all(r.open for r in kept)


@hypothesis_settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(WORD, WORD), min_size=1, max_size=20))
def test_worker_function_agrees_with_duckdb(pairs):
    similar = similar_udf(0.9).func
    got = similar(pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs]))
    expected = duck_similar(pairs, 0.9)
    assert list(got) == [expected[p] and p != ("", "") for p in pairs]


def test_whole_long_text_is_compared():
    similar = similar_udf(0.9).func
    text = "lorem ipsum " * 2000
    far = text[:4] + "q" * (len(text) - 4)
    assert list(similar(pd.Series([text, text]), pd.Series([text[:-1] + "z", far]))) == [True, False]
