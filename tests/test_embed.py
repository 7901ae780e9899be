import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.embed import embed_hashed, embed_with, hashed_counts, hashed_sparse

TEXTS = ["Red bolt, red BOLT; blue", "", None, "...", "a b c d e f g h i j " * 40, "été 42"]


def by_python(text, dim):
    counts = {}
    for t in re.findall(r"[^\W_]+", (text or "").lower()):
        h = hashlib.md5(t.encode()).hexdigest()
        at = int(h[:8], 16) % dim
        counts[at] = counts.get(at, 0) + (1 if int(h[8:10], 16) % 2 == 0 else -1)
    return {d: n for d, n in counts.items() if n}


@pytest.mark.parametrize("dim", [1, 3, 1536])
def test_counts(spark, dim):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    for r in df.select("i", hashed_counts("t", dim).alias("c")).collect():
        if TEXTS[r.i] is not None:
            assert {c.dim: c.n for c in r.c} == by_python(TEXTS[r.i], dim)
            assert [c.dim for c in r.c] == sorted(c.dim for c in r.c)


def test_unit_length(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t], "text string")
    for r in df.select(hashed_sparse("text", 64).alias("s")).collect():
        norm = math.sqrt(sum(e.w**2 for e in r.s))
        assert r.s == [] or abs(norm - 1) < 1e-12


def test_dense(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    rows = {r.i: r.vector for r in embed_hashed(df, dim=16).collect()}
    assert rows[1] is None and rows[2] is None and rows[3] is None
    counts = by_python(TEXTS[0], 16)
    norm = math.sqrt(sum(n * n for n in counts.values()))
    expected = [counts.get(d, 0) / norm for d in range(16)]
    assert rows[0] == pytest.approx(expected, abs=1e-6)


def test_own_model(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "text string")
    out = embed_with(df, lambda texts: [[len(t), 1.5] for t in texts], 2)
    assert sorted(r.vector for r in out.collect()) == [[2.0, 1.5], [3.0, 1.5]]
    # a NULL text never reaches the model
    gap = spark.createDataFrame([("ab",), (None,)], "text string")
    out = embed_with(gap, lambda texts: [[len(t), 1.5] for t in texts], 2)
    assert {r.text: r.vector for r in out.collect()} == {"ab": [2.0, 1.5], None: None}
    wrong = embed_with(df, lambda texts: [[0.0] for _ in texts], 2)
    with pytest.raises(Exception, match="vectors of 2"):
        wrong.select(F.sum(F.size("vector"))).collect()
