"""The toxicity grammar clause by clause, its learning, and held-out labels."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import toxicity
from corpusmill.llm.common import table


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.mark.parametrize("text, outputs", [
    ("An idiot wrote this.", ["plain"]),
    ("You are such an idiot", ["targeted i"]),
    ("Idiot that you are", ["plain", "aimed"]),
    ("He is not an idiot at all", ["negated i"]),
    ("It is not the answer that the idiot gave", ["plain"]),
    ('She said he was an idiot', ["reported i"]),
    ('The word "idiot" is old', ["reported i"]),
    ("She said it. An idiot came", ["plain"]),
    ("I will kill you", ["threat", "aimed threat"]),
    ("You I will kill", ["threat"]),
    ("I kill time until late in the day for you", ["threat"]),
    ("I would never kill you", ["negated t"]),
    ("He claimed they would kill you", ["reported t"]),
    ("Du Idiot! Tu es stupide, crétin", ["targeted i", "targeted i"]),
    ("Nothing of this kind here, you know", []),
    ("", []),
])
def test_clauses(text, outputs):
    found = list(toxicity.Reader({}).matches(text))
    assert [o for clause in found for o, _ in clause] == outputs
    assert all(w == toxicity._GIVEN for clause in found for _, w in clause)


def test_machine_equals_the_transducers():
    """The tables, which step over runs of other words, against the five transducers run one after the other."""
    draw = random.Random(1)
    machine, parts = toxicity.Machine(), toxicity.grammar()
    for _ in range(3000):
        symbols = draw.choices([toxicity.OTHER, *machine.symbols], [8, 3, 2, 2, 1, 1, 1], k=draw.randint(0, 30))
        state, want = parts.start, []
        for s in symbols:
            state, out = parts.step(state, s)
            if out != toxicity.OTHER:
                want.append(out)
        got = machine.run([(i, s, 1.0) for i, s in enumerate(symbols) if s != toxicity.OTHER])
        assert [o for o, _ in got] == want
        assert set(want) <= set(toxicity.OUTPUTS)


def test_entries():
    reader = toxicity.Reader({"zor": 2.0, "zorka": 3.0, "zorx$": 5.0, "abc$": 1.5})
    assert [reader.symbol(w) for w in ("zor", "zorq", "zorkas", "zorx", "zorxy", "abc", "abcd", "you")] == [
        ("i", 2.0), ("i", 2.0), ("i", 3.0), ("i", 5.0), ("i", 2.0), ("i", 1.5), None, ("g", 0.0)]


def test_weights_are_a_minimum():
    rng = np.random.default_rng(2)
    x = np.c_[np.ones(200), rng.normal(0, 1, (200, len(toxicity._PRIOR) - 1))]
    toxic = (x[:, 2] + rng.normal(0, 1, 200) > 0.5).astype(float)

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - toxic * z).sum() + ((w - toxicity._PRIOR) ** 2).sum() / 2

    w = toxicity.fit(x, toxic)
    assert all(loss(w + rng.normal(0, 0.05, len(w))) > loss(w) for _ in range(500))


@pytest.mark.parametrize("sf, least, area", [("sf0.001", 0.9, 0.75), ("sf0.01", 0.94, 0.9), ("sf0.1", 0.98, 0.95)])
def test_held_out_labels(spark, sf, least, area):
    docs, labels = (table(spark, f"/root/testdata/{sf}", n) for n in ("documents", "labels"))
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["score"], r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    bad, good = ([s for s, _, t in held if t == v] for v in (1, 0))
    assert sum((b > g) + (b == g) / 2 for g in good for b in bad) / (len(good) * len(bad)) > area
    assert sum(p == t for _, p, t in held) / len(held) > least
    assert sum(p > t for _, p, t in held) <= 0.01 * len(held)  # clean documents are left alone


def test_held_out_labels_are_not_read(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", n) for n in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x) for x in (labels, flipped))
    assert a.lexicon == b.lexicon and np.array_equal(a.weights, b.weights)


def test_awkward_rows(spark):
    texts = [None, "", " ", "?!\n", "you idiot " * 20_000, "fine", "fine", "x" * 100_000]
    rows = [(i, t, 1, 0.5, "k") for i, t in enumerate(texts)] + [(None, "you moron", 1, 0.5, "k"), (5, "fine", 1, 0.5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score double, features string")
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (6, None), (77, 1)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        got = {(r["doc_id"], r["score"], r["predicted"]) for r in toxicity.score_documents(docs, known).collect()}
        score = {d: (s, p) for d, s, p in got}
        assert len(got) == len(rows) - 1 and score[4][1] == score[None][1] == 1 and {score[i][1] for i in (0, 1, 2, 3, 5, 6, 7)} == {0}
        assert score[0] == score[1]
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    model = toxicity.train(docs, labels)
    spans = {r["doc_id"]: r["clauses"] for r in toxicity.matched_clauses(docs, model).collect()}
    assert spans[0] == [] and spans[None] == [[("targeted i", 4.0)]]
