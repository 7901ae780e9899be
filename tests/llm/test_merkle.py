"""The Merkle manifest against a plain tree in Python, at several sizes and fan-outs."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
draw = random.Random(3)


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaf(r, text):
    return H(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(nodes, fan_out):
    """The root of a list of digests, and for each its path: (place in the run, run) by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fan_out] for i in range(0, len(nodes), fan_out)]
        for k, place in enumerate(at):
            paths[k].append((place % fan_out, runs[place // fan_out]))
            at[k] = place // fan_out
        nodes = [H(*r) for r in runs]
    return nodes[0], paths


def expected(rows, fan_out=8):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = [tree([leaf(r, r["text"]) for r in groups[g]], fan_out) for g in names]
    root, top = tree([t[0] for t in trees], fan_out)
    out = Counter()
    for g, (subroot, paths), above in zip(names, trees, top):
        for r, path in zip(groups[g], paths):
            path = path + above
            proof = H(*(d for i, run in path for k, d in enumerate(run) if k != i))
            tamper = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf(r, lower(r["text"]) if tamper else r["text"])
            for i, run in path:
                node = H(*run[:i], node, *run[i + 1 :])
            out[r["doc_id"], leaf(r, r["text"]), subroot, root, proof, node, node == root] += 1
    return out


def got(df, fan_out=8):
    return Counter(map(tuple, merkle.verify(merkle.build(df, other=merkle.tampered_text(), fan_out=fan_out)).collect()))


def rows_of(n, langs):
    return [(i, draw.choice(["Abc", "é Ü ABC\n", "", None, "plain"]) , draw.choice(langs), draw.choice(["s", None, "Z"]), draw.choice([1, None])) for i in range(n)]


@pytest.mark.parametrize("n, langs, fan_out", [
    (1, ["en"], 8), (8, ["en"], 8), (9, [None], 8), (65, ["en", None], 8), (700, ["en"] * 30 + ["de", "fr", None, "é", "z", "Z"], 8),
    (40, [str(i) for i in range(20)], 2), (300, ["a"] * 9 + ["b", "", None], 3),
])
def test_manifest(spark, n, langs, fan_out):
    df = spark.createDataFrame(rows_of(n, langs), COLUMNS).repartition(5)
    assert got(df, fan_out) == expected(df.collect(), fan_out)


def test_awkward_rows(spark):
    """Repeated rows, null ids, one id with several texts, columns of clashing names, an empty table."""
    rows = [(1, "A B", "en", "s", 3)] * 200 + [(1, "other", "en", "s", 3), (None, "X", "en", None, None), (None, None, None, None, None)]
    rows += [(i, "x" * 5000 + "Q", "de", "s", 3) for i in range(30)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(7)
    want = expected(df.collect())
    assert got(df) == want
    clash = df.selectExpr("*", *(f"1 AS {c}" for c in ("g", "i", "node", "path", "name", "leaf", "rank", "_row", "_part", "children")))
    assert got(clash) == want
    assert got(df.limit(0)) == Counter()


def test_records_are_content_addressed(spark):
    df = spark.createDataFrame(rows_of(100, ["en", "de"]), COLUMNS)
    m = merkle.build(df)
    for level in (*m.levels, *m.top):
        for r in level.collect():
            assert H(*(bytes(c).hex() for c in r["children"])) == bytes(r["node"]).hex() and 1 <= len(r["children"]) <= 8
    assert merkle.build(df.repartition(9)).root == m.root
    changed = df.withColumn("text", F.when(F.col("doc_id") == 7, "changed").otherwise(F.col("text")))
    assert merkle.build(changed).root != m.root
