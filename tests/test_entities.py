import random
import re

import pytest

from corpusmill.operators import entities
from corpusmill.operators.entities import extract_entities, gazetteer_entities, pattern_entities

NAMES = [
    ("New York", "LOCATION"), ("York", "LOCATION"), ("New York Times", "ORG"), ("Times", "PRODUCT"),
    ("Ann Lee", "PERSON"), ("Lee", "ORG"), ("lee", "ORG"), ("Lee", "PERSON"), ("a b c d", "PRODUCT"),
    ("--", "ORG"),
]


def by_python(docs):
    names = {}
    for name, kind in NAMES:
        key = tuple(re.findall(r"[^\W_]+", name.lower()))
        if key:
            names[key, kind] = min(name, names.get((key, kind), name))
    found = []
    for doc, text in docs:
        t = re.findall(r"[^\W_]+", (text or "").lower())
        hits = [
            (i, i + len(k), kind, entity)
            for (k, kind), entity in names.items()
            for i in range(len(t) - len(k) + 1)
            if tuple(t[i : i + len(k)]) == k
        ]
        for s, e, kind, entity in hits:
            if not any(s2 <= s and e <= e2 and e2 - s2 > e - s for s2, e2, _, _ in hits):
                found.append((doc, kind, entity, s))
    return sorted(found)


@pytest.mark.parametrize(
    "limit, digests", [(entities.BROADCAST_BYTES, 0), (0, entities.DIGEST_ROWS), (0, 0)]
)
@pytest.mark.parametrize("bucket", [4096, 3])
def test_gazetteer(spark, monkeypatch, limit, digests, bucket):
    monkeypatch.setattr(entities, "BUCKET_TOKENS", bucket)
    rng = random.Random(5)
    words = ["New", "york", "TIMES", "Ann", "Lee", "a", "b", "c", "d", "x"]
    docs = [(i, " ".join(rng.choices(words, k=40))) for i in range(8)]
    docs += [(100, ""), (101, None), (102, "the New-York Times")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    gazetteer = spark.createDataFrame(NAMES, "name string, entity_type string")
    found = gazetteer_entities(df, gazetteer, broadcast_bytes=limit, digest_rows=digests)
    assert sorted(map(tuple, found.collect())) == by_python(docs)


def test_patterns(spark):
    text = "Paid $1,299.50 and $20 on 2024-05-01, Q4 2023, May 5, 2020 and June 2021; 12024-05-011"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    found = sorted((r.entity_type, r.pos, r.entity) for r in pattern_entities(df).collect())
    assert found == [
        ("DATE", 0, "2024-05-01"), ("DATE", 1, "Q4 2023"), ("DATE", 2, "May 5, 2020"),
        ("DATE", 3, "June 2021"), ("MONEY", 0, "$1,299.50"), ("MONEY", 1, "$20"),
    ]


@pytest.mark.parametrize("limit", [entities.BROADCAST_BYTES, 0])
def test_both(spark, limit):
    df = spark.createDataFrame([(1, "Ann Lee paid $5")], "doc_id int, text string")
    gazetteer = spark.createDataFrame(NAMES, "name string, entity_type string")
    both = extract_entities(df, gazetteer, broadcast_bytes=limit).collect()
    assert sorted(map(tuple, both)) == [(1, "MONEY", "$5", 0), (1, "PERSON", "Ann Lee", 0)]
    many = spark.createDataFrame([(1, "$1 " * 9000 + "lee")], "doc_id int, text string")
    found = extract_entities(many, gazetteer, broadcast_bytes=limit).collect()
    assert sorted((r.pos, r.entity_type) for r in found) == sorted(
        [(i, "MONEY") for i in range(9000)] + [(9000, "ORG"), (9000, "PERSON")]
    )
    empty = gazetteer.limit(0)
    assert {r.entity for r in extract_entities(df, empty).collect()} == {"$5"}


def test_large_gazetteer_is_not_copied(spark):
    """Names beyond the size that is sent go through the shuffle once, and only first tokens are sent."""
    df = spark.createDataFrame([(1, "Ann Lee of New York")], "doc_id int, text string")
    found = gazetteer_entities(df, spark.createDataFrame(NAMES, "name string, entity_type string"), broadcast_bytes=0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and "_head" in plan and plan.count("strategy=broadcast") == 1
    assert {r.entity for r in found.collect()} == {"Ann Lee", "New York"}
