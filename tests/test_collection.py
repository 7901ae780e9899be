import numpy as np
import pytest

from corpusmill.operators import collection
from corpusmill.operators.collection import collection_stats, knn

DIM = 4


def vectors():
    rng = np.random.default_rng(3)
    # a third of the points are copies of one vector
    copies = [[1.0, 2.0, 0.0, -1.0]] * 20
    return copies + rng.normal(size=(38, DIM)).round(3).tolist() + [[0.0] * DIM, [2.0] * DIM]


def by_numpy(points, queries, k):
    found = []
    for q, qv in queries:
        scored = []
        for p, pv in points:
            a, b = np.array(qv), np.array(pv)
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((-round(float(a @ b / norm), 9) if norm else -0.0, p))
        for rank, (s, p) in enumerate(sorted(scored)[:k], 1):
            found.append((q, rank, p, round(-s, 6) + 0.0))
    return sorted(found)


@pytest.mark.parametrize("form", ["broadcast", "sliced", "blocks"])
@pytest.mark.parametrize("k", [1, 7, 100])
def test_knn_is_exact(spark, monkeypatch, form, k):
    data = [(i * 7 % 60, v) for i, v in enumerate(vectors())]
    points = spark.createDataFrame(data, "id int, vector array<double>").repartition(5)
    asked = [(f"q{i}", v) for i, v in data if i % 4 == 0]
    queries = spark.createDataFrame(asked, "query_id string, vector array<double>")
    options = {}
    if form == "sliced":
        monkeypatch.setattr(collection, "MATRIX_ENTRIES", 30)
    if form == "blocks":
        options = {"broadcast_bytes": 8 * DIM, "block_rows": 16}
    found = knn(points, queries, k, dim=DIM, **options).collect()
    assert sorted((r.query_id, r.rank, r.id, round(r.score, 6) + 0.0) for r in found) == by_numpy(
        data, asked, k
    )


def test_knn_leaves_out_unfit_vectors(spark):
    points = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [None, 1.0]), (5, [0.5, 0.5])],
        "id int, vector array<double>",
    )
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "query_id int, vector array<double>")
    found = knn(points, queries, 5, dim=2).orderBy("rank").collect()
    assert [r.id for r in found] == [1, 5]
    assert knn(points, queries.limit(0), 5, dim=2).count() == 0
    assert knn(points.limit(0), queries, 5, dim=2).count() == 0


def test_stats(spark):
    points = spark.createDataFrame(
        [
            ("a", [1.0, 2.0], ("Title", "heading", "x")),
            ("b", [1.0], ("Title", None, "")),
            ("c", None, (None, None, None)),
        ],
        "id string, vector array<double>, payload struct<type:string,category:string,text:string>",
    )
    found = {(r.section, r.key): r.n for r in collection_stats(points, 2).collect()}
    assert found == {
        ("type", "Title"): 2, ("type", "Unknown"): 1, ("category", "heading"): 1,
        ("category", "Unknown"): 2, ("points", "total"): 3, ("points", "with_text"): 1,
        ("points", "with_vector"): 1,
    }
    assert ("points", "with_vector") not in {
        (r.section, r.key) for r in collection_stats(points).collect()
    }


def test_blocks_of_a_worker_are_small():
    """Queries sent along, a block of vectors, and a score matrix: a worker holds a few of each."""
    assert collection.BROADCAST_BYTES <= 16 * 2**20 and 8 * collection.MATRIX_ENTRIES <= 16 * 2**20
