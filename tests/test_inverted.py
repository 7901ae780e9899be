import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators.collection import knn
from corpusmill.operators.inverted import _nearest, build_lists, fit_centroids, probes_for, recall, search_lists


def clustered(spark, n=1500, dim=8, groups=20, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (groups, dim))
    m = centers[rng.integers(0, groups, n)] + rng.normal(0, 0.3, (n, dim))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, vector array<double>")


@pytest.mark.parametrize("block_rows", [None, 40])
def test_search(spark, block_rows):
    points = clustered(spark)
    queries = points.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    exact = knn(points, queries, 10, dim=8)
    index = build_lists(points, 8)
    assert index.lists == 38 and index.points.count() == 1500
    whole = search_lists(index, queries, 10, probes=index.lists, dim=8, block_rows=block_rows)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, exact.collect()))
    few = search_lists(index, queries, 10, probes=8, dim=8, block_rows=block_rows)
    measured = recall(few, exact).first()
    assert measured["queries"] == 75 and measured["recall"] >= 0.95
    chosen = probes_for(index, queries, 10, dim=8, target=0.95)
    assert 1 <= chosen <= 8
    assert 0.95 <= recall(search_lists(index, queries, 10, probes=chosen, dim=8), exact).first()["recall"]
    own = {r["query_id"]: r["id"] for r in few.where("rank = 1").collect()}
    assert own == {q: q for q in range(0, 1500, 20)}


def test_rows_left_out(spark):
    """Vectors that are NULL, short, with gaps or zero; copies that fill one list; more lists than points."""
    rows = [(0, None), (1, [1.0]), (2, [1.0, None]), (3, [1.0, float("nan")]), (4, [0.0, 0.0]), (5, [1.0, 0.0]), (6, [0.0, 2.0])]
    rows += [(i, [3.0, 4.0]) for i in range(10, 200)]
    points = spark.createDataFrame(rows, "id long, vector array<double>")
    index = build_lists(points, 2, 5)
    queries = spark.createDataFrame([(1, [6.0, 8.0]), (2, None)], "query_id long, vector array<double>")
    found = search_lists(index, queries, 3, probes=1, dim=2, block_rows=16).collect()
    assert [(r["query_id"], r["rank"], r["id"], r["score"]) for r in found] == [(1, 1, 10, 1.0), (1, 2, 11, 1.0), (1, 3, 12, 1.0)]
    nothing = build_lists(points.limit(0), 2)
    assert search_lists(nothing, queries, 3, probes=1, dim=2).count() == 0
    assert len(fit_centroids(points, 2, 500)) <= 193


def test_no_pairs_of_all_blocks(spark):
    """Points are shuffled once however many queries there are."""
    points = clustered(spark)
    index = build_lists(points, 8)
    queries = points.withColumnRenamed("id", "query_id")
    plan = search_lists(index, queries, 5, probes=2, dim=8)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "CartesianProduct" not in plan
    assert search_lists(index, queries, 5, probes=2, dim=8).groupBy("query_id").agg(F.count("*").alias("n")).where("n = 5").count() > 1400


def test_vectors_leave_python_once(spark):
    """However many lists are probed, a query is one row of the Python step, and repeated by Spark."""
    rows = clustered(spark, 300).withColumnsRenamed({"id": "query_id", "vector": "v"})
    centroids = np.random.default_rng(2).normal(size=(50, 8))
    found = _nearest(rows, "query_id", centroids, 8, 40)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(list") < plan.index("MapInPandas")
    counted = found.groupBy("query_id").agg(F.count_distinct("list").alias("n"), F.count("v").alias("all")).select("n", "all").distinct().collect()
    assert [(r["n"], r["all"]) for r in counted] == [(40, 40)]
