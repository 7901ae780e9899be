"""Nearest points through inverted lists: a coarse quantizer, points by list, exact scores inside the probed lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.collection import MATRIX_ENTRIES, _best_of, _top, _unit_rows, has_vector, knn

SAMPLE_BYTES = 32 * 1024 * 1024  # of vectors that the centroids are learnt from, at most
MOST_LISTS = 4096
LIST = "list"


@dataclass(frozen=True)
class ListIndex:
    """Centroids, and the points ``(id, v, list)`` by the list of the nearest one."""

    centroids: np.ndarray
    points: DataFrame

    @property
    def lists(self) -> int:
        return len(self.centroids)


def fit_centroids(points: DataFrame, dim: int, lists: int, *, key: str = "id", vector: str = "vector",
                  sample_bytes: int = SAMPLE_BYTES, iterations: int = 12, seed: int = 7) -> np.ndarray:
    """Directions of ``lists`` clusters, by k-means with the cosine distance.

    They are learnt from the vectors of least hash of their ids, as many as ``sample_bytes`` hold; a direction found from
    a sample serves all points, as each is put to the nearest one whichever that is. Rows without a full vector, and
    zero vectors, are left out.
    """
    v = F.col(vector).cast("array<double>")
    whole = has_vector(vector, dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & F.exists(v, lambda x: x != 0)
    rows = points.where(whole).select(F.col(key).alias("id"), v.alias("v")).orderBy(F.xxhash64(key), key)
    sample = rows.limit(max(lists, sample_bytes // (8 * dim))).select(array_to_vector("v").alias("features")).cache()
    try:
        n = sample.count()
        if not n:
            return np.zeros((0, dim))
        fitted = KMeans(k=min(lists, n), distanceMeasure="cosine", maxIter=iterations, seed=seed, initSteps=2).fit(sample)
    finally:
        sample.unpersist()
    centers = np.array([c for c in fitted.clusterCenters()]).reshape(-1, dim)
    norms = np.linalg.norm(centers, axis=1, keepdims=True)
    return (centers / np.where(norms == 0, 1, norms)).reshape(-1, dim)


def _nearest(rows: DataFrame, key: str, centroids: np.ndarray, dim: int, n: int) -> DataFrame:
    """``(key, v, list)`` for the ``n`` nearest centroids of each row with a full vector.

    A vector leaves Python once, with the numbers of its lists; it is repeated for each of them outside.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(centroids)  # lists x dim doubles, both bounded by parameters
    out = T.StructType([*rows.schema.fields, T.StructField(LIST, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        directions = shipped.value
        step = max(1, MATRIX_ENTRIES // max(1, len(directions), dim))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                m = np.array(part["v"].tolist(), dtype="float64").reshape(-1, dim)
                full = ~np.isnan(m).any(axis=1)
                part, scores = part[full], m[full] @ directions.T
                few = min(n, len(directions))
                if few < len(directions):
                    found = np.argpartition(-scores, few - 1, axis=1)[:, :few]
                else:
                    found = np.broadcast_to(np.arange(few), scores.shape)
                if few == 1:  # of equally near ones the first, whatever the batch
                    found = scores.argmax(axis=1)[:, None]
                yield part.assign(**{LIST: list(found.astype("int32"))})

    return rows.mapInPandas(run, out).withColumn(LIST, F.explode(LIST))


def build_lists(points: DataFrame, dim: int, lists: int | None = None, *, key: str = "id", vector: str = "vector",
                sample_bytes: int = SAMPLE_BYTES) -> ListIndex:
    """Every point with a full vector in the list of its nearest centroid; by default as many lists as the root of their number."""
    rows = points.where(has_vector(vector, dim)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    lists = lists or min(MOST_LISTS, max(1, int(np.sqrt(rows.count()))))
    centroids = fit_centroids(points, dim, lists, key=key, vector=vector, sample_bytes=sample_bytes)
    if not len(centroids):
        centroids = np.zeros((1, dim))
    return ListIndex(centroids, _nearest(rows, "id", centroids, dim, 1))


def search_lists(index: ListIndex, queries: DataFrame, k: int, *, probes: int, dim: int, query_key: str = "query_id",
                 query_vector: str = "vector", block_rows: int | None = None) -> DataFrame:
    """The nearest points by cosine among those of the ``probes`` lists nearest to each query: query_id, rank, id, score.

    Scores are exact, and with as many probes as lists so is the result. Queries go to the lists they probe and points
    stay in theirs: both are shuffled by list, points once. A list beyond ``block_rows`` points is cut into blocks by the
    hash of the id, and its queries likewise, so a list that holds a third of all points is many bounded groups.
    """
    block_rows = block_rows or max(1, MATRIX_ENTRIES // dim)
    wanted = queries.where(has_vector(query_vector, dim)).select(
        F.col(query_key).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v")
    )
    probed = _nearest(wanted, "query_id", index.centroids, dim, max(1, probes))
    out = T.StructType([
        T.StructField("query_id", wanted.schema["query_id"].dataType), T.StructField("id", index.points.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    # one row for each list: into how many blocks its points and its queries are cut
    cuts = (
        index.points.groupBy(LIST).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("pbs"))
        .join(probed.groupBy(LIST).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("qbs")), LIST)
    )

    def blocked(rows: DataFrame, key: str, own: str, n: str, other: str, m: str) -> DataFrame:
        # at most as many rows as lists
        named = F.broadcast(cuts.select(F.col(LIST).alias("_list"), F.col(n).alias("_own"), F.col(m).alias("_other")))
        return rows.join(named, F.col(LIST) == F.col("_list")).select(
            key, "v", LIST, F.pmod(F.xxhash64(key), F.col("_own")).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col("_other") - 1)).alias(other),
        )

    left = blocked(probed, "query_id", "qb", "qbs", "pb", "pbs")
    right = blocked(index.points, "id", "pb", "pbs", "qb", "qbs")

    def run(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        query_ids, vectors = _unit_rows(qs["query_id"], qs["v"], dim)
        ids, held = _unit_rows(ps["id"], ps["v"], dim)
        if not len(query_ids) or not len(ids):
            return pd.DataFrame({f.name: [] for f in out.fields})
        return _best_of(query_ids, vectors, ids, held, k)

    groups = (LIST, "qb", "pb")
    found = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(run, out)
    return _top(found, k)


def probes_for(index: ListIndex, queries: DataFrame, k: int, *, dim: int, target: float = 0.95, sample: int = 256,
               query_key: str = "query_id", query_vector: str = "vector") -> int:
    """How many lists a search has to look into to find ``target`` of the ``k`` nearest points.

    Learnt from at most ``sample`` queries, those of least hash: their exact neighbours are searched in all points, and
    the lists of these are numbered in the order in which the query would probe them.
    """
    few = queries.where(has_vector(query_vector, dim)).select(
        F.col(query_key).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v")
    ).orderBy(F.xxhash64(query_key), query_key).limit(sample)
    asked = {r["query_id"]: np.array(r["v"], dtype="float64") for r in few.collect()}
    exact = knn(index.points, few, k, dim=dim, vector="v", query_vector="v").select("query_id", "id")
    lists = index.points.select(F.col("id").alias("_id"), LIST)
    found = exact.join(lists, F.col("id") == F.col("_id")).select("query_id", LIST).collect()  # sample x k rows
    if not found:
        return index.lists
    order = {q: np.argsort(np.argsort(-(index.centroids @ v), kind="stable")) for q, v in asked.items()}
    ranks = np.sort([order[r["query_id"]][r[LIST]] for r in found])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]) + 1


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the queries of the exact result, and the share of its points that was found (at least as near counts as found)."""
    last = exact.groupBy(F.col("query_id").alias("_q")).agg(F.min("score").alias("_least"), F.count(F.lit(1)).alias("_n"))
    hits = found.join(last, F.col("query_id") == F.col("_q")).where(F.col("score") >= F.col("_least"))
    per_query = hits.groupBy("_q").agg(F.count(F.lit(1)).alias("hits"))
    return last.join(per_query, "_q", "left").agg(
        F.count(F.lit(1)).alias("queries"),
        (F.sum(F.least(F.coalesce("hits", F.lit(0)), F.col("_n"))) / F.sum("_n")).alias("recall"),
    )
