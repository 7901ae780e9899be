"""Reports on and searches in a collection of vector points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.predicates import has_text

# Query vectors up to this many bytes go to every executor; more take the
# block form.
BROADCAST_BYTES = 16 * 1024 * 1024
# Most entries of one score matrix, and of one block of vectors
MATRIX_ENTRIES = 2 * 1024 * 1024
# Scores equal to this many decimals are ties, decided by id
SCORE_DECIMALS = 9


def has_vector(vector: Column | str, dim: int) -> Column:
    """The point carries a vector of the declared dimension."""
    return F.coalesce(F.size(vector) == dim, F.lit(False))


def collection_stats(
    points: DataFrame,
    dim: int | None = None,
    *,
    type: str = "payload.type",
    category: str = "payload.category",
    text: str = "payload.text",
    vector: str = "vector",
    key: str = "id",
) -> DataFrame:
    """Points by type and by category, and totals: section, key, n.

    The totals (section ``points``) are ``total``, ``with_text`` and, when the
    dimension is given, ``with_vector``; without it the vectors, by far the
    largest column, are not read. All come from one scan and one shuffle.
    """
    narrow = points.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(type).cast("string"), F.lit("Unknown")).alias("type"),
        F.coalesce(F.col(category).cast("string"), F.lit("Unknown")).alias("category"),
        has_text(text).alias("with_text"),
        *([has_vector(vector, dim).alias("with_vector")] if dim is not None else []),
    )
    def entry(section: str, k: Column, n: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), k.alias("key"), n.alias("n"))

    one = F.lit(1)
    entries = [
        entry("type", F.col("type"), one),
        entry("category", F.col("category"), one),
        entry("points", F.lit("total"), one),
        entry("points", F.lit("with_text"), F.col("with_text").cast("int")),
    ]
    if dim is not None:
        entries.append(entry("points", F.lit("with_vector"), F.col("with_vector").cast("int")))
    long = narrow.select(F.inline(F.array(*entries)))
    return long.groupBy("section", "key").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------------------
# nearest neighbours


def _unit_rows(ids: pd.Series, vectors: pd.Series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of unit length, in id order; vectors with gaps are left out."""
    m = np.array(vectors.tolist(), dtype="float64").reshape(-1, dim)
    ids = ids.to_numpy()
    order = np.argsort(ids, kind="stable")
    order = order[~np.isnan(m[order]).any(axis=1)]
    ids, m = ids[order], m[order]
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return ids, m / np.where(norms == 0, 1, norms)


def _best_of(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int
) -> pd.DataFrame:
    """The k best of some points for each query, by score and then by id.

    Queries are taken in slices, so that the score matrix stays small however
    many there are. At the k-th score just as many ties are kept as fit, in id
    order, so copies of one vector cannot inflate the result.
    """
    n, found = len(ids), []
    step = max(1, MATRIX_ENTRIES // max(1, n))
    for at in range(0, len(query_ids), step):
        scores = np.round(queries[at : at + step] @ points.T, SCORE_DECIMALS)
        if n > k:
            limit = np.partition(scores, n - k, axis=1)[:, [n - k]]
            above, ties = scores > limit, scores == limit
            room = k - above.sum(axis=1, keepdims=True)
            keep = above | (ties & (np.cumsum(ties, axis=1) <= room))
        else:
            keep = np.ones_like(scores, dtype=bool)
        row, col = np.nonzero(keep)
        found.append(
            pd.DataFrame(
                {
                    "query_id": query_ids[at : at + step][row],
                    "id": ids[col],
                    "score": scores[row, col],
                }
            )
        )
    return pd.concat(found, ignore_index=True)


def _merge_best(found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    rows = pd.concat(found, ignore_index=True)
    rows = rows.sort_values(["query_id", "score", "id"], ascending=[True, False, True])
    return rows.groupby("query_id", sort=False).head(k)


def unfit_vectors(df: DataFrame, dim: int, key: str = "id", vector: str = "vector") -> DataFrame:
    """The keys that a search leaves out: of a NULL vector, or one of another size or with a gap."""
    v = F.col(vector)
    gap = F.exists(v, lambda x: x.isNull() | F.isnan(x))
    return df.where(~F.coalesce(has_vector(vector, dim) & ~gap, F.lit(False))).select(key)


def knn(
    points: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    dim: int,
    key: str = "id",
    vector: str = "vector",
    query_key: str = "query_id",
    query_vector: str = "vector",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int | None = None,
) -> DataFrame:
    """Exact nearest points by cosine: query_id, rank, id, score.

    Rows that :func:`unfit_vectors` names take no part, as points or as queries.
    Scores are matrix products inside the tasks. Of all compared pairs only
    the k best per query leave a task. Query vectors whose size has been
    checked against ``broadcast_bytes`` go to every task; a larger set is
    compared block against block, with bounded blocks on both sides.
    """
    p = points.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(
        has_vector("v", dim)
    )
    q = queries.select(
        F.col(query_key).alias("query_id"), F.col(query_vector).alias("v")
    ).where(has_vector("v", dim))
    out = T.StructType(
        [
            T.StructField("query_id", q.schema["query_id"].dataType),
            T.StructField("id", p.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    allowed = max(1, broadcast_bytes // (8 * dim))
    head = q.limit(allowed + 1).toPandas()
    if head.empty:
        partial = points.sparkSession.createDataFrame([], out)
    elif len(head) <= allowed:
        partial = _against_broadcast(p, head, k, dim, out)
    else:
        partial = _against_blocks(
            p, q, k, dim, out, block_rows or max(1, MATRIX_ENTRIES // dim)
        )
    return _top(partial, k)


def _top(partial: DataFrame, k: int) -> DataFrame:
    """The k best of the partial results, in two steps so that no query is one big group."""
    best = [F.desc("score"), F.asc("id")]
    salted = partial.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = salted.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id", "_salt").orderBy(*best))
    ).where(F.col("rank") <= k)
    return (
        first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _against_broadcast(
    p: DataFrame, head: pd.DataFrame, k: int, dim: int, out: T.StructType
) -> DataFrame:
    shipped = p.sparkSession.sparkContext.broadcast(
        _unit_rows(head["query_id"], head["v"], dim)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, queries = shipped.value
        best: list[pd.DataFrame] = []
        for batch in batches:
            ids, vectors = _unit_rows(batch["id"], batch["v"], dim)
            if len(ids):
                best.append(_best_of(query_ids, queries, ids, vectors, k))
                best = [_merge_best(best, k)]
        yield from best

    return p.mapInPandas(run, out)


def _against_blocks(
    p: DataFrame, q: DataFrame, k: int, dim: int, out: T.StructType, block_rows: int
) -> DataFrame:
    """Every block of queries meets every block of points in a group of its own.

    Blocks are set by the hash of the id, so their sizes are even; the numbers
    of blocks follow from the row counts.
    """
    p_blocks = -(-p.count() // block_rows) or 1
    q_blocks = -(-q.count() // block_rows) or 1

    def blocked(df: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        )

    left = blocked(q, "query_id", "qb", q_blocks, "pb", p_blocks)
    right = blocked(p, "id", "pb", p_blocks, "qb", q_blocks)

    def run(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        query_ids, queries = _unit_rows(qs["query_id"], qs["v"], dim)
        ids, vectors = _unit_rows(ps["id"], ps["v"], dim)
        if not len(query_ids) or not len(ids):
            return pd.DataFrame({f.name: [] for f in out.fields})
        return _best_of(query_ids, queries, ids, vectors, k)

    return left.groupBy("qb", "pb").cogroup(right.groupBy("qb", "pb")).applyInPandas(run, out)
