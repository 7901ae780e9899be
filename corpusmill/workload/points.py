"""Vector collections: reports, paging, search, sinks, and the whole document flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.scalars import describe_vector
from corpusmill.operators.collection import collection_stats, has_vector, knn
from corpusmill.operators.embed import embed_with
from corpusmill.operators.hybrid import hybrid_corpus, to_points
from corpusmill.operators.inverted import build_lists, probes_for, recall, search_lists
from corpusmill.plans.flow import DocumentFlow
from corpusmill.sinks.points import unit_vector, write_points
from corpusmill.session import scratch_path
from corpusmill.sources.tables import read_page, scroll, write_clustered
from corpusmill.workload.base import SQL_ORDER_RECORDS, from_table, load, named, order_records
from corpusmill.workload.documents import (
    _SQL_HTML_ELEMENTS, _SQL_TEXT_ELEMENTS, _sql_chunks, text_sizes,
)


def _points(spark, sf_dir):
    """The embeddings in the shape of points, with type and category from the label."""
    label = F.col("label")
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("vector"),
        F.struct(
            F.when(label % 3 == 0, F.lit("Title")).when(label % 3 == 1, F.lit("Table")).alias("type"),
            F.concat(F.lit("group "), label.cast("string")).alias("category"),
            F.when(label > 2, F.concat(F.lit("label "), label.cast("string")))
            .when(label == 1, F.lit(""))
            .alias("text"),
        ).alias("payload"),
    )


_SQL_POINTS = """
  SELECT vec_id AS id, embedding AS vector,
         CASE WHEN label % 3 = 0 THEN 'Title' WHEN label % 3 = 1 THEN 'Table' END AS type,
         'group ' || label AS category,
         CASE WHEN label > 2 THEN 'label ' || label WHEN label = 1 THEN '' END AS text
  FROM embeddings
"""


def _sql_collection(points: str, dim: int) -> str:
    return f"""
      WITH p AS ({points})
      SELECT 'type' AS section, coalesce(type, 'Unknown') AS key, count(*) AS n FROM p GROUP BY 2
      UNION ALL SELECT 'category', coalesce(category, 'Unknown'), count(*) FROM p GROUP BY 2
      UNION ALL SELECT 'points', 'total', count(*) FROM p
      UNION ALL SELECT 'points', 'with_text',
                count(*) FILTER (WHERE text IS NOT NULL AND text <> '') FROM p
      UNION ALL SELECT 'points', 'with_vector', count(*) FILTER (WHERE len(vector) = {dim}) FROM p"""


@named("collection_stats", _sql_collection(_SQL_POINTS, 64))
def collection_stats_(spark, sf_dir):
    return collection_stats(_points(spark, sf_dir), 64)


@named(
    "vector_check",
    """SELECT count(*) AS total, count(*) FILTER (WHERE len(embedding) = 64) AS complete
       FROM embeddings""",
)
def vector_check(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").agg(
        F.count("*").alias("total"), F.count_if(has_vector("embedding", 64)).alias("complete")
    )


@named(
    "vector_preview",
    """SELECT vec_id, printf('%.4f', embedding[1]::DOUBLE) AS first,
              printf('%.4f', embedding[2]::DOUBLE) AS second,
              printf('%.4f', embedding[-1]::DOUBLE) AS last,
              CAST(len(embedding) AS INTEGER) AS dim FROM embeddings""",
)
def vector_preview(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").select(
        "vec_id", *(c.alias(n) for n, c in describe_vector("embedding").items())
    )


@named(
    "scroll_page",
    f"""SELECT id, type, category, text FROM ({_SQL_POINTS}) WHERE id > 100 ORDER BY id LIMIT 50""",
)
def scroll_page(spark, sf_dir):
    return scroll(_points(spark, sf_dir), 50, after=100).select("id", "payload.*")


@named(
    "scroll_vectors",
    """SELECT vec_id AS id, round(embedding[1]::DOUBLE, 6) AS x FROM embeddings
       ORDER BY vec_id LIMIT 3""",
)
def scroll_vectors(spark, sf_dir):
    page = scroll(_points(spark, sf_dir), 3, with_payload=False, with_vectors=True)
    return page.select("id", F.round(F.get("vector", F.lit(0)).cast("double"), 6).alias("x"))


@named(
    "scroll_clustered",
    f"""SELECT id, type, category, text, true AS few_files FROM ({_SQL_POINTS}) WHERE id > 100 ORDER BY id LIMIT 50""",
)
def scroll_clustered(spark, sf_dir):
    """A page of points that lie in sixteen files by key, of which it reads a few."""
    path = scratch_path(spark, "clustered")
    write_clustered(_points(spark, sf_dir), path, "id", 16)
    page = read_page(spark, path, 50, 100)
    return page.select("id", "payload.*", F.lit(len(page.inputFiles()) <= 4).alias("few_files"))


# ---------------------------------------------------------------------------
# search

_SQL_RANKED = """
  SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
        FROM (SELECT q.query_id, p.vec_id AS id,
                     round(list_cosine_similarity(p.embedding::DOUBLE[], q.v), 9) AS score
              FROM embeddings p, q))
  WHERE rank <= 10
"""


@named(
    "knn_label_means",
    f"""WITH q AS (SELECT label AS query_id, list(x ORDER BY i) AS v
                   FROM (SELECT label, i, avg(x) AS x
                         FROM (SELECT label, unnest(embedding)::DOUBLE AS x,
                                      generate_subscripts(embedding, 1) AS i FROM embeddings)
                         GROUP BY 1, 2) GROUP BY 1)
        {_SQL_RANKED}""",
)
def knn_label_means(spark, sf_dir):
    embeddings = load(spark, sf_dir, "embeddings")
    # coordinates averaged one by one: bounded groups, combined in the scanning tasks
    means = (
        embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.sort_array(F.collect_list(F.struct("i", "x")))["x"].alias("vector"))
    )
    return knn(embeddings, means, 10, dim=64, key="vec_id", vector="embedding").withColumn(
        "score", F.round("score", 6)
    )


@named(
    "knn_top10",
    f"WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings) {_SQL_RANKED}",
)
def knn_top10(spark, sf_dir):
    embeddings = load(spark, sf_dir, "embeddings")
    return knn(
        embeddings, embeddings, 10, dim=64, key="vec_id", vector="embedding",
        query_key="vec_id", query_vector="embedding",
    ).withColumn("score", F.round("score", 6))


_SQL_TWENTIETH = "SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 20 = 0"


def _list_search(spark, sf_dir):
    """The points of the embeddings in lists, and a search for those whose id 20 divides."""
    embeddings = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    queries = embeddings.where("id % 20 = 0").select(F.col("id").alias("query_id"), "vector")
    index = build_lists(embeddings, 64)
    probes = probes_for(index, queries, 10, dim=64)
    return embeddings, queries, search_lists(index, queries, 10, probes=probes, dim=64)


@named(
    "knn_lists",
    f"""WITH q AS ({_SQL_TWENTIETH}), r AS ({_SQL_RANKED})
        SELECT query_id, id, score, (SELECT least(10, count(*)) FROM embeddings) AS n FROM r WHERE rank = 1""",
)
def knn_lists(spark, sf_dir):
    """The nearest point by the list search, and how many points it found for each query."""
    found = _list_search(spark, sf_dir)[2]
    counted = found.groupBy("query_id").agg(
        F.min_by(F.struct("id", "score"), "rank").alias("first"), F.count(F.lit(1)).alias("n")
    )
    return counted.select("query_id", "first.id", F.round("first.score", 6).alias("score"), "n")


@named(
    "knn_lists_recall",
    "SELECT count(*) AS queries, true AS nine_of_ten FROM embeddings WHERE vec_id % 20 = 0",
)
def knn_lists_recall(spark, sf_dir):
    """Whether the list search finds nine tenths of the ten nearest points by brute force."""
    embeddings, queries, found = _list_search(spark, sf_dir)
    exact = knn(embeddings, queries, 10, dim=64)
    return recall(found, exact).select("queries", (F.col("recall") >= 0.9).alias("nine_of_ten"))


# ---------------------------------------------------------------------------
# sinks and the document flow


@named(
    "points_sink",
    """SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
              CAST(embedding[1]::DOUBLE / sqrt(list_inner_product(
                     embedding::DOUBLE[], embedding::DOUBLE[])) AS FLOAT)::DOUBLE AS x
       FROM embeddings""",
)
def points_sink(spark, sf_dir):
    stored = from_table(spark, "points", lambda name: write_points(_points(spark, sf_dir), name, 64, parts=4, buckets=4))
    return stored.select(
        F.col("id").cast("bigint").alias("id"),
        F.size("vector").alias("dim"),
        F.get("vector", F.lit(0)).cast("double").alias("x"),
    )


@named(
    "points_sink_rerun",
    """SELECT vec_id AS id, CASE WHEN vec_id % 4 = 0 THEN 'second' ELSE 'first' END AS text
       FROM embeddings""",
)
def points_sink_rerun(spark, sf_dir):
    """A run that is repeated, and one over a part, leave one point for each id."""
    points = _points(spark, sf_dir)

    def marked(text):
        return points.withColumn("payload", F.col("payload").withField("text", F.lit(text)))

    def fill(name):
        for new in (marked("first"), marked("first"), marked("second").where("id % 4 = 0")):
            write_points(new, name, 64, parts=4, buckets=2)

    return from_table(spark, "points_rerun", fill).select(F.col("id").cast("bigint").alias("id"), "payload.text")


@named(
    "hybrid_points",
    f"""WITH texts AS (
          SELECT 'doc-' || doc_id || '-' || chunk_no AS id, text
          FROM ({_sql_chunks(_SQL_TEXT_ELEMENTS, 2048, 1500, 0)})
          UNION ALL SELECT 'rec-' || id, interaction_text FROM ({SQL_ORDER_RECORDS}))
        SELECT id, text, CAST(length(text) AS FLOAT)::DOUBLE AS x,
               text LIKE '%$%' AS money FROM texts""",
)
def hybrid_points(spark, sf_dir):
    """Documents and records as one corpus, through a model, in one collection."""
    chunks = DocumentFlow("text", content="text").chunks(load(spark, sf_dir, "documents"))
    corpus = hybrid_corpus(chunks, order_records(spark, sf_dir), key="id", text="interaction_text")
    points = to_points(embed_with(corpus, text_sizes, 2))
    stored = from_table(spark, "hybrid", lambda name: write_points(points, name, 2, normalize=False, parts=4, buckets=4))
    return stored.select(
        "id", "payload.text", F.get("vector", F.lit(0)).cast("double").alias("x"),
        F.col("payload.text").contains("$").alias("money"),
    )


@named(
    "unit_vectors",
    """SELECT vec_id, CAST(embedding[3]::DOUBLE * 2 / sqrt(4 * list_inner_product(
                      embedding::DOUBLE[], embedding::DOUBLE[])) AS FLOAT)::DOUBLE AS x
       FROM embeddings""",
)
def unit_vectors(spark, sf_dir):
    doubled = F.transform("embedding", lambda x: x * 2)
    return load(spark, sf_dir, "embeddings").select(
        "vec_id", F.get(unit_vector(doubled), F.lit(2)).cast("double").alias("x")
    )


def _flow(sf_dir):
    return DocumentFlow("html", doc_id="page_id", content="html", filename="url")


@named(
    "flow_collection_stats",
    _sql_collection(
        f"""SELECT 'Chunk' AS type, 'body' AS category, text,
                   CASE WHEN regexp_matches(text, '[\\p{{L}}\\p{{N}}]')
                        THEN range(1536) END AS vector
            FROM ({_sql_chunks(_SQL_HTML_ELEMENTS, 2048, 1500, 0)})""",
        1536,
    ),
)
def flow_collection_stats(spark, sf_dir):
    points = _flow(sf_dir).points(load(spark, sf_dir, "pages"))
    return collection_stats(points, 1536)
