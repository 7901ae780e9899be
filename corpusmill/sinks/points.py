"""Collections of vector points as keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let
from corpusmill.schemas import POINT_SCHEMA
from corpusmill.sinks.tables import Load, create_table, read_table, upsert_table

METRIC = "cosine"


def _described(vector: Column, dim: int) -> Column:
    return vector.alias("vector", metadata={"dim": dim, "metric": METRIC})


def collection_dim(spark: SparkSession, name: str) -> int | None:
    """The dimension a collection was declared with, or None where there is none."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.table(name).schema["vector"].metadata.get("dim")


def ensure_collection(spark: SparkSession, name: str, dim: int = 1536, parts: int = 16, buckets: int = 16) -> None:
    """Creates an empty collection, or checks the dimension of the one that exists."""
    found = collection_dim(spark, name)
    if found is not None:
        if found != dim:
            raise ValueError(f"the collection has dimension {found}, not {dim}")
        return
    empty = spark.createDataFrame([], POINT_SCHEMA)
    create_table(spark, name, empty.select("id", _described(F.col("vector"), dim), "payload").schema, "id", parts, buckets)


def unit_vector(vector: Column | str) -> Column:
    """The vector scaled to length 1; a zero vector stays as it is."""
    v = F.col(vector) if isinstance(vector, str) else vector
    square = F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return let(
        F.sqrt(square),
        lambda norm: F.when(
            norm > 0, F.transform(v, lambda x: (x / norm).cast("float"))
        ).otherwise(v),
    )


def checked_points(points: DataFrame, dim: int, *, normalize: bool = True) -> DataFrame:
    """Points whose vectors have the declared dimension; another one fails the job."""
    v = F.col("vector")
    scaled = unit_vector(v) if normalize else v
    complaint = F.concat(
        F.lit(f"a vector of dimension {dim} is needed, point "), F.col("id").cast("string")
    )
    fits = F.coalesce(F.size(v) == dim, F.lit(False))
    return points.withColumn("vector", F.when(fits, scaled).otherwise(F.raise_error(complaint)))


def write_points(
    points: DataFrame,
    name: str,
    dim: int = 1536,
    *,
    batch_size: int = 0,
    normalize: bool = True,
    parts: int = 16,
    buckets: int = 16,
) -> Load:
    """Writes points to a collection by id: a point replaces the one with its id.

    So the same run twice leaves the same points. Of equal ids within one call, one stays, chosen by
    content. ``batch_size`` bounds the rows of one file. Vectors are scaled once here, so that
    a search needs only products. The result says how many points were new and how many replaced one.
    """
    spark = points.sparkSession
    ensure_collection(spark, name, dim, parts, buckets)
    fitted = checked_points(points, dim, normalize=normalize).select(
        F.col("id").cast("string").alias("id"),
        _described(F.col("vector").cast("array<float>"), dim),
        "payload",
    )
    return upsert_table(spark, name, fitted, "id", None, parts=parts, buckets=buckets, max_records_per_file=batch_size)


def read_points(spark: SparkSession, name: str) -> DataFrame:
    """The points of a collection, with the payload fields of all writes."""
    return read_table(spark, name)
