"""Documents and records in one corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.schemas import METADATA_TYPE


def document_items(chunks: DataFrame) -> DataFrame:
    """Chunks in the shape of the corpus: id, origin, type, category, text, metadata."""
    return chunks.select(
        F.concat_ws("-", F.lit("doc"), "doc_id", "chunk_no").alias("id"),
        F.lit("document").alias("origin"),
        F.lit("Chunk").alias("type"),
        F.lit("body").alias("category"),
        "text",
        "metadata",
    )


def record_items(
    records: DataFrame, key: str = "id", text: str = "text", category: str | Column = "record"
) -> DataFrame:
    """Records in the shape of the corpus; their other fields go along as extra columns."""
    own = {key, text, "id", "origin", "type", "category", "text", "metadata"}
    kind = F.lit(category) if isinstance(category, str) else category
    return records.select(
        F.concat_ws("-", F.lit("rec"), F.col(key)).alias("id"),
        F.lit("record").alias("origin"),
        F.lit("Record").alias("type"),
        kind.alias("category"),
        F.col(text).alias("text"),
        F.lit(None).cast(METADATA_TYPE).alias("metadata"),
        *(F.col(c) for c in records.columns if c not in own),
    )


def hybrid_corpus(chunks: DataFrame, records: DataFrame, **record_options) -> DataFrame:
    """The union of both; a field only records have is NULL for documents."""
    return document_items(chunks).unionByName(
        record_items(records, **record_options), allowMissingColumns=True
    )


def to_points(items: DataFrame, vector: str = "vector") -> DataFrame:
    """Corpus items with a vector as points: id, vector, payload."""
    return items.select(
        "id",
        F.col(vector).alias("vector"),
        F.struct("type", "category", "text", "metadata").alias("payload"),
    )
