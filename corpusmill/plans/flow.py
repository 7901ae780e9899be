"""Partition, chunk and embed composed into one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let
from corpusmill.operators.aggregates import stage_rows
from corpusmill.operators.chunk import MAX_CHARS, NEW_AFTER, OVERLAP, explode_chunks, packed
from corpusmill.operators.clean import strip_inline_images
from corpusmill.operators.embed import DIM, embed_hashed, embed_with
from corpusmill.operators.hybrid import document_items, to_points
from corpusmill.operators.partition import (
    explode_elements, html_elements, metadata, parse_with, partition_with, text_elements,
    with_error_elements,
)
from corpusmill.sinks.points import write_points
from corpusmill.sinks.tables import Load


@dataclass(frozen=True)
class DocumentFlow:
    """Documents to points: partition, then chunk, then embed.

    ``source`` is ``html``, ``text`` or a parser for :func:`parse_with`. A
    document stays in its row from the scan to its chunks and vectors, and the
    whole flow needs no shuffle.
    """

    source: str | Callable[[bytes], list[tuple]] = "html"
    doc_id: str = "doc_id"
    content: str = "content"
    filename: str | None = None
    max_chars: int = MAX_CHARS
    new_after: int = NEW_AFTER
    overlap: int = OVERLAP
    dim: int = DIM
    strip_images: bool = False
    model: Callable[[list[str]], list] | None = None

    def _cleaned(self, documents: DataFrame) -> DataFrame:
        return strip_inline_images(documents, self.content) if self.strip_images else documents

    def _array(self) -> Column:
        if self.source == "html":
            return html_elements(self.content)
        if self.source == "text":
            return text_elements(self.content)
        raise ValueError(f"source must be 'html', 'text' or a parser: {self.source!r}")

    def _metadata(self) -> Column:
        return metadata(self.filename, F.lit("html" if self.source == "html" else "txt"))

    def elements(self, documents: DataFrame) -> DataFrame:
        cleaned = self._cleaned(documents)
        if callable(self.source):
            return partition_with(cleaned, self.source, self.doc_id, self.content, self.filename)
        return explode_elements(cleaned, self.doc_id, self._array(), self._metadata())

    def chunks(self, documents: DataFrame) -> DataFrame:
        cleaned = self._cleaned(documents)
        if callable(self.source):
            cleaned = with_error_elements(
                parse_with(cleaned, self.source, self.doc_id, self.content, self.filename)
            )
            doc_id, elements = "doc_id", F.col("elements")
            page = F.get("elements", F.lit(0))["page_number"].alias("page_number")
            meta = F.struct("filename", "filetype", page)
        else:
            doc_id, elements, meta = self.doc_id, self._array(), self._metadata()
        chunks = packed(elements, self.max_chars, self.new_after, self.overlap)
        return explode_chunks(cleaned, doc_id, chunks, meta)

    def points(self, documents: DataFrame) -> DataFrame:
        return self.embed(document_items(self.chunks(documents)))

    def embed(self, items: DataFrame) -> DataFrame:
        """Corpus items, from documents or records, to points."""
        if self.model is None:
            return to_points(embed_hashed(items, dim=self.dim))
        return to_points(embed_with(items, self.model, self.dim))

    def summary(self, documents: DataFrame) -> DataFrame:
        """Rows and filled rows of each stage, as :func:`run_summary` has them, from one scan.

        Elements and chunks are counted in the row of their document.
        """
        if callable(self.source):
            cleaned = parse_with(self._cleaned(documents), self.source, self.doc_id, self.content, self.filename)
            elements, filled = F.col("elements"), F.col("elements").isNotNull()
        else:
            cleaned = self._cleaned(documents)
            elements, filled = self._array(), F.col(self.content).isNotNull()

        def sizes(found: Column) -> Column:
            chunks = packed(found, self.max_chars, self.new_after, self.overlap)
            return F.struct(
                F.coalesce(F.size(found), F.lit(0)).alias("elements"),
                F.coalesce(F.size(F.filter(found, lambda e: e["text"].isNotNull())), F.lit(0)).alias("elements_filled"),
                F.coalesce(F.size(chunks), F.lit(0)).alias("chunks"),
            )

        counted = cleaned.select(filled.alias("filled"), let(elements, sizes).alias("n"))
        return stage_rows(
            counted.agg(
                F.count("*").alias("documents"), F.count_if("filled").alias("documents_filled"),
                F.coalesce(F.sum("n.elements"), F.lit(0)).alias("elements"),
                F.coalesce(F.sum("n.elements_filled"), F.lit(0)).alias("elements_filled"),
                F.coalesce(F.sum("n.chunks"), F.lit(0)).alias("chunks"),
                F.coalesce(F.sum("n.chunks"), F.lit(0)).alias("chunks_filled"),
            ),
            ("documents", "elements", "chunks"),
        )

    def run(self, documents: DataFrame, name: str, *, batch_size: int = 0) -> Load:
        """Writes the points of the documents to a collection, a table of that name, each chunk under its id.

        A chunk without a token has nothing to hash; it gets the zero vector, so the collection
        holds every chunk and each text is embedded once.
        """
        return write_points(self.whole_points(documents), name, self.dim, batch_size=batch_size, normalize=False)

    def whole_points(self, documents: DataFrame) -> DataFrame:
        """The points as :meth:`run` writes them, the zero vector in place of none."""
        zero = F.array_repeat(F.lit(0.0).cast("float"), self.dim)
        return self.points(documents).withColumn("vector", F.coalesce("vector", zero))
