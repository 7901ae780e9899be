"""Documents into ordered elements.

The column functions give an array of ``(type, category, text)`` inside the
document row, so later steps can go on without moving any text between
machines. The DataFrame functions explode it into one row per element.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.arrays import let, lookup
from corpusmill.functions.references import decode_references
from corpusmill.schemas import METADATA_TYPE, fields

# fixed values: element type by tag, category by element type
TAG_TYPES = {
    "title": "Title", "h1": "Title", "h2": "Title", "h3": "Title", "h4": "Title",
    "h5": "Title", "h6": "Title", "p": "NarrativeText", "li": "ListItem",
    "table": "Table", "img": "Image",
}
CATEGORIES = {
    "Title": "heading", "NarrativeText": "body", "ListItem": "list",
    "Table": "table", "Image": "image",
}
_TAG_CATEGORIES = {tag: CATEGORIES[kind] for tag, kind in TAG_TYPES.items()}

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_BLOCK = (
    r"(?is)<table\b[^>]*>.*?</table>|<img\b[^>]*>"
    r"|<(?:title|h[1-6]|p|li)\b[^>]*>.*?</(?:title|h[1-6]|p|li)>"
)
# opener, closer, and what an opener without a closer becomes: a tag that is no block, or a marker
_OPEN_COMMENT = "<\u0001!--"
_HIDDEN_TAGS = (
    (r"<!--", r"-->", _OPEN_COMMENT),
    (r"(?i)<script\b", r"</script>", "<x-script"),
    (r"(?i)<style\b", r"</style>", "<x-style"),
)
_BLOCK_TAGS = (
    (r"(?i)<table\b", r"</table>", "<x-table"),
    (r"(?i)<(?=(?:title|h[1-6]|p|li)\b)", r"</(?:title|h[1-6]|p|li)>", "<x-"),
)
_ALT = r"""(?is)\balt\s*=\s*["']([^"']*)["']"""
_SPACE = r"[ \t\r\n\f]+"


def _element(kind: Column, category: Column, text: Column) -> Column:
    return F.struct(kind.alias("type"), category.alias("category"), text.alias("text"))


def plain(markup: Column) -> Column:
    """The text of a piece of markup: no tags, character references decoded, single spaces."""
    text = decode_references(F.regexp_replace(markup, r"(?s)<[^>]*>", " "))
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def html_elements(html: Column | str) -> Column:
    """Titles, paragraphs, list items, tables and images of an HTML text, in order.

    A block ends at the first closing tag of any block, as pages often leave
    their own tags open. Text that stands outside of such blocks, wherever it is, is
    narrative text too, so nothing visible is lost. Scripts, styles and comments are not
    text. Elements without text are left out, images are kept.
    """
    html = F.col(html) if isinstance(html, str) else html
    shown = html
    for opener, closer, inert in _HIDDEN_TAGS:
        shown = _closed_only(shown, opener, closer, inert)
    # an opened comment that never ends stays as it was written
    shown = F.replace(F.regexp_replace(shown, _HIDDEN, " "), F.lit(_OPEN_COMMENT), F.lit("<!--"))
    for opener, closer, inert in _BLOCK_TAGS:
        shown = _closed_only(shown, opener, closer, inert)
    return let(shown, _elements_of)


def _closed_only(text: Column, opener: str, closer: str, inert: str) -> Column:
    """The text with ``inert`` for every opener that no closer follows.

    A lazy pattern would look for its end from each of these up to the end of the page. All
    that come before the last closer find one, and are consumed with what they enclose.
    """
    return let(
        text,
        lambda t: F.when(
            ~t.rlike(opener), t
        ).otherwise(
            let(
                F.length(F.regexp_extract(t, rf"(?is)^.*{closer}", 0)),
                lambda n: F.concat(
                    F.substring(t, F.lit(1), n),
                    F.regexp_replace(F.substring(t, n + 1, F.length(t)), opener, inert),
                ),
            )
        ),
    )


def _elements_of(shown: Column) -> Column:
    blocks = F.regexp_extract_all(shown, F.lit(_BLOCK), F.lit(0))
    between = F.split(shown, _BLOCK, -1)

    tagged = F.transform(
        blocks,
        lambda block: F.struct(
            F.lower(F.regexp_extract(block, r"^<([A-Za-z0-9]+)", 1)).alias("tag"),
            block.alias("block"),
        ),
    )

    def element(e: Column) -> Column:
        text = F.when(
            e["tag"] == "img", F.trim(F.regexp_extract(e["block"], _ALT, 1))
        ).otherwise(plain(e["block"]))
        return _element(lookup(TAG_TYPES, e["tag"]), lookup(_TAG_CATEGORIES, e["tag"]), text)

    # the stretch before each block, the block, ..., and the stretch after the last
    in_order = F.zip_with(
        between,
        tagged,
        lambda stretch, block: F.array(
            _element(F.lit("NarrativeText"), F.lit("body"), plain(stretch)),
            F.when(block.isNotNull(), element(block)),
        ),
    )
    return F.filter(F.flatten(in_order), lambda e: (e["text"] != "") | (e["type"] == "Image"))


def text_elements(text: Column | str) -> Column:
    """Lines of plain text or markdown as elements, in order; blank lines are left out."""
    text = F.col(text) if isinstance(text, str) else text
    lines = F.filter(
        F.transform(F.split(text, "\r?\n"), lambda line: F.trim(line)), lambda line: line != ""
    )

    def kind(line: Column) -> Column:
        return (
            F.when(line.rlike(r"^#{1,6} "), F.lit("Title"))
            .when(line.rlike(r"^(?:[-*+] |[0-9]+[.)] )"), F.lit("ListItem"))
            .when(line.rlike(r"^\|.*\|$"), F.lit("Table"))
            .when(line.rlike(r"^!\["), F.lit("Image"))
            .otherwise(F.lit("NarrativeText"))
        )

    def bare(line: Column) -> Column:
        return F.regexp_replace(line, r"^(?:#{1,6}|[-*+]|[0-9]+[.)]) +", "")

    typed = F.transform(
        lines, lambda line: F.struct(kind(line).alias("type"), bare(line).alias("text"))
    )
    return F.transform(
        F.filter(typed, lambda e: e["text"] != ""),
        lambda e: _element(e["type"], lookup(CATEGORIES, e["type"]), e["text"]),
    )


def metadata(filename: Column | str | None, filetype: Column | str | None) -> Column:
    """The metadata struct of an element; these formats have no pages."""

    def text(c):
        c = F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c
        return c.cast("string")

    return F.struct(
        text(filename).alias("filename"),
        text(filetype).alias("filetype"),
        F.lit(None).cast("int").alias("page_number"),
    ).cast(METADATA_TYPE)


def explode_elements(df: DataFrame, doc_id: str, elements: Column, meta: Column) -> DataFrame:
    """One row per element: doc_id, pos, type, category, text, metadata."""
    return df.select(
        F.col(doc_id).alias("doc_id"), meta.alias("metadata"), F.posexplode(elements)
    ).select("doc_id", "pos", "col.type", "col.category", "col.text", "metadata")


def partition_html(
    df: DataFrame, doc_id: str = "doc_id", html: str = "html", filename: str | None = None
) -> DataFrame:
    """Elements of HTML documents."""
    return explode_elements(df, doc_id, html_elements(html), metadata(filename, F.lit("html")))


def partition_text(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", filename: str | None = None
) -> DataFrame:
    """Elements of plain text or markdown documents."""
    return explode_elements(df, doc_id, text_elements(text), metadata(filename, F.lit("txt")))


def parse_with(
    df: DataFrame,
    parser: Callable[[bytes], list[tuple]],
    doc_id: str = "doc_id",
    content: str = "content",
    filename: str | None = None,
    filetype: str | Column | None = None,
) -> DataFrame:
    """One row per document with its elements from a parser of your own.

    ``parser`` takes the content of one document and returns
    ``(type, text, page_number)`` tuples. It runs in the tasks, once per
    document. Result: doc_id, filename, filetype, elements, error. A document that the
    parser fails on has NULL elements and the message in ``error``; one without
    content has no elements and no error.
    """
    described = metadata(filename, filetype)
    source = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(content).alias("content"),
        described["filename"].alias("filename"),
        described["filetype"].alias("filetype"),
    )
    parsed = fields(type="string", text="string", page_number="integer")
    out = fields(
        doc_id=source.schema["doc_id"].dataType, filename="string", filetype="string",
        elements=T.ArrayType(parsed), error="string",
    )

    def parse(content):
        if content is None:
            return [], None
        try:
            return [dict(zip(("type", "text", "page_number"), e)) for e in parser(content)], None
        except Exception as failure:
            return None, f"{type(failure).__name__}: {failure}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [parse(c) for c in batch["content"]]
            yield batch[["doc_id", "filename", "filetype"]].assign(
                elements=[f[0] for f in found], error=[f[1] for f in found]
            )

    return source.mapInPandas(run, out)


def with_error_elements(parsed: DataFrame) -> DataFrame:
    """The result of :func:`parse_with`, with one element of type ``Error`` for each failed document."""
    message = F.array(
        F.struct(
            F.lit("Error").alias("type"), F.col("error").alias("text"), F.lit(None).cast("int").alias("page_number")
        )
    )
    return parsed.withColumn("elements", F.coalesce("elements", message))


def partition_with(
    df: DataFrame,
    parser: Callable[[bytes], list[tuple]],
    doc_id: str = "doc_id",
    content: str = "content",
    filename: str | None = None,
    filetype: str | Column | None = None,
) -> DataFrame:
    """Elements by a parser of your own, for formats such as PDF; see :func:`parse_with`.

    A document that the parser fails on gives one element of type and category ``Error`` and
    ``error``, with the message as its text.
    """
    parsed = with_error_elements(parse_with(df, parser, doc_id, content, filename, filetype))
    return parsed.select(
        "doc_id", "filename", "filetype", F.posexplode("elements").alias("pos", "e")
    ).select(
        "doc_id",
        "pos",
        "e.type",
        F.when(F.col("e.type") == "Error", "error")
        .otherwise(F.coalesce(lookup(CATEGORIES, F.col("e.type")), F.lit("body")))
        .alias("category"),
        "e.text",
        F.struct("filename", "filetype", "e.page_number").cast(METADATA_TYPE).alias("metadata"),
    )
