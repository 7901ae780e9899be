"""Elements into chunks that respect titles and a size limit.

The rule: elements are joined with one line end while the open chunk is
shorter than ``new_after`` and stays within ``max_chars``; a title opens a new
chunk; a longer element is cut into pieces of ``max_chars``, each beginning
``max_chars - overlap`` after the one before.

Two forms with equal results:

* :func:`packed` works on an element array inside the document row. Nothing is
  moved between machines. This is the one to use when documents are partitioned
  by this library.
* :func:`chunk_by_title` works on a table of element rows. A document of any
  number of elements is handled in bounded groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.arrays import let
from corpusmill.schemas import fields

MAX_CHARS, NEW_AFTER, OVERLAP = 2048, 1500, 0

# A block has at most 2^13 pieces, each within ``max_chars``, so 16 million characters by default, however long the
# elements are. Positions are INTs: 2^18 stretches of 2^13 of them, so 2^9 blocks per span keep the
# groups of spans near 2^9 as well; long elements add a block for every 16 million characters.
BLOCK_ELEMENTS, SPAN_BLOCKS = 1 << 13, 1 << 9
# Documents beyond so many characters are not brought together in one row.
BLOCK_CHARS = 1 << 24
_RUN = 256  # pieces whose starts are gathered together


def _check(max_chars: int, new_after: int, overlap: int) -> None:
    if not 0 < new_after <= max_chars:
        raise ValueError("new_after must be positive and not above max_chars")
    if not 0 <= overlap < max_chars:
        raise ValueError("overlap must not be negative and must be below max_chars")


def pieces(text: Column, max_chars: int, overlap: int) -> Column:
    """A text as an array of pieces within the limit; short text is its only piece.

    The pattern walks the text once, where cutting by position would count
    characters from the start for every piece.
    """
    step = max_chars - overlap
    if overlap:
        # look ahead for a whole piece, move on by one step
        pattern, group = rf"(?s)(?=(.{{1,{max_chars}}})).{{1,{step}}}", 1
    else:
        pattern, group = rf"(?s).{{1,{max_chars}}}", 0
    n = F.floor((F.length(text) - overlap - 1) / step).cast("int") + 1
    cut = F.slice(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(1), n)
    return F.when(F.length(text) > max_chars, cut).otherwise(F.array(text))


def _all_pieces(elements: Column, max_chars: int, overlap: int) -> Column:
    """Array of (text, len, brk) for an element array; a title breaks with its first piece."""

    def of_element(e: Column) -> Column:
        brk = e["type"] == "Title"
        return F.transform(
            pieces(e["text"], max_chars, overlap),
            lambda t, i: F.struct(
                t.alias("text"), F.length(t).alias("len"), (brk & (i == 0)).alias("brk")
            ),
        )

    return F.flatten(F.transform(F.filter(elements, lambda e: e["text"] != ""), of_element))


def _starts(parts: Column, max_chars: int, new_after: int, open_chars: Column) -> Column:
    """0-based indexes of the pieces that open a chunk.

    Only lengths are folded; the text is joined afterwards from slices.
    ``open_chars`` is the length of the chunk left open before the first piece.
    """
    no_starts = F.array().cast("array<int>")

    def merge(acc: Column, p: Column) -> Column:
        grown = acc["cur"] + 1 + p["len"]
        opens = (acc["cur"] == 0) | p["brk"] | (acc["cur"] >= new_after) | (grown > max_chars)
        return F.struct(
            F.when(opens, F.array_append(acc["starts"], acc["i"]))
            .otherwise(acc["starts"])
            .alias("starts"),
            F.when(opens, p["len"]).otherwise(grown).alias("cur"),
            (acc["i"] + 1).alias("i"),
        )

    # appending copies the array, so starts are gathered by runs of pieces, and runs in turn
    def merge_run(acc: Column, first: Column) -> Column:
        open_run = F.struct(no_starts.alias("starts"), acc["cur"].alias("cur"), first.alias("i"))
        return let(
            F.aggregate(F.slice(parts, first + 1, _RUN), open_run, merge),
            lambda run: F.struct(
                F.array_append(acc["runs"], run["starts"]).alias("runs"), run["cur"].alias("cur")
            ),
        )

    zero = F.struct(
        F.array().cast("array<array<int>>").alias("runs"), open_chars.cast("int").alias("cur")
    )
    firsts = F.sequence(F.lit(0), F.size(parts), F.lit(_RUN))
    return F.aggregate(firsts, zero, merge_run, lambda acc: F.flatten(acc["runs"]))


def _join_slices(parts: Column, starts: Column) -> Column:
    """Array of (text, n_elements): the pieces from each start up to the next.

    Both arguments have to be cheap to refer to, as they are used per chunk.
    """

    def chunk(start: Column, k: Column) -> Column:
        n = F.coalesce(F.get(starts, k + 1), F.size(parts)) - start
        return F.struct(
            F.array_join(F.slice(parts, start + 1, n)["text"], "\n").alias("text"),
            n.alias("n_elements"),
        )

    return F.transform(starts, chunk)


def packed(
    elements: Column | str,
    max_chars: int = MAX_CHARS,
    new_after: int = NEW_AFTER,
    overlap: int = OVERLAP,
) -> Column:
    """An array of (text, n_elements) chunks made from an element array."""
    _check(max_chars, new_after, overlap)
    elements = F.col(elements) if isinstance(elements, str) else elements
    return let(
        _all_pieces(elements, max_chars, overlap),
        lambda parts: let(
            _starts(parts, max_chars, new_after, F.lit(0)),
            lambda starts: _join_slices(parts, starts),
        ),
    )


def explode_chunks(df: DataFrame, doc_id: str, chunks: Column, meta: Column) -> DataFrame:
    """One row per chunk: doc_id, chunk_no, text, n_chars, n_elements, metadata."""
    return df.select(
        F.col(doc_id).alias("doc_id"), meta.alias("metadata"), F.posexplode(chunks)
    ).select(
        "doc_id",
        F.col("pos").alias("chunk_no"),
        "col.text",
        F.length("col.text").alias("n_chars"),
        "col.n_elements",
        "metadata",
    )


# ---------------------------------------------------------------------------
# element rows


def chunk_by_title(
    elements: DataFrame,
    max_chars: int = MAX_CHARS,
    new_after: int = NEW_AFTER,
    overlap: int = OVERLAP,
    block_elements: int = BLOCK_ELEMENTS,
    span_blocks: int = SPAN_BLOCKS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Chunks from a stored table of element rows (doc_id, pos, type, text, metadata).

    Documents up to ``block_elements`` elements and ``block_chars`` characters are packed in one group each, after
    one shuffle. Whether any document is larger is asked beforehand, by the lengths of its texts summed up in the tasks;
    elements that are not stored would be computed once more
    for it, so write them first, or use :func:`packed`. Larger documents go through :func:`_chunk_large`.
    """
    _check(max_chars, new_after, overlap)
    source = elements.where(F.col("text") != "").select(
        "doc_id", "pos", F.struct("type", "text").alias("e"), "metadata"
    )
    sizes = elements.groupBy("doc_id").agg(F.max("pos").alias("last"), F.sum(F.length("text")).alias("chars"))
    large = sizes.where((F.col("last") >= block_elements) | (F.col("chars") > block_chars)).select("doc_id")
    if large.isEmpty():
        return _chunk_small(source, max_chars, new_after, overlap)
    return _chunk_small(
        source.join(large, "doc_id", "left_anti"), max_chars, new_after, overlap
    ).unionByName(
        _chunk_large(
            source.join(large, "doc_id", "left_semi"),
            max_chars, new_after, overlap, block_elements, span_blocks,
        )
    )


def _chunk_small(source: DataFrame, max_chars: int, new_after: int, overlap: int) -> DataFrame:
    grouped = source.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "e"))).alias("rows"),
        F.min_by("metadata", "pos").alias("metadata"),
    )
    return explode_chunks(
        grouped,
        "doc_id",
        packed(F.col("rows")["e"], max_chars, new_after, overlap),
        F.col("metadata"),
    )


def _block_map(
    lens: np.ndarray, brks: np.ndarray, max_chars: int, new_after: int
) -> np.ndarray:
    """Length left open after a block, for every length that may be open before it."""
    states, where = np.arange(max_chars + 1), np.arange(max_chars + 1)
    for n, brk in zip(lens.tolist(), brks.tolist()):
        grown = states + 1 + n
        opens = (states == 0) | brk | (states >= new_after) | (grown > max_chars)
        # entries that have met once stay together, so the work shrinks quickly
        states, back = np.unique(np.where(opens, n, grown), return_inverse=True)
        where = back[where]
    return states[where].astype("int32")


def _in_blocks(source: DataFrame, max_chars: int, overlap: int, size: int) -> DataFrame:
    """Pieces (doc_id, pos, piece, metadata, p) with their block, in order and without gaps.

    Blocks are cut by running sums of the numbers of pieces, so one has at most ``size``. The sums run over numbers
    alone: inside stretches of ``size`` positions, and then over the stretches of a document.
    """
    step = max_chars - overlap
    stretch = F.floor(F.col("pos") / size).cast("int").alias("stretch")
    long = F.length("e.text") > max_chars
    n = F.when(long, F.floor((F.length("e.text") - overlap - 1) / step).cast("bigint") + 1).otherwise(F.lit(1).cast("bigint"))
    inside = Window.partitionBy("doc_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    numbered = source.select("doc_id", "pos", stretch, n.alias("n")).withColumn("first", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    along = Window.partitionBy("doc_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("doc_id", "stretch").agg(F.ceil(F.max(F.col("first") + F.col("n")) / size).alias("blocks"))
        .withColumn("start", F.coalesce(F.sum("blocks").over(along), F.lit(0)))
    )
    placed = numbered.join(starts, ["doc_id", "stretch"]).select("doc_id", "pos", "first", "start")
    cut = source.join(placed, ["doc_id", "pos"]).select(
        "doc_id", "pos", "metadata", "first", "start", F.posexplode(_all_pieces(F.array("e"), max_chars, overlap)).alias("piece", "p")
    )
    block = (F.col("start") + F.floor((F.col("first") + F.col("piece")) / size)).cast("int")
    return cut.select("doc_id", "pos", "metadata", "piece", "p", block.alias("block"))


def _chunk_large(
    source: DataFrame,
    max_chars: int,
    new_after: int,
    overlap: int,
    block_elements: int,
    span_blocks: int,
) -> DataFrame:
    """Packs documents block by block.

    Whether a piece opens a chunk depends on everything before it, but only
    through one number, the length of the open chunk. Each block is reduced to
    a map from that number before to that number after; the maps are chained,
    first within spans of blocks, then over the spans of a document. That
    gives the entry length of every block, and all blocks are then packed
    independently. Chunks that cross a block border are joined at the end.
    """
    id_type = source.schema["doc_id"].dataType
    parts = _in_blocks(source, max_chars, overlap, block_elements)

    def ids(**types: str) -> T.StructType:
        return fields(doc_id=id_type, **types)

    def to_map(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["pos", "piece"])
        reached = _block_map(
            group["len"].to_numpy(), group["brk"].to_numpy(), max_chars, new_after
        )
        return group.iloc[[0]][["doc_id", "block"]].assign(reached=[reached.tobytes()])

    maps = (
        parts.select("doc_id", "block", "pos", "piece", "p.len", "p.brk")
        .groupBy("doc_id", "block")
        .applyInPandas(to_map, ids(block="integer", reached="binary"))
        .withColumn("span", F.floor(F.col("block") / span_blocks).cast("int"))
    )

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        reached = np.arange(max_chars + 1)
        for raw in group.sort_values("block")["reached"]:
            reached = np.frombuffer(raw, "int32")[reached]
        return group.iloc[[0]][["doc_id", "span"]].assign(
            reached=[reached.astype("int32").tobytes()]
        )

    def span_entries(group: pd.DataFrame) -> pd.DataFrame:
        group, state, entries = group.sort_values("span"), 0, []
        for raw in group["reached"]:
            entries.append(state)
            state = int(np.frombuffer(raw, "int32")[state])
        return group[["doc_id", "span"]].assign(entry=entries)

    spans = (
        maps.groupBy("doc_id", "span")
        .applyInPandas(chain, ids(span="integer", reached="binary"))
        .groupBy("doc_id")
        .applyInPandas(span_entries, ids(span="integer", entry="integer"))
    )

    def block_entries(blocks: pd.DataFrame, span: pd.DataFrame) -> pd.DataFrame:
        blocks, state, entries = blocks.sort_values("block"), int(span["entry"].iloc[0]), []
        for raw in blocks["reached"]:
            entries.append(state)
            state = int(np.frombuffer(raw, "int32")[state])
        return blocks[["doc_id", "block"]].assign(entry=entries)

    entries = (
        maps.groupBy("doc_id", "span")
        .cogroup(spans.groupBy("doc_id", "span"))
        .applyInPandas(block_entries, ids(block="integer", entry="integer"))
    )

    blocks = (
        parts.join(entries, ["doc_id", "block"])
        .groupBy("doc_id", "block")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "piece", "p")))["p"].alias("parts"),
            F.min("entry").alias("entry"),
            F.min_by("metadata", "pos").alias("metadata"),
        )
        # through an array of one, so that the starts are found once per block
        .withColumn(
            "starts",
            F.explode(
                F.array(_starts(F.col("parts"), max_chars, new_after, F.col("entry")))
            ),
        )
        .withColumn("opened", F.size("starts"))
    )
    # blocks of one document, at most 2^18 rows of two numbers
    numbered = blocks.select("doc_id", "block", "opened").withColumn(
        "before",
        F.expr(
            "sum(opened) OVER (PARTITION BY doc_id ORDER BY block "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ),
    )
    # index 0 as an extra start when the block begins inside an open chunk
    inside = F.coalesce(F.get("starts", F.lit(0)) != 0, F.lit(True))
    cut = (
        blocks.join(numbered.select("doc_id", "block", "before"), ["doc_id", "block"])
        .withColumn("inside", inside)
        .select(
            "doc_id",
            "block",
            "metadata",
            (F.coalesce("before", F.lit(0)) - F.col("inside").cast("int")).alias("base"),
            F.posexplode(
                let(
                    F.when(F.col("inside"), F.array_prepend("starts", 0)).otherwise(
                        F.col("starts")
                    ),
                    lambda bounds: _join_slices(F.col("parts"), bounds),
                )
            ).alias("k", "c"),
        )
        .withColumn("chunk_no", (F.col("base") + F.col("k")).cast("int"))
    )
    # a chunk holds at most max_chars characters, so this group is bounded
    joined = cut.groupBy("doc_id", "chunk_no").agg(
        F.array_join(
            F.sort_array(F.collect_list(F.struct("block", "c")))["c"]["text"], "\n"
        ).alias("text"),
        F.sum("c.n_elements").cast("int").alias("n_elements"),
        F.min_by("metadata", "block").alias("metadata"),
    )
    return joined.select(
        "doc_id", "chunk_no", "text", F.length("text").alias("n_chars"), "n_elements", "metadata"
    )
