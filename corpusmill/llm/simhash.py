"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into blocks by population count and hash. Two fingerprints within
the radius differ in population count by no more than it, so only blocks of near counts meet, and
inside them only tiles whose upper halves have near counts too. Tiles are compared with exclusive-or
and bit counts; what leaves a task is a spanning forest of the links, never the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import each_block, staged

SEED = 42
SHINGLE = 4
RADIUS = 4
BLOCK = 16_384  # fingerprints in a block, about
_ROWS, _COLUMNS = 128, 2048  # of a tile


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, each the majority of that bit over the hashes of all word shingles; ties are 0."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends)]
    hashes = [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[min(shingle, len(words)) - 1 :])]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, hash ``h`` of the text and the fingerprint ``print`` as a signed 64-bit integer; a null text has no words."""

    def make() -> Callable[[list[str]], dict[str, pa.Array]]:
        return lambda texts: {"print": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64).tolist()}

    rows = docs.select(F.col(id_col).alias("doc_id"), _content(F.col(text_col)).alias("h"), F.col(text_col).alias("_text"))
    return each_block(rows, "_text", make, "print bigint")


def _content(text: Column) -> Column:
    """What tells the texts of one id apart; null and empty differ."""
    return F.xxhash64(text, text.isNull())


class Forest:
    """Components of numbered nodes, joined by arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def forest_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (other, root) that connect what lies within the radius, of two blocks or of one.

    All fingerprints of a block have one population count. The blocks are sorted by the count of
    the upper half, and a row tile meets only the stretch of columns that the bound allows.
    """

    def ordered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upper = np.bitwise_count(x >> np.uint64(32)).astype(np.int64)
        at = np.argsort(upper, kind="stable")
        return x[at], upper[at]

    a, a_upper = ordered(left)
    b, b_upper = (a, a_upper) if right is None else ordered(right)
    shift = len(a) if right is not None else 0
    forest = Forest(len(a) + (len(b) if shift else 0))
    extra = int(np.bitwise_count(b[0])) - int(np.bitwise_count(a[0])) if len(a) and len(b) else 0
    # |x| + |extra - x| <= radius for the difference x of the upper counts
    low, high = -((radius - extra) // 2), (radius + extra) // 2
    for r in range(0, len(a), _ROWS):
        rows = a[r : r + _ROWS]
        begin = np.searchsorted(b_upper, a_upper[r] + low, "left")
        end = np.searchsorted(b_upper, a_upper[min(r + _ROWS, len(a)) - 1] + high, "right")
        if not shift:
            begin = max(begin, r)
        for c in range(begin, end, _COLUMNS):
            columns = b[c : min(c + _COLUMNS, end)]
            near = np.bitwise_count(rows[:, None] ^ columns[None, :]) <= radius
            if near.any():
                i, j = np.nonzero(near)
                i, j = i + r, j + c + shift
                other = i != j
                if other.any():
                    forest.join(i[other], j[other])
    nodes = np.concatenate([a, b]) if shift else a
    member = np.flatnonzero(forest.root != np.arange(len(nodes)))
    return nodes[member], nodes[forest.root[member]]


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``print`` whose components are those of all pairs in reach.

    Blocks are bounded whatever the number of fingerprints of one population count; pairs of blocks
    are dealt over all tasks. The sizes of the 65 population counts are all that the driver sees.
    """
    counted = prints.select("print", F.bit_count("print").alias("p"))
    sizes = {r["p"]: -(-r["n"] // block) for r in counted.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_blocks = F.array(*(F.lit(sizes.get(p, 0)) for p in range(65)))
    blocks = counted.groupBy(
        "p", F.pmod(F.xxhash64("print"), F.element_at(n_blocks, F.col("p") + 1)).cast("int").alias("i")
    ).agg(F.collect_list("print").alias("prints"))
    # a block takes part in pairs (p, i) <= (q, j) as the first and as the second
    def named(span: Column, count: Column) -> Column:
        return F.transform(span, lambda j: F.struct(count.alias("q"), j.alias("j")))

    def partners(first: bool):
        arrays = []
        for d in range(radius + 1):
            other = F.col("p") + (d if first else -d)
            n = F.coalesce(F.get(n_blocks, other), F.lit(0))
            if d == 0:
                span = F.sequence(F.col("i"), n - 1) if first else F.when(F.col("i") > 0, F.sequence(F.lit(0), F.col("i") - 1))
            else:
                span = F.when(n > 0, F.sequence(F.lit(0), n - 1))
            arrays.append(named(F.coalesce(span, F.array().cast("array<int>")), other))
        return F.flatten(F.array(*arrays))

    def key(first: bool):
        own, other = F.struct(F.col("p").alias("q"), F.col("i").alias("j")), F.col("o")
        a, b = (own, other) if first else (other, own)
        return F.struct(a.alias("a"), b.alias("b")).alias("pair")

    sides = [
        blocks.select("p", "i", "prints", F.explode(partners(first)).alias("o")).select(
            key(first), F.struct(F.lit(0 if first else 1).alias("side"), "prints").alias("block")
        )
        for first in (True, False)
    ]
    pairs = sides[0].unionByName(sides[1]).groupBy("pair").agg(F.sort_array(F.collect_list("block")).alias("blocks"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                parts = [np.asarray(b["prints"].values.to_numpy()).view(np.uint64) for b in row]
                u, v = forest_links(parts[0], parts[1] if len(parts) > 1 else None, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return pairs.select("blocks").mapInArrow(compare, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``, root the smallest of its component.

    Alternates the large-star and small-star operations: every node's larger, then smaller neighbours are
    linked to its smallest one, until nothing changes. Each round shuffles the edges by
    node, combines them before, and is written to the shared folder.
    """

    def stars(e: DataFrame) -> DataFrame:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(least.select("u", F.col("m").alias("v"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = staged(edges, "edges")
    seen = mark(edges)
    while seen[0]:
        edges = staged(stars(edges), "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _rooted(docs: DataFrame, radius: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and ``(print, least, root)`` of the distinct ones, root naming the component."""
    prints = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    # of the rows of a fingerprint the one of least id; rows without an id come last
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("least")
    distinct = staged(prints.groupBy("print").agg(least), "distinct_prints")
    roots = components(links(distinct.select("print"), radius))
    rooted = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    return prints, rooted


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    The component is the smallest id reachable over links of at most ``radius`` differing bits. Texts without
    words (null ones too) have fingerprint zero and link like any other. Equal fingerprints are
    combined before anything is compared, so copies, however many, cost one fingerprint. A null id
    takes part in links; its component is null only if no member of it has an id.
    """
    prints, rooted = _rooted(docs, radius, id_col, text_col)
    smallest = rooted.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("print").alias("_print"), "component_id")
    return prints.join(named, F.col("print") == F.col("_print")).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, that of the smallest id.

    Texts without words are copies of each other. Among different texts of one id the one of least
    hash stays; of rows that repeat id and text any one. Rows without an id come last: one of them
    stays only where the component has no id at all. Columns may have any names.
    """
    prints, rooted = _rooted(docs, radius, id_col, text_col)
    chosen = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.h")
    times = prints.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    chosen = staged(
        chosen.alias("c").join(times.alias("t"), F.expr("c.h = t.h AND c.doc_id <=> t.doc_id")).selectExpr("c.doc_id", "c.h", "n"),
        "chosen",
    )
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")).select(
        "row", F.col("row")[id_col].alias("doc_id"), _content(F.col("row")[text_col]).alias("h")
    )

    def those(keys: DataFrame) -> DataFrame:
        return rows.alias("r").join(keys.alias("k"), F.expr("r.h = k.h AND r.doc_id <=> k.doc_id"), "left_semi")

    # only rows whose id and text are repeated have to be told apart, so no other text is sorted
    kept = those(chosen.filter("n = 1")).unionByName(those(chosen.filter("n > 1")).dropDuplicates(["doc_id", "h"]))
    return kept.select(*(F.col("row")[c].alias(c) for c in names))
