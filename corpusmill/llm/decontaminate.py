"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k is cut into k + 1 pieces. If a text holds the item with at most k edits,
at least one piece is in it unchanged. One automaton finds all pieces of a block of items in one pass
over a text; each hit names the place where the item would lie, and Myers' bit-parallel
distance decides there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import blocks, kept_rows

CHARS_PER_ERROR = 14  # of an item: one edit in so many characters may differ
LEAST_ITEM = 24  # characters; a shorter item must be found unchanged
ITEM_BLOCK = 1 << 20  # characters of items that a task holds at once


def normal(text: str) -> str:
    """Lower case, with single spaces."""
    return " ".join(text.lower().split())


def budget(item: str, chars_per_error: int = CHARS_PER_ERROR) -> int:
    return 0 if len(item) < LEAST_ITEM else len(item) // chars_per_error


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of about equal length, with their offsets."""
    n = errors + 1
    cuts = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and the end of the first such part.

    Myers' algorithm: the columns of the distance table as two bit vectors, one step for each character.
    """
    m = len(item)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = at.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        hp = minus | ~(xh | plus) & full
        hm = plus & xh
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp = hp << 1 & full
        hm = hm << 1 & full
        plus = hm | ~(xv | hp) & full
        minus = hp & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int):
        import ahocorasick

        self.items = [(i, t, budget(t, chars_per_error)) for i, t in items]
        places = defaultdict(list)
        for n, (_, t, k) in enumerate(self.items):
            for offset, piece in pieces(t, k):
                places[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """Per item within its budget: least distance, and the end of the first part that has it."""
        starts = defaultdict(set)
        for end, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                starts[n].add(end + 1 - length - offset)
        found = {}
        for n, begins in starts.items():
            _, item, k = self.items[n]
            best = None
            reach = -1
            group = []
            # one window for begins that lie within the budget of each other
            for b in [*sorted(begins), None]:
                if group and (b is None or b > reach + 2 * k):
                    low = max(0, group[0] - k)
                    d, e = best_match(item, text[low : group[-1] + len(item) + k])
                    if d <= k and (best is None or d < best[0]):
                        best = d, low + e
                    group = []
                if b is not None:
                    group.append(b)
                    reach = b
            if best:
                found[n] = best
        return found


def matches(docs: DataFrame, items: DataFrame, chars_per_error: int = CHARS_PER_ERROR, id_col: str = "doc_id",
            text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``distance``, ``budget`` and ``end`` for every item that a row contains.

    Texts and items are compared in lower case with single spaces; ``end`` counts in that form. The
    items are the stated query set: they come to the driver in blocks of bounded size, and each block
    meets all documents in one pass without a shuffle. Null and empty items are in nothing, null
    texts contain nothing; repeated rows and items are reported as often as they come.
    """
    found = None
    for block in item_blocks(items, item_id, item_text):
        part = _scan(docs, block, chars_per_error, id_col, text_col, items.schema[item_id].dataType.simpleString())
        found = part if found is None else found.unionByName(part)
    if found is None:
        return _scan(docs.limit(0), [], chars_per_error, id_col, text_col, items.schema[item_id].dataType.simpleString())
    return found


def item_blocks(items: DataFrame, item_id: str = "item_id", item_text: str = "text") -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.select(item_id, item_text).orderBy(item_id).toLocalIterator():
        text = normal(row[1] or "")
        if not text:
            continue
        block.append((row[0], text))
        size += len(text)
        if size >= ITEM_BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _scan(docs: DataFrame, block: list[tuple], chars_per_error: int, id_col: str, text_col: str, item_type: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_type}, distance int, budget int, end bigint"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.select("doc_id", F.lit(None).cast(item_type).alias("item_id")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(out)]
        matcher = Matcher(block, chars_per_error) if block else None
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                at, hits = [], []
                for i, text in enumerate(texts):
                    for n, (d, e) in (matcher.find(normal(text)) if matcher else {}).items():
                        at.append(i)
                        hits.append((block[n][0], d, matcher.items[n][2], e))
                columns = list(zip(*hits)) if hits else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], types[1]),
                     pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
                    names=["doc_id", "item_id", "distance", "budget", "end"],
                )

    return rows.mapInArrow(run, schema)


def without_items(docs: DataFrame, items: DataFrame, chars_per_error: int = CHARS_PER_ERROR, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item; rows with a null text stay.

    Each row is judged where it is, one pass for each block of items, so nothing is joined; columns may have any names.
    """
    kept = docs
    for block in item_blocks(items):

        def make(block=block):
            matcher = Matcher(block, chars_per_error)
            return lambda texts: [not matcher.find(normal(t)) for t in texts]

        kept = kept_rows(kept, text_col, make)
    return kept
