"""Removal of every byte that lies in a repeated string, by distributed bucket-pointer refinement.

Suffixes of all texts are put into q-gram buckets: each window of ``length`` bytes goes to the bucket of
its least-hashed q-gram, so equal windows always meet, and windows that lie next to each other share
a bucket as one *run*. Runs of equal content are combined. Buckets that hold different runs are refined
in tasks: positions start in buckets of eight bytes, and each round sorts them by their own bucket
identifier and that of the position one bucket length later, which doubles the length. A position
alone in its bucket is settled, and by that every position that points to it.

A bucket with too many different runs for one task is split before: by stretches of window
offsets, and inside each by the bytes that all windows of the stretch share. After three rounds a bucket is one
window.

Rows that repeat both id and text are one text here, and lie in a repeated string from end to end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import semi_join, staged

LENGTH = 400
GRAM = 64
GROUP = 2048  # different runs of one bucket that a task takes at once
_BLOCK = 1 << 20  # bytes hashed together; places in a block take 20 bits
_BATCH = 1 << 20  # bytes refined together
_MULTIPLIER = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93


class _Hasher:
    """Hashes of all q-grams of a byte array, by prefix sums modulo 2**64."""

    def __init__(self, gram: int):
        self.gram = gram
        self.codes = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        self.up, self.down = (self._powers(m) for m in (_MULTIPLIER, inverse))

    @staticmethod
    def _powers(m: int) -> np.ndarray:
        powers = np.full(_BLOCK + LENGTH, m, np.uint64)
        powers[0] = 1
        return np.multiply.accumulate(powers)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: n + 1 - self.gram]) * self.down[: n + 1 - self.gram]
        h ^= h >> np.uint64(29)
        h *= np.uint64(_MIX)
        return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs_of(data: bytes, ends: list[int], hasher: _Hasher, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(start, windows, offset of the anchor, key, content hash)`` for the windows of texts laid end to end."""
    from xxhash import xxh3_64_intdigest

    gram = hasher.gram
    raw = np.frombuffer(data, np.uint8)
    view = memoryview(data)
    if len(raw) < length:
        return
    h = hasher(raw)
    places = np.arange(len(h), dtype=np.uint64)
    low = np.uint64(_BLOCK * 2 - 1)
    anchor = (sliding_min((h & ~low) | places, length - gram + 1) & low).astype(np.int64)
    # windows that begin in a text and end in it
    good = np.zeros(len(anchor), bool)
    begin = 0
    for end in ends:
        good[begin : max(begin, end - length + 1)] = True
        begin = end
    first = good & np.r_[True, ~good[:-1] | (anchor[1:] != anchor[:-1])]
    last = good & np.r_[~good[1:] | (anchor[1:] != anchor[:-1]), True]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last)
    at = anchor[starts]
    for s, e, a, k in zip(starts.tolist(), stops.tolist(), at.tolist(), h[at].view(np.int64).tolist()):
        yield s, e - s + 1, a - s, k, xxh3_64_intdigest(view[s : e + length], 7)


def refine(data: bytes, starts: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """For contexts laid end to end (each ``counts`` windows long): whether each window occurs twice or more."""
    raw = np.frombuffer(data + bytes(8), np.uint8)
    grams = np.zeros(len(data), np.uint64)
    for i in range(8):
        grams = (grams << np.uint64(8)) | raw[i : i + len(data)]
    sizes = counts + length - 1
    stop = np.repeat(starts + sizes, sizes)  # end of the context of each position
    places = np.arange(len(data))
    span = min(8, length)
    if span < 8:
        grams >>= np.uint64(8 * (8 - span))
    alive = np.flatnonzero(places + span <= stop)
    bucket = np.full(len(data), -1, np.int64)

    def settle(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """New identifiers of positions ``at``; -1 where a key is alone."""
        _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        return np.where(n[inverse] > 1, inverse, -1)

    bucket[alive] = settle(alive, grams[alive])
    while span < length:
        step = min(span, length - span)
        at = np.flatnonzero((bucket >= 0) & (places + span + step <= stop))
        later = bucket[at + step]
        fresh = np.full(len(data), -1, np.int64)
        both = later >= 0
        at, later = at[both], later[both]
        fresh[at] = settle(at, bucket[at] * (len(data) + 1) + later)
        bucket, span = fresh, span + step
    window = np.repeat(starts, counts) + _within(counts)
    return bucket[window] >= 0


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, … inside each stretch of ``counts``."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher(gram)
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column(2).to_pylist()]
            pieces = []  # row, offset in its text, bytes
            for row, t in enumerate(texts):
                if len(t) >= length:
                    step = _BLOCK - length
                    for at in range(0, max(1, len(t) - length + 1), step):
                        pieces.append((row, at, t[at : at + step + length - 1]))
            while pieces:
                group, size = [], 0
                while pieces and (not group or size + len(pieces[-1][2]) <= _BLOCK):
                    group.append(pieces.pop())
                    size += len(group[-1][2])
                ends = np.cumsum([len(g[2]) for g in group])
                found = list(runs_of(b"".join(g[2] for g in group), ends.tolist(), hasher, length))
                if not found:
                    continue
                s, n, x, key, ctx = (np.array(c) for c in zip(*found))
                which = np.searchsorted(ends, s, "right")
                rows = np.array([g[0] for g in group])[which]
                shift = np.array([g[1] for g in group]) - np.r_[0, ends[:-1]]
                rows_ = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows_), hashes.take(rows_), pa.array((s + shift[which]).astype(np.int64)),
                     pa.array(n.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array(key.astype(np.int64)),
                     pa.array(np.array(ctx, np.uint64).view(np.int64))],
                    names=["doc_id", "h", "s", "n", "x", "key", "ctx"],
                )
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "h", "text").mapInArrow(
        run, f"doc_id {kind}, h bigint, s bigint, n int, x int, key bigint, ctx bigint"
    )


_CONTEXT = "doc_id {kind}, h bigint, s bigint, n int, x int, key bigint, key2 bigint, alone boolean, data binary"


def _contexts(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs, cut from their texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    per_text = wanted.groupBy("doc_id", "h").agg(F.collect_list(F.struct("s", "n", "x", "key", "alone")).alias("runs"))
    joined = docs.join(per_text.withColumnsRenamed({"doc_id": "_d", "h": "_h"}),
                       (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, size = [[] for _ in range(8)], 0
            for row, (text, runs) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                data = text.encode("utf-8", "replace")
                for r in runs:
                    piece = data[r["s"] : r["s"] + r["n"] - 1 + length]
                    for c, v in zip(columns, (row, r["s"], r["n"], r["x"], r["key"], 0, r["alone"], piece)):
                        c.append(v)
                    size += len(piece)
                if size > 1 << 24:
                    yield _context_batch(batch, columns)
                    columns, size = [[] for _ in range(8)], 0
            yield _context_batch(batch, columns)

    return joined.select("doc_id", "h", "text", "runs").mapInArrow(cut, _CONTEXT.format(kind=kind))


def _context_batch(batch: pa.RecordBatch, columns: list[list]) -> pa.RecordBatch:
    rows = pa.array(columns[0], pa.int64())
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(c, t) for c, t in zip(columns[1:], types))],
        names=["doc_id", "h", "s", "n", "x", "key", "key2", "alone", "data"],
    )


def _split(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """Contexts cut into stretches of ``width`` window offsets, keyed by the bytes all these windows share."""
    kind = contexts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            columns = [[] for _ in range(8)]
            for row, (s, n, x, k, k2, alone, data) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(2, 9)))):
                # window i of the context starts x - i before its anchor
                i = 0
                while i < n:
                    stretch = (x - i) // width
                    m = min(n - i, x - i - stretch * width + 1)
                    high, low = stretch * width + width - 1, stretch * width
                    shared = data[max(0, x - low) : x - high + length] if width > 1 else data[i : i + length]
                    digest = xxh3_128_intdigest(shared, (k ^ k2 ^ stretch) & (1 << 64) - 1)
                    a, b = (v - (1 << 64) if v >> 63 else v for v in (digest >> 64, digest & (1 << 64) - 1))
                    for c, v in zip(columns, (row, s + i, m, x - i, a, b, alone, data[i : i + m - 1 + length])):
                        c.append(v)
                    i += m
            yield _context_batch(batch, columns)

    return contexts.mapInArrow(cut, _CONTEXT.format(kind=kind))


def _refined(contexts: DataFrame, length: int) -> DataFrame:
    """``(doc_id, h, b, e)``: stretches of bytes in repeated windows, of contexts whose content is alone."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind, id_type = contexts.schema["doc_id"].dataType.simpleString(), to_arrow_type(contexts.schema["doc_id"].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if size >= _BATCH and row[5:7] != last:
                    yield _resolve(held, length, id_type)
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
                held.append(row)
                size += len(row[8])
                last = row[5:7]
        if held:
            yield _resolve(held, length, id_type)

    dealt = contexts.repartition("key", "key2").sortWithinPartitions("key", "key2")
    return dealt.mapInArrow(run, f"doc_id {kind}, h bigint, b bigint, e bigint")


def _resolve(rows: list[tuple], length: int, id_type: pa.DataType) -> pa.RecordBatch:
    data = b"".join(r[8] for r in rows)
    sizes = np.array([len(r[8]) for r in rows])
    counts = np.array([r[3] for r in rows])
    flags = refine(data, np.cumsum(sizes) - sizes, counts, length)
    cuts = np.cumsum(counts)
    out = []
    for r, begin, end in zip(rows, cuts - counts, cuts):
        if r[7]:
            out += [(r[0], r[1], r[2] + b, r[2] + e - 1 + length) for b, e in _spans(flags[begin:end])]
    columns = list(zip(*out)) if out else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", "h", "b", "e"]
    )


def _by_size(contexts: DataFrame, sizes: DataFrame, group: int, parts: int = 2000) -> tuple[DataFrame, DataFrame]:
    """The contexts of buckets of 2 to ``group`` runs, and those of larger ones, which stay where they are if they are many."""
    keys = ["key", "key2"]
    most = max(group, contexts.count() // parts)
    hot = F.broadcast(sizes.filter(F.col("m") > most).select(*keys))
    small = contexts.join(hot, keys, "left_anti").join(sizes.filter(F.col("m") <= group).select(*keys), keys, "left_semi")
    large = semi_join(contexts, sizes.filter(F.col("m") > group), keys, "m", parts)
    return small.select(*contexts.columns), large.select(*contexts.columns)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``(doc_id, h, b, e)``: byte ranges of ``docs (doc_id, h, text)`` in strings of ``length`` bytes found twice or more."""
    runs = staged(_runs(docs, length, gram), "runs")
    shared = staged(runs.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "shared_keys")
    runs = staged(semi_join(runs, shared, ["key"], "k"), "shared_runs")
    # runs of equal content: one stands for all of them
    distinct = staged(
        runs.groupBy("key", "ctx").agg(
            F.count(F.lit(1)).alias("k"), *(F.first(c).alias(c) for c in ("doc_id", "h", "s", "n", "x"))
        ),
        "distinct_runs",
    )
    copied = semi_join(runs, distinct.filter("k > 1").select("key", "ctx", "k"), ["key", "ctx"], "k").select(
        "doc_id", "h", F.col("s").alias("b"), (F.col("s") + F.col("n") - 1 + length).alias("e")
    )
    mixed = staged(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "mixed_keys")
    wanted = semi_join(distinct, mixed, ["key"], "m").select(
        "doc_id", "h", "s", "n", "x", "key", (F.col("k") == 1).alias("alone")
    )
    contexts = staged(_contexts(wanted, docs, length), "contexts")
    found = [copied]
    widths = [-(-(length - gram + 1) // 8)]
    while widths[-1] > 1:
        widths.append(-(-widths[-1] // 8))
    for width in [*widths, 0]:
        sizes = staged(contexts.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "bucket_sizes")
        if width == 0:  # buckets of one window, by 128 bits of it
            again = semi_join(contexts, sizes, ["key", "key2"], "m").filter("alone")
            found.append(again.select("doc_id", "h", F.col("s").alias("b"), (F.col("s") + F.col("n") - 1 + length).alias("e")))
            break
        small, large = _by_size(contexts, sizes, group)
        found.append(_refined(small, length))
        if sizes.filter(F.col("m") > group).isEmpty():
            break
        contexts = staged(_split(large, width, length), "contexts")
    spans = found[0]
    for f in found[1:]:
        spans = spans.unionByName(f)
    return spans


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted((s["b"], s["e"]) for s in spans):
        if out and b <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((b, e))
    return out


def _with_spans(docs: DataFrame, length: int, gram: int, group: int, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    times = rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("k"), F.max(F.octet_length("text")).cast("bigint").alias("e"))
    again = staged(times.filter("k > 1"), "repeated_rows")
    same = F.expr("d.h = a.h AND d.doc_id <=> a.doc_id")
    of_again = rows.alias("d").join(again.alias("a"), same, "left_semi")
    once = rows.alias("d").join(again.alias("a"), same, "left_anti").unionByName(of_again.dropDuplicates(["doc_id", "h"]))
    spans = repeated_spans(once, length, gram, group).unionByName(
        again.filter(F.col("e") >= length).select("doc_id", "h", F.lit(0).cast("bigint").alias("b"), "e")
    )
    per_text = staged(spans.groupBy("doc_id", "h").agg(F.collect_set(F.struct("b", "e")).alias("spans")), "spans")
    return rows.join(
        per_text.withColumnsRenamed({"doc_id": "_d", "h": "_h"}),
        (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left",
    ).select("doc_id", "text", "spans")


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the bytes that stay (``kept``), ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of ``length`` bytes that covers it also
    starts anywhere else in the input; texts do not run into each other. A repeated row is a text of
    its own, so it removes itself. Shared windows are told apart exactly inside buckets; copies of whole runs
    by 128 bits of hash.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                gone = _merged(spans or [])
                cuts = [0, *(x for g in gone for x in g), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                out.append((kept, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) if out else [[]] * 5
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return _with_spans(docs, length, gram, group, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
