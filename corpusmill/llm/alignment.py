"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers cut the same bytes. A token of one and a token of the other are linked where their byte ranges
overlap, and places where tokens of both end cut a text into groups. How often each pair of ids is
linked in the whole corpus is counted in an inverted form: documents are numbered inside blocks, and each pair
of a block has compressed bitmaps of its documents, one for each binary digit of the number of links
(multiplicity planes). Population counts of the planes give links, those of the planes merged by OR give
documents. The scores of the pairs then travel back along the same bitmaps to the documents.

Bitmaps are kept as sorted lists of 16-bit numbers where few bits are set, else as bits. Pairs are dealt into
buckets, so a pair occurs once in a block and no task meets more than one bucket of some blocks.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bpe import byte_alphabet
from corpusmill.llm.common import blocks, spare_collector, staged
from corpusmill.llm.ragged import Table, at_rows, distinct

BUCKETS = 16
BLOCK_LINKS = 4_000_000  # links in a block, about
BLOCK_DOCS = 1 << 16  # documents in a block at most, so that 16 bits number them
TOGETHER = 32  # blocks whose bitmaps of one bucket a task scores
_CUT = "\x00"
_SPACE = "▁"
_CACHE = 64 << 20  # bytes of known stretches that a task remembers
_ENTRY = 220
_TOGETHER = 20_000  # stretches given to the library as one text


class Stretches:
    """Ids of blocks of texts by way of their different stretches.

    Texts are cut where no token can cross, and only stretches not met before are encoded. Some texts are taken whole.
    """

    def __init__(self, pieces: Table):
        self.pieces = pieces  # bytes of each id
        self.known: dict[str, bytes] = {}
        self.held = 0

    def is_whole(self, text: str) -> bool:
        raise NotImplementedError

    def marked(self, texts: pa.Array) -> pa.Array:
        """The texts with a mark at each cut."""
        raise NotImplementedError

    def encode(self, stretches: list[str]) -> Iterator[bytes]:
        """The ids of each, as 32-bit integers end to end."""
        raise NotImplementedError

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts in them."""
        whole = [i for i, t in enumerate(texts) if _CUT in t or self.is_whole(t)]
        column = list(texts)
        for i in whole:
            column[i] = ""
        found, index, offsets = distinct(pc.split_pattern(self.marked(pa.array(column, pa.string())), _CUT))
        index = index.copy()
        index[offsets[whole]] = len(found) + np.arange(len(whole))
        found += [texts[i] for i in whole]
        if self.held > _CACHE:
            self.known.clear()
            self.held = 0
        fresh = [x for x in dict.fromkeys(found) if x not in self.known]
        for x, data in zip(fresh, self.encode(fresh)):
            self.known[x] = data
            self.held += _ENTRY + len(x) + len(data)
        flat, ends = Table([self.known[x] for x in found], "<u4").take(index)
        return flat, at_rows(ends, offsets)


class ByteIds(Stretches):
    """By a byte-level vocabulary, for which the strings of special tokens are plain text.

    Texts are cut ahead of spaces, but not those with a space inside of white space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.library.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]
        super().__init__(Table([bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in names], "u1"))
        self.is_whole = re.compile(r"  |[^\S ] [^\S ]").search

    def marked(self, texts: pa.Array) -> pa.Array:
        return pc.replace_substring(texts, " ", _CUT + " ")

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, stretches: list[str]) -> Iterator[bytes]:
        """What begins with a space and a character, and ends in one, stands next to others as alone, so many are one text."""
        for at in range(0, len(stretches), _TOGETHER):
            some = stretches[at : at + _TOGETHER]
            plain = [x[:1] == " " and not x[1:2].isspace() and not x[-1].isspace() for x in some]
            joined = [x for x, p in zip(some, plain) if p]
            ids = self._encoded("".join(joined))
            # no token crosses from one to the next, so bytes tell where each ends
            ends = np.cumsum([len(x.encode()) for x in joined])
            cuts = iter((4 * np.searchsorted(np.cumsum(self.pieces.sizes[ids]), ends, "right")).tolist())
            data, begin = ids.tobytes(), 0
            for x, p in zip(some, plain):
                if p:
                    end = next(cuts)
                    yield data[begin:end]
                    begin = end
                else:
                    yield self._encoded(x).tobytes()


class PieceIds(Stretches):
    """By a sentence-piece model, which puts a space before each text.

    Where no piece reaches from another character to a space, texts are cut at their spaces; not those with two
    spaces together or at an end, or a literal space symbol.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in names)
        super().__init__(Table([
            b"" if self.model.is_control(i) else bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(names)
        ], "u1"))

    def is_whole(self, text: str) -> bool:
        return not self.cuts or "  " in text or text[:1] == " " or text[-1:] == " " or _SPACE in text

    def marked(self, texts: pa.Array) -> pa.Array:
        return pc.replace_substring(texts, " ", _CUT)

    def encode(self, stretches: list[str]) -> Iterator[bytes]:
        for ids in self.model.encode(stretches, num_threads=1):
            yield array("I", ids).tobytes()


@dataclass
class Aligned:
    """Tokens and links of a block of texts, end to end; offsets say where each text begins and ends in them."""

    a: np.ndarray
    b: np.ndarray
    a_offsets: np.ndarray
    b_offsets: np.ndarray
    a_ends: np.ndarray  # in bytes of the block
    b_ends: np.ndarray
    bounds: np.ndarray  # byte ends of groups
    pairs: np.ndarray  # of each link: id of a * base + id of b
    link_offsets: np.ndarray
    group_offsets: np.ndarray


class Aligner:
    """Encodes blocks of texts with both vocabularies and links their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.first, self.second = ByteIds(path_a), PieceIds(path_b)
        self.base = len(self.second.pieces.sizes)
        self.numbers = Table([f"{i},".encode() for i in range(max(self.base, len(self.first.pieces.sizes)))], "u1")

    def align(self, texts: list[str]) -> Aligned:
        spaced = [" " + t if t else "" for t in texts]
        a, a_at = self.first.ids(spaced)
        b, b_at = self.second.ids(texts)
        b, b_at = _without(b, b_at, np.array([not t for t in texts], bool))
        sides = []
        for ids, at, table in ((a, a_at, self.first.pieces), (b, b_at, self.second.pieces)):
            data, ends = table.take(ids)
            sides.append((data.tobytes(), at_rows(ends, at).tolist()))
        want = [t.encode("utf-8", "replace") for t in spaced]
        differs = np.array([
            any(data[ends[i] : ends[i + 1]] != w for data, ends in sides) for i, w in enumerate(want)
        ], bool)
        a, a_at = _without(a, a_at, differs)
        b, b_at = _without(b, b_at, differs)
        a_ends, b_ends = np.cumsum(self.first.pieces.sizes[a]), np.cumsum(self.second.pieces.sizes[b])
        n_bytes = int(a_ends[-1]) if len(a_ends) else 0
        ends = np.zeros(n_bytes + 1, np.int8)
        ends[a_ends] = 1
        ends[b_ends] += 2
        # between two neighbouring ends lies one token of each side: one link
        links, bounds = np.flatnonzero(ends), np.flatnonzero(ends == 3)
        pairs = a[np.searchsorted(a_ends, links)].astype(np.int64) * self.base + b[np.searchsorted(b_ends, links)]
        text_ends = at_rows(a_ends, a_at)
        return Aligned(
            a, b, a_at, b_at, a_ends, b_ends, bounds, pairs,
            np.searchsorted(links, text_ends, "right"), np.searchsorted(bounds, text_ends, "right"),
        )

    def rendered(self, x: Aligned) -> Iterator[bytes]:
        """For each text its groups as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(x.a), len(x.b)
        a_group, b_group = np.searchsorted(x.bounds, x.a_ends), np.searchsorted(x.bounds, x.b_ends)
        last_a, last_b = np.r_[a_group[1:] != a_group[:-1], np.ones(min(n_a, 1), bool)], np.r_[b_group[1:] != b_group[:-1], np.ones(min(n_b, 1), bool)]
        upto_a, upto_b = np.cumsum(np.bincount(a_group, minlength=len(x.bounds))), np.cumsum(np.bincount(b_group, minlength=len(x.bounds)))
        at_a = np.arange(n_a) + np.r_[0, upto_b][a_group]
        at_b = np.arange(n_b) + upto_a[b_group]
        ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[at_a], ids[at_b] = x.a, x.b
        mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
        data, ends = self.numbers.take(ids)
        data = data.copy()
        data[ends - 1] = mark
        cuts = np.r_[0, ends][x.a_offsets + x.b_offsets].tolist()
        data = data.tobytes()
        for begin, end in zip(cuts, cuts[1:]):
            yield data[begin : max(begin, end - 1)]


def _without(ids: np.ndarray, offsets: np.ndarray, drop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids without those of the texts to ``drop``."""
    if not drop.any():
        return ids, offsets
    sizes = np.diff(offsets)
    kept = ids[~np.repeat(drop, sizes)]
    return kept, np.r_[0, np.cumsum(np.where(drop, 0, sizes))]


@dataclass(frozen=True)
class Bitmaps:
    """Compressed bitmaps of documents, by pair and plane in that order."""

    pairs: np.ndarray  # int64
    planes: np.ndarray  # uint8
    sizes: np.ndarray  # int32: bits set
    listed: np.ndarray  # uint16: numbers of the documents of the sparse ones, end to end
    bits: np.ndarray  # uint8: the dense ones, row by row
    n_docs: int

    @staticmethod
    def dense(sizes: np.ndarray, n_docs: int) -> np.ndarray:
        """Where bits are shorter than a list."""
        return sizes > n_docs // 16

    @staticmethod
    def of(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, n_docs: int) -> Bitmaps:
        """From postings in the order of pair and document."""
        planes = range(int(times.max(initial=0)).bit_length())
        rows = [np.flatnonzero(times >> k & 1) for k in planes]
        p = np.concatenate([pairs[r] for r in rows]) if rows else pairs
        k = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        d = np.concatenate([docs[r] for r in rows]) if rows else docs
        order = np.argsort(p * 64 + k, kind="stable")
        p, k, d = p[order], k[order], d[order]
        first = np.flatnonzero(np.r_[np.ones(min(len(p), 1), bool), (p[1:] != p[:-1]) | (k[1:] != k[:-1])])
        sizes = np.diff(np.r_[first, len(p)])
        dense = Bitmaps.dense(sizes, n_docs)
        inside = np.repeat(dense, sizes)
        grid = np.zeros((int(dense.sum()), n_docs), bool)
        grid[np.repeat(np.arange(len(grid)), sizes[dense]), d[inside]] = True
        return Bitmaps(p[first], k[first].astype(np.uint8), sizes.astype(np.int32), d[~inside].astype(np.uint16),
                       np.packbits(grid, axis=1).ravel(), n_docs)

    def part(self, chosen: np.ndarray) -> Bitmaps:
        """The chosen bitmaps."""
        dense = self.dense(self.sizes, self.n_docs)
        width = -(-self.n_docs // 8)
        listed = self.listed[np.repeat(chosen[~dense], self.sizes[~dense])]
        bits = self.bits.reshape(-1, width)[chosen[dense]].ravel() if len(self.bits) else self.bits
        return Bitmaps(self.pairs[chosen], self.planes[chosen], self.sizes[chosen], listed, bits, self.n_docs)

    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every bit that is set: which bitmap, and which document."""
        dense = self.dense(self.sizes, self.n_docs)
        which, bit = np.nonzero(np.unpackbits(self.bits.reshape(int(dense.sum()), -1), axis=1)) if dense.any() else (np.zeros(0, np.int64),) * 2
        return (np.r_[np.repeat(np.flatnonzero(~dense), self.sizes[~dense]), np.flatnonzero(dense)[which]],
                np.r_[self.listed.astype(np.int64), bit])

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs, the number of documents of each and the number of its links."""
        first = np.flatnonzero(np.r_[np.ones(min(len(self.pairs), 1), bool), self.pairs[1:] != self.pairs[:-1]])
        if not len(first):
            return (np.zeros(0, np.int64),) * 3
        links = np.add.reduceat(self.sizes.astype(np.int64) << self.planes.astype(np.int64), first)
        n_planes = np.diff(np.r_[first, len(self.pairs)])
        docs = self.sizes[first].astype(np.int64)
        several = np.flatnonzero(n_planes > 1)
        if len(several):  # planes merged by OR
            owner = np.repeat(np.arange(len(first)), n_planes)
            merged = self.part(np.repeat(n_planes > 1, n_planes))
            which, doc = merged.postings()
            owners = owner[np.repeat(n_planes > 1, n_planes)]
            seen = np.unique(owners[which] * (self.n_docs + 1) + doc)
            docs[several] = np.bincount(seen // (self.n_docs + 1), minlength=len(first))[several]
        return self.pairs[first], docs, links

    def record(self) -> dict:
        return {"n_docs": self.n_docs} | {f: getattr(self, f).tobytes() for f in ("pairs", "planes", "sizes", "listed", "bits")}

    @staticmethod
    def read(r: dict) -> Bitmaps:
        kinds = {"pairs": np.int64, "planes": np.uint8, "sizes": np.int32, "listed": np.uint16, "bits": np.uint8}
        return Bitmaps(**{f: np.frombuffer(r[f], k) for f, k in kinds.items()}, n_docs=r["n_docs"])


_BITMAPS = "n_docs int, pairs binary, planes binary, sizes binary, listed binary, bits binary"
_RENDERED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


@dataclass(frozen=True)
class Alignment:
    """``documents``: a row for each document with its place ``(task, block, number)`` and measures; ``bitmaps``: those of all pairs
    of a block and bucket in each row. ``base`` splits a pair into its ids."""

    documents: DataFrame
    bitmaps: DataFrame
    base: int
    n_blocks: int


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return ((pairs * np.int64(0x9E3779B1)) >> 20) % buckets


def align(docs: DataFrame, path_a: str, path_b: str, buckets: int = BUCKETS, block_links: int = BLOCK_LINKS, id_col: str = "doc_id",
          text_col: str = "text") -> Alignment:
    """Encodes all texts and writes measures and bitmaps, in one pass without a shuffle.

    Null and empty texts, and those whose tokens do not spell a space and the text, have no tokens: zeros and an
    empty string. Each row is a document of its own, so repeated ids and rows do not matter; other columns are left out.
    """
    import sentencepiece
    from pyspark.sql.pandas.types import to_arrow_type

    kind, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    schema = f"doc_id {kind}, task int, block int, number int, {_RENDERED}, bucket int, {_BITMAPS}"
    names = ["doc_id", "task", "block", "number", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "bucket",
             "n_docs", "pairs", "planes", "sizes", "listed", "bits"]
    i32, i64, binary = pa.int32(), pa.int64(), pa.binary()
    types = [id_type, i32, i32, i32, i64, i64, i64, i64, pa.string(), i32, i32, *[binary] * 5]

    def record(n: int, **columns) -> pa.RecordBatch:
        arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(n, t)
                  for c, t in zip(names, types)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, block, aligner = TaskContext.get().partitionId(), 0, None
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_docs = n_links = 0
        spare_collector()

        def close() -> Iterator[pa.RecordBatch]:
            pairs, docs_, times = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(pairs * BLOCK_DOCS + docs_, kind="stable")
            maps = Bitmaps.of(pairs[order], docs_[order], times[order], n_docs)
            dealt = bucket_of(maps.pairs, buckets)
            for k in np.unique(dealt).tolist():
                part = maps.part(dealt == k).record()
                yield record(1, task=[task], block=[block], bucket=[k], **{f: [v] for f, v in part.items()})

        for batch in batches:
            for part, texts in blocks(batch, 1):
                for begin in range(0, len(texts), BLOCK_DOCS):
                    some = texts[begin : begin + BLOCK_DOCS]
                    if found and (n_docs + len(some) > BLOCK_DOCS or n_links >= block_links):
                        yield from close()
                        found, n_docs, n_links, block = [], 0, 0, block + 1
                    aligner = aligner or Aligner(path_a, path_b)
                    x = aligner.align(some)
                    per_doc = np.diff(x.link_offsets)
                    keys, times = np.unique(x.pairs * BLOCK_DOCS + np.repeat(np.arange(len(some)), per_doc) + n_docs, return_counts=True)
                    found.append((keys // BLOCK_DOCS, keys % BLOCK_DOCS, times))
                    yield record(
                        len(some), doc_id=part.column(0).slice(begin, len(some)), task=[task] * len(some), block=[block] * len(some),
                        number=np.arange(n_docs, n_docs + len(some)), n_a=np.diff(x.a_offsets), n_b=np.diff(x.b_offsets),
                        n_groups=np.diff(x.group_offsets), n_links=per_doc,
                        groups_sha256=[hashlib.sha256(g).hexdigest() if g else "" for g in aligner.rendered(x)],
                    )
                    n_docs, n_links = n_docs + len(some), n_links + len(x.pairs)
                    pa.default_memory_pool().release_unused()
        if found:
            yield from close()

    rows = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema), "aligned")
    base = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    bitmaps = rows.filter("bucket IS NOT NULL").select("task", "block", "bucket", *_fields(_BITMAPS))
    documents = rows.filter("bucket IS NULL").select("doc_id", "task", "block", "number", *_fields(_RENDERED))
    return Alignment(documents, bitmaps, base, bitmaps.select("task", "block").distinct().count())


def _fields(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def pair_counts(alignment: Alignment) -> DataFrame:
    """``pair``, its ids ``a`` and ``b``, ``n_docs`` documents with a link and ``n_links`` links, for every pair of the corpus."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = Bitmaps.read(batch.slice(i, 1).to_pylist()[0]).counts()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in counts], names=["pair", "n_docs", "n_links"])

    counted = alignment.bitmaps.select(*_fields(_BITMAPS)).mapInArrow(count, "pair bigint, n_docs bigint, n_links bigint")
    return counted.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")).select(
        "pair", F.expr(f"pair DIV {alignment.base}").alias("a"), F.pmod("pair", F.lit(alignment.base)).alias("b"), "n_docs", "n_links"
    )


def best_pairs(counts: DataFrame) -> DataFrame:
    """Adds ``best``: whether no pair of the same ``b`` has more links."""
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(most, "b").withColumn("best", F.col("n_links") == F.col("most")).drop("most")


def document_scores(alignment: Alignment, scores: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(task, block, number, n_best, count_sum)`` from ``scores (pair, n_links, best)``, along the bitmaps.

    Bitmaps of a bucket meet the scores of the bucket in tasks that hold some blocks each; scores are repeated
    for these, bitmaps move once. In a task the scores come first, and bitmaps stream past them.
    """
    parts = max(1, -(-alignment.n_blocks // TOGETHER))
    bucket = F.pmod(F.shiftright(F.col("pair") * F.lit(0x9E3779B1), 20), F.lit(buckets)).cast("int")
    fields = _fields(_BITMAPS)
    spread = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    first = scores.select(
        bucket.alias("bucket"), spread, F.lit(-1).alias("task"), F.lit(-1).alias("block"), "pair", "n_links", "best",
        *(F.lit(None).cast("int" if f == "n_docs" else "binary").alias(f) for f in fields),
    )
    then = alignment.bitmaps.select(
        "bucket", F.pmod(F.xxhash64("task", "block"), F.lit(parts)).cast("int").alias("part"), "task", "block",
        F.lit(None).cast("bigint").alias("pair"), F.lit(None).cast("bigint").alias("n_links"), F.lit(None).cast("boolean").alias("best"), *fields,
    )
    dealt = first.unionByName(then).repartition(buckets * parts, "bucket", "part").sortWithinPartitions("bucket", "part", "task", "block")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, table = None, [], None
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            keys = np.stack([column[c].to_numpy() for c in ("bucket", "part")]).T
            tasks = column["task"].to_numpy()
            change = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1) | ((tasks[1:] < 0) != (tasks[:-1] < 0))])
            for begin, end in zip(change.tolist(), [*change[1:].tolist(), len(keys)]):
                if tuple(keys[begin]) != at:
                    at, held, table = tuple(keys[begin]), [], None
                if tasks[begin] < 0:
                    held.append([column[c].slice(begin, end - begin).to_numpy(zero_copy_only=False) for c in ("pair", "n_links", "best")])
                    continue
                if table is None:
                    pairs, links, best = (np.concatenate(c) for c in zip(*held))
                    order = np.argsort(pairs)
                    table, held = (pairs[order], links[order].astype(np.int64), best[order].astype(bool)), []
                for i in range(begin, end):
                    yield _scored(batch.slice(i, 1).to_pylist()[0], *table)

    made = dealt.mapInArrow(score, "task int, block int, number int, n_best bigint, count_sum bigint")
    return made.groupBy("task", "block", "number").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _scored(r: dict, pairs: np.ndarray, links: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    maps = Bitmaps.read(r)
    at = np.searchsorted(pairs, maps.pairs)
    times = np.int64(1) << maps.planes.astype(np.int64)
    which, doc = maps.postings()

    def summed(weights: np.ndarray) -> np.ndarray:
        # in two halves, as sums of doubles are exact below 2**53 only
        low, high = (np.bincount(doc, part[which].astype(float), maps.n_docs).astype(np.int64) for part in (weights & 0x3FFFFFF, weights >> 26))
        return low + (high << 26)

    sums = summed(times * links[at])
    number = np.flatnonzero(sums)
    n_best = summed(times * best[at])
    return pa.RecordBatch.from_arrays(
        [pa.array([r["task"]] * len(number), pa.int32()), pa.array([r["block"]] * len(number), pa.int32()), pa.array(number, pa.int32()),
         pa.array(n_best[number]), pa.array(sums[number])],
        names=["task", "block", "number", "n_best", "count_sum"],
    )


def score_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    alignment = align(docs, path_a, path_b, id_col=id_col, text_col=text_col)
    scores = staged(best_pairs(staged(pair_counts(alignment), "pair_counts")).select("pair", "n_links", "best"), "pair_scores")
    place = ["task", "block", "number"]
    scored = alignment.documents.join(document_scores(alignment, scores), place, "left")
    return scored.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256",
    )


def group_spans(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``groups``: of each group the byte range in a space and the text, and the ids of both sides."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, groups array<struct<begin:bigint,end:bigint,a:array<int>,b:array<int>>>"
    out = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            for part, texts in blocks(batch, 1):
                aligner = aligner or Aligner(path_a, path_b)
                x = aligner.align(texts)
                a_at, b_at = np.r_[0, np.searchsorted(x.a_ends, x.bounds, "right")], np.r_[0, np.searchsorted(x.b_ends, x.bounds, "right")]
                begins, groups = np.r_[0, x.bounds], []
                for i, j in zip(x.group_offsets[:-1].tolist(), x.group_offsets[1:].tolist()):
                    start = begins[i] if i < len(begins) else 0
                    groups.append([
                        {"begin": int(begins[g] - start), "end": int(x.bounds[g] - start), "a": x.a[a_at[g] : a_at[g + 1]].tolist(),
                         "b": x.b[b_at[g] : b_at[g + 1]].tolist()} for g in range(i, j)
                    ])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(groups, out.field(1).type)], schema=out)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ddl)
