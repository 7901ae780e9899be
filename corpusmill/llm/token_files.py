"""Token ids in Arrow files of fixed-size lists, written and read by tasks.

All ids form one stream in the order of the document ids. Each range of documents is one file in
the Arrow stream-file format: record batches of equally many sequences, each a fixed-size list of ids
and one of mask bits, closed by a footer. Sequence ``k`` is row ``k % batch`` of batch
``k // batch``, so a memory map gives any sequence and its mask without a copy. Only the last
sequence of a file is padded; there the mask is false.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import blocks, kept_by_worker, remove_at_exit, spare_collector
from corpusmill.llm.ragged import Table, at_rows, distinct
from corpusmill.session import scratch_path

SEQUENCE = 2048
BATCH = 256
_CACHE = 600_000
_WORDS = 20_000  # plain words given to the library as one string
_TOGETHER = 2_000  # other stretches given to the library at once; each costs it about a kilobyte


@dataclass(frozen=True)
class TokenFiles:
    """A folder of token files; ``parts`` holds, per file, its name, first id and number of ids."""

    folder: str
    parts: tuple[tuple[str, int, int], ...]
    sequence: int = SEQUENCE
    batch: int = BATCH


def file_schema(sequence: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint16(), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


def encoder(path: str, end: int) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Turns texts into the ids of all, each with ``end`` after it, as 16-bit integers, and the offsets of the texts.

    The tokenizers library encodes each distinct stretch of text once. White space always separates
    tokens of this kind of vocabulary, and letters part from other characters, unless an
    apostrophe, a special token or a normalisation may join them; these are cut at white space only.
    Words of Latin-1 letters, once in lower case, need no normalising, and a piece that closes a word
    tells them apart, so many go through the library's merges as one string.
    """
    import re

    from tokenizers import Tokenizer, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    vocabulary = tokenizer.get_vocab()
    if max(vocabulary.values()) >= 1 << 16:
        raise ValueError("ids of this vocabulary do not fit 16 bits")
    closes = np.zeros(1 << 16, bool)
    closes[[i for piece, i in vocabulary.items() if piece.endswith(tokenizer.model.end_of_word_suffix)]] = True
    merges = Tokenizer(tokenizer.model)
    merges.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    fine = re.compile(r"[^\W\d_]+|(?:[\d_]|[^\w \t\n\r\x0b\x0c])+").findall
    latin = re.compile(r"[^\x00-\xff]").search
    tail = np.array([end], "<u2").tobytes()
    cache: dict[str, bytes] = {}
    whole: dict[str, bytes] = {}

    def learn(fresh: set[str]) -> None:
        words = [x for x in fresh if x.isalpha() and x.islower() and (x.isascii() or not latin(x))]
        for at in range(0, len(words), _WORDS):
            some = words[at : at + _WORDS]
            ids = np.array(merges.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u2")
            cuts = [0, *(2 * np.flatnonzero(closes[ids]) + 2).tolist()]
            data = ids.tobytes()
            for x, a, b in zip(some, cuts[:-1], cuts[1:], strict=True):
                cache[x] = data[a:b]
        others = list(fresh.difference(words))
        for at in range(0, len(others), _TOGETHER):
            some = others[at : at + _TOGETHER]
            for x, e in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                cache[x] = array("H", e.ids).tobytes()

    def stretches(text: str) -> list[str]:
        """The parts of a stretch without white space that are encoded on their own."""
        if text.isascii() and text.isalpha():
            return [text.lower()]
        return [text] if "'" in text or "<|" in text or latin(text) else fine(text.lower())

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        column = pa.array(texts, pa.string())
        found, index, offsets = distinct(pc.ascii_split_whitespace(column))
        fresh = [x for x in found if x not in whole]
        if len(whole) + len(fresh) > _CACHE:
            whole.clear()
            fresh = found
        if len(cache) > _CACHE:
            cache.clear()
        split = list(map(stretches, fresh))
        learn(set().union(*split).difference(cache))
        known = cache.__getitem__
        for x, parts in zip(fresh, split):
            whole[x] = known(parts[0]) if len(parts) == 1 else b"".join(map(known, parts))
        # the end id follows the items of each text
        closing = len(found)
        spread = np.insert(index, offsets[1:], closing)
        flat, ends = Table([*map(whole.__getitem__, found), tail], "<u2").take(spread)
        return flat, at_rows(ends, offsets + np.arange(len(offsets)))

    return encode


class _Writer:
    """Gathers ids and writes full batches; the file gets its name when it is complete."""

    def __init__(self, folder: str, part: int, attempt: str, sequence: int, batch: int):
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(folder)
        self.name = f"part-{part:06d}.arrow"
        self.path, self.hidden = f"{root}/{self.name}", f"{root}/.{self.name}.{attempt}"
        self.fs.create_dir(root, recursive=True)
        self.sequence, self.batch, self.n = sequence, batch, 0
        self.schema = file_schema(sequence)
        self.sink = self.fs.open_output_stream(self.hidden)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[bytes] = []
        self.held = 0

    def add(self, ids: bytes) -> None:
        self.n += len(ids) // 2
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 2 * self.sequence * self.batch:
            self._flush(2 * self.sequence * self.batch)

    def _flush(self, unit: int) -> None:
        data = b"".join(self.waiting)
        whole = len(data) // unit * unit
        for at in range(0, whole, unit):
            self._write(np.frombuffer(data, "<u2", unit // 2, at), unit // 2)
        self.waiting, self.held = [data[whole:]], len(data) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (ids, mask)
        ]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self._flush(2 * self.sequence * self.batch)
        rest = np.frombuffer(b"".join(self.waiting), "<u2")
        if len(rest):
            padded = np.zeros(-(-len(rest) // self.sequence) * self.sequence, "<u2")
            padded[: len(rest)] = rest
            self._write(padded, len(rest))
        self.out.close()
        self.sink.close()
        self.fs.move(self.hidden, self.path)


def write_tokens(docs: DataFrame, folder: str, path: str, end: int, id_col: str = "doc_id", text_col: str = "text",
                 sequence: int = SEQUENCE, batch: int = BATCH) -> tuple[TokenFiles, DataFrame]:
    """Encodes every text, appends ``end`` and writes the files; returns them and the index of documents.

    Documents are dealt into ranges of their id and sorted there (equal ids by text, null ids first), so
    files follow each other in order and none depends on the size of another. The index has
    the part, the offset inside it and the number of ids of every row. A task that runs again
    writes the same file. Null and empty texts have the end id alone; an empty table gives no file.
    """
    from corpusmill.llm.common import staged

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    kind = docs.schema[id_col].dataType.simpleString()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, writer, encode = task.partitionId(), None, None
        spare_collector()
        for batch_ in batches:
            for piece, texts in blocks(batch_, "text"):
                if writer is None:
                    writer = _Writer(folder, part, f"{task.taskAttemptId()}", sequence, batch)
                    encode = kept_by_worker(("encoder", path, end), lambda: encoder(path, end))
                ids, offsets = encode(texts)
                n, first = len(texts), writer.n
                writer.add(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([part] * n, pa.int32()), pa.array(first + offsets[:-1]), pa.array(np.diff(offsets))],
                    names=["doc_id", "part", "first", "n_tokens"],
                )
        if writer is not None:
            writer.close()

    index = staged(
        dealt.mapInArrow(write, f"doc_id {kind}, part int, first bigint, n_tokens bigint"), "token_index"
    )
    # one row for each file
    sizes = sorted(index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    parts = tuple((f"part-{r['part']:06d}.arrow", start, r["n"]) for r, start in zip(sizes, starts))
    return TokenFiles(folder, parts, sequence, batch), index


def open_part(files: TokenFiles, name: str) -> pa.ipc.RecordBatchFileReader:
    """The reader of one file; on a local file system it maps the file and copies nothing."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(files.folder)
    if isinstance(system, fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(os.path.join(root, name)))
    return pa.ipc.open_file(system.open_input_file(f"{root}/{name}"))


def sequence_at(reader: pa.ipc.RecordBatchFileReader, k: int, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of the k-th sequence of a file; the ids are a view of the file."""
    rows = reader.get_batch(k // batch)
    ids, mask = (rows.column(i)[k % batch].values for i in (0, 1))
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def _read(files: TokenFiles, index: DataFrame, made: Callable[[list[np.ndarray]], list[pa.Array]], names: str) -> DataFrame:
    """Id and start of every row of the index, and what ``made`` gives for its ids.

    The rows of a file come together in their order, and the file is read batch by batch beside them.
    """
    kind = index.schema["doc_id"].dataType.simpleString()
    known = {int(name[5:11]): (name, start) for name, start, _ in files.parts}
    rows = index.repartition("part").sortWithinPartitions("part", "first")
    fields = ["doc_id", "start", *(n.split()[0] for n in names.split(", "))]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader, group, before = None, None, 0, 0
        have = np.zeros(0, "<u2")  # ids of the file from ``before`` on
        for batch in batches:
            part, first, n = (batch.column(i).to_pylist() for i in range(1, 4))
            start, found = [], []
            for p, f, k in zip(part, first, n):
                if p != at:
                    at, reader, group, before, have = p, open_part(files, known[p][0]), 0, 0, have[:0]
                if f + k > before + len(have):
                    chunks = [have[f - before :]]
                    size = len(chunks[0])
                    while size < k:
                        rows_ = reader.get_batch(group)
                        group += 1
                        mask = rows_.column(1).flatten().to_numpy(zero_copy_only=False)
                        ids = rows_.column(0).flatten().to_numpy()
                        chunks.append(ids if mask.all() else ids[mask])
                        size += len(chunks[-1])
                    have, before = np.concatenate(chunks), f
                start.append(known[p][1] + f)
                found.append(have[f - before : f - before + k])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(start, pa.int64()), *made(found)], names=fields)

    return rows.mapInArrow(read, f"doc_id {kind}, start bigint, {names}")


def read_tokens(files: TokenFiles, index: DataFrame) -> DataFrame:
    """Per row of the index its id, start in the whole stream and ids, as 16-bit bytes."""
    return _read(files, index, lambda found: [pa.array([x.tobytes() for x in found], pa.binary())], "ids binary")


def read_digests(files: TokenFiles, index: DataFrame) -> DataFrame:
    """Id, start, number of ids and their crc32 as 32-bit integers, from the files."""

    def made(found: list[np.ndarray]) -> list[pa.Array]:
        return [
            pa.array([len(x) for x in found], pa.int64()),
            pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
        ]

    return _read(files, index, made, "n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    path = scratch_path(spark, "tokens")
    remove_at_exit(spark, path)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
