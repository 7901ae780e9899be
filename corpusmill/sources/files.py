"""File sources: recursive scans, whole-file text, and manifests of files to fetch."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import scratch_path, shared_dir, stored

# fixed values: accepted content types and the key prefix of stored files
PDF_CONTENT = ("pdf", "application/octet-stream")
OBJECT_PREFIX = "workflow-docs/pdf/"
# Bytes and files that one task of a scan reads, unless one file is larger
TASK_BYTES = 64 * 1024 * 1024
TASK_FILES = 2000
# Names that a listing task hands on at once, and bytes of files that a reading one does
NAMES_AT_ONCE = 10_000
BYTES_AT_ONCE = 16 * 1024 * 1024


def file_name(path: Column | str) -> Column:
    """The part after the last slash."""
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(path, "/"), -1)


def file_type(name: Column) -> Column:
    """The extension in lower case, or an empty string."""
    return F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))


def scan_tasks(spark: SparkSession, n_bytes: int, n_files: int) -> int:
    """Into how many tasks a scan of whole files goes.

    Spark counts each file as several megabytes, so that a task of many small files would be over
    before it is well begun. They are dealt by their true size and by their number instead.
    """
    return max(1, -(-n_bytes // TASK_BYTES), -(-n_files // TASK_FILES), min(spark.sparkContext.defaultParallelism, n_files))


def _hidden(name: str, folder: bool) -> bool:
    """Whether Spark's file scans pass over a name."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str, deep: bool) -> Iterator[tuple[str, bool]]:
    """Paths in a folder, each with whether it is one; ``deep`` has the files of all depths instead.

    Entries are read as they are handed on. Links are followed, those that lead nowhere left out.
    """
    with os.scandir(folder) as found:
        for entry in found:
            link = entry.is_symlink()
            if link and not os.path.exists(entry.path):
                continue
            inner = os.path.isdir(entry.path) if link else entry.is_dir()
            if _hidden(entry.name, inner):
                continue
            if inner and deep:
                yield from _entries(entry.path, deep)
            else:
                yield entry.path, inner


def _walk(deep: bool) -> Callable:
    """Folders give way to what is in them, files stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (pair for b in batches for pair in zip(b["path"].to_pylist(), b["folder"].to_pylist()))
        found = (e for path, folder in given for e in (_entries(path, deep) if folder else [(path, False)]))
        yield from _in_batches(found, ["path", "folder"], [pa.string(), pa.bool_()])

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for path in batch["path"].to_pylist():
                found = os.stat(path)
                if found.st_size > 0:
                    yield f"file:{path}", found.st_size, found.st_mtime_ns // 1_000_000

    yield from _in_batches(rows(), ["path", "length", "millis"], [pa.string(), pa.int64(), pa.int64()])


def _in_batches(rows: Iterable[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    for row in rows:
        held.append(row)
        if len(held) == NAMES_AT_ONCE:
            yield batch()
            held = []
    if held:
        yield batch()


def walkable(spark: SparkSession, path: str) -> bool:
    """Whether tasks can walk a folder by themselves: one of a mounted file system, and with a shared folder for what they find."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return False
    try:
        return bool(shared_dir(spark))
    except ValueError:
        return False


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> tuple[DataFrame, int, int]:
    """Path, length and time of each file that Spark's scan of a :func:`walkable` folder has, and their bytes and number.

    Tasks walk the tree and look up its files, and the list goes to the shared folder, so the driver holds no names of files.
    Folders of the first two levels are walked each by itself, and names in one folder are looked up by many tasks. Only what
    a pattern in ``path`` itself names is matched in the driver.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = [(files.makeQualified(s.getPath()).toString().removeprefix("file:"), s.isDirectory()) for s in files.globStatus(place) or ()]
    if not named:
        raise FileNotFoundError(f"there is nothing at {path}")
    kept = [(p, folder) for p, folder in named if folder or not _hidden(p.rsplit("/", 1)[-1], False)]
    tasks = spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame(kept, "path string, folder boolean")
    for deep in (False, False, True):
        rows = rows.mapInArrow(_walk(deep), "path string, folder boolean").repartition(tasks, "path")
    if glob:
        name = jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        rows = rows.where(file_name("path").rlike(rf"(?s)\A(?:{name})\z"))
    counted = Observation()
    found = rows.select("path").mapInArrow(_look_up, "path string, length bigint, millis bigint").select(
        "path", "length", F.timestamp_millis("millis").alias("modificationTime")
    )
    listed = scratch_path(spark, "listed")
    found.observe(counted, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")).write.parquet(listed)
    return spark.read.schema(found.schema).parquet(listed), counted.get["n_bytes"], counted.get["n"]


def file_content(path: Column | str, under: str | None = None) -> Column:
    """The bytes of the file at a path of :func:`list_files`.

    A file that has gone since fails the task; with ``under``, it has NULL as long as that folder is there.
    """

    def content(name: str) -> bytes | None:
        try:
            with open(name.removeprefix("file:"), "rb") as file:
                return file.read()
        except FileNotFoundError:
            if under is None or not os.path.isdir(under):
                raise
            return None

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            held, n_bytes = [], 0
            for name in batch.to_pylist():
                held.append(content(name))
                n_bytes += len(held[-1] or b"")
                if n_bytes >= BYTES_AT_ONCE:
                    yield pa.array(held, pa.binary())
                    held, n_bytes = [], 0
            if held:
                yield pa.array(held, pa.binary())

    return F.arrow_udf(read, "binary")(path)


def scan_documents(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Every file under a folder: path, name, type, length, time, bytes.

    A plan that does not use ``content`` never opens the files. Small files share a task. Which files there are
    is settled by the call; for folders that are not :func:`walkable`, by Spark's own listing in the driver.
    """
    if walkable(spark, path):
        rows, n_bytes, n_files = list_files(spark, path, glob)
        found = rows.repartition(scan_tasks(spark, n_bytes, n_files), "path").withColumn("content", file_content("path"))
    else:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        found = reader.load(path).coalesce(scan_tasks(spark, *stored(spark, path)))
    name = file_name("path")
    return found.select(
        "path",
        name.alias("filename"),
        file_type(name).alias("filetype"),
        "length",
        "modificationTime",
        "content",
    )


def scan_text_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file with its whole text (UTF-8): path, filename, filetype, content.

    Spark's file scans pass over files of zero bytes, so those give no row.
    """
    return scan_documents(spark, path, glob).select(
        "path", "filename", "filetype", F.col("content").cast("string").alias("content")
    )


def url_manifest(df: DataFrame, url: str = "url", prefix: str = OBJECT_PREFIX) -> DataFrame:
    """Adds the local file name of each URL, with its suffix, and the key it is stored under."""
    last = file_name(url)
    name = F.when(last.endswith(".pdf"), last).otherwise(F.concat(last, F.lit(".pdf")))
    return df.withColumn("filename", name).withColumn(
        "object_key", F.concat(F.lit(prefix), F.col("filename"))
    )


def validate_manifest(
    df: DataFrame, content_type: str = "content_type", length: str = "length"
) -> DataFrame:
    """Adds ``type_warning`` and ``rejected``.

    Another content type is only worth a warning; an empty file is rejected.
    """
    kind = F.lower(F.coalesce(F.col(content_type), F.lit("")))
    expected = F.lit(False)
    for accepted in PDF_CONTENT:
        expected = expected | kind.contains(accepted)
    return df.withColumn("type_warning", ~expected).withColumn(
        "rejected", F.coalesce(F.col(length), F.lit(0)) <= 0
    )


def accepted(manifest: DataFrame) -> DataFrame:
    """The files a validated manifest lets through."""
    return manifest.where(~F.col("rejected"))
