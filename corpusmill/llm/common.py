"""What several operators share: reading tables, staging results, working through Arrow batches."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import scratch_path

# how much text a task looks at together, in characters
BLOCK_CHARS = 3_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    It cuts the lineage: what is read several times is computed once, and a lost executor
    costs a file to read. The files go when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def semi_join(rows: DataFrame, keys: DataFrame, on: list[str], times: str, parts: int = 2000) -> DataFrame:
    """The rows whose ``on`` is in ``keys``; ``times`` says how many rows have each key. Both are read twice.

    A key that holds more than one in ``parts`` of the rows would burden a single task. There are fewer than ``parts``
    such keys, whatever the data, so these are broadcast, and the rest meets by a shuffle.
    """
    most = rows.count() // parts
    hot = F.broadcast(keys.filter(F.col(times) > most).select(*on))
    cold = keys.filter(F.col(times) <= most).select(*on)
    return rows.join(hot, on, "left_semi").unionByName(rows.join(hot, on, "left_anti").join(cold, on, "left_semi"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def blocks(batch: pa.RecordBatch, text: str | int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in slices of about ``BLOCK_CHARS`` (a row at least), with their texts; null is empty."""
    column = batch.column(text)
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > BLOCK_CHARS:
            part = batch.slice(start, i - start)
            yield part, texts_of(part, text)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        part = batch.slice(start)
        yield part, texts_of(part, text)


def texts_of(batch: pa.RecordBatch, text: str | int) -> list[str]:
    return [t or "" for t in batch.column(text).to_pylist()]


def spare_collector() -> None:
    """Makes Python look for cycles rarely: tasks hold millions of strings and lists, and no cycles."""
    gc.set_threshold(1_000_000, 50, 50)


def kept_by_worker(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the Python worker for the tasks after this one.

    A worker serves many tasks, but the functions of each arrive anew, and their globals with them; a
    module made here stays. For memos of pure functions only: losing one costs time, not results.
    """
    module = sys.modules.setdefault("corpusmill_worker_memo", types.ModuleType("corpusmill_worker_memo"))
    if key not in module.__dict__:
        module.__dict__[key] = make()
    return module.__dict__[key]


def each_block(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[list[str]], dict[str, pa.Array | list]]],
    schema: str,
) -> DataFrame:
    """Adds columns computed from blocks of texts; the text itself is not returned.

    ``make`` is called once in each task and returns what turns texts into columns. The
    other columns of ``df`` come first, then those of ``schema``.
    """
    kept = [c for c in df.columns if c != text]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text] + [schema])
    out = pa.schema(_arrow_fields(fields))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        spare_collector()
        for batch in batches:
            for part, texts in blocks(batch, text):
                work = work or make()
                made = work(texts)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                columns += [made[f.name] for f in list(out)[len(kept):]]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out)],
                    schema=out,
                )
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, fields)


def kept_rows(df: DataFrame, text: str, make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """The rows of ``df`` whose text is judged to stay, in blocks; each row passes through Python once, as it is."""
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = None
        spare_collector()
        for batch in batches:
            for part, texts in blocks(batch, at):
                judge = judge or make()
                yield part.filter(pa.array(judge(texts), pa.bool_()))
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, df.schema)


def _arrow_fields(ddl: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return list(to_arrow_schema(StructType.fromDDL(ddl)))
