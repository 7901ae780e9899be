"""Table sources: record scans, stable samples and keyset paging."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.schemas import ensure_schema


def scan_records(
    spark: SparkSession, source: str, schema: T.StructType | None = None
) -> DataFrame:
    """A record table by name or path, held to a schema when one is given."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return ensure_schema(df, schema) if schema else df


def sample_rows(df: DataFrame, n: int, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """The first rows by key. The key makes the choice repeatable."""
    picked = df.select(*dict.fromkeys([key, *columns])) if columns else df
    return picked.orderBy(key).limit(n)


def scroll(
    df: DataFrame,
    limit: int,
    after=None,
    *,
    key: str = "id",
    with_payload: bool = True,
    with_vectors: bool = False,
    payload: str = "payload",
    vector: str = "vector",
) -> DataFrame:
    """One page in key order, after a key. Unwanted columns are not read at all.

    Each page costs one pruned scan and keeps ``limit`` rows per task; no
    offset is counted off.
    """
    hidden = [c for c, wanted in ((payload, with_payload), (vector, with_vectors)) if not wanted]
    page = df.drop(*hidden)
    if after is not None:
        page = page.where(F.col(key) > F.lit(after))
    return page.orderBy(key).limit(limit)


def next_offset(page: DataFrame, limit: int, key: str = "id"):
    """The key to continue after, or None behind the last page."""
    found = page.agg(F.count("*").alias("n"), F.max(key).alias("last")).first()
    return found["last"] if found["n"] == limit else None


def write_clustered(df: DataFrame, path: str, key: str, files: int) -> None:
    """Writes rows in files that follow each other by key, and beside them the range of keys of each file.

    One shuffle by ranges of the key, sampled by Spark; rows lie sorted in each file. Rows below ``path/rows``, ranges
    below ``path/ranges``, one row for each file.
    """
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    ranges = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("least"), F.max(key).alias("most"), F.count(F.lit(1)).alias("n")
    )
    ranges.write.parquet(f"{path}/ranges")


def read_page(spark: SparkSession, path: str, limit: int, after=None, *, key: str = "id", **toggles) -> DataFrame:
    """One page, as :func:`scroll` gives it, from files of :func:`write_clustered`; only files that hold it are read.

    A file that reaches beyond ``after`` has a row of the page at least, so no more than ``limit`` ranges, and one, have to be
    looked at, whatever the number of files.
    """
    ranges = spark.read.parquet(f"{path}/ranges")
    if after is not None:
        ranges = ranges.where(F.col("most") > F.lit(after))
    chosen, certain = [], 0
    for r in ranges.orderBy(F.asc_nulls_first("least"), "most").limit(limit + 1).collect():
        if certain >= limit:
            break
        chosen.append(unquote(r["file"]))
        # of the first file only some rows may lie behind the key
        certain += r["n"] if after is None or (r["least"] is not None and r["least"] > after) else 0
    rows = spark.read.parquet(f"{path}/rows")
    found = spark.read.schema(rows.schema).parquet(*chosen) if chosen else rows.limit(0)
    return scroll(found, limit, after, key=key, **toggles)
