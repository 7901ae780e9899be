"""Cleaned text back to storage, always at a new path."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_clean_text(
    df: DataFrame,
    path: str,
    *,
    filename: str = "filename",
    content: str = "content",
    layout: str = "table",
    folders: int = 0,
) -> None:
    """Writes (filename, content) rows.

    ``table`` is one parquet table, the form for many files. ``files`` is one file per row, with
    the row's name and exactly its text in UTF-8; a NULL text is an empty file. Names must be unique,
    not NULL, and without slashes. With ``folders`` they are dealt by name to so many folders below the path, as one folder of
    millions of files is listed and removed as a whole. A path that holds data is refused, so a source can never be overwritten
    while it is being read.
    """
    rows = df.select(F.col(filename).alias("filename"), F.col(content).alias("content"))
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        raise ValueError(f"there is data at {path} already")
    if layout == "table":
        rows.write.mode("errorifexists").parquet(path)
    elif layout == "files":
        _write_files(rows, path, folders)
    else:
        raise ValueError(f"layout must be 'table' or 'files': {layout!r}")


def _write_files(rows: DataFrame, path: str, folders: int) -> None:
    name = F.col("filename")
    bad = rows.groupBy("filename").count().where(
        name.isNull() | name.rlike(r"^[._]?$|/") | name.isin("..") | (F.col("count") > 1)
    )
    found = bad.select("filename").first()
    if found:
        raise ValueError(f"a file name is NULL, repeated or no file name: {found[0]!r}")
    # a local path in the form that the file system of the tasks reads
    target = path.removeprefix("file:") if path.startswith("file:/") else path
    target = "/" + target.lstrip("/") if path.startswith("file:/") else target

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        files, top = FileSystem.from_uri(target)
        files.create_dir(top, recursive=True)
        made = {""}
        for batch in batches:
            for file_name, text, inner in zip(batch["filename"], batch["content"], batch["folder"]):
                folder = f"{top}/{inner}" if inner else top
                if inner not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(inner)
                # complete under a hidden name first, so that a repeated task leaves no half file
                draft = f"{folder}/.{uuid.uuid4().hex}"
                with files.open_output_stream(draft) as out:
                    out.write((text or "").encode())
                files.move(draft, f"{folder}/{file_name}")
            yield pd.DataFrame({"n": [len(batch)]})

    number = F.pmod(F.xxhash64("filename"), F.lit(folders)).cast("string") if folders else F.lit("")
    rows.withColumn("folder", number).mapInPandas(run, "n long").agg(F.sum("n")).collect()
