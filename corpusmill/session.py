"""Session helpers: a ready-made session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

def session(app: str = "corpusmill", **conf: str) -> SparkSession:
    """A session with the settings the library is tested with.

    Every operator also runs on a session somebody else configured; nothing
    here is required for correct results.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see, as named by ``spark.checkpoint.dir``.

    Without it, the folder given to ``setCheckpointDir`` counts. A master that runs all tasks in its
    own process may go without either: there, a temporary folder is shared by definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return os.path.join(tempfile.gettempdir(), "corpusmill")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before; it is removed when the application ends."""
    parent = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{parent}/data"


def stored(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of the files below a path, or below all that a pattern names; nothing there counts as nothing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sums = [files.getContentSummary(s.getPath()) for s in files.globStatus(place) or ()]
    return sum(s.getLength() for s in sums), sum(s.getFileCount() for s in sums)


def make_path(spark: SparkSession, path: str) -> None:
    """Makes a folder, and those above it, unless it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes what was staged under a path of :func:`scratch_path`."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
