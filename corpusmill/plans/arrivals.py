"""Documents as they arrive: new files of a folder go through a flow into a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.flow import DocumentFlow
from corpusmill.schemas import POINT_SCHEMA
from corpusmill.session import drop_path, make_path, stored
from corpusmill.sinks.points import write_points
from corpusmill.sources.files import (
    TASK_BYTES, TASK_FILES, file_content, file_name, file_type, list_files, scan_tasks, walkable,
)

_LIST = "path string, length bigint, modificationTime timestamp"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
# Files of one batch: their names are one list, and tasks hold few of their contents at a time
FILES_AT_ONCE = 100_000
# Lists are filled to this share, so that chance does not make one too long
_FILLED = 0.97


def arriving_documents(
    spark: SparkSession, folder: str, seen: str, glob: str | None = None, files_at_once: int = FILES_AT_ONCE
) -> DataFrame:
    """A stream of the files of a folder: path, filename, filetype, length, content; each file once, by its path.

    ``seen`` is a folder of lists of all files that have come. This call adds those that are on none of them yet, whatever
    their time, and the stream reads these lists, one in a batch, so the driver holds no names. A file that has gone before its
    batch gives no row. A folder that tasks cannot walk is left to Spark's stream of files, for which the driver holds all names.
    """
    if walkable(spark, folder):
        tasks = _list_arrivals(spark, folder, seen, glob, files_at_once)
        lists = spark.readStream.schema(_LIST).option("maxFilesPerTrigger", 1).option("maxFileAge", "100000d").parquet(seen)
        found = lists.repartition(tasks, "path").withColumn("content", file_content("path", _local_root(spark, folder)))
        found = found.where(F.col("content").isNotNull())
    else:
        reader = (
            _small_files(spark).readStream.format("binaryFile").schema(_FILES)
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_at_once)
        )
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        found = reader.load(folder)
    name = file_name("path")
    return found.select("path", name.alias("filename"), file_type(name).alias("filetype"), "length", "content")


def _local_root(spark: SparkSession, folder: str) -> str:
    """The folder without what is a pattern in it, as tasks open it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = files.makeQualified(place).toString().removeprefix("file:").split("/")
    pattern = next((i for i, part in enumerate(whole) if set(part) & set("*?[{")), len(whole))
    return "/".join(whole[:pattern]) or "/"


def _list_arrivals(spark: SparkSession, folder: str, seen: str, glob: str | None, files_at_once: int) -> int:
    """Adds lists of the files of a folder that are on none of those in ``seen``; into how many tasks a list goes."""
    found, _, _ = list_files(spark, folder, glob)
    make_path(spark, seen)
    if stored(spark, seen)[1]:
        # a broadcast would bring all names to the driver
        known = spark.read.schema(_LIST).parquet(seen).select(F.col("path").alias("_seen")).hint("merge")
        found = found.join(known, F.col("path") == F.col("_seen"), "left_anti")
    n, n_bytes = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    if not n:
        return scan_tasks(spark, 0, files_at_once)
    lists = -(-n // max(1, int(_FILLED * files_at_once)))
    # another hash than that by which a list goes to tasks
    dealt = found.repartition(lists, F.xxhash64("path"))
    dealt.write.mode("append").option("maxRecordsPerFile", files_at_once).parquet(seen)
    return scan_tasks(spark, -(-n_bytes // lists), min(n, files_at_once))


def _small_files(spark: SparkSession) -> SparkSession:
    """A session beside this one, with its settings, but for very many files in a batch.

    Spark looks up each file of a batch in a task of its own, and counts it as several megabytes when it deals out the scan.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    own.conf.set("spark.sql.files.openCostInBytes", str(TASK_BYTES // TASK_FILES))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    return own


def load_arrivals(
    spark: SparkSession, folder: str, flow: DocumentFlow, name: str, checkpoint: str, glob: str | None = None,
    files_at_once: int = FILES_AT_ONCE,
) -> dict[str, int]:
    """Loads all files that have come since the last call and ends; returns what was written, added and replaced.

    ``checkpoint`` remembers which files were read. The flow reads the columns of :func:`arriving_documents`, its document
    id is ``path``. The points of each batch are kept in a folder of their own beside the checkpoint, and those of all batches
    go into the collection at once, so that its parts are written once for a call, not once for a batch. A batch that is run
    again takes the place of its first run; points that a failed call has left there are loaded by the next one. They
    go by id, so a load that is repeated leaves the same points, and files that came in many calls leave those of a single one.
    Of a folder that tasks can walk, the checkpoint holds the lists of files, too; one that was made without them loads all files again.
    """
    if flow.doc_id != "path" or flow.content != "content":
        raise ValueError("the flow must take 'path' as its document id and 'content' as its content")
    text = not callable(flow.source)
    checkpoint = checkpoint.rstrip("/")
    staged, seen = f"{checkpoint}-points", f"{checkpoint}/files"
    # apart from the state that a stream of the files themselves has left
    state = f"{checkpoint}/lists" if walkable(spark, folder) else checkpoint

    def stage(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("content", F.col("content").cast("string")) if text else batch
        flow.whole_points(rows).write.mode("overwrite").parquet(f"{staged}/{number}")

    query = (
        arriving_documents(spark, folder, seen, glob, files_at_once).writeStream.foreachBatch(stage)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not stored(spark, staged)[1]:
        return {"written": 0, "added": 0, "replaced": 0}
    points = spark.read.schema(POINT_SCHEMA).parquet(f"{staged}/*")
    done = write_points(points, name, flow.dim, normalize=False)
    drop_path(spark, staged)
    return {key: getattr(done, key) for key in ("written", "added", "replaced")}
