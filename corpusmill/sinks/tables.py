"""Keyed tables: last-write-wins upserts into tables that Spark buckets by key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.schemas import SchemaConflict, check_rows, fields
from corpusmill.session import drop_path, scratch_path, stored

PART = "_part"
# Bytes of incoming rows, as staged, that one task writes
TASK_BYTES = 64 * 1024 * 1024
_KEY, _PARTS, _BUCKETS = "corpusmill.key", "corpusmill.parts", "corpusmill.buckets"


def last_by_key(df: DataFrame, key: str, seq: str | None) -> DataFrame:
    """The row with the highest ``seq`` per key; NULL is lower than any, equal ones (all without ``seq``) go by content.

    A NULL key is a key like any other. Repeats are combined in the task that reads them, so a key with very many
    versions does not gather in one place.
    """
    order = [F.col(seq).isNotNull(), F.col(seq)] if seq else []
    return (
        df.groupBy(F.col(key).alias("_key"))
        .agg(
            F.max_by(
                F.struct(*df.columns),
                F.struct(*order, F.xxhash64(*df.columns)),
            ).alias("_row")
        )
        .select("_row.*")
    )


def upsert(old: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    """``old`` with the rows of ``new`` put in place of those with the same key.

    ``seq`` orders the versions of a key within ``new`` and is not stored. Of
    ``new`` only the keys meet the old table; when they are few, the planner
    sends them to its scan and the old table is not shuffled. Fields that one
    side lacks become NULL.
    """
    rows = last_by_key(new, key, seq).drop(seq)
    keys = rows.select(F.col(key).alias("_new_key"))
    kept = old.join(keys, F.col(key).eqNullSafe(F.col("_new_key")), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


@dataclass(frozen=True)
class Load:
    """What a load did: rows that came, keys that were written, how many of these replaced a row, and rows refused.

    ``failures`` holds the refused rows as they came, each with the reason in ``error``.
    """

    received: int
    written: int
    replaced: int
    refused: int
    failures: DataFrame

    @property
    def added(self) -> int:
        return self.written - self.replaced


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def create_table(spark: SparkSession, name: str, schema: T.StructType, key: str, parts: int = 16, buckets: int = 16) -> None:
    """An empty table, in folders by hash of the key (the parts), and by Spark's buckets of the key inside of them."""
    stored = T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])
    (
        spark.createDataFrame([], stored).write.partitionBy(PART).bucketBy(buckets, key)
        .option("partitionOverwriteMode", "dynamic").saveAsTable(name)
    )
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_KEY}' = '{key}', '{_PARTS}' = '{parts}', '{_BUCKETS}' = '{buckets}')")


def _widened(old: T.DataType, new: T.DataType, at: str) -> T.DataType:
    """The type that holds values of both: structs take the fields of either; any other change is refused."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        found = {f.name: f for f in old.fields}
        for f in new.fields:
            kind = _widened(found[f.name].dataType, f.dataType, f"{at}.{f.name}") if f.name in found else f.dataType
            found[f.name] = T.StructField(f.name, kind, True, found[f.name].metadata if f.name in found else f.metadata)
        return T.StructType(list(found.values()))
    if old.simpleString() != new.simpleString():
        raise SchemaConflict(f"{at}: {new.simpleString()} is not {old.simpleString()}")
    return old


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in a type that has more struct fields, these NULL."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType) and have != want:
        names = set(have.names)
        inner = [
            (_fitted(value[f.name], have[f.name].dataType, f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*inner))
    return value.cast(want)


def _in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, those that ``df`` lacks NULL."""
    return df.select(
        *(
            (_fitted(F.col(f.name), df.schema[f.name].dataType, f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
            .alias(f.name, metadata=f.metadata)
            for f in schema.fields
        )
    )


def _evolved(spark: SparkSession, name: str, incoming: T.StructType) -> T.StructType:
    """Adds columns that come new to the table and returns its columns, without the part.

    New fields of structs cannot be added in place, so these rewrite the table under a new name, which then takes its place.
    """
    table = spark.table(name)
    present = T.StructType([f for f in table.schema.fields if f.name != PART])
    wanted = _widened(present, incoming, name)
    if all(a.dataType == b.dataType for a, b in zip(present.fields, wanted.fields)):
        missing = wanted.fields[len(present.fields):]
        if missing:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
        return wanted
    found, other = _properties(spark, name), f"{name}_{uuid.uuid4().hex}"
    create_table(spark, other, wanted, found[_KEY], int(found[_PARTS]), int(found[_BUCKETS]))
    rewritten = _in_schema(table, wanted).withColumn(PART, _part(found[_KEY], int(found[_PARTS])))
    rewritten.repartition(int(found[_BUCKETS]), found[_KEY]).write.insertInto(other, overwrite=True)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {other} RENAME TO {name}")
    return wanted


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def upsert_table(
    spark: SparkSession,
    name: str,
    new: DataFrame,
    key: str,
    seq: str | None,
    *,
    parts: int = 16,
    buckets: int = 16,
    declared: T.StructType | None = None,
    required: Sequence[str] = (),
    max_records_per_file: int = 0,
) -> Load:
    """Upserts into a table of the catalog, which is created where there is none, and reports what happened.

    Rows that lack a ``required`` value, or hold one that is not of its ``declared`` type, are refused and the
    others loaded. The incoming rows are written to the shared folder once, and counted as they are. Only parts that
    hold a changed key are read and written: their old rows come out of Spark's buckets, so they meet the new keys without
    a shuffle, and go back by Spark's dynamic partition overwrite. A part that a job was writing when it failed keeps its
    old rows or has its new ones; the load can be repeated. One writer at a time. Columns and struct fields
    may be added, and keep their type. Without ``seq``, versions of a key within ``new`` are decided by content.
    """
    if spark.catalog.tableExists(name):
        found = _properties(spark, name)
        if (found[_KEY], int(found[_PARTS]), int(found[_BUCKETS])) != (key, parts, buckets):
            raise ValueError(f"the table has key {found[_KEY]}, {found[_PARTS]} parts and {found[_BUCKETS]} buckets")
    checked = check_rows(new, declared or fields(), list(required))
    coming, latest = Observation(), Observation()
    refused = F.col("error").isNotNull()
    seen = checked.observe(coming, F.count(F.lit(1)).alias("received"), F.count_if(refused).alias("refused"))
    kinds = {f.name: f.dataType for f in declared.fields} if declared else {}
    good = seen.where(~refused).select(*(F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in new.columns))
    rows = last_by_key(good, key, seq)
    rows = (rows.drop(seq) if seq else rows).withColumn(PART, _part(key, parts))
    staged = scratch_path(spark, "upsert")
    rows.observe(latest, F.count(F.lit(1)).alias("written"), F.count_if(F.col(key).isNull()).alias("no_key")).write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    incoming = T.StructType([f for f in rows.schema.fields if f.name != PART])
    if not spark.catalog.tableExists(name):
        create_table(spark, name, incoming, key, parts, buckets)
    schema = _evolved(spark, name, incoming)
    replaced = 0
    # numbers of parts only, as many as there are at most
    touched = [r[0] for r in rows.select(PART).distinct().collect()]
    if touched:
        old = spark.table(name).where(F.col(PART).isin(touched))
        before, after = old.count(), Observation()  # counted by the footers
        fitted = _in_schema(rows, schema).withColumn(PART, _part(key, parts))
        written = dealt(fitted, key, parts, buckets, stored(spark, staged)[0])
        if before:
            kept = kept_rows(old, rows, key, bool(latest.get["no_key"])).observe(after, F.count(F.lit(1)).alias("kept"))
            written = kept.select(*schema.names, PART).unionByName(written)
        written.write.option("maxRecordsPerFile", max_records_per_file).insertInto(name, overwrite=True)
        replaced = before - after.get["kept"] if before else 0
    drop_path(spark, staged)
    return Load(coming.get["received"], latest.get["written"], replaced, coming.get["refused"], checked.where(refused))


def dealt(rows: DataFrame, key: str, parts: int, buckets: int, n_bytes: int) -> DataFrame:
    """Rows by bucket, for a write: into as many tasks as their bytes need, however few buckets and parts there are.

    Beyond one task for a bucket, its parts go to several, and then the rows of a part, as further files of the bucket.
    """
    tasks = max(1, -(-n_bytes // (buckets * TASK_BYTES)))
    groups = min(parts, tasks)
    pieces = -(-tasks // groups)
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # as Spark numbers its buckets
    piece = F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(pieces))
    place = (bucket * groups + F.pmod(F.col(PART), F.lit(groups))) * pieces + piece
    return rows.repartitionById(buckets * groups * pieces, place.cast("int"))


def kept_rows(old: DataFrame, rows: DataFrame, key: str, no_key: bool) -> DataFrame:
    """The rows of ``old`` whose key is not in ``rows``; those without a key go if ``no_key``.

    A merge join, so that what comes out lies in the buckets it came from and is written back to these.
    """
    keys = rows.select(F.col(key).alias("_new_key")).hint("merge")
    kept = old.join(keys, F.col(key) == F.col("_new_key"), "left_anti")
    return kept.where(F.col(key).isNotNull()) if no_key else kept


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table, with all its columns."""
    return spark.table(name).drop(PART)
