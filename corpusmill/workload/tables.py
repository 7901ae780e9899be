"""Upserts, schema changes and load checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.schemas import (
    ensure_schema, ensure_table, fields, first_failures, found_fields, load_tally, new_fields, split_valid, typed_json,
)
from corpusmill.session import scratch_path
from corpusmill.sinks.tables import upsert, upsert_table
from corpusmill.sources.tables import scan_records
from corpusmill.workload.base import SQL_LABELLED, from_table, labelled, load, named

# Changes: every customer in debt twice, with a later version in another
# segment, and every supplier as a new customer.
_SQL_CHANGES = """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, 'FIRST' AS c_mktsegment,
         1 AS seq FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 2, 'SECOND', 2 FROM customer
  WHERE c_acctbal < 0
  UNION ALL
  SELECT s_suppkey + 100000000, s_name, s_nationkey, s_acctbal, 'NEW', 1 FROM supplier
"""


def _changes(spark, sf_dir):
    debt = load(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)

    def version(amount: int, segment: str):
        return debt.select(
            "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + amount).alias("c_acctbal"),
            F.lit(segment).alias("c_mktsegment"), F.lit(amount).alias("seq"),
        )

    added = load(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 100000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"),
        F.lit(1).alias("seq"),
    )
    return version(1, "FIRST").unionByName(version(2, "SECOND")).unionByName(added)


_SQL_UPSERTED = f"""
  WITH n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey
                                                         ORDER BY seq DESC) AS rn
                            FROM ({_SQL_CHANGES})) WHERE rn = 1)
  SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 4) AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM n)
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 4), c_mktsegment FROM n
"""


@named("upsert_last_wins", _SQL_UPSERTED)
def upsert_last_wins(spark, sf_dir):
    return upsert(
        load(spark, sf_dir, "customer"), _changes(spark, sf_dir), "c_custkey", "seq"
    ).withColumn("c_acctbal", F.round("c_acctbal", 4))


@named("upsert_sink", _SQL_UPSERTED)
def upsert_sink(spark, sf_dir):
    def fill(name):
        first = load(spark, sf_dir, "customer").withColumn("seq", F.lit(0))
        upsert_table(spark, name, first, "c_custkey", "seq", parts=4, buckets=4)
        upsert_table(spark, name, _changes(spark, sf_dir), "c_custkey", "seq", parts=4, buckets=4)

    return from_table(spark, "customers", fill).withColumn("c_acctbal", F.round("c_acctbal", 4))


# of the changes some come without a name, some with a balance that is no number
_SQL_DOUBTFUL = f"""
  SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS c_name, c_nationkey,
         CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE c_acctbal::VARCHAR END AS c_acctbal, c_mktsegment, seq
  FROM ({_SQL_CHANGES})
"""


@named(
    "upsert_outcome",
    f"""WITH d AS ({_SQL_DOUBTFUL}), good AS (SELECT * FROM d WHERE c_name IS NOT NULL AND c_acctbal <> 'n/a')
        SELECT 'received' AS outcome, count(*) AS n FROM d
        UNION ALL SELECT 'written', count(DISTINCT c_custkey) FROM good
        UNION ALL SELECT 'replaced', count(DISTINCT c_custkey) FROM good WHERE c_custkey IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'added', count(DISTINCT c_custkey) FROM good WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'refused', count(*) FROM d WHERE c_name IS NULL OR c_acctbal = 'n/a'
        UNION ALL SELECT CASE WHEN c_name IS NULL THEN 'missing: c_name' ELSE 'type: c_acctbal' END, count(*)
                  FROM d WHERE c_name IS NULL OR c_acctbal = 'n/a' GROUP BY 1
        UNION ALL SELECT 'rows in the table', (SELECT count(*) FROM customer) + (SELECT count(DISTINCT c_custkey) FROM good
                  WHERE c_custkey NOT IN (SELECT c_custkey FROM customer))""",
)
def upsert_outcome(spark, sf_dir):
    """What a load reports: rows received, written, replaced and refused, the latter with reasons."""
    reports = []
    customer = load(spark, sf_dir, "customer")
    doubtful = _changes(spark, sf_dir).withColumns({
        "c_name": F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")),
        "c_acctbal": F.when(F.col("c_custkey") % 3 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")),
    })

    def fill(name):
        upsert_table(spark, name, customer.withColumn("seq", F.lit(0)), "c_custkey", "seq", parts=4, buckets=4)
        reports.append(upsert_table(
            spark, name, doubtful, "c_custkey", "seq", parts=4, buckets=4, declared=customer.schema, required=["c_name"]
        ))

    stored = from_table(spark, "outcomes", fill)
    report = reports[0]
    counted = [("received", report.received), ("written", report.written), ("replaced", report.replaced), ("added", report.added),
               ("refused", report.refused)]
    reasons = report.failures.groupBy(F.col("error").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    rows = stored.agg(F.lit("rows in the table").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame(counted, "outcome string, n bigint").unionByName(reasons).unionByName(rows)


@named(
    "upsert_sink_evolving",
    """SELECT s_suppkey, 'second ' || s_name AS s_name, s_nationkey, s_acctbal,
              CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 2 END AS rating FROM supplier""",
)
def upsert_sink_evolving(spark, sf_dir):
    """A column that some rows bring is kept when the others are written again without it."""
    rows = load(spark, sf_dir, "supplier").withColumn("seq", F.lit(0))
    later = rows.withColumn("s_name", F.concat(F.lit("second "), "s_name"))
    rated = later.where("s_suppkey % 3 = 0").withColumn("rating", F.col("s_suppkey") * 2)

    def fill(name):
        for new in (rows, rated, later.where("s_suppkey % 3 <> 0")):
            upsert_table(spark, name, new, "s_suppkey", "seq", parts=4, buckets=2)

    return from_table(spark, "suppliers", fill)


@named(
    "upsert_null_seq",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'numbered' ELSE 'alone' END AS s_name
       FROM supplier""",
)
def upsert_null_seq(spark, sf_dir):
    """A version without a number loses to one that has it, and stays where it is the only one."""
    key = load(spark, sf_dir, "supplier").select("s_suppkey")
    nothing = F.lit(None).cast("int").alias("seq")
    new = (
        key.select("s_suppkey", F.lit("alone").alias("s_name"), nothing)
        .unionByName(key.where("s_suppkey % 2 = 0").select(
            "s_suppkey", F.lit("numbered").alias("s_name"), F.lit(-1).alias("seq")))
    )
    return upsert(key.where("s_suppkey % 5 = 0").withColumn("s_name", F.lit("old")), new, "s_suppkey", "seq")


@named(
    "table_lifecycle",
    """SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_rating,
              TRUE AS existed, FALSE AS exists_after FROM supplier""",
)
def table_lifecycle(spark, sf_dir):
    """A table is created, filled, given a column, filled again, read and dropped."""
    name = f"suppliers_{uuid.uuid4().hex}"
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    ensure_table(spark, name, fields(s_suppkey=supplier.schema["s_suppkey"].dataType, s_name="string"))
    supplier.where("s_suppkey % 2 <> 0").select("s_suppkey", "s_name").write.insertInto(name)
    ensure_table(
        spark, name,
        fields(s_suppkey=supplier.schema["s_suppkey"].dataType, s_name="string", s_rating="double"),
    )
    rated = supplier.where("s_suppkey % 2 = 0").withColumn("s_rating", F.col("s_acctbal").cast("double"))
    rated.select("s_suppkey", "s_name", "s_rating").write.insertInto(name)
    spark.catalog.refreshTable(name)
    existed = spark.catalog.tableExists(name)
    path = scratch_path(spark, "lifecycle")
    scan_records(spark, name).write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path).select(
        "s_suppkey", "s_name", "s_rating", F.lit(existed).alias("existed"),
        F.lit(spark.catalog.tableExists(name)).alias("exists_after"),
    )


@named(
    "upsert_partial",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
       UNION ALL
       SELECT s_suppkey + 100000000, s_name, NULL, NULL, NULL FROM supplier""",
)
def upsert_partial(spark, sf_dir):
    partial = load(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 100000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.lit(1).alias("seq"),
    )
    return upsert(load(spark, sf_dir, "customer"), partial, "c_custkey", "seq")


_EVOLVED = fields(s_suppkey="long", s_name="string", s_rating="double", s_active="boolean")


@named(
    "evolve_schema",
    """SELECT s_suppkey, s_name, NULL::DOUBLE AS s_rating, NULL::BOOLEAN AS s_active,
              s_nationkey, s_acctbal FROM supplier""",
)
def evolve_schema(spark, sf_dir):
    return ensure_schema(load(spark, sf_dir, "supplier"), _EVOLVED)


_LABEL_FIELDS = fields(doc_id="long", source="integer", quality="integer", toxic="integer")

# the digits of a source are readable as a number, its letters are not
_SQL_INCOMING = f"""
  SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE substr(source, 4) END AS source,
         quality, CASE WHEN lang = 'fr' THEN NULL ELSE toxic END AS toxic FROM ({SQL_LABELLED})
"""
_SQL_CHECKED = f"""
  SELECT *, CASE WHEN quality IS NULL AND toxic IS NULL THEN 'missing: quality, toxic'
                 WHEN quality IS NULL THEN 'missing: quality'
                 WHEN toxic IS NULL THEN 'missing: toxic'
                 WHEN source IS NOT NULL AND try_cast(source AS INTEGER) IS NULL
                 THEN 'type: source' END AS error
  FROM ({_SQL_INCOMING})
"""


def _incoming(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("lang") == "en", F.col("source"))
        .otherwise(F.substring("source", 4, 100))
        .alias("source"),
        "quality",
        F.when(F.col("lang") == "fr", F.lit(None)).otherwise(F.col("toxic")).alias("toxic"),
    )


@named(
    "split_valid",
    f"""SELECT doc_id, try_cast(source AS INTEGER) AS source, quality, toxic
        FROM ({_SQL_CHECKED}) WHERE error IS NULL""",
)
def split_valid_(spark, sf_dir):
    return split_valid(_incoming(spark, sf_dir), _LABEL_FIELDS, ["quality", "toxic"])[0]


@named(
    "split_invalid",
    f"SELECT doc_id, source, quality, toxic, error FROM ({_SQL_CHECKED}) WHERE error IS NOT NULL",
)
def split_invalid(spark, sf_dir):
    return split_valid(_incoming(spark, sf_dir), _LABEL_FIELDS, ["quality", "toxic"])[1]


@named(
    "load_tally",
    f"SELECT coalesce(error, 'ok') AS outcome, count(*) AS n FROM ({_SQL_CHECKED}) GROUP BY 1",
)
def load_tally_(spark, sf_dir):
    return load_tally(_incoming(spark, sf_dir), _LABEL_FIELDS, ["quality", "toxic"])


@named(
    "first_failures",
    f"SELECT doc_id, error FROM ({_SQL_CHECKED}) WHERE error IS NOT NULL ORDER BY doc_id LIMIT 3",
)
def first_failures_(spark, sf_dir):
    refused = split_valid(_incoming(spark, sf_dir), _LABEL_FIELDS, ["quality", "toxic"])[1]
    return first_failures(refused, "doc_id", 3)


def _json_events(spark, sf_dir):
    """Events as an id and a JSON text, whose fields come and go."""
    body = F.to_json(F.struct(
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("kind"),
        F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("user"),
        F.when(F.col("event_id") % 5 == 0, F.struct(F.col("event_id").alias("of"), F.col("event_type").alias("what"))).alias("inner"),
    ))
    return load(spark, sf_dir, "events").select("event_id", body.alias("body"))


@named(
    "json_fields",
    """SELECT * FROM (VALUES ('inner', 'struct<of:bigint,what:string>', true), ('kind', 'string', false), ('user', 'bigint', true))
       AS t(field, type, is_new) WHERE (SELECT count(*) FROM events) > 0""",
)
def json_fields(spark, sf_dir):
    """The fields that the data has, with the types that hold all their values, and which of them a mapping lacks."""
    found = found_fields(_json_events(spark, sf_dir), "body")
    added = new_fields(found, fields(kind="string")).names
    rows = [(f.name, f.dataType.simpleString(), f.name in added) for f in found.fields]
    return spark.createDataFrame(rows, "field string, type string, is_new boolean")


@named(
    "json_mapped",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS kind, CASE WHEN event_id % 3 = 0 THEN user_id END AS user,
              CASE WHEN event_id % 5 = 0 THEN event_id END AS inner_of, CASE WHEN event_id % 5 = 0 THEN event_type END AS inner_what
       FROM events""",
)
def json_mapped(spark, sf_dir):
    """A mapping found in the data, and the rows read by it."""
    events = _json_events(spark, sf_dir)
    typed = typed_json(events, "body", found_fields(events, "body"))
    return typed.select("event_id", "kind", "user", F.col("inner.of").alias("inner_of"), F.col("inner.what").alias("inner_what"))
