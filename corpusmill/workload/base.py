"""The registry of named queries and what several of them share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.session import scratch_path
from corpusmill.sinks.tables import read_table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Named:
    run: Run
    sql: str | None


REGISTRY: dict[str, Named] = {}


def named(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Registers a query and the SQL that gives the same result."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered already")
        REGISTRY[name] = Named(run, sql)
        return run

    return register


# schemas by path, so that the footer of a table is asked for its schema once
_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def from_table(spark: SparkSession, label: str, fill: Callable[[str], object]) -> DataFrame:
    """The rows of a catalog table that ``fill`` has written, given its name, in the shared folder; the table is dropped."""
    name, path = f"{label}_{uuid.uuid4().hex}", scratch_path(spark, label)
    try:
        fill(name)
        read_table(spark, name).write.parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(path)


def sql_tokens(text: str) -> str:
    return (
        rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), "
        "lambda t: t <> '')"
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer, nation and region in the fields of a sales record.

    The joins are left to the planner, which broadcasts the two fixed-size
    tables by their statistics and shuffles orders and customers when both are
    large.
    """
    orders, customer, nation, region = (
        load(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")
    )
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
    )
    text = F.concat(
        F.lit("Order "), F.col("o_orderkey").cast("string"),
        F.lit(" by Customer "), F.col("c_name"),
        F.lit(" of "), F.col("n_name"),
        F.lit(", "), F.col("r_name"),
        F.lit(" on "), F.col("o_orderdate").cast("date").cast("string"),
        F.lit(" for $"), F.format_string("%.2f", "o_totalprice"),
        F.lit(", "), F.col("c_mktsegment"), F.lit(" rate."),
    )
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("retailer"),
        F.col("n_name").alias("location_city"),
        F.col("r_name").alias("region"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("customer_priority"),
        F.col("o_orderstatus").alias("deal_stage"),
        text.alias("interaction_text"),
    )


SQL_ORDER_RECORDS = """
  SELECT o_orderkey AS id, o_orderdate AS timestamp, c_name AS customer_name,
         c_mktsegment AS retailer, n_name AS location_city, r_name AS region,
         o_totalprice AS price, o_orderpriority AS customer_priority,
         o_orderstatus AS deal_stage,
         'Order ' || o_orderkey || ' by Customer ' || c_name || ' of ' || n_name || ', '
         || r_name || ' on ' || strftime(o_orderdate, '%Y-%m-%d') || ' for $'
         || printf('%.2f', o_totalprice) || ', ' || c_mktsegment || ' rate.' AS interaction_text
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, NULL where there are none."""
    return load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")


SQL_LABELLED = """
  SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
