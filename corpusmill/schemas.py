"""Schemas of the library and the operators that hold data to a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fields(**types: str | T.DataType) -> T.StructType:
    """A struct type from field names and types; needs no running session."""
    struct = T.StructType()
    for name, kind in types.items():
        struct.add(name, kind)
    return struct


# fixed values: field names and types of a record
RECORD_SCHEMA = fields(
    id="string", timestamp="timestamp_ntz", customer_name="string",
    sales_representative="string", product_line="string", product_model="string",
    product_category="string", price="double", retailer="string", location_city="string",
    region="string", interaction_type="string", interaction_text="string", text="string",
    quarter="string", year="integer", month="string", day_of_week="string",
    customer_segment="string", sales_channel="string", lead_source="string",
    deal_stage="string", revenue_potential="double", customer_priority="string",
    follow_up_required="boolean", notes="string",
)

# fixed values: what a hand-written single record carries; the other fields stay NULL
PARTIAL_RECORD_FIELDS = (
    "id", "timestamp", "customer_name", "sales_representative", "product_line",
    "product_model", "price", "retailer", "location_city", "region", "interaction_type",
    "interaction_text", "text", "quarter", "year", "month", "day_of_week",
)

METADATA_TYPE = fields(filename="string", filetype="string", page_number="integer")

POINT_SCHEMA = fields(
    id="string",
    vector=T.ArrayType(T.FloatType()),
    payload=fields(type="string", category="string", text="string", metadata=METADATA_TYPE),
)


class SchemaConflict(ValueError):
    """A column exists with another type than the declared one."""


def ensure_schema(df: DataFrame, declared: T.StructType, *, extras: bool = True) -> DataFrame:
    """Adds what is missing as NULL and refuses a change of type.

    Columns the declaration does not name follow the declared ones, or are
    dropped when ``extras`` is off.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    clashes = [
        f"{f.name}: {present[f.name].simpleString()} is not {f.dataType.simpleString()}"
        for f in declared.fields
        if f.name in present and present[f.name].simpleString() != f.dataType.simpleString()
    ]
    if clashes:
        raise SchemaConflict("; ".join(clashes))
    columns = [
        F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in declared.fields
    ]
    if extras:
        columns += [F.col(n) for n in present if n not in declared.names]
    return df.select(*columns)


def _own_type(kind: T.DataType) -> T.DataType:
    """The column type for a type found in JSON: fractions are doubles, what is only ever null is a string."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.LongType()
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_own_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _own_type(f.dataType)) for f in kind.fields])
    return kind


def found_fields(df: DataFrame, text: str) -> T.StructType:
    """The fields of the JSON objects in a column, over all rows, with the type that holds all their values.

    Values of kinds that no type holds make a field ``VARIANT``. Text that is no JSON object is passed over. The types are
    merged in the tasks and then together, so only one type reaches the driver.
    """
    value = F.try_parse_json(F.col(text))
    objects = F.when(F.schema_of_variant(value).startswith("OBJECT"), value)
    found = df.agg(F.schema_of_variant_agg(objects)).first()[0]
    if not found or not found.startswith("OBJECT"):
        return T.StructType([])
    kind = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
    return T.StructType([T.StructField(f.name, _own_type(f.dataType)) for f in kind.fields])


def new_fields(found: T.StructType, declared: T.StructType) -> T.StructType:
    """The found fields that the declaration lacks; refuses one that it has with a type that cannot hold the values."""
    known = {f.name: f.dataType for f in declared.fields}
    widens = {("bigint", "double"), ("bigint", "string"), ("double", "string"), ("boolean", "string"), ("int", "bigint")}
    clashes = []
    for f in found.fields:
        have, want = f.dataType.simpleString(), known[f.name].simpleString() if f.name in known else None
        if want is None or have == want or (have, want) in widens or (have, want) == ("bigint", "int"):
            continue
        clashes.append(f"{f.name}: {have} is not {want}")
    if clashes:
        raise SchemaConflict("; ".join(clashes))
    return T.StructType([f for f in found.fields if f.name not in known])


def typed_json(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """The column replaced by the fields of the schema, read out of its JSON; a missing field, or a value that does not fit, is NULL."""
    value = F.try_parse_json(F.col(text)).alias("_value")
    columns = [
        F.try_variant_get("_value", F.lit(f"$['{f.name}']"), f.dataType.simpleString()).alias(f.name) for f in schema.fields
    ]
    return df.select("*", value).select(*(c for c in df.columns if c != text), *columns)


def ensure_table(spark: SparkSession, name: str, declared: T.StructType) -> None:
    """Creates the table, or adds the columns it lacks; refuses a change of type."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], declared).write.mode("ignore").saveAsTable(name)
        return
    present = spark.table(name)
    ensure_schema(present, declared)
    missing = [f for f in declared.fields if f.name not in present.columns]
    if missing:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")


def missing_required(names: list[str]) -> Column:
    """Names of the required fields that hold no value in this row (NULL or empty)."""
    return F.array_compact(
        F.array(
            *(
                F.when(F.coalesce(F.length(F.col(n).cast("string")) == 0, F.lit(True)), F.lit(n))
                for n in names
            )
        )
    )


def check_rows(df: DataFrame, declared: T.StructType, required: list[str]) -> DataFrame:
    """Casts each declared field and adds ``error``: NULL for a good row, else the reason.

    The reason names every required field without a value (``missing: a, b``)
    or else every field whose value cannot be read as its type
    (``type: a, b``), so its variety is bounded by the schema, not by the data.
    """
    by_name = {f.name: f for f in declared.fields if f.name in df.columns}
    cast = {n: F.col(n).try_cast(f.dataType) for n, f in by_name.items()}
    unreadable = F.array_compact(
        F.array(
            *(F.when(F.col(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in cast.items())
        ).cast("array<string>")
    )
    absent = missing_required(required)
    reason = F.when(
        F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", "))
    ).when(F.size(unreadable) > 0, F.concat(F.lit("type: "), F.array_join(unreadable, ", ")))
    return df.withColumn("error", reason)


def split_valid(
    df: DataFrame, declared: T.StructType, required: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, typed and without ``error``; rows that do not, as they came)."""
    checked = check_rows(df, declared, required)
    typed = [
        F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in declared.fields
        if f.name in df.columns
    ]
    extras = [F.col(n) for n in df.columns if n not in declared.names]
    good = checked.where(F.col("error").isNull()).select(*typed, *extras)
    return good, checked.where(F.col("error").isNotNull())


def load_tally(df: DataFrame, declared: T.StructType, required: list[str]) -> DataFrame:
    """Rows per outcome of a load: ``ok`` and each failure reason."""
    checked = check_rows(df, declared, required)
    return checked.groupBy(F.coalesce("error", F.lit("ok")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


def first_failures(bad: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first failures by key, for display."""
    return bad.select(key, "error").orderBy(key).limit(n)
