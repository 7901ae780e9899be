"""Counts, top terms, statistics, histograms and reports over one scan each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.predicates import all_of, any_of, contains_any, exists_in

INTERVALS = ("year", "quarter", "month", "week", "day", "hour", "minute")

# fixed values: the word lists of the entity estimate
PERSON_WORDS = ("Customer", "Sales rep", "rep")
RETAILER_NAMES = ("Best Buy", "Target", "Amazon", "Walmart")
STATE_SUFFIXES = (", NY", ", CA", ", TX", ", FL")


def terms(df: DataFrame, field: str, size: int) -> DataFrame:
    """The ``size`` most frequent values: key, doc_count. NULL is no value."""
    return (
        df.where(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("key"))
        .agg(F.count("*").alias("doc_count"))
        .orderBy(F.desc("doc_count"), "key")
        .limit(size)
    )


def stats(df: DataFrame, field: str) -> DataFrame:
    """count, min, max, avg and sum of a number; all but the count NULL on no rows."""
    c = F.col(field)
    return df.agg(
        F.count(c).alias("count"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.avg(c).alias("avg"),
        F.sum(c).alias("sum"),
    )


def bucket_start(ts: Column | str, interval: str) -> Column:
    """The first moment of the calendar bucket, independent of the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {INTERVALS}: {interval!r}")
    if interval in ("hour", "minute"):
        width = 13 if interval == "hour" else 16
        text = F.substring(ts.cast("timestamp_ntz").cast("string"), 1, width)
        return F.concat(text, F.lit(":00" if interval == "hour" else "")).cast("timestamp_ntz")
    day = ts.cast("date")
    start = day if interval == "day" else F.trunc(day, interval)
    return start.cast("timestamp_ntz")


def _step(interval: str) -> str:
    return "INTERVAL 3 MONTH" if interval == "quarter" else f"INTERVAL 1 {interval.upper()}"


def _with_next(buckets: DataFrame) -> DataFrame:
    """Adds ``_next``, the key of the following bucket; NULL for the last; and ``_year``.

    Buckets are compared inside their year, so a task gets 527,040 of them at most. Then only the first and the last of
    each year meet: as many rows as the calendar has years, twice.
    """
    inside = Window.partitionBy("_year").orderBy("key")
    dated = buckets.withColumn("_year", F.year("key")).withColumns(
        {"_within": F.lead("key").over(inside), "_before": F.lag("key").over(inside)}
    )
    ends = F.when(F.col("_within").isNull() | F.col("_before").isNull(), F.lit(0)).otherwise(F.col("_year"))
    across = F.lead("key").over(Window.partitionBy(ends).orderBy("key"))
    return dated.withColumn("_next", F.coalesce("_within", across)).drop("_within", "_before")


def _first_in_year(year: Column, interval: str) -> Column:
    """The first bucket that begins in a year."""
    new_year = F.make_date(year, F.lit(1), F.lit(1))
    if interval != "week":
        return new_year.cast("timestamp_ntz")
    monday = F.trunc(new_year, "week")
    return F.when(monday < new_year, F.date_add(monday, 7)).otherwise(monday).cast("timestamp_ntz")


# average lengths, to tell how many buckets a gap has before it is filled
_SECONDS = {"year": 31_556_952, "quarter": 7_889_238, "month": 2_629_746, "week": 604_800, "day": 86_400, "hour": 3600, "minute": 60}


def _gap(interval: str) -> Column:
    """About how many empty buckets lie between a bucket and the next."""
    apart = F.unix_seconds(F.col("_next").cast("timestamp")) - F.unix_seconds(F.col("key").cast("timestamp"))
    return F.greatest(F.round(F.coalesce(apart, F.lit(0)) / _SECONDS[interval]).cast("bigint") - 1, F.lit(0))


def fill_gaps(buckets: DataFrame, interval: str, carry: Sequence[str] = (), max_gap: int | None = None) -> DataFrame:
    """Adds the empty buckets between the first and the last (columns key, doc_count).

    Every bucket yields the empty ones up to its successor, which also take its
    ``carry`` columns. This runs on the aggregated buckets, so the data itself is scanned once. A gap is
    filled year by year, in rows of their own, so no array is longer than a year of buckets. A gap of more than
    ``max_gap`` empty buckets, as one stray time makes it, fails the job and names the times around it.
    """
    step = F.expr(_step(interval))
    chained = _with_next(buckets)
    if max_gap is not None:
        text = F.concat(
            F.lit(f"more than {max_gap} empty buckets between "), F.col("key").cast("string"), F.lit(" and "), F.col("_next").cast("string")
        )
        chained = chained.withColumn("_next", F.when(_gap(interval) > max_gap, F.raise_error(text).cast("timestamp_ntz")).otherwise(F.col("_next")))
    last = F.coalesce(F.col("_next") - step, F.col("key"))
    spans = chained.withColumn("_last", last).select(
        *carry, "doc_count", F.col("key").alias("_first"), "_last", "_year",
        F.explode(F.sequence(F.col("_year"), F.greatest(F.year("_last"), F.col("_year")))).alias("_in"),
    )
    begin = F.when(F.col("_in") == F.col("_year"), F.col("_first")).otherwise(_first_in_year(F.col("_in"), interval))
    end = F.least(F.col("_last"), _first_in_year(F.col("_in") + 1, interval) - step)
    # a year may end between two buckets of a week
    return spans.withColumn("_begin", begin).withColumn("_end", F.greatest(end, F.when(F.col("_in") == F.col("_year"), F.col("_first")))).where(
        F.col("_begin") <= F.col("_end")
    ).select(
        *carry, "doc_count", "_first", F.explode(F.sequence("_begin", "_end", step)).alias("key")
    ).select(
        *carry,
        "key",
        F.when(F.col("key") == F.col("_first"), F.col("doc_count")).otherwise(F.lit(0)).cast("bigint").alias("doc_count"),
    )


def _buckets(df: DataFrame, ts: str, interval: str) -> DataFrame:
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(bucket_start(ts, interval).alias("key"))
        .agg(F.count("*").alias("doc_count"))
    )


def date_histogram(df: DataFrame, ts: str, interval: str = "year", max_gap: int | None = None) -> DataFrame:
    """Rows per calendar bucket from the first to the last, empty ones included; see :func:`fill_gaps` for ``max_gap``."""
    return fill_gaps(_buckets(df, ts, interval), interval, max_gap=max_gap).orderBy("key")


def wide_gaps(df: DataFrame, ts: str, interval: str, least: int) -> DataFrame:
    """Gaps of more than ``least`` empty buckets: the buckets around each, their rows and about how many are empty.

    To be looked at before a histogram of stray times is filled.
    """
    chained = _with_next(_buckets(df, ts, interval)).withColumn("empty", _gap(interval)).where(F.col("empty") > least)
    return chained.select("key", F.col("_next").alias("next"), "doc_count", "empty").orderBy("key")


def profile(
    df: DataFrame,
    fields: Mapping[str, int],
    metrics: Sequence[str] = (),
    histogram: tuple[str, str] | None = None,
) -> DataFrame:
    """Many aggregations in one scan and one shuffle.

    ``fields`` maps a field to the number of top terms, ``metrics`` are numbers
    to take statistics of, ``histogram`` is (time field, interval). The result
    is long: agg, key, doc_count, min, max, avg, sum. The rows of one record
    are combined in the scanning task already, so what is shuffled grows with
    the number of different values and not with the number of records.
    """
    none_text, none_num = F.lit(None).cast("string"), F.lit(None).cast("double")
    terms_kind, stats_kind, histogram_kind = 0, 1, 2

    def entry(kind: int, agg: str, key: Column, num: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(agg).alias("agg"), key.alias("key"), num.alias("num")
        )

    entries = [entry(terms_kind, f, F.col(f).cast("string"), none_num) for f in fields]
    entries += [entry(stats_kind, m, none_text, F.col(m).cast("double")) for m in metrics]
    if histogram:
        ts, interval = histogram
        if ts in fields:
            raise ValueError(f"{ts} cannot be a term and a histogram at once")
        start = bucket_start(ts, interval).cast("string")
        entries.append(entry(histogram_kind, ts, start, none_num))
    grouped = (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("key").isNotNull() | (F.col("kind") == stats_kind))
        .groupBy("agg", "key")
        .agg(
            # An aggregate and no grouping key: a filter on it stays above the
            # aggregation, so that the parts below share one scan and shuffle.
            # A number, as a string here would force a sort of all rows.
            F.max("kind").alias("kind"),
            F.count_if((F.col("kind") != stats_kind) | F.col("num").isNotNull()).alias("doc_count"),
            F.min("num").alias("min"),
            F.max("num").alias("max"),
            F.avg("num").alias("avg"),
            F.sum("num").alias("sum"),
        )
    )
    columns = ["agg", "key", "doc_count", "min", "max", "avg", "sum"]
    parts = []
    if metrics:
        parts.append(grouped.where(F.col("kind") == stats_kind).select(*columns))
    if fields:
        sizes = F.create_map(*(F.lit(x) for pair in fields.items() for x in pair))
        order = Window.partitionBy("agg").orderBy(F.desc("doc_count"), "key")
        parts.append(
            grouped.where(F.col("kind") == terms_kind)
            .withColumn("_rank", F.row_number().over(order))
            # the constant bound is applied in the tasks before a field is brought together
            .where(F.col("_rank") <= max(fields.values()))
            .where(F.col("_rank") <= F.try_element_at(sizes, F.col("agg")))
            .select(*columns)
        )
    if histogram:
        buckets = grouped.where(F.col("kind") == histogram_kind).withColumn(
            "key", F.col("key").try_cast("timestamp_ntz")
        )
        parts.append(
            fill_gaps(buckets, histogram[1], ["agg", "min", "max", "avg", "sum"])
            .withColumn("key", F.col("key").cast("string"))
            .select(*columns)
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def count_queries(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows under each predicate, all in one aggregation: name, n."""
    counted = df.agg(*(F.count_if(p).alias(name) for name, p in predicates.items()))
    pairs = F.array(
        *(F.struct(F.lit(name).alias("name"), F.col(f"`{name}`").alias("n")) for name in predicates)
    )
    return counted.select(F.inline(pairs))


def entity_readiness(
    df: DataFrame,
    *,
    persons: Sequence[str],
    organization: str,
    location: str,
    money: str,
    date: str,
    text: str,
    min_chars: int = 50,
) -> DataFrame:
    """Records fit for entity extraction, by entity category: name, n."""
    return count_queries(
        df,
        {
            "person_names": any_of(*(exists_in(df, p) for p in persons)),
            "organizations": exists_in(df, organization),
            "locations": exists_in(df, location),
            "monetary_values": F.coalesce(F.col(money) > 0, F.lit(False)),
            "dates": exists_in(df, date),
            "rich_text": all_of(exists_in(df, text), F.length(text) >= min_chars),
        },
    )


def estimate_entities(
    text: Column | str,
    persons: Sequence[str] = PERSON_WORDS,
    retailers: Sequence[str] = RETAILER_NAMES,
    states: Sequence[str] = STATE_SUFFIXES,
) -> Column:
    """0 to 4: a person word, a dollar sign, a retailer, a state, each found or not."""
    tests = (
        contains_any(text, persons),
        contains_any(text, ["$"]),
        contains_any(text, retailers),
        contains_any(text, states),
    )
    return sum((t.cast("int") for t in tests[1:]), tests[0].cast("int"))


def latest(df: DataFrame, ts: str, n: int, key: str) -> DataFrame:
    """The newest rows, numbered from 1. The key decides between equal times."""
    order = [F.desc_nulls_last(ts), F.asc(key)]
    newest = df.orderBy(*order).limit(n)
    # at most n rows are left to number
    return newest.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def table_stats(df: DataFrame, *, files: bool = True) -> DataFrame:
    """One row: rows, columns, and for a file source its files and bytes."""
    columns = F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    if not files:
        return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", columns)
    # the names as the scan lists them, files without rows included; their sizes are metadata
    paths = [unquote(f) for f in df.inputFiles()]
    rows = df.agg(F.count("*").alias("n_rows"))
    if not paths:
        zero = F.lit(0).cast("bigint")
        return rows.select("n_rows", zero.alias("n_files"), zero.alias("n_bytes"), columns)
    listed = df.sparkSession.read.format("binaryFile").load(paths).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )
    return rows.select("n_rows", *(listed.select(c).scalar().alias(c) for c in listed.columns), columns)


def table_segments(df: DataFrame) -> DataFrame:
    """One row per row group of a parquet source: path, row_group, n_rows, n_bytes, raw_bytes, n_columns, codec, created_by.

    Footers are read in tasks, files dealt over them; no page of data is. Works for folders that pyarrow can open
    by their address.
    """

    def footers(batches):
        for batch in batches:
            yield pd.concat([_row_groups(path) for path in batch["path"]], ignore_index=True)

    return _files(df).mapInPandas(
        footers, "path string, row_group int, n_rows bigint, n_bytes bigint, raw_bytes bigint, n_columns int, codec string, created_by string"
    )


def _files(df: DataFrame) -> DataFrame:
    """The addresses of the files of a frame, as the scan writes them, some to a task."""
    spark, paths = df.sparkSession, sorted(df.inputFiles())
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    return rows.repartition(max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4)), "path")


def _row_groups(path: str):
    import pyarrow.fs
    import pyarrow.parquet

    fs, name = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as file:
        footer = pyarrow.parquet.ParquetFile(file).metadata
    rows = []
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        columns = [group.column(i) for i in range(group.num_columns)]
        rows.append((
            unquote(path), g, group.num_rows, sum(c.total_compressed_size for c in columns), sum(c.total_uncompressed_size for c in columns),
            group.num_columns, ",".join(sorted({c.compression for c in columns})), footer.created_by,
        ))
    return pd.DataFrame(rows, columns=["path", "row_group", "n_rows", "n_bytes", "raw_bytes", "n_columns", "codec", "created_by"])


def table_mapping(df: DataFrame) -> DataFrame:
    """One row per column, nested fields included: column (with dots), type, nullable."""

    def walk(kind, prefix: str):
        for f in kind.fields:
            yield f"{prefix}{f.name}", f.dataType.simpleString(), f.nullable
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, f"{prefix}{f.name}.")

    return df.sparkSession.createDataFrame(list(walk(df.schema, "")), "column string, type string, nullable boolean")


def run_summary(stages: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per stage: rows, and how many of them carry a value in the named column."""
    rows = [
        df.agg(F.count("*").alias("n_rows"), F.count(column).alias("n_filled")).select(
            F.lit(name).alias("stage"), "n_rows", "n_filled"
        )
        for name, (df, column) in stages.items()
    ]
    summary = rows[0]
    for row in rows[1:]:
        summary = summary.unionByName(row)
    return _with_status(summary)


def stage_rows(totals: DataFrame, stages: Sequence[str]) -> DataFrame:
    """The rows of :func:`run_summary` from one row with the columns ``stage`` and ``stage_filled`` of each."""
    each = F.array(
        *(
            F.struct(
                F.lit(s).alias("stage"), F.col(s).cast("long").alias("n_rows"),
                F.col(f"{s}_filled").cast("long").alias("n_filled"),
            )
            for s in stages
        )
    )
    return _with_status(totals.select(F.inline(each)))


def _with_status(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "status", F.when(F.col("n_rows") > 0, F.lit("COMPLETED")).otherwise(F.lit("EMPTY"))
    )
