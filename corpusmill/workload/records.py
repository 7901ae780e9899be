"""Counts, filters, aggregations and scalar functions over the record-like tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.predicates import (
    all_of, any_of, between_range, contains_any, exists_in, has_text, match, match_keyword, since,
)
from corpusmill.functions.scalars import (
    calendar_parts, extra_keys, iso_format, iso_parse, iso_year, mask_middle, megabytes,
    payload_keys, quarter_label, snippet, text_stats,
)
from corpusmill.operators.aggregates import (
    count_queries, date_histogram, entity_readiness, estimate_entities, latest, profile, stats,
    table_mapping, table_segments, table_stats, terms, wide_gaps,
)
from corpusmill.plans.reports import RecordReport
from corpusmill.sources.files import scan_documents, url_manifest, validate_manifest
from corpusmill.sources.records import Catalog, records_for
from corpusmill.sources.tables import sample_rows
from corpusmill.workload.base import (
    SQL_LABELLED, SQL_ORDER_RECORDS, labelled, load, named, order_records, sql_tokens,
)

# ---------------------------------------------------------------------------
# counts and filters


@named("count_all", "SELECT count(*) AS n FROM events")
def count_all(spark, sf_dir):
    return load(spark, sf_dir, "events").agg(F.count("*").alias("n"))


@named("count_exists", f"SELECT count(quality) AS n FROM ({SQL_LABELLED})")
def count_exists(spark, sf_dir):
    df = labelled(spark, sf_dir)
    return df.agg(F.count_if(exists_in(df, "quality")).alias("n"))


@named(
    "count_should",
    f"""SELECT count(*) FILTER (WHERE quality IS NOT NULL OR lang = 'de') AS n
        FROM ({SQL_LABELLED})""",
)
def count_should(spark, sf_dir):
    df = labelled(spark, sf_dir)
    return df.agg(
        F.count_if(any_of(exists_in(df, "quality"), match_keyword("lang", "de"))).alias("n")
    )


@named(
    "count_must",
    f"""SELECT count(*) FILTER (WHERE quality IS NOT NULL AND length(text) >= 50) AS n
        FROM ({SQL_LABELLED})""",
)
def count_must(spark, sf_dir):
    df = labelled(spark, sf_dir)
    return df.agg(F.count_if(all_of(exists_in(df, "quality"), F.length("text") >= 50)).alias("n"))


@named("range_gt", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 950")
def range_gt(spark, sf_dir):
    return (
        load(spark, sf_dir, "part")
        .where(between_range("p_retailprice", gt=950))
        .select("p_partkey", "p_retailprice")
    )


@named(
    "range_gte",
    "SELECT p_partkey, p_size FROM part WHERE p_size >= 25 AND p_size < 40",
)
def range_gte(spark, sf_dir):
    return (
        load(spark, sf_dir, "part")
        .where(between_range("p_size", gte=25, lt=40))
        .select("p_partkey", "p_size")
    )


@named(
    "since_30d",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY""",
)
def since_30d(spark, sf_dir):
    return (
        load(spark, sf_dir, "orders")
        .where(since("o_orderdate", "30d", "2001-08-01"))
        .select("o_orderkey", "o_orderdate")
    )


@named(
    "match_keyword",
    "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'",
)
def match_keyword_(spark, sf_dir):
    return (
        load(spark, sf_dir, "events")
        .where(match_keyword("event_type", "purchase"))
        .select("event_id", "user_id")
    )


@named(
    "match_any",
    f"""SELECT doc_id FROM documents
        WHERE list_has_any({sql_tokens('text')}, ['nicht', 'étion', 'license'])""",
)
def match_any(spark, sf_dir):
    return (
        load(spark, sf_dir, "documents")
        .where(match("text", "Nicht étion, LICENSE"))
        .select("doc_id")
    )


@named(
    "match_all_tokens",
    f"""SELECT doc_id FROM documents
        WHERE list_has_all({sql_tokens('text')}, ['that', 'is', 'of'])""",
)
def match_all_tokens(spark, sf_dir):
    return (
        load(spark, sf_dir, "documents")
        .where(match("text", "of that is", "and"))
        .select("doc_id")
    )


@named(
    "contains_any",
    """SELECT doc_id FROM documents
       WHERE contains(text, 'rep') OR contains(text, '$') OR contains(text, ', de')""",
)
def contains_any_(spark, sf_dir):
    return (
        load(spark, sf_dir, "documents")
        .where(contains_any("text", ["rep", "$", ", de"]))
        .select("doc_id")
    )


@named(
    "has_text",
    """SELECT conv_id, turn FROM conversations
       WHERE text IS NOT NULL AND length(text) > 0""",
)
def has_text_(spark, sf_dir):
    return load(spark, sf_dir, "conversations").where(has_text("text")).select("conv_id", "turn")


# ---------------------------------------------------------------------------
# aggregations


@named(
    "terms_brand",
    """SELECT p_brand AS key, count(*) AS doc_count FROM part GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 10""",
)
def terms_brand(spark, sf_dir):
    return terms(load(spark, sf_dir, "part"), "p_brand", 10)


@named(
    "terms_priority",
    """SELECT o_orderpriority AS key, count(*) AS doc_count FROM orders GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 5""",
)
def terms_priority(spark, sf_dir):
    return terms(load(spark, sf_dir, "orders"), "o_orderpriority", 5)


@named(
    "stats_price",
    """SELECT count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max,
              round(avg(o_totalprice), 4) AS avg, round(sum(o_totalprice), 2) AS sum
       FROM orders""",
)
def stats_price(spark, sf_dir):
    return stats(load(spark, sf_dir, "orders"), "o_totalprice").withColumns(
        {"avg": F.round("avg", 4), "sum": F.round("sum", 2)}
    )


@named(
    "stats_empty",
    """SELECT count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max,
              avg(o_totalprice) AS avg, sum(o_totalprice) AS sum
       FROM orders WHERE o_totalprice < 0""",
)
def stats_empty(spark, sf_dir):
    df = load(spark, sf_dir, "orders").where(F.col("o_totalprice") < 0)
    return stats(df, "o_totalprice")


def _sql_histogram(table: str, ts: str, unit: str, step: str, where: str = "true") -> str:
    return f"""
      WITH b AS (SELECT CAST(date_trunc('{unit}', {ts}) AS TIMESTAMP) AS key, count(*) AS n
                 FROM {table} WHERE {where} GROUP BY 1),
           g AS (SELECT unnest(generate_series((SELECT min(key) FROM b), (SELECT max(key) FROM b),
                                               INTERVAL {step})) AS key)
      SELECT g.key, coalesce(b.n, 0) AS doc_count FROM g LEFT JOIN b ON g.key = b.key"""


@named(
    "date_histogram_year", _sql_histogram("orders", "o_orderdate", "year", "1 YEAR")
)
def date_histogram_year(spark, sf_dir):
    return date_histogram(load(spark, sf_dir, "orders"), "o_orderdate", "year")


@named(
    "date_histogram_gapfill",
    _sql_histogram("orders", "o_orderdate", "month", "1 MONTH", "o_totalprice > 499000"),
)
def date_histogram_gapfill(spark, sf_dir):
    dear = load(spark, sf_dir, "orders").where(F.col("o_totalprice") > 499000)
    return date_histogram(dear, "o_orderdate", "month")


@named(
    "date_histogram_quarter",
    _sql_histogram("lineitem", "l_shipdate", "quarter", "3 MONTH"),
)
def date_histogram_quarter(spark, sf_dir):
    return date_histogram(load(spark, sf_dir, "lineitem"), "l_shipdate", "quarter")


@named(
    "date_histogram_week",
    _sql_histogram("orders", "o_orderdate", "week", "7 DAY", "o_totalprice > 490000"),
)
def date_histogram_week(spark, sf_dir):
    dear = load(spark, sf_dir, "orders").where(F.col("o_totalprice") > 490000)
    return date_histogram(dear, "o_orderdate", "week")


@named(
    "date_histogram_hour",
    _sql_histogram("events", "ts", "hour", "1 HOUR", "event_type = 'error'"),
)
def date_histogram_hour(spark, sf_dir):
    errors = load(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return date_histogram(errors, "ts", "hour")


_PROFILE_FIELDS = {
    "retailer": 15, "location_city": 20, "region": 15, "customer_priority": 3, "deal_stage": 10,
    "customer_name": 10,
}


def _sql_profile() -> str:
    none = "NULL::DOUBLE"
    tops = " UNION ALL ".join(
        f"""SELECT '{f}' AS agg, key, n AS doc_count, {none} AS min, {none} AS max,
                   {none} AS avg, {none} AS sum
            FROM (SELECT {f} AS key, count(*) AS n FROM r WHERE {f} IS NOT NULL GROUP BY 1
                  ORDER BY 2 DESC, 1 LIMIT {size})"""
        for f, size in _PROFILE_FIELDS.items()
    )
    return f"""
      WITH r AS ({SQL_ORDER_RECORDS}),
           b AS (SELECT CAST(date_trunc('year', timestamp) AS TIMESTAMP) AS key, count(*) AS n
                 FROM r GROUP BY 1),
           g AS (SELECT unnest(generate_series((SELECT min(key) FROM b), (SELECT max(key) FROM b),
                                               INTERVAL 1 YEAR)) AS key)
      {tops}
      UNION ALL
      SELECT 'price', NULL, count(price), min(price), max(price), round(avg(price), 4),
             round(sum(price), 2) FROM r
      UNION ALL
      SELECT 'timestamp', strftime(g.key, '%Y-%m-%d %H:%M:%S'), coalesce(b.n, 0),
             {none}, {none}, {none}, {none} FROM g LEFT JOIN b ON g.key = b.key"""


@named("profile_multi", _sql_profile())
def profile_multi(spark, sf_dir):
    return profile(
        order_records(spark, sf_dir), _PROFILE_FIELDS, ["price"], ("timestamp", "year")
    ).withColumns({"avg": F.round("avg", 4), "sum": F.round("sum", 2)})


def _sql_counts(source: str, predicates: dict[str, str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) FILTER (WHERE {p}) AS n FROM r"
        for name, p in predicates.items()
    )
    return f"WITH r AS ({source}) {parts}"


@named(
    "readiness",
    _sql_counts(
        SQL_ORDER_RECORDS,
        {
            "person_names": "customer_name IS NOT NULL OR customer_priority IS NOT NULL",
            "organizations": "retailer IS NOT NULL",
            "locations": "location_city IS NOT NULL",
            "monetary_values": "price > 0",
            "dates": "timestamp IS NOT NULL",
            "rich_text": "interaction_text IS NOT NULL AND length(interaction_text) >= 50",
        },
    ),
)
def readiness(spark, sf_dir):
    return RecordReport(persons=("customer_name", "customer_priority")).readiness(
        order_records(spark, sf_dir)
    )


@named(
    "readiness_documents",
    _sql_counts(
        SQL_LABELLED,
        {
            "person_names": "quality IS NOT NULL OR toxic IS NOT NULL",
            "organizations": "source IS NOT NULL",
            "locations": "lang IS NOT NULL",
            "monetary_values": "quality > 0",
            "dates": "toxic IS NOT NULL",
            "rich_text": "text IS NOT NULL AND length(text) >= 50",
        },
    ),
)
def readiness_documents(spark, sf_dir):
    return entity_readiness(
        labelled(spark, sf_dir),
        persons=["quality", "toxic"], organization="source", location="lang",
        money="quality", date="toxic", text="text",
    )


@named(
    "named_counts",
    _sql_counts(
        SQL_ORDER_RECORDS,
        {
            "keyword": "region = 'ASIA'",
            "high_value": "price >= 300000",
            "name": f"list_has_any({sql_tokens('region')}, ['middle', 'east'])",
            "recent": "timestamp >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY",
            "words": f"list_has_any({sql_tokens('interaction_text')}, ['building', 'nation'])",
        },
    ),
)
def named_counts(spark, sf_dir):
    return count_queries(
        order_records(spark, sf_dir),
        {
            "keyword": match_keyword("region", "ASIA"),
            "high_value": between_range("price", gte=300000),
            "name": match("region", "Middle East"),
            "recent": since("timestamp", "30d", "2001-08-01"),
            "words": match("interaction_text", "building nation"),
        },
    )


@named(
    "latest_n",
    """SELECT event_id, ts, event_type, CAST(row_number() OVER (ORDER BY ts DESC, event_id)
              AS INTEGER) AS rank
       FROM events ORDER BY ts DESC, event_id LIMIT 50""",
)
def latest_n(spark, sf_dir):
    return latest(load(spark, sf_dir, "events"), "ts", 50, "event_id").select(
        "event_id", "ts", "event_type", "rank"
    )


@named(
    "sample_first",
    "SELECT conv_id, turn, role FROM conversations ORDER BY conv_id * 1000 + turn LIMIT 5",
)
def sample_first(spark, sf_dir):
    df = load(spark, sf_dir, "conversations").withColumn(
        "k", F.col("conv_id") * 1000 + F.col("turn")
    )
    return sample_rows(df, 5, "k", ["conv_id", "turn", "role"]).drop("k")


@named(
    "estimate_entities",
    f"""WITH r AS ({SQL_ORDER_RECORDS})
        SELECT id, CAST(
            (contains(t, 'Customer') OR contains(t, 'Sales rep') OR contains(t, 'rep'))::INT
            + contains(t, '$')::INT
            + (contains(t, 'BUILDING') OR contains(t, 'MACHINERY'))::INT
            + (contains(t, ', ASIA') OR contains(t, ', EUROPE'))::INT AS INTEGER) AS n_entities
        FROM (SELECT id, interaction_text AS t FROM r)""",
)
def estimate_entities_(spark, sf_dir):
    return order_records(spark, sf_dir).select(
        "id",
        estimate_entities(
            "interaction_text",
            retailers=["BUILDING", "MACHINERY"], states=[", ASIA", ", EUROPE"],
        ).alias("n_entities"),
    )


@named(
    "estimate_entities_documents",
    """SELECT doc_id, CAST(
            (contains(t, 'Customer') OR contains(t, 'Sales rep') OR contains(t, 'rep'))::INT
            + contains(t, '$')::INT
            + (contains(t, 'Best Buy') OR contains(t, 'Target') OR contains(t, 'Amazon')
               OR contains(t, 'Walmart'))::INT
            + (contains(t, ', NY') OR contains(t, ', CA') OR contains(t, ', TX')
               OR contains(t, ', FL'))::INT AS INTEGER) AS n_entities
       FROM (SELECT doc_id, text AS t FROM documents)""",
)
def estimate_entities_documents(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", estimate_entities("text").alias("n_entities")
    )


@named(
    "table_stats",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS name, count(*) AS n_rows, 1::BIGINT AS n_files,
                   {n}::BIGINT AS n_columns FROM {t}"""
        for t, n in (("documents", 5), ("events", 6), ("orders", 6))
    ),
)
def table_stats_(spark, sf_dir):
    rows = [
        table_stats(load(spark, sf_dir, t)).select(
            F.lit(t).alias("name"), "n_rows", "n_files", "n_columns"
        )
        for t in ("documents", "events", "orders")
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# types of Spark by those of the SQL engine
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>"}


@named(
    "table_mapping",
    "SELECT table_name AS name, column_name AS \"column\", CASE data_type "
    + " ".join(f"WHEN '{sql}' THEN '{own}'" for sql, own in _TYPES.items())
    + """ END AS type FROM information_schema.columns
         WHERE table_name IN ('documents', 'events', 'orders', 'embeddings', 'customer')""",
)
def table_mapping_(spark, sf_dir):
    found = [
        table_mapping(load(spark, sf_dir, t)).select(F.lit(t).alias("name"), "column", "type")
        for t in ("documents", "events", "orders", "embeddings", "customer")
    ]
    return reduce(DataFrame.unionByName, found)


@named(
    "table_segments",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*)::BIGINT AS n_rows, {n}::BIGINT AS n_columns, true AS filled FROM {t}"
        for t, n in (("documents", 5), ("lineitem", 11), ("orders", 6), ("embeddings", 3))
    ),
)
def table_segments_(spark, sf_dir):
    """The row groups of some tables by their footers: they hold all rows, none is empty, each has every column and bytes."""
    found = []
    for t in ("documents", "lineitem", "orders", "embeddings"):
        df = load(spark, sf_dir, t)
        found.append(table_segments(df).agg(
            F.lit(t).alias("name"), F.sum("n_rows").alias("n_rows"), F.max("n_columns").cast("bigint").alias("n_columns"),
            F.every((F.col("n_rows") > 0) & (F.col("n_bytes") > 0) & (F.col("n_columns") == len(df.columns))).alias("filled"),
        ))
    return reduce(DataFrame.unionByName, found)


@named(
    "wide_gaps",
    """WITH b AS (SELECT date_trunc('month', o_orderdate) AS key, count(*) AS doc_count FROM orders WHERE o_totalprice > 499000 GROUP BY 1),
       n AS (SELECT key, lead(key) OVER (ORDER BY key) AS next, doc_count FROM b)
       SELECT key::TIMESTAMP AS key, next::TIMESTAMP AS next, doc_count, (date_diff('month', key, next) - 1)::BIGINT AS empty
       FROM n WHERE date_diff('month', key, next) - 1 > 1""",
)
def wide_gaps_(spark, sf_dir):
    dear = load(spark, sf_dir, "orders").where(F.col("o_totalprice") > 499000)
    return wide_gaps(dear, "o_orderdate", "month", 1)


@named("table_bytes")
def table_bytes(spark, sf_dir):
    return table_stats(load(spark, sf_dir, "lineitem")).withColumn("mb", megabytes("n_bytes"))


@named("scan_files")
def scan_files(spark, sf_dir):
    # the bytes are never asked for, so no file is opened
    return (
        scan_documents(spark, sf_dir, "*.parquet")
        .groupBy("filetype")
        .agg(F.count("*").alias("n"), F.sum("length").alias("n_bytes"))
    )


# ---------------------------------------------------------------------------
# scalar functions


@named(
    "source_fields",
    "SELECT event_id, event_type FROM events",
)
def source_fields(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", "event_type")


@named(
    "default_value",
    f"""SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'N/A') AS quality,
               coalesce(CAST(toxic AS VARCHAR), 'Unknown') AS toxic FROM ({SQL_LABELLED})""",
)
def default_value(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "doc_id",
        F.coalesce(F.col("quality").cast("string"), F.lit("N/A")).alias("quality"),
        F.coalesce(F.col("toxic").cast("string"), F.lit("Unknown")).alias("toxic"),
    )


@named(
    "snippet_fixed",
    "SELECT doc_id, substr(text, 1, 100) || '...' AS shown FROM documents",
)
def snippet_fixed(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", snippet("text", 100).alias("shown"))


@named(
    "snippet_cond",
    """SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...'
                           ELSE text END AS shown,
              CAST(length(text) AS INTEGER) AS full_length FROM documents""",
)
def snippet_cond(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", snippet("text", 200, always=False).alias("shown"),
        F.length("text").alias("full_length"),
    )


@named(
    "text_stats",
    r"""SELECT doc_id,
               CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> ''))
                    AS INTEGER) AS n_words,
               CAST(length(text) AS INTEGER) AS n_chars FROM documents""",
)
def text_stats_(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", *(c.alias(n) for n, c in text_stats("text").items())
    )


@named(
    "calendar_parts",
    """SELECT o_orderkey, 'Q' || quarter(o_orderdate) AS quarter,
              CAST(year(o_orderdate) AS INTEGER) AS year, monthname(o_orderdate) AS month,
              dayname(o_orderdate) AS day_of_week FROM orders""",
)
def calendar_parts_(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", *(c.alias(n) for n, c in calendar_parts("o_orderdate").items())
    )


@named(
    "quarter_legacy",
    """SELECT 'Q' || (month(o_orderdate) // 3 + 1) AS quarter, count(*) AS n
       FROM orders GROUP BY 1""",
)
def quarter_legacy(spark, sf_dir):
    return (
        load(spark, sf_dir, "orders")
        .groupBy(quarter_label("o_orderdate", "legacy").alias("quarter"))
        .agg(F.count("*").alias("n"))
    )


@named(
    "iso_times",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
              CAST(date_trunc('second', ts) AS TIMESTAMP) AS parsed,
              CAST(year(ts) AS INTEGER) AS year FROM events""",
)
def iso_times(spark, sf_dir):
    iso = load(spark, sf_dir, "events").select("event_id", iso_format("ts").alias("iso"))
    zoned = F.concat("iso", F.lit("Z"))
    return iso.select(
        "event_id", "iso", iso_parse(zoned).alias("parsed"), iso_year(zoned).alias("year")
    )


@named(
    "replace_title",
    """SELECT n_nationkey, replace(n_name, '_', ' ') AS spaced,
              upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS title FROM nation""",
)
def replace_title(spark, sf_dir):
    return load(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.replace("n_name", F.lit("_"), F.lit(" ")).alias("spaced"),
        F.initcap("n_name").alias("title"),
    )


@named(
    "number_format",
    """SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS shown,
              round(o_totalprice / 1048576.0, 2) AS mb FROM orders""",
)
def number_format(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.format_number("o_totalprice", 2).alias("shown"),
        megabytes("o_totalprice").alias("mb"),
    )


@named(
    "mask_middle",
    """SELECT page_id, CASE WHEN length(url) > 20 THEN left(url, 10) || '...' || right(url, 10)
                            ELSE repeat('*', length(url)) END AS masked FROM pages
       UNION ALL
       SELECT p_partkey, CASE WHEN length(p_name) > 20
              THEN left(p_name, 10) || '...' || right(p_name, 10)
              ELSE repeat('*', length(p_name)) END FROM part""",
)
def mask_middle_(spark, sf_dir):
    return (
        load(spark, sf_dir, "pages")
        .select("page_id", mask_middle("url").alias("masked"))
        .union(load(spark, sf_dir, "part").select("p_partkey", mask_middle("p_name")))
    )


_SQL_MANIFEST = """
  SELECT page_id, url, CASE WHEN ends_with(f, '.pdf') THEN f ELSE f || '.pdf' END AS filename
  FROM (SELECT page_id, url, split_part(url, '/', -1) AS f FROM pages)
"""


@named(
    "url_manifest",
    f"""SELECT page_id, filename, 'workflow-docs/pdf/' || filename AS object_key
        FROM ({_SQL_MANIFEST})""",
)
def url_manifest_(spark, sf_dir):
    return url_manifest(load(spark, sf_dir, "pages")).select("page_id", "filename", "object_key")


@named(
    "manifest_valid",
    """SELECT page_id, content_type,
              NOT (contains(lower(content_type), 'pdf')
                   OR contains(lower(content_type), 'application/octet-stream')) AS type_warning,
              n <= 0 AS rejected
       FROM (SELECT page_id,
                    CASE WHEN contains(url, '.com') THEN 'Application/PDF'
                         WHEN contains(url, '.net') THEN 'application/octet-stream'
                         ELSE 'text/html' END AS content_type,
                    CASE WHEN contains(url, '#') THEN 0 ELSE length(html) END AS n
             FROM pages)""",
)
def manifest_valid(spark, sf_dir):
    manifest = load(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.contains("url", F.lit(".com")), F.lit("Application/PDF"))
        .when(F.contains("url", F.lit(".net")), F.lit("application/octet-stream"))
        .otherwise(F.lit("text/html"))
        .alias("content_type"),
        F.when(F.contains("url", F.lit("#")), F.lit(0)).otherwise(F.length("html")).alias("length"),
    )
    return validate_manifest(manifest).select("page_id", "content_type", "type_warning", "rejected")


_SQL_PAYLOAD = """
  SELECT doc_id, to_json(struct_pack(type := lang, category := source, n_chars := n_chars,
                                     props := struct_pack(x := 1))) AS payload FROM documents
"""


def _payload(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        F.to_json(
            F.struct(
                F.col("lang").alias("type"), F.col("source").alias("category"), "n_chars",
                F.struct(F.lit(1).alias("x")).alias("props"),
            )
        ).alias("payload"),
    )


@named(
    "payload_keys",
    f"""SELECT doc_id AS id, array_to_string(json_keys(payload), ',') AS keys
        FROM ({_SQL_PAYLOAD})
        UNION ALL SELECT event_id, array_to_string(json_keys(props), ',') FROM events""",
)
def payload_keys_(spark, sf_dir):
    return (
        _payload(spark, sf_dir)
        .select(
            F.col("doc_id").alias("id"), F.array_join(payload_keys("payload"), ",").alias("keys")
        )
        .union(
            load(spark, sf_dir, "events").select(
                "event_id", F.array_join(payload_keys("props"), ",")
            )
        )
    )


@named(
    "extra_fields",
    f"""SELECT doc_id, array_to_string(list_filter(json_keys(payload),
               lambda k: k NOT IN ('metadata', 'type', 'category', 'text')), ', ') AS extra
        FROM ({_SQL_PAYLOAD})""",
)
def extra_fields(spark, sf_dir):
    return _payload(spark, sf_dir).select(
        "doc_id", F.array_join(extra_keys(payload_keys("payload")), ", ").alias("extra")
    )


# ---------------------------------------------------------------------------
# generated records


def _sql_records(seed: int, start: str, span: int) -> str:
    """The draws of the generator, written against digests h0 … h4 of the order key."""
    c = Catalog()

    def quoted(values) -> str:
        return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"

    def raw(position: int) -> str:
        block, slot = divmod(position, 4)
        return f"CAST('0x' || substr(h{block}, {slot * 8 + 1}, 8) AS BIGINT)"

    def pick(position: int, values) -> str:
        values = list(values)
        return f"{quoted(values)}[{raw(position)} % {len(values)} + 1]"

    def numbers(values) -> str:
        return "[" + ", ".join(map(str, values)) + "]"

    def filled(template: str) -> str:
        holes = {
            "customer": "customer_name", "city": "location_city", "region": "region",
            "model": "product_model", "line": "product_line", "rep": "sales_representative",
            "retailer": "retailer", "price": "p", "deposit": "(p // 10)",
            "topic": "replace(interaction_type, '_', ' ')",
        }
        sql = "'" + template.replace("'", "''") + "'"
        for hole, column in holes.items():
            sql = sql.replace("{" + hole + "}", f"' || {column} || '")
        return sql

    cases = " ".join(
        f"WHEN '{kind}' THEN {filled(t)}" for kind, t in c.interactions.items() if t is not None
    )
    models = [m for line in c.lines for m in line.models]
    n_models = len(models) // len(c.lines)
    digests = ", ".join(f"md5('{seed}:{b}:' || o_orderkey) AS h{b}" for b in range(5))
    return f"""
      WITH d AS (SELECT md5('{seed}:uuid:' || o_orderkey) AS u, {digests} FROM orders),
      a AS (SELECT *, CAST({raw(0)} % {len(c.lines)} AS INTEGER) AS line FROM d),
      b AS (SELECT *, {numbers(x.low for x in c.lines)}[line + 1]
                + {raw(2)} % ({numbers(x.high for x in c.lines)}[line + 1]
                              - {numbers(x.low for x in c.lines)}[line + 1] + 1) AS p,
             CAST(TIMESTAMP '{start}' + to_seconds({raw(10)} % {span}) AS TIMESTAMP) AS timestamp,
             {pick(3, c.first_names)} || ' ' || {pick(4, c.last_names)} AS customer_name,
             {pick(5, c.representatives)} AS sales_representative,
             {pick(6, c.retailers)} AS retailer, {pick(7, c.cities)} AS location_city,
             {pick(8, c.regions)} AS region, {pick(9, c.interactions)} AS interaction_type,
             {quoted(x.name for x in c.lines)}[line + 1] AS product_line,
             {quoted(models)}[line * {n_models} + {raw(1)} % {n_models} + 1] AS product_model
           FROM a),
      t AS (SELECT *, CASE interaction_type {cases} ELSE {filled(c.fallback)} END AS tx FROM b)
      SELECT substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-4' || substr(u, 14, 3) || '-a'
             || substr(u, 18, 3) || '-' || substr(u, 21, 12) AS id,
             timestamp, customer_name, sales_representative, product_line, product_model,
             {quoted(x.category for x in c.lines)}[line + 1] AS product_category,
             CAST(p AS DOUBLE) AS price, retailer, location_city, region, interaction_type,
             tx AS interaction_text, tx AS text, 'Q' || quarter(timestamp) AS quarter,
             CAST(year(timestamp) AS INTEGER) AS year, monthname(timestamp) AS month,
             dayname(timestamp) AS day_of_week, {pick(11, c.segments)} AS customer_segment,
             {pick(12, c.channels)} AS sales_channel, {pick(13, c.lead_sources)} AS lead_source,
             {pick(14, c.deal_stages)} AS deal_stage,
             CAST(p * (1 + {raw(15)} % 5) AS DOUBLE) AS revenue_potential,
             {pick(16, c.priorities)} AS customer_priority,
             {raw(17)} % 2 = 0 AS follow_up_required, {filled(c.notes)} AS notes
      FROM t"""


@named("generate_records", _sql_records(42, "2016-01-01", 315619200))
def generate_records_(spark, sf_dir):
    return records_for(load(spark, sf_dir, "orders"), "o_orderkey", seed=42)


@named(
    "generated_profile",
    f"""WITH r AS ({_sql_records(42, "2016-01-01", 315619200)})
        SELECT 'product_line' AS agg, product_line AS key, count(*) AS doc_count FROM r GROUP BY 2
        UNION ALL SELECT 'region', region, count(*) FROM r GROUP BY 2
        UNION ALL SELECT 'price', NULL, count(*) FROM r""",
)
def generated_profile(spark, sf_dir):
    records = records_for(load(spark, sf_dir, "orders"), "o_orderkey", seed=42)
    return profile(records, {"product_line": 10, "region": 15}, ["price"]).select(
        "agg", "key", "doc_count"
    )
