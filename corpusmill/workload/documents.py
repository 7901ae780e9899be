"""Cleaning, partitioning, chunking, embedding and entities over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.predicates import tokens
from corpusmill.functions.references import decode_references
from corpusmill.operators.chunk import chunk_by_title
from corpusmill.operators.clean import strip_inline_images
from corpusmill.operators.embed import embed_hashed, embed_with, hashed_counts, hashed_sparse
from corpusmill.operators.entities import extract_entities, gazetteer_entities, pattern_entities
from corpusmill.operators.hybrid import hybrid_corpus
from corpusmill.operators.outline import outline_html
from corpusmill.operators.partition import (
    html_elements, partition_html, partition_text, partition_with,
)
from corpusmill.plans.arrivals import load_arrivals
from corpusmill.plans.flow import DocumentFlow
from corpusmill.session import scratch_path
from corpusmill.sinks.text import write_clean_text
from corpusmill.sources.files import scan_documents, scan_text_files
from corpusmill.workload.base import (
    SQL_ORDER_RECORDS, from_table, load, named, order_records, sql_tokens,
)

# ---------------------------------------------------------------------------
# inline images

_IMAGE = "![shot](data:image/png;base64,iVBORw0KGgo=)"

# every document gets images by its language: none, one, or two with a gap
_SQL_IMAGED = f"""
  SELECT doc_id, CASE lang
           WHEN 'en' THEN text
           WHEN 'de' THEN '{_IMAGE}' || chr(10) || chr(10) || chr(10) || chr(10) || text
           ELSE '![a] x {_IMAGE}' || text || chr(10) || ' ' || chr(10) || chr(10) || chr(10)
                || '{_IMAGE}' END AS content
  FROM documents
"""


def _imaged(spark, sf_dir):
    content = (
        F.when(F.col("lang") == "en", F.col("text"))
        .when(F.col("lang") == "de", F.concat(F.lit(_IMAGE + "\n\n\n\n"), F.col("text")))
        .otherwise(
            F.concat(F.lit("![a] x " + _IMAGE), F.col("text"), F.lit("\n \n\n\n" + _IMAGE))
        )
    )
    return load(spark, sf_dir, "documents").select("doc_id", content.alias("content"))


# fixed value: the pattern of an inline image, as the SQL engine takes it
_PATTERN = r"!\[[^\n]*?\]\(data:image/[^;]+;base64,[A-Za-z0-9+/=]+\)"
_SQL_STRIPPED = rf"""
  SELECT doc_id, n_images, CASE WHEN n_images = 0 THEN content ELSE
           regexp_replace(regexp_replace(content, '{_PATTERN}', '', 'g'),
                          '\n\s*\n\s*\n+', chr(10) || chr(10) || chr(10), 'g') END AS content
  FROM (SELECT *, CAST(len(regexp_extract_all(content, '{_PATTERN}')) AS INTEGER) AS n_images
        FROM ({_SQL_IMAGED}))
"""


@named("strip_images", _SQL_STRIPPED)
def strip_images(spark, sf_dir):
    return strip_inline_images(_imaged(spark, sf_dir))


@named(
    "strip_images_pages",
    rf"""SELECT page_id, html AS content,
                CAST(len(regexp_extract_all(html, '{_PATTERN}')) AS INTEGER) AS n_images
         FROM pages""",
)
def strip_images_pages(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))
    return strip_inline_images(pages)


@named("text_sink", f"SELECT CAST(doc_id AS VARCHAR) AS filename, content FROM ({_SQL_STRIPPED})")
def text_sink(spark, sf_dir):
    path = scratch_path(spark, "clean-text")
    cleaned = strip_inline_images(_imaged(spark, sf_dir)).withColumn(
        "filename", F.col("doc_id").cast("string")
    )
    write_clean_text(cleaned, path)
    return spark.read.parquet(path)


# folders that the files of documents are dealt to
_FOLDERS = 256


def _written(spark, sf_dir):
    """The documents as one text file each, in folders of the shared place."""
    path = scratch_path(spark, "text-files")
    docs = load(spark, sf_dir, "documents").withColumn("name", F.concat("doc_id", F.lit(".TXT")))
    write_clean_text(docs, path, filename="name", content="text", layout="files", folders=_FOLDERS)
    return path


@named(
    "text_files",
    """SELECT doc_id || '.TXT' AS filename, 'txt' AS filetype, text AS content FROM documents""",
)
def text_files(spark, sf_dir):
    return scan_text_files(spark, _written(spark, sf_dir), "*.TXT").drop("path")


@named(
    "scan_written_files",
    """SELECT doc_id || '.TXT' AS filename, 'txt' AS filetype,
              CAST(octet_length(encode(text)) AS BIGINT) AS length FROM documents""",
)
def scan_written_files(spark, sf_dir):
    return scan_documents(spark, _written(spark, sf_dir)).select("filename", "filetype", "length")


@named(
    "partition_failures",
    """SELECT doc_id, 'Error' AS type, 'error' AS category, 'ValueError: no text in ' || lang AS text
       FROM documents WHERE lang <> 'en'
       UNION ALL
       SELECT doc_id, 'NarrativeText', 'body', lang FROM documents WHERE lang = 'en' AND doc_id % 3 > 0""",
)
def partition_failures(spark, sf_dir):
    """A parser that fails on some documents, and documents without content."""

    def parser(content: bytes) -> list[tuple]:
        lang = bytes(content).decode()
        if lang != "en":
            raise ValueError(f"no text in {lang}")
        return [("NarrativeText", lang, 1)]

    content = F.when((F.col("lang") != "en") | (F.col("doc_id") % 3 > 0), F.col("lang")).cast("binary")
    docs = load(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return partition_with(docs, parser).select("doc_id", "type", "category", "text")


# ---------------------------------------------------------------------------
# elements

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_BLOCK = (
    r"(?is)<table\b[^>]*>.*?</table>|<img\b[^>]*>"
    r"|<(?:title|h[1-6]|p|li)\b[^>]*>.*?</(?:title|h[1-6]|p|li)>"
)


def _sql_plain(block: str) -> str:
    text = rf"regexp_replace({block}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
        ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{char}')"
    return rf"trim(regexp_replace({text}, '[ \t\r\n\f]+', ' ', 'g'))"


_SQL_HTML_ELEMENTS = rf"""
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos,
         CASE WHEN tag IN ('title', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6') THEN 'Title'
              WHEN tag IN ('p', 'between') THEN 'NarrativeText' WHEN tag = 'li' THEN 'ListItem'
              WHEN tag = 'table' THEN 'Table' ELSE 'Image' END AS type,
         CASE WHEN tag IN ('title', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6') THEN 'heading'
              WHEN tag IN ('p', 'between') THEN 'body' WHEN tag = 'li' THEN 'list'
              WHEN tag = 'table' THEN 'table' ELSE 'image' END AS category,
         text
  FROM (SELECT doc_id, i, lower(regexp_extract(block, '^<([A-Za-z0-9]+)', 1)) AS tag,
               {_sql_plain('block')} AS text
        FROM (WITH shown AS (SELECT page_id, regexp_replace(html, '{_HIDDEN}', ' ', 'g') AS h FROM pages),
                   cut AS (SELECT page_id, regexp_extract_all(h, '{_BLOCK}') AS b,
                                  regexp_split_to_array(h, '{_BLOCK}') AS g FROM shown)
              SELECT page_id AS doc_id, unnest(b) AS block, 2 * generate_subscripts(b, 1) AS i FROM cut
              UNION ALL
              SELECT page_id, '<between>' || unnest(g), 2 * generate_subscripts(g, 1) - 1 FROM cut))
  WHERE text <> '' OR tag = 'img'
"""

_SQL_TEXT_ELEMENTS = r"""
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos,
         type, CASE type WHEN 'Title' THEN 'heading' WHEN 'ListItem' THEN 'list'
                         WHEN 'Table' THEN 'table' WHEN 'Image' THEN 'image'
                         ELSE 'body' END AS category, text
  FROM (SELECT doc_id, i,
               CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 'Title'
                    WHEN regexp_matches(line, '^(?:[-*+] |[0-9]+[.)] )') THEN 'ListItem'
                    WHEN regexp_matches(line, '^\|.*\|$') THEN 'Table'
                    WHEN regexp_matches(line, '^!\[') THEN 'Image'
                    ELSE 'NarrativeText' END AS type,
               regexp_replace(line, '^(?:#{1,6}|[-*+]|[0-9]+[.)]) +', '') AS text
        FROM (SELECT doc_id, trim(unnest(l)) AS line, generate_subscripts(l, 1) AS i
              FROM (SELECT doc_id, regexp_split_to_array(text, '\r?\n') AS l FROM documents))
        WHERE line <> '')
  WHERE text <> ''
"""


@named("partition_html", _SQL_HTML_ELEMENTS)
def partition_html_(spark, sf_dir):
    return partition_html(load(spark, sf_dir, "pages"), "page_id").drop("metadata")


# written without the patterns above: comments and scripts out, then every tag, then all white space
_SQL_VISIBLE = r"""
  SELECT page_id AS doc_id, length(t) AS n_visible, md5(t) AS visible
  FROM (SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
                 regexp_replace(regexp_replace(regexp_replace(html,
                   '<!--(?s:.)*?-->', ' ', 'g'), '(?i)<(script|style)\b(?s:.)*?</(script|style)>', ' ', 'g'),
                   '<[^>]*>', '', 'g'),
                 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)),
                 '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&'),
                 '[ \t\r\n\f]+', '', 'g') AS t FROM pages)
"""


@named("html_text_kept", _SQL_VISIBLE)
def html_text_kept(spark, sf_dir):
    """The visible characters of a page are those of its elements, in the same order."""
    pages = load(spark, sf_dir, "pages")
    texts = F.filter(html_elements("html"), lambda e: e["type"] != "Image")
    joined = F.array_join(F.transform(texts, lambda e: e["text"]), "")
    squeezed = pages.select(
        F.col("page_id").alias("doc_id"), F.regexp_replace(joined, r"[ \t\r\n\f]+", "").alias("t")
    )
    return squeezed.select(
        "doc_id", F.length("t").cast("bigint").alias("n_visible"), F.md5("t").alias("visible")
    )


_SQL_OUTLINE = """
  WITH c AS (SELECT c_custkey AS k, c_name, count(o_orderkey) AS n
             FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name),
  o AS (SELECT o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i, * FROM orders),
  e AS (
    SELECT k, 0 AS pos, 'Title' AS type, 'Customer & orders' AS text, 0 AS depth, NULL AS parent_pos FROM c
    UNION ALL SELECT k, 1, 'Title', c_name || ' – ' || chr(169), 1, 0 FROM c
    UNION ALL SELECT k, 2, 'Title', 'Orders', 2, 1 FROM c
    UNION ALL SELECT k, 3 + 3 * i, 'ListItem', 'Order ' || o_orderkey, 3, 2 FROM o
    UNION ALL SELECT k, 4 + 3 * i, 'ListItem', 'status ' || o_orderstatus, 4, 3 + 3 * i FROM o
    UNION ALL SELECT k, 5 + 3 * i, 'ListItem', 'é ' || o_orderpriority, 4, 3 + 3 * i FROM o
    UNION ALL SELECT k, 3 + 3 * n, 'Title', 'Sums', 2, 1 FROM c
    UNION ALL SELECT k, 4 + 3 * n, 'Table', 'orders ' || n, 3, 3 + 3 * n FROM c
    UNION ALL SELECT k, 5 + 3 * n, 'NarrativeText', 'end of ' || k, 2, 1 FROM c)
  SELECT k AS doc_id, CAST(pos AS INTEGER) AS pos, type,
         CASE type WHEN 'Title' THEN 'heading' WHEN 'ListItem' THEN 'list' WHEN 'Table' THEN 'table' ELSE 'body' END AS category,
         text, CAST(depth AS INTEGER) AS depth, CAST(parent_pos AS INTEGER) AS parent_pos
  FROM e
"""


@named("html_outline", _SQL_OUTLINE)
def html_outline_(spark, sf_dir):
    """Pages made of customers and their orders: nested lists with tags left open, a table in a section, references."""
    item = F.concat(
        F.lit("<li>Order <b>"), F.col("o_orderkey").cast("string"), F.lit("</b><UL class='x'><li>status "), F.col("o_orderstatus"),
        F.lit("<li>&eacute;&#32;"), F.col("o_orderpriority"), F.lit("</ul>"),
    )
    orders = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", item.alias("item")))).alias("items")
    )
    customers = load(spark, sf_dir, "customer")
    items = F.coalesce(F.col("items.item"), F.array().cast("array<string>"))
    html = F.concat(
        F.lit("<html><title>Customer &amp; orders</title><!-- <h1>no</h1> --><h1>"), F.col("c_name"),
        F.lit(" &ndash; &#xA9;</h1><section><h2>Orders</h2><ul>"), F.array_join(items, ""),
        F.lit("</ul></section><section><h2>Sums<table><tr><th>orders<td><p>"), F.size(items).cast("string"),
        F.lit("</table></section><script>p = '<p>'</script><p>end of "), F.col("c_custkey").cast("string"),
    )
    pages = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("doc_id"), html.alias("html"))
    return outline_html(pages).drop("metadata")


# references and their characters, the i-th for the documents whose id leaves i
_REFERENCES = (
    ("&amp;lt;", "&lt;"), ("&eacute;", "é"), ("&#8217;", "’"), ("&#x2014;", "—"), ("&mdash;", "—"), ("&hellip;", "…"), ("&Ouml;", "Ö"),
    ("&#128512;", "😀"), ("&#150;", "–"), ("&nosuchname;", "&nosuchname;"), ("&#xD800;", "�"), ("&frac12;", "½"), ("& &;", "& &;"),
)


@named(
    "html_references",
    "SELECT doc_id, length(t) AS n_chars, md5(t) AS decoded FROM (SELECT doc_id, replace(text, ' ', ' ' || CASE doc_id % "
    + f"{len(_REFERENCES)} " + " ".join(f"WHEN {i} THEN '{c}'" for i, (_, c) in enumerate(_REFERENCES)) + " END) AS t FROM documents)",
)
def html_references(spark, sf_dir):
    """The documents with a character reference put after every space."""
    docs = load(spark, sf_dir, "documents")
    reference = F.get(F.array(*(F.lit(r) for r, _ in _REFERENCES)), F.pmod("doc_id", F.lit(len(_REFERENCES))).cast("int"))
    escaped = F.replace("text", F.lit(" "), F.concat(F.lit(" "), reference))
    rows = docs.select("doc_id", decode_references(escaped).alias("t"))
    return rows.select("doc_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("decoded"))


@named("partition_text", _SQL_TEXT_ELEMENTS)
def partition_text_(spark, sf_dir):
    return partition_text(load(spark, sf_dir, "documents")).drop("metadata")


def _dialogue_parser(content: bytes) -> list[tuple]:
    """A small parser for the hook: paragraphs of a message, numbered like pages."""
    lines = [line for line in content.decode("utf-8").split("\n") if line != ""]
    return [("NarrativeText", line, page) for page, line in enumerate(lines, 1)]


def _messages(spark, sf_dir):
    return load(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        F.col("text").cast("binary").alias("content"),
    )


@named(
    "partition_custom",
    """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos,
              'NarrativeText' AS type, 'body' AS category, line AS text,
              CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS page_number
       FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
             FROM (SELECT conv_id * 1000 + turn AS doc_id, string_split(text, chr(10)) AS l
                   FROM conversations))
       WHERE line <> ''""",
)
def partition_custom(spark, sf_dir):
    return partition_with(_messages(spark, sf_dir), _dialogue_parser).select(
        "doc_id", "pos", "type", "category", "text", "metadata.page_number"
    )


# ---------------------------------------------------------------------------
# chunks


def _sql_chunks(elements: str, max_chars: int, new_after: int, overlap: int) -> str:
    step = max_chars - overlap
    return f"""
      WITH RECURSIVE e AS ({elements}),
      pieces AS (
        SELECT doc_id, substr(text, CAST(i * {step} + 1 AS BIGINT), {max_chars}) AS text,
               type = 'Title' AND i = 0 AS brk,
               row_number() OVER (PARTITION BY doc_id ORDER BY pos, i) AS n
        FROM (SELECT *, unnest(range(CASE WHEN length(text) <= {max_chars} THEN 1
                       ELSE 1 + (length(text) - {overlap} - 1) // {step} END)) AS i
              FROM e WHERE text <> '')),
      walk AS (
        SELECT doc_id, n, length(text) AS cur, 0 AS chunk_no FROM pieces WHERE n = 1
        UNION ALL
        SELECT p.doc_id, p.n,
               CASE WHEN p.brk OR w.cur >= {new_after}
                         OR w.cur + 1 + length(p.text) > {max_chars}
                    THEN length(p.text) ELSE w.cur + 1 + length(p.text) END,
               CASE WHEN p.brk OR w.cur >= {new_after}
                         OR w.cur + 1 + length(p.text) > {max_chars}
                    THEN w.chunk_no + 1 ELSE w.chunk_no END
        FROM walk w JOIN pieces p ON p.doc_id = w.doc_id AND p.n = w.n + 1),
      chunks AS (
        SELECT w.doc_id, w.chunk_no, string_agg(p.text, chr(10) ORDER BY p.n) AS text,
               CAST(count(*) AS INTEGER) AS n_elements
        FROM walk w JOIN pieces p ON p.doc_id = w.doc_id AND p.n = w.n GROUP BY 1, 2)
      SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, text,
             CAST(length(text) AS INTEGER) AS n_chars, n_elements FROM chunks"""


@named("chunk_by_title", _sql_chunks(_SQL_TEXT_ELEMENTS, 2048, 1500, 0))
def chunk_text(spark, sf_dir):
    return (
        DocumentFlow("text", content="text")
        .chunks(load(spark, sf_dir, "documents"))
        .drop("metadata")
    )


@named("chunk_html_overlap", _sql_chunks(_SQL_HTML_ELEMENTS, 300, 200, 20))
def chunk_html(spark, sf_dir):
    flow = DocumentFlow(
        "html", doc_id="page_id", content="html", max_chars=300, new_after=200, overlap=20
    )
    return flow.chunks(load(spark, sf_dir, "pages")).drop("metadata")


@named("chunk_element_rows", _sql_chunks(_SQL_HTML_ELEMENTS, 300, 200, 20))
def chunk_rows(spark, sf_dir):
    path = scratch_path(spark, "elements")
    partition_html(load(spark, sf_dir, "pages"), "page_id").write.parquet(path)
    return chunk_by_title(spark.read.parquet(path), 300, 200, 20).drop("metadata")


@named(
    "chunk_custom",
    _sql_chunks(
        """SELECT conv_id * 1000 + turn AS doc_id, i AS pos, 'NarrativeText' AS type, line AS text
           FROM (SELECT conv_id, turn, unnest(l) AS line, generate_subscripts(l, 1) AS i
                 FROM (SELECT *, string_split(text, chr(10)) AS l FROM conversations))""",
        200, 150, 10,
    ),
)
def chunk_custom(spark, sf_dir):
    flow = DocumentFlow(_dialogue_parser, max_chars=200, new_after=150, overlap=10)
    return flow.chunks(_messages(spark, sf_dir)).drop("metadata")


# ---------------------------------------------------------------------------
# vectors from text

_SQL_HASHED = f"""
  SELECT doc_id, dim, sum(s) AS n
  FROM (SELECT doc_id, CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) % 1536 AS INTEGER) AS dim,
               CASE WHEN CAST('0x' || substr(h, 9, 2) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS s
        FROM (SELECT doc_id, md5(unnest({sql_tokens('text')})) AS h FROM documents))
  GROUP BY 1, 2 HAVING sum(s) <> 0
"""


@named(
    "embed_hashed",
    f"""SELECT doc_id, dim, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 6) AS w
        FROM ({_SQL_HASHED})""",
)
def embed_hashed_(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", F.inline(hashed_sparse("text"))).withColumn(
        "w", F.round("w", 6)
    )


@named(
    "embed_dense",
    f"""WITH w AS (SELECT doc_id, dim, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS FLOAT) AS w
                   FROM ({_SQL_HASHED}))
        SELECT d.doc_id, CAST(CASE WHEN count(dim) > 0 THEN 1536 END AS INTEGER) AS size,
               count(dim) AS n_set, round(sum(w::DOUBLE * (dim + 1)), 3) AS moment
        FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id GROUP BY 1""",
)
def embed_dense(spark, sf_dir):
    """Dense vectors, by their size, the coordinates that are set, and a sum that places weigh."""
    docs = embed_hashed(load(spark, sf_dir, "documents").select("doc_id", "text"))
    vector = F.col("vector")
    moment = F.aggregate(
        F.transform(vector, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x
    )
    n_set = F.size(F.filter(vector, lambda x: x != 0)).cast("bigint")
    return docs.select(
        "doc_id", F.size(vector).alias("size"), F.coalesce(n_set, F.lit(0)).alias("n_set"),
        F.round(moment, 3).alias("moment"),
    )


def text_sizes(texts: list[str]) -> list[list[float]]:
    """A model that needs no files: characters and words."""
    return [[float(len(t)), float(len(t.split(" ")))] for t in texts]


@named(
    "embed_custom",
    """SELECT doc_id, length(text)::FLOAT::DOUBLE AS chars,
              len(string_split(text, ' '))::FLOAT::DOUBLE AS words FROM documents""",
)
def embed_custom(spark, sf_dir):
    docs = embed_with(load(spark, sf_dir, "documents").select("doc_id", "text"), text_sizes, 2)
    at = [F.get("vector", F.lit(i)).cast("double") for i in (0, 1)]
    return docs.select("doc_id", at[0].alias("chars"), at[1].alias("words"))


@named("hashed_counts", f"SELECT doc_id, dim, CAST(n AS INTEGER) AS n FROM ({_SQL_HASHED})")
def hashed_counts_(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", F.inline(hashed_counts("text")))


@named(
    "token_terms",
    f"""SELECT token AS key, count(*) AS doc_count
        FROM (SELECT unnest({sql_tokens('text')}) AS token FROM documents)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",
)
def token_terms(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return (
        docs.select(F.explode(tokens("text")).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("doc_count"))
        .orderBy(F.desc("doc_count"), "key")
        .limit(100)
    )


# ---------------------------------------------------------------------------
# hybrid corpus and entities

_SQL_CORPUS = f"""
  WITH r AS ({SQL_ORDER_RECORDS}),
  c AS ({_sql_chunks(_SQL_TEXT_ELEMENTS, 2048, 1500, 0)})
  SELECT 'doc-' || doc_id || '-' || chunk_no AS id, 'document' AS origin,
         'Chunk' AS type, 'body' AS category, text, NULL AS customer_name,
         NULL::DOUBLE AS price FROM c
  UNION ALL
  SELECT 'rec-' || id, 'record', 'Record', region, interaction_text, customer_name, price FROM r
"""


def _corpus(spark, sf_dir):
    chunks = DocumentFlow("text", content="text").chunks(
        load(spark, sf_dir, "documents")
    )
    records = order_records(spark, sf_dir).select(
        "id", "interaction_text", "region", "customer_name", "price"
    )
    return hybrid_corpus(
        chunks, records, text="interaction_text", category=F.col("region")
    ).select("id", "origin", "type", "category", "text", "customer_name", "price")


@named("hybrid_corpus", _SQL_CORPUS)
def hybrid_corpus_(spark, sf_dir):
    return _corpus(spark, sf_dir)


_MONTHS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
)
# fixed values: the patterns of the library, as the SQL engine takes them
_SQL_PATTERNS = {
    "MONEY": r"\$[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?",
    "DATE": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b|\bQ[1-4] [0-9]{4}\b"
    rf"|\b(?:{_MONTHS}) (?:[0-9]{{1,2}}, )?[0-9]{{4}}\b",
}


def _sql_pattern_entities(source: str, key: str, text: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT doc_id, '{kind}' AS entity_type, unnest(m) AS entity,
                   CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos
            FROM (SELECT {key} AS doc_id, regexp_extract_all({text}, '{p}') AS m FROM {source})"""
        for kind, p in _SQL_PATTERNS.items()
    )


# names of customers, nations, regions and segments; one region also as an organization
_SQL_GAZETTEER = """
  SELECT c_name AS name, 'PERSON' AS entity_type FROM customer
  UNION ALL SELECT n_name, 'LOCATION' FROM nation
  UNION ALL SELECT r_name, 'LOCATION' FROM region
  UNION ALL SELECT DISTINCT n_name || ', ' || r_name, 'AREA'
            FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT DISTINCT c_mktsegment, 'ORG' FROM customer
  UNION ALL SELECT DISTINCT p_name, 'PRODUCT' FROM part
"""


def _gazetteer(spark, sf_dir):
    customer, nation, region, part = (
        load(spark, sf_dir, t) for t in ("customer", "nation", "region", "part")
    )
    area = nation.join(region, nation.n_regionkey == region.r_regionkey)
    lists = [
        (customer.select("c_name"), "PERSON"),
        (nation.select("n_name"), "LOCATION"),
        (region.select("r_name"), "LOCATION"),
        (area.select(F.concat("n_name", F.lit(", "), "r_name")), "AREA"),
        (customer.select("c_mktsegment").distinct(), "ORG"),
        (part.select("p_name").distinct(), "PRODUCT"),
    ]
    frames = [df.toDF("name").withColumn("entity_type", F.lit(kind)) for df, kind in lists]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _sql_gazetteer_entities(source: str) -> str:
    """``source`` has doc_id and text. Longest first by containment in any other match."""
    return f"""
      g AS (SELECT phrase, entity_type, min(name) AS entity,
                   len(string_split(phrase, ' ')) AS n
            FROM (SELECT array_to_string({sql_tokens('name')}, ' ') AS phrase, name, entity_type
                  FROM ({_SQL_GAZETTEER})) WHERE phrase <> '' GROUP BY 1, 2),
      tk AS (SELECT doc_id, {sql_tokens('text')} AS t FROM {source}),
      w AS (SELECT doc_id, i - 1 AS pos, k AS n, array_to_string(t[i:i + k - 1], ' ') AS phrase
            FROM (SELECT doc_id, t, k, unnest(range(1, len(t) - k + 2)) AS i
                  FROM tk, (SELECT DISTINCT n AS k FROM g))),
      m AS (SELECT doc_id, entity_type, entity, pos, pos + g.n AS e
            FROM w JOIN g ON w.phrase = g.phrase AND w.n = g.n),
      found AS (SELECT doc_id, entity_type, entity, CAST(pos AS INTEGER) AS pos FROM m
            WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.pos <= m.pos
                              AND o.e >= m.e AND o.e - o.pos > m.e - m.pos))"""


@named(
    "entity_patterns",
    _sql_pattern_entities(f"({SQL_ORDER_RECORDS})", "id", "interaction_text"),
)
def entity_patterns(spark, sf_dir):
    return pattern_entities(order_records(spark, sf_dir), "id", "interaction_text")


@named(
    "entity_gazetteer",
    f"""WITH r AS (SELECT id AS doc_id, interaction_text AS text FROM ({SQL_ORDER_RECORDS})),
        {_sql_gazetteer_entities('r')} SELECT * FROM found""",
)
def entity_gazetteer(spark, sf_dir):
    return gazetteer_entities(
        order_records(spark, sf_dir), _gazetteer(spark, sf_dir), "id", "interaction_text"
    )


@named(
    "extract_entities",
    f"""WITH corpus AS (SELECT id AS doc_id, text FROM ({_SQL_CORPUS})),
        {_sql_gazetteer_entities('corpus')},
        everything AS (SELECT * FROM found
                       UNION ALL {_sql_pattern_entities('corpus', 'doc_id', 'text')})
        SELECT entity_type, entity, count(*) AS n, count(DISTINCT doc_id) AS n_items
        FROM everything GROUP BY 1, 2""",
)
def extract_entities_(spark, sf_dir):
    found = extract_entities(_corpus(spark, sf_dir), _gazetteer(spark, sf_dir), "id", "text")
    # one row per item and entity first, so that the distinct count needs no second expansion
    per_item = found.groupBy("entity_type", "entity", "doc_id").agg(F.count("*").alias("n"))
    return per_item.groupBy("entity_type", "entity").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_items")
    )


# ---------------------------------------------------------------------------
# run summary


@named(
    "run_summary",
    f"""WITH e AS ({_SQL_HTML_ELEMENTS}),
        c AS ({_sql_chunks(_SQL_HTML_ELEMENTS, 2048, 1500, 0)}),
        s AS (SELECT 'documents' AS stage, count(*) AS n_rows, count(html) AS n_filled FROM pages
              UNION ALL SELECT 'elements', count(*), count(text) FROM e
              UNION ALL SELECT 'chunks', count(*), count(text) FROM c)
        SELECT *, CASE WHEN n_rows > 0 THEN 'COMPLETED' ELSE 'EMPTY' END AS status FROM s""",
)
def run_summary_(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    flow = DocumentFlow("html", doc_id="page_id", content="html")
    return flow.summary(pages)


@named(
    "arrivals",
    f"""SELECT 'doc-' || doc_id || '-' || chunk_no AS id, text, true AS as_one_batch
        FROM ({_sql_chunks(_SQL_TEXT_ELEMENTS, 2048, 1500, 0)})""",
)
def arrivals(spark, sf_dir):
    """Documents whose files arrive in two lots, loaded after each, as one batch over all would have loaded them."""
    path, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "seen")
    docs = load(spark, sf_dir, "documents").withColumn("name", F.concat("doc_id", F.lit(".txt")))
    flow = DocumentFlow("text", doc_id="path", filename="filename", dim=8)
    totals = []

    def fill(name):
        for lot in (0, 1):
            part = docs.where(F.col("doc_id") % 2 == lot)
            write_clean_text(part, f"{path}/{lot}", filename="name", content="text", layout="files", folders=_FOLDERS)
            totals.append(load_arrivals(spark, path, flow, name, checkpoint, "*.txt"))

    stored = from_table(spark, "arrivals", fill)
    added = sum(t["added"] for t in totals)
    number = F.regexp_extract("id", r"/([0-9]+)\.txt-([0-9]+)$", 1)
    part = F.regexp_extract("id", r"/([0-9]+)\.txt-([0-9]+)$", 2)
    return stored.select(
        F.concat(F.lit("doc-"), number, F.lit("-"), part).alias("id"), "payload.text", F.lit(added == stored.count()).alias("as_one_batch")
    )
