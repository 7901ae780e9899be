"""The named queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import alignment, bpe, decontaminate, merkle, pii, pu_classifier, quality_rules, simhash, suffix_dedup, token_counts, token_files, toxicity, url_filter
from corpusmill.llm.common import table
from corpusmill.workload.base import Named

QUERIES: dict[str, Named] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Named(run, sql)
        return run

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)
# a page of fewer characters is thin; a domain of which more than a third of the pages are thin is on the block list
THIN = 1800

_SQL_PARSED = """
  SELECT page_id, CASE WHEN cut = 0 THEN '' ELSE translate(part[1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') END AS host,
         CASE WHEN cut = 0 THEN '' ELSE split_part(split_part(substr(rest, strlen_host + 1), '?', 1), '#', 1) END AS path, thin
  FROM (SELECT *, [regexp_extract(rest, '^[^/?#]*')] AS part, length(regexp_extract(rest, '^[^/?#]*')) AS strlen_host
        FROM (SELECT page_id, coalesce(length(html), 0) < 1800 AS thin, coalesce(instr(url, '://'), 0) AS cut,
                     substr(url, instr(url, '://') + 3) AS rest FROM pages))
"""


@query(
    "op1_url_filter",
    f"""
  WITH parsed AS ({_SQL_PARSED}),
  rules(r_host, r_path, r_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
  fitted AS (
    SELECT page_id, host, path, max_by(r_host || r_path, length(r_host || r_path)) AS rule,
           max_by(r_verdict, length(r_host || r_path)) AS ruled
    FROM parsed LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY page_id, host, path),
  hosts AS (SELECT host, count(*) AS n, count(*) FILTER (thin) AS t FROM parsed GROUP BY host),
  domains AS (SELECT host, n, t, unnest(list_distinct([host] || list_transform(range(2, len(string_split(host, '.')) + 1),
      lambda x: array_to_string(string_split(host, '.')[-x:], '.')))) AS key FROM hosts),
  listed AS (SELECT key FROM domains WHERE key <> '' GROUP BY key HAVING 3 * sum(t) > sum(n)),
  judged AS (SELECT *, host IN (SELECT host FROM domains WHERE key IN (SELECT key FROM listed)) AS is_listed FROM fitted)
  SELECT page_id, host, path, rule,
         coalesce(ruled, CASE WHEN is_listed THEN 'block' ELSE 'allow' END) AS verdict, is_listed
  FROM judged
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    thin = F.coalesce(F.length("html"), F.lit(0)) < THIN
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, 3 * F.col("failing") > F.col("rows"), failing=thin)


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.removed(table(spark, sf_dir, "documents"))
    # what is left as text: a character that was cut through is replaced
    return left.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@query("op3_bpe_codec")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.code_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


HOST_LIMIT = 0.5

_SQL_RULES = rf"""
  WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
  grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
  covered AS (
    SELECT doc_id, count(DISTINCT p) AS c
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
  counted AS (
    SELECT words.doc_id, source, len(w)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN covered USING (doc_id)),
  based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
  hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS failed FROM based GROUP BY source),
  sums AS (SELECT sum(failed) AS k, sum(n) AS n, count(*) AS h, sum(failed * failed / n) AS q, sum(n * n) AS nn FROM hosts),
  spread AS (SELECT *, k / n AS mean, (q - k * k / n - (h - 1) * ((k - q) / (n - h))) / (n - nn / n) AS between_ FROM sums),
  prior AS (SELECT mean, CASE WHEN h > 1 AND n > h AND between_ > 0
                              THEN greatest(mean * (1 - mean) / between_ - 1, 1.0) ELSE 1e6 END AS weight FROM spread),
  rated AS (SELECT source, (failed + mean * weight) / (n + weight) AS rate FROM hosts, prior)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND NOT rate > {HOST_LIMIT} AS kept, round(rate, 6) AS host_rate
  FROM based JOIN rated ON based.source IS NOT DISTINCT FROM rated.source
"""


@query("op4_host_quality", _SQL_RULES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"), HOST_LIMIT)
    return judged.withColumn("host_rate", F.round("host_rate", 6))


PSEUDONYM_KEY = "a key of the workload; a real one comes from a secret store"


@query("op5_pseudonyms")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PSEUDONYM_KEY)


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_folder(spark)
    files, index = token_files.write_tokens(
        table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end=2
    )
    return token_files.read_digests(files, index)


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def _sql_manifest(levels: int = 7) -> str:
    """The tree level by level: ``levels`` runs of 8 above the leaves of a language, and 2 above the languages.

    DuckDB has no crc32, so it comes from a table of its 256 steps.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(text: str) -> str:
        parts = (text if f == "text" else f"{f}::VARCHAR" for f in fields)
        return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        """steps AS (SELECT list(list_reduce([n] || range(8)::UBIGINT[],
             lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY n) AS step
           FROM (SELECT unnest(range(256))::UBIGINT AS n))""",
        f"""rows_ AS (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(lowered)} AS changed,
             xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT),
               lambda a, b: xor(a >> 8, step[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS crc
           FROM documents, steps)""",
        """n0 AS (SELECT doc_id, lang, leaf, CASE WHEN crc % 3 = 0 THEN changed ELSE leaf END AS start,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM rows_)""",
        "t0 AS (SELECT lang, r AS i, leaf AS node FROM n0)",
    ]
    for k in range(1, levels + 1):  # a tree of one node stays as it is
        ctes += [
            f"s{k - 1} AS (SELECT lang, i // 8 AS i, list(node ORDER BY i) AS run, any_value(c) AS c "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS c FROM t{k - 1}) GROUP BY lang, i // 8)",
            f"t{k} AS (SELECT lang, i, CASE WHEN c = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM s{k - 1})",
        ]
    ctes += [f"u0 AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, node AS subroot, node FROM t{levels})"]
    ctes += ["v0 AS (SELECT i // 8 AS i, list(node ORDER BY i) AS run, (SELECT count(*) FROM u0) AS c FROM u0 GROUP BY i // 8)",
             "u1 AS (SELECT i, CASE WHEN c = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM v0)",
             "v1 AS (SELECT i // 8 AS i, list(node ORDER BY i) AS run, (SELECT count(*) FROM u1) AS c FROM u1 GROUP BY i // 8)",
             "u2 AS (SELECT CASE WHEN c = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS root FROM v1)"]

    def up(name: str, before: str, run: str, place: str, on: str) -> str:
        kept = f"list_filter(run, lambda x, k: k <> ({place}) % 8 + 1)"
        folded = f"sha256(array_to_string(run[:({place}) % 8] || [node] || run[({place}) % 8 + 2:], ''))"
        return (f"{name} AS (SELECT a.* EXCLUDE (proof, node), CASE WHEN c = 1 THEN proof ELSE proof || array_to_string({kept}, '') END AS proof, "
                f"CASE WHEN c = 1 THEN node ELSE {folded} END AS node FROM {before} a JOIN {run} b ON {on})")

    ctes.append("p0 AS (SELECT doc_id, lang, leaf, r, start AS node, '' AS proof FROM n0)")
    for k in range(levels):
        place = f"a.r // {8 ** k}"
        ctes.append(up(f"p{k + 1}", f"p{k}", f"s{k}", place, f"a.lang IS NOT DISTINCT FROM b.lang AND a.r // {8 ** (k + 1)} = b.i"))
    ctes.append(f"q0 AS (SELECT p.doc_id, p.leaf, u0.subroot, u0.i AS g, p.node, p.proof FROM p{levels} p JOIN u0 ON p.lang IS NOT DISTINCT FROM u0.lang)")
    ctes += [up("q1", "q0", "v0", "a.g", "a.g // 8 = b.i"), up("q2", "q1", "v1", "a.g // 8", "a.g // 64 = b.i")]
    return (f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, "
            "node = root AS verified FROM q2, u2")


@query("op11_merkle_manifest", _sql_manifest())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(merkle.build(docs, other=merkle.tampered_text()))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.score_documents(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
