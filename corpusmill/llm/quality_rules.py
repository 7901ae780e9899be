"""Quality rules of documents, and verdicts on whole hosts from how many of their documents fail.

Everything is a column expression: the counts come from arrays inside each row, so a text is read
once and nothing of it is shuffled. Hosts get a Beta prior fitted to all hosts by moments,
so that a host of few documents is judged mostly by the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import let, staged

_SPACE = " \t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"
_WORD_CHAR = r"[^\x20\x09-\x0D]"
# fixed value: the characters that count as symbols
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _GAP), lambda w: w != "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD_CHAR))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def repeated_words(words: Column) -> Column:
    """Words inside a window of three words that occurs more than once.

    Windows are compared by a 64-bit hash within one document. Sorting (hash, place) brings equal
    windows together; the places found cover up to three words each, less what overlaps the next.
    """
    n = F.size(words)
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        )
    )

    def places(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)),
                ),
                lambda e: e["i"],
            ),
        )

    def covered(found: Column) -> Column:
        return let(
            F.sort_array(found),
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(3)), F.lit(3))),
                F.lit(0).cast("int"),
                lambda a, b: a + b,
            ),
        )

    return let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(places(h))),
    )


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document: id, host, the counts of the rules and ``base_failed``; a null text has no words."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    split = base.select(
        "_id", "_host",
        F.length(F.translate(text, _SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"),
        let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r"))).alias("w"),
    )
    n, r = F.col("w.n"), F.col("w.r")
    return split.select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"),
        n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", r.alias("n_repeat_words"),
        ((n < 50) | (100 * r > 50 * n)).alias("base_failed"),
    )


def host_verdicts(counts: DataFrame, limit: float) -> DataFrame:
    """Per host: documents, failures, shrunk rate and ``rejected``.

    The prior Beta(a, b) has the mean of the failure rates of all hosts and, as far as they differ by more
    than chance, their spread; each rate is then (failures + a) / (documents + a + b). Rows are
    combined per task before the shuffle, so a host with a third of all documents costs one row per task.
    """
    hosts = counts.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed")
    )
    # method of moments over hosts; the sums are integers or sums of one rational per host
    moments = hosts.agg(
        F.sum("failed").alias("k"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("h"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("q"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    )
    mean = F.col("k") / F.col("n")
    # between-host variance of a weighted one-way layout, within (0, mean (1 - mean))
    within = (F.col("k") - F.col("q")) / (F.col("n") - F.col("h"))
    between = (F.col("q") - F.col("k") * F.col("k") / F.col("n") - (F.col("h") - 1) * within) / (
        F.col("n") - F.col("nn") / F.col("n")
    )
    spread = mean * (1 - mean)
    weight = F.when(
        (F.col("h") > 1) & (F.col("n") > F.col("h")) & (between > 0), F.greatest(spread / between - 1, F.lit(1.0))
    ).otherwise(F.lit(1e6))
    prior = moments.select(F.struct(mean.alias("mean"), weight.alias("weight")).alias("prior"))
    p = prior.scalar()
    rated = hosts.select("host", "n", "failed", p.alias("prior"))
    rate = (F.col("failed") + F.col("prior.mean") * F.col("prior.weight")) / (F.col("n") + F.col("prior.weight"))
    return rated.select("host", "n", "failed", rate.alias("rate"), (rate > limit).alias("rejected"))


def judge_documents(docs: DataFrame, limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                    host_col: str = "source") -> DataFrame:
    """The counts of every document and ``kept``: it failed no rule, and its host is not rejected.

    A null host is a host of its own. Repeated rows count and are returned as often as they come;
    other columns are left out. An empty table gives an empty result.
    """
    counts = staged(rule_counts(docs, id_col, text_col, host_col), "rule_counts")
    verdicts = host_verdicts(counts, limit).select(F.col("host").alias("_host"), "rate", "rejected")
    joined = counts.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("rejected")).alias("kept"), F.col("rate").alias("host_rate"),
    )
