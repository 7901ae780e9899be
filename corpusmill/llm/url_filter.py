"""URL filters: literal rules, then a Bloom filter cascade over the hosts of the corpus.

A cascade answers membership exactly for every key of a known universe. Level 0 encodes the
listed keys; level 1 encodes those other keys of the universe that level 0 lets through by
mistake; level 2 those listed keys that level 1 holds by mistake, and so on until a level makes no
mistake. A key is listed if the first level that misses it is an odd one. The levels are bit
arrays of bounded size that each row tests in place, so pages are neither shuffled nor joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# a name of 255 octets has no more labels than this (RFC 1035)
MOST_LABELS = 127
# parent domains that a row tests in one pass
STEP = 5
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path begins with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, _URL, 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def labels_of(host: Column) -> Column:
    """Number of labels of a host, no more than a name can have."""
    return F.least(F.size(F.split(host, r"\.")), F.lit(MOST_LABELS))


def domains_of(host: Column) -> Column:
    """Array of the host and its parent domains of two or more labels."""
    spans = F.sequence(F.lit(2), F.greatest(labels_of(host), F.lit(2)))
    return F.array_prepend(F.transform(spans, lambda n: F.call_function("substring_index", host, F.lit("."), -n)), host)


def rule_for(rules: Iterable[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    if not ranked:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    fits = [(r.fits(host, path), r) for r in ranked]
    return (
        F.coalesce(*(F.when(c, F.lit(r.name)) for c, r in fits)),
        F.coalesce(*(F.when(c, F.lit(r.verdict)) for c, r in fits)),
    )


def _positions(key: Column, level: int, probes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits).cast("bigint")) for i in range(probes)]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a table of one row that holds its 64-bit words, and its shape."""

    number: int
    words: DataFrame
    probes: int
    bits: int

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        found = F.lit(True)
        for p in _positions(key, self.number, self.probes, self.bits):
            word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
            bit = F.call_function("getbit", word, (p % 64).cast("int"))
            found = found & (bit == 1)
        return found


def _shape(keys: int, against: int, level: int) -> tuple[int, int]:
    """Probes and bits: level 0 lets through about as many others as there are keys, later ones half."""
    probes = 1 if level else max(1, round(math.log2(max(1.0, math.sqrt(2) * against / keys))))
    return probes, max(64, 64 * math.ceil(keys * probes / math.log(2) / 64))


def _level(keys: DataFrame, number: int, probes: int, bits: int) -> Level:
    spark = keys.sparkSession
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, probes, bits))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("i")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("w")
    )
    dense = spark.range(bits // 64).select(F.col("id").alias("i")).join(words, "i", "left")
    row = dense.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("bigint")).alias("w")))),
            lambda e: e["w"],
        ).alias("words")
    )
    return Level(number, staged(row, "bloom"), probes, bits)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        inside = F.lit(False)
        for level in reversed(self.levels):
            inside = level.holds(key) & ~inside
        return inside


def cascade(keys: DataFrame, n_listed: int, n_others: int) -> Cascade:
    """The cascade of ``keys (key, listed)``, which must hold each key once.

    An empty list gives a cascade without levels, which lists nothing.
    """
    levels: list[Level] = []
    source, other = keys.filter("listed").select("key"), keys.filter("NOT listed").select("key")
    n_source, n_other = n_listed, n_others
    while n_source:
        probes, bits = _shape(n_source, n_other, len(levels))
        levels.append(_level(source, len(levels), probes, bits))
        wrong = staged(other.filter(levels[-1].holds(F.col("key"))), "bloom_next")
        source, other, n_source, n_other = wrong, source, wrong.count(), n_source
    return Cascade(tuple(levels))


def domain_keys(hosts: DataFrame, listed: Column, failing: Column | None = None) -> DataFrame:
    """``(key, listed)`` for every domain of ``hosts (host, …)``: each host, and its parents of two labels and more.

    ``listed`` judges ``key``, the number of its ``rows`` (subdomains included) and how many of these are ``failing``.
    Rows are counted by host before they are counted by domain. The empty host is never listed.
    """
    counted = hosts.groupBy("host").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.lit(False) if failing is None else failing, F.lit(False))).alias("failing")
    )
    return (
        counted.select(F.explode(F.array_distinct(domains_of(F.col("host")))).alias("key"), "rows", "failing")
        .groupBy("key").agg(F.sum("rows").alias("rows"), F.sum("failing").alias("failing"))
        .select("key", F.coalesce(listed & (F.col("key") != ""), F.lit(False)).alias("listed"))
    )


def listed_hosts(hosts: DataFrame, listed: Column, max_words: int = 8 << 20, failing: Column | None = None) -> DataFrame:
    """Adds ``is_listed`` to ``hosts (host, …)``: whether the host or a parent domain is listed.

    :func:`domain_keys` says what is listed. The universe is every
    domain of the table, found in one shuffle that combines equal hosts first; it also tells how many
    labels the deepest host has, and rows test that many parents, ``STEP`` in a pass. A cascade
    beyond ``max_words`` 64-bit words is built in shards by the hash of the key; the rows then pass one
    shard after the other, so that no executor holds more than one.
    """
    keys = staged(domain_keys(hosts, listed, failing), "url_keys")
    sizes = keys.agg(
        F.count_if("listed").alias("l"), F.count_if(~F.col("listed")).alias("o"), F.max(labels_of(F.col("key"))).alias("depth")
    ).first()
    probes, bits = _shape(max(1, sizes["l"]), sizes["o"], 0)
    shards = max(1, math.ceil(2 * bits / 64 / max_words))
    parents = list(range(2, (sizes["depth"] or 0) + 1))
    passes = [parents[at : at + STEP] for at in range(0, len(parents), STEP)] or [[]]
    host = F.col("host")
    out = hosts.withColumn("is_listed", F.lit(False))
    for shard in range(shards):
        mine = (lambda k, s=shard: F.pmod(F.xxhash64(k, F.lit("shard")), F.lit(shards)) == s) if shards > 1 else (lambda k: F.lit(True))
        own = keys.filter(mine(F.col("key")))
        n = own.agg(F.count_if("listed").alias("l"), F.count_if(~F.col("listed")).alias("o")).first()
        found = cascade(own, n["l"], n["o"])
        if not found.levels:
            continue
        for first, labels in enumerate(passes):
            hit = F.lit(False)
            for key in [*([] if first else [host]), *(F.substring_index(host, ".", -n) for n in labels)]:
                hit = hit | (mine(key) & found.lists(key))
            out = out.withColumn("is_listed", F.col("is_listed") | hit)
            if shards * len(passes) > 1:
                out = staged(out, "url_pass")
    return out


def judge_urls(pages: DataFrame, rules: Iterable[Rule], listed: Column, id_col: str = "page_id", url_col: str = "url",
               max_words: int = 8 << 20, failing: Column | None = None) -> DataFrame:
    """Id, host, path, rule, verdict and ``is_listed`` of every row.

    The longest rule that fits decides; else the url is blocked if its host, or a parent domain, is
    listed, as ``listed`` says of a domain and of its pages for which ``failing`` holds (:func:`domain_keys`). A null
    url, or one without ``://``, has an empty host and path, fits no rule and is
    allowed. Repeated rows are judged each on its own; other columns are left out, so none can clash.
    """
    url = F.col(url_col)
    fails = F.lit(False) if failing is None else failing
    parsed = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), fails.alias("_failing"))
    judged = listed_hosts(parsed, listed, max_words, F.col("_failing"))
    rule, verdict = rule_for(rules, F.col("host"), F.col("path"))
    own = F.when(F.col("is_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "is_listed")
