"""Named entities in text: names of a gazetteer and patterns."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.predicates import tokens

# A gazetteer up to this size is sent to every executor, as a trie of tokens.
BROADCAST_BYTES = 32 * 1024 * 1024
# Up to this many first tokens of names are sent instead, each with the lengths of its
# names, to sort out token runs that are no name before any of them is put together.
DIGEST_ROWS = 250_000
# Copies of a larger gazetteer, so that one frequent phrase is spread over tasks, where
# Spark does not split such partitions itself.
SALTS = 32
# Tokens per group when overlapping matches of one document are compared.
BUCKET_TOKENS = 4096

_MONTHS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
)
PATTERNS: Mapping[str, str] = {
    "MONEY": r"\$[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?",
    "DATE": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b|\bQ[1-4] [0-9]{4}\b"
    rf"|\b(?:{_MONTHS}) (?:[0-9]{{1,2}}, )?[0-9]{{4}}\b",
}


def phrase(text: Column | str) -> Column:
    """The form in which names are compared: lower-case tokens with single spaces."""
    return F.array_join(tokens(text), " ")


def pattern_entities(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    patterns: Mapping[str, str] = PATTERNS,
) -> DataFrame:
    """Matches of the patterns: doc_id, entity_type, entity, pos (running number, from 0)."""
    found = F.array(
        *(
            F.struct(
                F.lit(kind).alias("entity_type"),
                F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)).alias("found"),
            )
            for kind, p in patterns.items()
        )
    )
    return df.select(F.col(doc_id).alias("doc_id"), F.inline(found)).select(
        "doc_id", "entity_type", F.posexplode("found").alias("pos", "entity")
    ).select("doc_id", "entity_type", "entity", "pos")


def gazetteer_entities(
    df: DataFrame,
    gazetteer: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    digest_rows: int = DIGEST_ROWS,
) -> DataFrame:
    """Names of a gazetteer (name, entity_type) found in text.

    Result: doc_id, entity_type, entity, pos (token number, from 0). A match
    inside a longer one is dropped. A gazetteer whose measured size allows sending it
    along is walked as a trie inside each row. Otherwise token runs are shuffled to the names: of
    the lengths that names with the same first token have, if the first tokens are few enough to
    be sent, else of all lengths of the gazetteer.
    """
    return extract_entities(df, gazetteer, doc_id, text, {}, broadcast_bytes, digest_rows)


def extract_entities(
    df: DataFrame,
    gazetteer: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    patterns: Mapping[str, str] = PATTERNS,
    broadcast_bytes: int = BROADCAST_BYTES,
    digest_rows: int = DIGEST_ROWS,
) -> DataFrame:
    """Entities by pattern and, when a gazetteer is given, by name.

    Columns as in :func:`pattern_entities` and :func:`gazetteer_entities`. With
    a gazetteer that can be sent along, the text is read once for both and stays in its row.
    """
    if gazetteer is None:
        return pattern_entities(df, doc_id, text, patterns)
    names = (
        gazetteer.select(
            phrase("name").alias("phrase"), "entity_type", F.col("name").alias("entity")
        )
        .where(F.col("phrase") != "")
        .groupBy("phrase", F.col("entity_type").alias("name_type"))
        .agg(F.min("entity").alias("name"))
        .withColumn("n", F.size(F.split("phrase", " ")))
    )
    measured = names.agg(
        F.coalesce(
            F.sum(F.length("phrase") + F.length("name") + F.length("name_type") + 48), F.lit(0)
        ).alias("bytes"),
        F.count("*").alias("rows"),
        F.array_sort(F.collect_set("n")).alias("lengths"),
        F.approx_count_distinct(_first("phrase")).alias("heads"),
    ).first()
    lengths = measured["lengths"] or [1]

    if measured["bytes"] <= broadcast_bytes:
        return _in_row(df, names, doc_id, text, patterns)

    heads = None
    if measured["heads"] <= digest_rows:
        heads = names.groupBy(_first("phrase").alias("_head")).agg(F.collect_set("n").alias("_lengths"))
    candidates, names = _candidates(df, doc_id, text, lengths, heads), names.drop("n")
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true" == conf.get("spark.sql.adaptive.skewJoin.enabled"):
        # runs pass the names of their partition unsorted; one with a very frequent phrase is split as it is read
        joined = candidates.join(names.hint("shuffle_hash"), "phrase")
    else:
        salted = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = candidates.withColumn(
            "_salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int")
        ).join(salted, ["phrase", "_salt"])
    found = _resolved(joined, lengths)
    if not patterns:
        return found
    return found.unionByName(pattern_entities(df, doc_id, text, patterns))


def _first(phrase: str) -> Column:
    return F.substring_index(phrase, " ", 1)


_FOUND = "array<struct<entity_type:string,entity:string,pos:int>>"


def _in_row(df: DataFrame, names: DataFrame, doc_id: str, text: str, patterns: Mapping[str, str]) -> DataFrame:
    """Names and pattern matches of each text, found in its row; the text is read once and nothing is shuffled."""
    rows = [tuple(r) for r in names.select("phrase", "name_type", "name").orderBy("phrase", "name_type").collect()]  # of checked size
    found = [_trie_finder(df.sparkSession.sparkContext.broadcast(rows))(F.col(text))] if rows else []
    for kind, p in patterns.items():
        matched = F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0))
        numbered = F.transform(matched, lambda m, i: F.struct(F.lit(kind).alias("entity_type"), m.alias("entity"), i.alias("pos")))
        found.append(F.coalesce(numbered.cast(_FOUND), F.array().cast(_FOUND)))
    if not found:
        found = [F.array().cast(_FOUND)]
    return df.select(F.col(doc_id).alias("doc_id"), F.inline(F.concat(*found)))


def _trie_finder(rows):
    """A column function over texts, from a broadcast list of ``(phrase, entity_type, name)``."""

    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import regex

        split = regex.compile(r"[^\p{L}\p{N}]+").split
        names = rows.value
        trie: dict = {}
        for k, (phrase, _, _) in enumerate(names):
            node = trie
            for token in phrase.split(" "):
                node = node.setdefault(token, {})
            node.setdefault("", []).append(k)  # no token is empty
        kinds, words = (pa.array([r[i] for r in names], pa.string()) for i in (1, 2))
        for batch in texts:
            offsets, which, places = [0], [], []
            for text in batch:
                at = [t for t in split((text.as_py() or "").lower()) if t]
                reach = 0
                for i, token in enumerate(at):
                    node = trie.get(token)
                    if node is None:
                        continue
                    best, end, j = None, 0, i + 1
                    while node is not None:
                        if "" in node:
                            best, end = node[""], j
                        node = node.get(at[j]) if j < len(at) else None
                        j += 1
                    # what ends no further than a match before lies inside of it
                    if best is not None and end > reach:
                        reach = end
                        which += best
                        places += [i] * len(best)
                offsets.append(len(which))
            index = pa.array(which, pa.int64())
            values = pa.StructArray.from_arrays(
                [kinds.take(index), words.take(index), pa.array(places, pa.int32())], names=["entity_type", "entity", "pos"]
            )
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return F.arrow_udf(find, _FOUND)


def _candidates(df: DataFrame, doc_id: str, text: str, lengths: list[int], heads: DataFrame | None) -> DataFrame:
    """Token runs, for gazetteers that cannot be sent along: doc_id, pos, n, phrase.

    With ``heads``, only runs whose first token is there, of the lengths found beside it.

    One row per token first, with the tokens that follow it. The shifted arrays share the
    token strings; the runs are put together in generated code.
    """
    # exploded from an array of one, so that the tokens are computed once per text
    tokenized = df.select(F.col(doc_id).alias("doc_id"), F.explode(F.array(tokens(text))).alias("t"))
    shifted = [
        F.slice("t", F.lit(k + 1), F.greatest(F.size("t") - k, F.lit(0))).alias(f"t{k}")
        for k in range(max(lengths))
    ]
    numbered = tokenized.select("doc_id", F.posexplode(F.arrays_zip(*shifted)).alias("pos", "z"))
    wanted = [F.lit(True)] * len(lengths)
    if heads is not None:
        numbered = numbered.join(F.broadcast(heads), F.col("z.t0") == F.col("_head"))
        wanted = [F.array_contains("_lengths", n) for n in lengths]
    rows = [
        F.struct(
            F.lit(n).alias("n"),
            F.when(
                w & F.col(f"z.t{n - 1}").isNotNull(),
                F.concat_ws(" ", *(F.col(f"z.t{k}") for k in range(n))),
            ).alias("phrase"),
        )
        for n, w in zip(lengths, wanted)
    ]
    return numbered.select("doc_id", "pos", F.inline(F.array(*rows))).where(F.col("phrase").isNotNull())


def _resolved(joined: DataFrame, lengths: list[int]) -> DataFrame:
    """Named candidates, without names inside longer names."""
    found = joined.select(
        "doc_id", F.col("name_type").alias("entity_type"), F.col("name").alias("entity"), "pos", (F.col("pos") + F.col("n")).alias("_end")
    )
    return (found if len(lengths) == 1 else _longest(found)).drop("_end")


def _longest(matches: DataFrame) -> DataFrame:
    """Drops matches that lie inside a longer one.

    In order of start, longest first, a match lies inside another exactly when
    the furthest end so far, not counting matches of the same extent, reaches
    its end. Matches of a document are compared in buckets of tokens; one that
    crosses a border also goes to the next bucket, for comparison only.
    """
    bucketed = matches.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.floor(F.col("pos") / BUCKET_TOKENS), F.floor((F.col("_end") - 1) / BUCKET_TOKENS)
            )
        ),
    )
    group = Window.partitionBy("doc_id", "_bucket")
    # one number in the order of start and, from the longest, of end, so that one sort serves
    extent = F.col("pos").cast("bigint") * F.lit(1 << 32) - F.col("_end")
    ranked = bucketed.withColumn("_extent", extent)
    before = group.orderBy("_extent").rangeBetween(Window.unboundedPreceding, -1)
    return (
        ranked.withColumn("_reached", F.max("_end").over(before))
        .where(F.coalesce(F.col("_reached") < F.col("_end"), F.lit(True)))
        .where(F.col("_bucket") == F.floor(F.col("pos") / BUCKET_TOKENS))
        .drop("_bucket", "_extent", "_reached")
    )
