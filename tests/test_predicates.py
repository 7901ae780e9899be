import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.predicates import (
    all_of, any_of, between_range, contains_any, exists, exists_in, has_text, match, match_keyword,
    query_tokens, since, tokens,
)


def test_exists_counts_the_empty_string_but_not_the_empty_array(spark):
    df = spark.createDataFrame([("", [1]), (None, []), ("x", None)], "s string, a array<int>")
    rows = df.select(exists_in(df, "s").alias("s"), exists_in(df, "a").alias("a")).collect()
    assert [(r.s, r.a) for r in rows] == [(True, True), (False, False), (True, False)]
    assert df.where(exists("a")).count() == 2


def test_groups_treat_null_as_false(spark):
    df = spark.createDataFrame([(None, True), (False, None), (True, True)], "a boolean, b boolean")
    a, b = F.col("a"), F.col("b")
    rows = df.select(any_of(a, b).alias("o"), all_of(a, b).alias("n"), (~all_of(a, b)).alias("x"))
    assert [tuple(r) for r in rows.collect()] == [
        (True, False, True), (False, False, True), (True, True, False),
    ]
    assert df.where(any_of()).count() == 0
    assert df.where(all_of()).count() == 3


def test_range_is_inclusive_where_it_says_so(spark):
    df = spark.createDataFrame([(299,), (300,), (301,), (None,)], "p int")
    count = lambda **bounds: df.where(between_range("p", **bounds)).count()
    assert count(gte=300) == 2
    assert count(gt=300) == 1
    assert count(gte=299, lt=301) == 2
    assert count(lte=299) == 1
    assert count() == 3
    assert df.where(~between_range("p", gte=300)).count() == 2


def test_since(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-03-01 00:00:00' AS ts UNION ALL "
        "SELECT timestamp_ntz'2024-01-30 23:59:59' UNION ALL SELECT NULL"
    )
    assert df.where(since("ts", "30d", "2024-03-01")).count() == 1
    assert df.where(since("ts", "2M", "2024-03-01")).count() == 2
    assert df.where(since("ts", "1h", "2024-03-01T00:30:00")).count() == 1
    with pytest.raises(ValueError):
        since("ts", "30 days", "2024-03-01")


TEXTS = [
    "Best-Buy opened", "bestbuy", "They BUY, the best", "", None, "Déjà-vu 42nd", "a_b c", "été",
]


@pytest.mark.parametrize("query", ["Best Buy", "BEST", "déjà 42nd", "b", "été,vu", "42", "..."])
@pytest.mark.parametrize("operator", ["or", "and"])
def test_match_is_a_test_on_tokens(spark, query, operator):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    wanted = query_tokens(query)
    quantifier = any if operator == "or" else all
    expected = []
    for t in TEXTS:
        found = set(re.findall(r"[^\W_]+", (t or "").lower()))
        expected.append(bool(wanted) and quantifier(w in found for w in wanted))
    rows = df.select(match("t", query, operator).alias("m"), tokens("t").alias("k")).collect()
    assert [r.m for r in rows] == expected


def test_match_rejects_another_operator():
    with pytest.raises(ValueError):
        match("t", "x", "xor")


def test_keyword_is_the_whole_value(spark):
    df = spark.createDataFrame([("Best Buy",), ("Best",), (None,)], "t string")
    assert df.where(match_keyword("t", "Best")).count() == 1


def test_contains_reaches_inside_words(spark):
    df = spark.createDataFrame([("a report",), ("none",), (None,)], "t string")
    assert df.where(contains_any("t", ["rep", "$"])).count() == 1


def test_has_text(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "t string")
    assert df.where(has_text("t")).count() == 1
