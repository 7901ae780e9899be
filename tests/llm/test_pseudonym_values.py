"""Values beside other numbers and words, and dates in the other ways of writing them."""

import re

import pytest

from corpusmill.llm import pii

CARD, ES, DE = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00"
# text around the values, each written as {}, and the values
CASES = [
    ("card {} 12/27", [CARD]),
    ("{} 123.", [CARD]),
    ("12 {}, 2024 {}", [CARD, CARD]),
    ("{} 77 {} 9", [CARD, "5500 0000 0000 0004"]),
    ("AB12 {}", [CARD]),
    ("{} {} {}", [CARD, "31.12.1999", "10.0.255.3"]),
    ("{} {} {}", [CARD, "2024-01-05", "123-45-6789"]),
    ("{} {}", ["+49 151 12345678", CARD]),
    ("{} BIC X", [ES]),
    ("{} EUR", [ES.replace(" ", "")]),
    ("{} {} {} 12", [ES, ES, DE]),
    ("at {}T10:00 and {}T10:00:00Z", ["2024-01-05", "2024-02-29"]),
    ("{}; {}; {}; {}", ["12-05-2020", "2024/01/05", "2024.01.05", "2024/1/5"]),
]
LEFT = ["4111 1111 1111 1112 123", "ES92 2100 0418 4502 0005 1332 EUR", "2024-13-05T10:00", "99-99-2020", "x.org/2024/01/05/a",
        "1234 5678 9012 3456 1", "2024-01-05Tail"]


@pytest.fixture(scope="module")
def done(spark):
    texts = [text.format(*values) for text, values in CASES] + LEFT
    alone = sorted({v for _, values in CASES for v in values})
    df = spark.createDataFrame(list(enumerate(texts + alone)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.pseudonymise(df, "k").collect()}
    new = [rows[i] for i in range(len(texts) + len(alone))]
    return new[: len(CASES)], new[len(CASES) : len(texts)], dict(zip(alone, (r["text"] for r in new[len(texts) :])))


def test_values_in_context(done):
    """A value beside others gets the pseudonym it has alone, and nothing else changes."""
    rows, left, alone = done
    assert all(a != b and re.sub(r"\d+", "0", a) == re.sub(r"\d+", "0", b) for a, b in alone.items())
    for (text, values), row in zip(CASES, rows):
        assert row["text"] == text.format(*(alone[v] for v in values)), text
        assert row["n_pii"] == len(values), text


def test_invalid_values_stay(done):
    for text, row in zip(LEFT, done[1]):
        assert (row["text"], row["n_pii"]) == (text, 0)
