import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.scalars import (
    calendar_parts, describe_vector, extra_keys, iso_format, iso_parse, iso_year, mask_middle,
    megabytes, payload_keys, quarter_label, snippet, text_stats,
)


def test_snippets(one):
    long = "x" * 201
    assert one([snippet("t", 100)], t="ab")[0] == "ab..."
    assert one([snippet("t", 200, always=False)], t="x" * 200)[0] == "x" * 200
    assert one([snippet("t", 200, always=False)], t=long)[0] == "x" * 200 + "..."


@pytest.mark.parametrize(
    "month, calendar, legacy",
    [(1, "Q1", "Q1"), (3, "Q1", "Q2"), (6, "Q2", "Q3"), (9, "Q3", "Q4"), (12, "Q4", "Q5")],
)
def test_quarters(one, month, calendar, legacy):
    ts = F.lit(f"2024-{month:02}-15").cast("timestamp_ntz")
    row = one([quarter_label(ts), quarter_label(ts, "legacy")])
    assert tuple(row) == (calendar, legacy)


def test_calendar_parts(one):
    parts = calendar_parts(F.lit("2024-09-01 10:00:00").cast("timestamp_ntz"))
    row = one([c.alias(n) for n, c in parts.items()])
    assert row.asDict() == {
        "quarter": "Q3", "year": 2024, "month": "September", "day_of_week": "Sunday",
    }


def test_iso(one):
    ts = F.lit("2023-11-15 14:30:00.123").cast("timestamp_ntz")
    text = "2023-11-15T14:30:00"
    row = one([iso_format(ts), iso_parse("z"), iso_parse("bad"), iso_year("z")], z=text + "Z", bad="?")
    assert tuple(row) == (text, dt.datetime(2023, 11, 15, 14, 30), None, 2023)


def test_text_stats(one):
    stats = text_stats("t")
    assert tuple(one(stats.values(), t=" two  wörds\n")) == (2, 12)
    assert tuple(one(stats.values(), t="")) == (0, 0)


def test_mask(one):
    assert one([mask_middle("t")], t="a" * 10 + "secret" + "z" * 10)[0] == "a" * 10 + "..." + "z" * 10
    assert one([mask_middle("t")], t="x" * 20)[0] == "*" * 20


def test_payload_keys(one):
    keys = payload_keys("t")
    row = one([keys, extra_keys(keys)], t='{"type": 1, "metadata": {"a": 1}, "zone": 2}')
    assert row[0] == ["type", "metadata", "zone"]
    assert row[1] == ["zone"]
    assert one([payload_keys("t")], t="no object")[0] is None


def test_describe_vector(spark):
    df = spark.createDataFrame([([0.12345, 1.0, -2.0],), ([0.5],), ([],)], "v array<double>")
    rows = df.select(*(c.alias(n) for n, c in describe_vector("v").items())).collect()
    assert [tuple(r) for r in rows] == [
        ("0.1235", "1.0000", "-2.0000", 3), ("0.5000", None, "0.5000", 1), (None, None, None, 0),
    ]


def test_megabytes(one):
    assert one([megabytes(F.lit(245760))])[0] == 0.23
