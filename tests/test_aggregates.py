import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.aggregates import (
    bucket_start, count_queries, date_histogram, estimate_entities, latest, profile, stats,
    table_mapping, table_segments, table_stats, terms, wide_gaps,
)


def test_terms_order_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "k string")
    assert [tuple(r) for r in terms(df, "k", 2).collect()] == [("c", 2), ("a", 1)]


def test_stats_of_nothing(spark):
    df = spark.createDataFrame([(1.0,)], "x double").where("x < 0")
    assert tuple(stats(df, "x").first()) == (0, None, None, None, None)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_histogram_fills_gaps_in_any_zone(spark, zone):
    # midnight of 2018-11-04 does not exist in the second zone
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_ntz'2018-11-04 00:10:00' AS ts UNION ALL "
            "SELECT timestamp_ntz'2018-11-06 23:59:59' UNION ALL SELECT NULL"
        )
        rows = [tuple(r) for r in date_histogram(df, "ts", "day").collect()]
        assert rows == [
            (dt.datetime(2018, 11, 4), 1), (dt.datetime(2018, 11, 5), 0), (dt.datetime(2018, 11, 6), 1),
        ]
        hours = date_histogram(df, "ts", "hour").collect()
        assert len(hours) == 72 and hours[0].key == dt.datetime(2018, 11, 4)
        assert date_histogram(df, "ts", "minute").count() == 3 * 1440 - 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_years_between_are_zero(spark):
    df = spark.sql("SELECT timestamp_ntz'2016-05-01' AS ts UNION ALL SELECT timestamp_ntz'2019-01-01'")
    assert [r.doc_count for r in date_histogram(df, "ts", "year").collect()] == [1, 0, 0, 1]
    with pytest.raises(ValueError):
        bucket_start("ts", "decade")


def test_profile_agrees_with_single_aggregations(spark):
    df = spark.createDataFrame(
        [(i, f"g{i % 5}", None if i % 3 else "x", float(i), None) for i in range(40)],
        "id int, a string, b string, m double, e double",
    ).withColumn("ts", F.lit("2020-01-01").cast("timestamp_ntz") + F.make_interval(years=F.col("id") % 4 * 2))
    found = profile(df, {"a": 3, "b": 5}, ["m", "e"], ("ts", "year")).collect()
    by_agg = {}
    for r in found:
        by_agg.setdefault(r["agg"], []).append(r)
    for field, size in (("a", 3), ("b", 5)):
        assert sorted((r.key, r.doc_count) for r in by_agg[field]) == sorted(
            map(tuple, terms(df, field, size).collect())
        )
    (m,), (e,) = by_agg["m"], by_agg["e"]
    assert (m.doc_count, m["min"], m["max"], m.avg, m["sum"]) == (40, 0.0, 39.0, 19.5, 780.0)
    assert (e.doc_count, e["min"], e["sum"]) == (0, None, None)
    assert [r.doc_count for r in sorted(by_agg["ts"], key=lambda r: r.key)] == [10, 0, 10, 0, 10, 0, 10]
    with pytest.raises(ValueError):
        profile(df, {"ts": 3}, histogram=("ts", "year"))


def test_profile_reads_its_input_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    frame = profile(
        df, {"o_orderstatus": 5}, ["o_totalprice"], ("o_orderdate", "year")
    )
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    assert plan.count("ReusedExchange") == 2
    assert "SortAggregate" not in plan


def test_count_queries(spark):
    df = spark.range(10)
    found = count_queries(df, {"low": F.col("id") < 3, "of none": F.lit(None).cast("boolean")})
    assert {r.name: r.n for r in found.collect()} == {"low": 3, "of none": 0}


def test_estimate(one):
    def n(text):
        return one([estimate_entities("t")], t=text)[0]

    assert n("a report") == 1
    assert n("Customer from Austin, TX paid $5 at Target") == 4
    assert n("nothing") == 0


def test_latest_is_numbered(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, ts int")
    assert [(r.id, r["rank"]) for r in latest(df, "ts", 3, "id").orderBy("rank").collect()] == [
        (2, 1), (3, 2), (1, 3),
    ]


def test_table_stats(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    found = table_stats(spark.read.parquet(path)).first()
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("part-*.parquet"))
    assert (found.n_rows, found.n_files, found.n_bytes, found.n_columns) == (100, 4, size, 1)
    # a file without rows counts, whatever its folder is called
    path = str(tmp_path / "a folder")
    spark.range(100).repartition(2).write.parquet(path)
    spark.range(0).write.mode("append").parquet(path)
    found = table_stats(spark.read.parquet(path)).first()
    size = sum(p.stat().st_size for p in (tmp_path / "a folder").glob("part-*.parquet"))
    assert (found.n_rows, found.n_files, found.n_bytes) == (100, 3, size)
    assert table_stats(spark.range(3), files=False).first().n_rows == 3


@pytest.mark.parametrize("interval", ["year", "quarter", "month", "week", "day", "hour"])
def test_gaps_over_years(spark, interval):
    """Gaps that cross several years, against all buckets counted one by one."""
    times = ["1999-12-31 23:10:00", "2000-01-01 00:00:00", "2000-01-02 11:00:00", "2003-02-28 05:00:00", "2003-03-01 00:00:00", "2005-01-02 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    found = [(r.key, r.doc_count) for r in date_histogram(df, "ts", interval).collect()]
    starts = [r[0] for r in df.select(bucket_start("ts", interval)).collect()]
    step = {"year": "1 YEAR", "quarter": "3 MONTH", "month": "1 MONTH", "week": "7 DAY", "day": "1 DAY", "hour": "1 HOUR"}[interval]
    every = [r[0] for r in spark.sql(
        f"SELECT explode(sequence(timestamp_ntz'{min(starts)}', timestamp_ntz'{max(starts)}', INTERVAL {step}))").collect()]
    assert found == [(k, starts.count(k)) for k in every]


def test_stray_times(spark):
    """One wrong year makes a gap of billions of minutes: it is reported, and refused where a bound is set."""
    df = spark.sql(
        "SELECT timestamp_ntz'0001-01-01 00:00:00' AS ts UNION ALL SELECT timestamp_ntz'2020-05-05 10:00:30' "
        "UNION ALL SELECT timestamp_ntz'2020-05-05 10:02:00' UNION ALL SELECT timestamp_ntz'9999-12-31 23:59:59'")
    gaps = wide_gaps(df, "ts", "minute", 1000).collect()
    assert [(r.key.year, r.next.year) for r in gaps] == [(1, 2020), (2020, 9999)] and all(r.empty > 10**9 for r in gaps)
    with pytest.raises(Exception, match="more than 100000 empty buckets between"):
        date_histogram(df, "ts", "minute", max_gap=100_000).count()
    assert date_histogram(df.where("year(ts) = 2020"), "ts", "minute", max_gap=1).count() == 3
    # without a bound nothing is built that is longer than a year of buckets
    assert date_histogram(df, "ts", "day").count() == (dt.date(9999, 12, 31) - dt.date(1, 1, 1)).days + 1


def test_segments_and_mapping(spark, tmp_path):
    df = spark.range(5000).select("id", F.struct(F.lit("x").alias("a"), F.lit(1.5).alias("b")).alias("s"))
    path = str(tmp_path / "a b")
    df.repartition(3).write.option("parquet.block.size", 4096).option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    rows = table_segments(stored).collect()
    assert len({r.path for r in rows}) == 3 and sum(r.n_rows for r in rows) == 5000
    assert {(r.n_columns, r.codec) for r in rows} == {(3, "ZSTD")} and all(0 < r.n_bytes for r in rows)
    assert [tuple(r) for r in table_mapping(stored).collect()] == [
        ("id", "bigint", True), ("s", "struct<a:string,b:double>", True), ("s.a", "string", True), ("s.b", "double", True)]
