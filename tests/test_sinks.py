import os
import uuid

import pytest
from pyspark.sql import functions as F

from corpusmill.plans.flow import DocumentFlow
from corpusmill.sinks import tables
from corpusmill.sinks.points import (
    collection_dim, ensure_collection, read_points, write_points,
)
from corpusmill.schemas import SchemaConflict, fields
from corpusmill.sinks.tables import PART, kept_rows, read_table, upsert, upsert_table
from corpusmill.sinks.text import write_clean_text
from corpusmill.sources.files import scan_text_files


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame(
        [(2, "x", 1), (2, "y", 3), (2, "z", 2), (3, "c", 1)], "id int, v string, seq int"
    )
    once = upsert(old, new, "id", "seq")
    expected = [(1, "a"), (2, "y"), (3, "c")]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, upsert(once, new, "id", "seq").collect())) == expected


@pytest.fixture
def name(spark):
    """The name of a table, which is dropped after the test."""
    chosen = f"t_{uuid.uuid4().hex}"
    yield chosen
    spark.sql(f"DROP TABLE IF EXISTS {chosen}")


def mtimes(spark, name):
    return {f: os.stat(f.removeprefix("file:")).st_mtime_ns for f in spark.table(name).inputFiles()}


def test_upsert_rewrites_only_the_parts_it_touches(spark, name):
    first = spark.range(1000).select(F.col("id"), F.lit("old").alias("v"), F.lit(0).alias("seq"))
    load = upsert_table(spark, name, first, "id", "seq", parts=8, buckets=4)
    assert (load.received, load.written, load.replaced, load.added, load.refused) == (1000, 1000, 0, 1000, 0)
    before = mtimes(spark, name)
    change = spark.createDataFrame(
        [(5, "new", 1.5, 1), (5, "newer", 2.5, 2)], "id long, v string, w double, seq int"
    )
    for _ in range(2):
        load = upsert_table(spark, name, change, "id", "seq", parts=8, buckets=4)
        assert (load.received, load.written, load.replaced, load.added) == (2, 1, 1, 0)
    rows = {r.id: (r.v, r.w) for r in read_table(spark, name).collect()}
    assert len(rows) == 1000
    assert rows.pop(5) == ("newer", 2.5)
    assert set(rows.values()) == {("old", None)}
    after = mtimes(spark, name)
    # seven of eight parts are as they were; the other has a file for each bucket, and one for the new row
    assert sum(f in before and before[f] == t for f, t in after.items()) == 7 * 4
    assert len(after) <= 7 * 4 + 4 + 1
    with pytest.raises(ValueError, match="buckets"):
        upsert_table(spark, name, change, "id", "seq", parts=8, buckets=2)


def test_old_rows_are_not_shuffled(spark, name):
    first = spark.range(1000).select(F.col("id"), F.lit("old").alias("v"))
    upsert_table(spark, name, first, "id", None, parts=4, buckets=4)
    old = spark.table(name).where(F.col(PART).isin(1, 2))
    plan = kept_rows(old, spark.range(50), "id", False)._jdf.queryExecution().executedPlan().toString()
    left, right = plan.split("Exchange")[0], plan.split("Exchange")[1:]
    assert "Bucketed: true" in left and "_part" in left and len(right) == 1


def test_refused_rows(spark, name):
    declared = fields(id="long", price="double", v="string")
    new = spark.createDataFrame(
        [("1", "2.5", "a", 1), ("2", "dear", "b", 1), ("x", "1", "c", 1), ("3", "1", "", 1), ("4", None, "d", 1), ("1", "3", "e", 0)],
        "id string, price string, v string, seq int",
    )
    load = upsert_table(spark, name, new, "id", "seq", parts=2, buckets=2, declared=declared, required=["v"])
    assert (load.received, load.written, load.replaced, load.refused) == (6, 2, 0, 3)
    assert sorted(map(tuple, read_table(spark, name).collect())) == [(1, 2.5, "a"), (4, None, "d")]
    failures = {(r.id, r.error) for r in load.failures.collect()}
    assert failures == {("2", "type: price"), ("x", "type: id"), ("3", "missing: v")}
    again = upsert_table(spark, name, new.limit(0), "id", "seq", parts=2, buckets=2, declared=declared, required=["v"])
    assert (again.received, again.written, again.replaced) == (0, 0, 0)


def test_collection(spark, name):
    path = name
    assert collection_dim(spark, path) is None
    ensure_collection(spark, path, 2)
    ensure_collection(spark, path, 2)
    assert collection_dim(spark, path) == 2
    with pytest.raises(ValueError, match="dimension"):
        ensure_collection(spark, path, 3)
    points = spark.createDataFrame(
        [(str(i), [3.0, 4.0], ("Title", "heading", "t")) for i in range(7)],
        "id string, vector array<float>, payload struct<type:string,category:string,text:string>",
    ).coalesce(1)
    write_points(points, path, 2, batch_size=3)
    stored = read_points(spark, path)
    assert stored.count() == 7
    assert stored.first().vector == pytest.approx([0.6, 0.8])
    assert stored.select("payload.type").distinct().collect()[0][0] == "Title"
    write_points(points.withColumn("id", F.lit("same")), path, 2, batch_size=1)
    assert read_points(spark, path).count() == 8
    write_points(points, path, 2, batch_size=1)
    assert read_points(spark, path).count() == 8
    bad = points.withColumn("vector", F.array(F.lit(1.0)).cast("array<float>"))
    with pytest.raises(Exception, match="dimension 2 is needed"):
        write_points(bad, path, 2)
    assert read_points(spark, path).count() == 8


def test_types_stay(spark, name):
    first = spark.range(5).select("id", F.lit("a").alias("v"), F.struct(F.lit("x").alias("x")).alias("s"))
    upsert_table(spark, name, first, "id", None, parts=2, buckets=2)
    with pytest.raises(SchemaConflict, match="v: int is not string"):
        upsert_table(spark, name, first.withColumn("v", F.lit(1)), "id", None, parts=2, buckets=2)
    assert read_table(spark, name).count() == 5
    # structs may gain fields, and rows that lack these may come later
    wider = first.where("id = 1").withColumn("s", F.struct(F.lit("z").alias("x"), F.lit(7).alias("y")))
    upsert_table(spark, name, wider, "id", None, parts=2, buckets=2)
    upsert_table(spark, name, first.where("id = 2"), "id", None, parts=2, buckets=2)
    found = {r.id: (r.s.x, r.s.y) for r in read_table(spark, name).collect()}
    assert found == {0: ("x", None), 1: ("z", 7), 2: ("x", None), 3: ("x", None), 4: ("x", None)}


def test_text(spark, tmp_path):
    df = spark.createDataFrame([("a.py", "x\n\ny\n"), ("b.py", "z")], "filename string, content string")
    table = str(tmp_path / "table")
    write_clean_text(df, table)
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [("a.py", "x\n\ny\n"), ("b.py", "z")]
    with pytest.raises(ValueError):
        write_clean_text(df, table)
    files = str(tmp_path / "files")
    named = spark.createDataFrame(
        [("a.txt", "x\n\ny\n"), ("b é.txt", "z"), ("c.txt", None)], "filename string, content string"
    )
    write_clean_text(named, files, layout="files")
    read = scan_text_files(spark, files, "*.txt").collect()
    assert sorted((r.filename, r.content) for r in read) == [("a.txt", "x\n\ny\n"), ("b é.txt", "z")]
    # written, but a scan passes over files of zero bytes
    assert os.path.getsize(os.path.join(files, "c.txt")) == 0
    for names in (["a", "a"], [None], ["a/b"], [".."]):
        bad = spark.createDataFrame([(n, "x") for n in names], "filename string, content string")
        with pytest.raises(ValueError):
            write_clean_text(bad, str(tmp_path / "bad"), layout="files")
    with pytest.raises(ValueError):
        write_clean_text(df, str(tmp_path / "zip"), layout="zip")


def test_flow(spark, name):
    html = "<h1>T</h1><p>one two</p><h2>U</h2><p>three ![i](data:image/png;base64,QQ==)</p>"
    docs = spark.createDataFrame(
        [(1, html, "a.html"), (2, "<p></p>", "b.html")], "doc_id int, content string, name string"
    )
    flow = DocumentFlow("html", filename="name", dim=32, strip_images=True)
    assert flow.elements(docs).count() == 4
    assert [r.text for r in flow.chunks(docs).orderBy("chunk_no").collect()] == ["T\none two", "U\nthree"]
    plan = flow.points(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    path = name
    assert flow.run(docs, path).added == 2
    load = flow.run(docs.unionByName(spark.createDataFrame([(3, "<p>---</p>", "c.html")], docs.schema)), path)
    assert (load.written, load.replaced) == (3, 2)
    rows = read_points(spark, path).orderBy("id").collect()
    assert (rows.pop().id, len(rows)) == ("doc-3-0", 2)
    assert [r.id for r in rows] == ["doc-1-0", "doc-1-1"]
    assert rows[0].payload.metadata.filename == "a.html" and len(rows[0].vector) == 32

    own = DocumentFlow(
        lambda b: [("Title", "T", 1), ("Text", b.decode(), 2)], dim=2,
        model=lambda texts: [[1.0, 0.0] for _ in texts],
    )
    binary = spark.createDataFrame([(1, bytearray(b"abc"))], "doc_id int, content binary")
    point = own.points(binary).first()
    assert (point.payload.text, point.vector) == ("T\nabc", [1.0, 0.0])
    with pytest.raises(ValueError):
        DocumentFlow("odt").elements(docs)


def test_null_and_equal_versions(spark, tmp_path):
    """A NULL version loses to any other, and a lone one stays; a NULL key is replaced like any key."""
    rows = spark.createDataFrame(
        [(1, "a", None), (2, "b", None), (2, "c", 3), (None, "d", 1)], "id int, v string, seq int"
    )
    old = spark.createDataFrame([(None, "old"), (5, "e")], "id int, v string")
    found = {(r.id, r.v) for r in upsert(old, rows, "id", "seq").collect()}
    assert found == {(1, "a"), (2, "c"), (None, "d"), (5, "e")}
    equal = spark.createDataFrame([(1, c, 7) for c in "abcdef"], "id int, v string, seq int")
    picked = {upsert(old, equal.repartition(n), "id", "seq").where("id = 1").first().v for n in (1, 2, 5)}
    assert len(picked) == 1


def test_null_keys_in_a_table(spark, name):
    first = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b")], "id int, v string")
    upsert_table(spark, name, first, "id", None, parts=2, buckets=2)
    assert sorted(map(str, read_table(spark, name).collect())) == ["Row(id=1, v='a')", "Row(id=None, v='b')"]
    load = upsert_table(spark, name, spark.createDataFrame([(None, "c"), (2, "d")], first.schema), "id", None, parts=2, buckets=2)
    assert (load.written, load.replaced) == (2, 1)
    assert {(r.id, r.v) for r in read_table(spark, name).collect()} == {(1, "a"), (None, "c"), (2, "d")}


def test_column_of_one_part_stays(spark, name):
    rows = [(i, "a", 1) for i in range(20)]
    upsert_table(spark, name, spark.createDataFrame(rows, "id int, v string, seq int"), "id", "seq", parts=2, buckets=2)
    upsert_table(spark, name, spark.createDataFrame([(3, "b", "new", 2)], "id int, v string, w string, seq int"), "id", "seq", parts=2, buckets=2)
    rows = [(i, "c", 3) for i in range(20) if i != 3]
    upsert_table(spark, name, spark.createDataFrame(rows, "id int, v string, seq int"), "id", "seq", parts=2, buckets=2)
    found = {r.id: (r.v, r.w) for r in read_table(spark, name).collect()}
    assert found == {i: ("b", "new") if i == 3 else ("c", None) for i in range(20)}


def test_a_large_load_has_more_tasks_than_buckets(spark, name, monkeypatch):
    """Few buckets do not make few tasks of a load, and rows stay in their bucket and part."""
    monkeypatch.setattr(tables, "TASK_BYTES", 1000)
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    marked = tables.dealt(rows.withColumn(tables.PART, tables._part("k", 3)), "k", 3, 2, 20_000)
    assert marked.rdd.getNumPartitions() == 24
    where = marked.select(F.spark_partition_id().alias("p"), tables.PART, F.pmod(F.hash("k"), F.lit(2)).alias("b"))
    assert where.groupBy("p").agg(F.count_distinct(tables.PART, "b").alias("n")).where("n <> 1").count() == 0
    for _ in range(2):
        done = upsert_table(spark, name, rows, "k", None, parts=3, buckets=2)
    assert (done.written, done.replaced) == (3000, 3000)
    assert sorted(map(tuple, read_table(spark, name).collect())) == sorted(map(tuple, rows.collect()))


def test_text_files_in_folders(spark, tmp_path):
    """So many files that one folder would be too large are dealt to several, with the same names and texts."""
    rows = [(f"{i}.txt", f"text {i}") for i in range(100)]
    write_clean_text(spark.createDataFrame(rows, "filename string, content string"), str(tmp_path / "f"), layout="files", folders=4)
    assert sorted(os.listdir(tmp_path / "f")) == ["0", "1", "2", "3"]
    assert sorted((r.filename, r.content) for r in scan_text_files(spark, str(tmp_path / "f")).collect()) == sorted(rows)
