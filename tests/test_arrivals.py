import os
import uuid

import pytest
from pyspark.sql import functions as F

from corpusmill.plans.arrivals import arriving_documents, load_arrivals
from corpusmill.plans.flow import DocumentFlow
from corpusmill.sinks import points
from corpusmill.sinks.points import read_points
from corpusmill.sources.files import scan_text_files


@pytest.fixture
def names(spark):
    chosen = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    yield chosen
    for n in chosen:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_two_arrivals_are_one_batch(spark, tmp_path, names):
    folder, flow = tmp_path / "in", DocumentFlow("html", doc_id="path", filename="filename", dim=16)
    (folder / "deep").mkdir(parents=True)
    for i in range(5):
        (folder / f"a{i}.html").write_text(f"<h1>T{i}</h1><p>one two {i}</p>")
    checkpoint = str(tmp_path / "seen")
    first = load_arrivals(spark, str(folder), flow, names[0], checkpoint, "*.html", files_at_once=2)
    assert first == {"written": 5, "added": 5, "replaced": 0}
    assert load_arrivals(spark, str(folder), flow, names[0], checkpoint, "*.html") == {"written": 0, "added": 0, "replaced": 0}
    for i in range(3):
        (folder / "deep" / f"b{i}.html").write_text(f"<p>three {i}</p><h2>four</h2>")
    (folder / "other.txt").write_text("not this one")
    assert load_arrivals(spark, str(folder), flow, names[0], checkpoint, "*.html")["added"] == 6
    flow.run(scan_text_files(spark, str(folder), "*.html"), names[1])

    def rows(name):
        return sorted((r.id, r.payload.text, tuple(r.vector)) for r in read_points(spark, name).collect())

    assert rows(names[0]) == rows(names[1]) and len(rows(names[0])) == 11
    with pytest.raises(ValueError, match="document id"):
        load_arrivals(spark, str(folder), DocumentFlow("html"), names[0], checkpoint)


def test_batches_of_a_call_are_one_load(spark, tmp_path, names, monkeypatch):
    """The collection is written once for a call; points of a call that failed before that come with the next one."""
    folder, flow = tmp_path / "in", DocumentFlow("text", doc_id="path", filename="filename", dim=4)
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.txt").write_text(f"one two {i}")
    loads, upsert = [], points.upsert_table

    def counted(spark, name, *args, **kwargs):
        loads.append(name)
        if len(loads) == 1:
            raise OSError("no space")
        return upsert(spark, name, *args, **kwargs)

    monkeypatch.setattr(points, "upsert_table", counted)
    with pytest.raises(Exception, match="no space"):
        load_arrivals(spark, str(folder), flow, names[0], str(tmp_path / "seen"), files_at_once=2)
    (folder / "5.txt").write_text("three")
    assert load_arrivals(spark, str(folder), flow, names[0], str(tmp_path / "seen"), files_at_once=2)["added"] == 6
    assert len(loads) == 2 and read_points(spark, names[0]).count() == 6
    assert load_arrivals(spark, str(folder), flow, names[0], str(tmp_path / "seen"))["written"] == 0


def test_lists_of_arrivals(spark, tmp_path, names):
    """The stream reads lists of bounded length, not one entry for each file; none comes twice, and old times and gone files do no harm."""
    folder, seen = tmp_path / "in", str(tmp_path / "lists")
    flow = DocumentFlow("text", doc_id="path", filename="filename", dim=4)
    folder.mkdir()
    for i in range(120):
        (folder / f"{i}.txt").write_text(f"one two {i}")
    arriving_documents(spark, str(folder), seen, "*.txt", files_at_once=50)
    arriving_documents(spark, str(folder), seen, "*.txt", files_at_once=50)
    lists = spark.read.parquet(seen)
    assert lists.count() == lists.select("path").distinct().count() == 120
    sizes = lists.groupBy(F.input_file_name()).count().collect()
    assert 3 <= len(sizes) <= 8 and max(r["count"] for r in sizes) <= 50

    checkpoint = str(tmp_path / "seen")
    assert load_arrivals(spark, str(folder), flow, names[0], checkpoint, "*.txt", files_at_once=50)["added"] == 120
    # one that is years older than those that came before, and one that goes before its batch
    (folder / "old.txt").write_text("three")
    os.utime(folder / "old.txt", (0, 10**9))
    (folder / "gone.txt").write_text("four")
    arriving_documents(spark, str(folder), f"{checkpoint}/files", "*.txt")
    (folder / "gone.txt").unlink()
    assert load_arrivals(spark, str(folder), flow, names[0], checkpoint, "*.txt")["added"] == 1
    assert read_points(spark, names[0]).where("id LIKE '%/old.txt-0'").count() == 1
    assert read_points(spark, names[0]).count() == 121


def test_arrivals_from_another_store(spark, tmp_path, names):
    """What tasks cannot walk comes by Spark's own stream of files."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one two")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.late.link./in", f"file://{tmp_path}/in")
    flow = DocumentFlow("text", doc_id="path", filename="filename", dim=4)
    for added in (1, 0):
        assert load_arrivals(spark, "viewfs://late/in", flow, names[0], str(tmp_path / "seen"), "*.txt")["added"] == added
