import pytest

from corpusmill.session import scratch_path, shared_dir
from corpusmill.sources import files
from corpusmill.sources.files import (
    TASK_BYTES, accepted, scan_documents, scan_tasks, scan_text_files, url_manifest, validate_manifest,
)
from corpusmill.sources.tables import next_offset, read_page, sample_rows, scroll, write_clustered


def test_scans_are_recursive(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "one.PDF").write_bytes(b"12345")
    (tmp_path / "a" / "b" / "two.html").write_text("<p>é</p>\nend", encoding="utf-8")
    found = {r.filename: (r.filetype, r.length) for r in scan_documents(spark, str(tmp_path)).collect()}
    assert found == {"one.PDF": ("pdf", 5), "two.html": ("html", 13)}
    assert scan_documents(spark, str(tmp_path), "*.PDF").first().content == b"12345"
    text = scan_text_files(spark, str(tmp_path), "*.html").collect()
    assert [(r.filename, r.filetype, r.content) for r in text] == [("two.html", "html", "<p>é</p>\nend")]
    assert text[0].path.endswith("/a/b/two.html")


def test_manifest(spark):
    df = spark.createDataFrame(
        [("http://x/a.pdf", "Application/PDF", 3), ("http://x/b?c=1", "text/html", 2),
         ("http://x/", None, 0), ("c", "application/octet-stream", None)],
        "url string, content_type string, length int",
    )
    found = [tuple(r)[1:] for r in validate_manifest(url_manifest(df)).drop("url").collect()]
    assert found == [
        (3, "a.pdf", "workflow-docs/pdf/a.pdf", False, False),
        (2, "b?c=1.pdf", "workflow-docs/pdf/b?c=1.pdf", True, False),
        (0, ".pdf", "workflow-docs/pdf/.pdf", True, True),
        (None, "c.pdf", "workflow-docs/pdf/c.pdf", False, True),
    ]
    assert accepted(validate_manifest(df)).count() == 2


def test_scroll_visits_every_row_once(spark):
    df = spark.range(23).selectExpr("id", "'p' AS payload", "array(1) AS vector").repartition(4)
    seen, after = [], None
    while True:
        page = scroll(df, 5, after)
        assert page.columns == ["id", "payload"]
        seen += [r.id for r in page.collect()]
        after = next_offset(page, 5)
        if after is None:
            break
    assert seen == list(range(23))
    assert scroll(df, 5, with_payload=False, with_vectors=True).columns == ["id", "vector"]
    assert "TakeOrderedAndProject" in scroll(df, 5)._jdf.queryExecution().executedPlan().toString()


def test_session_helpers(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_sample(spark):
    rows = sample_rows(spark.range(9).selectExpr("9 - id AS k", "id"), 2, "k", ["id"]).collect()
    assert [tuple(r) for r in rows] == [(1, 8), (2, 7)]


def test_filters_reach_the_file(spark):
    from corpusmill.functions.predicates import between_range, match_keyword, since

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    df = orders.where(
        between_range("o_totalprice", gte=100)
        & since("o_orderdate", "30d", "2001-08-01")
        & match_keyword("o_orderstatus", "F")
    ).select("o_orderkey")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for part in (
        "GreaterThanOrEqual(o_totalprice", "GreaterThanOrEqual(o_orderdate", "EqualTo(o_orderstatus",
    ):
        assert part in pushed


def test_pages_of_clustered_files(spark, tmp_path):
    path = str(tmp_path / "c d")
    df = spark.range(5000).selectExpr("id * 3 AS id", "'p' AS payload", "array(1) AS vector").repartition(7)
    write_clustered(df, path, "id", 20)
    n_files = len(spark.read.parquet(f"{path}/rows").inputFiles())
    assert n_files == 20
    seen, after, read = [], None, []
    while True:
        page = read_page(spark, path, 100, after)
        read.append(len(page.inputFiles()))
        found = [r.id for r in page.collect()]
        if not found:
            break
        assert "vector" not in page.columns and page.columns == ["id", "payload"]
        seen += found
        after = next_offset(page, 100)
        if after is None:
            break
    assert seen == [3 * i for i in range(5000)] and max(read) <= 2
    assert read_page(spark, path, 10, 10**9).count() == 0
    everything = read_page(spark, path, 10_000, with_vectors=True)
    assert everything.count() == 5000 and "vector" in everything.columns


def test_small_files_share_a_task(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    scan = scan_text_files(spark, str(tmp_path), "*.txt")
    assert scan.rdd.getNumPartitions() <= 8
    assert {r.content for r in scan.collect()} == {f"text {i}" for i in range(1000)}
    assert scan_documents(spark, f"{tmp_path}/9*.txt").count() == 111
    named = scan_documents(spark, str(tmp_path)).select("filename", "length")
    assert "content" not in named._jdf.queryExecution().executedPlan().toString().lower().replace("binaryfile", "")
    assert scan_tasks(spark, 10 * TASK_BYTES, 20) == 10 and scan_tasks(spark, 0, 0) == 1


def test_no_names_of_files_in_the_driver(spark, tmp_path):
    """Tasks list the files: a plan holds the files of the list, not one entry for each file that is scanned."""
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text("text")
    scan = scan_documents(spark, str(tmp_path))
    assert len(scan.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism and scan.count() == 300


def test_lists_are_those_of_the_file_scan(spark, tmp_path):
    """Odd names, hidden ones, empty files, links and depths, with and without patterns, as Spark's own scan has them."""
    for name in (
        "one.txt", "a b%20c.TXT", "é.txt", "_hidden.txt", "_k=v.txt", ".dot.txt", "x._COPYING_", "_metadata.txt", "noending",
        "_gone/a.txt", "_metadata_x/b.txt", "k=1/c.txt", "d/e/f/g/h.txt", "d/e/i.csv", "d/.j/k.txt", "line\nend.txt",
    ):
        place = tmp_path / "in" / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(f"text of {name}")
    (tmp_path / "in" / "empty.txt").write_text("")
    (tmp_path / "in" / "nothing").mkdir()
    (tmp_path / "far").mkdir()
    (tmp_path / "far" / "l.txt").write_text("linked")
    (tmp_path / "in" / "link").symlink_to(tmp_path / "far")
    (tmp_path / "in" / "m.txt").symlink_to(tmp_path / "far" / "l.txt")
    (tmp_path / "in" / "broken.txt").symlink_to(tmp_path / "none")
    folder = str(tmp_path / "in")
    for path, glob in (
        (folder, None), (f"file:{folder}", "*.txt"), (folder, "{?,noending}*[!v]"), (f"{folder}/*/e", None), (f"{folder}/*.txt", None),
        (f"{folder}/one.txt", None), (f"{folder}/nothing", None),
    ):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        theirs = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
        ours = scan_documents(spark, path, glob).select(theirs.columns)
        assert ours.dtypes == theirs.dtypes and sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect())), (path, glob)
    with pytest.raises(Exception, match="none"):
        scan_documents(spark, str(tmp_path / "none"))


def test_large_and_small_contents(spark, tmp_path, monkeypatch):
    """Files leave a task in pieces bounded by bytes, each with the content of its own path."""
    monkeypatch.setattr(files, "BYTES_AT_ONCE", 50)
    monkeypatch.setattr(files, "NAMES_AT_ONCE", 7)
    expected = {}
    for i in range(60):
        (tmp_path / str(i % 5)).mkdir(exist_ok=True)
        expected[f"{i}.txt"] = f"{i}-" * (1 + 100 * (i % 7 == 0))
        (tmp_path / str(i % 5) / f"{i}.txt").write_text(expected[f"{i}.txt"])
    assert {r.filename: r.content for r in scan_text_files(spark, str(tmp_path)).coalesce(1).collect()} == expected


def test_another_store_is_listed_by_spark(spark, tmp_path):
    """Only mounted folders are walked by tasks."""
    (tmp_path / "a.txt").write_text("text")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.own.link./in", f"file://{tmp_path}")
    assert files.walkable(spark, str(tmp_path)) and not files.walkable(spark, "viewfs://own/in")
    assert [(r.filename, r.content) for r in scan_text_files(spark, "viewfs://own/in").collect()] == [("a.txt", "text")]
