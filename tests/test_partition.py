import time

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.partition import parse_with, partition_html, partition_text, partition_with


def elements(df):
    return [(r.pos, r.type, r.category, r.text) for r in df.orderBy("doc_id", "pos").collect()]


def test_html(spark):
    html = """<html><head><title>A &amp; B</title><script>var t="<p>no</p>";</script></head>
      <!-- <p>hidden</p> --><h2 class="x">Head</h2><p>One <b>two</b><br>three
      <p>Open</p><p> </p><ul><li>First</li></ul>
      <table><tr><td>1</td><td><p>2</p></td></tr></table><img src="a.png" alt=" Cat ">
      <IMG src='b'><P>&lt;end&gt;</P>"""
    df = spark.createDataFrame([(1, html)], "doc_id int, html string")
    assert elements(partition_html(df)) == [
        (0, "Title", "heading", "A & B"),
        (1, "Title", "heading", "Head"),
        (2, "NarrativeText", "body", "One two three Open"),
        (3, "ListItem", "list", "First"),
        (4, "Table", "table", "1 2"),
        (5, "Image", "image", "Cat"),
        (6, "Image", "image", ""),
        (7, "NarrativeText", "body", "<end>"),
    ]


def test_html_text_outside_of_blocks(spark):
    html = """loose<div>in a div</div><blockquote>quoted <i>words</i></blockquote><p>para</p>
      <pre>code</pre><dl><dt>term</dt></dl><footer>foot</footer>tail <p>open"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "doc_id int, html string")
    assert elements(partition_html(df)) == [
        (0, "NarrativeText", "body", "loose in a div quoted words"),
        (1, "NarrativeText", "body", "para"),
        (2, "NarrativeText", "body", "code term foot tail open"),
    ]


def test_html_tags_without_an_end(spark):
    html = """<!-- hidden <p>x</p> --><script>gone()</script><h1>Head</h1><table><tr><td>1</td></table>
      <p>closed</p><table><tr><td>2 <style>a <script>b <!-- c <h2>last <p>open"""
    df = spark.createDataFrame([(1, html)], "doc_id int, html string")
    assert elements(partition_html(df)) == [
        (0, "Title", "heading", "Head"),
        (1, "Table", "table", "1"),
        (2, "NarrativeText", "body", "closed"),
        (3, "NarrativeText", "body", "2 a b last open"),
    ]


@pytest.mark.parametrize("tag", ["<table>", "<p>", "<script>"])
def test_html_is_linear(spark, tag):
    def seconds(n):
        df = spark.createDataFrame([(1, (tag + "word ") * n)], "doc_id int, html string")
        began = time.perf_counter()
        assert partition_html(df).count() >= 1
        return time.perf_counter() - began

    seconds(100)
    assert seconds(16_000) < 5


def test_parser_failures(spark):
    def parser(content):
        if content == b"bad":
            raise ValueError("not a document")
        return [("Title", content.decode(), 1)]

    df = spark.createDataFrame(
        [(1, bytearray(b"good")), (2, bytearray(b"bad")), (3, None)], "doc_id int, content binary"
    )
    parsed = {r.doc_id: (r.elements, r.error) for r in parse_with(df, parser).collect()}
    assert [e.text for e in parsed[1][0]] == ["good"]
    assert parsed[2] == (None, "ValueError: not a document") and parsed[3] == ([], None)
    rows = partition_with(df, parser).orderBy("doc_id").collect()
    assert [(r.doc_id, r.type, r.category, r.text) for r in rows] == [
        (1, "Title", "heading", "good"), (2, "Error", "error", "ValueError: not a document"),
    ]


def test_text(spark):
    text = "# Head\r\n\n  plain  \n- item\n2) two\n| a | b |\n![pic](x)\n#no\n\n##  \n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    assert elements(partition_text(df)) == [
        (0, "Title", "heading", "Head"),
        (1, "NarrativeText", "body", "plain"),
        (2, "ListItem", "list", "item"),
        (3, "ListItem", "list", "two"),
        (4, "Table", "table", "| a | b |"),
        (5, "Image", "image", "![pic](x)"),
        (6, "NarrativeText", "body", "#no"),
        (7, "NarrativeText", "body", "##"),
    ]


def test_metadata(spark):
    df = spark.createDataFrame([(1, "x", "u/a.txt")], "doc_id int, text string, path string")
    meta = partition_text(df, filename="path").first().metadata
    assert (meta.filename, meta.filetype, meta.page_number) == ("u/a.txt", "txt", None)


def test_own_parser(spark):
    def parser(content):
        return [("Title", content.decode()[:1], 1), ("Odd", content.decode(), None)]

    df = spark.createDataFrame([("k", bytearray(b"abc"))], "doc_id string, content binary")
    rows = partition_with(df, parser, filetype=F.lit("bin")).orderBy("pos").collect()
    assert [(r.doc_id, r.type, r.category, r.text, r.metadata.page_number) for r in rows] == [
        ("k", "Title", "heading", "a", 1), ("k", "Odd", "body", "abc", None),
    ]
    assert rows[0].metadata.filetype == "bin"
    nothing = partition_with(df, lambda content: [])
    assert nothing.count() == 0
