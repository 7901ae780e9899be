import html as python_html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.references import decode_references
from corpusmill.operators.outline import CONTAINERS, HEADINGS, outline_html


def rows(df):
    return [(r.pos, r.type, r.text, r.depth, r.parent_pos) for r in outline_html(df).orderBy("doc_id", "pos").collect()]


def test_nested_lists_and_sections(spark):
    page = """<title>T</title><h1>A</h1><p>intro<section><h2>B</h2><ul><li>one<ul><li>deep</li><li>deeper<ol><li>x</ol></ul>
      <li><p>two</p><p>more</p></li></ul><table><tr><td>1<td><p>2</p><table><tr><td>3</table></table>tail</section>
      <p>after</p><h2>C</h2><img src="a" alt="pic &eacute;">caption<h1>D</h1><div><h3>E</h3><p>in</div>out</ul><table><tr><td>open"""
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "plain")], "doc_id int, html string")
    assert rows(df) == [
        (0, "Title", "T", 0, None), (1, "Title", "A", 1, 0), (2, "NarrativeText", "intro", 2, 1),
        (3, "Title", "B", 2, 1), (4, "ListItem", "one", 3, 3), (5, "ListItem", "deep", 4, 4), (6, "ListItem", "deeper", 4, 4),
        (7, "ListItem", "x", 5, 6), (8, "ListItem", "two", 3, 3), (9, "NarrativeText", "more", 4, 8), (10, "Table", "1 2 3", 3, 3),
        (11, "NarrativeText", "tail", 3, 3), (12, "NarrativeText", "after", 2, 1), (13, "Title", "C", 2, 1),
        (14, "Image", "pic é", 3, 13), (15, "NarrativeText", "caption", 3, 13), (16, "Title", "D", 1, 0), (17, "Title", "E", 2, 16),
        (18, "NarrativeText", "in", 3, 17), (19, "NarrativeText", "out", 2, 16), (20, "Table", "open", 2, 16),
        (0, "NarrativeText", "plain", 0, None),
    ]


def by_python(pieces):
    """The same rules over a list of tags and texts, with a list as the stack."""
    stack, out, depth, cells = [], [], 0, []

    def emit(kind, text):
        if text or kind == "Image":
            above = [e["pos"] for e in stack if e["pos"] is not None]
            out.append((len(out), kind, text, len(above), above[-1] if above else None))
            return len(out) - 1

    for tag, text in [*pieces, ("end", "")]:
        if depth:
            depth = 0 if tag == "end" else depth + (tag == "table") - (tag == "/table")
            if depth:
                cells.append(text)
                continue
            emit("Table", " ".join(" ".join(cells).split()))
            emit("NarrativeText", text)
            continue
        if tag == "table":
            depth, cells = 1, [text]
            continue
        if tag in CONTAINERS:
            stack.append({"tag": tag, "pos": None})
        elif tag[1:] in CONTAINERS and any(e["tag"] == tag[1:] for e in stack):
            while stack.pop()["tag"] != tag[1:]:
                pass
        elif tag in HEADINGS:
            while stack and stack[-1]["tag"] == "h" and stack[-1]["level"] >= HEADINGS[tag]:
                stack.pop()
        elif tag in ("li", "/li"):
            lists = [i for i, e in enumerate(stack) if e["tag"] in ("ul", "ol")]
            stack = stack[: lists[-1] + 1] if lists else [e for e in stack if e["tag"] != "li"]
            if tag == "li":
                stack.append({"tag": "li", "pos": None})
        if tag == "img":
            emit("Image", "alt")
        if not text:
            continue
        if tag in HEADINGS:
            at = emit("Title", text)
            stack.append({"tag": "h", "level": HEADINGS[tag], "pos": at})
        elif tag == "li" or (tag == "p" and stack and stack[-1]["tag"] == "li" and stack[-1]["pos"] is None):
            stack[-1]["pos"] = emit("ListItem", text)
        else:
            emit("NarrativeText", text)
    return out


def test_random_pages(spark):
    """Any order of tags, closed or not, against the same rules in Python."""
    draw = random.Random(4)
    tags = ["ul", "ol", "div", "section", "h1", "h2", "h3", "p", "li", "li", "li", "table", "img"]
    pages = []
    for i in range(150):
        pieces = []
        for _ in range(draw.randint(0, 60) if i else 400):
            tag = draw.choice(tags)
            if tag != "img" and draw.random() < 0.45:
                tag = "/" + tag
            pieces.append((tag, draw.choice(["", "", "word", "two words"])))
        pages.append(pieces)
    text = ["".join(f"<{t} alt='alt'>{x}" if t == "img" else f"<{t}>{x}" for t, x in p) for p in pages]
    df = spark.createDataFrame(list(enumerate(text)), "doc_id int, html string")
    found = {}
    for r in outline_html(df).orderBy("doc_id", "pos").collect():
        found.setdefault(r.doc_id, []).append((r.pos, r.type, r.text, r.depth, r.parent_pos))
    for i, p in enumerate(pages):
        assert found.get(i, []) == by_python(p), text[i]


@pytest.mark.parametrize("text", ["<div><p>x", "<ul><li>x", "<table><tr><td>x"])
def test_many_pieces(spark, text):
    df = spark.createDataFrame([(1, text * 3000)], "doc_id int, html string")
    assert outline_html(df).agg(F.max("pos")).first()[0] == (0 if "table" in text else 2999)


def test_references(spark):
    names = [n for n in html5 if n.endswith(";") and html5[n] not in ("\n", " ")]
    texts = ["&" + n for n in names] + [
        "a &amp;lt; b", "&#8217;&#x2019;&#X2014;", "&#0;&#xD800;&#1114112;&#999999999;", "&#150;&#x80;", "&unknown; & &; &#; &#x; &amp",
        "caf&eacute;s & bars", "", "no reference", "&NewLine;x", "&nbsp;x",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.d for r in df.select("i", decode_references(F.col("t")).alias("d")).collect()}
    for i, t in enumerate(texts[: len(names) + 2]):
        assert got[i] == python_html.unescape(t), t
    rest = [got[i] for i in range(len(names) + 2, len(texts))]
    assert rest == ["�" * 4, "–€", "&unknown; & &; &#; &#x; &amp", "cafés & bars", "", "no reference", "\nx", " x"]
    assert spark.range(1).select(decode_references(F.lit(None).cast("string"))).first()[0] is None
