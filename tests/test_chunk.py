import random
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.chunk import chunk_by_title, explode_chunks, packed
from corpusmill.schemas import METADATA_TYPE

SCHEMA = (
    "doc_id int, pos int, type string, text string, "
    "metadata struct<filename:string,filetype:string,page_number:int>"
)


def by_python(elements, max_chars, new_after, overlap):
    """The rule, one element at a time."""
    chunks, step = [], max_chars - overlap
    for kind, text in elements:
        if not text:
            continue
        starts = range(0, max(1, len(text) - overlap), step) if len(text) > max_chars else [0]
        for i, at in enumerate(starts):
            piece = text[at : at + max_chars]
            opens = (
                not chunks
                or (kind == "Title" and i == 0)
                or len(chunks[-1]) >= new_after
                or len(chunks[-1]) + 1 + len(piece) > max_chars
            )
            if opens:
                chunks.append(piece)
            else:
                chunks[-1] += "\n" + piece
    return chunks


def documents(seed):
    rng = random.Random(seed)
    even = [("NarrativeText", "e" * 9)] * 300
    mixed = [
        (
            "Title" if rng.random() < 0.1 else "NarrativeText",
            "".join(rng.choices("aé😀 x", k=rng.choice([0, 1, 5, 30, 49, 50, 51, 230]))),
        )
        for _ in range(200)
    ]
    return {1: even, 2: mixed, 3: [("Title", "t" * 400)], 4: [("NarrativeText", "")], 5: mixed[:3]}


def rows(df):
    found = {}
    for r in df.orderBy("doc_id", "chunk_no").collect():
        found.setdefault(r.doc_id, []).append(r.text)
        assert r.chunk_no == len(found[r.doc_id]) - 1
        assert r.n_chars == len(r.text)
    return found


@pytest.mark.parametrize("sizes", [(50, 40, 0), (50, 50, 7), (120, 60, 119)])
def test_both_forms_follow_the_rule(spark, sizes):
    docs = documents(1)
    data = [
        (d, pos, kind, text, None)
        for d, els in docs.items()
        for pos, (kind, text) in enumerate(els)
    ]
    random.Random(2).shuffle(data)
    elements = spark.createDataFrame(data, SCHEMA)
    expected = {d: c for d, els in docs.items() if (c := by_python(els, *sizes))}

    assert rows(chunk_by_title(elements, *sizes)) == expected
    # documents 1 and 2 in blocks, those in spans
    in_blocks = chunk_by_title(elements, *sizes, block_elements=64, span_blocks=2)
    assert rows(in_blocks) == expected

    arrays = elements.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "type", "text"))).alias("els")
    )
    meta = F.lit(None).cast(METADATA_TYPE)
    in_rows = explode_chunks(arrays, "doc_id", packed("els", *sizes), meta)
    assert rows(in_rows) == expected


def test_groups_are_bounded_by_length(spark, monkeypatch):
    """Few but long elements go into blocks of bounded length too, and give the same chunks."""
    from corpusmill.operators import chunk

    rng = random.Random(7)
    docs = {1: [("Title" if rng.random() < 0.2 else "NarrativeText", "x" * rng.choice([1, 40, 3000, 9000])) for _ in range(40)],
            2: [("NarrativeText", "ab" * 10)] * 5, 3: [("NarrativeText", "c" * 50_000)]}
    data = [(d, p, k, t, None) for d, els in docs.items() for p, (k, t) in enumerate(els)]
    elements = spark.createDataFrame(data, SCHEMA)
    expected = {d: by_python(els, 50, 40, 0) for d, els in docs.items()}
    assert rows(chunk_by_title(elements, 50, 40, 0, block_elements=64, span_blocks=3, block_chars=1000)) == expected
    source = elements.select("doc_id", "pos", F.struct("type", "text").alias("e"), "metadata")
    blocks = chunk._in_blocks(source, 50, 0, 64).groupBy("doc_id", "block").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    found = {}
    for r in blocks.orderBy("doc_id", "block").collect():
        assert r.n <= 64
        found.setdefault(r.doc_id, []).append(r.block)
    assert all(b == list(range(len(b))) for b in found.values()) and len(found[3]) == 16 and len(found[1]) > 20


def test_limits_and_completeness(spark):
    docs = documents(3)
    data = [
        (d, p, "NarrativeText", t, None) for d, els in docs.items() for p, (_, t) in enumerate(els)
    ]
    found = rows(chunk_by_title(spark.createDataFrame(data, SCHEMA), 300, 200, 0))
    for d, els in docs.items():
        chunks = found.get(d, [])
        assert all(0 < len(c) <= 300 for c in chunks)
        text = "\n".join(t for _, t in els if t)
        if all(len(t) <= 300 for _, t in els):
            assert "\n".join(chunks) == text


def test_bad_sizes():
    with pytest.raises(ValueError):
        packed("e", 100, 200, 0)
    with pytest.raises(ValueError):
        packed("e", 100, 50, 100)


def test_many_chunks_in_one_document(spark):
    """Twice the chunks take about twice the time; appending to one array takes four times."""

    def seconds(n):
        element = F.struct(F.lit("Title").alias("type"), F.lit("body").alias("category"), F.lit("a word").alias("text"))
        df = spark.range(1).select("id", F.array_repeat(element, n).alias("elements"))
        began = time.perf_counter()
        assert df.select(F.size(packed("elements")).alias("n")).first().n == n
        return time.perf_counter() - began

    seconds(100)
    assert seconds(80_000) < 8
