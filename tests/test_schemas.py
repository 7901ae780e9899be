import pytest

from corpusmill.schemas import (
    PARTIAL_RECORD_FIELDS, RECORD_SCHEMA, SchemaConflict, ensure_schema, ensure_table, fields,
    first_failures, found_fields, load_tally, new_fields, split_valid, typed_json,
)
from corpusmill.sources.records import generate_records
from corpusmill.sources.tables import scan_records


def test_missing_fields_become_null(spark):
    partial = generate_records(spark, 3).select(*PARTIAL_RECORD_FIELDS)
    full = ensure_schema(partial, RECORD_SCHEMA)
    assert full.schema.names == RECORD_SCHEMA.names
    row = full.first()
    assert row.notes is None and row.id is not None
    assert sum(v is None for v in row) == 9


def test_types_do_not_change(spark):
    df = spark.createDataFrame([(1, "x")], "id int, other string")
    with pytest.raises(SchemaConflict, match="id"):
        ensure_schema(df, RECORD_SCHEMA)
    assert ensure_schema(df, fields(id="integer")).columns == ["id", "other"]
    assert ensure_schema(df, fields(id="integer"), extras=False).columns == ["id"]


def test_table_is_created_once_and_extended(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex}"
    ensure_table(spark, name, fields(id="string", n="integer"))
    spark.createDataFrame([("a", 1)], "id string, n int").write.insertInto(name)
    ensure_table(spark, name, fields(id="string", n="integer"))
    ensure_table(spark, name, fields(id="string", extra="double"))
    spark.catalog.refreshTable(name)
    assert [tuple(r) for r in scan_records(spark, name).collect()] == [("a", 1, None)]
    with pytest.raises(SchemaConflict):
        ensure_table(spark, name, fields(n="string"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not spark.catalog.tableExists(name)


def test_split(spark):
    df = spark.createDataFrame(
        [("a", "1", "x"), ("b", "?", "y"), ("", "2", "z"), ("c", None, "w"), (None, "?", "v")],
        "id string, n string, extra string",
    )
    declared = fields(id="string", n="integer")
    good, bad = split_valid(df, declared, ["id"])
    assert sorted(map(tuple, good.collect())) == [("a", 1, "x"), ("c", None, "w")]
    assert sorted((r.extra, r.error) for r in bad.collect()) == [
        ("v", "missing: id"), ("y", "type: n"), ("z", "missing: id"),
    ]
    tally = {r.outcome: r.n for r in load_tally(df, declared, ["id"]).collect()}
    assert tally == {"ok": 2, "missing: id": 2, "type: n": 1}
    assert first_failures(bad, "extra", 2).count() == 2


def test_fields_of_json(spark):
    rows = [
        (1, '{"a": 1, "b": "x", "n": {"p": 1.5}}'), (2, '{"a": 2.5, "c": true, "l": [1, 2]}'), (3, "no json"), (4, None), (5, "[1]"),
        (6, '{"b": null, "z": null, "odd name": 3}'),
    ]
    df = spark.createDataFrame(rows, "id int, j string")
    found = found_fields(df, "j")
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {
        "a": "double", "b": "string", "c": "boolean", "l": "array<bigint>", "n": "struct<p:double>", "odd name": "bigint", "z": "string"}
    declared = fields(a="double", b="string")
    added = new_fields(found, declared)
    assert added.names == ["c", "l", "n", "odd name", "z"]
    typed = {r.id: r for r in typed_json(df, "j", fields(a="double", b="string", c="boolean", n=found["n"].dataType)).collect()}
    assert (typed[1].a, typed[1].b, typed[1].c, typed[1].n.p) == (1.0, "x", None, 1.5) and typed[2].c is True
    assert tuple(typed[3])[1:] == (None,) * 4 and typed[4].a is None and typed[5].a is None
    with pytest.raises(SchemaConflict, match="b: string is not double"):
        new_fields(found, fields(b="double"))
    mixed = spark.createDataFrame([('{"k": 1}',), ('{"k": "one"}',)], "j string")
    with pytest.raises(SchemaConflict, match="k: variant is not bigint"):
        new_fields(found_fields(mixed, "j"), fields(k="long"))
    assert found_fields(df.limit(0), "j").fields == []
