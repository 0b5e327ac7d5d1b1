import json

import pytest
from pyspark.sql import types as T

from tests.test_jobs import CONFIG, FIELDS, landed, later, moment, run, target  # noqa: F401
from tidemark.operators.columns import Field, fields_of
from tidemark.operators.evolve import KEEP, REFUSE, WIDEN, TypeRefused, type_changes, wider_type, widen_columns
from tidemark.plans import jobs, store
from tidemark.plans.config import TableConfig
from tidemark.sources.drift import page_drift

INT, LONG, DOUBLE, TEXT, DAY = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
WIDER = [
    (INT, LONG, LONG),
    (INT, DOUBLE, DOUBLE),
    (LONG, DOUBLE, None),
    (LONG, T.DecimalType(10, 2), T.DecimalType(21, 2)),
    (LONG, T.DecimalType(38, 30), None),
    (T.DecimalType(10, 4), T.DecimalType(12, 2), T.DecimalType(14, 4)),
    (T.FloatType(), DOUBLE, DOUBLE),
    (T.ShortType(), T.FloatType(), DOUBLE),
    (T.DecimalType(10, 2), DOUBLE, None),
    (DAY, T.TimestampNTZType(), T.TimestampNTZType()),
    (DAY, T.TimestampType(), None),
    (TEXT, T.BooleanType(), TEXT),
    (TEXT, T.TimestampType(), None),
    (T.BooleanType(), INT, None),
    (T.ArrayType(INT), TEXT, None),
    (T.ArrayType(INT), T.ArrayType(INT), T.ArrayType(INT)),
]


@pytest.mark.parametrize("a, b, wide", WIDER)
def test_wider_type(a, b, wide):
    assert wider_type(a, b) == wider_type(b, a) == wide
    # It holds both: no step further is needed.
    assert wide is None or wider_type(a, wide) == wider_type(b, wide) == wide


def test_changes_and_values(spark):
    stored = spark.createDataFrame([(1, 2.5, "x", True), (None, None, None, None)], "A int, b double, c string, `d.e` boolean")
    changes = type_changes(fields_of("a INTEGER\nb FLOAT\nc DATE\nd.e STRING\nnew DATE"), stored.schema)
    assert [(c.name, c.action, c.to) for c in changes] == [("A", WIDEN, LONG), ("c", KEEP, TEXT), ("d.e", WIDEN, TEXT)]
    wide = widen_columns(stored, changes)
    assert [tuple(r) for r in wide.collect()] == [(1, 2.5, "x", "true"), (None, None, None, None)]
    assert wide.schema.simpleString() == "struct<A:bigint,b:double,c:string,d.e:string>"
    refused = type_changes([Field("b", "BOOLEAN"), Field("c", "TIMESTAMP")], stored.schema)
    assert [c.action for c in refused] == [REFUSE, REFUSE]
    with pytest.raises(TypeRefused, match="b from double to boolean, c from string to timestamp"):
        widen_columns(stored, refused)


def test_a_refresh_widens_or_refuses(spark, run):
    chunked = TableConfig("account", ("id",), "changed", layout_range=10)
    jobs.full_load(run, chunked, FIELDS, landed(spark, ("1", "one", "3/9/2024", "T"), ("2", "two", "3/9/2024", "F")))
    text = [Field(f.name, "STRING") if f.name == "active" else f for f in FIELDS]
    jobs.refresh(later(run), chunked, text, landed(spark, ("2", "two", "3/9/2024", "perhaps")))
    assert {k: v[2] for k, v in target(run).items()} == {1: "true", 2: "perhaps"}
    version = store.version_of(spark, run.target(chunked))
    assert jobs.widen(run, chunked, FIELDS) == () and store.version_of(spark, run.target(chunked)) == version
    for name, kind, told in (("changed", "BOOLEAN", "changed from date"), ("id", "STRING", "chunks follow")):
        other = [Field(f.name, kind) if f.name == name else f for f in FIELDS]
        with pytest.raises(TypeRefused, match=told):
            jobs.refresh(later(run), chunked, other, landed(spark, ("3", "x", "3/9/2024", "T")))
    assert store.version_of(spark, run.target(chunked)) == version


def test_drift_of_pages(spark, tmp_path):
    items = [
        {"ID": 1, "name": "a", "changed": None, "active": True, "links": []},
        {"id": "2", "name": {"first": "b"}, "active": 1, "extra": 1.5, "links": []},
        {"id": 3.5, "name": ["c"], "Extra": 2.5, "new one": None},
        {},
    ]
    pages = [json.dumps({"items": items[:2], "hasMore": True}), "", json.dumps({"items": items[2:]}), json.dumps({"items": []}), "{}"]
    (tmp_path / "page.json").write_text("\n".join(pages))
    fields = fields_of("id INTEGER\nname STRING\nchanged DATE\nactive BOOLEAN\nGone STRING\nupdated_at DATETIME")
    got = {tuple(r) for r in page_drift(spark, str(tmp_path), fields).collect()}
    assert got == {
        ("id", "conflict", "DECIMAL", 1),
        ("name", "conflict", "OBJECT", 1),
        ("name", "conflict", "ARRAY", 1),
        ("active", "conflict", "BIGINT", 1),
        ("extra", "undeclared", "DECIMAL", 2),
        ("new one", "undeclared", "VOID", 1),
        ("gone", "absent", None, 0),
    }


def test_no_drift_and_broken_pages(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"items":[{"id":1,"links":[]}]}')
    assert page_drift(spark, str(tmp_path), [Field("id", "INTEGER")]).isEmpty()
    (tmp_path / "other.json").write_text('{"items":[{"id":')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        page_drift(spark, str(tmp_path), [Field("id", "INTEGER")]).collect()
