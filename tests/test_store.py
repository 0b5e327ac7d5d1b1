import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans import store
from tidemark.sources import pages, sinks, tables
from tidemark.workspace import new_folder


@pytest.fixture
def place(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    sinks.create_schema(spark, name, str(tmp_path / "db"))
    yield name
    sinks.drop_schema(spark, name)


LAYOUTS = [None, store.Layout("k", 10)]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_target_versions(spark, rows, place, tmp_path, layout):
    name = f"{place}.t"
    df = spark.createDataFrame([(1, "a"), (25, "b"), (None, "c")], "k bigint, v string")
    store.create_target(spark, name, df.schema, str(tmp_path / "t"), layout)
    store.create_target(spark, name, df.schema, str(tmp_path / "other"), layout)
    assert store.layout_of(spark, name) == layout
    assert store.read_target(spark, name).count() == 0
    store.update_target(df, name)
    assert rows(store.read_target(spark, name)) == rows(df)
    store.update_target(store.read_target(spark, name).withColumn("v", F.upper("v")).filter("k is null or k < 20"), name)
    assert rows(store.read_target(spark, name)) == sorted([(1, "A"), (None, "C")], key=repr)
    store.update_target(df.filter("false"), name)
    assert store.read_target(spark, name).count() == 0


@pytest.mark.parametrize("layout", LAYOUTS)
def test_replace_takes_the_new_schema(spark, rows, place, tmp_path, layout):
    name = f"{place}.t"
    df = spark.createDataFrame([(1, "a"), (25, "b")], "k bigint, v string")
    store.create_target(spark, name, df.schema, str(tmp_path / "t"), layout)
    store.update_target(df, name)
    store.replace_target(store.read_target(spark, name).select("k", F.lit(1.5).alias("w")), name)
    assert store.read_target(spark, name).columns == ["k", "w"]
    assert rows(store.read_target(spark, name)) == [(1, 1.5), (25, 1.5)]
    assert store.layout_of(spark, name) == layout


def test_only_touched_partitions_move(spark, rows, place, tmp_path):
    name, layout = f"{place}.t", store.Layout("k", 10)
    df = spark.createDataFrame([(1, "a"), (15, "b"), (25, "c"), (None, "d")], "k bigint, v string")
    store.create_target(spark, name, df.schema, str(tmp_path / "t"), layout)
    store.update_target(df, name)
    before = {f for f in spark.table(name).inputFiles()}
    new = spark.createDataFrame([(15, "B"), (35, "E"), (None, "D")], "k bigint, v string")
    chunks = store.touched_chunks(new, layout)
    assert {r[store.CHUNK] for r in chunks.collect()} == {1, 3, store.NO_CHUNK}
    assert rows(store.read_chunks(spark, name, chunks)) == sorted([(15, "b"), (None, "d")], key=repr)
    store.publish_chunks(spark, name, store.write_version(new, name), chunks)
    assert rows(store.read_target(spark, name)) == sorted([(1, "a"), (15, "B"), (25, "c"), (35, "E"), (None, "D")], key=repr)
    after = {f for f in spark.table(name).inputFiles()}
    assert {f for f in before if "key_chunk=0" in f or "key_chunk=2" in f} <= after


def test_reading_chunks_prunes_files(spark, place, tmp_path, monkeypatch):
    name, layout = f"{place}.t", store.Layout("k", 10)
    numbers = spark.range(100).withColumnRenamed("id", "k")
    store.create_target(spark, name, numbers.schema, str(tmp_path / "t"), layout)
    store.update_target(numbers, name)
    touched = store.touched_chunks(numbers.filter("k >= 20 and k < 40"), layout)
    chunk = store.read_chunks(spark, name, touched)
    assert chunk.count() == 20
    assert "PartitionFilters: [key_chunk" in chunk._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(store, "LISTED_CHUNKS", 1)
    assert store.read_chunks(spark, name, touched).count() == 20


def test_targets_of_any_number_of_chunks(spark, rows, place, tmp_path):
    name, layout = f"{place}.t", store.Layout("k", 1)
    numbers = spark.range(300).withColumnRenamed("id", "k")
    store.create_target(spark, name, numbers.schema, str(tmp_path / "t"), layout)
    store.update_target(numbers, name)
    assert store.read_target(spark, name).count() == 300


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("dies_in", ["write_version", "_point"])
def test_a_death_leaves_the_old_or_the_new_table(spark, rows, place, tmp_path, monkeypatch, layout, dies_in):
    name = f"{place}.t"
    df = spark.createDataFrame([(1, "a"), (25, "b"), (35, "c")], "k bigint, v string")
    store.create_target(spark, name, df.schema, str(tmp_path / "t"), layout)
    store.update_target(df, name)
    before = rows(store.read_target(spark, name))
    with monkeypatch.context() as m:
        m.setattr(store, dies_in, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replace_target(df.select("k", F.lit(2).alias("w")), name)
        if layout:
            touched = store.touched_chunks(df.filter("k > 20"), layout)
            with pytest.raises(ZeroDivisionError):
                store.publish_chunks(spark, name, store.write_version(df.filter("k > 30"), name), touched)
    assert rows(store.read_target(spark, name)) == before
    if layout:
        store.publish_chunks(spark, name, store.write_version(df.filter("k > 30"), name), touched)
        assert rows(store.read_target(spark, name)) == [(1, "a"), (35, "c")]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_old_versions_can_be_removed(spark, rows, place, tmp_path, layout):
    name = f"{place}.t"
    df = spark.createDataFrame([(1, "a"), (25, "b")], "k bigint, v string")
    store.create_target(spark, name, df.schema, str(tmp_path / "t"), layout)
    for _ in range(3):
        store.update_target(df, name)
    if layout:
        touched = store.touched_chunks(df.filter("k > 20"), layout)
        store.publish_chunks(spark, name, store.write_version(df.filter("k > 20"), name), touched)
    now = dt.datetime.now()
    assert store.remove_old_versions(spark, name, now - dt.timedelta(hours=1)) == []
    assert len(store.remove_old_versions(spark, name, now + dt.timedelta(hours=1))) == 2
    assert rows(store.read_target(spark, name)) == rows(df)


def test_hot_partition_is_written_by_several_tasks(spark, conf, place, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    name = f"{place}.t"
    df = spark.range(0, 200_000, 1, 16).select((F.col("id") % 1000).alias("k"), F.uuid().alias("v"))
    store.create_target(spark, name, df.schema, str(tmp_path / "t"), store.Layout("k", 100_000))
    store.update_target(df, name)
    assert len(spark.table(name).inputFiles()) > 4
    assert store.read_target(spark, name).count() == 200_000


def test_append_create_clone_truncate(spark, rows, place):
    name = f"{place}.plain"
    sinks.create_table(spark, name, spark.createDataFrame([], "id bigint, v string").schema)
    sinks.create_table(spark, name, spark.createDataFrame([], "other int").schema)
    sinks.append(spark.createDataFrame([("a", 1)], "v string, ID int"), name)
    sinks.append(spark.createDataFrame([(1,)], "id int"), name)
    assert rows(spark.table(name)) == sorted([(1, "a"), (1, None)], key=repr)
    sinks.clone_table(spark, f"{place}.clone", name)
    assert spark.table(f"{place}.clone").schema == spark.table(name).schema
    assert spark.table(f"{place}.clone").count() == 0
    sinks.truncate(spark, name)
    assert spark.table(name).count() == 0
    sinks.drop(spark, name)
    sinks.drop(spark, name)
    assert not spark.catalog.tableExists(name)


def test_fresh_schema_drops_what_it_held(spark, place, tmp_path):
    staging = f"{place}_staging"
    sinks.fresh_schema(spark, staging, str(tmp_path / "one"))
    sinks.create_table(spark, f"{staging}.a", spark.range(1).schema)
    sinks.fresh_schema(spark, staging, str(tmp_path / "two"))
    assert not spark.catalog.tableExists(f"{staging}.a")
    sinks.drop_schema(spark, staging)
    assert not spark.catalog.databaseExists(staging)


def test_pages(spark, rows, tmp_path):
    path = tmp_path / "pages"
    path.mkdir()
    (path / "one.json").write_text(
        '{"items": [{"id": "1", "flag": "T", "links": []}, {"id": 2, "links": [], "more": {"a": 1}}], "hasMore": true}\n'
        '{"items": [], "hasMore": true}\n'
        '{"hasMore": false, "count": 0}\n'
    )
    row = spark.createDataFrame([], "id string, flag string").schema
    assert rows(pages.read_pages(spark, str(path), row)) == [("1", "T"), ("2", None)]
    with_links = spark.createDataFrame([], "id string, links array<string>").schema
    assert pages.read_pages(spark, str(path), with_links).columns == ["id"]
    (path / "two.json").write_text('{"items": [{"id": "3"')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        pages.read_pages(spark, str(path), row).collect()


def test_page_per_file(spark, rows, tmp_path):
    (tmp_path / "p.json").write_text('{\n "items": [\n {"id": "1"},\n {"id": "2"}\n ]\n}\n')
    row = spark.createDataFrame([], "id string").schema
    assert rows(pages.read_pages(spark, str(tmp_path), row, multiline=True)) == [("1",), ("2",)]


def test_landed_pages_are_bounded(spark, rows, tmp_path):
    df = spark.range(0, 2500, 1, 3).select(F.col("id").cast("string"))
    pages.land_pages(df, str(tmp_path / "landed"), rows=100)
    landed = spark.read.schema(pages.page_schema(df.schema)).json(str(tmp_path / "landed"))
    assert landed.agg(F.max(F.size("items"))).first()[0] <= 100
    assert rows(pages.read_pages(spark, str(tmp_path / "landed"), df.schema)) == rows(df)


def test_pages_landed_by_day_are_pruned(spark, rows, tmp_path):
    path, row = str(tmp_path / "landed"), spark.createDataFrame([], "id string").schema
    for day in range(1, 5):
        pages.land_pages(spark.createDataFrame([(str(day),)], "id string"), path, day=dt.date(2024, 3, day))
    recent = pages.read_pages(spark, path, row, since=dt.date(2024, 3, 3))
    assert recent.columns == ["id"] and rows(recent) == [("3",), ("4",)]
    assert "PartitionFilters: [isnotnull(landed" in recent._jdf.queryExecution().executedPlan().toString()
    assert rows(pages.read_pages(spark, path, row)) == [("1",), ("2",), ("3",), ("4",)]


def test_shared_folder(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_full_scan_reads_only_declared_columns(spark, tmp_path):
    spark.range(5).selectExpr("id", "id as a", "id as b").write.parquet(str(tmp_path / "t"))
    from tidemark.operators.columns import fields_of

    scan = tables.full_scan(spark.read.parquet(str(tmp_path / "t")), fields_of("b INTEGER\nid INTEGER"))
    assert "ReadSchema: struct<id:bigint,b:bigint>" in scan._jdf.queryExecution().executedPlan().toString()
