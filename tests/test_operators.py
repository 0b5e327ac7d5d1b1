import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import audit, columns, control, dedupe, evolve, ranges
from tidemark.operators.columns import Field, declared_fields, declared_schema, fields_of
from tidemark.plans.config import TABLE_CONFIGS
from tidemark.sources import tables

D = dt.date


# ---------------------------------------------------------------- columns


def test_declared_fields_skip_rows_without_type():
    sheet = [
        {"Column Name": "id", "Data Type": "INTEGER", "Nullable": "REQUIRED"},
        {"Column Name": "memo", "Data Type": "STRING(2000)", "Nullable": "NULLABLE"},
        {"Column Name": "gone", "Data Type": "()", "Nullable": ""},
        {"Column Name": "blank", "Data Type": "", "Nullable": None},
    ]
    fields = declared_fields(sheet)
    assert fields == [Field("id", "INTEGER", False), Field("memo", "STRING")]
    assert declared_schema(fields) == T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("memo", T.StringType())]
    )


def test_conform(spark):
    fields = fields_of("id INTEGER\nday DATE\nflag BOOLEAN\nrate FLOAT\nlate FLOAT\nupdated_at TIMESTAMP")
    raw = spark.createDataFrame(
        [("1", "1/2/2024", "T", "1.5", "x"), ("q", "2024-01-02", "maybe", None, "y")],
        "ID string, day string, flag string, rate string, links string",
    )
    out = columns.conform(raw, fields, count_bad=True)
    assert out.columns == ["id", "day", "flag", "rate", "late", "bad_cells"]
    assert [tuple(r) for r in out.collect()] == [
        (1, D(2024, 1, 2), True, 1.5, None, 0),
        (None, None, None, None, None, 2),  # the unreadable date does not count
    ]
    strict = columns.conform(raw, fields, count_bad=True, lenient=())
    assert [r["bad_cells"] for r in strict.collect()] == [0, 3]


def test_typed_columns_pass_through(spark):
    raw = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3))], "id int, day timestamp_ntz")
    out = columns.conform(raw, fields_of("id INTEGER\nday DATE"), count_bad=True)
    assert [tuple(r) for r in out.collect()] == [(1, D(2024, 1, 2), 0)]


def test_projection_stamp_and_links(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, name string, links string")
    fields = fields_of("name STRING\nid INTEGER\nupdated_at TIMESTAMP")
    assert columns.select_declared(df, fields).columns == ["name", "id"]
    assert tables.full_scan(df).columns == ["id", "name", "links"]
    assert columns.drop_links(columns.drop_links(df)).columns == ["id", "name"]
    stamped = columns.stamp_load(df, dt.datetime(2024, 1, 1)).collect()
    assert [r["updated_at"] for r in stamped] == [dt.datetime(2024, 1, 1)]


def test_pages_concatenate_with_nulls(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(1, "x")], "id int, b string")
    assert rows(columns.concat_pages(a, b, a)) == sorted([(1, "x", None), (1, "x", None), (1, None, "x")], key=repr)


# ---------------------------------------------------------------- dedupe


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [
            (1, D(2024, 1, 1), "old"),
            (1, D(2024, 1, 2), "new"),
            (2, None, "undated"),
            (2, D(2020, 1, 1), "dated"),
            (3, D(2024, 1, 1), "b"),
            (3, D(2024, 1, 1), "a"),
            (None, D(2024, 1, 1), "n1"),
            (None, D(2024, 1, 3), "n2"),
        ],
        "id int, day date, v string",
    )
    got = {r["id"]: r["v"] for r in dedupe.latest_per_key(df, ["id"], "day").collect()}
    assert got == {1: "new", 2: "dated", 3: "a", None: "n2"}


def test_exact_duplicates(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "id int, v string")
    assert rows(dedupe.drop_exact_duplicates(df)) == sorted([(1, None), (1, "a"), (None, None)], key=repr)


def test_unique_keys(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (None, None), (None, None)], "id int, day date")
    assert dedupe.require_unique_keys(df, ["id", "day"]) is df
    with pytest.raises(dedupe.DuplicateKeys, match=r"\(1, 2\)"):
        dedupe.require_unique_keys(df, ["id"])


# ---------------------------------------------------------------- ranges


def test_recent_window(spark):
    days = [D(2024, 1, 1), D(2024, 1, 7), D(2024, 1, 8), D(2024, 1, 10), D(2030, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    kept = {r["day"] for r in ranges.recent_window(df, "day", D(2024, 1, 10)).collect()}
    assert kept == {D(2024, 1, 8), D(2024, 1, 10), D(2030, 1, 1)}


def test_key_range_is_half_open_and_sorted(spark):
    df = spark.range(0, 100, 1, 7)
    got = [r["id"] for r in ranges.sorted_key_range(df, "id", 10, 20).collect()]
    assert sorted(got) == list(range(10, 20))
    by_task = ranges.sorted_key_range(df, "id", 10, 90).withColumn("p", F.spark_partition_id()).collect()
    for p in {r["p"] for r in by_task}:
        ids = [r["id"] for r in by_task if r["p"] == p]
        assert ids == sorted(ids)


def test_points_bounds_and_pages(spark):
    df = spark.createDataFrame([(i,) for i in [5, 3, 9, 7, None]], "k bigint")
    assert ranges.point_lookup(df, "k", 3).count() == 1
    assert tuple(ranges.key_bounds(df, "k").first()) == (3, 9)
    assert [r["k"] for r in ranges.top_key(df, "k").collect()] == [9]
    assert [r["k"] for r in ranges.top_key(df, "k", descending=False).collect()] == [3]
    assert [r["k"] for r in ranges.page(df.dropna(), ["k"], 1, rows=3).collect()] == [9]
    assert ranges.page(df.dropna(), ["k"], 2, rows=3).collect() == []


@pytest.mark.parametrize("most_skipped", [0, 3, 1000])
def test_pages_by_key_cover_the_table(spark, monkeypatch, most_skipped):
    monkeypatch.setattr(ranges, "GRID", 100)
    hot = [(i, 7) for i in range(30)] + [(-1, 8)] * 25
    data = hot + [(i, i * i) for i in range(40)] + [(0, -5), (0, 10**15)]
    df = spark.createDataFrame(data, "i int, k bigint")
    got = []
    for number in range(len(data) // 16 + 2):
        found = [(r["i"], r["k"]) for r in ranges.page_by_key(df, "k", number, 16, most_skipped=most_skipped).collect()]
        assert len(found) == min(16, max(0, len(data) - 16 * number))
        assert not got or not found or min(k for _, k in found) >= max(k for _, k in got)
        got += found
    assert sorted(got) == sorted(data)


def test_pages_by_key_of_odd_tables(spark):
    nulls = spark.createDataFrame([(None,), (1,)], "k bigint")
    with pytest.raises(ValueError, match="nulls"):
        ranges.page_by_key(nulls, "k", 0)
    assert ranges.page_by_key(nulls.filter("false"), "k", 3, 9, most_skipped=0).collect() == []
    one = spark.createDataFrame([(1,)] * 20, "k bigint")
    assert [ranges.page_by_key(one, "k", n, 8, most_skipped=2).count() for n in range(4)] == [8, 8, 4, 0]


@pytest.mark.parametrize("keys,size", [([5], 10), ([0, 9, 10, 35], 10), ([-15, -1, 3], 7), ([2**62, 2**62 + 5], 3), ([], 4)])
def test_chunks_cover_each_key_once(spark, keys, size):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    counts = [tuple(r) for r in ranges.chunk_counts(df, "k", size).orderBy("chunk_id").collect()]
    if not keys:
        assert counts == []
        return
    lows = list(range(min(keys), max(keys) + 1, size))
    expected = [
        (i, lo, min(lo + size, max(keys) + 1), sum(lo <= k < lo + size for k in keys)) for i, lo in enumerate(lows)
    ]
    assert counts == expected
    placed = {r["k"]: r["chunk_id"] for r in ranges.with_chunks(df, "k", size).collect()}
    assert placed == {k: (k - min(keys)) // size for k in keys}


def test_database_ranges():
    assert tables.range_partitions(1, 1, 100, 50) == 1
    assert tables.range_partitions(1, 100, 100, 50) == 1
    assert tables.range_partitions(1, 101, 100, 50) == 2
    assert tables.range_partitions(0, 10**9, 100_000, 50) == 50


# ---------------------------------------------------------------- audit


def test_audit(spark, rows):
    df = spark.createDataFrame(
        [(0, 0, True), (0, 0, True), (0, 1, True), (0, 1, False), (0, 1, True), (1, 2, True)],
        "chunk int, batch int, ok boolean",
    )
    counted = audit.load_audit(df, "chunk", "batch", F.col("ok"))
    assert rows(counted) == [(0, 2, 2, 3, False), (1, 1, 1, 0, True)]
    assert tuple(audit.audit_total(counted).first()) == (3, 3, 3, False)
    assert tuple(audit.audit_total(counted.filter("false")).first()) == (0, 0, 0, True)


def test_counts(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert audit.filtered_count(df).first()["n_rows"] == 3
    assert audit.filtered_count(df, F.col("a") > 1).first()["n_rows"] == 1
    assert audit.null_keys(df, ["a", "b"]).first()["null_keys"] == 2


# ---------------------------------------------------------------- evolution


def test_schema_differences(spark, rows):
    declared = spark.createDataFrame([("Id", "INTEGER"), ("memo", "STRING"), ("rate", "FLOAT")], "column_name string, data_type string")
    stored = spark.createDataFrame([("ID",), ("extra",), ("RATE",)], "column_name string")
    assert rows(evolve.schema_diff(declared, stored)) == [("memo", "STRING")]
    fields = fields_of("Id INTEGER\nmemo STRING\nrate FLOAT")
    df = spark.createDataFrame([(1, 2, 3.0)], "ID int, extra int, RATE double")
    assert evolve.missing_fields(fields, df.schema) == [Field("memo", "STRING")]
    assert rows(evolve.add_columns(df, fields)) == [(1, 2, 3.0, None)]


# ---------------------------------------------------------------- control


def test_modes(spark):
    sheet = spark.createDataFrame(
        [
            ("a", "reload_once", 1),
            ("b", "reload_always", 2),
            ("a", "periodic_refresh", 3),
            ("c", "", 4),
            ("", "reload_once", 5),
            ("d", None, 6),
            ("b", "", 7),
            ("e", "sometimes", 8),
        ],
        "Table_Name string, Sync_Mode string, position int",
    )
    config = spark.createDataFrame([(t,) for t in "abcde"], "Table_Name string")
    resolved = control.resolve_modes(config, control.control_modes(sheet, "position"))
    assert {r["Table_Name"]: r["Sync_Mode"] for r in resolved.collect()} == {
        "a": "periodic_refresh",
        "b": "reload_always",
        "c": "periodic_refresh",
        "d": "periodic_refresh",
        "e": "sometimes",
    }
    after = control.reset_reload_once(sheet, ["a"]).filter("position in (1, 5)").orderBy("position").collect()
    assert [r["Sync_Mode"] for r in after] == ["periodic_refresh", "reload_once"]


def test_only_configured(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "t string, v int")
    config = spark.createDataFrame([("a",), ("z",), ("a",)], "t string")
    assert rows(control.configured_only(df, config, "t")) == [("a", 1), ("a", 3)]


def test_table_configs():
    assert len(TABLE_CONFIGS) == 13
    assert TABLE_CONFIGS["Quota"].keys == ("id", "date") and not TABLE_CONFIGS["Quota"].reduce
    assert TABLE_CONFIGS["invoiceSalesTeam"].chunk_key == "transaction"
    assert TABLE_CONFIGS["transactionLine"].chunk_key == "uniquekey"


def test_declared_tables(spark):
    from tidemark.plans.declared import DECLARED

    sizes = {name: len(fields) for name, fields in DECLARED.items()}
    assert sizes == {"Account": 30, "transactionLine": 75, "invoiceSalesTeam": 6, "transactionSalesTeam": 6}
    lines = DECLARED["transactionLine"]
    raw = spark.createDataFrame([("1", "2", "1/5/2024", "T", "1.50")], "id string, uniquekey string, linelastmodifieddate string, mainline string, netamount string")
    row = columns.conform(raw, lines, count_bad=True).first()
    assert (row["uniquekey"], row["linelastmodifieddate"], row["mainline"], row["netamount"]) == (2, D(2024, 1, 5), True, 1.5)
    assert row["memo"] is None and row["bad_cells"] == 0
    for name, fields in DECLARED.items():
        config = TABLE_CONFIGS[name]
        declared = {f.name for f in fields}
        assert {*config.keys, config.chunk_key} <= declared
