import datetime as dt
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import control
from tidemark.operators.columns import Field, fields_of
from tidemark.operators.dedupe import DuplicateKeys
from tidemark.plans import jobs, store
from tidemark.plans.config import TableConfig
from tidemark.sources import pages
from tidemark.streaming import stream_refresh

DAY = dt.date(2024, 3, 10)
FIELDS = fields_of("id INTEGER\nname STRING\nchanged DATE\nactive BOOLEAN\nupdated_at DATETIME")
CONFIG = TableConfig("account", ("id",), "changed")
QUOTA = TableConfig("quota", ("id", "changed"), "changed", reduce=False)
LANDED = "id string, name string, changed string, active string"
LAYOUTS = [None, 10]


def moment(hour):
    return F.lit(f"2024-03-10 {hour:02d}:00:00").cast("timestamp_ntz")


@pytest.fixture
def run(spark, tmp_path):
    started = jobs.open_run(spark, f"sync_{uuid.uuid4().hex[:10]}", DAY, moment(1), root=str(tmp_path / "targets"))
    yield started
    jobs.close_run(started)
    spark.sql(f"DROP SCHEMA {started.schema} CASCADE")


def later(run, hour=2, as_of=DAY):
    return replace(run, as_of=as_of, load_ts=moment(hour))


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), LANDED)


def target(run, config=CONFIG):
    df = store.read_target(run.spark, run.target(config))
    return {r["id"]: tuple(r)[1:] for r in df.withColumn("updated_at", F.hour("updated_at")).collect()}


D = dt.date
OLD = [("1", "one", "1/5/2024", "T"), ("2", "two", "3/8/2024", "F"), ("3", "three", "03/09/2024", "F")]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_refresh_takes_the_recent_window(spark, run, layout):
    config = TableConfig("account", ("id",), "changed", layout_range=layout)
    assert jobs.full_load(run, config, FIELDS, landed(spark, *OLD)) == jobs.Result("account", "reload", 3)
    source = landed(
        spark,
        ("1", "ONE", "3/7/2024", "F"),  # a day too old
        ("2", "TWO", "3/8/2024", "T"),  # first day of the window
        ("2", "TWO+", "3/9/2024", "T"),  # newer row of the same key
        ("40", "forty", "4/1/2024", "T"),  # the future counts as recent
        ("5", "five", "2024-03-10", "T"),  # not a date: it may be recent
        ("6", "six", None, "T"),
    )
    result = jobs.refresh(later(run), config, FIELDS, source)
    assert result == jobs.Result("account", "refresh", 4, bad_dates=1)
    expected = {
        1: ("one", D(2024, 1, 5), True, 1),
        2: ("TWO+", D(2024, 3, 9), True, 2),
        3: ("three", D(2024, 3, 9), False, 1),
        5: ("five", None, True, 2),
        40: ("forty", D(2024, 4, 1), True, 2),
    }
    assert target(run, config) == expected
    jobs.refresh(later(run), config, FIELDS, source)
    assert target(run, config) == expected
    assert jobs.refresh(later(run, as_of=D(2025, 1, 1)), config, FIELDS, source).uploaded == 1
    assert target(run, config) == expected


def test_typed_source_is_filtered_in_the_scan(spark, run, tmp_path):
    typed = spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 3, 7, 23, 59)), (2, "b", dt.datetime(2024, 3, 8)), (3, "c", None)],
        "id bigint, name string, changed timestamp_ntz",
    )
    typed.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    recent = jobs._recent(run, CONFIG, FIELDS, source)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(changed" in plan
    jobs.refresh(run, CONFIG, FIELDS, source)
    assert target(run) == {2: ("b", D(2024, 3, 8), None, 1)}


def test_text_keys_are_stored_in_hash_buckets(spark, run):
    config = TableConfig("named", ("NAME",), "changed", layout_range=10)
    jobs.refresh(run, config, FIELDS, landed(spark, *OLD))
    layout = store.layout_of(spark, run.target(config))
    assert (layout.key, layout.range, layout.buckets) == ("name", None, jobs.BUCKETS)
    jobs.refresh(later(run), config, FIELDS, landed(spark, ("9", "two", "3/9/2024", "T"), ("4", "four", "3/9/2024", "T")))
    got = {r["name"]: r["id"] for r in store.read_target(spark, run.target(config)).collect()}
    assert got == {"two": 9, "three": 3, "four": 4}


def test_a_target_of_many_folders_frees_the_smallest(spark, run, monkeypatch):
    monkeypatch.setattr(store, "MOST_FOLDERS", 3)
    config = TableConfig("account", ("id",), "changed", layout_range=10)
    jobs.full_load(run, config, FIELDS, landed(spark, *[(str(10 * i), "old", "3/9/2024", "T") for i in range(100, 120)]))
    folders, written = [], []
    for i in range(6):
        jobs.refresh(later(run), config, FIELDS, landed(spark, (str(10 * i), f"n{i}", "3/9/2024", "T"), ("999", f"n{i}", "3/9/2024", "T")))
        properties = store._properties(spark, run.target(config))
        folders.append(len(store._folders(properties)))
        held = spark.read.parquet(properties[store._MANIFEST]).groupBy("folder").count().collect()
        written.append(sorted(r["count"] for r in held))
    # The loaded twenty chunks are never written again.
    assert folders == [2, 3, 3, 3, 3, 3] and all(w[-1] == 20 for w in written)
    assert {k: v[0] for k, v in target(run, config).items() if k < 1000} == {**{10 * i: f"n{i}" for i in range(6)}, 999: "n5"}
    assert len(target(run, config)) == 27


def test_unreadable_keys_stop_a_backfill(spark, run):
    jobs.full_load(run, CONFIG, [f for f in FIELDS if f.name != "active"], landed(spark, *OLD))
    with pytest.raises(jobs.LoadFailed):
        jobs.backfill(run, CONFIG, FIELDS, landed(spark, *OLD, ("#9", "nine", "3/9/2024", "T")))


def test_refresh_into_a_new_target(spark, run):
    jobs.refresh(run, CONFIG, FIELDS, landed(spark, *OLD))
    assert set(target(run)) == {2, 3}


MIXED = [("1", "x", "3/10/2024", "T"), ("2", "y", "3/10/2024", "perhaps")]


@pytest.mark.parametrize("step", [jobs.refresh, jobs.full_load])
def test_strict_loads_leave_the_target_alone(spark, run, step):
    jobs.full_load(run, CONFIG, FIELDS, landed(spark, *OLD))
    before = target(run)
    with pytest.raises(jobs.LoadFailed):
        step(later(run), CONFIG, FIELDS, landed(spark, *MIXED), strict=True)
    assert target(run) == before
    assert spark.table(run.rejects).select("table_name", "chunk_id").collect() == [("account", 0)]


@pytest.mark.parametrize("step, left", [(jobs.refresh, {1, 2, 3}), (jobs.full_load, {1})])
def test_bad_rows_are_rejected_and_the_others_loaded(spark, run, step, left):
    jobs.full_load(run, CONFIG, FIELDS, landed(spark, *OLD))
    result = step(later(run), CONFIG, FIELDS, landed(spark, *MIXED), strict=False)
    assert (result.uploaded, result.rejected) == (1, 1)
    assert set(target(run)) == left and target(run)[1][0] == "x"
    (reject,) = spark.table(run.rejects).collect()
    assert '"id":2' in reject["row"] and reject["reason"].startswith("1 ")
    (audit,) = spark.table(run.audits).filter("failed > 0").collect()
    assert (audit["uploaded"], audit["failed"], audit["succeeded"]) == (1, 1, False)


def test_required_columns_may_not_be_null(spark, run):
    fields = [*FIELDS[:1], Field("name", "STRING", False), *FIELDS[2:]]
    result = jobs.full_load(run, CONFIG, fields, landed(spark, ("1", None, "3/9/2024", "T"), ("2", "two", "3/9/2024", "T")))
    assert (result.uploaded, result.rejected) == (1, 1)


@pytest.mark.parametrize("size", [1_000, 200_000])
def test_audit_by_a_text_key(spark, run, size):
    config = TableConfig("account", ("id",), "changed", "name", size)
    with pytest.raises(jobs.LoadFailed):
        jobs.refresh(run, config, FIELDS, landed(spark, *MIXED))
    assert spark.table(run.audits).filter("failed > 0").count() == 1


def test_two_runs_do_not_share_staging(spark, run):
    other = jobs.open_run(spark, run.schema, DAY, moment(2), root=run.root)
    jobs._stage(run, run.staged(CONFIG), spark.range(3))
    jobs.close_run(other)
    assert spark.table(run.staged(CONFIG)).count() == 3


def test_reload_without_rows_leaves_the_target_alone(spark, run):
    jobs.full_load(run, CONFIG, FIELDS, landed(spark, *OLD))
    with pytest.raises(jobs.LoadFailed, match="no rows"):
        jobs.full_load(later(run), CONFIG, FIELDS, landed(spark, *OLD).filter("false"))
    assert len(target(run)) == 3


def test_audit_of_a_staging_table(spark):
    staged = spark.range(0, 250_000, 500).withColumn("bad_cells", (F.col("id") == 100_500).cast("int"))
    audit = {r["chunk_id"]: r for r in jobs.audit_staged(CONFIG, staged).collect()}
    assert set(audit) == {0, 1, 2}
    assert (audit[0]["uploaded"], audit[0]["failed"]) == (200, 0)
    assert (audit[1]["uploaded"], audit[1]["failed"], audit[1]["succeeded"]) == (198, 2, False)


def test_layout_and_broadcast_change_nothing(spark, run, monkeypatch, rows):
    r = random.Random(11)
    some = lambda n, mark: [
        (None if r.random() < 0.1 else str(r.randrange(-60, 200)), f"{mark}{i}", f"3/{r.randrange(1, 20)}/2024", r.choice("TF"))
        for i in range(n)
    ]
    first = list({x[0]: x for x in some(150, "old")}.values())
    second = some(300, "new")
    results = []
    for layout, limit in ((None, 2**20), (None, 0), (25, 2**20), (25, 0)):
        monkeypatch.setattr(jobs, "BROADCAST_KEY_BYTES", limit)
        config = TableConfig(f"t_{layout}_{limit}", ("id",), "changed", layout_range=layout)
        jobs.full_load(run, config, FIELDS, landed(spark, *first))
        jobs.refresh(later(run), config, FIELDS, landed(spark, *second))
        results.append(rows(store.read_target(spark, run.target(config))))
    assert all(x == results[0] for x in results)
    newest = {}
    for k, name, day, _ in second:
        if int(day.split("/")[1]) >= 8:
            rank = (int(day.split("/")[1]), [-ord(c) for c in name])
            newest[k] = max(newest.get(k, (rank, name)), (rank, name))
    kept = [name for k, name, *_ in first if k is None or k not in newest]
    assert sorted(x[1] for x in results[0]) == sorted([*kept, *(name for _, name in newest.values())])


def test_composite_key(spark, run):
    jobs.full_load(run, QUOTA, FIELDS, landed(spark, ("1", "a", "3/9/2024", "T"), ("1", "b", "3/10/2024", "T")))
    jobs.refresh(later(run), QUOTA, FIELDS, landed(spark, *[("1", "B", "3/10/2024", "F")] * 2, ("1", "c", "3/11/2024", "T")))
    got = store.read_target(spark, run.target(QUOTA)).select("name").orderBy("changed").collect()
    assert [r["name"] for r in got] == ["a", "B", "c"]
    with pytest.raises(DuplicateKeys):
        jobs.refresh(later(run), QUOTA, FIELDS, landed(spark, ("1", "x", "3/10/2024", "T"), ("1", "y", "3/10/2024", "T")))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_new_column_is_backfilled_and_nothing_else(spark, run, layout):
    config = TableConfig("account", ("id",), "changed", layout_range=layout)
    few = [f for f in FIELDS if f.name != "active"]
    jobs.full_load(run, config, few, landed(spark, *OLD, ("15", "gone", "1/1/2024", "T")))
    now = landed(spark, ("1", "ONE", "1/5/2024", "T"), ("2", "TWO", "3/8/2024", None), ("3", "3", "3/1/2024", "F"), ("9", "new", "1/1/2024", "T"))
    assert jobs.backfill(later(run), config, FIELDS, now).new_columns == ("active",)
    got = store.read_target(spark, run.target(config))
    assert got.columns == ["id", "name", "changed", "updated_at", "active"]
    assert {r["id"]: (r["name"], r["active"]) for r in got.collect()} == {
        1: ("one", True),
        2: ("two", None),
        3: ("three", False),
        15: ("gone", None),
    }
    assert jobs.backfill(later(run), config, FIELDS, now).new_columns == ()


def test_date_column_may_be_undeclared(spark, run, tmp_path):
    few = fields_of("id INTEGER\nname STRING\nupdated_at DATETIME")
    jobs.full_load(run, CONFIG, few, landed(spark, *OLD))
    source = landed(spark, ("1", "ONE", "1/5/2024", "T"), ("2", "old", "3/8/2024", "T"), ("2", "TWO", "3/9/2024", "T"))
    assert jobs.refresh(later(run), CONFIG, few, source).uploaded == 2
    assert {k: v[0] for k, v in target(run).items()} == {1: "one", 2: "TWO", 3: "three"}
    jobs.backfill(later(run), CONFIG, [*few, *fields_of("active BOOLEAN")], source)
    assert store.read_target(spark, run.target(CONFIG)).columns == ["id", "name", "updated_at", "active"]
    with pytest.raises(ValueError, match="changed"):
        jobs.refresh(later(run), CONFIG, few, source.drop("changed"))
    land(spark, tmp_path / "in", ("3", "THREE", "3/9/2024", "T"))
    with pytest.raises(ValueError, match="declare it"):
        stream_refresh(run, CONFIG, few, str(tmp_path / "in"), str(tmp_path / "marks"))
    stream_refresh(run, CONFIG, few, str(tmp_path / "in"), str(tmp_path / "marks"), only_if_newer=False).awaitTermination()
    assert target(run)[3][0] == "THREE"


def test_refresh_with_a_new_column_does_both(spark, run):
    jobs.full_load(run, CONFIG, [f for f in FIELDS if f.name != "active"], landed(spark, *OLD))
    source = landed(spark, ("1", "ONE", "1/5/2024", "T"), ("2", "TWO", "3/9/2024", "T"))
    assert jobs.refresh(later(run), CONFIG, FIELDS, source).new_columns == ("active",)
    rows = {r["id"]: (r["name"], r["active"]) for r in store.read_target(spark, run.target(CONFIG)).collect()}
    assert rows == {1: ("one", True), 2: ("TWO", True), 3: ("three", None)}


def test_backfill_that_died_starts_over(spark, run, monkeypatch):
    jobs.full_load(run, CONFIG, [f for f in FIELDS if f.name != "active"], landed(spark, *OLD))
    monkeypatch.setattr(jobs, "publish", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.backfill(run, CONFIG, FIELDS, landed(spark, *OLD))
    monkeypatch.undo()
    assert "active" not in store.read_target(spark, run.target(CONFIG)).columns
    jobs.backfill(run, CONFIG, FIELDS, landed(spark, *OLD))
    assert store.read_target(spark, run.target(CONFIG)).filter("active").count() == 1


def test_reload_takes_the_declared_schema(spark, run):
    jobs.full_load(run, CONFIG, FIELDS, landed(spark, *OLD))
    other = fields_of("id INTEGER\nname STRING")
    jobs.full_load(run, CONFIG, other, landed(spark, ("7", "seven", "", "")))
    assert store.read_target(spark, run.target(CONFIG)).columns == ["id", "name", "updated_at"]
    assert store.read_target(spark, run.target(CONFIG)).count() == 1


def test_sync_modes(spark, run):
    names = ["fresh", "once", "always", "unknown", "broken", "unreadable", "last"]
    configs = {n: TableConfig(n, ("id",), "changed") for n in names}
    for n in names:
        jobs.full_load(run, configs[n], FIELDS, landed(spark, *OLD))
    sheet = spark.createDataFrame(
        [("once", "reload_once", 1), ("always", "reload_always", 2), ("unknown", "whenever", 3), ("broken", "reload_once", 4), ("unreadable", "reload_once", 5)],
        "Table_Name string, Sync_Mode string, position int",
    )
    name = f"{run.schema}.modes"
    store.create_target(spark, name, sheet.schema, f"{run.root}/modes")
    store.update_target(sheet, name)
    new = landed(spark, ("2", "TWO", "3/9/2024", "T"))
    sources = {n: jobs.Source(FIELDS, new) for n in [*names, "not configured"]}
    sources["broken"] = jobs.Source(FIELDS, landed(spark, ("2", "TWO", "3/9/2024", "maybe")))
    run.spark.createDataFrame([("{",)], "value string").write.text(f"{run.root}/pages")
    page = pages.read_pages(spark, f"{run.root}/pages", new.schema)
    sources["unreadable"] = jobs.Source(FIELDS, page)
    results = jobs.sync_by_table(later(run), configs, sources, name, "position")
    assert [(r.table, r.action, bool(r.error)) for r in results] == [
        ("fresh", "refresh", False),
        ("once", "reload", False),
        ("always", "reload", False),
        ("unknown", "none", True),
        ("broken", "none", True),
        ("unreadable", "none", True),
        ("last", "refresh", False),
    ]
    counts = {n: store.read_target(spark, run.target(configs[n])).count() for n in names}
    assert counts == {"fresh": 3, "once": 1, "always": 1, "unknown": 3, "broken": 3, "unreadable": 3, "last": 3}
    modes = {r["Table_Name"]: r["Sync_Mode"] for r in store.read_target(spark, name).collect()}
    assert modes == {
        "once": control.PERIODIC_REFRESH,
        "always": control.RELOAD_ALWAYS,
        "unknown": "whenever",
        "broken": control.RELOAD_ONCE,
        "unreadable": control.RELOAD_ONCE,
    }


def land(spark, path, *rows):
    pages.land_pages(landed(spark, *rows).coalesce(1), str(path))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_stream_merges_each_file_once(spark, run, tmp_path, layout):
    config = TableConfig("account", ("id",), "changed", layout_range=layout)
    land(spark, tmp_path / "in", ("1", "new", "3/9/2024", "T"), ("2", "two", "3/9/2024", "F"))
    land(spark, tmp_path / "in", ("1", "late", "3/1/2024", "T"), ("3", "three", "3/9/2024", "F"))
    start = lambda marks: stream_refresh(
        run, config, FIELDS, str(tmp_path / "in"), str(tmp_path / marks), files_per_batch=1
    ).awaitTermination()
    start("marks")
    once = target(run)
    assert {k: v[0] for k, v in once.items()} == {1: "new", 2: "two", 3: "three"}
    start("marks")
    assert target(run) == once
    start("other-marks")  # every file again
    assert target(run) == once
    land(spark, tmp_path / "in", ("2", "TWO", "3/10/2024", "T"))
    start("marks")
    assert target(run)[2][0] == "TWO"


def test_stream_goes_on_after_unreadable_cells(spark, run, tmp_path):
    def start(marks, **options):
        stream_refresh(run, CONFIG, FIELDS, str(tmp_path / "in"), str(tmp_path / marks), **options).awaitTermination()

    land(spark, tmp_path / "in", ("1", "new", "3/9/2024", "T"))
    start("marks")
    land(spark, tmp_path / "in", ("1", "newer", "3/10/2024", "?"), ("2", "two", "3/10/2024", "T"))
    start("marks")
    assert {k: v[0] for k, v in target(run).items()} == {1: "new", 2: "two"}
    assert spark.table(run.rejects).count() == 1
    with pytest.raises(Exception, match="LoadFailed|unreadable"):
        start("strict marks", strict=True)


@pytest.mark.parametrize("step", [jobs.refresh, jobs.full_load])
def test_a_load_that_is_run_again_leaves_one_set_of_rejects(spark, run, step):
    for _ in range(2):
        step(run, CONFIG, FIELDS, landed(spark, *MIXED), strict=False)
    assert spark.table(run.rejects).count() == spark.table(run.audits).count() == 1
    # What was mended at the source is no reject any more.
    jobs.refresh(run, CONFIG, FIELDS, landed(spark, MIXED[0]), strict=False)
    assert spark.table(run.rejects).filter("load like '% refresh'").count() == 0


@pytest.mark.parametrize("size", [None, 10])
def test_overlapping_refreshes_lose_nothing(spark, run, monkeypatch, size):
    from dataclasses import replace

    config = replace(CONFIG, layout_range=size) if size else CONFIG
    jobs.full_load(run, config, FIELDS, landed(spark, *OLD))
    write, others = jobs.write_version, [("99", "other", "3/10/2024", "T"), ("98", "other", "3/10/2024", "T")]

    def slow(*args, **options):
        path = write(*args, **options)
        if others:
            other = jobs.open_run(spark, run.schema, DAY, moment(2), root=run.root)
            jobs.refresh(other, config, FIELDS, landed(spark, others.pop()))
        return path

    monkeypatch.setattr(jobs, "write_version", slow)
    if size is None:
        monkeypatch.setattr("tidemark.plans.store.write_version", slow)
    jobs.refresh(later(run), config, FIELDS, landed(spark, ("1", "mine", "3/10/2024", "T")))
    assert {1, 98, 99} <= set(target(run)) and not others


def test_a_reload_does_not_undo_a_refresh(spark, run, monkeypatch):
    from tidemark.plans.store import Superseded

    jobs.full_load(run, CONFIG, FIELDS, landed(spark, *OLD))
    write = jobs.write_version

    def slow(*args, **options):
        path = write(*args, **options)
        monkeypatch.setattr(jobs, "write_version", write)
        jobs.refresh(later(run), CONFIG, FIELDS, landed(spark, ("7", "new", "3/10/2024", "T")))
        return path

    monkeypatch.setattr(jobs, "write_version", slow)
    with pytest.raises(Superseded):
        jobs.full_load(run, CONFIG, FIELDS, landed(spark, *OLD))
    assert 7 in set(target(run))
