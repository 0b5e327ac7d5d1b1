import dataclasses

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import CONFIG, FIELDS, LANDED, landed, later, moment, run, target  # noqa: F401
from tidemark.plans import jobs, store
from tidemark.plans.config import TableConfig

ROWS = [(str(i), f"n{i}", "3/9/2024", "T") for i in range(1, 41)]
LAYOUTS = [None, 10]


def config(layout, **more):
    return TableConfig("account", ("id",), "changed", layout_range=layout, **more)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_refresh_of_unchanged_rows_writes_nothing(spark, run, layout):
    one = config(layout, skip_unchanged=True)
    jobs.full_load(run, one, FIELDS, landed(spark, *ROWS))
    version, before = store.version_of(spark, run.target(one)), target(run)
    done = jobs.refresh(later(run), one, FIELDS, landed(spark, *ROWS))
    assert (done.uploaded, done.unchanged) == (40, 40)
    assert store.version_of(spark, run.target(one)) == version and target(run) == before


@pytest.mark.parametrize("layout", LAYOUTS)
def test_only_changed_rows_are_merged(spark, run, layout):
    one = config(layout, skip_unchanged=True)
    jobs.full_load(run, one, FIELDS, landed(spark, *ROWS))
    new = [*ROWS[:4], ("5", None, "3/9/2024", "T"), ("99", "x", "3/9/2024", "F"), (None, "y", "3/9/2024", "F")]
    done = jobs.refresh(later(run), one, FIELDS, landed(spark, *new))
    assert (done.uploaded, done.unchanged) == (7, 4)
    got = target(run)
    assert {k for k, r in got.items() if r[-1] == 2} == {5, 99, None} and got[5][0] is None and len(got) == 42
    assert got[4][-1] == 1


@pytest.mark.parametrize("layout", LAYOUTS)
def test_departed_rows_go(spark, run, layout):
    one = config(layout)
    jobs.full_load(run, one, FIELDS, landed(spark, *ROWS, (None, "nobody", "3/9/2024", "T")))
    there = landed(spark, *[r for r in ROWS if r[0] not in ("7", "31")], ("x", "", "", "")).select("id")
    assert jobs.remove_departed(run, one, there).removed == 2
    assert set(target(run)) == {*range(1, 41), None} - {7, 31}
    assert jobs.remove_departed(run, one, there) == jobs.Result("account", "remove")
    for broken in (there.limit(0), there.filter("id = 'x'"), there.filter("id = '3'")):
        with pytest.raises(jobs.LoadFailed):
            jobs.remove_departed(run, one, broken)
    assert len(target(run)) == 39
    # A chunk that loses all its rows is gone as well.
    left = there.filter("not id rlike '^1[0-9]$'")
    assert jobs.remove_departed(run, one, left, most_share=1).removed == 10 and len(target(run)) == 29


@pytest.mark.parametrize("layout", LAYOUTS)
def test_repair(spark, run, layout):
    one = dataclasses.replace(config(layout), batch_range=7)
    jobs.full_load(run, one, FIELDS, landed(spark, *ROWS[:30], ("77", "extra", "3/9/2024", "T")))
    source = landed(spark, ("3", "other", "3/9/2024", "T"), *ROWS[3:], ("5", "older", "1/1/2020", "T"), ("z", "bad", "", ""))
    told = {(r["id"], r["what"]) for r in jobs.compare(later(run), one, FIELDS, source).collect()}
    assert told == {(1, "extra"), (2, "extra"), (3, "changed"), (77, "extra"), *((i, "missing") for i in range(31, 41))}
    done = jobs.repair(later(run), one, FIELDS, source)
    assert (done.action, done.uploaded, done.removed) == ("repair", 11, 3)
    got = target(run)
    assert {k for k in got if got[k][-1] == 2} == {3, *range(31, 41)} and set(got) == set(range(3, 41))
    assert jobs.compare(later(run), one, FIELDS, source).isEmpty()
    version = store.version_of(spark, run.target(one))
    assert jobs.repair(later(run), one, FIELDS, source) == jobs.Result("account", "repair")
    assert store.version_of(spark, run.target(one)) == version
    with pytest.raises(jobs.LoadFailed):
        jobs.repair(run, one, FIELDS, source.limit(0))


def test_repair_by_several_keys(spark, run):
    quota = TableConfig("quota", ("id", "changed"), "changed", reduce=False, layout_range=10)
    jobs.full_load(run, quota, FIELDS, landed(spark, ("1", "a", "3/9/2024", "T"), ("1", "b", "3/8/2024", "T"), ("2", "c", "3/8/2024", "T")))
    source = landed(spark, ("1", "a", "3/9/2024", "T"), ("1", "B", "3/8/2024", "T"))
    done = jobs.repair(later(run), quota, FIELDS, source)
    assert (done.uploaded, done.removed) == (1, 1)
    rows = store.read_target(spark, run.target(quota)).select("id", "name", F.hour("updated_at")).collect()
    assert sorted(map(tuple, rows)) == [(1, "B", 2), (1, "a", 1)]
