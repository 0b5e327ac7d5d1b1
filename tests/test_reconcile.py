import random

import pytest

from tidemark.operators import reconcile
from tidemark.operators.presence import departed_keys

COLUMNS = "key long, name string, n int"


def told(rows, width):
    """Rows of each side by chunk, only where the sides differ as bags of rows."""
    source, target = rows
    chunks = {}
    for side, part in enumerate((source, target)):
        for r in part:
            chunks.setdefault(None if r[0] is None else r[0] // width, ([], []))[side].append(r)
    sort = lambda part: sorted(part, key=repr)
    return {c: (len(a), len(b)) for c, (a, b) in chunks.items() if sort(a) != sort(b)}


def spoiled(seed, keys):
    rng = random.Random(seed)
    source = [(k, rng.choice(["a", None, ""]), rng.choice([1, None])) for k in keys]
    target = [r for r in source if rng.random() > 0.01]
    target = [(r[0], r[1], 7) if rng.random() < 0.01 else r for r in target]
    return source, target + [(rng.randrange(-500, 5000), "new", 0) for _ in range(5)]


@pytest.mark.parametrize("fan", [20, 1000])
def test_only_chunks_that_differ(spark, fan):
    # A third of the rows have one key, some have none.
    sides = spoiled(1, [*range(-300, 2000), *[40] * 1000, None, None])
    source, target = (spark.createDataFrame(s, COLUMNS).repartition(4) for s in sides)
    got = reconcile.differing_chunks(source, target, ["key"], width=10, fan=fan).collect()
    assert {None if r["lower"] is None else r["lower"] // 10: (r["source_rows"], r["target_rows"]) for r in got} == told(sides, 10)
    assert all(r["lower"] is None or r["upper"] - r["lower"] == 10 for r in got)


def test_many_chunks_are_joined(spark, monkeypatch):
    sides = spoiled(2, [*range(500), None])
    sides = (sides[0], sides[1][:-8] + [(None, "x", 1)])
    source, target = (spark.createDataFrame(s, COLUMNS) for s in sides)
    listed = sorted(map(str, reconcile.differing_rows(source, target, ["key"], width=2, fan=20).collect()))
    monkeypatch.setattr(reconcile, "LISTED", 3)
    assert sorted(map(str, reconcile.differing_rows(source, target, ["key"], width=2, fan=20).collect())) == listed != []
    got = reconcile.differing_chunks(source, target, ["key"], width=2, fan=20).collect()
    assert {None if r["lower"] is None else r["lower"] // 2: (r["source_rows"], r["target_rows"]) for r in got} == told(sides, 2)


def test_order_and_types_do_not_count_but_copies_and_nulls_do(spark):
    source = spark.createDataFrame([(1, None, 2), (1, "b", 2)], COLUMNS)
    assert reconcile.differing_chunks(source, source.orderBy("name").selectExpr("n + 0L n", "name", "cast(key as int) KEY"), ["key"]).isEmpty()
    twice = source.union(source.filter("name = 'b'")).union(source.filter("name = 'b'"))
    assert [r["target_rows"] for r in reconcile.differing_chunks(source, twice, ["key"]).collect()] == [4]
    moved = spark.createDataFrame([(1, "x", None)], COLUMNS)
    other = spark.createDataFrame([(1, None, 0)], COLUMNS).selectExpr("key", "cast('x' as string) name", "n")
    assert not reconcile.differing_chunks(moved, other, ["key"]).isEmpty()
    assert reconcile.differing_chunks(moved, other, ["key"], but=["N"]).isEmpty()


def test_empty_sides_and_far_keys(spark):
    far = spark.createDataFrame([(-(2**63), "a", 1), (2**63 - 1, "b", 1)], COLUMNS)
    none = far.filter("false")
    assert reconcile.differing_chunks(none, none, ["key"]).isEmpty() and reconcile.differing_rows(none, none, ["key"]).isEmpty()
    got = reconcile.differing_rows(far, far.filter("key < 0"), ["key"]).collect()
    assert [tuple(r) for r in got] == [(2**63 - 1, "missing")]


def test_rows_by_buckets_of_several_keys(spark):
    source = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), (None, 1, 1), ("d", 4, None), ("d", 4, None)], "k string, l int, v int")
    target = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 1, 1), ("d", 4, None)], "k string, l int, v int")
    got = reconcile.differing_rows(source, target, ["k", "l"], buckets=4).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [("b", 1, "changed"), (None, 1, "missing"), ("c", 1, "extra"), ("d", 4, "changed")], key=repr
    )
    with pytest.raises(ValueError, match="buckets"):
        reconcile.differing_rows(source, target, ["k"])
    with pytest.raises(ValueError, match="need the key"):
        reconcile.differing_rows(source, target, ["m"])


@pytest.mark.parametrize("broadcast", [True, False])
def test_changed_rows(spark, broadcast):
    stored = spark.createDataFrame([(1, "a", 1, 5), (2, "b", None, 5), (3, None, 3, 5), (9, "i", 9, 5)], COLUMNS + ", extra int")
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), (None, 3, 3), ("d", 4, 4), ("e", None, 5)], "name string, key int, n int")
    got = reconcile.changed_rows(rows, stored, ["key"], broadcast_keys=broadcast).collect()
    assert sorted(map(tuple, got)) == [("b", 2, 2), ("d", 4, 4), ("e", None, 5)]
    got = reconcile.changed_rows(rows, stored, ["key"], but=["n"], broadcast_keys=broadcast).collect()
    assert sorted(map(tuple, got)) == [("d", 4, 4), ("e", None, 5)]
    assert reconcile.changed_rows(rows.select("key"), stored, ["key"], broadcast_keys=broadcast).count() == 2


def test_departed_keys(spark):
    rng = random.Random(3)
    edges = [-(2**63), -32769, -32768, -32767, -1, 0, 1, 32768, 32769, 2**63 - 1]
    held = [*edges, *[rng.randrange(-100_000, 100_000) for _ in range(3000)], None]
    there = [k for k in held if rng.random() < 0.9] + [rng.randrange(100_000) for _ in range(50)]
    target, source = (spark.createDataFrame([(k,) for k in s + s[:100]], "key long") for s in (held, there))
    assert sorted(r[0] for r in departed_keys(target, source, "key").collect()) == sorted(set(held) - set(there) - {None})
    assert sorted(r[0] for r in departed_keys(target, source.filter("false"), "key").collect()) == sorted(set(held) - {None})
    assert departed_keys(target.filter("false"), source, "key").isEmpty()
    few = departed_keys(target.selectExpr("cast(key % 100 as int) key"), source.withColumnRenamed("key", "other"), "key", "other")
    assert few.schema["key"].dataType.simpleString() == "int"
