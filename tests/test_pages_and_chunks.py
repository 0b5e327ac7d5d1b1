import random

import pytest

from tidemark.operators import ranges
from tidemark.workspace import shared_folder


def pages(rows, order, size):
    """(sorted key, page) of every row, nulls first."""
    keys = sorted(((tuple((x is not None, x) for x in order(r))) for r in rows))
    return sorted((k, i // size) for i, k in enumerate(keys))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_every_row_has_its_page(spark, size):
    rng = random.Random(size)
    # A third of the rows have one key, some none; rows repeat.
    rows = [(rng.choice([5, rng.randrange(50), None]), rng.choice(["a", "b", None])) for _ in range(300)] + [(5, "a")] * 30
    df = spark.createDataFrame(rows, "k int, _place string").repartition(5)
    got = ranges.page_grid(df, ["k", "_place"], size).collect()
    assert sorted((((r[0] is not None, r[0]), (r[1] is not None, r[1])), r["page_id"]) for r in got) == pages(rows, lambda r: r, size)
    assert ranges.page_grid(df.filter("false"), ["k"]).collect() == []


def test_chunks_of_equal_depth(spark):
    rng = random.Random(1)
    keys = [int(rng.paretovariate(0.3)) % 10**15 - 50 for _ in range(20_000)]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 9, "key long").repartition(6)
    for chunks in (1, 10):
        got = sorted(ranges.equal_depth_bounds(df, "key", chunks).collect())
        assert [r["n_rows"] for r in got] == [sum(r["lower"] <= k < r["upper"] for k in keys) for r in got]
        assert sum(r["n_rows"] for r in got) == len(keys) and [r["upper"] for r in got[:-1]] == [r["lower"] for r in got[1:]]
        one_key = max(map(keys.count, {-49, -48, -47}))
        assert max(r["n_rows"] for r in got) <= max(2 * len(keys) / chunks, one_key + 2 * len(keys) / chunks)


def test_chunks_of_one_key_or_none(spark):
    df = spark.createDataFrame([(7,)] * 100, "key int")
    assert [tuple(r) for r in ranges.equal_depth_bounds(df, "key", 4).collect()] == [(0, 7, 8, 100)]
    assert ranges.equal_depth_bounds(df.filter("false"), "key", 4).collect() == []


def test_a_local_session_without_the_setting_has_a_folder(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    folder = shared_folder(spark)
    assert folder and shared_folder(spark) == folder
