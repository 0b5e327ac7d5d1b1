import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedupe import DuplicateKeys, latest_per_key
from tidemark.operators.skew import key_join
from tidemark.operators.upsert import (
    fill_columns,
    keys_fit_broadcast,
    upsert,
    upsert_latest,
    upsert_unique,
)

TARGET = "k bigint, d date, v string, extra string"
SOURCE = "k bigint, d date, v string"
DAY0 = dt.date(2024, 1, 1)


def merged(target, source, *, newer=False, width=4):
    """MERGE by hand: each target row takes the source row of its key, the other source rows are added."""
    by_key = {s[0]: s for s in source if s[0] is not None}
    out, used = [], set()
    for t in target:
        s = by_key.get(t[0]) if t[0] is not None else None
        used.add(t[0] if s else None)
        if s and (not newer or t[1] is None or (s[1] is not None and s[1] >= t[1])):
            out.append((*s, *t[len(s) :]))
        else:
            out.append(t)
    added = [(*s, *[None] * (width - len(s))) for s in source if s[0] is None or s[0] not in used]
    return sorted(out + added, key=repr)


def made_up(seed, n, keys, width):
    """Rows with some null keys and null dates; one key in three is the hot key 7."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = 7 if r.random() < 0.33 else (None if r.random() < 0.1 else r.randrange(keys))
        d = None if r.random() < 0.1 else DAY0 + dt.timedelta(days=r.randrange(30))
        rows.append((k, d, f"{seed}-{i}", f"x{i}")[:width])
    return rows


def one_per_key(rows):
    return list({r[0] if r[0] is not None else object(): r for r in rows}.values())


@pytest.mark.parametrize("broadcast", [False, True])
@pytest.mark.parametrize("newer", [False, True])
@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("width", [3, 4])
def test_upsert_by_hand(spark, rows, broadcast, newer, unique, width):
    target = made_up(1, 200, 60, 4)
    target = one_per_key(target) if unique else target
    source = one_per_key(made_up(2, 120, 90, width))
    got = upsert(
        spark.createDataFrame(target, TARGET),
        spark.createDataFrame(source, TARGET if width == 4 else SOURCE),
        ["k"],
        only_if_newer="d" if newer else None,
        target_keys_unique=unique,
        broadcast_keys=broadcast,
    )
    assert rows(got) == merged(target, source, newer=newer)


@pytest.mark.parametrize("broadcast", [False, True])
def test_upsert_latest_by_hand(spark, rows, broadcast):
    target, source = one_per_key(made_up(3, 150, 80, 4)), made_up(4, 300, 80, 4)
    newest = {}
    for s in source:
        old = newest.get(s[0])
        rank = (s[1] or dt.date.min, [-ord(c) for c in s[2]])
        if old is None or rank > old[0]:
            newest[s[0]] = (rank, s)
    got = upsert_latest(
        spark.createDataFrame(target, TARGET), spark.createDataFrame(source, TARGET), ["k"], "d", ["v"], broadcast_keys=broadcast
    )
    assert rows(got) == merged(target, [s for _, s in newest.values()])


def test_upsert_twice_changes_nothing(spark, rows):
    target = [t for t in one_per_key(made_up(5, 100, 50, 4)) if t[0] is not None]
    source = [s for s in made_up(6, 200, 70, 4) if s[0] is not None]
    t, s = spark.createDataFrame(target, TARGET), spark.createDataFrame(source, TARGET)
    once = upsert_latest(t, s, ["k"], "d")
    assert rows(upsert_latest(once, s, ["k"], "d")) == rows(once)
    new = {x[0] for x in source} - {x[0] for x in target}
    assert once.count() == len(target) + len(new)


def test_empty_sides(spark, rows):
    full = spark.createDataFrame([(1, DAY0, "a", "b")], TARGET)
    none = spark.createDataFrame([], TARGET)
    assert rows(upsert(full, none, ["k"])) == rows(full)
    assert rows(upsert(none, full, ["k"])) == rows(full)
    assert rows(upsert(full, none, ["k"], only_if_newer="d")) == rows(full)
    assert keys_fit_broadcast(none, ["k"])


def test_source_from_the_target_itself(spark, rows):
    t = spark.createDataFrame([(1, DAY0, "a", "x"), (2, DAY0, "b", "y")], TARGET)
    changed = t.filter("k = 2").withColumn("v", F.lit("c"))
    expected = [(1, DAY0, "a", "x"), (2, DAY0, "c", "y")]
    for options in ({}, {"only_if_newer": "d"}, {"target_keys_unique": False}, {"broadcast_keys": True, "only_if_newer": "d"}):
        assert rows(upsert(t, changed, ["k"], **options)) == expected


def test_composite_key(spark, rows):
    t = spark.createDataFrame([(1, DAY0, "a", None), (1, None, "b", None)], TARGET)
    s = spark.createDataFrame([(1, DAY0, "c", None), (1, dt.date(2024, 1, 2), "d", None), (1, None, "e", None)], TARGET)
    assert [r[2] for r in rows(upsert_unique(t, s, ["k", "d"]).orderBy("v"))] == ["b", "e", "c", "d"]
    with pytest.raises(DuplicateKeys):
        upsert_unique(t, s.union(s), ["k", "d"])


def test_unknown_columns_are_refused(spark):
    t, s = spark.createDataFrame([(1, DAY0, "a")], SOURCE), spark.createDataFrame([(1, DAY0, "a", "b")], TARGET)
    with pytest.raises(ValueError, match="extra"):
        upsert(t, s, ["k"])


def test_letter_case_of_columns(spark, rows):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, Name string")
    s = spark.createDataFrame([("c", 2)], "name string, id int")
    assert rows(upsert(t, s, ["id"])) == [(1, "a"), (2, "c")]


def test_key_bytes(spark):
    df = spark.createDataFrame([("x" * 100,), (None,)], "k string")
    assert keys_fit_broadcast(df, ["k"], limit=132)
    assert not keys_fit_broadcast(df, ["k"], limit=131)


def test_fill_columns_touches_nothing_else(spark, rows):
    t = spark.createDataFrame([(1, "a", None), (2, "b", "keep"), (3, "c", "keep"), (None, "n", None)], "k int, v string, new string")
    s = spark.createDataFrame(
        [
            (1, dt.date(2024, 1, 1), "older", "no"),
            (1, dt.date(2024, 1, 2), "newer", "no"),
            (3, dt.date(2024, 1, 1), None, "no"),
            (9, dt.date(2024, 1, 1), "unmatched", "no"),
            (None, dt.date(2024, 1, 1), "null", "no"),
        ],
        "k int, d date, new string, v string",
    )
    got = rows(fill_columns(t, s, ["k"], ["new"], "d"))
    assert got == sorted([(1, "a", "newer"), (2, "b", "keep"), (3, "c", None), (None, "n", None)], key=repr)


# ---------------------------------------------------------------- plans


def big(spark, n, hot):
    """Keys of which a third are `hot`."""
    k = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id"))
    return spark.range(0, n, 1, 16).select(k.alias("k"), F.lit(DAY0).alias("d"), F.col("id").cast("string").alias("v"))


def split_small_skew(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")


def test_hot_target_key_is_split(spark, conf, final_plan):
    split_small_skew(conf)
    target, source = big(spark, 200_000, 7), big(spark, 50_000, 7).dropDuplicates(["k"])
    wide = target.withColumn("w", F.lit(None).cast("string"))
    for df in (
        upsert(target, source, ["k"]),
        upsert(target, source, ["k"], only_if_newer="d", target_keys_unique=False),
        fill_columns(wide, source.withColumnRenamed("v", "w"), ["k"], ["w"], "d"),
        key_join(target, source, ["k"], "left_semi"),
    ):
        assert "SortMergeJoin(skew=true)" in final_plan(df)


@pytest.mark.parametrize("newer", [None, "d"])
def test_null_keys_spread_over_tasks(spark, conf, newer):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    target, source = big(spark, 200_000, None), big(spark, 500, 7).dropDuplicates(["k"])
    parts = upsert(target, source, ["k"], only_if_newer=newer).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert max(sizes) < 2.5 * sum(sizes) / 8


def test_hot_source_key_is_reduced_before_the_shuffle(spark, final_plan):
    plan = final_plan(latest_per_key(big(spark, 50_000, 7), ["k"], "d", ["v"]))
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_small_source_leaves_the_target_where_it_is(spark, conf, tmp_path, final_plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = str(tmp_path / "target")
    big(spark, 10_000, None).write.parquet(path)
    target, source = spark.read.parquet(path), big(spark, 1_000, 7).dropDuplicates(["k"])
    plan = final_plan(upsert(target, source, ["k"], broadcast_keys=True))
    scan = plan[: plan.index(path.split("/")[-1])] if path in plan else plan
    join = scan[scan.index("BroadcastHashJoin") :]
    assert "LeftAnti" in join
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    first_child = "".join(lines[at + 1 : at + 5])
    assert "FileScan" in first_child and "Exchange" not in first_child.split("FileScan")[0]
