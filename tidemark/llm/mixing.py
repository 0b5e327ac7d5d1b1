"""Mixing sources to target weights by hash-threshold histograms.

The words of each source are summed; sources in code-point order, null last, get weights that repeat, and share the
words of the whole corpus by weight. A target stops at `most_copies` times its source, and the excess is shared by
weight among the others until no target is above. A source then takes every document `floor(target / size)` times, and
once more those whose hash is below a threshold.

Thresholds are found without sorting: words are summed by source and bucket of the hash's highest bits, the bucket in
which the budget ends is split by the next bits, and so on; every level sums only the documents of boundary buckets.
Sums are combined before they are shuffled, so a source with a third of all rows is no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.text import Shelf, filled, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
HASH_BITS = 60
LEVEL_BITS = 10


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    carry: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, copies, taken, and with `carry` the whole row as `row`.

    size is the number of words (null text: 0); taken is copies times size. The threshold hash is made of id and text:
    reruns agree, rows equal in both are decided alike, and null ids are spread by their texts. A null source is
    a source, the last one. The document on which a budget ends is taken if at least half of it fits. A source
    without words has target 0. Without rows the result is empty. Other columns of `docs`, whatever their names, are
    only in `row`.
    """
    shelf = Shelf(docs.sparkSession, "mixing")
    given = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
        mixing_hash(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    sized = shelf.put(given.drop("row"), "sized")
    sums = shelf.put(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    goals = shelf.put(_targets(sums, weights, most_copies), "targets")
    rules = _thresholds(shelf, sized, goals)
    # Rows are read again for their other columns; id, size and hash come out the same.
    rows = given if carry else sized
    # The hash of a text without words may be below any threshold.
    copies = F.least(F.col("base") + (F.col("h") < F.col("threshold")).cast("long"), F.lit(most_copies))
    joined = rows.join(rules.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )


def mixing_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text, as a long."""
    content = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), filled(text))
    return F.conv(F.substring(F.md5(content), 1, HASH_BITS // 4), 16, 10).cast("long")


def _ranked(sums: DataFrame) -> DataFrame:
    """Position of each source in code-point order, null last, from 0: sorted by range, numbered inside each range,
    then shifted by the rows of the ranges before. Only one count per range passes through the driver."""
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    dealt = sums.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    shelf = Shelf(sums.sparkSession, "ranks")
    dealt = shelf.put(dealt, "ranges")
    counts = sorted(tuple(r) for r in dealt.groupBy("part").count().collect())
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    shifts = sums.sparkSession.createDataFrame(before, "part int, before long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return dealt.join(F.broadcast(shifts), "part").withColumn("rank", F.col("before") + inside).drop("part", "before")


def _targets(sums: DataFrame, weights: Sequence[int], most_copies: int) -> DataFrame:
    """Targets by weight, stopped at `most_copies` times the source: only the words per unit of weight pass the driver."""
    listed = F.array(*[F.lit(int(w)) for w in weights])
    weighed = Shelf(sums.sparkSession, "weights").put(
        _ranked(sums).withColumn("weight", F.get(listed, F.pmod("rank", F.lit(len(weights))).cast("int")).cast("long")),
        "weighed",
    )
    limit = F.lit(most_copies) * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    unit, stopped = 0.0, -1
    while True:
        full = F.lit(unit) * F.col("weight") >= limit if stopped >= 0 else F.lit(False)
        fact = weighed.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if fact["n"] == stopped or not fact["weight"]:
            break
        stopped, unit = fact["n"], (total - fact["words"]) / fact["weight"]
    share = F.lit(unit) * F.col("weight")
    target = F.when(share >= limit, limit.cast("double")).otherwise(share)
    return weighed.select("source", "source_size", target.alias("target"))


def _thresholds(shelf: Shelf, sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: whole copies of every document (`base`), and the hash below which one more is taken."""
    size = F.col("source_size")
    base = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    state = goals.withColumn("base", base).select(
        "source", "source_size", "target", "base",
        (F.col("target") - F.col("base") * size).alias("left"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("threshold"),
        F.lit(True).alias("open"),
    )
    state = shelf.put(state, "state")
    rows, known = sized.filter("size > 0").select("source", "size", "h"), 0
    while known < HASH_BITS:
        step = min(LEVEL_BITS, HASH_BITS - known)
        low = HASH_BITS - known - step
        # Documents of boundary buckets: those whose known bits are the prefix.
        at = state.filter("open").select(F.col("source").alias("of"), "prefix")
        same = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("h", HASH_BITS - known) == F.col("prefix"))
        if known:
            rows = shelf.put(rows.join(at, same, "left_semi"), f"boundary-{known}")
        sums = rows.groupBy("source", F.shiftright("h", low).alias("bucket")).agg(
            F.sum("size").alias("words"), (F.min("h") == F.max("h")).alias("one")
        )
        # At most 2**step buckets of one source meet here.
        in_order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0)))
        sums = sums.withColumnRenamed("source", "of")
        ends = (F.col("before") <= F.col("left")) & (F.col("before") + F.col("words") > F.col("left"))
        edge = state.filter("open").join(sums, F.col("source").eqNullSafe(F.col("of")) & ends, "left")
        remains = F.col("left") - F.col("before")
        # A bucket with one hash is not split: it is taken if at least half of it fits.
        through = F.col("bucket") + F.when(2 * remains >= F.col("words"), 1).otherwise(0)
        split = edge.select(
            "source", "source_size", "target", "base",
            F.when(F.col("bucket").isNull(), F.col("left")).otherwise(remains).alias("left"),
            F.coalesce("bucket", "prefix").alias("prefix"),
            F.when(F.col("bucket").isNull(), F.lit(1 << HASH_BITS)).otherwise(F.shiftleft(through, low))
            .cast("long").alias("threshold"),
            F.coalesce(~F.col("one"), F.lit(False)).alias("open"),
        )
        state = shelf.put(state.filter("not open").unionByName(split), f"state-{known}")
        known += step
        if state.filter("open").isEmpty():
            break
    return state.drop("left", "prefix", "open")
