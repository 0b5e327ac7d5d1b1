"""Reconciling a source with its target: order-free checksums by key chunk, compared level by level.

The first level reads both sides once and compares a few wide chunks; each further level reads only the chunks that differ and
cuts them finer. Both sides are summed up together, one counted against the other, so nothing is joined and what moves is one
row for each task and chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.columns import align
from tidemark.operators.ranges import CHUNK_RANGE
from tidemark.operators.skew import key_join, spread
from tidemark.workspace import new_folder

#: Chunks compared at the first level, and pieces that each differing chunk is cut into at the next.
FAN = 1000
#: So many differing stretches are listed in the plan, where they prune the scan; more are joined. Rows are the same.
LISTED = 200

MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def fingerprint(columns: Sequence[str]) -> Column:
    """64-bit hash of a row. Which columns are null is hashed too, since the hash of a null is that of nothing."""
    cells = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*cells, *[c.isNull() for c in cells])


def _either(test: list[Column]) -> Column:
    """One of the tests holds, as a tree of small depth."""
    if len(test) == 1:
        return test[0]
    return _either(test[: len(test) // 2]) | _either(test[len(test) // 2 :])


def _sides(source: DataFrame, target: DataFrame, keys: Sequence[str], but: Sequence[str], buckets: int | None) -> DataFrame:
    """Rows of both sides as `k0`, ... (keys), `at` (place of the key), `hash` and `side` (1 for the source, -1 for the target).

    The columns that both have are compared, `but` left out, in the target's types.
    """
    have = {c.lower() for c in source.columns} - {c.lower() for c in but}
    shared = T.StructType([f for f in target.schema if f.name.lower() in have])
    names = {f.name.lower(): f for f in shared}
    lacking = [k for k in keys if k.lower() not in names]
    if lacking:
        raise ValueError(f"both sides need the key columns {lacking}")
    key = [names[k.lower()] for k in keys]
    if buckets is None and (len(key) > 1 or not isinstance(key[0].dataType, T.IntegralType)):
        raise ValueError("keys that are not one integer column are compared by hash buckets; give their number")
    cells = [F.col(f"`{f.name}`") for f in key]
    at = cells[0].cast("bigint") if buckets is None else F.pmod(F.xxhash64(*cells), F.lit(buckets)).cast("bigint")
    told = [c.alias(f"k{i}") for i, c in enumerate(cells)]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return align(df, shared).select(*told, at.alias("at"), fingerprint(shared.names).alias("hash"), F.lit(sign).alias("side"))

    return side(source, 1).unionByName(side(target, -1))


def _chunk(width: int) -> Column:
    """Number of the chunk that `at` is in, rounded down; no step of it leaves 64 bits."""
    at, size = F.col("at"), F.lit(width).cast("bigint")
    return F.call_function("div", at, size) - ((at < 0) & (at % size != 0)).cast("bigint")


def _differing(both: DataFrame, width: int) -> DataFrame:
    """Chunks of `width` places whose counts or checksums differ, with the rows of each side."""
    signed = F.col("hash").cast("decimal(20,0)") * F.col("side")
    sums = both.groupBy(_chunk(width).alias("chunk")).agg(
        F.count_if(F.col("side") > 0).alias("source_rows"),
        F.count_if(F.col("side") < 0).alias("target_rows"),
        F.sum(signed).alias("_sum"),
        F.bit_xor("hash").alias("_xor"),
    )
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("_sum") == 0) & (F.col("_xor") == 0)
    return sums.filter(~same).drop("_sum", "_xor")


def _inside(both: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """The rows in some chunks of `width` places."""
    listed = chunks.select("chunk").limit(LISTED + 1).collect()
    if not listed:
        return both.limit(0)
    at = F.col("at")
    if len(listed) > LISTED:
        # Null keys form one chunk, which a join would not match.
        known = both.withColumn("chunk", _chunk(width)).join(chunks.select("chunk"), "chunk", "left_semi")
        no_key = chunks.filter("chunk is null").isEmpty()
        return known.drop("chunk") if no_key else known.drop("chunk").unionByName(both.filter(at.isNull()))
    stretches: list[list[int]] = []
    for c in sorted(r["chunk"] for r in listed if r["chunk"] is not None):
        if stretches and stretches[-1][1] == c * width:
            stretches[-1][1] += width
        else:
            stretches.append([c * width, (c + 1) * width])
    tests = [_between(at, low, high) for low, high in stretches]
    if any(r["chunk"] is None for r in listed):
        tests.append(at.isNull())
    return both.filter(_either(tests))


def _between(at: Column, low: int, high: int) -> Column:
    """low <= at < high, where either may lie outside of 64 bits."""
    return (at >= F.lit(max(low, -(1 << 63)))) & (at <= F.lit(min(high, 1 << 63) - 1))


def differing_chunks(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    width: int = CHUNK_RANGE,
    buckets: int | None = None,
    fan: int = FAN,
    but: Sequence[str] = (),
) -> DataFrame:
    """The key chunks in which source and target differ: lower, upper, source_rows, target_rows.

    Chunks are `width` values of an integer key, cut at its multiples; with `buckets`, hash buckets of any keys, where lower is the
    bucket. Rows are compared on the columns both sides have, `but` left out, whatever their order; a row that one side holds more
    often counts as a difference. Rows without an integer key form the chunk without bounds. Equal or empty sides give no row. Two
    different chunks pass for equal only where 64-bit sums of hashes agree by chance. Give stored rows: each level reads again.
    """
    both = _sides(source, target, keys, but, buckets)
    width = 1 if buckets else width
    lower, limits = F.col("chunk").cast("decimal(38,0)") * F.lit(width), (F.lit(-(1 << 63)), F.lit((1 << 63) - 1))
    known = F.col("chunk").isNotNull()
    # The first and the last chunk of all keys end where 64 bits do.
    return _descend(both, width, fan).select(
        F.when(known, F.greatest(lower, limits[0])).cast("bigint").alias("lower"),
        F.when(known, F.least(lower + width, limits[1])).cast("bigint").alias("upper"),
        "source_rows",
        "target_rows",
    )


def _descend(both: DataFrame, width: int, fan: int) -> DataFrame:
    """The differing chunks of the finest level, stored."""
    span = both.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    widths = [width]
    while span["low"] is not None and (span["high"] - span["low"]) // widths[-1] > fan and widths[-1] * fan < 1 << 62:
        widths.append(widths[-1] * fan)
    rows = both
    for step in reversed(widths):
        path = new_folder(both.sparkSession, "differing")
        _differing(rows, step).write.parquet(path)
        found = both.sparkSession.read.schema("chunk bigint, source_rows bigint, target_rows bigint").parquet(path)
        rows = _inside(both, found, step)
    return found


def differing_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    width: int = CHUNK_RANGE,
    buckets: int | None = None,
    fan: int = FAN,
    but: Sequence[str] = (),
) -> DataFrame:
    """The keys whose rows differ, each once, and what the target has: `missing`, `extra` or `changed` rows.

    Only the rows of differing chunks are read for it. A key that both sides have with other rows, or other numbers of them, is
    changed. Null keys are told like any other key.
    """
    both = _sides(source, target, keys, but, buckets)
    width = 1 if buckets else width
    rows = _inside(both, _descend(both, width, fan), width)
    told = [f"k{i}" for i in range(len(keys))]
    # Rows are counted against each other before keys meet, so copies of a hot key collapse in the tasks that read them.
    net = rows.groupBy(*told, "hash").agg(
        F.sum("side").alias("net"), F.max(F.col("side") > 0).alias("ours"), F.max(F.col("side") < 0).alias("theirs")
    )
    by_key = net.groupBy(*told).agg(
        F.bool_or(F.col("net") != 0).alias("differs"), F.bool_or("ours").alias("ours"), F.bool_or("theirs").alias("theirs")
    )
    what = F.when(~F.col("theirs"), MISSING).when(~F.col("ours"), EXTRA).otherwise(CHANGED)
    return by_key.filter("differs").select(*[F.col(t).alias(k) for t, k in zip(told, keys)], what.alias("what"))


def changed_rows(
    rows: DataFrame, stored: DataFrame, keys: Sequence[str], *, but: Sequence[str] = (), broadcast_keys: bool = False
) -> DataFrame:
    """The rows, at most one for each key, that are new to `stored` or differ from its row of their key.

    The columns that both have are compared cell by cell, null equal to null, in the stored types; `but` is left out. Rows without
    a key are always new. With `broadcast_keys`, for callers that have checked their size, `stored` is not shuffled.
    """
    have, left_out = {c.lower(): c for c in rows.columns}, {c.lower() for c in [*but, *keys]}
    shared = T.StructType([f for f in stored.schema if f.name.lower() in have])
    compared = [f for f in shared if f.name.lower() not in left_out]
    # A first cell that is always there: the structs are comparable where nothing but the keys is shared.
    cells = [F.lit(True), *[F.col(f"`{f.name}`").alias(f.name) for f in compared]]
    mine = [F.lit(True), *[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in compared]]
    theirs = key_join(align(stored, shared), align(rows, shared).select(*keys), keys, "left_semi", broadcast=broadcast_keys)
    theirs = spread(theirs, keys).select(
        *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_spread").alias("_at"), F.struct(*cells).alias("_cells")
    )
    ours = spread(rows, keys).withColumn("_mine", F.struct(*mine))
    same = [ours[k] == theirs[f"_key{i}"] for i, k in enumerate(keys)]
    same += [ours["_spread"] == theirs["_at"], ours["_mine"].eqNullSafe(theirs["_cells"])]
    return ours.join(theirs, same, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])
