"""Filters and reads by date window, key range, key chunk and page."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import days_before
from tidemark.workspace import new_folder

LOOKBACK_DAYS = 2
CHUNK_RANGE = 100_000
PAGE_ROWS = 1000

# A page search counts rows in this many key chunks at a time, until a task can hold the rows to skip.
GRID = 10_000
MOST_SKIPPED = 100_000


def recent_window(df: DataFrame, date_col: str, as_of: dt.date | Column, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows changed since midnight `days` days before `as_of`. No upper bound; null dates go."""
    return df.filter(F.col(date_col) >= days_before(as_of, days))


def key_range(df: DataFrame, key: str, lower, upper) -> DataFrame:
    """Rows with lower <= key < upper."""
    return df.filter((F.col(key) >= lower) & (F.col(key) < upper))


def sorted_key_range(df: DataFrame, key: str, lower, upper) -> DataFrame:
    """The key range with rows sorted by key, partition after partition.

    The input partition is the second range column, so that the rows of a hot key spread over many tasks.
    """
    rows = key_range(df, key, lower, upper).withColumn("_from", F.spark_partition_id())
    return rows.repartitionByRange(F.col(key), F.col("_from")).sortWithinPartitions(key).drop("_from")


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value)


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key in one pass (one row)."""
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def top_key(df: DataFrame, key: str, descending: bool = True) -> DataFrame:
    """The first key of the sorted table; a null key is never first."""
    order = F.col(key).desc() if descending else F.col(key).asc()
    return df.select(key).filter(F.col(key).isNotNull()).orderBy(order).limit(1)


def page(df: DataFrame, order_by: list[str], number: int, rows: int = PAGE_ROWS) -> DataFrame:
    """Page `number` (from 0) of the sorted table. Each task holds the rows up to the page's end: for early pages."""
    return df.orderBy(*order_by).offset(number * rows).limit(rows)


def page_by_key(
    df: DataFrame, key: str, number: int, rows: int = PAGE_ROWS, *, most_skipped: int = MOST_SKIPPED
) -> DataFrame:
    """Page `number` of the table sorted by an integer key without nulls, however far in.

    Counts rows per key chunk (one row per chunk comes back, `GRID` at most) to find the chunk in which the
    page begins, and again within that, until few rows are left to skip. Rows of one key are ordered by a
    hash, so that a key with more rows than a task may hold is searched in the same way.
    """
    if not df.filter(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} has nulls, which have no place in the order of pages")
    hashed = df.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(*df.columns), 1))
    return _slice(hashed, [key, "_hash"], number * rows, rows, most_skipped).drop("_hash")


def _slice(df: DataFrame, order_by: list[str], skip: int, rows: int, most_skipped: int) -> DataFrame:
    """Rows `skip` to `skip + rows` in the order of some integer columns."""
    key = order_by[0]
    low, high = _span(df, key)
    until, held = high, None
    while skip > most_skipped and high - low > 1:
        width = -((low - high) // GRID)
        chunk = chunk_of(F.col(key), F.lit(low), width)
        counts = key_range(df, key, low, high).groupBy(chunk.alias("c")).agg(F.count("*").alias("n")).collect()
        before, begin = 0, None
        for c, n in sorted(counts):
            if begin is None and before + n > skip:
                begin, skipped, held = c, before, n
            before += n
            if before >= skip + rows:
                until = min(until, low + (c + 1) * width)
                break
        if begin is None:
            return df.limit(0)
        low, high, skip = low + begin * width, min(high, low + (begin + 1) * width), skip - skipped
    found = key_range(df, key, low, until)
    if skip <= most_skipped:
        return found.orderBy(*order_by).offset(skip).limit(rows)
    first = found.filter(F.col(key) == low)
    here = min(rows, max(0, (first.count() if held is None else held) - skip))
    # Rows alike in every column are copies: any of them will do.
    head = _slice(first, order_by[1:], skip, here, most_skipped) if order_by[1:] else first.limit(here)
    return head.union(found.filter(F.col(key) > low).orderBy(*order_by).limit(rows - here))


def chunk_of(key: Column, start, chunk_range: int = CHUNK_RANGE) -> Column:
    """Number of the half-open key chunk, counted from `start`. Integer division, exact for any key."""
    offset = key.cast("bigint") - start
    return F.call_function("div", offset - F.pmod(offset, F.lit(chunk_range)), F.lit(chunk_range).cast("bigint"))


def with_chunks(df: DataFrame, key: str, chunk_range: int = CHUNK_RANGE, name: str = "chunk_id") -> DataFrame:
    """Each row's chunk, counted from the smallest key. The smallest key is a scalar subquery, not a join."""
    smallest = df.agg(F.min(key).alias("k")).scalar()
    return df.withColumn(name, chunk_of(F.col(key), smallest, chunk_range))


def _span(df: DataFrame, key: str) -> tuple[int, int]:
    """Smallest key and largest key + 1, read to the driver as one row; (0, 0) where there is no key."""
    bounds = key_bounds(df, key).first()
    if bounds["min_key"] is None:
        return 0, 0
    return int(bounds["min_key"]), int(bounds["max_key"]) + 1


def _grid(spark: SparkSession, lowest: int, end: int, chunk_range: int) -> DataFrame:
    return spark.range(0, -((lowest - end) // chunk_range)).select(
        F.col("id").alias("chunk_id"),
        (F.lit(lowest) + F.col("id") * chunk_range).alias("lower"),
        F.least(F.lit(lowest) + (F.col("id") + 1) * chunk_range, F.lit(end)).alias("upper"),
    )


def chunk_grid(df: DataFrame, key: str, chunk_range: int = CHUNK_RANGE) -> DataFrame:
    """All chunks from the smallest to the largest key, empty ones too; the last ends at the largest key + 1.

    Reads the two bounds to the driver; the grid itself is a distributed range.
    """
    return _grid(df.sparkSession, *_span(df, key), chunk_range)


def chunk_counts(df: DataFrame, key: str, chunk_range: int = CHUNK_RANGE) -> DataFrame:
    """The chunk grid with the number of rows in each chunk."""
    lowest, end = _span(df, key)
    chunk = chunk_of(F.col(key), F.lit(lowest), chunk_range)
    counts = df.groupBy(chunk.alias("chunk_id")).agg(F.count("*").alias("n_rows"))
    return (
        _grid(df.sparkSession, lowest, end, chunk_range)
        .join(counts, "chunk_id", "left")
        .select("chunk_id", "lower", "upper", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    )


def page_grid(df: DataFrame, order_by: list[str], rows: int = PAGE_ROWS, name: str = "page_id") -> DataFrame:
    """Every row with the number of its page (from 0) in the table sorted by `order_by`, nulls first.

    Two passes over one range partitioning: rows per partition are counted, and each row's place in its partition is added to the
    rows before it. Only the counts, one row for each partition, are summed up in one place. A hash of the row is the last sort
    column, so that rows of a hot key are dealt over many tasks; rows alike in every column may change places.
    """
    spark, own = df.sparkSession, {c: f"c{i}" for i, c in enumerate(df.columns)}
    given = df.select(*[F.col(f"`{c}`").alias(own[c]) for c in df.columns])
    order = [*(F.col(own[c]).asc_nulls_first() for c in order_by), F.col("_hash").asc()]
    placed = given.withColumn("_hash", F.xxhash64(*own.values())).repartitionByRange(*order)
    placed = placed.withColumn("_part", F.spark_partition_id())
    # Stored, since bounds are sampled anew whenever a range partitioning is run again.
    path = new_folder(spark, "pages")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # One row for each partition of the range partitioning.
    ranked = placed.withColumn("_place", inside).join(F.broadcast(starts), "_part")
    page_of = F.call_function("div", F.col("_before") + F.col("_place") - 1, F.lit(rows).cast("bigint"))
    return ranked.select(*[F.col(own[c]).alias(c) for c in df.columns], page_of.cast("bigint").alias(name))


def equal_depth_bounds(df: DataFrame, key: str, chunks: int, *, sketch_k: int = 800) -> DataFrame:
    """At most `chunks` half-open key ranges of about as many rows each: chunk_id, lower, upper, n_rows.

    Bounds are quantiles of a KLL sketch, which tasks build apart and merge; the rows of each chunk are then counted exactly. A
    key that holds more rows than a chunk should is a chunk of its own with what follows it up to the next bound. With
    `sketch_k` of 800 a bound is off by about 0.4 % of all rows, so for up to a hundred chunks or so none has twice the mean
    unless one key has. Null keys are in no chunk; without keys the result is empty.
    """
    shares = F.array(*[F.lit(i / chunks) for i in range(1, chunks)]) if chunks > 1 else F.array().cast("array<double>")
    known = df.select(F.col(f"`{key}`").cast("bigint").alias("key")).filter("key is not null")
    told = known.agg(F.kll_sketch_agg_bigint("key", sketch_k).alias("sketch"), F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    spark = df.sparkSession
    if told["lo"] is None:
        return spark.createDataFrame([], "chunk_id bigint, lower bigint, upper bigint, n_rows bigint")
    sketch = spark.createDataFrame([(bytes(told["sketch"]),)], "sketch binary")
    cuts = sketch.select(F.kll_sketch_get_quantile_bigint("sketch", shares)).first()[0] if chunks > 1 else []
    lowers = sorted({int(told["lo"]), *map(int, cuts)})
    uppers = [*lowers[1:], int(told["hi"]) + 1]
    # The bounds, `chunks` at most, are compared with each row's key: no join.
    bounds = F.array(*[F.lit(x).cast("bigint") for x in lowers])
    place = F.aggregate(bounds, F.lit(-1), lambda n, x: n + (F.col("key") >= x).cast("int"))
    counts = known.groupBy(place.cast("bigint").alias("chunk_id")).agg(F.count("*").alias("n_rows"))
    grid = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(lowers, uppers))], "chunk_id bigint, lower bigint, upper bigint")
    return grid.join(counts, "chunk_id", "left").select("chunk_id", "lower", "upper", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))
