"""Whole-table reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.columns import Field, select_declared
from tidemark.operators.ranges import CHUNK_RANGE


def full_scan(df: DataFrame, fields: Sequence[Field] | None = None) -> DataFrame:
    """All rows: the declared columns, or every column."""
    return df.select("*") if fields is None else select_declared(df, fields)


def range_partitions(lower: int, upper: int, chunk_range: int, most: int) -> int:
    """Parallel reads for the keys [lower, upper]: one per chunk, `most` at the most."""
    return max(1, min(most, -((lower - upper - 1) // chunk_range)))


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    fields: Sequence[Field],
    *,
    chunk_range: int = CHUNK_RANGE,
    most_reads: int,
    fetch_rows: int = 10_000,
    **options: str,
) -> DataFrame:
    """A database table read in parallel by key range, with the bounds asked from the database first.

    Filters and column selection on the result reach the database. Null keys come with the first range.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    bounds = reader.option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").load().first()
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_rows).options(**options)
    if bounds["lo"] is not None:
        lower, upper = int(bounds["lo"]), int(bounds["hi"])
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", lower)
            .option("upperBound", upper + 1)
            .option("numPartitions", range_partitions(lower, upper, chunk_range, most_reads))
        )
    return select_declared(reader.option("dbtable", table).load(), fields)
