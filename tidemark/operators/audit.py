"""Counts and success flags of a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def filtered_count(df: DataFrame, predicate: Column | None = None, name: str = "n_rows") -> DataFrame:
    """Number of rows, under the predicate of the read if there is one."""
    rows = df if predicate is None else df.filter(predicate)
    return rows.agg(F.count("*").alias(name))


def load_audit(df: DataFrame, chunk: str, batch: str, ok: Column) -> DataFrame:
    """Rows uploaded and failed per chunk. One bad row fails its whole batch.

    Two aggregates, first per batch and then per chunk; both combine before their shuffle.
    """
    batches = df.groupBy(chunk, batch).agg(F.count("*").alias("n"), F.bool_and(ok).alias("good"))
    return batches.groupBy(chunk).agg(
        F.count("*").alias("batches"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("uploaded"),
        F.sum(F.when(F.col("good"), 0).otherwise(F.col("n"))).alias("failed"),
        F.bool_and("good").alias("succeeded"),
    )


def row_audit(df: DataFrame, chunk: str, ok: Column) -> DataFrame:
    """The same where every row is a batch of its own: one aggregate, combined before its shuffle."""
    return df.groupBy(chunk).agg(
        F.count("*").alias("batches"),
        F.count_if(ok).alias("uploaded"),
        F.count_if(~ok).alias("failed"),
        F.bool_and(ok).alias("succeeded"),
    )


def audit_total(audit: DataFrame) -> DataFrame:
    """Totals over all chunks, one row. A load without batches succeeded."""
    sums: Sequence[str] = ("batches", "uploaded", "failed")
    return audit.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.coalesce(F.bool_and("succeeded"), F.lit(True)).alias("succeeded"),
    )


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can match nothing because a key column is null."""
    present = [F.col(k).isNotNull() for k in keys]
    known = present[0]
    for p in present[1:]:
        known = known & p
    return df.agg(F.count_if(~known).alias("null_keys"))
