"""Latest row per key and exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.operators.skew import known


def latest_per_key(
    df: DataFrame, keys: Sequence[str], date_col: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """The row with the newest `date_col` per key; null dates come last, all null keys are one key.

    `ties` decides between rows of the same date (ascending). By default every other column does, so
    that a rerun picks the same row. Catalyst keeps one row per key and input partition before the
    shuffle (partial WindowGroupLimit): a key that holds a third of all rows sends a few rows, not a third.
    """
    if ties is None:
        ordered = {f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))}
        ties = [c for c in df.columns if c in ordered and c != date_col and c not in keys]
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(date_col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]
    )
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Identical rows once. The partial aggregate collapses copies before the shuffle."""
    return df.dropDuplicates()


class DuplicateKeys(ValueError):
    """Source rows that share a key which must be unique."""


def require_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` itself, or DuplicateKeys with some of the offending keys. Runs one aggregate over the keys."""
    copies = df.select(*keys).filter(known(keys)).groupBy(*keys).agg(F.count("*").alias("copies"))
    repeated = copies.filter("copies > 1")
    found = repeated.orderBy(F.desc("copies"), *keys).limit(20).collect()
    if found:
        raise DuplicateKeys(f"source keys {list(keys)} are not unique, for example {[tuple(r) for r in found]}")
    return df
