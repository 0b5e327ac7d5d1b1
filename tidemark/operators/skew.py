"""Joins on a key of which one value, or null, may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def known(keys: Sequence[str]) -> Column:
    """All key columns are there. Plain null tests reach the scan; `dropna` would not."""
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The known keys of `df`, each once. Copies of a hot key collapse before the shuffle."""
    return df.select(*keys).filter(known(keys)).distinct()


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` with a second join column `_spread`: 0 beside a known key, the input partition beside a null one.

    Null keys match nothing, so they may go to any reducer; on the key alone they would all meet in one.
    The wider join key also asks for a fresh shuffle of both sides, and only between two such shuffles
    does AQE split the skewed partition of a hot key. The 0 is computed from the key because the optimizer
    would take a literal out of the join condition.
    """
    zero = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1))
    return df.withColumn("_spread", F.when(known(keys), zero).otherwise(F.spark_partition_id()))


def key_join(
    df: DataFrame, keys_of: DataFrame, keys: Sequence[str], how: str, *, broadcast: bool = False
) -> DataFrame:
    """Rows of `df` whose key is (`left_semi`) or is not (`left_anti`) a key of `keys_of`.

    `broadcast` is for callers that have checked the size of the keys; `df` then stays where it is.
    """
    others = distinct_keys(keys_of, keys)
    if broadcast:
        return df.join(F.broadcast(others), list(keys), how).select(*df.columns)
    joined = spread(df, keys).join(spread(others, keys), [*keys, "_spread"], how)
    return joined.select(*df.columns)
