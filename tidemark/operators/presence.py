"""Which integer keys a table holds, as bitmaps: one of 4 KB for each stretch of 32,768 keys.

Two tables are compared stretch by stretch. What moves is bitmaps, not rows, at most one bit for each key in dense keys. Keys
strewn thinly over a wide range take a bitmap each; for those an anti join is cheaper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def presence(df: DataFrame, key: str, name: str = "bits") -> DataFrame:
    """`bucket` and the bitmap of the keys in it. Null keys are in none."""
    keys = df.select(F.col(f"`{key}`").cast("bigint").alias("_key")).filter("_key is not null")
    return keys.groupBy(F.bitmap_bucket_number("_key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias(name)
    )


def _byte(bits: str, place: Column) -> Column:
    """A byte of a bitmap as a number, 0 where there is no bitmap."""
    one = F.substring(F.col(bits), place + 1, F.lit(1))
    return F.coalesce(F.conv(F.hex(one), 16, 10).cast("int"), F.lit(0))


def departed_keys(target: DataFrame, source: DataFrame, key: str, source_key: str | None = None) -> DataFrame:
    """The keys of `target`, each once, that no row of `source` has. Null keys are no keys.

    Both sides become bitmaps, and only bytes that differ are looked at bit by bit. No rows are joined.
    """
    held, there = presence(target, key, "held"), presence(source, source_key or key, "there")
    both = held.join(there, "bucket", "left").filter(F.col("there").isNull() | (F.col("held") != F.col("there")))
    gone = F.col("_held").bitwiseAND(F.bitwise_not("_there"))
    bytes_ = both.select("bucket", "held", "there", F.explode(F.sequence(F.lit(0), F.lit(4095))).alias("_place"))
    bytes_ = bytes_.select("bucket", "_place", _byte("held", F.col("_place")).alias("_held"), _byte("there", F.col("_place")).alias("_there"))
    spots = bytes_.filter(gone != 0).select("bucket", "_place", gone.alias("_gone"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit"))
    spots = spots.filter(F.getbit("_gone", F.col("_bit")) == 1)
    bit, bucket = F.col("_place") * 8 + F.col("_bit"), F.col("bucket")
    # Bucket b holds the keys (b - 1) * 32768 + 1 to b * 32768; buckets below one count down from zero.
    value = F.when(bucket > 0, (bucket - 1) * 32768 + 1 + bit).otherwise(bucket * 32768 - bit)
    return spots.select(value.cast(target.select(F.col(f"`{key}`")).schema[0].dataType).alias(key))
