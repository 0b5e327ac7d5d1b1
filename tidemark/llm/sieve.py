"""A bitmap of keys, of bounded size, that lets rows whose key is surely not among them pass without a shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BUCKET_BITS = 32768
MOST_BUCKETS = 4096


def sieved(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` with `maybe`: true for every row whose `columns` are a row of `keys`, and seldom for another.

    The bitmap has 16 bits for each key, in buckets of 4 KiB of which there are at most `MOST_BUCKETS`: 16 MiB in all.
    For more keys than that it lets more rows through, and their join decides. `keys` should be stored: it is counted.
    """
    buckets = min(MOST_BUCKETS, 1 << math.ceil(math.log2(max(1, keys.count() * 16 / BUCKET_BITS))))
    slot = F.pmod(F.xxhash64(*columns), F.lit(BUCKET_BITS * buckets))
    placed = (F.floor(slot / BUCKET_BITS).alias("bucket"), F.pmod(slot, F.lit(BUCKET_BITS)).alias("place"))
    bitmap = keys.select(*placed).groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    at = df.select("*", *placed).join(F.broadcast(bitmap), "bucket", "left")
    byte = F.substring(F.col("bits"), F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.pmod("place", F.lit(8)).cast("int"))
    return at.withColumn("maybe", F.coalesce(bit == 1, F.lit(False))).drop("bucket", "place", "bits")
