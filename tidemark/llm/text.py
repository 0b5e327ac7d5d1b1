"""Column expressions and folders that several of the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.workspace import new_folder

#: A run of white space that is not one plain space: what is left to replace when single spaces stay as they are.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def filled(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Every run of space, tab, line feed, vertical tab, form feed and carriage return becomes one space."""
    return F.regexp_replace(filled(text), _RUNS, " ")


def word_count(text: Column) -> Column:
    """Number of runs without white space. No array of words is built: spaces between words are counted."""
    words = F.trim(single_spaced(text))
    spaces = F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def fold(doc_id: Column, folds: int = 4, held_out: int = 2) -> Column:
    """Whether a document is held out: CRC-32 of its id as text, modulo `folds`, is `held_out`. A null id is not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == held_out, F.lit(False))


def smallest_hashes(df: DataFrame, group: str, ids: Sequence[str], most: int, buckets: int = 64) -> DataFrame:
    """The `most` rows of each group with the smallest hash of `ids`, with their `place` in that order from 1.

    Chosen first in buckets of each group and then among those, so that of a group with a third of all rows no task
    gets more than a bucket's rows, and the last one at most `buckets * most`.
    """
    hashed = F.xxhash64(*ids)
    order = [hashed, *ids]
    inner = Window.partitionBy(group, F.pmod(hashed, F.lit(buckets))).orderBy(*order)
    some = df.withColumn("place", F.row_number().over(inner)).filter(F.col("place") <= most)
    outer = Window.partitionBy(group).orderBy(*order)
    return some.withColumn("place", F.row_number().over(outer)).filter(F.col("place") <= most)


class Shelf:
    """Tables of one run in the shared folder: written once, read back without their lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, new_folder(spark, name)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
