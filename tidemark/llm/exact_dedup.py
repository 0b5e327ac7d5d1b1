"""Exact dedup by distributed MSD radix partitioning.

Every document is read as the bytes `length ‖ normalised text`. Level 0 splits all documents by their length and first
bytes, each further level splits the groups that are left by their next bytes, with digits that grow from level to
level. A document alone in its group leaves; a group whose text has ended is a group of copies. Equality is decided
by the bytes alone.

A level is two shuffles of the documents still in a group: a count by (group, digit), which is combined before its
shuffle, so a group with a third of all rows sends one row per task; and a plain join back to the groups of two or
more, whose hot keys adaptive execution splits. Before the join of level 0 a bitmap of the groups, of bounded
size, lets documents that are surely alone pass without a shuffle; where the bitmap is too small for the corpus,
more documents go through the join. Since the length is the first digit, hardly anything but copies goes
further. The levels are tables in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.sieve import sieved
from tidemark.llm.text import Shelf, single_spaced

FIRST_BYTES = 64
GROWTH = 8


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, and with `carry` the whole row as `row`.

    Texts are equal if they are after each run of white space has become one space; a null text counts as empty.
    Of equal texts the smallest id stays. A null id is larger than any other; a group with null ids only has the
    keep_id null. Of rows with equal text and equal smallest id (or all null) exactly one is kept, any of them.
    Every row counts in group_size. Without rows the result is empty. Other columns of `docs`, whatever their
    names, are only in `row`.
    """
    shelf = Shelf(docs.sparkSession, "exact-dedup")
    text, rest = F.col(f"`{text_col}`"), ["row"] if carry else []
    norm = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        single_spaced(text).alias("norm"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    heads = norm.withColumns(
        {"length": F.octet_length("norm"), "digit": _digit(F.col("norm").cast("binary"), first_bytes)}
    )
    shared = heads.groupBy("length", "digit").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    groups = shelf.put(shared.withColumn("gid", F.monotonically_increasing_id()), "groups-0")
    maybe = F.col("maybe")
    level = shelf.put(
        sieved(heads, groups, ["length", "digit"]).select(
            "doc_id", "length", "digit", F.sha2("norm", 256).alias("sha"), "maybe",
            F.when(maybe, F.col("norm").cast("binary")).alias("text"), F.monotonically_increasing_id().alias("tag"),
            *rest,
        ),
        "sieved",
    )
    done = [_alone(level.filter(~maybe), rest)]
    # Joins are by shuffle at every size: the broadcast side would grow with the copies in the corpus.
    joined = level.filter(maybe).join(groups.hint("merge"), ["length", "digit"], "left")
    level = shelf.put(joined.select("doc_id", "sha", "length", "tag", "gid", _rest("gid", first_bytes), *rest), "level-0")
    done.append(_alone(level.filter("gid IS NULL"), rest))
    open_rows, start, width = level.filter("gid IS NOT NULL"), first_bytes, first_bytes * growth
    while True:
        keyed = open_rows.withColumn("digit", _digit(F.col("text"), width))
        found = keyed.groupBy("gid", "digit").agg(
            F.count("*").alias("n"),
            F.min("doc_id").alias("keep_id"),
            F.coalesce(F.min_by("tag", "doc_id"), F.min("tag")).alias("keep_tag"),
            F.max("length").alias("longest"),
        )
        numbered = found.filter("n > 1").withColumn("next_gid", F.monotonically_increasing_id())
        groups = shelf.put(numbered, f"groups-{start}")
        start, width = start + width, width * growth
        joined = keyed.join(groups.hint("merge"), ["gid", "digit"], "left")
        level = shelf.put(
            joined.select(
                "doc_id", "sha", "length", "tag", "next_gid", "n", "keep_id", "keep_tag",
                _rest("next_gid", width // growth), *rest,
            ),
            f"level-{start}",
        )
        member, ended = F.col("next_gid").isNotNull(), F.col("length") <= start
        done.append(_alone(level.filter(~member), rest))
        done.append(
            level.filter(member & ended).select(
                "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("tag") == F.col("keep_tag")).alias("kept"),
                F.col("sha").alias("text_sha256"), *rest,
            )
        )
        if groups.filter(F.col("longest") > start).isEmpty():
            return reduce(DataFrame.unionByName, done)
        open_rows = level.filter(member & ~ended).select(
            "doc_id", "sha", "length", "tag", F.col("next_gid").alias("gid"), "text", *rest
        )


def _rest(group: str, width: int) -> Column:
    """What is left of the text behind its digit, for rows that are in a group."""
    return F.when(F.col(group).isNotNull(), F.substring("text", width + 1, (1 << 31) - 1)).alias("text")


def _digit(content: Column, width: int) -> Column:
    return F.substring(content, 1, width)


def _alone(rows: DataFrame, rest: list[str]) -> DataFrame:
    return rows.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *rest,
    )
