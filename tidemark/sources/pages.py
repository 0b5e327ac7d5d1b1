"""Landed pages: JSON objects with the rows in `items`."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.columns import drop_links
from tidemark.operators.ranges import PAGE_ROWS


def page_schema(row: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("items", T.ArrayType(row)), T.StructField("hasMore", T.BooleanType())]
    )


def rows_of(pages: DataFrame) -> DataFrame:
    """One row per item. A page without items gives none; the empty `links` of each item go."""
    return drop_links(pages.select(F.explode("items").alias("item")).select("item.*"))


#: Folder of the pages landed on one day: `landed=2024-03-10`.
LANDED = "landed"


def read_pages(
    spark: SparkSession, path: str, row: T.StructType, *, multiline: bool = False, since: dt.date | None = None
) -> DataFrame:
    """Rows of the pages under `path`, one page per line (or per file). A broken page fails the read.

    With `since`, only the folders of that day and later are read; pages must have been landed by day.
    """
    schema = page_schema(row)
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", multiline)
    if since is None:
        return rows_of(reader.schema(schema).json(path))
    return rows_of(reader.schema(schema.add(LANDED, T.DateType())).json(path).filter(F.col(LANDED) >= F.lit(since)))


def stream_pages(spark: SparkSession, path: str, row: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream: each micro-batch has the rows of newly landed files."""
    reader = spark.readStream.schema(page_schema(row)).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return rows_of(reader.json(path))


def to_pages(df: DataFrame, rows: int = PAGE_ROWS) -> DataFrame:
    """JSON pages of at most `rows` rows each, for landing `df`.

    The page number comes from the running row id, which is unique, so no group can exceed `rows`. Give it
    stored rows: they keep their order, so that a task that is run again numbers them alike.
    """
    numbered = df.select(
        F.struct(*df.columns, F.array().cast("array<string>").alias("links")).alias("item"),
        F.call_function("div", F.monotonically_increasing_id(), F.lit(rows).cast("bigint")).alias("page"),
    )
    paged = numbered.groupBy("page").agg(F.collect_list("item").alias("items"))
    return paged.select(F.to_json(F.struct("items", F.lit(True).alias("hasMore"))).alias("value"))


def land_pages(df: DataFrame, path: str, rows: int = PAGE_ROWS, *, day: dt.date | None = None) -> None:
    """Land rows as pages, in the folder of a day if one is given."""
    to_pages(df, rows).write.mode("append").text(f"{path}/{LANDED}={day.isoformat()}" if day else path)
