"""Declared schemas, projection, load stamp and cleaning by declared type."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import cleaned, spark_type
from tidemark.functions.types import declared_type

STAMP = "updated_at"
BAD_CELLS = "bad_cells"
BAD_DATE = "bad_date"

# Text of these declared types that cannot be read becomes null without failing the load.
LENIENT_TYPES = ("DATE",)


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True


def declared_fields(rows: Iterable) -> list[Field]:
    """Fields from schema rows (`Column Name`, `Data Type`, `Nullable`); rows without a type are skipped."""
    return [
        Field(r["Column Name"], declared_type(r["Data Type"]), (r["Nullable"] or "").upper() != "REQUIRED")
        for r in rows
        if declared_type(r["Data Type"])
    ]


def fields_of(text: str) -> list[Field]:
    """Fields from lines of `name TYPE`."""
    return [Field(*line.split()) for line in text.strip().splitlines()]


def declared_schema(fields: Sequence[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, spark_type(f.type), f.nullable) for f in fields])


def landed_schema(fields: Sequence[Field]) -> T.StructType:
    """The declared columns as text, the form in which landed pages carry them."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in fields if f.name.lower() != STAMP])


def select_declared(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Declared columns in declared order, without the load stamp."""
    return df.select(*[f.name for f in fields if f.name.lower() != STAMP])


def drop_links(df: DataFrame) -> DataFrame:
    return df.drop("links")


def stamp_load(df: DataFrame, load_ts: dt.datetime | Column, name: str = STAMP) -> DataFrame:
    """The same load time on every row."""
    return df.withColumn(name, load_ts if isinstance(load_ts, Column) else F.lit(load_ts))


def conform(
    df: DataFrame,
    fields: Sequence[Field],
    *,
    count_bad: bool = False,
    lenient: Sequence[str] = LENIENT_TYPES,
    bad_date: str | None = None,
) -> DataFrame:
    """One projection from `df` to the declared columns and types.

    Declared columns that `df` lacks become null, undeclared ones go. With `count_bad`, `bad_cells`
    holds the number of cells per row whose text could not be read, `lenient` types left out, or that are
    null though the column is declared REQUIRED. With `bad_date`, the column of that name tells whether the text of
    the date column it names could not be read.
    """
    unread = F.lit(False)
    have = {f.name.lower(): f for f in df.schema}
    columns: list[Column] = []
    bad: list[Column] = []
    for field in fields:
        if field.name.lower() == STAMP and STAMP not in have:
            continue
        want = spark_type(field.type)
        source = have.get(field.name.lower())
        if source is None:
            columns.append(F.lit(None).cast(want).alias(field.name))
            bad += [F.lit(1)] if not field.nullable else []
            continue
        raw = F.col(f"`{source.name}`")
        value = cleaned(raw, source.dataType, want)
        columns.append(value.alias(field.name))
        broken = raw.isNotNull() & value.isNull()
        if source.dataType != want and bad_date and field.name.lower() == bad_date.lower():
            unread = broken
        if not field.nullable:
            bad.append(value.isNull().cast("int"))
        elif source.dataType != want and field.type not in lenient:
            bad.append(broken.cast("int"))
    if count_bad:
        columns.append(reduce(lambda a, b: a + b, bad, F.lit(0)).alias(BAD_CELLS))
    if bad_date:
        columns.append(unread.alias(BAD_DATE))
    return df.select(*columns)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` in the column order and types of `schema`; columns it lacks become null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def concat_pages(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept; a column absent from one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, first)
