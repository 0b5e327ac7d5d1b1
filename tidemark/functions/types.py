"""Declared type names and what they stand for."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

# Declared type -> name used in the stored table's DDL.
STORAGE_TYPES = {
    "FLOAT": "FLOAT64",
    "STRING": "STRING",
    "INTEGER": "INT64",
    "BOOLEAN": "BOOL",
    "DATE": "DATE",
    "DATETIME": "DATETIME",
    "TIMESTAMP": "TIMESTAMP",
}

SPARK_TYPES = {
    "FLOAT": T.DoubleType(),
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    # A number without precision keeps its fraction.
    "NUMERIC": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18),
    # Names of storage types are types too.
    "FLOAT64": T.DoubleType(),
    "INT64": T.LongType(),
    "BOOL": T.BooleanType(),
    "JSON": T.StringType(),
}

SIZED_STRING = r"^STRING\(\d+\)$"
SIZED_NUMERIC = r"^NUMERIC\(\d+,\s*\d+\)$"
NO_TYPE = ("", "()", "NONE")


def normalized_type(type_text: Column) -> Column:
    """The type name in capitals, without padding and size; null where there is no type at all."""
    text = F.upper(F.trim(type_text))
    return (
        F.when(text.isin(*NO_TYPE), F.lit(None).cast("string"))
        .when(text.rlike(SIZED_STRING), F.lit("STRING"))
        .when(text.rlike(SIZED_NUMERIC), F.lit("FLOAT"))
        .otherwise(text)
    )


def storage_type(type_text: Column) -> Column:
    """Stored type name of a declared type; unknown names pass through unchanged."""
    names = F.create_map(*[F.lit(x) for pair in STORAGE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.upper(type_text)), type_text)


def declared_type(type_text: str | None) -> str | None:
    """The same rule as `normalized_type`, on the driver, for the few rows of a declared schema."""
    text = (type_text or "").strip(" ").upper()
    if text in NO_TYPE:
        return None
    if re.match(SIZED_STRING, text):
        return "STRING"
    if re.match(SIZED_NUMERIC, text):
        return "FLOAT"
    return text


def spark_type(type_text: str) -> T.DataType:
    """Spark type of a declared type. Names outside the table must be valid Spark DDL."""
    name = declared_type(type_text)
    if name is None:
        raise ValueError(f"no type declared: {type_text!r}")
    sized = re.fullmatch(r"(?:BIG)?NUMERIC\((\d+)\)", name)
    if sized:
        return T.DecimalType(min(38, int(sized[1]) + 9), 9)
    return SPARK_TYPES.get(name) or T.DataType.fromDDL(name)
