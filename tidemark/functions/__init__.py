"""Column expressions: cleaners, type names and dates. All are built-in Spark functions."""

from tidemark.functions.clean import (
    clean_boolean,
    clean_date,
    clean_float,
    clean_integer,
    clean_timestamp,
    cleaned,
)
from tidemark.functions.dates import days_before, parse_us_date, us_date_text
from tidemark.functions.types import normalized_type, spark_type, storage_type

__all__ = [
    "clean_boolean",
    "clean_date",
    "clean_float",
    "clean_integer",
    "clean_timestamp",
    "cleaned",
    "days_before",
    "normalized_type",
    "parse_us_date",
    "spark_type",
    "storage_type",
    "us_date_text",
]
