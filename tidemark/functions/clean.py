"""Text cleaners. Bad text becomes null; the audit counts it (`operators.audit`).

A failing `try_cast` costs an exception per row, far more than the cast itself. Each cleaner therefore first
tests the shape of the text, and hardly any text that cannot be read reaches the cast.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")


def _month_day(sep: str) -> str:
    """One- or two-digit month and day within the month's length; a one-digit day may have a leading blank."""
    day = "[12][0-9]|0?[1-9]| [1-9]"
    return (
        f"(?:(?:0?[13578]|1[02]){sep}(?:3[01]|{day})|(?:0?[469]|11){sep}(?:30|{day})|0?2{sep}(?:{day}))"
    )


_YEAR = "(?!0000)[0-9]{4}"
_US_DATE = rf"^{_month_day('/')}/{_YEAR}\z"
_ISO_DATE = rf"^{_YEAR}-{_month_day('-')}\z"
_ISO_SECOND = rf"^{_YEAR}-{_month_day('-')}\s+(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]\z"
_INTEGER = r"^\s*[+-]?[0-9]+\s*\z"
_FLOAT = r"^\s*(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:[+-]?inf(?:inity)?|nan))\s*\z"


def clean_boolean(value: Column) -> Column:
    """`T` is true, `F` is false, other text is read as a boolean if it is one."""
    words = {w: True for w in TRUE_WORDS} | {w: False for w in FALSE_WORDS}
    meaning = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    other = F.try_element_at(meaning, F.lower(F.trim(value)))
    return F.when(value == "T", True).when(value == "F", False).otherwise(other)


def clean_date(value: Column) -> Column:
    """Month/day/year text as a date. Every other form is null, ISO dates too."""
    year_first = F.concat(F.right(value, F.lit(4)), F.lit("-"), F.substring_index(value, "/", 2))
    iso = F.replace(year_first, F.lit("/"), F.lit("-"))
    tidy = F.when(value.contains("/ "), F.replace(iso, F.lit(" "))).otherwise(iso)
    return F.when(value.rlike(_US_DATE), tidy.try_cast("date"))


def clean_timestamp(value: Column, to: str = "timestamp_ntz") -> Column:
    """`yyyy-MM-dd` (ten characters) as midnight, or `yyyy-MM-dd HH:mm:ss`; null otherwise."""
    shaped = ((F.length(value) == 10) & value.rlike(_ISO_DATE)) | value.rlike(_ISO_SECOND)
    text = F.replace(F.regexp_replace(value, r"\s+", " "), F.lit("- "), F.lit("-"))
    return F.when(shaped, text.try_cast(to))


def clean_integer(value: Column) -> Column:
    """Digits with an optional sign; blanks around them are allowed."""
    return F.when(value.rlike(_INTEGER), value.try_cast("bigint"))


def clean_float(value: Column) -> Column:
    """A decimal number, with or without exponent, an infinity or NaN."""
    return F.when(value.rlike(_FLOAT), value.try_cast("double"))


def cleaned(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """`value` as type `want`: text goes through its cleaner, typed columns through a cast."""
    if have == want:
        return value
    if isinstance(have, T.StringType):
        if isinstance(want, T.BooleanType):
            return clean_boolean(value)
        if isinstance(want, T.DateType):
            return clean_date(value)
        if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
            return clean_timestamp(value, want.simpleString())
        if isinstance(want, T.LongType):
            return clean_integer(value)
        if isinstance(want, T.DoubleType):
            return clean_float(value)
    return value.try_cast(want)
