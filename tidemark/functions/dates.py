"""Day arithmetic for the recent window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

US_DATE = "MM/dd/yyyy"


def days_before(as_of: dt.date | Column, days: int) -> Column:
    """Midnight `days` days before `as_of`. A literal folds to a constant, so it is pushed to the scan."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.date_sub(day, days)


def us_date_text(day: Column) -> Column:
    """A date as zero-padded month/day/year text."""
    return F.date_format(day, US_DATE)


def parse_us_date(text: Column) -> Column:
    return F.try_to_date(text, US_DATE)
