"""Dates and times as they stand in reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.text import blank_to_null, strip


#: Characters of the longest ``m/d/yyyy``.
LONGEST_US_DATE = 10


def _typed_date(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def us_date(text: Column) -> Column:
    """``m/d/yyyy`` at the start of the text; NULL for anything else, 02/30 included."""
    return _typed_date(
        blank_to_null(F.regexp_extract(strip(text), r"^(\d{1,2}/\d{1,2}/\d{4})", 1)), "M/d/yyyy"
    )


def long_date(text: Column) -> Column:
    """First ``Month d, yyyy`` in the text; NULL when there is none or it is no date."""
    return _typed_date(
        blank_to_null(F.regexp_extract(text, r"(?U)(\w+ \d{1,2}, \d{4})", 1)), "MMMM d, yyyy"
    )


def compact_date(text: Column) -> Column:
    """Checked DATE of ``yyyyMMdd``."""
    return _typed_date(blank_to_null(text), "yyyyMMdd")


def clock_time(text: Column) -> Column:
    """``HH:MM`` at the start of the text or NULL. The range is not checked."""
    return blank_to_null(F.regexp_extract(strip(text), r"^(\d{1,2}:\d{2})", 1))


def clock_zone(text: Column) -> Column:
    """Zone in brackets after the time, '' when there is none."""
    return F.regexp_extract(strip(text), r"(?U)^\d{1,2}:\d{2}\s*\[(\w+)\]", 1)
