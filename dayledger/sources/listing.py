"""Outside list of event numbers: text lines, fields parted by pipes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions.text import strip
from dayledger.sources.tables import path_exists

#: Why a line is no entry.
BLANK, NO_NUMBER = "blank", "first field is no number"


def _field(line: str) -> Column:
    return strip(F.split(strip(F.col(line)), r"\|", 2)[0])


def number_text(field: Column) -> Column:
    """Digits without zeros in front, NULL for anything but the ten ASCII digits: one text for each number, of any length."""
    digits = F.when(field.rlike(r"^[0-9]+$"), field)
    return F.regexp_replace(digits, r"^0+(?=[0-9])", "")


def listed_texts(lines: DataFrame, line: str = "value") -> DataFrame:
    """Distinct numbers in the first field, as digits: none is too long to be kept. Compare with ``as_texts``."""
    numbers = lines.select(number_text(_field(line)).alias("event_number"))
    return numbers.where("event_number is not null").distinct()


def as_texts(found: DataFrame) -> DataFrame:
    """Event numbers as digits, to be reconciled with ``listed_texts``."""
    return found.select(F.col("event_number").cast("string").alias("event_number"))


def listed_numbers(lines: DataFrame, line: str = "value") -> DataFrame:
    """The distinct numbers that fit 64 bits, as such. No event has another, so for
    reconciliation with events take ``listed_texts``, which keeps the others as missing."""
    numbers = lines.select(_field(line).alias("field")).where(F.col("field").rlike(r"^[0-9]+$"))
    return (
        numbers.select(F.col("field").try_cast("bigint").alias("event_number"))
        .where("event_number is not null")
        .distinct()
    )


def rejected_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are no entries, repeats counted: (line, reason, n)."""
    reason = F.when(strip(F.col(line)) == "", BLANK).otherwise(NO_NUMBER)
    bad = lines.where(number_text(_field(line)).isNull() & F.col(line).isNotNull())
    return bad.groupBy(F.col(line).alias("line"), reason.alias("reason")).agg(F.count("*").alias("n"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the list; a missing file gives none."""
    return spark.read.text(path) if path_exists(spark, path) else spark.createDataFrame([], "value string")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return listed_numbers(spark.read.text(path))
