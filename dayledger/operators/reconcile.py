"""Event numbers found against an outside list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MATCHED, MISSING, EXTRA = "matched", "missing", "extra"


def matched(listed: DataFrame, found: DataFrame) -> DataFrame:
    return listed.select("event_number").intersect(found.select("event_number"))


def missing(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Listed, not found."""
    return listed.select("event_number").subtract(found.select("event_number"))


def extra(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Found, not listed."""
    return found.select("event_number").subtract(listed.select("event_number"))


def reconcile(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Every number once with its outcome. Both sides are made distinct first, so the
    shuffle carries each number at most once per task, and one shuffle serves both steps."""
    left = listed.select("event_number").distinct().withColumn("listed", F.lit(True))
    right = found.select("event_number").distinct().withColumn("found", F.lit(True))
    outcome = (
        F.when(F.col("listed") & F.col("found"), MATCHED)
        .when(F.col("listed"), MISSING)
        .otherwise(EXTRA)
    )
    return left.join(right, "event_number", "full_outer").select(
        "event_number", outcome.alias("outcome")
    )


def reconcile_counts(outcomes: DataFrame) -> DataFrame:
    """One row: numbers listed, found, matched, missing, extra. A list without any number
    gives no row, as there is nothing to compare."""
    is_ = {name: F.col("outcome") == name for name in (MATCHED, MISSING, EXTRA)}
    return outcomes.agg(
        F.count_if(~is_[EXTRA]).alias("listed"),
        F.count_if(~is_[MISSING]).alias("found"),
        *[F.count_if(condition).alias(name) for name, condition in is_.items()],
    ).where("listed > 0")


def first_numbers(outcomes: DataFrame, outcome: str, n: int = 20) -> DataFrame:
    """Smallest numbers of an outcome, ascending; a top-k, not a full sort. Numbers may be
    given as digits too."""
    as_digits = isinstance(outcomes.schema["event_number"].dataType, StringType)
    order = [F.length("event_number"), "event_number"] if as_digits else ["event_number"]
    return outcomes.where(F.col("outcome") == outcome).select("event_number").orderBy(*order).limit(n)
