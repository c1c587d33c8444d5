"""Event category from its heading."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.text import normalize_whitespace

# Phrase looked for and the category it means, first hit counts.
# "NON-AGREEMENT STATE" holds "AGREEMENT STATE" and so is one.
PHRASES = (
    ("POWER REACTOR", "Power Reactor"),
    ("AGREEMENT STATE", "Agreement State"),
    ("FUEL CYCLE", "Fuel Cycle"),
    ("MATERIAL", "Material"),
    ("NON-AGREEMENT", "Material"),
    ("GENERAL", "General Information or Other"),
    ("INFORMATION", "General Information or Other"),
)


def plain_heading(text: Column) -> Column:
    return F.upper(normalize_whitespace(text))


def category_of_heading(heading: Column) -> Column:
    """Category of a heading made by ``plain_heading``. Pass a column, not an expression:
    it is looked at once for each phrase."""
    return F.coalesce(
        *[F.when(heading.contains(phrase), F.lit(name)) for phrase, name in PHRASES],
        F.lit("Unknown"),
    )


def event_category(text: Column) -> Column:
    return category_of_heading(plain_heading(text))
