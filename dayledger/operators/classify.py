"""Page layout: one pass over the page, ordered rules, first hit wins."""

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.markup import attribute_starts, has_class, inside, open_tag, until
from dayledger.functions.text import (
    TAG,
    decode_entities,
    joined_text,
    may_hide,
    once,
    plain_markup,
    strip,
    unescape_markup,
    without_hidden,
)

# The markers that tell the layouts apart, and the lengths in characters.
EVENT_PREFIX = "en"
REPORT_DAY_CLASS = "nrc-event-report-day"
NO_EVENTS = "no events found"
NUMBER_LABEL = r"Event Number:\s*\d+"
NUMBER_WITHIN = 1000
SHORT_PRE = 400
SHORT_PAGE = 200

MODERN_EVENT = open_tag("div", has_class("grid", "border"), attribute_starts("id", EVENT_PREFIX))
LEGACY_EVENT = open_tag("a", attribute_starts("name", EVENT_PREFIX))
_GRID_BORDER = open_tag("div", has_class("grid", "border"))
_FROM_REPORT_DAY = "(?s)" + open_tag("div", has_class(REPORT_DAY_CLASS)) + "(.*+)"
_STRONG = open_tag("strong") + "(" + until(r"/strong\b") + ")"
_PRE = open_tag("pre") + "(" + until(r"/pre\b") + ")"


def bare_pre(html: Column) -> Column:
    """The first preformatted block without its tags, '' when there is none."""
    return once(
        F.regexp_extract(html, _PRE, 1), lambda t: F.when(t.contains("<"), F.regexp_replace(t, TAG, "")).otherwise(t)
    )


def pre_text(bare: Column) -> Column:
    """Text of a ``bare_pre``. Most have neither entities nor carriage returns and are their text."""
    text = F.replace(unescape_markup(bare), F.lit("\r\n"), F.lit("\n"))
    return F.when(bare.contains("&") | bare.contains("\r"), text).otherwise(bare)


@cache
def _stages() -> tuple[dict[str, Column], ...]:
    """Columns step by step. Each step is a column of its own, so that a page goes through
    it once; a column object serves any number of plans."""
    page, kind, pre = F.col("_html"), F.col("_kind"), F.col("_pre")
    strong = F.array_join(F.regexp_extract_all(page, F.lit(_STRONG), F.lit(1)), "<p>\x00<p>")
    # A tag stands in the page as it landed, unless what is hidden there cuts it in two or a letter is a number there.
    low, hides = F.col("_low"), F.col("_hides")
    changes = hides | low.contains("&#")
    by_markup = (
        F.when((low.contains("<strong") | changes) & F.lower(joined_text(strong)).contains(NO_EVENTS), "empty")
        # A class is looked for as it is written, so pages without the word need no search for the tag.
        .when(page.contains("grid") & page.rlike(MODERN_EVENT), "modern")
        .when(
            page.contains(REPORT_DAY_CLASS)
            & inside(F.regexp_extract(page, _FROM_REPORT_DAY, 1), "div").rlike(_GRID_BORDER),
            "modern",
        )
        .when((low.contains("<a") | changes) & page.rlike(LEGACY_EVENT), "legacy")
    )
    by_text = (
        F.when(F.substring(pre, 1, NUMBER_WITHIN).rlike(NUMBER_LABEL), "plaintext")
        .when(F.length(strip(pre)) < SHORT_PRE, "empty")
        .when(F.length(joined_text(page)) < SHORT_PAGE, "empty")
        .otherwise("unknown")
    )
    return (
        {"_low": F.lower("html")},
        {"_hides": may_hide(low)},
        {"_short": F.when(F.col("_hides"), without_hidden(F.col("html"))).otherwise(F.col("html"))},
        {"_visible": plain_markup(F.col("html"), F.col("_short"), F.col("_hides"))},
        {"_html": decode_entities(F.col("_visible"))},
        {"_kind": by_markup},
        {"_bare": F.when(kind.isNull() & page.rlike(open_tag("pre")), bare_pre(page))},
        {"_pre": pre_text(F.col("_bare"))},
        {"html_format": F.when(kind.isNotNull(), kind).otherwise(by_text)},
    )


def with_layout(pages: DataFrame) -> DataFrame:
    """Add ``_html`` (prepared), ``_pre`` (text of the first preformatted block, only where
    the earlier rules leave the layout open) and ``html_format``."""
    for columns in _stages():
        pages = pages.withColumns(columns)
    return pages.drop("_short", "_visible", "_low", "_hides", "_kind", "_bare")


def detect_format(pages: DataFrame) -> DataFrame:
    """Add ``html_format``: modern / legacy / plaintext / empty / unknown."""
    return with_layout(pages).drop("_html", "_pre")
