"""Pages to events: routing by layout, segmentation, field extraction.

A CASE on ``html_format`` picks the expressions of the page's own layout. So pages are
scanned once, not once per layout, and nothing is shuffled. Every intermediate that is
used more than once is a column, because inside a CASE branch the optimizer does not
share common expressions.
"""

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.category import category_of_heading, plain_heading
from dayledger.functions.lists import citations_in_lines, empty_list, persons, unit_statuses
from dayledger.functions.markup import levelled_body_rows, without_first
from dayledger.functions.text import clean_lines, normalize_whitespace
from dayledger.operators import legacy, modern, plaintext
from dayledger.operators.classify import with_layout
from dayledger.operators.pieces import field_columns, labels_of, values_of
from dayledger.schemas import EVENT, EVENT_COLUMNS, UNIT_STATUS

NO_NUMBER = "no event number"
NO_TABLE = "no header table"
NO_ROWS = "header table has no rows"


def _by_layout(if_modern=None, if_legacy=None, if_plaintext=None) -> Column:
    """CASE on the layout; only the branch of the row's own layout is evaluated."""
    branches = {"modern": if_modern, "legacy": if_legacy, "plaintext": if_plaintext}
    chain = F
    for name, value in branches.items():
        if value is not None:
            chain = chain.when(F.col("html_format") == name, value)
    return chain


@cache
def _page_columns() -> tuple[Column, Column]:
    """Report date and pieces of a page."""
    page, pre = F.col("_html"), F.col("_pre")
    return (
        _by_layout(modern.report_date(page), None, plaintext.report_date(pre)).alias("report_date"),
        _by_layout(modern.cuts(page), legacy.cuts(page), plaintext.cuts(pre)).alias("_cuts"),
    )


def segment(pages: DataFrame) -> DataFrame:
    """One row per event fragment; a page without any keeps one row with NULLs.

    Input: ``url``, ``year``, ``html``. Other input columns are carried along.
    """
    replaced = ("url", "html", "report_date", "html_format")
    carried = [c for c in pages.columns if c not in replaced]
    routed = with_layout(pages.select(F.col("url").alias("page_url"), *carried, "html"))
    cut = routed.select("page_url", *carried, "html_format", *_page_columns())
    return cut.select(
        "page_url",
        *carried,
        "html_format",
        "report_date",
        F.posexplode_outer(without_first(F.col("_cuts"))).alias("event_pos", "fragment"),
    )


@cache
def _stages() -> tuple[dict[str, Column], ...]:
    """Intermediate columns of a fragment, step by step."""
    c = F.col
    is_modern, is_legacy = c("html_format") == "modern", c("html_format") == "legacy"
    fragment, head, rows, pair_text = c("fragment"), c("_head"), c("_rows"), c("_pair_text")
    after_head = F.substr(fragment, F.length(head) + 1)
    labels = c("_all_labels")
    return (
        {
            "_found": _by_layout(
                modern.head(fragment), legacy.head(fragment), plaintext.head(fragment)
            ),
            "event_ref": _by_layout(
                modern.event_ref(fragment), legacy.event_ref(fragment), plaintext.event_ref(fragment)
            ),
        },
        # A modern container that is never closed reaches to the end of its fragment.
        {
            "_head": F.when(is_modern & (c("_found") == ""), fragment).otherwise(c("_found")),
            "event_number": F.regexp_extract("event_ref", r"\d+", 0).try_cast("bigint"),
        },
        {
            "_tail": after_head,
            "_rows": _by_layout(None, legacy.rows(head)),
        },
        {
            "_siblings": F.when(is_modern, modern.siblings(c("_tail"))),
            "_second": F.when(is_legacy, legacy.cells(rows, 1)),
            "_third": F.when(is_legacy, legacy.cells(rows, 2)),
            "_heading": plain_heading(
                _by_layout(
                    modern.category_text(head),
                    legacy.category_text(rows),
                    plaintext.category_text(fragment),
                )
            ),
            "error": F.when(fragment.isNull(), None)
            .when(c("event_number").isNull(), NO_NUMBER)
            .when(is_legacy & (head == ""), NO_TABLE)
            .when(is_legacy & (F.size(rows) == 0), NO_ROWS),
        },
        {
            "category": category_of_heading(c("_heading")),
            "_third_left": F.when(is_legacy, legacy.cell_lines(c("_third"), 0)),
        },
        {
            "_pair_text": _by_layout(
                modern.pair_text(head),
                legacy.pair_text(c("_second"), c("_third_left")),
                plaintext.pair_text(head),
            ),
            "_citation_text": _by_layout(
                normalize_whitespace(modern.citation_text(head)),
                legacy.citation_text(c("_third_left")),
            ),
        },
        {"_all_labels": labels_of(pair_text), "_all_values": values_of(pair_text)},
        # Modern pages: blank values do not count. Without repeats a blank and a missing
        # value give the same columns, only repeated labels need the slow form.
        {
            "_slow": F.when(
                is_modern & (F.size(F.array_distinct(labels)) < F.size(labels)),
                modern.filled_pairs(head),
            )
        },
        {
            "_labels": F.reverse(F.coalesce(F.transform("_slow", lambda p: p["label"]), labels)),
            "_values": F.reverse(
                F.coalesce(F.transform("_slow", lambda p: p["value"]), c("_all_values"))
            ),
        },
    )


@cache
def _outputs() -> tuple[Column, ...]:
    """The event columns out of the intermediate ones."""
    c = F.col
    head, tail = c("_head"), c("_tail")
    in_pre = c("html_format") == "plaintext"
    is_reactor = c("category") == "Power Reactor"
    person_text = _by_layout(modern.person_text(head), legacy.cell_lines(c("_third"), 1))
    text_html = _by_layout(modern.text_html(tail, c("_siblings")), legacy.text_html(tail))
    unit_table = _by_layout(modern.unit_table(tail, c("_siblings")), legacy.unit_table(tail))
    values = field_columns(c("_labels"), c("_values"))
    values["event_text"] = F.when(in_pre, plaintext.event_text(tail)).otherwise(
        clean_lines(text_html)
    )
    lists = {
        "cfr_sections": F.when(in_pre, plaintext.cfr_sections(head)).otherwise(
            citations_in_lines(c("_citation_text"))
        ),
        "persons_notified": F.when(in_pre, plaintext.persons_notified(head)).otherwise(
            persons(person_text)
        ),
        "reactor_units": F.when(in_pre, plaintext.reactor_units(head))
        .when(is_reactor, unit_statuses(levelled_body_rows(unit_table)))
        .otherwise(empty_list(UNIT_STATUS)),
        "parse_warnings": _by_layout(modern.warnings(c("_pair_text"), c("_labels"))),
    }
    for name, value in lists.items():
        values[name] = F.coalesce(value, F.array().cast(EVENT[name].dataType))
    return tuple(value.alias(name) for name, value in values.items())


def read_fragments(fragments: DataFrame) -> DataFrame:
    """Typed event columns for each fragment, plus ``event_ref`` and ``error``."""
    kept = [name for name in fragments.columns if name != "fragment"]
    for columns in _stages():
        fragments = fragments.withColumns(columns)
    return fragments.select(
        *kept, "event_ref", "event_number", "category", _in_its_place(F.col("error")).alias("error"), *_outputs()
    )


def _in_its_place(value: Column) -> Column:
    """The value, which filters are not moved below. Moved below the stages, a filter on ``error``, or the one that
    exploding a list adds, would hold them all written out, run once more for every use of each."""
    return F.when(F.spark_partition_id() >= 0, value)


def extract_rows(pages: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Everything found on the pages: good events, failed events, and one row for each
    page without events. Write this once and derive all outputs from it."""
    stamp = F.current_timestamp() if scraped_at is None else scraped_at
    return read_fragments(segment(pages)).withColumn("scraped_at", stamp)


def events_of(rows: DataFrame) -> DataFrame:
    """The good events, in the fixed schema plus ``year`` and ``event_pos``."""
    good = rows.where(F.col("event_pos").isNotNull() & F.col("error").isNull())
    return good.select(*EVENT_COLUMNS, "year", "event_pos")


def parse_errors_of(rows: DataFrame) -> DataFrame:
    """The failed events, one line each; they never stop the others."""
    failed = rows.where(F.col("error").isNotNull())
    return failed.select(
        "page_url", "event_ref", F.col("error").alias("message"), F.col("scraped_at").alias("seen_at"), "year"
    )


def extract_events(pages: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    return events_of(extract_rows(pages, scraped_at))
