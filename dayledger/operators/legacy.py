"""Legacy layout: an anchor per event, then a header table with three rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.markup import (
    cut_before,
    element,
    levelled_tables,
    once,
    open_tag,
    row_cells,
    table_rows,
    tables,
    until,
    walk,
)
from dayledger.functions.text import joined_text, spaced_text
from dayledger.operators.classify import LEGACY_EVENT
from dayledger.operators.pieces import (
    DATE_LABELS,
    EMERGENCY_LABEL,
    colons_to_separators,
    tidy_lines,
)

# The tags, titles and table width of this layout.
_TO_TABLE = r"^<(?:[^<]++|<(?i:br\b|/?a\b))*+(?=<(?i:table)\b)"
_CELL = open_tag("t[dh]") + "(" + until(r"/?t[dhr]\b", r"/?table\b") + ")"
_TEXT_HEADING = open_tag("p") + until(r"/?p\b", r"b\b") + open_tag("b") + "[^<]*Event Text"
_TO_TEXT_CELL = _TEXT_HEADING + "(?s:.*?)" + open_tag("table") + until(r"t[dh]\b", r"/table\b")
_TEXT_CELL = _TO_TEXT_CELL + _CELL
_FROM_TEXT_CELL = "(?s)" + _TO_TEXT_CELL + open_tag("t[dh]") + "(.*+)"
_WIDE_TABLE = r"""^[^>]*\s(?i:width)\s*+=\s*+["']?98"""
_STATE_ON_LINE = r"(?m)^([^\S\n]*+(?i:region|city)[^\S\n]*+:[^\n]*?)State:"
_DATE_LINE = r"(?im)^ ?(?:" + "|".join(DATE_LABELS) + r") ?:[^\n]*+"
_EMERGENCY_LINE = rf"(?im)^ ?{EMERGENCY_LABEL}[^:\n]*+:?"
_EMERGENCY_FIELD = rf"(?im)^ ?{EMERGENCY_LABEL} ?:[^\n]*+"


def cuts(page: Column) -> Column:
    return cut_before(page, LEGACY_EVENT)


def event_ref(fragment: Column) -> Column:
    return F.regexp_extract(fragment, r"""^[^>]*\s(?i:name)\s*+=\s*+["']?([^"'\s>]*)""", 1)


def head(fragment: Column) -> Column:
    """Anchor to end of the header table; '' when another element stands between. A table that
    is never closed ends at the text heading, or with the fragment."""
    before = F.regexp_extract(fragment, _TO_TABLE, 0)

    def to_end(at: Column) -> Column:
        rest = F.substr(fragment, at + 1)
        unclosed = F.split(rest, f"(?={_TEXT_HEADING})", 2)[0]
        table = once(element(rest, "table"), lambda t: F.when(t == "", unclosed).otherwise(t))
        return F.when(at > 0, F.concat(F.substr(fragment, F.lit(1), at), table)).otherwise("")

    return once(F.length(before), to_end)


def rows(header: Column) -> Column:
    return table_rows(levelled_tables(header))


def cells(header_rows: Column, nth: int) -> Column:
    return row_cells(F.get(header_rows, F.lit(nth)))


def category_text(header_rows: Column) -> Column:
    return joined_text(F.coalesce(F.get(cells(header_rows, 0), F.lit(0)), F.lit("")))


def cell_lines(row: Column, nth: int) -> Column:
    """Text of a cell, a line end where a tag stood."""
    return tidy_lines(spaced_text(F.coalesce(F.get(row, F.lit(nth)), F.lit("")), "\n"))


def pair_text(second: Column, third_left: Column) -> Column:
    """Fields from the left cell, dates from the right one, then the class line.

    A region or city line may carry the state too; it is broken there first.
    """
    fields = F.regexp_replace(cell_lines(second, 0), _STATE_ON_LINE, "$1\nState:")
    dates = F.regexp_extract_all(cell_lines(second, 1), F.lit(_DATE_LINE), F.lit(0))
    emergency = F.regexp_extract_all(
        F.regexp_replace(third_left, _EMERGENCY_LINE, EMERGENCY_LABEL + ":"),
        F.lit(_EMERGENCY_FIELD),
        F.lit(0),
    )
    others = F.regexp_replace(F.regexp_replace(fields, _DATE_LINE, ""), _EMERGENCY_FIELD, "")
    pairs = colons_to_separators(
        F.concat_ws("\n", others, F.array_join(dates, "\n"), F.array_join(emergency, "\n"))
    )
    return tidy_lines(pairs)


def citation_text(third_left: Column) -> Column:
    """Only lines that start with a code and hold no section label."""
    return F.regexp_replace(third_left, r"(?m)^(?!\d+\.\d+)[^\n]*+$|^[^\n]*10 CFR Section[^\n]*+$", "")


def text_html(after_header: Column) -> Column:
    """First cell of the table after the text heading, with the tables inside it; a cell that
    is never closed ends at the next one."""
    rest = F.regexp_extract(after_header, _FROM_TEXT_CELL, 1)
    unclosed = F.regexp_extract(after_header, _TEXT_CELL, 1)
    return once(
        walk(rest, "t[dh]|table", F.lit(1)),
        lambda w: F.when(w["done"], F.substr(rest, F.lit(1), w["pos"])).otherwise(unclosed),
    )


def unit_table(after_header: Column) -> Column:
    """Table with unit titles or nearly full width, before the text heading; levelled."""
    # The blank in front lets the cut happen at the very start too.
    before_text = F.split(F.concat(F.lit(" "), after_header), f"(?={_TEXT_HEADING})", 2)[0]

    def is_unit_table(table: Column) -> Column:
        first_row = joined_text(F.get(table_rows(table), F.lit(0)))
        return first_row.rlike("(?s)^(?=.*Unit)(?=.*SCRAM)") | table.rlike(_WIDE_TABLE)

    found = F.filter(tables(levelled_tables(before_text)), is_unit_table)
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))
