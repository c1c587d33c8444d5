"""Modern layout: one grid container per event, then siblings up to the next one."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.dates import long_date
from dayledger.functions.markup import (
    attribute_starts,
    close_tag,
    cut_before,
    element,
    has_class,
    inside,
    levelled,
    levelled_tables,
    once,
    open_tag,
    tables,
    tag_pieces,
    until,
)
from dayledger.functions.text import TAG, joined_text, spaced_text, unescape_markup
from dayledger.operators.classify import EVENT_PREFIX, MODERN_EVENT
from dayledger.operators.pieces import (
    KNOWN_LABELS,
    SEP,
    labels_of,
    tidy_lines,
    values_of,
    written_labels,
)

# The tags, classes and titles of this layout.
_H1 = open_tag("h1") + "(" + until(r"/h1\b") + ")"
_NEXT_EVENT = "^" + open_tag("div", has_class("grid"), attribute_starts("id", EVENT_PREFIX))
_GRID = "^" + open_tag("div", has_class("grid"))
_FIRST_HEADING = open_tag("div", has_class("th")) + "(" + until(r"/?div\b") + ")"
_HEADING = open_tag("div", has_class("th")) + until(r"/?div\b") + close_tag("div")
_HEADING_WITH_BLOCKS = open_tag("div", has_class("th")) + until(r"/?div\b") + r"<(?i:div)\b"
_LEVELLED_HEADING = (
    r"<(?i:div)_([1-9]\d*+)\b" + has_class("th") + "[^>]*+>" + until(r"/div_\1\b") + r"</(?i:div)_\1\s*+>"
)
_BORDER = "^" + open_tag("div", has_class("border"))
_CITATION_TITLE = "10 CFR Section"
_PERSON_TITLES = ("Person (Organization):", "Person(Organization):")


def cuts(page: Column) -> Column:
    """The page cut in front of each container; the first piece is no event."""
    return cut_before(page, MODERN_EVENT)


def report_date(page: Column) -> Column:
    """Date in the first ``<h1>``, NULL without one."""
    return long_date(joined_text(F.regexp_extract(page, _H1, 1)))


def event_ref(fragment: Column) -> Column:
    return F.regexp_extract(fragment, r"""^[^>]*\s(?i:id)\s*+=\s*+["']?([^"'\s>]*)""", 1)


def head(fragment: Column) -> Column:
    """The container; '' when it is never closed."""
    return element(fragment, "div")


def siblings(after_container: Column) -> Column:
    """Places among the siblings of the container, which end at the next event or the close
    of the parent: the inside of the first border block from ``start`` to before ``stop``, and
    where the search for the unit ``table`` starts. 0 where there is none, -1 for a table
    looked for no more; places count from 1."""

    def step(acc: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"^<(?i:div)\b"), piece.rlike(r"^</(?i:div)\b")
        top = acc["depth"] == 1
        ends = acc["ends"] | (top & (closes | piece.rlike(_NEXT_EVENT)))
        grid = top & piece.rlike(_GRID)
        begins = (acc["start"] == 0) & top & ~grid & piece.rlike(_BORDER)
        inner = F.length(F.regexp_extract(piece, "^" + open_tag("div"), 0))
        finishes = (acc["start"] > 0) & (acc["stop"] == 0) & closes & (acc["depth"] == 2)
        level = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        table = (acc["table"] == 0) & (level == 1) & piece.rlike(open_tag("table"))
        moved = {
            "depth": level,
            "pos": acc["pos"] + F.length(piece),
            "start": F.when(begins, acc["pos"] + inner + 1).otherwise(acc["start"]),
            "stop": F.when(finishes, acc["pos"] + 1).otherwise(acc["stop"]),
            "table": F.when(table, acc["pos"] + 1)
            .when((acc["table"] == 0) & grid, -1)
            .otherwise(acc["table"]),
        }
        kept = [F.when(ends, acc[name]).otherwise(value).alias(name) for name, value in moved.items()]
        return F.struct(*kept, ends.alias("ends"))

    zero = {"depth": 1, "pos": 0, "start": 0, "stop": 0, "table": 0, "ends": False}
    start = F.struct(*(F.lit(value).alias(name) for name, value in zero.items()))
    return F.aggregate(tag_pieces(after_container, "div"), start, step)


def category_text(container: Column) -> Column:
    return joined_text(F.regexp_extract(container, _FIRST_HEADING, 1))


def pair_text(html: Column) -> Column:
    """A bold label starts a line, its end is the separator; a value ends at the next
    label, line break or block end."""
    with_blocks = F.regexp_replace(levelled(html, "div", "div"), _LEVELLED_HEADING, "")
    unmarked = F.regexp_replace(with_blocks, r"<(/?)((?i:div))_\d++", "<$1$2")
    fields = F.when(html.rlike(_HEADING_WITH_BLOCKS), unmarked).otherwise(F.regexp_replace(html, _HEADING, ""))
    one_line = F.replace(F.replace(fields, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    lines = F.regexp_replace(one_line, r"<(?i:b|br|/div|/p|/td|/li)\b[^>]*+>", "\n")
    parted = F.regexp_replace(lines, close_tag("b"), SEP)
    tidy = tidy_lines(unescape_markup(F.regexp_replace(parted, TAG, " ")))
    return F.regexp_replace(tidy, f" ?:{{1,2}}+{SEP}", SEP)


def filled_pairs(container: Column) -> Column:
    """Slow form of the pairs, for containers where a label stands twice: inside one block
    a label counts at its last place only, even if that one is blank; between blocks the
    later filled one counts."""

    def block_pairs(lines: Column) -> Column:
        labels = labels_of(lines)
        found = F.arrays_zip(labels.alias("label"), values_of(lines).alias("value"))
        return F.filter(
            found,
            lambda p, i: (p["value"] != "")
            & ~F.array_contains(F.slice(labels, i + 2, 1_000_000_000), p["label"]),
        )

    blocks = F.split(container, r"(?=<(?i:div)\b)")
    return F.flatten(F.transform(F.transform(blocks, pair_text), block_pairs))


def warnings(text: Column, labels: Column) -> Column:
    """A line for each filled label that no column takes."""
    known = F.array(*[F.lit(x) for x in (*KNOWN_LABELS, "")])
    pairs = F.arrays_zip(written_labels(text).alias("label"), values_of(text).alias("value"))
    odd = F.filter(
        pairs, lambda p: (p["value"] != "") & ~F.array_contains(known, F.lower(p["label"]))
    )
    lines = F.transform(
        odd,
        lambda p: F.concat(
            F.lit("Unexpected field: '"), p["label"], F.lit("' = '"), p["value"], F.lit("'")
        ),
    )
    return F.when(F.size(F.array_except(labels, known)) > 0, lines)


def _after(container: Column, *titles: str) -> Column:
    """HTML after the last of ``titles``, up to the end of its field block: the child of the
    container, however deep the title stands in it; '' without a title."""

    def behind(title: str) -> Column:
        after = F.substring_index(container, title, -1)
        place = F.struct(F.length(after).alias("n"), after.alias("after"), F.lit(len(title)).alias("title"))
        return F.when(container.contains(title), place)

    def block(last: Column) -> Column:
        before = F.substr(container, F.lit(1), F.length(container) - last["n"] - last["title"])
        opened = F.regexp_count(before, F.lit(r"<(?i:div)\b"))
        closed = F.regexp_count(before, F.lit(r"</(?i:div)\b"))
        return inside(last["after"], "div", F.greatest(opened - closed - 1, F.lit(1)))

    last = F.array_min(F.array_compact(F.array(*[behind(title) for title in titles])))
    return F.when(container.isNotNull(), F.coalesce(once(last, block), F.lit("")))


def citation_text(container: Column) -> Column:
    """Text after the last section label, up to the end of its block."""
    return spaced_text(_after(container, _CITATION_TITLE), " ")


def person_text(container: Column) -> Column:
    return spaced_text(_after(container, *_PERSON_TITLES), "\n")


def text_html(after_container: Column, places: Column) -> Column:
    """Inside of the first border block; one never closed reaches to the last sibling."""
    stop = F.when(places["stop"] > 0, places["stop"]).otherwise(places["pos"] + 1)
    inner = F.substr(after_container, places["start"], stop - places["start"])
    return F.when(places["start"] > 0, inner).otherwise("")


def unit_table(after_container: Column, places: Column) -> Column:
    """First table among the siblings, none inside other blocks; levelled."""
    html = F.when(places["table"] > 0, F.substr(after_container, places["table"]))
    return F.coalesce(F.get(tables(levelled_tables(html)), F.lit(0)), F.lit(""))
