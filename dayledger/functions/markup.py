"""Regular expressions for pieces of HTML.

There is no document tree. Tags are found by patterns built here. Every loop is
possessive: Java runs such loops without recursion, so a long page cannot exhaust the
stack, and without backtracking, so the time stays linear.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.text import joined_text, once


def _up_to(attribute: str) -> str:
    """From inside a tag to the value of its first ``attribute``; quoted values are stepped over whole."""
    name = rf"\s(?i:{attribute})\s*+="
    return rf"""(?:(?!{name})(?:=\s*+(?:"[^"<>]*+"|'[^'<>]*+')|[^<>]))*+{name}\s*+"""


def has_class(*names: str) -> str:
    """Lookaheads for class tokens, in any order, quoted either way or not at all."""
    value = r"""(?:"[^"<>]*?|'[^'<>]*?|)"""
    return "".join(rf"(?={_up_to('class')}{value}(?<![\w-]){n}(?![\w-]))" for n in names)


def attribute_starts(attribute: str, value: str) -> str:
    return rf"""(?={_up_to(attribute)}["']?{value})"""


def open_tag(name: str, *conditions: str) -> str:
    return rf"<(?i:{name})\b{''.join(conditions)}[^>]*+>"


def close_tag(name: str) -> str:
    return rf"</(?i:{name})\s*+>"


def until(*stops: str) -> str:
    """Everything up to a tag whose inside starts like one of ``stops``, or the end."""
    return rf"[^<]*+(?:<(?!(?i:{'|'.join(stops)}))[^<]*+)*+"


def walk(html: Column, name: str, depth: Column) -> Column:
    """(pos, done): characters before the close of ``name`` that leaves no element open, out
    of ``depth`` open ones at the start. Nesting may be as deep as it likes; without such a
    close ``pos`` is the whole length and ``done`` false."""

    # With a line end in front every piece but the first starts with a tag of the name, and the first with none.
    def step(acc: Column, piece: Column) -> Column:
        closes = piece.startswith("</")
        at = acc["depth"] + F.when(closes, -1).when(piece.startswith("<"), 1).otherwise(0)
        done = acc["done"] | (closes & (at <= 0))
        return F.struct(
            at.alias("depth"),
            (acc["pos"] + F.when(done, 0).otherwise(F.length(piece))).alias("pos"),
            done.alias("done"),
        )

    start = F.struct(depth.cast("int").alias("depth"), F.lit(-1).alias("pos"), F.lit(False).alias("done"))
    return F.aggregate(tag_pieces(F.concat(F.lit("\n"), html), name), start, step)


def tag_pieces(html: Column, name: str) -> Column:
    """The text cut in front of every opening and closing tag of ``name``."""
    return F.split(html, f"(?=</?(?i:{name})\\b)")


def cut_before(html: Column, tag: str) -> Column:
    """The text cut in front of every ``tag``, a pattern for a whole tag; the first piece starts with none. The cuts take
    the opening brackets, which are put back: a search for one character is quicker than a look ahead from each."""
    pieces = F.split(html, f"<(?={tag.removeprefix('<')})")
    return F.transform(pieces, lambda piece, i: F.when(i > 0, F.concat(F.lit("<"), piece)).otherwise(piece))


def inside(html: Column, name: str, depth: Column | None = None) -> Column:
    """Content up to the close that ends ``depth`` open elements, one unless given."""
    depth = F.lit(1) if depth is None else depth
    walked = once(walk(html, name, depth), lambda w: F.substr(html, F.lit(1), w["pos"]))
    # Up to the first close; it is the one that is looked for when nothing is opened before it.
    first = F.regexp_extract(html, "^" + until(rf"/{name}\b"), 0)
    return once(first, lambda t: F.when((depth == 1) & ~t.rlike(f"<(?i:{name})\\b"), t).otherwise(walked))


def element(html: Column, name: str) -> Column:
    """The element that the text starts with, close tag included; '' when never closed."""

    def whole(w: Column) -> Column:
        last = F.regexp_extract(F.substr(html, w["pos"] + 1), f"^{close_tag(name)}", 0)
        return F.when(w["done"], F.concat(F.substr(html, F.lit(1), w["pos"]), last)).otherwise("")

    # Elements that are closed and hold none of the name, or only such, are found by one pattern.
    tag, text, close = rf"<(?i:{name})\b[^<>]*+>", until(rf"/?{name}\b"), close_tag(name)
    shallow = F.regexp_extract(html, f"^{tag}{text}(?:{tag}{text}{close}{text})*+{close}", 0)
    return once(shallow, lambda e: F.when(e == "", once(walk(html, name, F.lit(0)), whole)).otherwise(e))


#: Deepest nesting that is told apart; the parsers that pages are made for stop there too.
DEEPEST = 256
_TABLE_TAGS = "table|tr|td|th"


def levelled(html: Column, outer: str, names: str) -> Column:
    """Tags ``names`` with the level of the ``outer`` element around them in their name, as in ``<tr_2>``.

    The innermost elements are level 1, those that hold only such ones 2, and so on; what belongs to an
    element that is never closed is level 0. With its level a tag is told from those of the elements inside, so a
    row is what lies between two row tags of one level. Each level is one pass over the text.
    """
    innermost = open_tag(outer) + until(rf"/?{outer}\b") + close_tag(outer)
    tag = rf"<(/?)(?i:({names}))\b"

    def mark(text: Column, level: Column) -> Column:
        return F.regexp_replace(text, F.lit(tag), F.concat(F.lit("<$1$2_"), level.cast("string")))

    def one_level(text: Column, level: Column) -> Column:
        inside_ = F.regexp_extract_all(text, F.lit(innermost), F.lit(0))
        between = F.split(text, innermost)
        parts = F.arrays_zip(between.alias("between"), inside_.alias("inside"))
        marked = F.transform(
            parts, lambda p: F.concat(p["between"], F.coalesce(mark(p["inside"], level), F.lit("")))
        )
        return F.when(text.rlike(innermost), F.array_join(marked, "")).otherwise(text)

    count = F.least(F.regexp_count(html, F.lit(rf"</(?i:{outer})\b")), F.lit(DEEPEST))
    levels = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return mark(F.aggregate(levels, html, one_level), F.lit(0))


def levelled_tables(html: Column) -> Column:
    """``levelled`` for tables, rows and cells."""
    nested = open_tag("table") + until(r"/?table\b") + r"<(?i:table)\b"
    unclosed = open_tag("table") + until(r"/?table\b") + r"\z"
    plain = F.regexp_replace(html, rf"<(/?)(?i:({_TABLE_TAGS}))\b", "<$1$2_1")
    return F.when(html.rlike(f"{nested}|{unclosed}"), levelled(html, "table", _TABLE_TAGS)).otherwise(plain)


def _from_level(names: str, *stops: str) -> str:
    """A tag of any level and, looked ahead to, what follows up to a stop of the same level: group 2."""
    ends = "|".join(rf"{stop}_\1\b" for stop in stops)
    return rf"<(?i:{names})_(\d++)\b[^>]*+>(?=({until(ends)}))"


_ROW = _from_level("tr", "/?tr", "/?table")
_CELL = _from_level("t[dh]", "/?t[dhr]", "/?table")
#: A whole table of any level, the outer one first; one that is never closed reaches to the end.
_WHOLE_TABLE = r"<(?i:table)_([1-9]\d*+)\b[^>]*+>" + until(r"/table_\1\b") + r"</(?i:table)_\1\s*+>|<(?i:table)_0\b(?s:.*+)"


def tables(html: Column) -> Column:
    """The tables of levelled HTML that lie in no other, one after the other."""
    return F.regexp_extract_all(html, F.lit(_WHOLE_TABLE), F.lit(0))


def table_rows(table: Column) -> Column:
    """Inner HTML of each row of a levelled table and of those inside it, as they begin."""
    return F.regexp_extract_all(table, F.lit(_ROW), F.lit(2))


def row_cells(row: Column) -> Column:
    """Inner HTML of each cell of a row, of inner tables too, as they begin."""
    return F.regexp_extract_all(row, F.lit(_CELL), F.lit(2))


def cell_texts(html: Column) -> Column:
    """Rows of a table as lists of cell texts; rows without cells are left out."""
    return texts_of_levelled(levelled_tables(html))


def texts_of_levelled(table: Column) -> Column:
    return F.filter(
        F.transform(table_rows(table), lambda row: F.transform(row_cells(row), joined_text)),
        lambda cells: F.size(cells) > 0,
    )


def without_first(items: Column) -> Column:
    """The list without its first item; the length is only an upper bound."""
    return F.slice(items, 2, 1_000_000_000)


def body_rows(html: Column) -> Column:
    """The same without the heading row."""
    return without_first(cell_texts(html))


def levelled_body_rows(table: Column) -> Column:
    return without_first(texts_of_levelled(table))


def anchors_targets(html: Column) -> Column:
    """Target of every link, in order, repeats kept."""
    target = r"""("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    raw = F.regexp_extract_all(html, F.lit(r"<(?i:a)\b" + _up_to("href") + target), F.lit(1))
    return F.transform(raw, lambda t: F.regexp_replace(t, r"""^["']|["']$""", ""))
