"""Text clean-up as native column expressions.

Java and Python disagree on what a blank is, so the blanks are spelled out once and
used both as a trim set and as a regular-expression class.
"""

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in text.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# As a class: the visible ASCII characters are ruled out by one range before the list is
# looked at, which matters since nearly every character tested is one of them.
_LATIN_BLANKS = "".join(c for c in BLANKS if c < "\u0100")
_OTHER_BLANKS = "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _blank_class(without: str = "") -> str:
    latin = "".join(c for c in _LATIN_BLANKS if c not in without)
    return f"[[^!-~]&&[{latin}{_OTHER_BLANKS}]]"


WS = _blank_class()
# White space that does not end a line, and classes without the plain space.
HWS = _blank_class(without="\n")


# The others in two classes, as Java looks faster for characters below 256.
_ODD_LATIN, _ODD_LATIN_IN_LINE = (f"[{''.join(c for c in _LATIN_BLANKS if c not in left)}]" for left in (" ", " \n"))
_ODD_WIDE = f"[{_OTHER_BLANKS}]"
#: Signs that a text may hold such. Control character 2 is a separator of this library.
_NOT_PLAIN, _NOT_PLAIN_LINES, _MAY_BE_WIDE = r"[^\x02 -~]", r"[^\n\x02 -~]", "[\u1680-\u3000]"

# A tag opens with a letter, "/", "!" or "?"; a lone "<" in running text is no tag.
TAG = r"</?[A-Za-z!?][^>]*+>"

_MARKUP_CHARS = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}
_ENTITY = r"&(?!(?:lt|gt|quot|amp);)(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,31};)"
_FOREIGN_ENTITY = r"&(?!(?:lt|gt|quot|amp);)(?:#[0-9xX]|[A-Za-z][A-Za-z0-9]{1,31};)"


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed one time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends. Spaces go first, which is quicker than a search in a set."""
    return F.trim(F.trim(text), F.lit(BLANKS))


def _spaces(text: Column, not_plain: str, odd_latin: str) -> Column:
    """Every blank as a space; plain texts, as most are, are only looked through."""

    def replaced(t: Column) -> Column:
        latin = F.regexp_replace(t, odd_latin, " ")
        return F.when(t.rlike(_MAY_BE_WIDE), F.regexp_replace(latin, _ODD_WIDE, " ")).otherwise(latin)

    return once(text, lambda t: F.when(t.rlike(not_plain), replaced(t)).otherwise(t))


def spaces_in_lines(text: Column) -> Column:
    """Every blank as a space; line ends stay."""
    return _spaces(text, _NOT_PLAIN_LINES, _ODD_LATIN_IN_LINE)


def _squeezed(spaced: Column) -> Column:
    return once(spaced, lambda t: F.when(t.contains("  "), F.regexp_replace(t, " {2,}+", " ")).otherwise(t))


def normalize_whitespace(text: Column) -> Column:
    """Turn every run of white space, non-breaking included, into one space."""
    return F.trim(_squeezed(_spaces(text, _NOT_PLAIN, _ODD_LATIN)))


def single_spaces(text: Column) -> Column:
    """Every run of blanks inside a line to one space; line ends stay."""
    return _squeezed(spaces_in_lines(text))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def safe_int(text: Column) -> Column:
    """Whole number or NULL; never an error."""
    return strip(text).try_cast("int")


def field_value(text: Column, label: str) -> Column:
    """Text after the first ``label:``, any case, up to where blanks, words and a colon follow; '' when absent."""
    at = F.instr(F.lower(text), label.lower() + ":")
    after = strip(F.substr(text, at + len(label) + 1))
    value = F.split(after, rf"{WS}++(?=(?U)\w(?:\w|{WS})*+:)", 2)[0]
    return F.when(at > 0, strip(value)).when(at == 0, "")


def split_first_colon(line: Column) -> tuple[Column, Column]:
    """(before, after) the first colon; after is '' when the line has none."""
    parts = F.split(line, ":", 2)
    return parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def _named_entities() -> Column:
    """Map from entity name to character, built from the standard library's list."""
    names = {name: chr(point) for name, point in name2codepoint.items()}
    names["apos"] = "'"
    for entity in _MARKUP_CHARS:
        names[entity.strip("&;")] = entity
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _character(point: Column) -> Column:
    """Code point to character; markup characters come back as named entities."""
    valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    encoded = F.unhex(F.lpad(F.hex(point), 8, "0"))
    result = F.when(valid, F.decode(encoded, "UTF-32")).otherwise(F.lit("\ufffd"))
    for entity, char in _MARKUP_CHARS.items():
        result = F.when(point == ord(char), F.lit(entity)).otherwise(result)
    return result


def _decode_one(entity: Column) -> Column:
    digits = F.rtrim(F.substring(entity, 3, 8), F.lit(";"))
    hexadecimal = F.conv(F.substring(digits, 2, 7), 16, 10).try_cast("int")
    name = F.rtrim(F.substring(entity, 2, 40), F.lit(";"))
    return (
        F.when(entity.rlike("^&#[xX]"), _character(hexadecimal))
        .when(entity.startswith("&#"), _character(digits.try_cast("int")))
        .otherwise(F.coalesce(F.try_element_at(_named_entities(), name), entity))
    )


def decode_entities(text: Column) -> Column:
    """Decode every character reference except the four that would look like markup.

    ``&lt; &gt; &quot; &amp;`` stay until the tags are gone, see ``unescape_markup``.
    One pass per distinct reference, longest first so that none is cut by a shorter one.
    """
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)))
    longest_first = F.reverse(F.array_sort(F.transform(found, lambda e: F.struct(F.length(e).alias("n"), e.alias("e")))))
    decoded = F.aggregate(
        F.transform(longest_first, lambda pair: pair["e"]),
        text,
        lambda done, e: F.replace(done, e, _decode_one(e)),
    )
    return F.when(text.contains("&") & text.rlike(_FOREIGN_ENTITY), decoded).otherwise(text)


def unescape_markup(text: Column) -> Column:
    """Last decoding step, after tags are removed. The ampersand goes last. Most texts have none."""

    def decoded(text: Column) -> Column:
        for entity, char in _MARKUP_CHARS.items():
            text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    return once(text, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))


#: A tag's inside: attribute values may hold angle brackets where they are quoted.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_HIDDEN = r"(?s)<(?:!--.*?(?:-->|\z)|((?i:script|style))\b[^<>]*+>.*?(?:</(?i:\1)\s*+>|\z))"
#: Every character of a page belongs to one token, and a token is found without looking back or looking
#: twice: comment, script or style; tag, which reaches to the end when it is never ended; text.
_TOKEN = (
    rf"(?s)<!--.*?(?:-->|\z)|<((?i:script|style))\b{_INSIDE}>.*?(?:</(?i:\1)\s*+>|\z)"
    rf"|</?[A-Za-z]{_INSIDE}(?:>|\z)|<[!?][^>]*+(?:>|\z)|[^<]++|<"
)
#: Signs that the short way may go wrong: angle brackets in a quoted value, a tag never ended. The second is looked
#: for behind the last "<" alone.
_ODD_VALUE = r"""=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""
_NEVER_ENDED = r"^[A-Za-z/!?][^>]*+\z"
_HIDDEN_IN_VALUE = r"""=\s*+["'][^"'<>]*+<(?:!--|(?i:script|style)\b)"""


def may_hide(low: Column) -> Column:
    """No comment, script or style begins where this is false for ``low``, the page in lower case. Words are found
    several times as fast as patterns."""
    return low.contains("<!--") | low.contains("<script") | low.contains("<style")


def without_hidden(html: Column) -> Column:
    """Drop comments, scripts and styles of a page whose tags are plain; one never closed reaches to the end."""
    return F.regexp_replace(html, _HIDDEN, "")


def _plain_token(token: Column) -> Column:
    """A hidden token vanishes, a whole tag keeps no angle brackets inside, a tag that is never ended is text."""
    inner = F.substr(token, F.lit(2), F.length(token) - 2)
    escaped = F.replace(F.replace(inner, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return (
        F.when(token.rlike(r"^<(?:!--|(?i:script|style)\b)"), "")
        .when(token.rlike(r"^</?[A-Za-z!?]") & token.endswith(">"), F.concat(F.lit("<"), escaped, F.lit(">")))
        .when(token.rlike(r"^</?[A-Za-z!?]"), F.replace(token, F.lit("<"), F.lit("&lt;")))
        .otherwise(token)
    )


def plain_markup(html: Column, short: Column, hides: Column) -> Column:
    """``short``, which is ``without_hidden(html)``, or the page put together from its tokens where that may
    differ. ``hides`` says whether ``html`` may hide anything. After this a tag is what lies between two angle brackets, on any page, so that what
    follows can look for tags by simple patterns."""
    tokens = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    never_ended = short.contains("<") & F.substring_index(short, "<", -1).rlike(_NEVER_ENDED)
    odd_value = short.contains("=") & short.rlike(_ODD_VALUE)
    odd = never_ended | odd_value | (hides & html.rlike(_HIDDEN_IN_VALUE))
    shown = F.when(odd, F.array_join(F.transform(tokens, _plain_token), "")).otherwise(short)
    blank = F.lit("&nbsp;")
    return once(shown, lambda s: F.when(s.contains(blank), F.replace(s, blank, F.lit("\xa0"))).otherwise(s))


def visible_markup(html: Column) -> Column:
    """Drop comments, scripts and styles; one never closed reaches to the end. Make
    non-breaking blanks real."""
    return once(without_hidden(html), lambda short: plain_markup(html, short, F.lit(True)))


def prepare_html(html: Column) -> Column:
    """``visible_markup`` with the entities decoded that cannot be markup. In a plan give
    the two steps a column each, so that the first is not run again for every use."""
    return decode_entities(visible_markup(html))


def spaced_text(html: Column, separator: str) -> Column:
    """Text of a prepared fragment with ``separator`` where a tag stood."""
    return unescape_markup(F.regexp_replace(html, TAG, separator))


def joined_text(html: Column) -> Column:
    """Text of a prepared fragment, every piece stripped, pieces put together."""
    tag_and_blanks = f"{TAG}{WS}*+|{WS}(?<!{WS}{WS}){WS}*+{TAG}{WS}*+"
    return unescape_markup(strip(F.regexp_replace(html, tag_and_blanks, "")))


def visible_text(html: Column) -> Column:
    """Visible text of a raw page."""
    return joined_text(prepare_html(html))


def clean_lines(html: Column) -> Column:
    """Line breaks from ``<br>``, each line stripped, blank lines at both ends dropped."""
    broken = F.regexp_replace(html, r"<(?i:br)\b[^>]*+>", "\n")
    text = spaced_text(broken, "")
    blanks_at_line_end = f"\n{HWS}++|{HWS}(?<!{HWS}{HWS}){HWS}*+\n{HWS}*+"
    return strip(F.regexp_replace(text, blanks_at_line_end, "\n"))
