"""Licence recognition by sentences and ordered rules.

Text that may speak of licences is unwrapped (comment marks go, a single line end is a blank)
and cut into sentences, the known notices in each normalised sentence are named by
identifiers, and the sequence of identifiers is read by ordered rules: the first rule that
fits at a place names the licence and uses up its notices. So a notice of three sentences is
one licence, and its first sentence alone another or none. Only functions of DataFrames are
used, in one pass without a shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A text without any of these has no licence sentence. Fixed values.
CUES = ("licen", "copyright", "permission", "redistribut", "warrant", "as is", "public domain", "spdx", "all rights reserved")
#: Identifier, and the pattern of the whole normalised sentence where a line is a sentence: what
#: the SQL reads. Fixed values.
SENTENCES = (
    ("SPDX", r"spdx license identifier [a-z0-9 +]+"),
    ("COPYRIGHT", r"(portions )?copyright( c)?( |$).*"),
    ("RIGHTS", r"all rights reserved"),
    ("APACHE2", r".*licensed under (the )?(terms of the )?apache license( version)? 2( 0)?( .*)?"),
    ("APACHE2_COPY", r"you may obtain a copy of the license at .*apache org licenses license 2 0.*"),
    ("LIMITS", r"see the license for the specific language governing permissions and limitations under the license"),
    ("MIT_NAME", r".*(released|licensed|distributed|available) under (the )?(terms of the )?mit license( .*)?"),
    ("MIT_GRANT", r"permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("MIT_KEEP", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("AS_IS", r".*software is provided (by .* )?as is.*"),
    ("BSD_GRANT", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("BSD_SOURCE", r".*redistributions of source code must retain the above copyright notice.*"),
    ("BSD_BINARY", r".*redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSD_NAMES", r".*neither the name of .* nor the names of .* contributors may be used to endorse.*"),
    ("AGPL3", r".*licensed under (the )?(terms of the )?gnu affero general public license( .*)? (version |v)3.*"),
    ("LGPL", r".*licensed under (the )?(terms of the )?gnu (lesser|library) general public license.*"),
    ("GPL3", r".*licensed under (the )?(terms of the )?gnu general public license( as published .*)? (version |v)3.*"),
    ("GPL2", r".*licensed under (the )?(terms of the )?gnu general public license( as published .*)? (version |v)2.*"),
    ("GPL", r".*(licensed|redistribute it).* under (the )?(terms of the )?gnu general public license.*"),
    ("LATER", r"(either version [23]( of the license)? )?or( at your option)? any later version"),
    ("MPL2", r".*(licensed under|subject to) (the )?(terms of the )?mozilla public license( v(ersion)?)? ?2( 0)?.*"),
    ("CC_NC", r".*licensed under (a |the )?(cc|creative commons) (by nc|attribution noncommercial)( [0-9]( [0-9])?)?.*"),
    ("CC_BY_SA", r".*licensed under (a |the )?(cc|creative commons) (by sa|attribution sharealike)( [0-9]( [0-9])?)?.*"),
    ("CC_BY", r".*licensed under (a |the )?(cc|creative commons) (by|attribution)( [0-9]( [0-9])?)?.*"),
    ("CC0", r".*(cc0 1 0|dedicated to the public domain|released into the public domain).*"),
    ("OTHER", r".*(licensed under|license agreement|subject to the license).*"),
)
#: Licence and the identifiers that say so, in the order in which rules are tried. Fixed values.
RULES = (
    ("Apache-2.0", "APACHE2 APACHE2_COPY AS_IS LIMITS"),
    ("Apache-2.0", "APACHE2 APACHE2_COPY"),
    ("MIT", "MIT_GRANT MIT_KEEP AS_IS"),
    ("BSD-3-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY BSD_NAMES"),
    ("BSD-2-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY"),
    ("GPL-2.0-or-later", "GPL2 LATER"),
    ("GPL-3.0-or-later", "GPL3 LATER"),
    ("Apache-2.0", "APACHE2"),
    ("MIT", "MIT_NAME"),
    ("MIT", "MIT_GRANT"),
    ("AGPL-3.0-only", "AGPL3"),
    ("LGPL", "LGPL"),
    ("GPL-3.0-only", "GPL3"),
    ("GPL-2.0-only", "GPL2"),
    ("GPL", "GPL"),
    ("MPL-2.0", "MPL2"),
    ("CC-BY-NC-4.0", "CC_NC"),
    ("CC-BY-SA-4.0", "CC_BY_SA"),
    ("CC-BY-4.0", "CC_BY"),
    ("CC0-1.0", "CC0"),
    ("SPDX", "SPDX"),
    ("proprietary", "COPYRIGHT RIGHTS"),
    ("unknown", "OTHER"),
)
#: ``RULES`` and what only unwrapped notices say.
ALL_RULES = (("AGPL-3.0-or-later", "AGPL3 LATER"), *RULES)
_UNDER = r"(?:licensed|redistribute)(?: .*)? under (?:the )?(?:terms of )?(?:the )?"
_GNU = r"gnu general public license(?: as published(?:(?! version ).){0,80})?(?: either)? (?:version |v)"
#: Patterns of ``SENTENCES`` that are looked for inside a sentence; the others lose a leading and a closing ``.*``.
_INSIDE = {
    "COPYRIGHT": r"^(?:portions )?copyright(?: c)?(?= |$)",
    "RIGHTS": r"^all rights reserved(?= |$)",
    "APACHE2": r"licensed under (?:the )?(?:terms of the )?apache license(?: version)? 2(?: 0)?(?= |$)",
    "MIT_NAME": r"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit license(?= |$)",
    "AGPL3": _UNDER + r"gnu affero general public license(?:(?! version ).){0,80} (?:version |v)3",
    "LGPL": _UNDER + r"gnu (?:lesser|library) general public license",
    "GPL3": _UNDER + rf"(?:{_GNU}3|(?:version |v)3 of the gnu general public license)",
    "GPL2": _UNDER + rf"(?:{_GNU}2|(?:version |v)2 of the gnu general public license)",
    "GPL": _UNDER + r"gnu general public license",
    "LATER": r"or(?: at your option)? any later version",
}


def _inside(name: str, pattern: str) -> str:
    return _INSIDE.get(name) or pattern.removeprefix(".*").removesuffix(".*").replace("(", "(?:")


NOTICES = tuple((name, _inside(name, pattern)) for name, pattern in SENTENCES)
#: Marks that lead a line of a comment; a line of nothing else is blank.
_MARKS = r"(?m)^[\x20\t]*(?:(?:/\*+|\*+/?|//+!?|#+|--+|;+|%+|>+|<!--|(?:rem|dnl)\b)[\x20\t]*)?"
#: A copyright, a reservation or an SPDX tag starts a sentence at the start of its line; a tag ends with the line.
_OPENS = (
    r"(?i)\n(?=(?:portions )?copyright\b(?! (?:notices?|holders?|owners?|laws?|statements?|and|or|in|is|of|to)\b)"
    r"|all rights reserved|spdx-license-identifier)"
)
_TAG = r"(?im)^(.*spdx-license-identifier:.*)$"
#: An address may stand on a line of its own below the words that lead to it.
_ADDRESS = r"(?i)\bat\s*\n\s*(?=https?://)"
_BREAK = (
    r"(?i)\n\s*\n|[.!?](?:\s|$)|;(?!\s+(?:either\s+)?version\s+[23])(?:\s|$)|(?<!spdx-license-identifier):(?:\s|$)"
)


def unwrapped(text: Column) -> Column:
    """Text whose single line ends are blanks to be: what ends a sentence has an empty line."""
    text = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), _MARKS, "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _ADDRESS, "at "), _OPENS, "\n\n"), _TAG, "$1\n\n")


def sentences(text: Column) -> Column:
    """Normalised sentences: lower case, letters and digits, words parted by one space."""
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}+]+", " "))
    return F.filter(F.transform(F.split(unwrapped(text), _BREAK), plain), lambda s: s != "")


def identifier(sentence: Column, known=NOTICES) -> Column:
    out = None
    for name, pattern in known:
        fits = sentence.rlike(f"^(?:{pattern})$")
        out = F.when(fits, F.lit(name)) if out is None else out.when(fits, F.lit(name))
    return out


def identifiers(sentence: Column, known=NOTICES) -> Column:
    """Identifiers of the notices in a sentence, by place; OTHER only where there is nothing else."""
    pattern = "|".join(f"(?:{p})" for _, p in known)
    found = F.transform(F.regexp_extract_all(sentence, F.lit(pattern), 0), lambda m: identifier(m, known))
    telling = F.filter(found, lambda i: i != "OTHER")
    return F.when(F.size(telling) > 0, telling).otherwise(F.slice(found, 1, 1))


def _speaks(s: Column) -> Column:
    fits = F.lit(False)
    for cue in (*CUES, "any later version"):
        fits = fits | s.contains(cue)
    return fits


def licences(sequence: Column, rules=ALL_RULES) -> Column:
    """Licences of a sequence of identifiers, in order of place.

    The sequence is written as text, each identifier in angle brackets; one regular
    expression with an alternative for each rule, in rule order, reads it from the left.
    """
    told = F.concat_ws("", F.transform(sequence, lambda i: F.concat(F.lit("<"), i, F.lit(">"))))
    written = [("".join(f"<{i}>" for i in ids.split()), licence) for licence, ids in rules]
    pattern = "(" + "|".join(ids for ids, _ in written) + ")"
    table = F.create_map(*(F.lit(x) for pair in written for x in pair))
    return F.transform(F.regexp_extract_all(told, F.lit(pattern), 1), lambda m: F.element_at(table, m))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, sentence_ids and licences, both in order of place.

    Texts without a known sentence, null and empty ones among them, have empty lists. A
    sentence goes on over single line ends and comment marks, up to a stop, colon or blank line;
    what is no notice is skipped, so words between the notices of a licence do no harm. Rows are judged one by one, repeated
    ids and rows too; other columns are not read; no rows give no rows.
    """
    text = F.col(text_col).cast("string")
    low = F.lower(text)
    whole = docs.select(
        F.col(id_col).alias(id_col), F.when(_speaks(low), text).otherwise(F.lit("")).alias("_text")
    )
    ids = F.flatten(F.transform(F.filter(sentences(F.col("_text")), _speaks), lambda s: identifiers(s)))
    told = whole.select(id_col, ids.alias("sentence_ids"))
    return told.select(id_col, "sentence_ids", licences(F.col("sentence_ids")).alias("licences"))
