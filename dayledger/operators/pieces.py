"""What the three layouts share.

Every layout brings its label/value pairs into one text form: a line per pair, label and
value parted by ``SEP``. From there on all layouts are read alike, by whole-text
expressions that run in generated code instead of a lambda per pair.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.dates import clock_time, clock_zone, us_date
from dayledger.functions.text import blank_to_null, spaces_in_lines

SEP = "\x02"

# Label in lower case and the column it fills.
FIELD_LABELS = {
    "facility": "facility",
    "region": "region",
    "state": "state",
    "unit": "unit",
    "rx type": "rx_type",
    "licensee": "licensee",
    "license #": "license_number",
    "rep org": "rep_org",
    "agreement": "agreement",
    "docket": "docket",
    "county": "county",
    "city": "city",
}
DATE_LABELS = (
    "notification date",
    "notification time",
    "event date",
    "event time",
    "last update date",
)
EMERGENCY_LABEL = "emergency class"
# Read but not kept as fields.
IGNORED_LABELS = (
    "nrc notified by",
    "hq ops officer",
    "person (organization)",
    "person(organization)",
)
KNOWN_LABELS = (*FIELD_LABELS, *DATE_LABELS, EMERGENCY_LABEL, *IGNORED_LABELS)

_LABEL = rf"\n([^\n{SEP}]*+){SEP}"
_VALUE = rf"{SEP}([^\n]*+)"
# Spaces after or before the end of a line or label, and all but the last one of others.
_SPARE_SPACES = rf" (?:(?<=[\n{SEP}] ) *+| *+(?=[\n{SEP}])|(?= )(?: (?= ))*+)"


def tidy_lines(text: Column) -> Column:
    """Single spaces, none around line ends and separators; a line end in front."""
    lines = F.concat(F.lit("\n"), spaces_in_lines(text))
    return F.rtrim(F.regexp_replace(lines, _SPARE_SPACES, ""))


def colons_to_separators(text: Column) -> Column:
    """First colon of each line becomes the separator."""
    return F.regexp_replace(text, r"(?m)^([^:\n]*+):", "$1" + SEP)


def written_labels(pair_text: Column) -> Column:
    """Labels as written, without the colon."""
    return F.regexp_extract_all(pair_text, F.lit(_LABEL), F.lit(1))


def labels_of(pair_text: Column) -> Column:
    return written_labels(F.lower(pair_text))


def values_of(pair_text: Column) -> Column:
    return F.regexp_extract_all(pair_text, F.lit(_VALUE), F.lit(1))


def last_value(labels: Column, values: Column, label: str) -> Column:
    """Value at the last place of ``label``; both lists run from the last pair to the first."""
    return F.get(values, (F.array_position(labels, F.lit(label)) - 1).cast("int"))


def field_columns(labels: Column, values: Column) -> dict[str, Column]:
    """The typed columns that come from labels."""
    value = {label: last_value(labels, values, label) for label in KNOWN_LABELS}
    columns = {name: blank_to_null(value[label]) for label, name in FIELD_LABELS.items()}
    columns |= {
        "notification_date": us_date(value["notification date"]),
        "notification_time": clock_time(value["notification time"]),
        # A time without a zone gives '', only a missing time keeps the default.
        "notification_timezone": F.coalesce(clock_zone(value["notification time"]), F.lit("ET")),
        "event_date": us_date(value["event date"]),
        "event_time": clock_time(value["event time"]),
        "event_timezone": F.coalesce(clock_zone(value["event time"]), F.lit("")),
        "last_update_date": us_date(value["last update date"]),
        "emergency_class": F.coalesce(value[EMERGENCY_LABEL], F.lit("")),
    }
    return columns
