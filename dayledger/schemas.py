"""Fixed schemas of every table the library reads or writes."""

from pyspark.sql import types as T

CITATION = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("description", T.StringType())]
)

PERSON = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("organization", T.StringType()),
        T.StructField("phone", T.StringType()),
    ]
)

UNIT_STATUS = T.StructType(
    [
        T.StructField("unit", T.IntegerType()),
        T.StructField("scram_code", T.StringType()),
        T.StructField("rx_crit", T.StringType()),
        T.StructField("initial_power", T.IntegerType()),
        T.StructField("initial_rx_mode", T.StringType()),
        T.StructField("current_power", T.IntegerType()),
        T.StructField("current_rx_mode", T.StringType()),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("event_number", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("facility", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("rx_type", T.StringType()),
        T.StructField("licensee", T.StringType()),
        T.StructField("license_number", T.StringType()),
        T.StructField("rep_org", T.StringType()),
        T.StructField("agreement", T.StringType()),
        T.StructField("docket", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("notification_date", T.DateType()),
        T.StructField("notification_time", T.StringType()),
        T.StructField("notification_timezone", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("event_timezone", T.StringType()),
        T.StructField("last_update_date", T.DateType()),
        T.StructField("emergency_class", T.StringType()),
        T.StructField("cfr_sections", T.ArrayType(CITATION)),
        T.StructField("persons_notified", T.ArrayType(PERSON)),
        T.StructField("event_text", T.StringType()),
        T.StructField("reactor_units", T.ArrayType(UNIT_STATUS)),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("html_format", T.StringType()),
        T.StructField("parse_warnings", T.ArrayType(T.StringType())),
    ]
)

EVENT_COLUMNS = EVENT.fieldNames()

PAGES_RAW = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("html", T.StringType()),
        T.StructField("html_sha256", T.StringType()),
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
    ]
)

PAGE_STATUS = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("html_format", T.StringType()),
        T.StructField("html_sha256", T.StringType()),
        T.StructField("event_count", T.IntegerType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
    ]
)

EVENT_INDEX = T.StructType(
    [
        T.StructField("event_number", T.LongType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
    ]
)

PARSE_ERRORS = T.StructType(
    [
        T.StructField("page_url", T.StringType()),
        T.StructField("event_ref", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("seen_at", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_type", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("pages_discovered", T.LongType()),
        T.StructField("pages_fetched", T.LongType()),
        T.StructField("pages_parsed", T.LongType()),
        T.StructField("events_found", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

EVENT_BITMAPS = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("year", T.IntegerType()),
    ]
)

BATCH = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("phase", T.StringType()),
    ]
)

# Batches that a compaction holds the rows of.
COVERED = T.StructType([T.StructField(f"of_{f.name}", f.dataType) for f in BATCH.fields])

# The closed list of event categories.
CATEGORIES = (
    "Power Reactor",
    "Material",
    "Fuel Cycle",
    "Agreement State",
    "General Information or Other",
    "Unknown",
)

# Life of a page.
STATUSES = ("pending", "fetched", "parsed", "error")
