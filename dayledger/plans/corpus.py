"""Report pages made from the star-schema tables.

The given tables hold no report pages, so each order is written out as one event of a
report page, in the layout of its year. A page holds the orders of one day out of a
block of consecutive order keys: the number of pages grows with the data while the size
of a page is bounded by the block, however the days are spread.

Nested lists come from line items summed up per (order, slot) first. There are eight
slots, so no order collects more than eight rows.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.session import PAGE_CODEC, fresh_path

BLOCK = 16_384
SLOTS = 8
HOST = "https://reports.example/b"

# Heading per market segment; the last one belongs to no category.
HEADINGS = {
    "AUTOMOBILE": "Power Reactor",
    "BUILDING": "Agreement State",
    "FURNITURE": "Fuel Cycle Facility",
    "HOUSEHOLD": "General Information or Other",
    "MACHINERY": "Hospital",
}
PLAINTEXT_UNTIL = 1997
LEGACY_UNTIL = 1999

_OF_PAGE = ("block", "day", "year")

LEFT, RIGHT = 48, 29
_FULL_RULE = "+" + "-" * 78 + "+"
_SPLIT_RULE = "+" + "-" * LEFT + "+" + "-" * RIGHT + "+"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def line_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most eight summary rows per order, dealt out by order."""
    lines = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_number"),
        F.pmod("l_linenumber", F.lit(SLOTS)).cast("int").alias("slot"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_returnflag",
        "l_linestatus",
    )
    # A slot has hardly more than a line, so there is nothing to gain from summing up first: the lines go to their
    # order at once, and not to their slot and then to their order.
    return lines.repartition("event_number").groupBy("event_number", "slot").agg(
        F.count("*").cast("int").alias("n_lines"),
        F.sum("quantity").cast("int").alias("qty"),
        F.max("l_returnflag").alias("flag"),
        F.max("l_linestatus").alias("line_status"),
    )


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with all that its event is written from, see ``_shown``."""
    slots = (
        line_slots(spark, sf_dir)
        .groupBy("event_number")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("slot", "n_lines", "qty", "flag", "line_status"))
            ).alias("slots")
        )
    )
    places = _read(spark, sf_dir, "nation").join(
        _read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = _read(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    return (
        _read(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("event_number"),
            day.alias("day"),
            F.year(day).alias("year"),
            (key / F.lit(BLOCK)).cast("bigint").alias("block"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_name").alias("customer"),
            F.col("o_custkey").alias("custkey"),
            F.col("n_name").alias("state"),
            F.col("c_nationkey").alias("nationkey"),
            F.col("n_regionkey").alias("regionkey"),
            F.col("o_orderpriority").alias("emergency"),
            F.col("o_orderstatus").alias("order_status"),
            F.floor("o_totalprice").cast("bigint").alias("total"),
        )
        .join(slots, "event_number", "left")
        .withColumn(
            "slots",
            F.coalesce(
                "slots",
                F.array().cast(
                    "array<struct<slot:int,n_lines:int,qty:int,flag:string,line_status:string>>"
                ),
            ),
        )
    )


def _shown(e: Column) -> Column:
    """The fields of an event as its page shows them. They are made after all exchanges, whose rows stay short."""
    key, day = e["event_number"], F.col("day")
    heading = F.create_map(*[F.lit(x) for pair in HEADINGS.items() for x in pair])[e["segment"]]
    is_reactor = heading == "Power Reactor"
    given = ("event_number", "customer", "custkey", "state", "emergency", "order_status", "slots")
    return F.struct(
        *[e[name].alias(name) for name in given],
        heading.alias("heading"),
        F.concat(F.lit("City "), e["nationkey"]).alias("city"),
        (e["regionkey"] + 1).cast("string").alias("region"),
        F.concat(F.lit("["), key % 3 + 1, F.lit("] [] []")).alias("unit"),
        F.concat(F.lit("[1] GE-"), key % 6).alias("rx_type"),
        F.concat(e["segment"], F.lit(" DEPT")).alias("rep_org"),
        F.concat(F.lit("L-"), e["custkey"], F.lit("-01")).alias("license"),
        F.when(e["order_status"] == "F", "Y").otherwise("N").alias("agreement"),
        F.when(key % 2 == 0, F.concat(F.lit("030-"), e["custkey"])).otherwise("").alias("docket"),
        F.format_string("%02d:%02d", key % 24, key % 60).alias("clock"),
        F.date_sub(day, (key % 5).cast("int")).alias("event_day"),
        F.date_add(day, 1).alias("update_day"),
        e["total"].cast("string").alias("price"),
        is_reactor.alias("is_reactor"),
        (is_reactor | (key % 11 == 0)).alias("shows_units"),
    )


def _us(date: Column) -> Column:
    return F.date_format(date, "MM/dd/yyyy")


def _code(s: Column) -> Column:
    return F.concat(F.lit("50.7"), s["slot"], F.lit("(b)("), s["n_lines"], F.lit(")"))


def _description(s: Column) -> Column:
    return F.concat(F.lit("RETURN "), s["flag"], F.lit(" QTY "), s["qty"])


def _unit_cells(s: Column) -> list[Column]:
    return [
        s["slot"].cast("string"),
        F.when(s["flag"] == "R", "A/R").otherwise("N"),
        F.when(s["line_status"] == "O", "Y").otherwise("N"),
        F.concat(s["qty"] % 101, F.when(s["slot"] == 3, "%").otherwise("")),
        F.when(s["line_status"] == "O", "Power Operation").otherwise(""),
        s["n_lines"].cast("string"),
        F.lit("Hot Standby"),
    ]


def _join(items: Column, between: str = "") -> Column:
    return F.array_join(items, between)


def _text(c: Callable[[str], Column], line_break: str, markup: bool) -> Column:
    """Three lines with a blank one, a label inside the narrative, and entities."""
    amp, lt, quote, cafe = (
        ("&amp;", "&lt;", "&quot;", "caf&eacute;&nbsp;bar") if markup else ("and", "under", "'", "cafe")
    )
    return F.concat(
        F.lit("ORDER "),
        c("event_number"),
        F.lit(" STATUS "),
        c("order_status"),
        F.lit(line_break * 2 + f"Total {quote}price{quote} "),
        c("price"),
        F.lit(f" {amp} {lt} more, {cafe}{line_break}UNIT: 99 was not affected"),
    )


def _modern_event(c: Callable[[str], Column]) -> Column:
    key = c("event_number")
    digits = F.when(key % 97 == 0, F.lit("x")).otherwise(key.cast("string"))
    opening = F.when(
        key % 2 == 0, F.concat(F.lit('<div class="grid border" id="en'), digits, F.lit('">\n'))
    ).otherwise(F.concat(F.lit("<div id='en"), digits, F.lit("' class='border wide grid'>\n")))

    def field(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"  <b>{label}:</b> "), value, F.lit("<br>\n"))

    reactor = F.concat(
        field("Facility", c("customer")),
        F.lit("  <b>Region:</b> "),
        c("region"),
        F.lit(" &nbsp; &nbsp; <b>State:</b> "),
        c("state"),
        F.lit("<br>\n"),
        field("Unit", c("unit")),
        field("RX Type", c("rx_type")),
    )
    other = F.concat(
        field("Rep Org", c("rep_org")),
        field("Licensee", c("customer")),
        field("Region", c("region")),
        F.lit("  <b>City:</b> "),
        c("city"),
        F.lit(" &nbsp; <b>State:</b> "),
        c("state"),
        F.lit("<br>\n  <b>County:</b> <br>\n"),
        field("License #", c("license")),
        field("Agreement", c("agreement")),
        field("Docket", c("docket")),
    )
    extra = F.when(key % 7 == 0, field("Site Code", F.concat(F.lit("S"), c("region")))).otherwise("")
    units = F.concat(
        F.lit('<table class="report-table">\n<thead><tr><th>Unit</th><th>SCRAM Code</th>'),
        F.lit("<th>RX Crit</th><th>Initial PWR</th><th>Initial RX Mode</th>"),
        F.lit("<th>Current PWR</th><th>Current RX Mode</th></tr></thead>\n<tbody>"),
        _join(
            F.transform(
                c("slots"),
                lambda s: F.concat(
                    F.lit("<tr>"),
                    *[F.concat(F.lit("<td> "), cell, F.lit("</td>")) for cell in _unit_cells(s)],
                    F.lit("</tr>\n"),
                ),
            )
        ),
        F.lit("</tbody></table>\n"),
    )
    return F.concat(
        opening,
        F.lit('  <div class="th">'),
        c("heading"),
        F.lit('</div>\n  <div class="th">Event Number: '),
        digits,
        F.lit("</div>\n  <div>\n"),
        F.when(c("is_reactor"), reactor).otherwise(other),
        extra,
        F.lit("  <b>NRC Notified By:</b> A Caller<br>\n  <b>HQ OPS Officer:</b> An Officer\n"),
        F.lit("  </div>\n  <div>\n"),
        field("Notification Date", _us(c("day"))),
        field("Notification Time", F.concat(c("clock"), F.lit(" [ET]"))),
        field("Event Date", _us(c("event_day"))),
        field("Event Time", F.concat(c("clock"), F.lit(" [EST]"))),
        F.lit("  <b>Last Update Date:</b> "),
        _us(c("update_day")),
        F.lit("\n  </div>\n  <div>\n"),
        field("Emergency Class", c("emergency")),
        F.lit("  10 CFR Section:<br>\n"),
        F.when(F.size(c("slots")) == 0, "   Agreement State\n").otherwise(
            _join(
                F.transform(
                    c("slots"),
                    lambda s: F.concat(
                        F.lit("   "), _code(s), F.lit(" -\n      "), _description(s), F.lit("<br>\n")
                    ),
                )
            )
        ),
        F.lit("  </div>\n  <div>\n  <b>Person (Organization):</b><br>\n    Berber, C"),
        c("custkey"),
        F.lit(" (R"),
        c("region"),
        F.lit("DO)<br>\n    DUTY_DESK (EMAIL)<br>\n    Robert Brown<br>\n"),
        F.lit("    - CROSS_BORDER (MEXICO) (EMAIL)<br>\n  </div>\n</div>\n"),
        F.when(c("shows_units"), units).otherwise(""),
        F.lit('<b>Event Text</b>\n<div class="border">\n  '),
        _text(c, "<br>", markup=True),
        F.lit("<br>\n</div>\n<br><br>\n"),
    )


def _legacy_event(c: Callable[[str], Column]) -> Column:
    key = c("event_number")
    digits = F.when(key % 97 == 0, F.lit("")).otherwise(key.cast("string"))
    reactor = F.concat(
        F.lit(" Facility: "),
        c("customer"),
        F.lit(" <br> Region: "),
        c("region"),
        F.lit(" &nbsp; &nbsp; State: "),
        c("state"),
        F.lit("<br> Unit: "),
        c("unit"),
        F.lit("<br> RX Type: "),
        c("rx_type"),
        F.lit(" <br>"),
    )
    other = F.concat(
        F.lit(" Rep Org: "),
        c("rep_org"),
        F.lit(" <br> Licensee: "),
        c("customer"),
        F.lit(" <br> Region: "),
        c("region"),
        F.lit(" <br> City: "),
        c("city"),
        F.lit(" &nbsp; State: "),
        c("state"),
        F.lit("<br> County: <br> License #: "),
        c("license"),
        F.lit("<br> Agreement: "),
        c("agreement"),
        F.lit("<br> Docket: "),
        c("docket"),
        F.lit(" <br>"),
    )
    units = F.concat(
        F.lit('<table width="98% "><tbody><tr>'),
        *[
            F.lit(f'<td colspan="2"> {t} </td>')
            for t in ("Unit", "SCRAM Code", "RX Crit", "Initial PWR", "Initial RX Mode")
        ],
        F.lit('<td colspan="2"> Current PWR </td><td colspan="2"> Current RX Mode </td></tr>'),
        _join(
            F.transform(
                c("slots"),
                lambda s: F.concat(
                    F.lit("<tr>"),
                    *[
                        F.concat(F.lit('<td colspan="2"> '), cell, F.lit(" </td>"))
                        for cell in _unit_cells(s)
                    ],
                    F.lit("</tr>"),
                ),
            )
        ),
        F.lit("</tbody></table>"),
    )
    return F.concat(
        F.lit('<a name="en'),
        digits,
        F.lit('"></a><br>'),
        F.when(key % 89 == 0, "<hr>").otherwise(""),
        F.lit("<table><tbody><tr><td>"),
        c("heading"),
        F.lit("</td><td> Event Number: "),
        digits,
        F.lit(" </td></tr><tr><td>"),
        F.when(c("is_reactor"), reactor).otherwise(other),
        F.lit(" NRC Notified By: A CALLER<br> HQ OPS Officer: AN OFFICER </td>"),
        F.lit("<td> Notification Date: "),
        _us(c("day")),
        F.lit(" <br> Notification Time: "),
        c("clock"),
        F.lit(" [ET] <br> Event Date: "),
        _us(c("event_day")),
        F.lit(" <br> Event Time: "),
        c("clock"),
        F.lit(" [EST] <br> Last Update Date: "),
        _us(c("update_day")),
        F.lit(" </td></tr><tr><td> Emergency Class: "),
        c("emergency"),
        F.lit(" <br> 10 CFR Section: <br> "),
        F.when(F.size(c("slots")) == 0, "AGREEMENT STATE <br>").otherwise(
            _join(
                F.transform(
                    c("slots"),
                    lambda s: F.concat(_code(s), F.lit(" - "), _description(s), F.lit(" <br> ")),
                )
            )
        ),
        F.lit("</td><td> Person (Organization): <br> Berber, C"),
        c("custkey"),
        F.lit(" (R"),
        c("region"),
        F.lit("DO)<br>DUTY_DESK (EMAIL)<br>Robert Brown<br>- CROSS_BORDER (MEXICO) (EMAIL) "),
        F.lit("</td></tr></tbody></table>"),
        F.when(
            ~c("is_reactor"),
            "<table><tbody><tr><td colspan='2'> A notice for material. </td></tr></tbody></table>",
        ).otherwise(""),
        F.when(c("shows_units"), units).otherwise(""),
        F.lit("<p><b>Event Text</b></p><table><tbody><tr><td> "),
        _text(c, "<br>", markup=True),
        F.lit("<br> </td></tr></tbody></table><br>"),
    )


def _wide(text: Column, width: int) -> Column:
    """Pad to a width, never cut."""
    return F.concat(text, F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(text))))


def _two(left: Column, right: Column) -> Column:
    return F.concat(F.lit("|"), _wide(left, LEFT), F.lit("|"), _wide(right, RIGHT), F.lit("|\n"))


def _plaintext_event(c: Callable[[str], Column]) -> Column:
    lit = F.lit
    blank = lit("")

    def said(label: str, value: Column) -> Column:
        return F.concat(lit(label), lit("  "), value)

    reactor = F.concat(
        _two(said(" FACILITY:", c("customer")), said("NOTIFICATION DATE:", _us(c("day")))),
        _two(
            F.concat(said("    UNIT:", c("unit")), lit("  "), said("REGION:", c("region")),
                     lit("  "), said("STATE:", c("state"))),
            F.concat(said("NOTIFICATION TIME:", c("clock")), lit("[ET]")),
        ),
        _two(said("  RXTYPE:", c("rx_type")), said("EVENT DATE:", _us(c("event_day")))),
    )
    other = F.concat(
        _two(said(" REP ORG:", c("rep_org")), said("NOTIFICATION DATE:", _us(c("day")))),
        _two(
            said(" LICENSEE:", c("customer")),
            F.concat(said("NOTIFICATION TIME:", c("clock")), lit("[ET]")),
        ),
        _two(
            F.concat(said("    CITY:", c("city")), lit("  "), said("REGION:", c("region"))),
            said("EVENT DATE:", _us(c("event_day"))),
        ),
        _two(F.concat(lit("  COUNTY:            "), said("STATE:", c("state"))), blank),
        _two(F.concat(said("LICENSE#:", c("license")), lit("  "),
                      said("AGREEMENT:", c("agreement"))), blank),
        _two(said("  DOCKET:", c("docket")), blank),
    )
    left = F.concat(
        F.array(said("EMERGENCY CLASS:", c("emergency")), lit("10 CFR SECTION:")),
        F.when(F.size(c("slots")) == 0, F.array(lit("NINF                     INFORMATION ONLY"))).otherwise(
            F.transform(c("slots"), lambda s: F.concat(lit("AOUT "), _code(s), lit("  "), _description(s)))
        ),
    )
    right = F.array(
        F.concat(lit("Berber, C"), c("custkey"), lit("  R"), c("region"), lit("DO")),
        lit("DUTY_DESK            EMAIL"),
    )
    side_by_side = _join(
        F.transform(
            F.arrays_zip(left.alias("l"), right.alias("r")),
            lambda z: _two(F.coalesce(z["l"], blank), F.coalesce(z["r"], blank)),
        )
    )
    unit_rule = "+-----+----------+-------+--------+-----------------+--------+-----------------+\n"
    widths = (5, 10, 7, 8, 17, 8, 17)

    def unit_row(s: Column) -> Column:
        cells = _unit_cells(s)
        ruled = F.concat(lit("|"), *[x for cell, w in zip(cells, widths) for x in (_wide(cell, w), lit("|"))])
        # An unruled row with wide gaps, as old pages have them; it cannot show blanks.
        cells[4] = F.lit("Power Operation")
        loose = F.concat(
            lit("|"), *[x for cell, w in zip(cells[:5], widths) for x in (_wide(cell, w), lit("  "))],
            lit("|"), *[x for cell, w in zip(cells[5:], widths[5:]) for x in (_wide(cell, w), lit("  "))],
            lit("|"),
        )
        odd = (c("event_number") % 2 == 1) & (s["line_status"] == "O")
        return F.concat(F.when(odd, loose).otherwise(ruled), lit("\n"))

    units = F.concat(
        lit(unit_rule),
        lit("|UNIT |SCRAM CODE|RX CRIT|INIT PWR|   INIT RX MODE  |CURR PWR|  CURR RX MODE   |\n"),
        lit(unit_rule),
        _join(F.transform(c("slots"), unit_row)),
    )
    narrative = F.transform(
        F.split(_text(c, "\n", markup=False), "\n"),
        lambda line: F.concat(lit("|"), _wide(line, 78), lit("|\n")),
    )
    return F.concat(
        lit(_FULL_RULE + "\n"),
        _two(c("heading"), F.concat(lit("Event Number:  "), c("event_number"), lit("  "))),
        lit(_FULL_RULE + "\n" + _SPLIT_RULE + "\n"),
        F.when(c("is_reactor"), reactor).otherwise(other),
        lit("+" + "-" * LEFT + "+"),
        _wide(F.concat(said("EVENT TIME:", c("clock")), lit("[EST]")), RIGHT),
        lit("|\n"),
        _two(lit(" NRC NOTIFIED BY:  A CALLER"), said("LAST UPDATE DATE:", _us(c("update_day")))),
        lit("|" + "  HQ OPS OFFICER:  AN OFFICER".ljust(LEFT) + "+" + "-" * RIGHT + "+\n"),
        lit("+" + "-" * LEFT + "+" + "PERSON          ORGANIZATION".ljust(RIGHT) + "|\n"),
        side_by_side,
        F.when(c("shows_units"), units).otherwise(""),
        lit(_FULL_RULE + "\n\n" + " " * 35 + "EVENT TEXT\n" + _FULL_RULE + "\n"),
        _join(narrative),
        lit(_FULL_RULE + "\n\n"),
    )


def page_url(block: Column, day: Column) -> Column:
    return F.concat(
        F.lit(HOST), block, F.lit("/event/"), F.year(day), F.lit("/"),
        F.date_format(day, "yyyyMMdd"), F.lit("en"),
    )


def render_pages(events: DataFrame) -> DataFrame:
    """Pages of all layouts: ``url, year, report_date, html, html_sha256, landed_at``."""
    modern = F.col("year") > LEGACY_UNTIL
    plaintext = F.col("year") <= PLAINTEXT_UNTIL

    def body(e: Column) -> Column:
        # The day and year are the page's; the rest is the event's own.
        c = lambda name: F.col(name) if name in _OF_PAGE else e[name]
        return F.when(plaintext, _plaintext_event(c)).when(modern, _modern_event(c)).otherwise(_legacy_event(c))

    own = ["event_number", *[c for c in events.columns if c not in ("event_number", *_OF_PAGE)]]
    # The short source columns are dealt out and sorted, by year for the folders too; only then are
    # they written out, a page at a time. The text, many times as long, is in no exchange and in no sort.
    grouped = (
        events.groupBy(*_OF_PAGE)
        .agg(F.array_sort(F.collect_list(F.struct(*own))).alias("entries"))
        .sortWithinPartitions("year")
        .withColumn("content", _join(F.transform(F.transform("entries", _shown), body)))
    )
    day, before = F.col("day"), F.date_sub("day", 1)
    # Pages of odd blocks have no heading and so no report date.
    heading = F.when(
        F.col("block") % 2 == 0,
        F.concat(F.lit("<h1>Event Notification Report for "),
                 F.date_format(day, "MMMM dd, yyyy"), F.lit("</h1>\n")),
    ).otherwise("")
    modern_page = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>Reports</title>\n<script>var s="<pre>";</script>'),
        F.lit("</head><body>\n<strong>Official site</strong>\n"),
        heading,
        F.lit('<!-- <a name="en0"> --><div class="nrc-event-report-day general-content">\n'),
        F.col("content"),
        F.lit("</div></body></html>"),
    )
    legacy_page = F.concat(
        F.lit("<html><body><div><table><tbody><tr><td><p> Event Reports For<br>"),
        F.date_format(before, "M/d/yyyy"), F.lit(" - "), F.date_format(day, "M/d/yyyy"),
        F.lit(" </p></td></tr></tbody></table><br>"),
        F.col("content"),
        F.lit("</div></body></html>"),
    )
    plain_page = F.concat(
        F.lit("<html><body><pre>\n          Event Reports For\n          "),
        _us(before), F.lit(" - "), _us(day), F.lit("\n\n"),
        F.col("content"),
        F.lit("</pre></body></html>"),
    )
    html = F.when(plaintext, plain_page).when(modern, modern_page).otherwise(legacy_page)
    return grouped.select(
        page_url(F.col("block"), day).alias("url"),
        F.col("year"),
        day.alias("report_date"),
        html.alias("html"),
    ).select(
        "url",
        "report_date",
        "html",
        F.sha2("html", 256).alias("html_sha256"),
        F.col("report_date").cast("timestamp").alias("landed_at"),
        "year",
    )


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index page per block and year, at most 366 days long, links in every spelling."""
    day = F.col("o_orderdate").cast("date")
    days = (
        _read(spark, sf_dir, "orders")
        .select((F.col("o_orderkey") / F.lit(BLOCK)).cast("bigint").alias("block"), day.alias("day"))
        .distinct()
    )
    name = F.date_format("day", "yyyyMMdd")
    nth = F.dayofmonth("day") % 4
    other_year = F.concat((F.year("day") + 1).cast("string"), F.date_format("day", "MMdd"))
    link = (
        F.when(nth == 0, F.concat(F.lit('<a href="'), name, F.lit('en">')))
        .when(nth == 1, F.concat(F.lit("<A class=x HREF='./"), name, F.lit("en.html'>")))
        .when(nth == 2, F.concat(F.lit('<a href="'), page_url(F.col("block"), F.col("day")), F.lit('.html">')))
        .otherwise(F.concat(F.lit("<a href="), name, F.lit('en/ title="t">')))
    )
    links = F.concat(
        F.lit("<li>"), link, name, F.lit('</a> <a href="'), other_year, F.lit('en">next year</a> '),
        F.lit('<a href="/about?x=1&amp;y=2">about</a></li>\n'),
    )
    return (
        days.withColumn("year", F.year("day"))
        .groupBy("block", "year")
        .agg(F.array_sort(F.collect_list(F.struct("day", links.alias("link")))).alias("links"))
        .select(
            F.concat(F.lit(HOST), F.col("block"), F.lit("/event")).alias("base_url"),
            "year",
            F.concat(
                F.lit("<html><body><ul>\n"),
                _join(F.transform("links", lambda x: x["link"])),
                F.lit('<!-- <a href="'), F.col("year"), F.lit('0101en">hidden</a> -->'),
                F.lit("</ul></body></html>"),
            ).alias("html"),
        )
    )


_written: dict[tuple[str, str], str] = {}


def landed_pages(spark: SparkSession, sf_dir: str) -> str:
    """Path of the written corpus. Rendered once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = fresh_path(spark, "landed")
        pages = render_pages(source_events(spark, sf_dir))
        pages.write.option("compression", PAGE_CODEC).partitionBy("year").parquet(path)
        _written[key] = path
    return _written[key]
