import datetime
import time

import pages as p
import pytest
from pyspark.sql import functions as F

from dayledger.operators import modern, plaintext
from dayledger.operators.classify import detect_format
from dayledger.operators.extract import events_of, extract_events, extract_rows, parse_errors_of
from dayledger.schemas import CATEGORIES, EVENT


def frame(spark, *htmls):
    rows = [(f"https://x/2026/202603{i:02d}en", 2026, h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "url string, year int, html string")


def events(spark, *htmls):
    found = extract_events(frame(spark, *htmls)).orderBy("page_url", "event_pos").collect()
    return [r.asDict(recursive=True) for r in found]


@pytest.mark.parametrize(
    "html, expected",
    [
        (p.modern_page(p.modern_event()), "modern"),
        ("<DIV ID='en1' CLASS='border x grid'>", "modern"),
        ("<div id=en1 class='grid borders'>" + "x" * 200, "unknown"),
        ("<div class=nrc-event-report-day><div><div class='grid border'></div></div></div>", "modern"),
        ("<div class=nrc-event-report-day></div><div class='grid border'></div>" + "x" * 200, "unknown"),
        (p.legacy_event(), "legacy"),
        ("<a href='#en1'>" + "x" * 200, "unknown"),
        ("<!-- <a name='en1'> -->" + "x" * 200, "unknown"),
        (p.plaintext_page(p.plaintext_event()), "plaintext"),
        (p.plaintext_page("x" * 1000, p.plaintext_event()), "unknown"),
        ("<pre> Event Number: none </pre>" + "x" * 300, "empty"),
        ("<strong>Gov</strong><strong>NO Events <i>Found</i></strong>" + "x" * 300, "unknown"),
        ("<strong>Gov</strong><strong><i>NO Events Found</i> today</strong>" + p.legacy_event(), "empty"),
        ("<html><body><p>Random page</p></body></html>", "empty"),
        ("<html><body>" + "x" * 300 + "</body></html>", "unknown"),
        ("<html><body>" + "<p>  </p>" * 300 + "</body></html>", "empty"),
        ("", "empty"),
    ],
)
def test_layout(spark, html, expected):
    assert detect_format(frame(spark, html)).first()["html_format"] == expected


def test_schema(spark):
    df = extract_events(frame(spark, p.modern_page(p.modern_event())))
    found = {f.name: f.dataType for f in df.schema.fields}
    for field in EVENT.fields:
        assert found[field.name].simpleString() == field.dataType.simpleString(), field.name
    assert df.first()["category"] in CATEGORIES


def test_modern_fields(spark):
    fields = """<b>Facility:</b> Plant &amp; Co<br><b>Region:</b> 2 &nbsp; <b>State:</b> NC<br>
      <b>Unit:</b> [1] [] []<br><b>RX Type:</b> [1] GE-4,[2]
        GE-4<br><b>County:</b> <br><b>Site Code:</b> 7<br><b>NRC Notified By:</b> Me<br>"""
    more = """<div><b>Notification Date:</b> 03/02/2026<br><b>Notification Time:</b> 07:41<br>
      <b>Event Date:</b> 02/30/2026<br><b>Event Time:</b> 02:59 [EST]</div>
      <div><b>Emergency Class:</b> Non Emergency<br>10 CFR Section:<br>50.72(b) - One<br>20.1 - Two</div>
      <div><b>Person (Organization):</b><br>Bobber, Rob (R2DO)<br>Bare<br></div>"""
    after = """<table><tr><th>Unit</th></tr><tr><td>1</td><td>N</td><td>Y</td><td>99</td><td>A</td>
      <td>100%</td><td></td></tr><tr><td>x</td></tr></table>
      <b>Event Text</b><div class='border'> one<br><br>two <div>three</div></div><div class=border>no</div>"""
    html = p.modern_page(
        p.modern_event("740312", fields=fields, more=more, after=after), h1="<h1>For March 03, 2026</h1>"
    )
    (e,) = events(spark, html)
    assert e["event_number"] == 740312 and e["category"] == "Power Reactor"
    assert (e["facility"], e["region"], e["state"]) == ("Plant & Co", "2", "NC")
    assert (e["unit"], e["rx_type"], e["county"]) == ("[1] [] []", "[1] GE-4,[2] GE-4", None)
    assert e["report_date"] == datetime.date(2026, 3, 3)
    assert e["notification_date"] == datetime.date(2026, 3, 2)
    assert (e["notification_time"], e["notification_timezone"]) == ("07:41", "")
    assert (e["event_date"], e["event_time"], e["event_timezone"]) == (None, "02:59", "EST")
    assert e["last_update_date"] is None and e["emergency_class"] == "Non Emergency"
    # A code without a parenthesis does not end the description before it.
    assert e["cfr_sections"] == [{"code": "50.72(b)", "description": "One 20.1 - Two"}]
    assert [(x["name"], x["organization"]) for x in e["persons_notified"]] == [
        ("Bobber, Rob", "R2DO"), ("Bare", "")]
    assert e["event_text"] == "one\n\ntwo three"
    assert e["reactor_units"] == [
        {"unit": 1, "scram_code": "N", "rx_crit": "Y", "initial_power": 99, "initial_rx_mode": "A",
         "current_power": None, "current_rx_mode": ""}]
    assert e["parse_warnings"] == ["Unexpected field: 'Site Code' = '7'"]
    assert e["html_format"] == "modern" and e["page_url"] == "https://x/2026/20260300en"


def test_modern_defaults(spark):
    (e,) = events(spark, p.modern_page(p.modern_event(heading="Hospital")))
    assert e["category"] == "Unknown" and e["notification_timezone"] == "ET"
    assert e["event_timezone"] == "" and e["emergency_class"] == "" and e["event_text"] == ""
    assert e["cfr_sections"] == [] and e["reactor_units"] == [] and e["persons_notified"] == []
    assert e["facility"] is None and e["report_date"] is None


def test_modern_repeated_labels(spark):
    twice = "<b>City:</b> A<br><b>City:</b> <br><b>State:</b> X<br><b>State:</b> Y"
    more = "<div><b>Region:</b> 1</div><div><b>Region:</b> 2</div><div><b>Region:</b> </div>"
    (e,) = events(spark, p.modern_page(p.modern_event(fields=twice, more=more)))
    assert (e["city"], e["state"], e["region"]) == (None, "Y", "2")


def test_modern_text_and_units_of_their_own_event(spark):
    table = "<table><tr><th>Unit</th></tr><tr><td>1" + "<td>x" * 6 + "</table>"
    html = p.modern_page(
        p.modern_event("1", heading="Material", after=table + "<div class='border'>t1</div>"),
        p.modern_event("2"),
        p.modern_event("3", after="<div class='border'>t3</div>"),
    )
    found = events(spark, html + "<div class='border'>foot</div>" + table)
    assert [(e["event_number"], e["event_text"], len(e["reactor_units"])) for e in found] == [
        (1, "t1", 0), (2, "", 0), (3, "t3", 0)]


def test_page_that_starts_with_its_first_event(spark):
    assert [e["event_number"] for e in events(spark, p.modern_event("7").strip(), p.legacy_event("8"))] == [7, 8]


def test_legacy_fields(spark):
    left = """Rep Org: CA DEPT: HEALTH <br>Licensee: L INC<br>Region: 4<br>City: NEWPORT &nbsp; State: CA<br>
      County: <br>License #: 6492-30<br>Agreement: Y<br>Docket: 1<br>Docket: <br>Other: z"""
    right = "Notification Date: 02/20/2019<br>Notification Time: <br>Event Time: 09:03 [PST]<br>Facility: no"
    cfr = "Emergency Class: NON EMERGENCY <br> 10 CFR Section: <br> 50.72(b) - A B <br>see 20.1 - no<br>20.2 - C"
    after = p.legacy_text(" Title<br><br>\n body &lt;x&gt; ")
    (e,) = events(spark, p.legacy_event("740655", left=left, right=right, cfr=cfr, persons="A B (C)", after=after))
    assert e["event_number"] == 740655 and e["category"] == "Agreement State"
    assert (e["rep_org"], e["licensee"], e["region"]) == ("CA DEPT: HEALTH", "L INC", "4")
    assert (e["city"], e["state"], e["county"], e["docket"]) == ("NEWPORT", "CA", None, None)
    assert (e["license_number"], e["agreement"], e["facility"]) == ("6492-30", "Y", None)
    assert e["notification_date"] == datetime.date(2019, 2, 20)
    assert (e["notification_time"], e["notification_timezone"]) == (None, "")
    assert (e["event_time"], e["event_timezone"], e["event_date"]) == ("09:03", "PST", None)
    assert e["emergency_class"] == "NON EMERGENCY"
    assert [(x["code"], x["description"]) for x in e["cfr_sections"]] == [("50.72(b)", "A B"), ("20.2", "C")]
    assert [(x["name"], x["organization"]) for x in e["persons_notified"]] == [("A B", "C")]
    assert e["event_text"] == "Title\n\n\nbody <x>" and e["report_date"] is None


def test_legacy_units(spark):
    row = "<tr>" + "".join(f"<td colspan=2> {c} </td>" for c in ("2", "N", "N", "0", "Cold Idle", "0", "Hot")) + "</tr>"
    note = "<table><tr><td colspan='2'>note</td></tr></table>"
    titled = "<table><tr><td>Unit</td><td>SCRAM Code</td></tr>" + row + "</table>"
    wide = "<table width='98% '><tr><td>x</td></tr>" + row + "</table>"
    late = p.legacy_text("t") + wide
    page = "".join(
        p.legacy_event(str(i), heading=h, after=a)
        for i, (h, a) in enumerate(
            [("Power Reactor", note + titled), ("Power Reactor", wide), ("Material", wide), ("Power Reactor", late)])
    )
    found = events(spark, page)
    assert [len(e["reactor_units"]) for e in found] == [1, 1, 0, 0]
    assert found[0]["reactor_units"][0]["unit"] == 2
    assert found[3]["event_text"] == "t"


def test_failed_events(spark):
    rows = extract_rows(
        frame(
            spark,
            p.modern_page(p.modern_event("x"), p.modern_event("5")),
            p.legacy_event("") + "<a name='en9'></a><p>no</p><table></table>" + "<a name='en10'></a><table></table>"
            + p.legacy_event("11"),
            "x" * 300,
        )
    )
    failed = parse_errors_of(rows).orderBy("page_url", "event_ref").collect()
    assert [(r.event_ref, r.message) for r in failed] == [
        ("enx", "no event number"), ("en", "no event number"),
        ("en10", "header table has no rows"), ("en9", "no header table")]
    assert sorted(r.event_number for r in events_of(rows).collect()) == [5, 11]
    assert rows.where(F.col("event_pos").isNull()).count() == 1


PLAIN_ROWS = (
    "| FACILITY: CEDAR MILL    REGION: 1  STATE: QD   |NOTIFICATION DATE: 01/03/1999|",
    "|     UNIT: [2] [] []  RXTYPE: QX-7-B            |NOTIFICATION TIME: 08:12[ET] |",
    "|  DOCKET: 1                                     |EVENT DATE:        01/02/1999|",
    "|  DOCKET:                                       |                             |",
    "+------------------------------------------------+EVENT TIME:        07:55[EST]|",
    "| NRC NOTIFIED BY:  ULF   LICENSE#: L-1          |LAST UPDATE DATE:  01/03/1999|",
    "|  HQ OPS OFFICER:  RITA                         +-----------------------------+",
    "+------------------------------------------------+PERSON          ORGANIZATION |",
    "|EMERGENCY CLASS:          NON EMERGENCY         |MAYA OLDE,           R1      |",
    "|10 CFR SECTION:                                 |ONE WORD                     |",
    "|QRST 61.14(c)(2)(iv)(A)  BEYOND STATED LIMITS   |KIT VANN             R2 X    |",
    "|ZULU                     FOR THE RECORD         |                             |",
    "|                                                |                             |",
    "+-----+----------+-------+--------+-----------------+--------+-----------------+",
    "|UNIT |SCRAM CODE|RX CRIT|INIT PWR|   INIT RX MODE  |CURR PWR|  CURR RX MODE   |",
    "+-----+----------+-------+--------+-----------------+--------+-----------------+",
    "|2     N          Y       98       Power Operation  |97       Power Operation  |",
    "|3    |          |N      |0       |Cold Idle        |0       |Cold Idle        |",
    "|                                                   |                          |",
)


def test_plaintext_fields(spark):
    text = "FIRST LINE\n\n  UNIT: 99 is not meant | pipe\nLAST"
    html = p.plaintext_page(
        p.plaintext_event("810017", rows=PLAIN_ROWS, text=text), p.plaintext_event("810018", heading="Other Material"))
    first, second = events(spark, html.replace("\n", "\r\n"))
    for e in (first, second):
        assert e["report_date"] == datetime.date(1999, 1, 3) and e["html_format"] == "plaintext"
    assert second["event_number"] == 810018 and second["category"] == "Material"
    assert second["event_text"] == "Something happened."
    e = first
    assert e["event_number"] == 810017 and e["category"] == "Power Reactor"
    assert (e["facility"], e["region"], e["state"]) == ("CEDAR MILL", "1", "QD")
    assert (e["unit"], e["rx_type"], e["license_number"]) == ("[2] [] []", "QX-7-B", "L-1")
    assert e["docket"] is None
    assert (e["notification_time"], e["notification_timezone"]) == ("08:12", "ET")
    assert (e["event_time"], e["event_timezone"]) == ("07:55", "EST")
    assert e["event_date"] == datetime.date(1999, 1, 2)
    assert e["emergency_class"] == "NON EMERGENCY"
    assert [(x["code"], x["description"]) for x in e["cfr_sections"]] == [
        ("61.14(c)(2)(iv)(A)", "BEYOND STATED LIMITS"), ("ZULU", "FOR THE RECORD")]
    assert [(x["name"], x["organization"]) for x in e["persons_notified"]] == [
        ("MAYA OLDE", "R1"), ("KIT VANN", "R2 X")]
    assert e["event_text"] == "FIRST LINE\nUNIT: 99 is not meant | pipe\nLAST"
    assert [(u["unit"], u["scram_code"], u["initial_power"], u["current_power"], u["current_rx_mode"])
            for u in e["reactor_units"]] == [
        (2, "N", 98, 97, "Power Operation"), (3, "", 0, 0, "Cold Idle")]


DEEP = 12


def test_report_day_at_any_depth(spark):
    html = "<div class=nrc-event-report-day>" + "<div>" * DEEP + "<div class='grid border'></div>" + "</div>" * DEEP + "</div>"
    assert detect_format(frame(spark, html)).first()["html_format"] == "modern"


def test_modern_nested_blocks(spark):
    def deep(x):
        return "<div>" * DEEP + x + "</div>" * DEEP

    more = (
        "<div>" + deep("<b>City:</b> Oslo<br>") + "</div>"
        "<div>10 CFR Section:<div>50.72(b) - One</div></div>"
        "<div><b>Person (Organization):</b><div>Ann Able (R9DO)</div></div>"
    )
    table = "<table><tr><th>Unit</th></tr><tr><td>4" + "<td>x" * 6 + "</table>"
    after = (
        "<div><div class='border'>INNER</div></div>" + table + "<div class='grid'>plain grid</div>"
        "<div class='border'>real " + deep("text") + " end</div>"
    )
    heading = "Power Reactor</div><div class='th'><b>Odd:</b> title"
    first, second = events(
        spark, p.modern_page(p.modern_event("7", heading=heading, more=more, after=after), p.modern_event("8"))
    )
    assert (first["city"], first["parse_warnings"]) == ("Oslo", [])
    assert first["cfr_sections"] == [{"code": "50.72(b)", "description": "One"}]
    assert [(x["name"], x["organization"]) for x in first["persons_notified"]] == [("Ann Able", "R9DO")]
    assert first["event_text"] == "real text end"
    assert [u["unit"] for u in first["reactor_units"]] == [4]
    assert second["event_text"] == ""


def test_legacy_text_around_an_inner_table(spark):
    text = "one <table><tr><td>cell</td></tr></table> two"
    (e,) = events(spark, p.legacy_event("9", after=p.legacy_text(text)))
    assert e["event_text"] == "one cell two"


@pytest.mark.parametrize("broken", ["<!-- x ", "<script>"])
def test_unclosed_comments_and_scripts_take_linear_time(spark, broken):
    html = broken * (120_000 // len(broken))
    detect_format(frame(spark, "warm")).collect()
    began = time.monotonic()
    detect_format(frame(spark, html)).collect()
    assert time.monotonic() - began < 4


def test_page_text_is_cut_once_for_the_report_date_and_once_for_a_title():
    assert str(plaintext.report_date(F.col("x"))).count("Event Reports For") == 1
    assert "(.*)" not in str(modern.person_text(F.col("x")))


def test_title_spellings_and_days_in_blocks(spark):
    html = (
        "<div><div>Person (Organization):<br>Old (A)</div><div><p>Person(Organization):<div>x</div> New (B)</p></div>"
        "</div>"
    )
    df = spark.createDataFrame([(html,), ("<div>none</div>",)], "x string")
    assert [r.t.split() for r in df.select(modern.person_text(F.col("x")).alias("t")).collect()] == [
        ["x", "New", "(B)"],
        [],
    ]


@pytest.mark.parametrize(
    "line, found",
    [
        ("|A|B |Event Number: 7 |", ("A|B", "7")),
        ("|A |Event Number: x |Event Number: 7|", ("A |Event Number: x", "7")),
        ("|||Event Number: 8|", ("|", "8")),
        ("||Event Number: 8|", ("", "")),
    ],
)
def test_category_reaches_to_the_number_cell(spark, line, found):
    df = spark.createDataFrame([(line,)], "x string")
    row = df.select(plaintext.category_text(F.col("x")).alias("c"), plaintext.event_ref(F.col("x")).alias("n")).first()
    assert (row.c, row.n) == found
