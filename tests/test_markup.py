"""Odd markup: quoted brackets, tags never ended, blocks in headings, tables in tables."""

import time

import pages as p
import pytest
from pyspark.sql import functions as F
from test_extract import events, frame

from dayledger.functions import markup, text
from dayledger.operators.classify import detect_format
from dayledger.operators.discover import links

UNIT = ("1", "N", "Y", "99", "Power", "100", "Run")
UNIT_ROW = {
    "unit": 1, "scram_code": "N", "rx_crit": "Y", "initial_power": 99, "initial_rx_mode": "Power",
    "current_power": 100, "current_rx_mode": "Run",
}


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(function(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "html, shown",
    [
        ("a <b title='x > y'>b</b> c", "abc"),
        ('a <b title="<i>x</i>" id=k>b</b> c', "abc"),
        ("<a href = '>' >x</a>y", "xy"),
        ("<img alt=it's>x<img alt=it's>y", "xy"),
        ("1 < 2 and 3 > 2 <p title='>'>z", "1 < 2 and 3 > 2z"),
        ("x <!-- <p title='-->y", "x y"),
        ("x <p title='<!-- no comment -->'>y", "xy"),
        ("x<script data-a='a>b'>if (a < 'b>') {}</script>y", "xy"),
        ("x <p title='<script>'>y</p>", "xy"),
        ("x <style>p > a {}</style ><b title='>'>y", "xy"),
        ("x <p class='", "x <p class='"),
        ("x <p class='y'", "x <p class='y'"),
        ("x <b title='>'>y</b> <p class=", "xy<p class="),
        ("x <!doctype '>'> <b title='>'>y", "x'>y"),
        ("", ""),
        (None, None),
    ],
)
def test_visible_text(spark, html, shown):
    got = one(spark, html, text.visible_text)
    assert got == shown


def test_attributes_keep_quoted_brackets(spark):
    html = """<a title="a>b" href='one?a<b'>1</a><a title='<a href="no">' href="two">2</a> <a href=three title='"'>3</a>"""
    found = links(spark.createDataFrame([(html,)], "html string"))
    assert [r.href for r in found.collect()] == ["one?a<b", "two", "three"]
    page = p.modern_page(p.modern_event("5", fields="<b>Facility:</b> A <i title='x > <b>No:</b> 1'>&amp;</i> B<br>"))
    page = page.replace('<div class="grid border" id="en5">', """<div title='a > "b" <p' class="grid border" id="en5">""")
    (event,) = events(spark, page)
    assert (event["event_number"], event["facility"], event["parse_warnings"]) == (5, "A & B", [])


@pytest.mark.parametrize("broken", ["<div class='", '<div class="', "<div class=", "<script ", "<!", "<", "<a name='en1", "</div ", "<table><tr><td title='"])
def test_tags_that_are_never_ended_take_linear_time(spark, broken):
    def seconds(size):
        df = frame(spark, *[broken * (size // len(broken))] * 4).repartition(1).cache()
        df.count()
        best = 1e9
        for _ in range(3):
            start = time.time()
            assert {r[0] for r in detect_format(df).select("html_format").collect()} <= {"unknown", "empty"}
            best = min(best, time.time() - start)
        return best

    seconds(1000)
    small, large = seconds(120_000), seconds(480_000)
    assert small < 4 and large < 6 * small + 2


def test_long_odd_pages_do_not_exhaust_the_stack(spark):
    html = "<p title='>'>x</p><b>y</b> " * 100_000
    assert one(spark, html, lambda c: F.length(text.visible_text(c))) == 200_000


def test_headings_with_blocks_give_no_warnings(spark):
    headed = p.modern_event(
        "7", heading="<div><b>Power Reactor</b></div><div><div><b>Class:</b> one</div></div>", fields="<b>Facility:</b> F<br><b>Odd:</b> o"
    )
    plain = p.modern_event("8", fields="<b>Facility:</b> G<br>")
    found = events(spark, p.modern_page(headed, plain))
    assert [(e["event_number"], e["facility"], e["parse_warnings"]) for e in found] == [
        (7, "F", ["Unexpected field: 'Odd' = 'o'"]), (8, "G", [])]


@pytest.mark.parametrize(
    "html, rows",
    [
        # an inner table without rows is part of its cell
        ("<table><tr><td>a<table><caption>b</caption></table>c</td><td>d</td></tr></table>", [["abc", "d"]]),
        # rows and cells of an inner table count where they begin, for the outer row too
        (
            "<table><tr><td>a<table><tr><td>b</td><td>c</td></tr></table>d</td><td>e</td></tr><tr><td>f</td></tr></table>",
            [["abcd", "b", "c", "e"], ["b", "c"], ["f"]],
        ),
        # two levels, and two tables side by side in one cell
        (
            "<table><tr><td><table><tr><td>1<table><tr><td>2</td></tr></table></td></tr></table><table><tr><th>3</th></tr></table></td><td>4</td></tr></table>",
            [["123", "12", "2", "3", "4"], ["12", "2"], ["2"], ["3"], ["4"]][:4],
        ),
        # nothing is closed but the inner table
        ("<table><tr><td>a<table><tr><td>b</table>c<td>d<tr><td>e", [["abc", "b", "d"], ["b"], ["e"]]),
        ("<TABLE><TR><TD>a<TH>b<tr><td>c</TABLE>", [["a", "b"], ["c"]]),
        ("<table></table>", []),
        ("", []),
    ],
)
def test_tables_in_tables(spark, html, rows):
    assert one(spark, html, markup.cell_texts) == rows


def test_deep_tables(spark):
    deep = "<table><tr><td>x" * 200 + "</td></tr></table>" * 200
    rows = one(spark, deep, markup.cell_texts)
    assert len(rows) == 200 and rows[0][0] == "x" * 200 and rows[-1] == ["x"]
    start = time.time()
    assert one(spark, "<table>" * 20_000, lambda c: F.size(markup.cell_texts(c))) == 0
    one(spark, "<table>" * 3000 + "</table>" * 3000, lambda c: F.size(markup.cell_texts(c)))
    assert time.time() - start < 60


def cells(row, tag="td"):
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in row) + "</tr>"


HEAD = cells(("Unit", "SCRAM Code", "RX CRIT", "Initial PWR", "Mode", "Current PWR", "Mode"))
INNER = ("<table><caption>1</caption></table>", *UNIT[1:])


@pytest.mark.parametrize(
    "table",
    [
        "<table>" + HEAD + cells(UNIT) + "</table>",
        "<table>" + HEAD + cells(INNER) + "</table>",
        "<table>" + (HEAD + cells(UNIT)).replace("</td>", "").replace("</tr>", "") + "</table>",
        "<table>" + HEAD + cells(UNIT),  # never closed
        "<table>" + HEAD + cells(INNER).replace("</tr>", ""),
        "<table title='a > b'>" + HEAD + cells(UNIT) + "</table>",
    ],
)
def test_unit_tables(spark, table):
    modern = p.modern_page(p.modern_event("1", after=table))
    legacy = p.legacy_event("2", heading="Power Reactor", after=table + p.legacy_text("the text"))
    found = events(spark, modern, legacy)
    assert [e["reactor_units"] for e in found] == [[UNIT_ROW], [UNIT_ROW]]
    assert found[1]["event_text"] == "the text"


def test_the_table_after_an_inner_one_is_another(spark):
    note = "<table><tr><td>note <table>" + HEAD + "</table></td></tr></table>"
    units = "<table width='98%'>" + HEAD + cells(UNIT) + "</table>"
    (event,) = events(spark, p.legacy_event("3", heading="Power Reactor", after="<p>x</p>" + units + note + p.legacy_text("t")))
    assert event["reactor_units"] == [UNIT_ROW]


def test_legacy_header_tables(spark):
    whole = p.legacy_event("4", left="Facility: F<br>Region: 2 State: NC", right="Event Date: 01/02/1999", cfr="Emergency Class: ALERT", persons="Ann Lee (R2)")
    inner = whole.replace("Facility: F", "Facility: F <table><caption>and G</caption></table>")
    unclosed = whole.replace("</table>", "") + p.legacy_text("its text")
    bare = whole.replace("</td>", "").replace("</tr>", "")
    after = p.legacy_event("5", left="Facility: H", after=p.legacy_text("next"))
    for first, facility, words in ((inner, "F", ""), (unclosed, "F", "its text"), (bare, "F", "")):
        found = events(spark, first + after)
        assert [(e["event_number"], e["facility"], e["event_text"]) for e in found] == [(4, facility, words), (5, "H", "next")], first
        assert (found[0]["state"], str(found[0]["event_date"]), found[0]["emergency_class"]) == ("NC", "1999-01-02", "ALERT")
        assert [x["name"] for x in found[0]["persons_notified"]] == ["Ann Lee"]
