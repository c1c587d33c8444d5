import datetime

import pytest
from pyspark.sql import functions as F

from dayledger.functions import dates, lists, markup, text, urls
from dayledger.functions.category import event_category


def one(spark, value, function):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(function(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "value, expected",
    [("  a \xa0\n\t b ", "a b"), ("", ""), (" x　", "x"), ("a b", "a b"), ("a\tb", "a b")],
)
def test_normalize_whitespace(spark, value, expected):
    assert one(spark, value, text.normalize_whitespace) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2/3/2019 x", datetime.date(2019, 2, 3)),
        (" 02/03/2019", datetime.date(2019, 2, 3)),
        ("02/30/2019", None),
        ("13/01/2019", None),
        ("on 02/03/2019", None),
        ("02/03/19", None),
        ("", None),
    ],
)
def test_us_date(spark, value, expected):
    assert one(spark, value, dates.us_date) == expected


@pytest.mark.parametrize(
    "value, clock, zone",
    [("10:36 [ET]", "10:36", "ET"), ("9:03[PST]", "9:03", "PST"), ("10:36", "10:36", ""),
     ("99:99 [X]", "99:99", "X"), ("noon", None, ""), ("10:36 ET", "10:36", "")],
)
def test_clock(spark, value, clock, zone):
    assert one(spark, value, dates.clock_time) == clock
    assert one(spark, value, dates.clock_zone) == zone


@pytest.mark.parametrize(
    "value, expected",
    [("Report for March 03, 2026 x", datetime.date(2026, 3, 3)), ("Foo 03, 2026", None),
     ("March 45, 2026", None), ("", None)],
)
def test_long_date(spark, value, expected):
    assert one(spark, value, dates.long_date) == expected


@pytest.mark.parametrize(
    "value, expected", [(" 100 ", 100), ("100%", None), ("", None), ("1.5", None), ("\xa07", 7)]
)
def test_safe_int(spark, value, expected):
    assert one(spark, value, text.safe_int) == expected


def test_citations(spark):
    value = "50.72(b)(3)(ii)(A) -\n  Degraded Condition 20.2201(a) - LOST 5.5 mCi"
    found = one(spark, value, lists.citations)
    assert [tuple(r) for r in found] == [
        ("50.72(b)(3)(ii)(A)", "Degraded Condition"),
        ("20.2201(a)", "LOST 5.5 mCi"),
    ]
    assert one(spark, "Agreement State", lists.citations) == []


def test_persons(spark):
    value = "Person (Organization):\nEndress, Bob (R2DO)\nLIST, (EMAIL)\n- CNS (MX) (EMAIL)\n\n- dash\nBare Name\n"
    found = one(spark, value, lists.persons)
    assert [tuple(r) for r in found] == [
        ("Endress, Bob", "R2DO", ""),
        ("LIST", "EMAIL", ""),
        ("CNS", "MX", ""),
        ("Bare Name", "", ""),
    ]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Non-Power Reactor", "Power Reactor"),
        ("NON-AGREEMENT STATE", "Agreement State"),
        ("fuel\xa0cycle facility", "Fuel Cycle"),
        ("Other Material", "Material"),
        ("Non-Agreement", "Material"),
        ("General Information", "General Information or Other"),
        ("Information only", "General Information or Other"),
        ("Hospital", "Unknown"),
        ("", "Unknown"),
    ],
)
def test_category(spark, value, expected):
    assert one(spark, value, event_category) == expected


@pytest.mark.parametrize(
    "value, label, expected",
    [
        # Words before the next colon all count as its label.
        ("Facility: INDIAN POINT  Region: 1", "Facility", "INDIAN"),
        ("facility:X", "FACILITY", "X"),
        ("Region: 1", "State", ""),
        ("A: one two", "A", "one two"),
        ("a(b): 1", "a(b)", "1"),
    ],
)
def test_field_value(spark, value, label, expected):
    assert one(spark, value, lambda c: text.field_value(c, label)) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p> a </p>\n<p>b<br> c</p>", "abc"),
        ("x<!-- <b>no</b> --><script>y<z</script><STYLE>p{}</STYLE>w", "xw"),
        ("&lt;b&gt; &amp;amp; &quot;&#233;&#xE9;&eacute;&nope; &#38;lt;", '<b> &amp; "ééé&nope; &lt;'),
        ("a < b and c", "a < b and c"),
        ("&nbsp;x&nbsp;y", "x\xa0y"),
        ("&#128512;&#0;", "\U0001f600�"),
    ],
)
def test_visible_text(spark, html, expected):
    assert one(spark, html, text.visible_text) == expected


def test_clean_lines(spark):
    html = " <br>\n  one <br/>\n\n two\t<BR >three &amp; <i>four</i><br> "
    assert one(spark, html, text.clean_lines) == "one\n\n\ntwo\nthree & four"


def test_first_colon(spark):
    df = spark.createDataFrame([("a: b: c",), ("no",)], "x string")
    rows = df.select(*text.split_first_colon(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [("a", " b: c"), ("no", "")]


@pytest.mark.parametrize(
    "url, year, name, iso, day",
    [
        ("https://x/e/2026/20260303en", 2026, "20260303en", "2026-03-03", datetime.date(2026, 3, 3)),
        ("https://x/e/2026/20260303en.html", 2026, "20260303en", "2026-03-03", datetime.date(2026, 3, 3)),
        ("https://x/2020/about/", 2020, "about", None, None),
        ("https://x/about", 0, "about", None, None),
        ("https://x/2026/20261399en", 2026, "20261399en", "2026-13-99", None),
    ],
)
def test_page_keys(spark, url, year, name, iso, day):
    assert one(spark, url, urls.page_year) == year
    assert one(spark, url, urls.page_name) == name
    assert one(spark, url, urls.report_date_text) == iso
    assert one(spark, url, urls.report_date) == day


def test_cells_without_closing_tags(spark):
    html = "<table><tr><th>A<th> B <tr><td colspan='2'> 1 <td><b>2</b> x</table>"
    assert one(spark, html, markup.cell_texts) == [["A", "B"], ["1", "2x"]]
    assert one(spark, html, markup.body_rows) == [["1", "2x"]]
    assert one(spark, "", markup.body_rows) == []


def test_long_pages_do_not_exhaust_the_stack(spark):
    inner = "<p>x</p><b>y</b> " * 100_000
    html = f"<div>{inner}</div>"
    size = one(spark, html, lambda c: F.length(markup.inside(F.substr(c, F.lit(6)), "div")))
    assert size == len(inner)
    assert one(spark, html, lambda c: F.length(text.joined_text(c))) == 200_000


@pytest.mark.parametrize(
    "line, expected",
    [
        ("- A B (ORG) (EMAIL)", ("A B", "ORG")),
        ("--X (O)", ("-X", "O")),
        ("A) (B) C (D(E)", ("A) (B) C", "D(E")),
        ("A, (O )", ("A", "O")),
        ("LIST (EMAIL)", ("LIST", "EMAIL")),
        ("A ()", ("A ()", "")),
        ("(X)", ("(X)", "")),
        ("A \t (O", ("A (O", "")),
        ("- (O)", None),
    ],
)
def test_brackets_of_contacts(spark, line, expected):
    found = [(p["name"], p["organization"]) for p in one(spark, f" \n{line}\xa0", lists.persons)]
    assert found == ([] if expected is None else [expected])


def test_a_line_of_contacts_is_read_by_few_functions():
    # Lambdas are not generated code and share nothing: every part written twice is run twice.
    assert str(lists.persons(F.col("x"))).count("substring") <= 4
