"""How much work a page and an event take: patterns compiled, texts searched, bytes moved."""

import os
import random
import re

import pages as p
from pyspark.sql import functions as F
from test_extract import events, frame

from dayledger.functions import markup, text
from dayledger.operators import classify, legacy, modern, pieces, plaintext
from dayledger.operators.classify import detect_format
from dayledger.plans import corpus, jobs
from dayledger.session import bound_splits, fresh_path
from dayledger.sources import archive
from dayledger.sources.ledger import Store

SMALL = "/root/testdata/sf0.001"

def test_no_pattern_is_compiled_for_each_event(spark):
    """``split`` compiles its pattern for every text, unless that is one character."""
    x = F.col("x")
    assert "split(" not in str(plaintext.head(x))
    assert str(plaintext.event_text(x)).count("split(") == 1  # at line ends
    assert r"\s+, 2)" not in str(plaintext.cfr_sections(x))
    assert "split(x, (?=" not in str(legacy.cuts(x)) + str(modern.cuts(x))


def test_pages_are_searched_for_words_before_patterns(spark):
    (hidden,) = [s["_short"] for s in classify._stages() if "_short" in s]
    assert "_hides" in str(hidden)
    assert "CASE WHEN rlike(" in str(pieces.tidy_lines(F.col("x")))


def test_tidy_lines_against_a_plain_model(spark):
    rnd = random.Random(1)
    alphabet = ["a", "b:", " ", "  ", "\n", "\t", "\r", "\xa0", " ", "　", "\x85", pieces.SEP, "é", "ᚁ", "⿿"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 14))) for _ in range(3000)]

    def model(t):
        t = re.sub(f"[{re.escape(text.BLANKS.replace(chr(10), ''))}]+", " ", "\n" + t)
        return re.sub(f" ?([\n{pieces.SEP}]) ?", r"\1", t).rstrip(" ")

    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", pieces.tidy_lines(F.col("x")).alias("t"))
    # Lines of blanks alone stay lines; the model's one pass leaves a space between two ends.
    assert [(r.x, r.t) for r in df.collect() if r.t != re.sub(f"(?<=[\n{pieces.SEP}]) ", "", model(r.x))] == []


def test_elements_at_any_depth(spark):
    parts = ["<div>", "<div id=x>", "</div>", "</div >", "</DIV x>", "t", "<p>", "<"]
    rnd = random.Random(2)
    htmls = ["<div>" + "".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(2000)]

    def model(html):
        depth = 0
        for tag in re.finditer(r"<(/?)div\b", html, re.I):
            depth += -1 if tag[1] else 1
            if tag[1] and depth <= 0:
                close = re.match(r"</div\s*>", html[tag.start():], re.I)
                return html[: tag.start()] + (close[0] if close else "")
        return ""

    df = spark.createDataFrame([(h,) for h in htmls], "x string").select("x", markup.element(F.col("x"), "div").alias("e"))
    assert [(r.x, r.e) for r in df.collect() if r.e != model(r.x)] == []


def test_tags_that_show_only_after_decoding(spark):
    pages = frame(
        spark,
        "<stro&#110;g>no events found</strong>" + "x" * 300,
        "<<!-- -->strong>no events found</strong>" + "x" * 300,
        "<&#97; name='en1'>" + "x" * 300,
        p.legacy_event("6").replace("<a ", "<A "),
    )
    found = detect_format(pages).orderBy("url").collect()
    assert [r.html_format for r in found] == ["empty", "empty", "legacy", "legacy"]
    (event,) = events(spark, p.legacy_event("6").replace("<a ", "<A "))
    assert event["event_number"] == 6


def test_stored_files_are_compressed(spark):
    store = Store(fresh_path(spark, "store"))
    pages = frame(spark, p.modern_page(p.modern_event("7")))
    at = F.timestamp_seconds(F.lit(1))
    archive.save_pages(pages, store.path("pages_raw"), "one", at, buckets=2)
    jobs.extract_pages(store, archive.load_pages(spark, store.path("pages_raw")), "r1", at)
    names = [f for _, _, files in os.walk(store.root) for f in files]
    assert any(f.endswith(".zstd.parquet") or ".zstd." in f for f in names)
    assert any(f.endswith(".json.gz") for f in names) and not any(f.endswith(".json") for f in names)
    assert [r.event_number for r in store.events(spark).collect()] == [7]


def test_rendering_deals_out_source_columns_only(spark):
    """Fields of events are made above the exchanges, and lines of an order are dealt out once."""
    plan = corpus.render_pages(corpus.source_events(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "GE-" not in below and "030-" not in below
    assert plan.count("Exchange hashpartitioning(event_number") == 1  # that of the lines; orders are few here


def test_page_files_are_read_in_small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        bound_splits(spark)
        assert spark.conf.get(key) == "16m"
        spark.conf.set(key, "64m")
        bound_splits(spark)
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.set(key, before)
