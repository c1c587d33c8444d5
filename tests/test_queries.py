"""Every registered query against its SQL, and what the plans look like."""

import pytest
from oracle import difference
from pyspark.sql import functions as F

import __spark_entry__ as contract
from dayledger.operators import dedup
from dayledger.operators.extract import extract_events
from dayledger.operators.status import current_status
from dayledger.plans import catalogue, corpus, store_queries

SMALL = contract.SMALL


# Queries that run several whole jobs take minutes: tests/oracle.py runs them, test_store.py has the same on small pages.
@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(store_queries.WHOLE_STORES)))
def test_query_matches_sql(spark, name):
    assert difference(spark, SMALL, contract.queries()[name], contract.oracle_sql()[name]) == ""


def test_every_query_of_the_library_has_sql():
    """Those of the operators for training data that SQL cannot express have tests of their own beside them."""
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["year", "html_format", "category", "events"] and rows.count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cited_sections", "reactor_units", "failed_events", "events_by_year_and_category"])
def test_filters_stay_above_the_extraction(spark, name):
    """Below it, they would hold its patterns once more for every use."""
    text = contract.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    filters = text.split("Filter ")[1:]
    assert all("Project" in part.split("\n")[1] for part in filters)
    assert not any("regexp" in part.split("\n")[0] or "RLIKE" in part.split("\n")[0] for part in filters)


def test_page_text_is_rendered_after_the_short_columns_are_dealt_out(spark):
    """No text below the last exchange, nor below the sort by year, which serves the folders too."""
    text = plan(corpus.render_pages(corpus.source_events(spark, SMALL)))
    assert text.index("grid border") < text.index("Sort [year") < text.index("Exchange")
    assert "grid border" not in text[text.index("Sort [year") :]


def test_extraction_scans_once_without_shuffle_or_python(spark):
    text = plan(extract_events(catalogue.rendered(spark, SMALL)))
    assert text.count("FileScan") == 1
    assert "Exchange" not in text and "Python" not in text


def test_year_filter_prunes_folders(spark):
    pages = catalogue.rendered(spark, SMALL).where(F.col("year") == 1999)
    assert "PartitionFilters: [isnotnull(year" in plan(extract_events(pages))


def test_state_queries_do_not_read_the_page_text(spark):
    pages = catalogue.rendered(spark, SMALL)
    assert "html:" not in plan(pages.groupBy("year").count())


def test_first_wins_limits_groups_before_the_shuffle(spark):
    lines = catalogue._line_events(spark, SMALL).drop("batch")
    text = plan(dedup.first_wins(lines))
    first, second = (line for line in text.split("\n") if "WindowGroupLimit" in line)
    assert first.endswith("Final") and second.endswith("Partial")
    assert text.index(first) < text.index("Exchange") < text.index(second)


def test_current_status_uses_no_window(spark):
    text = plan(current_status(catalogue._status_log(spark, SMALL)))
    assert "Window" not in text and text.count("Exchange") == 1
