"""Queries on whole stores: runs, streams, ledgers, folding, and pages with odd markup.

Their SQL reads the source columns, as in ``catalogue``, which registers them.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators import reconcile, stats, status
from dayledger.operators.extract import extract_events, extract_rows, parse_errors_of
from dayledger.plans import catalogue, corpus
from dayledger.plans.catalogue import query, rendered, table, with_source
from dayledger.plans.compact import compact, vacuum
from dayledger.plans.jobs import run, run_current_year
from dayledger.schemas import EVENT_COLUMNS, PAGES_RAW
from dayledger.session import PAGE_CODEC, fresh_path
from dayledger.sources import archive, event_files, listing
from dayledger.sources.ledger import Store
from dayledger.streaming.incremental import process_new_pages


#: Each of these runs several whole jobs.
WHOLE_STORES = (
    "same_run_id_twice", "two_landings_one_store", "stream_ledger", "current_year_run", "discovered_per_run",
    "error_life", "compacted_store",
)


def _at(n: int):
    return F.timestamp_seconds(F.lit(1_000_000 + n))


def _landed(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame, DataFrame, list[int]]:
    """A store with all rendered pages landed, the pages, the index pages, and the years."""
    store, pages = Store(fresh_path(spark, "store")), rendered(spark, sf_dir)
    archive.save_landed(pages, store.path("pages_raw"), "landing", archive.buckets_for(spark))
    years = [r.year for r in pages.select("year").distinct().collect()]
    return store, pages, corpus.index_pages(spark, sf_dir), years


def _stored_counts(spark: SparkSession, store: Store) -> DataFrame:
    return store.events(spark).groupBy("year", "category", "html_format").agg(F.count("*").alias("events"))


_STORED = with_source("SELECT year, category, html_format, count(*) AS events FROM good GROUP BY ALL")


# --- runs and streams --------------------------------------------------------------------


@query(_STORED)
def same_run_id_twice(spark, sf_dir):
    """A run, the same id again, which is refused, and ids that look like parts of it: nothing stored is lost."""
    store, _, index, years = _landed(spark, sf_dir)
    early = [y for y in years if y < 1999]
    run(spark, store, early, "daily-done", _at(0), index)
    run(spark, store, [y for y in years if y not in early], "daily", _at(1), index)
    try:
        run(spark, store, years, "daily", _at(2), index)
    except ValueError:
        run(spark, store, years, "daily-found", _at(3), index)
    return _stored_counts(spark, store)


@query(_STORED)
def two_landings_one_store(spark, sf_dir):
    """Two streams with landing folders and checkpoints of their own write to one store."""
    store, pages = Store(fresh_path(spark, "store")), rendered(spark, sf_dir)
    for part in (F.col("year") < 1999, F.col("year") >= 1998):
        landing = fresh_path(spark, "landing")
        pages.where(part).select(*PAGES_RAW.fieldNames()).write.option("compression", PAGE_CODEC).parquet(landing)
        process_new_pages(spark, store, landing, fresh_path(spark, "stream")).awaitTermination()
    return _stored_counts(spark, store)


@query(
    with_source(
        """
SELECT CASE WHEN year < 1998 THEN 0 ELSE 1 END AS step, 'stream' AS run_type, 'completed' AS status,
  count(DISTINCT page_url) AS pages_parsed, count(*) FILTER (WHERE error IS NULL) AS events_found,
  CAST(0 AS BIGINT) AS errors, true AS in_order
FROM src GROUP BY 1
"""
    )
)
def stream_ledger(spark, sf_dir):
    """Three stream runs, the last without new pages: one ledger row for each micro-batch that had any."""
    store, pages = Store(fresh_path(spark, "store")), rendered(spark, sf_dir)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    for step in (F.col("year") < 1998, F.col("year") >= 1998, None):
        if step is not None:
            landed = pages.where(step).select(*PAGES_RAW.fieldNames())
            landed.write.mode("append").option("compression", PAGE_CODEC).parquet(landing)
        process_new_pages(spark, store, landing, checkpoint).awaitTermination()
    runs = stats.current_runs(store.runs(spark))
    return runs.select(
        F.substring_index("run_id", "-", -1).cast("int").alias("step"),
        "run_type",
        "status",
        "pages_parsed",
        "events_found",
        "errors",
        (F.col("started_at") <= F.col("finished_at")).alias("in_order"),
    )


@query(
    with_source(
        """
SELECT year, html_format, count(*) FILTER (WHERE error IS NULL) AS events,
  (SELECT count(DISTINCT page_url) FROM src WHERE year = 1999) AS pages_discovered, 'incremental' AS run_type
FROM src WHERE year = 1999 GROUP BY ALL
"""
    )
)
def current_year_run(spark, sf_dir):
    """The incremental run takes the year of its time in UTC: the last hours of 1999 are next year's elsewhere."""
    store, _, index, _ = _landed(spark, sf_dir)
    at = F.to_timestamp(F.lit("1999-12-31T23:30:00Z"))
    run_current_year(spark, store, "now", at, index)
    ledger = stats.current_runs(store.runs(spark)).select("pages_discovered", "run_type")
    counted = store.events(spark).groupBy("year", "html_format").agg(F.count("*").alias("events"))
    return counted.join(F.broadcast(ledger), how="cross")  # one run, so one row


@query(
    with_source(
        """
SELECT 'run' || n AS run_id, pages AS pages_discovered, CASE n WHEN 1 THEN 0 ELSE pages END AS pages_fetched,
  CASE n WHEN 1 THEN 0 ELSE pages END AS pages_parsed, CASE n WHEN 1 THEN 0 ELSE events END AS events_found
FROM (SELECT count(DISTINCT page_url) AS pages, count(*) FILTER (WHERE error IS NULL) AS events FROM src),
  (SELECT unnest(range(3)) AS n)
"""
    )
)
def discovered_per_run(spark, sf_dir):
    """Links are counted whether they are new or known: a run, another that finds nothing new, a forced one."""
    store, _, index, years = _landed(spark, sf_dir)
    for n in range(3):
        run(spark, store, years, f"run{n}", _at(n), index, force=n == 2)
    return stats.current_runs(store.runs(spark)).select(
        "run_id", "pages_discovered", "pages_fetched", "pages_parsed", "events_found"
    )


@query(
    with_source(
        """
SELECT page_url, message, year, count(*) AS failures, CASE WHEN year % 2 = 0 THEN 'resolved' ELSE 'open' END AS state,
  CAST(CASE WHEN year % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS times_seen
FROM (SELECT page_url, error AS message, year FROM src WHERE error IS NOT NULL) GROUP BY ALL
"""
    )
)
def error_life(spark, sf_dir):
    """All pages are done, then all again after those of even years have become pages without events."""
    store, pages, index, years = _landed(spark, sf_dir)
    run(spark, store, years, "first", _at(0), index)
    mended = pages.where("year % 2 = 0").select("url", F.lit("<strong>No events found</strong>").alias("html"))
    archive.save_pages(mended, store.path("pages_raw"), "mended", F.current_timestamp())
    run(spark, store, years, "second", _at(1), index, force=True)
    errors = store.current_errors(spark)
    # Failed events of a page may share a reference: they are one error, seen several times a parse.
    per_parse = parse_errors_of(extract_rows(pages)).groupBy("page_url", "event_ref", "message").agg(
        F.count("*").alias("n")
    )
    counted = errors.join(per_parse, ["page_url", "event_ref", "message"])
    return counted.groupBy("page_url", "message", "year", "state").agg(
        F.sum("n").alias("failures"), (F.sum("times_seen") / F.sum("n")).cast("bigint").alias("times_seen")
    )


@query(
    with_source(
        """
SELECT year, status, count(*) AS pages, CAST(sum(events) AS BIGINT) AS counted, bool_and(kept) AS kept FROM (
  SELECT year, page_url, 'parsed' AS status, count(*) FILTER (WHERE error IS NULL) AS events, true AS kept
  FROM src GROUP BY ALL) GROUP BY ALL
"""
    )
)
def compacted_store(spark, sf_dir):
    """Runs, a compaction, what it stands for removed, and a forced run on top."""
    store, _, index, years = _landed(spark, sf_dir)
    run(spark, store, years, "first", _at(0), index)
    unique = stats.unique_events(store.event_index(spark)).first()[0]
    compact(spark, store, "fold", _at(1))
    vacuum(spark, store)
    run(spark, store, years, "second", _at(2), index, force=True)
    kept = stats.unique_in_bitmaps(store.event_bitmaps(spark)).first()[0] == unique
    current = status.current_status(store.status_log(spark))
    return current.groupBy("year", "status").agg(
        F.count("*").alias("pages"), F.sum("event_count").alias("counted"), F.lit(kept).alias("kept")
    )


# --- folding, counting, files ------------------------------------------------------------


@query(catalogue.ORACLES["current_page_status"])
def folded_page_status(spark, sf_dir):
    """The log up to the middle of its time as a snapshot, and the rows after it."""
    log = catalogue._status_log(spark, sf_dir)
    ends = log.agg(F.min("at").cast("long").alias("low"), F.max("at").cast("long").alias("high")).first()
    middle = F.timestamp_seconds(F.lit((ends.low + ends.high) // 2))
    folded = status.snapshot(log.where(F.col("at") <= middle)).unionByName(
        log.where(F.col("at") > middle).select(*catalogue.PAGE_STATUS_COLUMNS)
    )
    current = status.current_status(folded).drop("report_date")
    return current.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("fetched_at", "parsed_at")})


@query(catalogue.ORACLES["unique_event_count"])
def unique_count_by_bitmaps(spark, sf_dir):
    """Exact count out of bitmaps of two batches that share numbers; the events are read once, for these."""
    lines = catalogue._line_events(spark, sf_dir)
    parts = [stats.event_bitmaps(lines.where(F.col("batch") == b)) for b in ("first", "second")]
    return stats.unique_in_bitmaps(parts[0].unionByName(parts[1]))


_BYTES = len(json.dumps(dict.fromkeys(EVENT_COLUMNS), separators=(",", ":"))) + 1 - 3 * len("null") + 2 * len('""')


@query(
    catalogue._STORED_LINES
    + f"""SELECT year, count(*) AS line_count, CAST(sum({_BYTES} + length(CAST(event_number AS VARCHAR))
  + length(page_url) + length(batch)) AS BIGINT) AS bytes FROM kept GROUP BY year"""
)
def event_file_bytes(spark, sf_dir):
    """Lines and bytes that compressed event files hold, to the byte; a folder that is not there adds nothing."""
    found = event_files.file_stats(spark, catalogue._two_batches(spark, sf_dir, "gzip"))
    nothing = event_files.file_stats(spark, fresh_path(spark, "no-events"))
    return found.unionByName(nothing).select("year", "line_count", F.col("line_bytes").alias("bytes"))


def _long_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys, some with zeros in front, some followed by 30 digits, some that are no numbers, and blank lines."""
    key = F.col("o_orderkey")
    field = (
        F.when(key % 5 == 0, F.concat(F.lit("00"), key))
        .when(key % 5 == 1, F.concat(key, F.lit("0" * 30)))
        .when(key % 5 == 2, F.concat(F.lit("#"), key % 100))
        .when(key % 5 == 3, F.lit("  "))
        .otherwise(key.cast("string"))
    )
    path = fresh_path(spark, "listing")
    lines = table(spark, sf_dir, "orders").select(F.concat(field, F.when(key % 5 == 3, "").otherwise(" | text")))
    lines.write.text(path)
    return listing.read_lines(spark, path)


@query(
    """
WITH listed AS (SELECT CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 5 = 1 THEN repeat('0', 30) ELSE '' END AS event_number
  FROM orders WHERE o_orderkey % 5 IN (0, 1, 4)),
found AS (SELECT CAST(o_orderkey AS VARCHAR) AS event_number FROM orders WHERE o_orderstatus <> 'P')
SELECT event_number, CASE WHEN f.event_number IS NULL THEN 'missing' WHEN l.event_number IS NULL THEN 'extra'
  ELSE 'matched' END AS outcome
FROM listed l FULL JOIN found f USING (event_number)
"""
)
def reconciliation_of_long_numbers(spark, sf_dir):
    """Numbers of any length count; those beyond 64 bits are missing, not lost."""
    listed = listing.listed_texts(_long_listing(spark, sf_dir))
    return reconcile.reconcile(listed, listing.as_texts(catalogue._found(spark, sf_dir)))


@query(
    f"""
SELECT CASE o_orderkey % 5 WHEN 2 THEN '#' || (o_orderkey % 100) || ' | text' ELSE '  ' END AS line,
  CASE o_orderkey % 5 WHEN 2 THEN '{listing.NO_NUMBER}' ELSE '{listing.BLANK}' END AS reason, count(*) AS n
FROM orders WHERE o_orderkey % 5 IN (2, 3) GROUP BY ALL
"""
)
def rejected_listing_lines(spark, sf_dir):
    """Lines of the list that are no entries, and why."""
    return listing.rejected_lines(_long_listing(spark, sf_dir))


@query(
    """
SELECT DISTINCT 'p' || l_partkey AS url, 'pending' AS status FROM lineitem
WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)
"""
)
def newly_registered_parts(spark, sf_dir):
    """Every part of a line is a page; those of large lines are known."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey")).alias("url"),
        F.lit(2000).alias("year"),
        F.lit(None).cast("date").alias("report_date"),
        "l_quantity",
    )
    found = lines.select("url", "year", "report_date").distinct()
    return status.register_new(found, lines.where("l_quantity >= 49"), F.current_timestamp()).select("url", "status")


# --- odd markup --------------------------------------------------------------------------


def _broken(pages: DataFrame) -> DataFrame:
    """The pages with quoted brackets in every block, cell and anchor tag, cells that hold a table, rows and cells never
    closed, and a tag at the end that is never ended."""
    html = F.regexp_replace("html", r"<(div|td|table|a|p)\b", r"""<$1 title='a > "b" <$1' """)
    html = F.regexp_replace(html, r"(<td\b[^\n]*?' [^>]*>) *([A-Za-z0-9/%]+) *</td>", "$1<table><caption>$2</caption></table></td>")
    html = F.regexp_replace(html, "</(?:td|tr)>", "")
    return pages.withColumn("html", F.concat(html, F.lit("<div class='")))


@query(catalogue.ORACLES["reactor_units"])
def reactor_units_of_broken_pages(spark, sf_dir):
    """The same rows as from sound pages."""
    events = extract_events(_broken(rendered(spark, sf_dir)))
    return events.select("event_number", F.explode("reactor_units").alias("u")).select("event_number", "u.*")


@query(
    with_source(
        """
SELECT page_url, event_number, html_format, category, CASE WHEN reactor THEN c_name END AS facility, n_name AS state
FROM good WHERE html_format <> 'plaintext'
"""
    )
)
def fields_of_broken_pages(spark, sf_dir):
    # Plaintext pages end with 1997. A filter on the layout would be evaluated beside the extraction, not after it.
    events = extract_events(_broken(rendered(spark, sf_dir).where("year >= 1998")))
    return events.select("page_url", "event_number", "html_format", "category", "facility", "state")
