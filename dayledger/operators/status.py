"""Page state as an append-only log and the current view over it.

A state change is a new row. The current row of a page is one aggregation, combined before
the shuffle: no window gathers the history of a page in one task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.schemas import PAGE_STATUS, STATUSES

_RANK = {status: rank for rank, status in enumerate(STATUSES)}


def _order(at: Column, status: Column) -> Column:
    """Total order of changes; changes of the same instant follow the page's life."""
    ranks = F.create_map(*[F.lit(x) for pair in _RANK.items() for x in pair])
    return F.struct(at.alias("at"), F.coalesce(ranks[status], F.lit(-1)).alias("rank"))


def current_status(log: DataFrame) -> DataFrame:
    """Current state per url.

    Carried columns hold their last value that was set, but only values set after the last
    return to pending: a reset clears them, and the event count goes back to 0.
    """
    carried = ("html_format", "html_sha256", "event_count", "error_msg")
    order = F.col("_order")
    ordered = log.withColumn("_order", _order(F.col("at"), F.col("status")))

    def last_set(name: str) -> Column:
        latest = F.max(F.when(F.col(name).isNotNull(), F.struct(order, F.col(name).alias("value"))))
        return latest.alias(f"_{name}")

    def last_time(status: str) -> Column:
        return F.max(F.when(F.col("status") == status, order)).alias(f"_{status}")

    latest = ordered.groupBy("url").agg(
        F.max(F.struct(order, "status")).alias("_latest"),
        F.min("year").alias("year"),
        F.max("report_date").alias("report_date"),
        *[last_set(name) for name in carried],
        *[last_time(status) for status in ("pending", "fetched", "parsed")],
    )
    reset = F.col("_pending")

    def since_reset(moment: Column, value: Column) -> Column:
        return F.when(moment.isNotNull() & (reset.isNull() | (moment > reset)), value)

    values = {
        name: since_reset(F.col(f"_{name}._order"), F.col(f"_{name}.value")) for name in carried
    }
    values["event_count"] = F.coalesce(values["event_count"], F.lit(0)).cast("int")
    return latest.select(
        "url",
        "year",
        "report_date",
        F.col("_latest.status").alias("status"),
        *[value.alias(name) for name, value in values.items()],
        since_reset(F.col("_fetched"), F.col("_fetched.at")).alias("fetched_at"),
        since_reset(F.col("_parsed"), F.col("_parsed.at")).alias("parsed_at"),
    )


def snapshot(log: DataFrame) -> DataFrame:
    """The rows of the log that decide the current state of any page: ``current_status`` of these, with
    whatever rows come later, is that of the whole log. At most ten rows a page, one aggregate."""
    names = PAGE_STATUS.fieldNames()
    order = _order(F.col("at"), F.col("status"))
    row = F.struct(*names)

    def holder(condition: Column, *first: Column) -> Column:
        return F.max(F.when(condition, F.struct(*first, order, row.alias("row"))))["row"]

    carried = ("html_format", "html_sha256", "event_count", "error_msg")
    deciding = [
        holder(F.lit(True)),
        holder(F.lit(True), -F.col("year")),
        holder(F.col("report_date").isNotNull(), F.col("report_date")),
        *[holder(F.col("status") == s) for s in ("pending", "fetched", "parsed")],
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(order, F.col(c), row.alias("row"))))["row"] for c in carried],
    ]
    rows = log.groupBy("url").agg(F.array_distinct(F.array_compact(F.array(*deciding))).alias("rows"))
    return rows.select(F.explode("rows").alias("row")).select("row.*").select(*names)


def status_rows(pages: DataFrame, status: str, at: Column, **columns: Column) -> DataFrame:
    """Log rows for ``pages(url, year, report_date)``; columns not given stay NULL."""
    given = {"status": F.lit(status), "at": at, **columns}
    kept = ("url", "year", "report_date")
    return pages.select(
        *[
            (F.col(f.name) if f.name in kept else given.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in PAGE_STATUS.fields
        ]
    )


def register_new(found: DataFrame, log: DataFrame | None, at: Column) -> DataFrame:
    """Pending rows for pages the log does not know; known pages stay as they are."""
    new = found
    if log is not None:
        new = found.join(log.select("url").distinct(), "url", "left_anti")
    return status_rows(new, "pending", at)


def reset_rows(current: DataFrame, at: Column) -> DataFrame:
    """Pending rows that send pages back, whatever their state; filter by year before."""
    return status_rows(current, "pending", at)


def pages_in(current: DataFrame, status: str | None = None, year: int | None = None) -> DataFrame:
    """Pages of a status and year, either may be left open."""
    if status is not None:
        current = current.where(F.col("status") == status)
    if year is not None:
        current = current.where(F.col("year") == year)
    return current


def pending_pages(current: DataFrame, year: int | None = None) -> DataFrame:
    return pages_in(current, "pending", year)


def fetched_unparsed(current: DataFrame, year: int | None = None) -> DataFrame:
    return pages_in(current, "fetched", year)


def page_at(log: DataFrame, url: str) -> DataFrame:
    """Current state of one page; the filter comes first, so only its rows are read."""
    return current_status(log.where(F.col("url") == url))
