"""Headline queries, one JSON line.

Report pages are rendered from the tables once before the clock starts; what is timed is
the work on landed pages and tables. Each query runs over its whole input and every output
column is produced (``noop`` sink).
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from dayledger.operators import classify
from dayledger.operators.extract import extract_events
from dayledger.plans import catalogue

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def classify_pages(spark, sf_dir):
    return classify.detect_format(catalogue.rendered(spark, sf_dir)).select("url", "html_format")


def extract_all_fields(spark, sf_dir):
    return extract_events(catalogue.rendered(spark, sf_dir))


HEADLINE = {
    "classify_pages": classify_pages,
    "extract_all_fields": extract_all_fields,
    **{
        name: catalogue.QUERIES[name]
        for name in (
            "events_by_year_and_category",
            "page_formats",
            "normalized_documents",
            "new_events",
            "current_page_status",
            "current_event_index",
            "reconciliation_counts",
            "unique_event_count",
        )
    },
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("dayledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.time()
    pages = catalogue.rendered(spark, SF_DIR)
    rendering = time.time() - start
    n_pages = pages.count()
    n_events = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    seconds = {}
    for name, function in HEADLINE.items():
        start = time.time()
        function(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "pages": n_pages,
                "pages_per_sec_classified": round(n_pages / seconds["classify_pages"]),
                "events_per_sec_extracted": round(n_events / seconds["extract_all_fields"]),
                "rendering_sec_not_counted": round(rendering, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
