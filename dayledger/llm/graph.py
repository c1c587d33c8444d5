"""Connected components of a link table, by alternating large and small stars.

Each half step takes the least neighbour with a partial aggregate and joins it back, so no
vertex's neighbours ever meet in one task and nothing but two numbers reaches the driver.
Every step is written to the shared folder: a lost executor costs one step at most.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.session import write_and_reread


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u")
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(u, v) longs -> (node, label), the label being the least node of the component.

    Nodes without a link to another node are left out. Repeated links, links both ways and
    links to oneself are fine; rows with a null end are left out; no links give no rows.
    """
    now = write_and_reread(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u > v")
        .distinct(),
        "links",
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        now = write_and_reread(_small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
