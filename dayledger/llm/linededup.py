"""Cross-site boilerplate lines by the spread of their sites.

Each line's sites are a HyperLogLog sketch, built per task and merged by the aggregation, so
a line on a third of all pages costs one small sketch per task. A sketch far from the bound
decides alone; lines near the bound get an exact distinct count. Lines on ``min_sites`` sites
or more are removed everywhere but at their first occurrence, so no line leaves the corpus
altogether, not even where whole documents were copied from site to site.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.session import write_and_reread

MIN_SITES, MIN_WORDS, LG_K = 10, 1, 12
_SPACE = r"[\x20\x09-\x0D]+"


def _plain(line: Column) -> Column:
    """Comparable form: words parted by one space."""
    return F.trim(F.regexp_replace(line, _SPACE, " "))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int) -> DataFrame:
    text, name = F.col(text_col).cast("string"), F.col(id_col).cast("string")
    line = F.col("line.col")
    return (
        docs.where(text.isNotNull())
        .select(
            *_row_key(name, text),
            F.col(id_col).cast("long").alias("id"),
            F.col(site_col).cast("string").alias("site"),
            F.posexplode(F.transform(F.split(text, "\n", -1), _plain)).alias("pos", "line"),
        )
        .withColumn("words", F.length("line") - F.length(F.translate("line", " ", "")) + 1)
        .where((F.col("words") >= min_words) & (F.col("line") != ""))
        .select(
            "r1",
            "r2",
            "id",
            "site",
            "pos",
            F.xxhash64("line").alias("h1"),
            F.xxhash64(F.lit(1), "line").alias("h2"),
        )
    )


def _row_key(name: Column, text: Column) -> list[Column]:
    """128 bits that name a row by its id and text."""
    return [F.xxhash64(name, text).alias("r1"), F.xxhash64(F.lit(1), name, text).alias("r2")]


def boilerplate_lines(lines: DataFrame, min_sites: int, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first) of lines on ``min_sites`` distinct sites or more; a null site is none.

    The sketch's standard error is 1.04 / sqrt(2^lg_k); within four of them of the bound, and
    by 1 at least, the exact count decides.
    """
    margin = max(1.0, 4 * 1.04 / 2 ** (lg_k / 2) * min_sites)
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", lg_k).alias("sites"), F.min(F.struct("id", "r1", "r2", "pos")).alias("first")
    )
    wide = write_and_reread(
        spread.select("h1", "h2", "first", F.hll_sketch_estimate("sites").alias("estimate")).where(
            F.col("estimate") >= min_sites - margin
        ),
        "wide-lines",
    )
    near = wide.where(F.col("estimate") <= min_sites + margin)
    counted = (
        lines.select("h1", "h2", "site")
        .where(F.col("site").isNotNull())
        .join(near.select("h1", "h2"), ["h1", "h2"])
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return (
        wide.where(F.col("estimate") > min_sites + margin)
        .select("h1", "h2", "first")
        .union(near.join(counted, ["h1", "h2"]).select("h1", "h2", "first"))
    )


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """All rows and columns, ``text`` without its boilerplate lines, and ``lines_removed``.

    Lines end at ``\\n``, are compared with white space folded, and count from ``min_words``
    words (every line with a word, unless told otherwise); shorter and blank lines always stay. The first occurrence (least id, nulls first,
    then the row's hash and the place in the text) keeps the line. A null text stays null, an
    empty one empty; a text may become empty, its row stays. Rows with a null site are
    cleaned but add no site. Rows equal in id and text are treated alike. A column
    ``n_chars`` is brought up to date if there is one; others pass through, whatever they are
    called, but a column ``lines_removed`` is replaced.
    """
    own = [c for c in docs.columns if c != "lines_removed"]
    lines = write_and_reread(_lines(docs, id_col, text_col, site_col, min_words), "lines")
    flagged = write_and_reread(boilerplate_lines(lines, min_sites), "boilerplate")
    here = F.struct("id", "r1", "r2", "pos")
    drops = (
        lines.join(flagged, ["h1", "h2"])
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("r1", "r2")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.struct("r1", "r2").alias("row"), "gone")
    )
    text = F.col("all.text")
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in own)).alias("all"),
        F.struct(*_row_key(F.col(id_col).cast("string"), F.col(text_col).cast("string"))).alias("row"),
    )
    text = F.col(f"all.`{text_col}`")
    parts = F.split(text, "\n", -1)
    kept = F.filter(parts, lambda _, i: ~F.array_contains("gone", i))
    clean = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    joined = packed.join(drops, "row", "left").select(
        "all", clean.alias("clean"), F.coalesce(F.size("gone"), F.lit(0)).alias("lines_removed")
    )
    fresh = {text_col: F.col("clean")}
    if "n_chars" in own:
        fresh["n_chars"] = F.coalesce(F.length("clean"), F.col("all.n_chars")).cast(docs.schema["n_chars"].dataType)
    return joined.select(
        *(fresh.get(c, F.col(f"all.`{c}`")).alias(c) for c in own), F.col("lines_removed").cast("int")
    )
