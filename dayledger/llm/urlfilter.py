"""URL verdicts from rules and empirical-Bayes host reputation.

Labelled page outcomes are counted for each host. The share of bad pages is shrunk level by
level: the corpus informs the suffix, the suffix the registered domain, the domain the host.
Each level is a beta-binomial: the prior's mean is the level above, its strength comes from how
far groups of that level spread around it (method of moments), within fixed bounds. A host
is blocked if the lower bound of its posterior, mean less ``z`` deviations, is over ``limit``.
Only functions of DataFrames are used; counts are aggregated before anything is joined.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (rule, verdict): host, then the path's beginning.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Second-level labels under which country suffixes register: fixed values.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
LIMIT, Z, LEAST_STRENGTH, MOST_STRENGTH = 0.5, 1.645, 2.0, 1000.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("`url`"))).otherwise("")
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (rule, verdict); null without one. Equal lengths: by name."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix: two labels under such as co.uk, else one."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    long = (n >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.element_at(parts, F.when(n >= 2, -2).otherwise(-1)).isin(*SECOND_LEVEL)
    width = F.when(long, 2).otherwise(1)
    tail = lambda k: F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), F.least(k, n)), ".")
    return tail(width + 1), tail(width)


def _posterior(groups: DataFrame, prior: DataFrame, on: list[str]) -> DataFrame:
    """Mean and strength of each group, given its parents' mean ``m0``.

    Strength of the prior by moments over the groups of one parent, weighted by size:
    between-group variance v around m0 gives m0 (1 - m0) / v - 1.
    """
    joined = groups.join(prior, on)
    chance = F.col("m0") * (1 - F.col("m0"))
    off = F.pow(F.col("bad") / F.col("n") - F.col("m0"), 2)
    spread = joined.where("n > 0").groupBy(*on).agg(
        (F.sum(F.col("n") * off) / F.sum("n") - F.sum(chance) / F.sum("n")).alias("v"), F.max(chance).alias("c")
    )
    raw = F.when(F.col("v") > 0, F.col("c") / F.col("v") - 1).otherwise(MOST_STRENGTH)
    strength = spread.select(*on, F.least(F.greatest(raw, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH)).alias("s0"))
    s0 = F.coalesce("s0", F.lit(LEAST_STRENGTH))
    return joined.join(strength, on, "left").withColumns(
        {"mean": (F.col("bad") + s0 * F.col("m0")) / (F.col("n") + s0), "weight": F.col("n") + s0}
    )


def reputation(hosts: DataFrame) -> DataFrame:
    """(host, n, bad) -> host, posterior mean, lower and upper bound of the share of bad pages."""
    domain, suffix = domain_and_suffix(F.col("host"))
    counted = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = counted.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums).withColumn("all", F.lit(1))
    whole = suffixes.groupBy("all").agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("m0"))
    of_suffix = _posterior(suffixes, whole, ["all"]).select("suffix", F.col("mean").alias("m0"))
    of_domain = _posterior(domains, of_suffix, ["suffix"]).select("suffix", "domain", F.col("mean").alias("m0"))
    of_host = _posterior(counted, of_domain, ["suffix", "domain"])
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return of_host.select(
        "host",
        "n",
        "bad",
        "mean",
        (F.col("mean") - F.lit(Z) * deviation).alias("lower"),
        (F.col("mean") + F.lit(Z) * deviation).alias("upper"),
    )


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_share (posterior mean) and lower bound per row.

    ``outcomes`` is (page_id, bad 0/1); null outcomes are left out, of several for a page the
    worst counts. A null url, or one without ``://``, has an empty host and path, fits no
    rule and shares the reputation of such pages. Rows that repeat a page are judged each, and
    each counts as an outcome. A null page_id has no outcome. Hosts without an outcome take
    their domain's share, with little weight. Other columns are not read; no rows give none.
    """
    host, path = host_and_path(F.col("url"))
    parted = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    known = outcomes.where("bad is not null").groupBy("page_id").agg(F.max("bad").cast("int").alias("bad"))
    hosts = (
        parted.select("page_id", "host")
        .join(known, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    table = reputation(hosts).select("host", "mean", "lower")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return parted.join(table, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(F.col("lower") > limit, "block").otherwise("allow")).alias("verdict"),
        F.col("mean").alias("bad_share"),
        "lower",
    )
