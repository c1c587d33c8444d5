"""Top-k and URL verdicts on small tables."""

import struct

from pyspark.sql import types as T

from dayledger.llm import topk, urlfilter

def _single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


VECTORS = "vec_id long, embedding array<float>, v int"


def brute(rows, every, k):
    whole = [(i, [int(64 * x // 1) for x in v]) for i, v, _ in rows]
    out = set()
    for q, a in whole:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


def test_top_k_against_brute_force(spark):
    import random

    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.125, 0.5]) for _ in range(6)], 0) for i in range(150)]
    got = topk.top_k(spark.createDataFrame(rows, VECTORS), every=7, k=5, block=40, query_block=6)
    assert {tuple(r) for r in got.collect()} == brute(rows, 7, 5)


def test_top_k_on_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (20, [1.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 1),
        (4, [float("inf")], 1), (None, [1.0], 1), (5, [], 1), (6, [3.0, 1.0], 1), (6, [3.0, 1.0], 1), (7, [1e14, 1.0], 1), (8, [-1e17, 1.0], 1),
    ]
    got = topk.top_k(spark.createDataFrame(rows, VECTORS)).collect()
    of_0 = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0]
    assert of_0 == [(7, 64 * int(64 * _single(1e14)) + 64 * 128), (6, 64 * 192 + 128 * 64), (6, 64 * 192 + 128 * 64), (20, 4096), (5, 0), (8, -(2**63 - 1))]
    assert topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0


def test_urls(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("host", T.StringType())])
    urls = [
        "http://A.example.net/en/x?q", "https://example.net", "x://sub.example.com/de/#f", "ftp://b.org/fr/", "no scheme",
        None, "", "http://bad.example.com/a", "http://bad.example.com/b?c", "http://good.example.com/",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[0], "h")] + [(100 + i, urls[7], "h") for i in range(30)], schema)
    outcomes = spark.createDataFrame([(100 + i, 1) for i in range(30)] + [(9, 0), (9, None), (None, 1)], "page_id long, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(pages, outcomes).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") == got[None]
    assert got[1][:3] == ("example.net", "", None)
    assert got[2] == ("sub.example.com", "/de/", "example.com/de/", "block")
    assert got[3] == ("b.org", "/fr/", "org/fr/", "allow")
    assert got[4][:3] == got[5][:3] == got[6][:3] == ("", "", None)
    assert got[7][3] == got[8][3] == "block"
    assert urlfilter.judge_urls(pages.limit(0), outcomes).count() == 0
    assert urlfilter.judge_urls(pages, outcomes.limit(0)).count() == len(urls) + 31
