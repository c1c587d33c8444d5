"""Exact top-k by inner product over an impact-ordered index, score at a time.

Components are whole numbers. The index deals vectors into blocks of bounded size; in a
block a dimension has two postings lists, of positive and of negative values, each cut into
segments by quantised size (4 levels). A query's segments are processed by falling signed
impact: those that can only add, from the largest level down, then those that take away, from
the largest down. After each round a vector's sum plus what the segments to come can add at
most bounds its score from above; the round stops the query in this block once no further
vector can reach the k-th best score known. Vectors that still can are scored exactly.

Queries go in blocks too. Each pair of blocks is one row of a table join, bounded in size, so
neither the vectors nor the queries are ever whole in one place.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, BLOCK, QUERY_BLOCK, LEVELS = 20, 4096, 512, 4
_EXACT, _MOST = 2.0**53, 2**63 - 1


def whole_components(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vector): components as floor(scale * x); unusable vectors and null ids are left out."""
    x = F.col(vector_col)
    good = x.isNotNull() & F.col(id_col).isNotNull()
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(good & fine).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("vector"),
    )


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows of at most about ``size`` vectors: (name, ids, vectors)."""
    n = rows.count()
    parts = max(1, -(-n // size))
    return (
        rows.withColumn(name, F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int"))
        .groupBy(name)
        .agg(F.sort_array(F.collect_list(F.struct("id", "vector"))).alias("rows"))
        .select(name, F.col("rows.id").alias(f"{name}_ids"), F.col("rows.vector").alias(f"{name}_rows"))
    )


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def segments(v: np.ndarray, levels: int = LEVELS) -> list[tuple[int, np.ndarray]]:
    """(greatest size, sizes) of each level, largest first; sizes hold 0 outside the level."""
    size = np.abs(v)
    top = int(size.max(initial=0))
    edges = sorted({top * 2**i // 2 ** (levels - 1) for i in range(levels)} | {top}, reverse=True)
    edges = [e for e in edges if e > 0]
    cut = [*edges[1:], 0]
    return [(high, np.where((size > low) & (size <= high), v, 0)) for high, low in zip(edges, cut)]


def block_top(q: np.ndarray, v: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places in ``v`` of its possible members and their exact scores.

    ``own`` is true where a vector is the query's own and takes no part.
    """
    if q.size and v.size and q.shape[1] * float(np.abs(q).max()) * float(np.abs(v).max()) >= _EXACT:
        scores = [sum(int(a) * b.astype(object) for a, b in zip(row, v.T)) for row in q]  # beyond doubles
        scores = [np.array([min(max(x, -_MOST), _MOST) for x in s], np.int64) for s in scores]
        return [(np.flatnonzero(~own[i]), s[~own[i]]) for i, s in enumerate(scores)]
    up, down = np.maximum(q, 0).astype(float), np.maximum(-q, 0).astype(float)
    parts = segments(v)
    reach = (up + down).sum(1)
    upper = np.zeros((len(q), len(v)))
    members, known = [None] * len(q), np.full(len(q), -np.inf)
    open_ = np.arange(len(q))
    rounds = [(sign, high, part) for sign, order in ((1, parts), (-1, parts)) for high, part in order]
    for r, (sign, _, part) in enumerate(rounds):
        plus, minus = np.maximum(part, 0).astype(float), np.maximum(-part, 0).astype(float)
        if sign > 0:  # what adds: like signs
            upper[open_] += up[open_] @ plus.T + down[open_] @ minus.T
        else:
            upper[open_] -= up[open_] @ minus.T + down[open_] @ plus.T
        still = rounds[r + 1][1] if r + 1 < len(rounds) and rounds[r + 1][0] > 0 else 0
        if sign > 0 and still:
            continue  # sums without the smaller levels bound nothing yet
        gone = []
        for i in open_:
            bound = np.where(own[i], -np.inf, upper[i] + still * reach[i])
            n = min(k, int((~own[i]).sum()))
            if not n:
                members[i] = np.zeros(0, np.int64)
                gone.append(i)
                continue
            if known[i] == -np.inf:  # a floor: exact scores of the most promising
                best = np.argpartition(-bound, n - 1)[:n]
                known[i] = (v[best] @ q[i]).min()
            can = np.flatnonzero(bound >= known[i])
            if len(can) <= max(4 * k, len(v) // 64) or r + 1 == len(rounds):
                members[i] = can
                gone.append(i)
        open_ = np.setdiff1d(open_, gone, assume_unique=True)
        if not len(open_):
            break
    return [(m, v[m] @ q[i]) for i, m in enumerate(members)]


def _searcher(k: int):
    def search(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for pair in frame.itertuples(index=False):
                width = max(map(len, [*pair.q_rows, *pair.v_rows]), default=0)
                q, v = _matrix(pair.q_rows, width), _matrix(pair.v_rows, width)
                ids, wanted = np.asarray(pair.v_ids), np.asarray(pair.q_ids)
                out = []
                for i, (at, score) in enumerate(block_top(q, v, wanted[:, None] == ids[None, :], k)):
                    order = np.lexsort((ids[at], -score))[:k]
                    out.append(pd.DataFrame({"query_id": wanted[i], "copy": i, "vec_id": ids[at][order], "score": score[order].astype(np.int64)}))
                yield pd.concat(out) if out else pd.DataFrame(columns=["query_id", "copy", "vec_id", "score"])

    return search


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = K,
    scale: int = 64,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's ``k`` highest inner products.

    Queries are the rows whose id is divisible by ``every``; candidates all rows with another
    id; ties go to the smaller id. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part. A shorter vector counts as filled up
    with zeros, an empty one scores 0. Scores and components beyond 64 bits become the last such number. Where rows repeat an id each is a candidate; queries that
    repeat an id are answered once for each different vector, as further ranks 1 to ``k``.
    Other columns are not read; no rows give no rows.
    """
    whole = whole_components(vectors, id_col, vector_col, scale)
    asked = blocks(whole.where(F.col("id") % every == 0).distinct(), query_block, "q")
    index = blocks(whole, block, "v")
    pairs = index.hint("shuffle_replicate_nl").crossJoin(asked).repartition("q", "v")
    found = pairs.select("q", "q_ids", "q_rows", "v", "v_ids", "v_rows").mapInPandas(
        _searcher(k), "query_id long, copy long, vec_id long, score long"
    )
    by = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
