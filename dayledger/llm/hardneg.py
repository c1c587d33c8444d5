"""Hard negatives by pruning on lengths and coordinates, after the LEMP family of joins.

The index deals all vectors into buckets of like length (each a tenth longer than the one
before) and each bucket into blocks of bounded size. A block holds, for every coordinate, the order of its
vectors by that coordinate of the unit vector. It is built once and written.

An anchor looks for the best scores within bands (one band for its positives; one for each
positive for the negatives). A band's floor is its lower end, or its k-th best score so far if
that is higher. If the floor is over the anchor's length times the block's greatest, the block
is left out, before it moves anywhere. Else floor / (both lengths) bounds the cosine from
below, and with it the values that a vector may have at the anchor's focus coordinates, those
where the anchor is largest: the stretches of the sorted lists between these values are
intersected, and what is in all of them is scored exactly.

Blocks are taken in rounds of one, seven, fifty-six ... per bucket; after each the floors rise
for the next. A round is a join of anchor blocks and index blocks on their numbers: a stated
query set against all rows, in blocks. Rounds grow eightfold, so there are few.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.session import write_and_reread

BLOCK, ANCHORS, FOCUS, GROWTH, RATIO = 4096, 512, 4, 8, 1.1
_EXACT, _MOST, _SLACK = 2.0**53, 2**63 - 1, 1e-9
_INDEX = "block int, n int, most double, rows binary, ids binary, labels binary, data binary, orders binary"
_FOUND = "row long, band int, other long, other_id long, score long"


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, id, label, vector, size), written: whole components, a number for each row, the vector's length."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = (
        vectors.where(x.isNotNull() & F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fine)
        .select(
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("long").alias("label"),
            F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("vector"),
        )
        .withColumn("row", F.monotonically_increasing_id())
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return write_and_reread(whole.withColumn("size", F.sqrt(square)), "vectors")


def _matrix(lists, width: int) -> np.ndarray:
    """Rows of whole numbers; a shorter one is filled up with zeros."""
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.sqrt((v.astype(float) ** 2).sum(-1, keepdims=True))
    return v / np.where(size > 0, size, 1)


def _pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: its vectors and, for each coordinate, their order by it."""
    v = _matrix(frame["vector"].tolist(), max(map(len, frame["vector"])))
    orders = np.argsort(_unit(v), axis=0, kind="stable").T.astype("<u4")
    longs = lambda c: frame[c].to_numpy().astype("<i8").tobytes()
    return pd.DataFrame(
        {
            "block": [key[0]], "n": [len(v)], "most": [float(frame["size"].max())],
            "rows": [longs("row")], "ids": [longs("id")], "labels": [longs("label")],
            "data": [v.astype("<i8").tobytes()], "orders": [orders.tobytes()],
        }
    )


class Index:
    """The written blocks, numbered so that each round's are one stretch of numbers."""

    def __init__(self, rows: DataFrame, block: int = BLOCK):
        spark = rows.sparkSession
        level = F.when(F.col("size") > 0, F.floor(F.log("size") / F.lit(math.log(RATIO)))).otherwise(-1)
        rows = rows.withColumn("level", level.cast("int"))
        counts = rows.groupBy("level").count().collect()  # lengths lie within 64 bits: under 600 levels
        parts = {r["level"]: max(1, -(-r["count"] // block)) for r in counts}
        self.rounds, firsts, number, low = [], [], 0, 0
        while any(p > low for p in parts.values()):
            high = max(1, low * GROWTH)
            start = number
            for at, p in sorted(parts.items(), reverse=True):  # the longest first
                if p > low:
                    firsts.append((at, low, min(p, high), p, number))
                    number += min(p, high) - low
            self.rounds.append((start, number - 1))
            low = high
        dealt = rows.join(
            F.broadcast(spark.createDataFrame([(a, p) for a, p in parts.items()], "level int, parts int")), "level"
        ).withColumn("salt", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
        places = spark.createDataFrame(firsts, "level int, low int, high int, parts int, first int").drop("parts")
        numbered = dealt.join(F.broadcast(places), "level").where("salt >= low AND salt < high")
        blocks = numbered.withColumn("block", F.expr("first + salt - low"))
        self.table = write_and_reread(blocks.groupBy("block").applyInPandas(_pack, _INDEX), "index")

    def of_round(self, n: int) -> DataFrame:
        first, last = self.rounds[n]
        return self.table.where(F.col("block").between(first, last))


class Block:
    """One index block as a task sees it."""

    def __init__(self, row):
        self.rows, self.ids, self.labels = (np.frombuffer(x, "<i8") for x in (row.rows, row.ids, row.labels))
        self.data = np.frombuffer(row.data, "<i8").reshape(row.n, -1)
        self.orders = np.frombuffer(row.orders, "<u4").reshape(-1, row.n)
        self.most, self.unit, self.lists = row.most, _unit(self.data), {}
        self.top = float(np.abs(self.data.astype(float)).max(initial=0))
        self.real = self.data.astype(float)

    def sorted_list(self, f: int) -> np.ndarray:
        if f not in self.lists:
            self.lists[f] = self.unit[self.orders[f], f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, floor: float, focus: int) -> np.ndarray:
        """Places of all vectors that can score ``floor`` with ``q``, and some that cannot."""
        width = min(len(q), self.data.shape[1])
        size = float(np.sqrt((q.astype(float) ** 2).sum()))
        if floor > size * self.most * (1 + _SLACK):
            return np.zeros(0, np.int64)
        if floor <= 0 or not width:
            return np.arange(len(self.rows))
        t = min(1.0, floor / (size * self.most) * (1 - _SLACK))
        best = np.argsort(-np.abs(q[:width]), kind="stable")[:focus]
        ranges = []
        for f in best:
            c = q[f] / size
            spread = math.sqrt(max(0.0, (1 - c * c) * (1 - t * t))) + _SLACK
            low, high = c * t - spread if c > -t else -1.0, c * t + spread if c < t else 1.0
            values = self.sorted_list(f)
            a, b = np.searchsorted(values, low - _SLACK), np.searchsorted(values, high + _SLACK, "right")
            ranges.append((b - a, f, a, b, low - _SLACK, high + _SLACK))
        ranges.sort()
        _, f, a, b, _, _ = ranges[0]
        at = self.orders[f, a:b].astype(np.int64)
        for _, f, _, _, low, high in ranges[1:]:
            x = self.unit[at, f]
            at = at[(x >= low) & (x <= high)]
        return at

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products, held at 64 bits."""
        width = min(len(q), self.data.shape[1])
        if width * self.top * float(np.abs(q.astype(float)).max(initial=0)) < _EXACT:
            return (self.real[at, :width] @ q[:width].astype(float)).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(self.data[i, :width], q[:width])) for i in at]
        return np.array([min(max(s, -_MOST), _MOST) for s in exact], np.int64)


def _searcher(k: int, same: bool, focus: int):
    def search(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for pair in frame.itertuples(index=False):
                block, out = Block(pair), []
                for a in pair.anchors:
                    q, lows, highs = np.asarray(a["vector"], np.int64), a["floors"], a["highs"]
                    bands = [b for b in range(len(lows)) if lows[b] <= highs[b]]
                    if not bands:
                        continue
                    at = block.candidates(q, float(min(lows[b] for b in bands)), focus)
                    at = at[((block.labels[at] == a["label"]) == same) & (block.rows[at] != a["row"])]
                    score = block.scores(q, at)
                    for b in bands:
                        fits = np.flatnonzero((score >= lows[b]) & (score <= highs[b]))
                        best = fits[np.lexsort((block.rows[at[fits]], block.ids[at[fits]], -score[fits]))[:k]]
                        out.append(pd.DataFrame({"row": a["row"], "band": b, "other": block.rows[at[best]], "other_id": block.ids[at[best]], "score": score[best]}))
                yield pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _FOUND.split(", ")])

    return search


def banded_top(anchors: DataFrame, index: Index, k: int, same: bool, anchors_block: int = ANCHORS, focus: int = FOCUS) -> DataFrame:
    """(row, band, rank, other_id, score): each anchor's ``k`` best of each band, ties to the smaller id.

    ``anchors``: row, label, vector, size and the bands' inclusive ends ``lows`` and ``highs``. Others are rows of the
    same label, or of different ones, and never the anchor's own row.
    """
    best = None
    order = Window.partitionBy("row", "band").orderBy(F.desc("score"), "other_id", "other")
    parts = max(1, -(-anchors.count() // anchors_block))
    for n, (first, last) in enumerate(index.rounds):
        floors = F.col("lows")
        known = anchors
        if best is not None:
            kth = best.groupBy("row", "band").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k)
            kth = kth.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("band", "floor"))).alias("kth"))
            known = anchors.join(kth, "row", "left")
            risen = lambda low, b: F.coalesce(F.try_element_at("kth", b), low)
            floors = F.when(F.col("kth").isNull(), F.col("lows")).otherwise(F.transform("lows", risen))
        known = known.withColumn("floors", floors).withColumn("q", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
        least = F.when(F.col("size") > 0, F.array_min("floors") / F.col("size"))
        packed = known.groupBy("q").agg(
            F.min(F.coalesce(least, F.lit(float("-inf")))).alias("least"),
            F.sort_array(F.collect_list(F.struct("row", "label", "vector", "floors", "highs"))).alias("anchors"),
        )
        packed = write_and_reread(packed, "anchors")
        blocks = index.of_round(n)
        pairs = packed.select("q", "least", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("block")).join(
            blocks.select("block", "most"), "block"
        )
        pairs = pairs.where(F.col("least") <= F.col("most") * (1 + _SLACK)).select("block", "q")
        met = blocks.join(pairs, "block").join(packed.select("q", "anchors").join(pairs, "q"), ["block", "q"])
        found = met.mapInPandas(_searcher(k, same, focus), _FOUND)
        found = found if best is None else found.union(best)
        best = write_and_reread(
            found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"), "best"
        )
    if best is None:
        best = anchors.sparkSession.createDataFrame([], _FOUND)
    return best.withColumn("rank", F.row_number().over(order)).drop("other")


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    scale: int = 256,
    block: int = BLOCK,
    anchors_block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. A score is the inner product of
    floor(scale * x); higher ones come first, ties by smaller id. An anchor's positives are its first
    ``positives`` other rows of its label. For each, the negatives are the first ``negatives`` rows of other
    labels that score between the ``percent`` of the positive's score; a negative positive score leaves
    none. Rows without id, label or vector, or with null or non-finite components, take no part; a shorter
    vector counts as filled up with zeros. Rows that repeat an id, or all they hold, are rows of their own,
    as anchors too. Scores and components beyond 64 bits become the last such number. Other columns are not
    read; no rows give no rows.
    """
    rows = prepared(vectors, id_col, vector_col, label_col, scale)
    index = Index(rows, block)
    asked = rows.where(F.col("id") % every == 0)
    one = asked.withColumns({"lows": F.array(F.lit(-_MOST)), "highs": F.array(F.lit(_MOST))})
    near = write_and_reread(banded_top(one, index, positives, True, anchors_block), "positives")
    score = F.col("score").cast("decimal(20,0)")
    ends = near.withColumn("low", F.ceil(score * percent[0] / 100).cast("long")).withColumn("high", F.floor(score * percent[1] / 100).cast("long"))
    ends = ends.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("bands"))
    banded = asked.join(ends, "row").select("*", F.col("bands.low").alias("lows"), F.col("bands.high").alias("highs")).drop("bands")
    found = banded_top(write_and_reread(banded, "banded"), index, negatives, False, anchors_block)
    positive = near.select("row", (F.col("rank") - 1).alias("band"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.join(positive, ["row", "band"])
        .join(asked.select("row", F.col("id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
