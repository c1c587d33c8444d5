"""Near copies by BagMinHash: weighted signatures, banding, exact multiset overlap.

A document is the multiset of its runs of five words, weight = count. Its signature holds,
for each of ``slots`` places, the first arrival of a Poisson process over (run, weight level,
place). The weights are discretised at whole numbers; levels hang together in blocks [0,1),
[1,2), [2,4), [4,8) ..., each with one process of the block's rate whose points fall to a
level by halving the block. A document takes the points below its weight, so two documents
agree in a place with probability equal to their weighted Jaccard similarity, without bias.
Only arrivals below a bound are drawn, and the bound doubles until every place is filled.

Each place is kept as 8 bits and six places are one whole number. The first 36 of these are
bands, that is buckets; the rest only sharpen the signature. A bucket's members are compared
with one of them, in rounds with changing members, until few pairs of one bucket in two
classes are open. These are then compared each, in the first bucket that they share: by their
lengths and signatures, of which pairs under 0.8 by 3.5 deviations are left, and the rest by
their texts. So each pair that shares a bucket is compared or in one class already, and
no group of copies is expanded into its pairs. A pair at similarity 0.8 misses
all 36 bands with probability 2e-5. Every comparison is the exact overlap of multisets.
"""

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.graph import components
from dayledger.llm.words import GOLDEN, hashes, mix, pieces_of_batches, shingles, words_of
from dayledger.session import bound_batches, write_and_reread

BANDS, ROWS, SIMILARITY, RUN = 36, 6, 0.8, 5
#: Bands' worth of places in a signature, over those that are buckets.
MORE = 1.5
_U = np.uint64


def bag_signatures(element, weight, doc, n_docs: int, slots: int) -> np.ndarray:
    """Signatures (n_docs x slots) of weighted sets given as flat arrays.

    ``element`` 64-bit hashes, ``weight`` whole numbers from 1, ``doc`` row numbers. A row
    without elements stays infinite everywhere.
    """
    seed, rate, start, bag, limit = [], [], [], [], []
    block, low, width = 0, 0, 1
    left = np.arange(len(element))
    while len(left):
        seed.append(mix(element[left] + GOLDEN * np.full(1, block + 1, _U)))
        rate.append(np.full(len(left), float(width)))
        start.append(np.full(len(left), low))
        bag.append(doc[left])
        limit.append(weight[left])
        low, width, block = low + width, max(1, low + width), block + 1
        left = left[weight[left] > low]
    out = np.full(n_docs * slots, np.inf)
    if not seed:
        return out.reshape(n_docs, slots)
    seed, rate, start, bag, limit = map(np.concatenate, (seed, rate, start, bag, limit))
    total = np.bincount(doc, weight, n_docs)
    bound = slots / np.maximum(total, 1) * (np.log(slots) + 3)
    turn = np.zeros(len(seed), _U)
    bits = mix(seed + GOLDEN)
    at = -np.log(((bits >> _U(11)) + 0.5) * 2.0**-53) / rate
    waiting = np.arange(len(seed))
    while len(waiting):
        now = waiting[at[waiting] <= bound[bag[waiting]]]
        while len(now):
            place = mix(seed[now] ^ (turn[now] * _M3 + _M4))
            slot = ((place >> _U(32)) * _U(slots)) >> _U(32)
            level = (((place & _U(0xFFFFFFFF)) * rate[now].astype(_U)) >> _U(32)).astype(np.int64)
            mine = start[now] + level < limit[now]
            here = now[mine]
            np.minimum.at(out, bag[here] * slots + slot[mine].astype(np.int64), at[here])
            turn[now] += _U(1)
            bits = mix(seed[now] + GOLDEN * (turn[now] + _U(1)))
            at[now] -= np.log(((bits >> _U(11)) + 0.5) * 2.0**-53) / rate[now]
            now = now[at[now] <= bound[bag[now]]]
        short = out.reshape(n_docs, slots).max(axis=1) == np.inf
        bound[short] *= 2
        waiting = waiting[short[bag[waiting]]]
    return out.reshape(n_docs, slots)


_M3, _M4 = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)


def packed(signature: np.ndarray, rows: int) -> np.ndarray:
    """Whole numbers of ``rows`` places (6 at most) each, 8 bits a place under the number's index.

    Two documents without anything in common agree in one of them by chance 2^(-8 * rows).
    """
    n, slots = signature.shape
    bits = (mix(np.ascontiguousarray(signature).view(_U)) & _U(0xFF)).reshape(n, slots // rows, rows)
    out = np.broadcast_to(np.arange(slots // rows, dtype=_U) << _U(48), bits.shape[:2]).copy()
    for j in range(rows):
        out |= bits[:, :, j] << _U(8 * j)
    return out.view(np.int64)


def bags(lists: list[list[str]], run: int):
    """Flat (element, weight, doc) of the rows' multisets of runs."""
    element, weight, doc = [], [], []
    for i, words in enumerate(lists):
        e, w = np.unique(shingles(hashes(words), run), return_counts=True)
        element.append(e)
        weight.append(w)
        doc.append(np.full(len(e), i))
    if not element:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(element), np.concatenate(weight), np.concatenate(doc)


def _lists(values: np.ndarray, total: np.ndarray) -> pa.Array:
    """A list for each row; an empty one where the total is 0."""
    ends = np.concatenate(([0], np.cumsum((total > 0) * values.shape[1]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[total > 0].ravel()))


def _signer(slots: int, rows: int, run: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lists in pieces_of_batches(batches, "text"):
            element, weight, doc = bags(lists, run)
            total = np.bincount(doc, weight, len(lists)).astype(np.int64)
            signature = packed(bag_signatures(element, weight, doc, len(lists), slots), rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("id"), _lists(signature, total), pa.array(total)],
                ["k", "id", "places", "total"],
            )

    return sign


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets given as sorted arrays of hashes."""
    if not len(a) or not len(b):
        return 0.0
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both)


def _verifier(similarity: float, run: int):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            u, v, s = [], [], []
            for x, p, mine, other in zip(*(batch.column(c) for c in ("x", "p", "x_text", "p_text"))):
                p = p.as_py()
                if p != last:
                    last, kept = p, shingles(hashes(words_of(other.as_py())), run)
                own = shingles(hashes(words_of(mine.as_py())), run)
                if min(len(own), len(kept)) < similarity * max(len(own), len(kept)):
                    continue
                found = overlap(own, kept)
                if found >= similarity:
                    u.append(x.as_py())
                    v.append(p)
                    s.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                ["u", "v", "similarity"],
            )

    return verify


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    ).where(F.col("text").isNotNull())


def _verified(pairs: DataFrame, held: DataFrame, similarity: float, run: int) -> DataFrame:
    """Links among pairs (x, x_id, p, p_id) of texts (n, id, text)."""
    mine = held.select(F.col("n").alias("x"), F.col("id").alias("x_id"), F.col("text").alias("x_text"))
    other = held.select(F.col("n").alias("p"), F.col("id").alias("p_id"), F.col("text").alias("p_text"))
    both = (
        pairs.alias("a")
        .join(
            mine.alias("b"),
            (F.col("a.x") == F.col("b.x")) & F.col("a.x_id").eqNullSafe(F.col("b.x_id")),
        )
        .select("a.x", "a.p", "a.p_id", "b.x_text")
        .alias("a")
        .join(
            other.alias("b"),
            (F.col("a.p") == F.col("b.p")) & F.col("a.p_id").eqNullSafe(F.col("b.p_id")),
        )
        .select("a.x", "a.p", "a.x_text", "b.p_text")
    )
    return both.mapInArrow(_verifier(similarity, run), "u long, v long, similarity double")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    similarity: float = SIMILARITY,
    run: int = RUN,
) -> DataFrame:
    """One row per document: its id, ``class_id`` and whether it is the one that stays.

    A class is what links of ``similarity`` or more connect; ``class_id`` is its least id.
    Equal texts are one class whatever their length. Texts without a word are linked with
    equal texts only; rows with a null text are classes of their own (``class_id`` = the id,
    ``stays`` true). Texts of fewer than ``run`` words count as one run. A null id is the
    greatest. Rows that repeat an id stand for one document: all of them get the class of
    their own text. ``stays`` is true on one row of a class, or on each of several
    rows that are equal in id and text. Other columns are not read; no rows give no rows.
    """
    nodes, classes = _classes(docs, id_col, text_col, bands, rows, similarity, run)
    table = (
        nodes.select("k", F.col("id").alias("own_id"))
        .join(classes, "k", "left")
        .select("k", F.coalesce("class_id", "own_id").alias("class_id"), "own_id")
    )
    whole = docs.select(F.col(id_col).alias("id"), _key(F.col(text_col).cast("string")).alias("k")).join(
        table, "k", "left"
    )
    alone, least = F.col("k").isNull(), F.col("own_id").eqNullSafe(F.col("class_id"))
    return whole.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        (alone | (F.col("id").eqNullSafe(F.col("class_id")) & least)).alias("stays"),
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    similarity: float = SIMILARITY,
    run: int = RUN,
    once: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``near_duplicates``.

    With ``once`` rows that are equal in id and text are one document too, null ids among
    them: the row with the least hash of all its columns stays. Rows with a null text all stay.
    """
    nodes, classes = _classes(docs, id_col, text_col, bands, rows, similarity, run)
    stay = (
        nodes.select("k", F.col("id").alias("own_id"))
        .join(classes, "k", "left")
        .where(F.coalesce("class_id", "own_id").eqNullSafe(F.col("own_id")))
        .select("k", "own_id")
    )
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(
        own.alias("all"), F.col(id_col).cast("long").alias("id"), _key(F.col(text_col).cast("string")).alias("k")
    )
    same = (keyed["k"] == stay["k"]) & keyed["id"].eqNullSafe(stay["own_id"])
    kept = keyed.join(stay, same, "left_semi")
    if once:
        counted = keyed.where("k is not null").groupBy("k", "id").agg(F.count("*").alias("n"))
        again = write_and_reread(counted.where("n > 1").select(F.col("k").alias("k2"), F.col("id").alias("id2")), "repeated-rows")
        repeats = (F.col("k") == F.col("k2")) & F.col("id").eqNullSafe(F.col("id2"))
        one = (
            kept.join(again, repeats, "left_semi")
            .groupBy("k", "id")
            .agg(F.min_by("all", F.xxhash64("all")).alias("all"))
            .select("all", "id", "k")
        )
        kept = kept.join(again, repeats, "left_anti").union(one)
    return kept.union(keyed.where("k is null")).select("all.*")


def _classes(docs, id_col, text_col, bands, rows, similarity, run) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (n, k, id, places, total), and (k, class_id) of those linked with another text."""
    if rows > 6:
        raise ValueError("a band has six places at most")
    bound_batches(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    slots = int(MORE * bands) * rows
    signed = texts.select(_key(F.col("text")).alias("k"), "id", "text").mapInArrow(
        _signer(slots, rows, run), "k binary, id long, places array<long>, total long"
    )
    nodes = write_and_reread(
        signed.groupBy("k")
        .agg(F.min("id").alias("id"), F.first("places").alias("places"), F.first("total").alias("total"))
        .select(F.xxhash64("k").alias("n"), "k", "id", "places", "total"),
        "texts",
    )
    members = nodes.select(
        F.col("n").alias("x"), F.col("id").alias("x_id"), F.explode(F.slice("places", 1, bands)).alias("bucket")
    )
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    crowded = write_and_reread(members.join(sizes, "bucket"), "buckets")
    degrees = crowded.groupBy("x").agg(F.sum("size").alias("degree"))
    crowded = write_and_reread(crowded.join(degrees, "x").select("bucket", "x", "x_id", "degree"), "buckets")
    wanted = crowded.select(F.col("x").alias("n"), F.struct("x_id").alias("key")).distinct()
    held = texts.select(F.xxhash64(_key(F.col("text"))).alias("n"), F.struct(F.col("id").alias("x_id")).alias("key"), "text")
    held = write_and_reread(held.join(wanted, ["n", "key"]).select("n", F.col("key.x_id").alias("id"), "text"), "candidates")
    alike = similarity * slots - 3.5 * (similarity * (1 - similarity) * slots) ** 0.5
    first = _linked(crowded, held, nodes.select(F.col("n").alias("x"), "places", "total"), slots - alike, similarity, run)
    named = nodes.select("n", "k", "id").join(first, nodes["n"] == first["node"], "inner")
    least = named.groupBy("label").agg(F.min("id").alias("class_id"))
    classes = write_and_reread(named.join(least, "label").select("k", "class_id"), "classes")
    return nodes, classes


def _linked(
    crowded: DataFrame, held: DataFrame, signatures: DataFrame, unlike: float, similarity: float, run: int
) -> DataFrame:
    """(node, label) of all texts that verified links connect.

    In each round every bucket of two or more classes picks a member and compares it with the
    members of other classes: first the one that shares most buckets with others, as the
    original of edited copies does, then by a draw that favours such members. Rounds go on
    while they settle a third of the open pairs; then the open pairs that are left, members of
    one bucket in two classes, are all compared: by the signatures inside the join, and word
    by word if at most ``unlike`` places differ.
    """
    spark = crowded.sparkSession
    links = spark.createDataFrame([], "u long, v long, similarity double")
    classes = spark.createDataFrame([], "node long, label long")
    open_pairs = None
    for turn in count():
        named = write_and_reread(
            crowded.join(classes.withColumnRenamed("node", "x"), "x", "left").select(
                "bucket", "x", "x_id", "degree", F.coalesce("label", "x").alias("c")
            ),
            "classes",
        )
        mixed = _mixed(named)
        before, open_pairs = open_pairs, mixed.agg(F.coalesce(F.sum("open"), F.lit(0))).first()[0]
        if not open_pairs:
            return classes
        last = before is not None and 3 * open_pairs > 2 * before
        pairs = _rest(named, mixed, signatures, unlike, similarity) if last else _to_pivot(named, mixed, turn)
        more = write_and_reread(_verified(pairs, held, similarity, run), "links")
        links = links.union(more)
        classes = components(links.select("u", "v"))
        if last:
            return classes


def _mixed(named: DataFrame) -> DataFrame:
    """Buckets of several classes: their largest class and number of open pairs."""
    sizes = named.groupBy("bucket", "c").agg(F.count("*").alias("n"))
    square = F.col("n") * F.col("n")
    return (
        sizes.groupBy("bucket")
        .agg(
            F.max_by("c", F.col("n")).alias("large"),
            F.count("*").alias("classes"),
            ((F.sum("n") * F.sum("n") - F.sum(square)) / 2).alias("open"),
        )
        .where("classes > 1")
    )


def _to_pivot(named: DataFrame, mixed: DataFrame, turn: int) -> DataFrame:
    """Each member of a mixed bucket with the bucket's pivot, if in another class."""
    inside = named.join(mixed.select("bucket"), "bucket", "left_semi")
    draw = F.pmod(F.xxhash64(F.lit(turn), "x"), F.lit(1000)) / 1000 if turn else F.lit(1.0)
    pivot = inside.groupBy("bucket").agg(
        F.max(F.struct((F.col("degree") * draw).alias("w"), "x", "x_id", "c")).alias("p")
    )
    return (
        inside.join(pivot, "bucket")
        .where(F.col("c") != F.col("p.c"))
        .select("x", "x_id", F.col("p.x").alias("p"), F.col("p.x_id").alias("p_id"))
        .distinct()
    )


def _rest(named: DataFrame, mixed: DataFrame, signatures: DataFrame, unlike: float, similarity: float) -> DataFrame:
    """Open pairs that may be links: each member outside its bucket's largest class with those
    of other classes, in the first bucket that the two share."""
    inside = named.join(mixed.select("bucket", "large"), "bucket").join(signatures, "x")
    outside = inside.where("c <> large").select(
        "bucket", *(F.col(c).alias(f"y_{c}") for c in ("x", "x_id", "c", "places", "total"))
    )
    place_in_list = F.shiftright("bucket", 48) + 1
    first = F.array_position(F.zip_with("places", "y_places", lambda a, b: a == b), F.lit(True)) == place_in_list
    differ = F.aggregate(
        F.zip_with("places", "y_places", lambda a, b: a.bitwiseXOR(b)), F.lit(0), lambda n, d: n + _bytes_set(d)
    )
    lengths = F.least("total", "y_total") >= similarity * F.greatest("total", "y_total")
    return (
        inside.join(outside, "bucket")
        .where(F.expr("c <> y_c and (c = large or x < y_x)") & lengths & first & (differ <= unlike))
        .select(
            F.col("y_x").alias("x"), F.col("y_x_id").alias("x_id"), F.col("x").alias("p"), F.col("x_id").alias("p_id")
        )
    )


def _bytes_set(d: Column) -> Column:
    """How many of the eight bytes of ``d`` are not 0."""
    for n in (4, 2, 1):
        d = d.bitwiseOR(F.shiftrightunsigned(d, n))
    return F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))
