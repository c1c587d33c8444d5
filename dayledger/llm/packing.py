"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. The driver gets the number of pieces
of each length, at most ``capacity`` numbers however large the corpus, and packs counts
instead of documents: lengths fall, and all pieces of a length go, run by run, to the tightest
sequences that still take them. The plan says which ranks of a length go where; pieces find
their rank within their length and take the planned slot.

A rank is a row number within (length, salt) plus the count in smaller salts, so a length
that a third of all pieces share is numbered by many tasks.
"""

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayledger.llm.words import pieces_of_batches
from dayledger.session import bound_batches, write_and_reread

CAPACITY, END_ID, SALTS = 4096, 1, 64
#: Parted like white space by ``str.split`` but not by the vocabulary.
_CONTROL = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class WordIds(dict):
    """Bytes of the ids of a stretch without white space.

    The vocabulary file drops white space and never merges over it, so the ids of a text are
    those of its stretches in order. New stretches of many texts are encoded together by the
    library itself; past ``size`` known ones it starts anew, so memory stays bounded.
    """

    def __init__(self, path: str, size: int = 1_000_000):
        super().__init__()
        self.tokenizer, self.size = Tokenizer.from_file(path), size

    @staticmethod
    def stretches(text: str) -> list[str]:
        return _SPACE.split(text) if _CONTROL.search(text) else text.split()

    def learn(self, new: list[str]) -> None:
        ends = np.cumsum([len(s) + 1 for s in new])
        found = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        at = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
        cuts = np.searchsorted(np.searchsorted(ends, at, "right"), np.arange(len(new) + 1)).tolist()
        data = ids.tobytes()
        self.update(zip(new, (data[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:]))))

    def encode(self, lists: list[list[str]]) -> list[bytes]:
        if len(self) > self.size:
            self.clear()
        found = [list(map(self.get, words)) for words in lists]
        holes = [i for i, parts in enumerate(found) if None in parts]
        new = {s for i in holes for s, part in zip(lists[i], found[i]) if part is None}
        if new:
            self.learn(list(new))
        for i in holes:
            found[i] = map(self.__getitem__, lists[i])
        return [b"".join(parts) for parts in found]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker process: what is known outlives a task."""
    return WordIds(path)


def _cutter(path: str, capacity: int, end_id: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        for batch, lists in pieces_of_batches(batches, "text", split=ids.stretches):
            rows, piece, start, length, crc = [], [], [], [], []
            for i, whole in enumerate(ids.encode(lists)):
                whole += end
                for j in range(0, len(whole), 4 * capacity):
                    part = whole[j : j + 4 * capacity]
                    rows.append(i)
                    piece.append(j // (4 * capacity))
                    start.append(j // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
                + [pa.array(c, pa.int64()) for c in (piece, start, length, crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document with lengths and checksums; a null text is an empty one."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _cutter(path, capacity, end_id),
        docs.select("doc_id").schema.add("piece", "long").add("start", "long").add("length", "long").add(
            "ids_crc32", "long"
        ),
    )


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, end rank, first sequence, pieces a sequence, offset), sorted.

    Best fit by falling length: of the open sequences the fullest that takes a piece gets it,
    else a new one is opened. Equal sequences are runs of numbers, handled at once. The piece
    of rank r goes to sequence first + (r - first rank) // n at offset + (r - first rank) % n
    * length.
    """
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences
    rooms: list[int] = []
    rows, sequences = [], 0

    def put(room: int, first: int, end: int) -> None:
        if room and first < end:
            if room not in open_runs:
                insort(rooms, room)
            open_runs.setdefault(room, []).append((first, end))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                room, first, end = capacity, sequences, sequences + -(-(count - rank) // per)
                sequences = end
            else:
                room = rooms[at]
                first, end = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room], rooms[at]
            per = room // length
            full = min(end - first, (count - rank) // per)
            if full:
                rows.append((length, rank, rank + full * per, first, per, capacity - room))
                rank += full * per
                put(room - per * length, first, first + full)
                first += full
            if first < end and rank < count:  # fewer pieces left than one sequence takes
                rows.append((length, rank, count, first, per, capacity - room))
                put(room - (count - rank) * length, first, first + 1)
                rank, first = count, first + 1
            put(room, first, end)
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def _placer(planned: np.ndarray):
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(2**48)
        starts = planned[:, 0] * shift + planned[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = planned[np.searchsorted(starts, length * shift + rank, "right") - 1]
            turn = rank - row[:, 1]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(row[:, 3] + turn // row[:, 4]), pa.array(row[:, 5] + turn % row[:, 4] * length)],
                [*names, "sequence_id", "offset"],
            )

    return place


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, salts: int = SALTS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``path`` is the vocabulary file, at the same place on every executor. Every row of
    ``docs`` counts, so repeated ids and rows give pieces each; null and empty texts give one
    piece of the end id alone; a null ``doc_id`` is kept. Other columns are not read. No
    rows give no rows. Sequences have no gaps, and only the last piece of a long document may
    be shorter than ``capacity``.
    """
    cut = write_and_reread(pieces(docs, path, capacity, end_id), "pieces")
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))  # capacity x salts rows at most
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = counts.select(
        "length",
        "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
    )
    by = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("number", F.row_number().over(by))
        .join(before, ["length", "salt"])
        .select(*cut.columns, (F.col("before") + F.col("number") - 1).alias("rank"))
    )
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(_placer(plan(histogram, capacity)), schema)
