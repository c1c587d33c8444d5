"""Alignment of two tokenizers' tokens, and how often ids are linked in a corpus.

Both encode the same bytes, so a token is a stretch of bytes and known by its end. Where both
have an end the tokens fall into groups. Most groups are one to one: at index i on one side and
i + shift on the other the ends agree for a while. Such a stretch is jumped by comparing 16, 32,
64, ... ends at the current shift, halving at the first difference. What follows is an irregular group: the
side that is behind goes on until both ends meet, and the shift is what the indices differ by then.

Tokens whose bytes overlap are linked: there is one link for each different end. Links are counted in
two steps, so that no table of all links of all documents is ever dealt out by id: a block of
documents keeps the table of its own pairs, which are summed over the blocks, and the sums come
back to the block, whose documents look them up by place.
"""

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Tokenizer

from dayledger.llm.units import LONGEST, ranges, slices, units
from dayledger.session import write_and_reread

#: Characters of a block of documents, about; a longer text is a block of its own.
BLOCK = 1 << 21
#: Units that a tokenizer gets in one text.
TOGETHER = 256
#: Ends compared first; stretches shorter than this are walked.
PROBE = 16
_PAIR = 0xFFFFFFFF


def irregular(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Indices of the tokens, on each side, that are not the last of their group.

    ``a`` and ``b`` are rising ends of tokens over the same bytes.
    """
    inner_a, inner_b, n, i, shift = [], [], len(a), 0, 0
    a, b = [*a, -1], [*b, -2]  # differ behind the end
    while True:
        width = PROBE
        while a[i : i + width] == b[i + shift : i + shift + width]:
            i += width
            width *= 2
        while width > PROBE:
            width //= 2
            if a[i : i + width] == b[i + shift : i + shift + width]:
                i += width
        j = i + shift
        x, y = a[i], b[j]
        while x == y:
            i += 1
            j += 1
            x, y = a[i], b[j]
        if i == n:
            return inner_a, inner_b
        while x != y:
            if x < y:
                inner_a.append(i)
                i += 1
                x = a[i]
            else:
                inner_b.append(j)
                j += 1
                y = b[j]
        i += 1
        shift = j + 1 - i


def byte_characters() -> dict[str, int]:
    """The byte of each character that byte-level vocabularies write it with (visible ones as themselves)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Sides:
    """Both tokenizers, by units."""

    def __init__(self, a_path: str, b_path: str, size: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out, not the library
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        model = proto.ModelProto()
        with open(b_path, "rb") as file:
            model.ParseFromString(file.read())
        if model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("this model does not put one blank before the text as it is")
        model.normalizer_spec.add_dummy_prefix = False  # units bring the blank along
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        back = byte_characters()
        a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        if any(_crosses(b.decode("utf-8", "ignore")) for b in b_bytes):
            raise ValueError("a piece of this vocabulary goes on over the start of a unit")
        self.bytes_of = (a_bytes, b_bytes)
        self.sizes = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes_of)
        self.size = size
        self._forget()
        marks = [f"{i}{mark}" for mark in (",", "|") for i in range(len(a_bytes))] + [f"{i}{mark}" for mark in (",", ";") for i in range(len(b_bytes))]
        self.written = np.array(marks, object)

    def _ids(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        return ((x.ids, y) for x, y in zip(a, self.b.encode(texts, num_threads=1)))

    def _spelt(self, side: int, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of[side].__getitem__, ids))

    def _forget(self) -> None:
        #: unit -> its number; the tokens of all units one after the other, and where each unit's are
        self.known: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.counts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.starts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.bad = np.zeros(0, bool)

    def _add(self, new: list[str], ids: list[np.ndarray], counts: list[np.ndarray], bad: bool = False) -> None:
        self.known.update(zip(new, range(len(self.bad), len(self.bad) + len(new))))
        self.bad = np.concatenate((self.bad, np.full(len(new), bad)))
        for side in (0, 1):
            begins = len(self.flat[side]) + np.cumsum(counts[side]) - counts[side]
            self.starts[side] = np.concatenate((self.starts[side], begins))
            self.counts[side] = np.concatenate((self.counts[side], counts[side]))
            self.flat[side] = np.concatenate((self.flat[side], ids[side].astype(np.int32)))

    def _learn(self, new: list[str]) -> None:
        """Tokens of units; those that a side's tokens do not spell are marked."""
        whole = [u for u in new if u[0] in " \n" and not u[-1].isspace() and "▁" not in u and len(u) <= LONGEST]
        rows = [whole[i : i + TOGETHER] for i in range(0, len(whole), TOGETHER)]
        good, ids, counts = [], ([], []), ([], [])
        for row, sides in zip(rows, self._ids(list(map("".join, rows)))):
            ends, raw, found = np.cumsum([len(u.encode("utf-8", "replace")) for u in row]), "".join(row).encode("utf-8", "replace"), []
            for side, side_ids in enumerate(sides):
                side_ids = np.array(side_ids, np.int64)
                at = np.cumsum(self.sizes[side][side_ids])
                stops = np.searchsorted(at, ends) + 1
                if len(at) and at[-1] == ends[-1] and (at[stops - 1] == ends).all() and self._spelt(side, side_ids.tolist()) == raw:
                    found.append((side_ids, np.diff(stops, prepend=0)))
            if len(found) == 2:
                good += row
                for side, (side_ids, n) in enumerate(found):
                    ids[side].append(side_ids)
                    counts[side].append(n)
        if good:
            self._add(good, *([np.concatenate(x) for x in both_sides] for both_sides in (ids, counts)))
        rest = [u for u in new if u not in self.known]
        for u, sides in zip(rest, self._ids(rest)):
            spelt = all(self._spelt(side, x) == u.encode("utf-8", "replace") for side, x in enumerate(sides))
            sides = sides if spelt else ([], [])
            self._add([u], [np.array(x, np.int32) for x in sides], [np.array([len(x)]) for x in sides], not spelt)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, ...]]:
        """For each side (ids of all texts one after the other, tokens of each text)."""
        if len(self.known) > self.size or len(self.flat[0]) > 100 * self.size:
            self._forget()
        parts = [(i, units(part)) for i, text in enumerate(texts) if text for part in slices(" " + text)]
        wanted = [u for _, row in parts for u in row]
        numbers = list(map(self.known.get, wanted))
        new = list(dict.fromkeys([u for u, number in zip(wanted, numbers) if number is None]))
        if new:
            self._learn(new)
            numbers = [self.known[u] if number is None else number for u, number in zip(wanted, numbers)]
        numbers = np.array(numbers, np.int64)
        for u in new:
            if len(u) > LONGEST:
                del self.known[u]
        of = np.repeat(np.array([i for i, _ in parts], np.int64), [len(row) for _, row in parts])
        good = np.ones(len(texts), bool)
        good[of[self.bad[numbers]]] = False
        numbers, of = numbers[good[of]], of[good[of]]
        out = []
        for side in (0, 1):
            counts = self.counts[side][numbers]
            ends = np.cumsum(counts)
            at = np.repeat(self.starts[side][numbers] - (ends - counts), counts) + np.arange(counts.sum())
            out.append((self.flat[side][at], np.bincount(of, counts, len(texts)).astype(np.int64)))
        return out


def _crosses(piece: str) -> bool:
    return any(piece[i] in " \n" and not piece[i - 1].isspace() for i in range(1, len(piece)))


@lru_cache(maxsize=2)
def both(a_path: str, b_path: str) -> Sides:
    """One per worker process: what is known outlives a task."""
    return Sides(a_path, b_path)


class Aligned:
    """The aligned tokens of a block of texts."""

    def __init__(self, sides: Sides, texts: list[str | None]):
        (self.a, self.n_a), (self.b, self.n_b) = sides.encode(texts)
        self.sides = sides
        ends_a, ends_b = np.cumsum(sides.sizes[0][self.a]), np.cumsum(sides.sizes[1][self.b])
        self.last_a, self.last_b = np.ones(len(self.a), bool), np.ones(len(self.b), bool)
        inner_a, inner_b = irregular(ends_a.tolist(), ends_b.tolist())
        self.last_a[inner_a] = False
        self.last_b[inner_b] = False
        self.stops_a, self.stops_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        # the two sides' different ends: one link each
        ends = np.concatenate((ends_a[self.last_a], ends_a[~self.last_a], ends_b[~self.last_b]))
        ends.sort(kind="stable")
        self.link_a, self.link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.n_links = self.per_text(self.link_a, self.stops_a)
        self.n_groups = self.per_text(np.flatnonzero(self.last_a), self.stops_a)

    @staticmethod
    def per_text(places: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """How many of the rising token ``places`` each text has."""
        return np.diff(np.searchsorted(places, stops), prepend=0)

    def sizes(self, last: np.ndarray) -> np.ndarray:
        """Tokens of each group of one side."""
        return np.diff(np.flatnonzero(last), prepend=-1)

    def groups(self) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        first_b = np.concatenate(([0], np.flatnonzero(self.last_b) + 1))
        next_a = np.flatnonzero(self.last_a) + 1
        v_a, v_b = len(self.sides.bytes_of[0]), len(self.sides.bytes_of[1])
        kinds = np.empty(len(self.a) + len(self.b), np.int64)
        kinds[np.arange(len(self.a)) + first_b[group_a]] = self.a + v_a * self.last_a
        kinds[np.arange(len(self.b)) + next_a[group_b]] = 2 * v_a + self.b + v_b * self.last_b
        words, out, start = self.sides.written[kinds].tolist(), [], 0
        for stop in (self.stops_a + self.stops_b).tolist():
            out.append("".join(words[start:stop])[:-1])
            start = stop
        return out

    def pairs(self) -> tuple[np.ndarray, ...]:
        """(pair of each link as a << 32 | b, text of each link)."""
        pair = (self.a[self.link_a].astype(np.int64) << 32) | self.b[self.link_b]
        return pair, np.repeat(np.arange(len(self.n_links)), self.n_links)


def _split(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32), pa.int32()))


_INTS = T.ArrayType(T.IntegerType())
#: What ``align`` can give of a text, and its type.
COLUMNS = {
    "a_ids": _INTS, "b_ids": _INTS, "a_sizes": _INTS, "b_sizes": _INTS, "link_a": _INTS, "link_b": _INTS,
    "groups": T.StringType(), "n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(),
}
#: The links in brief: a block's number, each text's places in the block's table of pairs (steps from one to the
#: next) and how often, and, at the block's first text, the table.
_BRIEF = {
    "block": T.LongType(), "steps": _INTS, "times": _INTS, "pairs": T.ArrayType(T.LongType()), "sums": T.ArrayType(T.LongType()),
}


def _column(name: str, x: Aligned) -> pa.Array:
    if name == "groups":
        return pa.array(x.groups(), pa.string())
    if name in ("n_a", "n_b", "n_groups", "n_links"):
        return pa.array(getattr(x, name), pa.int64())
    if name in ("a_ids", "b_ids"):
        return _split(getattr(x, name[0]), getattr(x, f"n_{name[0]}"))
    if name in ("a_sizes", "b_sizes"):
        return _split(x.sizes(getattr(x, f"last_{name[0]}")), x.n_groups)
    stops = getattr(x, f"stops_{name[-1]}")
    starts = np.repeat(np.concatenate(([0], stops))[: len(stops)], x.n_links)
    return _split(getattr(x, name) - starts, x.n_links)


def _brief(x: Aligned, block: int) -> list[pa.Array]:
    pair, text = x.pairs()
    place, table = pd.factorize(pair)
    sums = np.bincount(place, minlength=len(table))
    order = np.argsort(-sums, kind="stable")  # frequent ones first: small steps
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    width, n = max(1, len(table)), len(x.n_links)
    keys, times = np.unique(text * width + rank[place], return_counts=True)
    of, at = keys // width, keys % width
    steps = np.diff(at, prepend=0)
    steps[np.flatnonzero(np.diff(of, prepend=-1))] = at[np.flatnonzero(np.diff(of, prepend=-1))]
    counts = np.bincount(of, minlength=n)
    once = lambda values: pa.array([values] + [None] * (n - 1), pa.list_(pa.int64()))
    return [pa.array([block] * n, pa.int64()), _split(steps, counts), _split(times, counts), once(table[order]), once(sums[order])]


def align(
    docs: DataFrame, a_path: str, b_path: str, columns: Iterable[str] = COLUMNS, text_col: str = "text",
    keep: list[str] | None = None, brief: bool = False, block: int = BLOCK,
) -> DataFrame:
    """The rows of ``docs``, without their text, with ``columns`` of the alignment of each whole text.

    Side A is a byte-level BPE of the tokenizers library over blank + text, side B a sentencepiece model, which puts
    the blank itself. ``a_ids``, ``b_ids``: tokens; ``a_sizes``, ``b_sizes``: tokens of each group; ``link_a``,
    ``link_b``: places of linked tokens, in order; ``groups``: ``a1,a2|b1;a3|b2,b3``. Texts that are null or empty,
    or that the tokens of a side do not spell byte for byte, have no tokens: empty lists and strings, zeros. ``keep``: other columns to
    carry on (all); one named like a result is replaced. Repeated rows are aligned each; no rows give no rows. ``brief`` adds
    what ``link_weights`` needs. Paths are the same on every executor.
    """
    columns = list(columns)
    added = {c: COLUMNS[c] for c in columns} | (_BRIEF if brief else {})
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added and c != text_col]
    chosen = docs.select(*kept, F.col(text_col).cast("string").alias(text_col))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides, number = both(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, texts in ranges(batch.column(text_col), block):
                x = Aligned(sides, texts)
                part = batch.slice(start, len(texts))
                made = [_column(c, x) for c in columns] + (_brief(x, number) if brief else [])
                number += 1
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], [*kept, *added])

    schema = T.StructType([*chosen.select(*kept).schema.fields, *(T.StructField(c, kind) for c, kind in added.items())])
    return chosen.mapInArrow(rows, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, total, best): how many links hold each id pair linked, and if that is the most of its B id."""
    totals = _tables(blocks).groupBy("pair").agg(F.sum("n").alias("total"))
    totals = write_and_reread(totals.withColumn("b", F.col("pair").bitwiseAND(_PAIR)), "pair-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))  # no more rows than side B has ids
    return totals.join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _tables(blocks: DataFrame) -> DataFrame:
    pairs = blocks.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "sums")).alias("place", "x"))
    return pairs.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.sums").alias("n"))


def link_weights(brief: DataFrame) -> DataFrame:
    """Rows of ``align(..., brief=True)`` with n_best and count_sum in place of the links in brief.

    n_best: links whose pair is as frequent in all rows as any of its B id; count_sum: the sum over links of the
    pair's count in all rows. No links give zeros. The rows are written once to the shared folder.
    """
    blocks = write_and_reread(brief, "links")
    located = _tables(blocks).join(pair_counts(blocks), "pair")
    located = located.select(F.col("block").alias("of"), "place", "total", "best")
    rows = blocks.drop("pairs", "sums")
    kept = [c for c in rows.columns if c not in ("block", "steps", "times", "n_best", "count_sum")]

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right.num_rows
        total, best = np.zeros(n, np.int64), np.zeros(n, bool)
        at = right.column("place").to_numpy()
        total[at], best[at] = right.column("total").to_numpy(), right.column("best").to_numpy()
        left = left.combine_chunks()
        steps = left.column("steps").combine_chunks()
        counts = steps.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        places = np.cumsum(steps.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        before = np.concatenate(([0], places))[np.concatenate(([0], np.cumsum(counts)))[:-1]]
        places -= np.repeat(before, counts)
        times = left.column("times").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        stops = np.concatenate(([0], np.cumsum(counts)))
        per_row = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[stops])
        out = left.select(kept)
        out = out.append_column("n_best", pa.array(per_row(times * best[places]), pa.int64()))
        return out.append_column("count_sum", pa.array(per_row(times * total[places]), pa.int64()))

    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return rows.groupBy("block").cogroup(located.groupBy("of")).applyInArrow(look_up, schema)
