"""Encoding with a SentencePiece vocabulary by a max-plus parallel scan.

A text's encoding is the best path through the lattice of pieces (Viterbi), with byte pieces
for characters that the vocabulary lacks. A giant text is cut into chunks. A piece may reach
over a chunk's end, so a chunk is entered and left in a state: how many of its first
characters, or of those after it, are covered. Its transfer matrix holds the best score from each
state at its start to each state at its end. Matrices are combined associatively in the
max-plus sense, blocks of chunks in parallel and then the blocks of a text, which fixes the
states at every boundary; with them each chunk is traced back by itself.

No piece goes on over the start of a blank run or over a line feed, so the path passes
through there: words between are encoded once and remembered by the worker.
"""

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.llm.units import ranges
from dayledger.llm.words import GOLDEN
from dayledger.session import write_and_reread

CHUNK, BLOCK, NEVER = 32_768, 64, -(1 << 62)
#: Units of up to so many characters are encoded many at once, where there are so many new ones.
WIDE, MANY = 24, 100
_UNIT = re.compile(r"\n| *[^ \n]+| +")
_CUT = re.compile(r"(?<=[^ ])(?= )|(?=\n)|(?<=\n)")


class Vocabulary:
    """Pieces, scores and byte pieces of a model file.

    The file's scores are merge ranks, so a piece's log-probability is Zipf's for its rank. Scores are whole numbers (2^-16 nats) with a
    hash of the piece below them: sums are exact, and two paths practically never tie.
    """

    def __init__(self, path: str, size: int = 400_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        total = math.log(sum(1 / (r + 2.7) for r in range(n)))
        self.bytes_of, self.pieces, self.byte_ids = [b""] * n, {}, {}
        rank = 0
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
                self.byte_ids[self.bytes_of[i][0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = piece.replace("▁", " ")
                self.bytes_of[i] = plain.encode()
                self.pieces[plain] = (self._whole(-math.log(rank + 2.7) - total, i), i)
                rank += 1
        self.byte_score = -math.log(n + 2.7) - total - 10
        self.longest = max(map(len, self.pieces))
        self.starts = {p[:k] for p in self.pieces for k in range(1, len(p))}
        if any(_CUT.search(p) for p in self.pieces):
            raise ValueError("a piece of this vocabulary goes on over a blank or a line feed")
        self.size, self.known = size, {}
        self._grow()
        self.sizes = np.array([len(b) for b in self.bytes_of])
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    @staticmethod
    def _whole(score: float, i: int) -> int:
        return (round(score * 65536) << 12) + (xxhash.xxh32_intdigest(i.to_bytes(4, "little")) & 4095)

    def _grow(self) -> None:
        """The pieces as a trie: steps (node, character) -> node in a table with open addressing."""
        nodes: dict[str, int] = {"": 0}
        steps = []
        for piece in self.pieces:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    steps.append((nodes[piece[: k - 1]] << 21 | ord(piece[k - 1]), len(nodes) - 1))
        bits = (4 * len(steps)).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.step_key, self.step_to = np.full(1 << bits, -1), np.zeros(1 << bits, np.int32)
        key, to = np.array(steps).T
        for at, k, t in zip(self._slot(key).tolist(), key.tolist(), to.tolist()):
            while self.step_key[at] >= 0:
                at = (at + 1) & self.mask
            self.step_key[at], self.step_to[at] = k, t
        self.node_score, self.node_id = np.full(len(nodes), NEVER), np.full(len(nodes), -1, np.int32)
        for piece, (score, i) in self.pieces.items():
            self.node_score[nodes[piece]], self.node_id[nodes[piece]] = score, i

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes after ``char``, -1 where there is none."""
        key = node.astype(np.int64) << 21 | char
        at = self._slot(key)
        found = self.step_key[at]
        other = np.flatnonzero((found != key) & (found >= 0))
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            found[other] = self.step_key[at[other]]
            other = other[(found[other] != key[other]) & (found[other] >= 0)]
        return np.where(found == key, self.step_to[at], -1)

    def _many(self, units: list[str]) -> list[tuple[int, bytes]]:
        """As ``_unit`` for each of them, which have ``WIDE`` characters at most."""
        n = np.fromiter(map(len, units), np.int64, len(units))
        longest = int(n.max())
        chars = np.ascontiguousarray(np.array(units, f"U{longest}").view(np.uint32).reshape(len(units), longest).T.astype(np.int64))
        score = np.full((longest + 1, len(units)), NEVER)
        score[0] = 0
        start, piece = np.zeros(score.shape, np.int8), np.zeros(score.shape, np.int32)
        odd = np.zeros(len(units), bool)
        for p in range(longest):
            rows = np.flatnonzero((n > p) & ~odd)
            node, now = np.zeros(len(rows), np.int32), score[p, rows]
            for to in range(p + 1, min(p + self.longest, longest) + 1):
                if to > p + 1:
                    inside = n[rows] >= to
                    rows, node, now = rows[inside], node[inside], now[inside]
                node = self._step(node, chars[to - 1, rows])
                if to == p + 1:
                    odd[rows[(node < 0) | (self.node_id[node] < 0)]] = True
                known = node >= 0
                rows, node, now = rows[known], node[known], now[known]
                if not len(rows):
                    break
                total = now + self.node_score[node]
                better = total > score[to, rows]
                at = rows[better]
                score[to, at], start[to, at], piece[to, at] = total[better], p, self.node_id[node[better]]
        ids, used = np.zeros((len(units), longest), "<i4"), np.full(len(units), longest)
        rows = np.flatnonzero(~odd)
        place = n[rows]
        while len(rows):
            used[rows] -= 1
            ids[rows, used[rows]] = piece[place, rows]
            place = start[place, rows].astype(np.int64)
            rows, place = rows[place > 0], place[place > 0]
        data, ends = ids.tobytes(), 4 * longest * np.arange(1, len(units) + 1)
        starts = (ends - 4 * (longest - used)).tolist()
        out = [(s, data[i:j]) for s, i, j in zip(score[n, np.arange(len(units))].tolist(), starts, ends.tolist())]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._slow_unit(units[i])
        return out

    def _learn(self, units: Iterable[str]) -> None:
        """Remember those of ``units`` that are new."""
        known = self.known
        new = [u for u in dict.fromkeys(units) if u not in known]
        wide = [u for u in new if len(u) <= WIDE]
        if len(wide) >= MANY:
            known.update(zip(wide, self._many(wide)))
        for u in new:
            if u not in known:
                known[u] = self._unit(u)

    def edges(self, text: str, at: int, end: int) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """(next place, score, ids) of pieces that start at ``at``; there is always one."""
        first = self.pieces.get(text[at])
        if first:
            yield at + 1, first[0], (first[1],)
        else:
            ids = tuple(self.byte_ids[b] for b in text[at].encode())
            yield at + 1, len(ids) * self._whole(self.byte_score, ids[0]), ids
        for to in range(at + 2, min(at + self.longest, end) + 1):
            part = text[at:to]
            if found := self.pieces.get(part):
                yield to, found[0], (found[1],)
            if part not in self.starts:
                break

    def best(self, text: str, start: int, stop: int, end: int) -> dict[int, tuple[int, int, tuple[int, ...]]]:
        """Best (score, previous place, ids) at each place up to ``end``, over pieces that start before ``stop``."""
        at = {start: (0, -1, ())}
        for p in range(start, stop):
            if p not in at:
                continue
            score = at[p][0]
            for to, more, ids in self.edges(text, p, end):
                if to not in at or score + more > at[to][0]:
                    at[to] = (score + more, p, ids)
        return at

    @staticmethod
    def trace(at: dict, place: int) -> list[int]:
        out: list[tuple[int, ...]] = []
        while at[place][1] >= 0:
            out.append(at[place][2])
            place = at[place][1]
        return [i for ids in reversed(out) for i in ids]

    def _unit(self, unit: str) -> tuple[int, bytes]:
        """As ``best`` and ``trace`` over the whole unit, the common case without byte pieces."""
        pieces, starts, n = self.pieces, self.starts, len(unit)
        score, back = [0] + [NEVER] * n, [None] * (n + 1)
        for p in range(n):
            now = score[p]
            for to in range(p + 1, min(p + self.longest, n) + 1):
                part = unit[p:to]
                found = pieces.get(part)
                if found is not None:
                    if now + found[0] > score[to]:
                        score[to], back[to] = now + found[0], (p, found[1])
                elif to == p + 1:
                    return self._slow_unit(unit)
                if part not in starts:
                    break
        ids, place = [], n
        while place:
            place, i = back[place]
            ids.append(i)
        return score[n], np.array(ids[::-1], "<i4").tobytes()

    def _slow_unit(self, unit: str) -> tuple[int, bytes]:
        at = self.best(unit, 0, len(unit), len(unit))
        return at[len(unit)][0], np.array(self.trace(at, len(unit)), "<i4").tobytes()

    def units(self, text: str) -> list[tuple[int, bytes]]:
        """(score, ids) of the stretches between forced cuts."""
        if len(self.known) > self.size:
            self.known = {}
        units = _UNIT.findall(text)
        found = list(map(self.known.get, units))
        if None in found:
            self._learn(units)
            found = list(map(self.known.__getitem__, units))
        return found

    def encode(self, text: str) -> bytes:
        return b"".join([u[1] for u in self.units(text)])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As ``encode`` for each; the new units of all are learnt together."""
        if len(self.known) > self.size:
            self.known = {}
        lists = [_UNIT.findall(t) for t in texts]
        self._learn(chain.from_iterable(lists))
        known = self.known
        return [b"".join([known[u][1] for u in units]) for units in lists]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")

    def texts(self, lists: pa.Array) -> pa.Array:
        """Texts of lists of ids, all at once, without the blank that was put before each."""
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        counts = np.array(lists.value_lengths().fill_null(0))
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        data = self.flat[np.repeat(self.firsts[ids] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        rows = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        keep = np.ones(len(data), bool)
        keep[rows[:-1][rows[1:] > rows[:-1]]] = False
        offsets = np.concatenate(([0], np.cumsum(keep)))[rows].astype(np.int32)
        text = data[keep].tobytes()
        none = ~np.array(lists.is_valid())
        try:
            text.decode()
            found = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text))
            return pc.if_else(pa.array(none), pa.scalar(None, pa.string()), found)
        except UnicodeDecodeError:  # ids that no text has
            return pa.array([None if i is None else self.decode(i)[1:] for i in lists.to_pylist()], pa.string())

    def _ends(self, text: str, n: int) -> tuple[int, int] | None:
        """First forced cut behind all entry states, last one in the chunk; or none."""
        first = _CUT.search(text, self.longest - 1, n + 1)
        if not first:
            return None
        last = max(text.rfind(" ", 0, n), text.rfind("\n", 0, n))
        while last > first.start() and not _CUT.match(text, last):
            last -= 1
        return first.start(), max(first.start(), last)

    def transfer(self, text: str, n: int) -> np.ndarray:
        """Matrix (state at the start, state at the end); ``text`` is the chunk and what follows."""
        size = self.longest
        out = np.full((size, size), NEVER, object)
        ends = self._ends(text, n)
        end = min(len(text), n + size - 1)
        for i in range(min(size, n + 1)):
            if ends is None:
                row = self.best(text, i, n, end)
                for j in range(size):
                    if n + j in row:
                        out[i, j] = row[n + j][0]
                continue
            p, q = ends
            head = self.best(text, i, p, p)[p][0]
            if i == 0:
                middle = sum(u[0] for u in self.units(text[p:q]))
                tail = self.best(text, q, n, end)
            for j in range(size):
                if n + j in tail:
                    out[i, j] = head + middle + tail[n + j][0]
        return out

    def trace_chunk(self, text: str, n: int, enter: int, leave: int) -> bytes:
        """Ids of the chunk's path between given states."""
        ends = self._ends(text, n)
        end = min(len(text), n + self.longest - 1)
        if ends is None:
            return np.array(self.trace(self.best(text, enter, n, end), n + leave), "<i4").tobytes()
        p, q = ends
        head, tail = self.trace(self.best(text, enter, p, p), p), self.trace(self.best(text, q, n, end), n + leave)
        return np.array(head, "<i4").tobytes() + self.encode(text[p:q]) + np.array(tail, "<i4").tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process: what is known outlives a task."""
    return Vocabulary(path)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of matrices (or of a row and a matrix), shifted so that the greatest entry is 0."""
    out = np.max(a[..., :, None] + b, axis=-2)
    return _shifted(out)


def _shifted(m: np.ndarray) -> np.ndarray:
    top = max(m.ravel())
    return np.array([x - top if x > NEVER // 2 else NEVER for x in m.ravel()], object).reshape(m.shape)


def states(matrices: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """States at all boundaries of the best way through, from ``enter`` to ``leave``."""
    row = np.full(len(matrices[0]), NEVER, object)
    row[enter] = 0
    rows = [row]
    for m in matrices:
        rows.append(product(rows[-1], m))
    out = [leave]
    for row, m in zip(reversed(rows[:-1]), reversed(matrices)):
        out.append(int(np.argmax(row + m[:, out[-1]])))
    return out[::-1]


def _stack(column, size: int) -> list[np.ndarray]:
    return [np.array(list(map(int, m)), object).reshape(size, size) for m in column]


def _flat(m: np.ndarray) -> list[int]:
    return [int(x) for x in _shifted(m).ravel()]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(id, ids): piece ids of each whole text; a blank is put before a text, as the format does.

    A null text gives null ids, an empty one none. Texts over ``chunk`` characters go by the
    parallel scan, whose result does not depend on ``chunk``. Rows that repeat an id are encoded each; other
    columns are not read; no rows give no rows. ``path`` is the same place on every executor.
    """
    text = F.col(text_col).cast("string")
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col).cast("string"), text).alias("row"))
    giant = F.coalesce(F.length("text") >= chunk, F.lit(False))

    def small(batches):
        v = vocabulary(path)
        for b in batches:
            for start, texts in ranges(b.column("text")):
                found = v.encode_all([" " + t if t else "" for t in texts])
                ids = [None if t is None else np.frombuffer(f, "<i4") for t, f in zip(texts, found)]
                yield _id_rows(b.slice(start, len(texts)), ids)

    short = named.where(~giant).select("id", "text").mapInArrow(small, _schema(named))
    chunks = write_and_reread(named.where(giant).select("row", "text").mapInArrow(_chunker(path, chunk), "row long, chunk int, text string, n int"), "chunks")
    boundaries = _scan(chunks, path, block)

    def back(batches):
        v = vocabulary(path)
        for b in batches:
            ids = [
                np.frombuffer(v.trace_chunk(*x), "<i4")
                for x in zip(*(b.column(c).to_pylist() for c in ("text", "n", "enter", "leave")))
            ]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("chunk"), _lists(ids)], ["row", "chunk", "ids"])

    traced = chunks.dropDuplicates(["row", "chunk"]).join(boundaries, ["row", "chunk"]).mapInArrow(back, "row long, chunk int, ids array<int>")
    whole = traced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    long = named.where(giant).select("id", "row").join(whole, "row").select("id", F.flatten("parts.ids").alias("ids"))
    return short.union(long).withColumnRenamed("id", id_col)


def _schema(named: DataFrame):
    return named.select("id").schema.add("ids", T.ArrayType(T.IntegerType()))


def _lists(ids: list) -> pa.Array:
    """List column without a Python object for each number."""
    sizes = np.array([0 if x is None else len(x) for x in ids])
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    offsets = pa.array(ends, mask=np.array([x is None for x in ids] + [False]))
    full = [x for x in ids if x is not None]
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(full) if full else np.zeros(0, np.int32), pa.int32()))


def _id_rows(batch: pa.RecordBatch, ids: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("id"), _lists(ids)], ["id", "ids"])


def _chunker(path: str, chunk: int):
    def cut(batches):
        ahead = vocabulary(path).longest - 1
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text").to_pylist()):
                text = " " + text
                at = range(0, len(text), chunk)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([row] * len(at), pa.int64()),
                        "chunk": pa.array(range(len(at)), pa.int32()),
                        "text": pa.array([text[i : i + chunk + ahead] for i in at], pa.string()),
                        "n": pa.array([min(chunk, len(text) - i) for i in at], pa.int32()),
                    }
                )

    return cut


def _scan(chunks: DataFrame, path: str, block: int) -> DataFrame:
    """(row, chunk, enter, leave) of every chunk."""

    def matrices(batches):
        v = vocabulary(path)
        for b in batches:
            rows = [_flat(v.transfer(t, n)) for t, n in zip(b.column("text").to_pylist(), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("chunk"), pa.array(rows, pa.list_(pa.int64()))], ["row", "chunk", "m"])

    table = write_and_reread(
        chunks.dropDuplicates(["row", "chunk"]).mapInArrow(matrices, "row long, chunk int, m array<long>")
        .withColumn("block", F.expr(f"chunk div {block}").cast("int")),
        "matrices",
    )

    def combine(key, frame):
        size = vocabulary(path).longest
        parts = _stack(frame.sort_values("chunk")["m"], size)
        out = parts[0]
        for m in parts[1:]:
            out = product(out, m)
        return pd.DataFrame({"row": [key[0]], "block": [key[1]], "m": [_flat(out)]})

    def of_blocks(key, frame):
        frame = frame.sort_values("block")
        found = states(_stack(frame["m"], vocabulary(path).longest), 0, 0)
        return pd.DataFrame({"row": key[0], "block": frame["block"], "enter": found[:-1], "leave": found[1:]})

    def of_chunks(key, frame):
        frame = frame.sort_values("chunk")
        found = states(_stack(frame["m"], vocabulary(path).longest), int(frame["enter"].iloc[0]), int(frame["leave"].iloc[0]))
        return pd.DataFrame({"row": key[0], "chunk": frame["chunk"], "enter": found[:-1], "leave": found[1:]})

    blocks = table.groupBy("row", "block").applyInPandas(combine, "row long, block int, m array<long>")
    outer = blocks.groupBy("row").applyInPandas(of_blocks, "row long, block int, enter int, leave int")
    return table.join(outer, ["row", "block"]).groupBy("row", "block").applyInPandas(of_chunks, "row long, chunk int, enter int, leave int")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with its texts in ``text_col``; null ids give a null text, no ids an empty one."""
    others = [c for c in encoded.columns if c != text_col]

    def back(batches):
        v = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), v.texts(b.column(ids_col))], [*others, text_col])

    return encoded.select(*others).mapInArrow(back, encoded.select(*others).schema.add(text_col, "string"))
