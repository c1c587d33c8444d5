"""Byte-level BPE by a SentencePiece model that is made from the vocabulary file.

Each token's bytes are written as characters, one for each byte, none of them white space. The
rank file becomes a SentencePiece BPE model of these strings, scored by negative rank, with
identity normalisation and nothing put before a text; no training takes place. A text is cut by
the pattern, each match is written in the same characters and merged by the model, so that the
best pair, the leftmost of equals, goes first: the order of ranks. Decoding looks up each id's
piece and turns its characters back into bytes.
"""

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from dayledger.llm.units import LONGEST, Known, lists, ranges, slices, units

#: A byte's character: itself where it is a visible ASCII character, else one of its own from U+0100 on.
_TO_CHARS = {b: b if 33 <= b <= 126 else 256 + b for b in range(256)}
_TO_BYTES = {c: b for b, c in _TO_CHARS.items()}
#: Holds a blank, so no string of the characters above can be it.
_UNKNOWN = "not a piece"
#: Matches that the model gets in one call.
TOGETHER = 64


def in_characters(data: bytes) -> str:
    """One character for each byte."""
    return data.decode("latin-1").translate(_TO_CHARS)


def in_bytes(piece: str) -> bytes:
    """The bytes of such characters."""
    return piece.translate(_TO_BYTES).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64, blank, rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """A SentencePiece BPE model whose n-th piece is the token of the n-th smallest rank.

    The one unknown piece that the format asks for comes last; no text of bytes needs it, as a
    vocabulary without all 256 bytes is refused.
    """
    if lost := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks the bytes {lost[:5]}")
    model, kind = proto.ModelProto(), proto.ModelProto.SentencePiece
    for place, (token, _) in enumerate(sorted(ranks.items(), key=lambda x: x[1])):
        model.pieces.add(piece=in_characters(token), score=-place, type=kind.NORMAL)
    model.pieces.add(piece=_UNKNOWN, score=0, type=kind.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size, spec.unk_id = proto.TrainerSpec.BPE, len(model.pieces), len(ranks)
    spec.bos_id = spec.eos_id = spec.pad_id = -1
    spec.byte_fallback = False
    as_is = model.normalizer_spec
    as_is.name = "identity"
    as_is.add_dummy_prefix = as_is.remove_extra_whitespaces = as_is.escape_whitespaces = False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, pattern: str, size: int = 300_000):
        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(ranks))
        self.pattern = regex.compile(pattern)
        self.ranks = np.array(sorted(ranks.values()), np.int64)  # by the model's id
        tokens = sorted(ranks, key=ranks.get)
        self.merged: dict[str, bytes] = {}
        # A match that is itself a token is that token, even if its merges would end elsewhere.
        ids = self._merge([in_characters(t) for t in tokens])
        self.whole = {in_characters(t): i for i, t in enumerate(tokens) if ids[i] != np.int32(i).tobytes()}
        self.known = Known(self._learn, size)
        pieces = [in_bytes(self.model.id_to_piece(i)) for i in range(len(tokens))]
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def _merge(self, matches: list[str]) -> list[bytes]:
        """The model's ids of each match, as bytes. The blank between matches is no piece: nothing merges over it."""
        rows = [" ".join(matches[i : i + TOGETHER]) + " " for i in range(0, len(matches), TOGETHER)]
        ids = np.array(list(chain.from_iterable(self.model.encode(rows, num_threads=1))), "<i4")
        cuts = (4 * np.flatnonzero(ids == self.model.unk_id())).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], cuts)]

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of each unit, as bytes."""
        if len(self.merged) > self.known.size:
            self.merged.clear()
        merged, rows = self.merged, list(map(self.pattern.findall, new))
        fresh = [m for m in dict.fromkeys(m for row in rows for m in row) if m not in merged]
        strings = [in_characters(m.encode("utf-8", "replace")) for m in fresh]
        found = dict(zip(fresh, self._merge(strings)))
        if self.whole:
            found |= {m: np.int32(self.whole[s]).tobytes() for m, s in zip(fresh, strings) if s in self.whole}
        out = [b"".join([merged.get(m) or found[m] for m in row]) for row in rows]
        merged.update((m, ids) for m, ids in found.items() if len(m) <= LONGEST)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ranks of each whole text's tokens."""
        parts = [(i, units(part)) for i, text in enumerate(texts) for part in slices(text)]
        found = self.known.of([u for _, row in parts for u in row])
        out, start = [[] for _ in texts], 0
        for i, row in parts:
            out[i].append(b"".join(found[start : start + len(row)]))
            start += len(row)
        return [self.ranks[np.frombuffer(b"".join(x), "<i4")] for x in out]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all tokens one after the other, number of bytes of each)."""
        at = np.searchsorted(self.ranks, ids)
        if len(ids) and (at.max() >= len(self.ranks) or (self.ranks[at] != ids).any()):
            raise ValueError("an id that the vocabulary does not have")
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.firsts[at] - (ends - sizes), sizes) + np.arange(sizes.sum())], sizes


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One per worker process: what is known outlives a task."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with the token ids of each whole text, an array of numbers, in ``ids_col``.

    ``keep``: the other columns to carry on (all). A column named like ``ids_col`` is replaced. A
    null or empty text gets an empty list. Repeated rows are encoded each; no rows give no rows. ``path`` is
    the same place on every executor.
    """
    others = [c for c in (docs.columns if keep is None else keep) if c not in (ids_col, text_col)]
    kept = others + [text_col] * (keep is None or text_col in keep)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for start, texts in ranges(batch.column(text_col)):
                part = batch.slice(start, len(texts))
                ids = lists(bpe.encode([t or "" for t in texts]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), ids], [*kept, ids_col])

    chosen = docs.select(*others, F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([*chosen.select(*kept).schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return chosen.mapInArrow(rows, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """The rows of ``encoded`` with the bytes of their ids in ``bytes_col``.

    Null ids give null, no ids no bytes. An id that the vocabulary lacks is an error.
    """
    others = [c for c in encoded.columns if c != bytes_col]
    chosen = encoded.select(*others)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = part.column(ids_col)
                data, sizes = bpe.decode(ids.flatten().to_numpy(zero_copy_only=False))
                counts = np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes)))[counts]
                # 64-bit offsets: 500 long texts may pass 2 GB
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data.tobytes())])
                out = pa.array([None if not ok else x.as_py() for ok, x in zip(ids.is_valid().to_pylist(), out)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), out], [*others, bytes_col])

    return chosen.mapInArrow(rows, T.StructType([*chosen.schema.fields, T.StructField(bytes_col, T.BinaryType())]))
