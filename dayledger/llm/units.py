"""Stretches of a text that no token of the given vocabularies goes over.

A text may be cut before a blank or a line feed that follows something other than white
space: the byte-level pattern takes white space only at the start of a match or as a whole
match, and no piece of the 32k vocabulary has a blank or line feed behind another character.
So the tokens of a text are those of its units in order, a unit that was seen is a dictionary
lookup, and a giant text can be worked on slice by slice.
"""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: All that Python, the token pattern or Unicode may take for white space, but blank and line feed.
_OTHER = "\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_ODD = re.compile(f"[{_OTHER}]")
_CUT = re.compile(f"(?<=[^ \n{_OTHER}])(?=[ \n])")
_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Characters of a slice; past this a text is cut at the next place that allows it.
SLICE = 1 << 20
#: Longer units are not remembered.
LONGEST = 128


def units(text: str) -> list[str]:
    """The units in order; put together they are the text."""
    return _CUT.split(text) if _ODD.search(text) else _UNIT.findall(text)


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Parts of about ``size`` characters, each of whole units."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class Known(dict):
    """What is known of units; starts anew past ``size`` entries, so memory stays bounded."""

    def __init__(self, learn, size: int):
        super().__init__()
        self.learn, self.size = learn, size

    def of(self, wanted: list[str]) -> list:
        """The values of ``wanted`` in order; new units are learnt together."""
        if len(self) > self.size:
            self.clear()
        found = list(map(self.get, wanted))
        if None not in found:
            return found
        new = list(dict.fromkeys([u for u, f in zip(wanted, found) if f is None]))
        learnt = dict(zip(new, self.learn(new)))
        self.update(learnt if len(max(new, key=len)) <= LONGEST else {u: v for u, v in learnt.items() if len(u) <= LONGEST})
        return [learnt[u] if f is None else f for u, f in zip(wanted, found)]


def ranges(texts: pa.Array, chars: int = SLICE) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows with about ``chars`` characters, so a batch is never worked on whole."""
    start, held, n = 0, [], 0
    for i in range(len(texts)):
        held.append(texts[i].as_py())
        n += len(held[-1] or "")
        if n >= chars or i + 1 == len(texts):
            yield start, held
            start, held, n = i + 1, [], 0


def lists(parts: Iterable[np.ndarray], kind: pa.DataType = pa.int32()) -> pa.ListArray:
    """List column from one array for each row, without a Python object for each number."""
    parts = list(parts)
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype(), copy=False), kind))
