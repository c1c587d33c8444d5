"""Quality rules on how a public vocabulary takes a text (fertility).

Each word is encoded on its own by a byte-fallback vocabulary; a text's characters per token,
share of byte-fallback tokens and entropy of its tokens must lie in the band of its
language, or of its main script where the language has no band. Plain length and repetition
rules come first. A text is read once, in one pass without a shuffle, and decided alone.
"""

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.words import pieces_of_batches
from dayledger.session import bound_batches

MIN_WORDS, MAX_REPEATED = 50, 50
_SYMBOL = re.compile(r"[#*$%&|<>]")
_LATIN = re.compile(r"[A-Za-z\u00c0-\u024f]")
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Band:
    """What is accepted: characters per token from/to, byte share up to, bits per token from."""

    low: float
    high: float
    bytes_up_to: float
    bits_from: float


#: Language bands: characters per token and bits from the first percentile of the good labelled documents of
#: sf0.1 with even ids that pass the base rules. Script bands: on a sample of prose, 0.7 of its characters per
#: token and its byte share and 0.25 more. "other" takes three bytes of four.
BANDS = {
    "en": Band(2.113, 6.0, 0.06, 5.815),
    "de": Band(2.113, 6.0, 0.06, 5.825),
    "fr": Band(1.873, 6.0, 0.06, 5.771),
    "es": Band(1.834, 6.0, 0.06, 5.814),
    "Latin": Band(1.5, 7.0, 0.10, 4.5),
    "Cyrillic": Band(1.58, 7.0, 0.25, 3.5),
    "Greek": Band(0.58, 7.0, 0.25, 3.5),
    "Arabic": Band(0.64, 7.0, 0.25, 3.5),
    "Hebrew": Band(0.57, 7.0, 0.25, 3.5),
    "Devanagari": Band(0.50, 7.0, 0.33, 3.5),
    "Han": Band(0.63, 7.0, 0.36, 3.5),
    "Kana": Band(0.63, 7.0, 0.37, 3.5),
    "Hangul": Band(0.43, 7.0, 0.50, 3.5),
    "other": Band(0.3, 7.0, 0.75, 3.5),
}
#: Letters of the scripts with bands, and the share of a text's letters that tells; Kana stands among Han.
_SCRIPTS = {
    "Kana": (re.compile("[\u3040-\u30ff]"), 0.1),
    "Cyrillic": (re.compile("[\u0400-\u052f]"), 0.5),
    "Greek": (re.compile("[\u0370-\u03ff\u1f00-\u1fff]"), 0.5),
    "Arabic": (re.compile("[\u0600-\u06ff\u0750-\u077f]"), 0.5),
    "Hebrew": (re.compile("[\u0590-\u05ff]"), 0.5),
    "Devanagari": (re.compile("[\u0900-\u097f]"), 0.5),
    "Han": (re.compile("[\u3400-\u4dbf\u4e00-\u9fff]"), 0.5),
    "Hangul": (re.compile("[\uac00-\ud7af]"), 0.5),
}


def _band(text: str) -> str:
    """Name of the band of a text whose language has none."""
    if _LETTER.search(text) and _script(text) == "Latin":
        return "Latin"
    letters = len(_LETTER.findall(text))
    for name, (letter, share) in _SCRIPTS.items():
        if letters and len(letter.findall(text)) >= share * letters:
            return name
    return "other"


def _script(text: str) -> str:
    """Main script of the first letters that tell: Latin or other."""
    letters, latin = len(_LETTER.findall(text)), len(_LATIN.findall(text))
    return "Latin" if 2 * latin >= letters else "other"


class _Pieces:
    """Token ids of words, kept flat so that a text's tokens are gathered by numpy."""

    def __init__(self, path: str, size: int = 150_000):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.n)])
        self.size = size
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def numbers(self, lists: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the words; new ones are encoded together, past ``size`` all anew."""
        if len(self.number) > self.size:
            self.number = {}
            self.flat, self.ends = self.flat[:0], self.ends[:1]
        known = self.number
        new = list({w for words in lists for w in words if w not in known})
        if new:
            ids = self.model.encode(new, num_threads=1)
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.ends = np.concatenate((self.ends, self.ends[-1] + ends))
            self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])))
        return [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in lists]

    def measures(self, numbers: np.ndarray) -> tuple[int, float, float]:
        """(tokens, byte share, bits per token) of words by number."""
        if not len(numbers):
            return 0, 0.0, 0.0
        word, times = np.unique(numbers, return_counts=True)
        ends, starts = self.ends[word + 1], self.ends[word]
        sizes = ends - starts
        before = np.cumsum(sizes) - sizes
        tokens = self.flat[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]
        count = np.bincount(tokens, np.repeat(times, sizes), self.n)
        total = count.sum()
        share = count[count > 0] / total
        return int(total), float(count[self.is_byte].sum() / total), float(-(share * np.log2(share)).sum())


@lru_cache(maxsize=2)
def _pieces(path: str) -> _Pieces:
    """One per worker process: what is known outlives a task."""
    return _Pieces(path)


def repeated_words(numbers: np.ndarray, window: int = 3) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    n = len(numbers) - window + 1
    if n < 2:
        return 0
    _, small = np.unique(numbers, return_inverse=True)
    key = small[:n]
    for j in range(1, window):  # renumbered each time, so keys never overflow
        _, key = np.unique(key * (len(numbers) + 1) + small[j : n + j], return_inverse=True)
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(numbers), bool)
    for j in range(window):
        covered[j : n + j] |= again
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\v\f\r")]
    return len(lines) - len(set(lines))


_FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "chars_per_token double, byte_share double, token_bits double, band string, kept boolean"
)


def _with_text(batches: Iterable[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """The text beside the row that holds it, without a copy."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, batch.column("row").field(place)], [*batch.schema.names, "text"])


def _judge(path: str, bands: dict[str, Band], place: int | None = None):
    """Rows come with their text, or have it at ``place``."""

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        batches = batches if place is None else _with_text(batches, place)
        for batch, lists in pieces_of_batches(batches, "text"):
            rows = []
            every = zip(batch.column("text"), batch.column("lang"), lists, pieces.numbers(lists))
            for text, lang, words, numbers in every:
                text, lang, n = text.as_py() or "", lang.as_py(), len(words)
                chars = sum(map(len, words))
                repeat = repeated_words(numbers)
                failed = n < MIN_WORDS or 100 * repeat > MAX_REPEATED * n
                tokens, by, bits = pieces.measures(numbers)
                name = lang if lang in bands else _band(text)
                name = name if name in bands else _script(text)
                band = bands[name]
                per = chars / tokens if tokens else 0.0
                fits = band.low <= per <= band.high and by <= band.bytes_up_to and bits >= band.bits_from
                rows.append(
                    (n, chars, len(_SYMBOL.findall(text)), repeated_lines(text), repeat, failed)
                    + (per, by, bits, name, not failed and fits)
                )
            columns = [pa.array(c) for c in zip(*rows)]
            names = [f.split()[0] for f in _FIELDS.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", *names])

    return judge


def quality(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    lang_col: str = "lang",
    bands: dict[str, Band] | None = None,
) -> DataFrame:
    """All columns of ``docs`` in ``row``, and the measures and verdict beside them.

    A null text has no words and fails the base rules, as any text under 50 words does. A
    null or unknown language is judged by its script. Every row is judged by itself, so
    repeated rows and ids get equal verdicts; no rows give no rows. ``path`` is the
    vocabulary file, at the same place on every executor.
    """
    bound_batches(docs.sparkSession)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    place = docs.columns.index(text_col) if dict(docs.dtypes).get(text_col) == "string" else None
    text = [] if place is not None else [F.col(text_col).cast("string").alias("text")]
    flat = docs.select(row.alias("row"), *text, lang.alias("lang"))
    kind = flat.schema["row"].dataType.simpleString()
    return flat.mapInArrow(_judge(path, bands or BANDS, place), f"row {kind}, {_FIELDS}")


def keep_good(docs: DataFrame, path: str, **how) -> DataFrame:
    """The rows that pass, with their own columns."""
    return quality(docs, path, **how).where("kept").select("row.*")
