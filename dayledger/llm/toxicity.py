"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps look-alike letters, accents, full-width letters and digit substitutions to plain
letters and drops invisible characters. One automaton finds entries and exception phrases in
one pass over a text; an entry inside an exception phrase, or inside a longer word, does not
count. The lexicon is a fixed list and word beginnings learnt from labelled texts, chosen
one after another for the toxic texts that nothing chosen before explains. Weights are
smoothed log-odds among labelled texts, the sum is taken relative to the text's length, and
a logistic curve turns it into a score.

Beginnings are learnt on ``SAMPLE`` labelled rows at most, those of least id hash; counts,
weights and the curve use all labelled rows. Only bounded tables reach the driver: beginnings
of the sample, a count for each entry, a count for each bin of the curve.
"""

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.llm.words import words_of
from dayledger.session import write_and_reread

#: Insults and threats of everyday language, folded: fixed values, weighted by the fit.
LEXICON = tuple(
    "arsehole asshole bastard bimbo bitch bollocks bullshit clown coward creep cretin crap cunt dickhead "
    "dimwit disgusting douchebag dumbass dumb filth freak fuck fucking fucker garbage halfwit hateful idiot "
    "idiotic imbecile jackass jerk kys loser lowlife lunatic maggot moron moronic motherfucker nitwit numbskull "
    "parasite pathetic pervert pig prick psycho rat retard rubbish scum scumbag shit shithead simpleton slut "
    "stupid subhuman swine terrorist trash twat twit ugly useless vermin wanker weirdo whore worthless "
    "arschloch dummkopf hurensohn schlampe trottel vollidiot wichser connard connasse encule ordure salaud salope "
    "cabron estupido gilipollas imbecil pendejo puta".split()
)
#: Phrases in which an entry is no insult: fixed values.
EXCEPTIONS = tuple(
    "class clown;clown fish;clown car;trash can;trash bin;trash bag;white trash bag;rubbish bin;garbage collection;"
    "garbage collector;garbage can;sore loser;pig iron;guinea pig;lab rat;rat race;jerk chicken;ugly duckling;"
    "freak accident;parasite drag;scum line;stupid question;useless use of".split(";")
)
#: Look-alikes outside the Latin accents: fixed values, pairs of sign and letter.
_LOOKS = {
    pair[0]: pair[1:]
    for pair in (
        "аa вb еe ѕs іi јj кk мm нh оo рp ԛq гr сc тt уy хx ԝw ԁd һh ӏl ьb "
        "αa βb γy εe ιi κk νv οo ρp τt υu χx ωw ıi łl øo đd ßss ¡i |l"
    ).split()
}
_DIGITS = dict(zip("0134578@", "oieastba"))
_HIDDEN = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370)])
_BETWEEN = re.compile(r"(?<=[a-z])\$+(?=[a-z])")
BIN, RIDGE, PRIOR = 0.125, 1.0, 0.5
SAMPLE, CANDIDATES, SHORTEST, LONGEST, LEAST_ODDS = 20_000, 5_000, 4, 8, 20.0
_LETTERS = re.compile(r"[^\W\d_]+")


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(k): v for k, v in (_LOOKS | _DIGITS).items()} | _HIDDEN
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF00, 0xFF5F), *range(0x1D400, 0x1D800)):
        base = unicodedata.normalize("NFKD", chr(c))[:1].lower()
        if base.isascii() and base.isalnum():
            table.setdefault(c, _DIGITS.get(base, base))
    return table


_TABLE = _table()


def fold(text: str) -> str:
    low = text.lower().translate(_TABLE)
    return _BETWEEN.sub("s", low) if "$" in low else low


@lru_cache(maxsize=4)
def _automaton(lexicon: tuple[str, ...], exceptions: tuple[str, ...]):
    """An entry that ends in ``*`` is a word's beginning."""
    machine = ahocorasick.Automaton()
    for i, entry in enumerate(lexicon):
        plain = fold(entry.rstrip("*"))
        machine.add_word(plain, (i, len(plain), entry.endswith("*")))
    for phrase in exceptions:
        machine.add_word(fold(phrase), (-1, len(fold(phrase)), False))
    machine.make_automaton()
    return machine


def matches(text: str, lexicon=LEXICON, exceptions=EXCEPTIONS) -> Counter:
    """How often each entry (by number) is meant in a text."""
    folded = fold(text)
    found, safe = [], []
    for last, (i, n, opening) in _automaton(tuple(lexicon), tuple(exceptions)).iter(folded):
        start, end = last - n + 1, last + 1
        if start and folded[start - 1].isalnum() or not opening and folded[end : end + 1].isalnum():
            continue
        (safe if i < 0 else found).append((start, end, i))
    # Hits come by rising end, so a hit lies in an exception if one that ends no earlier starts no later.
    ends = [b for _, b, _ in safe]
    first = list(accumulate((a for a, _, _ in reversed(safe)), min))[::-1]

    def excepted(start: int, end: int) -> bool:
        k = bisect_left(ends, end)
        return k < len(ends) and first[k] <= start

    return Counter(i for s, e, i in found if not excepted(s, e))


_HITS = T.MapType(T.IntegerType(), T.IntegerType())


def _finder(lexicon, exceptions):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                n_words.append(len(words_of(text)))
                hits.append(sorted(matches(text, lexicon, exceptions).items()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.map_(pa.int32(), pa.int32())),
                ],
                ["doc_id", "n_words", "hits"],
            )

    return find


def _beginnings(text: str) -> set[str]:
    words = set(_LETTERS.findall(fold(text)))
    return {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _counter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(beginning, toxic and other texts that have it), summed as far as a task sees."""
    bad, good = Counter(), Counter()

    def rows():
        keys = list({**bad, **good})
        columns = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (bad, good))]
        bad.clear()
        good.clear()
        return pa.RecordBatch.from_arrays(columns, ["beginning", "bad", "good"])

    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            (bad if toxic else good).update(_beginnings(text))
            if len(bad) + len(good) > 500_000:
                yield rows()
    yield rows()


def _holders(chosen: frozenset[str], lexicon, exceptions):
    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch.column("text").to_pylist() if not matches(t, lexicon, exceptions)]
            held = [sorted(_beginnings(t) & chosen) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.string()))], ["held"])

    return hold


def learn_beginnings(sample: DataFrame, lexicon, exceptions) -> tuple[str, ...]:
    """Word beginnings that mark toxic texts in (text, toxic), as ``beginning*``.

    Greedy: the one that most unexplained toxic texts hold goes first, the longest of equals,
    while it has four or more of them and one in 200, and odds of ``LEAST_ODDS``. Equal texts count once.
    """
    texts = sample.where("text is not null").groupBy("text").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return ()
    counts = texts.mapInArrow(_counter, "beginning string, bad long, good long").groupBy("beginning")
    odds = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    least = max(4, bad // 200)
    best = (
        counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where((F.col("bad") >= least) & (odds >= LEAST_ODDS))
        .orderBy(F.desc("bad"), "good", "beginning")
        .limit(CANDIDATES)
        .collect()
    )
    good_of = {r["beginning"]: r["good"] for r in best}
    open_texts = [
        set(r["held"])
        for r in texts.where("toxic = 1")
        .mapInArrow(_holders(frozenset(good_of), lexicon, exceptions), "held array<string>")
        .collect()
    ]
    out = []
    while True:
        gain = Counter(b for held in open_texts for b in held)
        if not gain:
            break
        top = max(gain, key=lambda b: (gain[b] - good_of[b], len(b), b))
        if gain[top] < least:
            break
        out.append(top + "*")
        open_texts = [held for held in open_texts if top not in held]
    return tuple(out)


def fit_curve(x: np.ndarray, bad: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a ridge logistic curve through binned counts, by Newton steps."""
    w = np.array([0.0, 1.0])
    design = np.stack([np.ones(len(x)), x], 1)
    n = bad + good
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (bad - n * p) - RIDGE * np.array([0.0, w[1]])
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-9, RIDGE])
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    lexicon: tuple[str, ...] = LEXICON,
    exceptions: tuple[str, ...] = EXCEPTIONS,
    folds: int = 5,
) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5), hits (of the lexicon), n_words per row.

    Held out are rows whose crc32(doc_id as text) is divisible by ``folds``; their labels are
    never used, nor is any column but the text. A null or empty text has no hits and gets the
    score of such texts. A null ``doc_id`` is not held out and has no label. Rows that repeat an id are scored each by its
    own text. A document labelled twice is toxic if one label says so; null labels are
    left out. Without usable labels every entry weighs alike and the curve is a fixed
    one (two hits in a hundred words score above 0.5). No rows give no rows.
    """
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    mine = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds != 0, F.lit(False))
    few = known.where(mine).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = write_and_reread(
        docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(few), "doc_id").select("text", "toxic"),
        "sample",
    )
    lexicon = (*lexicon, *learn_beginnings(sample, lexicon, exceptions))
    found = write_and_reread(
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .mapInArrow(_finder(lexicon, exceptions), docs.select("doc_id").schema.add("n_words", "long").add("hits", _HITS))
        .withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))),
        "hits",
    )
    trained = write_and_reread(
        found.where("not held_out").join(known, "doc_id").select("toxic", "n_words", "hits"), "labelled"
    )
    totals = {r["toxic"]: r["n"] for r in trained.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = trained.select("toxic", F.explode(F.map_keys("hits")).alias("entry")).groupBy("entry", "toxic").count()
    weights = _weights({(r["entry"], r["toxic"]): r["count"] for r in rows.collect()}, totals, len(lexicon))
    table = F.array(*(F.lit(float(w)) for w in weights))
    mass = F.aggregate(
        F.map_entries("hits"), F.lit(0.0), lambda s, e: s + F.element_at(table, e["key"] + 1) * e["value"]
    )
    level = F.log2(F.lit(1.0) + 100 * mass / (F.col("n_words") + 50))
    binned = (
        trained.select("toxic", F.floor(level / BIN).alias("bin")).groupBy("bin").agg(
            F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"), F.count("*").alias("n")
        )
    ).collect()  # levels are logarithms of bounded shares: a few hundred bins
    intercept, slope = -2.0, 2.0
    if totals.get(1) and totals.get(0):
        x = np.array([(r["bin"] + 0.5 * (r["bin"] > 0)) * BIN for r in binned], float)
        bad, n = (np.array([r[c] for r in binned], float) for c in ("bad", "n"))
        intercept, slope = fit_curve(x, bad, n - bad)
    score = 1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * level)))
    return found.select(
        "doc_id",
        "held_out",
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
        F.aggregate(F.map_values("hits"), F.lit(0), lambda s, v: s + v).alias("hits"),
        "n_words",
    )


def _weights(counts: dict[tuple[int, int], int], totals: dict[int, int], n: int) -> np.ndarray:
    """Log-odds of an entry among toxic against other texts, from 0 on, drawn to the mean entry."""
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return np.ones(n)
    hits = np.array([[counts.get((i, t), 0) for t in (1, 0)] for i in range(n)], float)
    base = hits.sum(0) / max(1.0, hits.sum()) + 1e-3  # of unseen entries: what entries are as a whole
    odds = np.log(((hits[:, 0] + PRIOR * base[0]) / bad) / ((hits[:, 1] + PRIOR * base[1]) / good))
    return np.clip(odds, 0.0, 8.0)
