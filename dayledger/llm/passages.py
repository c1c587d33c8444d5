"""Passages that repeat across documents, found by chaining shared word runs.

Seeds are all runs of five words. Every holder of a seed is matched with an earlier holder,
its anchor: matches grow with the text, however often a passage repeats. The matches of one
document with one anchor are chained in order: a Fenwick tree over the anchor's places gives
the best chain that ends before a match, less a cost for the gap. Chains are then aligned
word by word against the anchor's passage, across gaps and out over both ends with insertions
and deletions, which finds the passage's fuzzy borders.

Seeds travel packed: a task sorts the seeds of some million words, matches repeats among them
on the spot and sends one place of each seed, as differences of the leading bits of its hash.
So a seed that all documents hold costs one entry for each such group, seeds with one holder
end where they arrive, and only shared ones become rows.

A passage of common sentences has its seeds anchored at many documents, and no chain with
the one that holds it whole. So shared seeds that no exact stretch of ``min_words`` words
covers are sent again as pairs, ``NEAR`` to ``FAR`` words apart, and matched alike.

A document loses the stretches that chains cover with a share of ``similarity`` equal words,
where they add up to ``min_words`` words or more; the first holder keeps them. "First" is by
the hash of id and text. Which of several earlier holders is the anchor may depend on how
rows are dealt to tasks.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.words import _WORD, GOLDEN, Words, mix, shingles, slices
from dayledger.session import bound_batches, broadcast_if_small, write_and_reread

RUN, WINDOW, MIN_WORDS, SIMILARITY = 5, 1, 50, 0.8
MAX_GAP, FLANK, LEAST = 64, 64, 15
#: Words between the two seeds of a pair.
NEAR, FAR = 20, 40
#: Of seeds at most so many words apart one is paired.
REACH = 4
#: Keys that a task sorts at once, and keys of a part of the exchange, about.
GROUP, PART = 1 << 21, 1 << 22
#: Buckets of matches at least, by row; a power of two.
BUCKETS = 512
#: Chains that are aligned together, and chains of one anchor that its text is handed on with.
TOGETHER, CHUNK = 512, 500


def seed_places(s: np.ndarray, window: int) -> np.ndarray:
    """Places of the least of each ``window`` neighbours; one of a run of equal ones."""
    if not len(s):
        return np.zeros(0, np.int64)
    if len(s) <= window:
        return np.array([s.argmin()])
    least = np.lib.stride_tricks.sliding_window_view(s, window).argmin(axis=1)
    at = np.unique(least + np.arange(len(least)))
    again = (s[at[1:]] == s[at[:-1]]) & (np.diff(at) < RUN)
    return np.delete(at, 1 + np.flatnonzero(again))


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of bytes, as many as the largest needs."""
    values = values.astype("<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _pack_steps(values: np.ndarray) -> bytes:
    """Whole numbers as steps from one to the next, the sign in the last bit."""
    steps = values.astype(np.int64)
    steps[1:] -= values[:-1]
    return _pack((steps << 1) ^ (steps >> 63))


def _unpack_steps(data: bytes) -> np.ndarray:
    steps = _unpack(data).view(np.int64)
    return np.cumsum((steps >> 1) ^ -(steps & 1))


_CELL = pa.schema(
    [("part", pa.int64()), ("local", pa.bool_())]
    + [(c, pa.binary()) for c in ("rows", "keys", "docs", "places", "anchors", "firsts")]
)
_CELL_KIND = "part long, local boolean, rows binary, keys binary, docs binary, places binary, anchors binary, firsts binary"


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``bits`` bits in order, and their places before, the least first."""
    free = np.uint64(64 - bits)
    if len(key) >> int(free):
        order = key.argsort(kind="stable")
        return key[order], order
    both = (key << free) | np.arange(len(key), dtype=np.uint64)
    both.sort()
    return both >> free, (both & ((np.uint64(1) << free) - np.uint64(1))).astype(np.int32)


def _cells(held: list[tuple], parts: int, bits: int) -> pa.RecordBatch:
    """Cells of a group of (row, keys, places): the first place of each key by part, and repeats with their firsts.

    Rows are the least first, so places in the order of the group are in the order of (row, place).
    """
    held.sort(key=lambda h: h[0])
    rows = np.array([h[0] for h in held], np.int64)
    doc = np.repeat(np.arange(len(held), dtype=np.int32), [len(h[1]) for h in held])
    key = np.concatenate([h[1] for h in held]) >> np.uint64(64 - bits)
    place = np.concatenate([h[2] for h in held])
    held.clear()
    key, order = _sorted(key, bits)
    doc, place = doc[order], place[order]
    del order
    new = np.concatenate(([True], key[1:] != key[:-1]))
    head = np.flatnonzero(new)
    out = []
    again = np.flatnonzero(~new)
    if len(again):
        first = head[np.searchsorted(head, again, "right") - 1]
        of = np.unique(first)
        at, to = np.concatenate((again, of)), np.concatenate((first, of))
        by = np.lexsort((place[at], doc[to], doc[at]))  # whole copies give steps of one
        at, to = at[by], to[by]
        used, both = np.unique(np.concatenate((doc[at], doc[to])), return_inverse=True)
        steps = (_pack_steps(c) for c in (both[: len(at)], place[at], both[len(at) :], place[to]))
        out.append((int(rows[0]) % parts, True, rows[used].tobytes(), _pack(key[at]), *steps))
    shift = np.uint64(bits - parts.bit_length() + 1)
    cuts = np.searchsorted(key[head], np.arange(parts, dtype=np.uint64) << shift).tolist() + [len(head)]
    for part, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
        if i < j:
            at = head[i:j]
            used, own = np.unique(doc[at], return_inverse=True)
            keys = np.diff(key[at], prepend=np.uint64(0))
            out.append((part, False, rows[used].tobytes(), _pack(keys), _pack(own), _pack(place[at]), None, None))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _CELL)], schema=_CELL)


def _grouped(found: Iterable[tuple], parts: int, bits: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for row, keys, places in found:
        if len(keys):
            held.append((row, keys, places))
            n += len(keys)
        if n >= GROUP:
            yield _cells(held, parts, bits)
            n = 0
    if n:
        yield _cells(held, parts, bits)


def _seeds(words: Words, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Seeds of each text and their places. Texts of fewer than ``RUN`` words have none: one seed is no chain."""
    n, ends = max(0, len(words.hashes) - RUN + 1), words.ends
    s = shingles(words.hashes, RUN) if n else np.zeros(0, np.uint64)
    last = np.maximum(ends[:-1], ends[1:] - RUN + 1)
    if window > 1:
        for i, j in zip(ends[:-1].tolist(), last.tolist()):
            at = seed_places(s[i:j], window)
            yield s[i:j][at], at.astype(np.int32)
        return
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    keep = doc[:n] == doc[len(doc) - n :]
    keep[1:] &= (s[1:] != s[:-1]) | (doc[1:n] != doc[: max(0, n - 1)])  # one of a run of equal ones
    at = np.flatnonzero(keep)
    place = (at - ends[doc[at]]).astype(np.int32)
    cuts = np.searchsorted(at, ends)
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield s[at[i:j]], place[i:j]


def _seeder(window: int, parts: int, bits: int):
    def found(batches):
        for batch in slices(batches, "text"):
            for row, (keys, places) in zip(batch.column("row").to_pylist(), _seeds(Words(batch.column("text")), window)):
                yield row, keys, places

    return lambda batches: _grouped(found(batches), parts, bits)


def sparse(place: np.ndarray, seed: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Which seeds are the least of those at most ``reach`` places away: a run of one to ``reach`` seeds keeps one."""
    keep = np.ones(len(place), bool)
    for k in range(1, reach + 1):
        near = place[k:] - place[:-k] <= reach
        keep[:-k] &= ~near | (seed[:-k] <= seed[k:])
        keep[k:] &= ~near | (seed[k:] <= seed[:-k])
    return keep


def _pairer(parts: int, bits: int):
    """Pairs of a row's open seeds, ``NEAR`` to ``FAR`` words apart, least ones of their surroundings."""

    def found(batches):
        for batch in batches:
            for i, row in enumerate(batch.column("row").to_pylist()):
                place = batch.column("xs")[i].values.to_numpy().astype(np.int64)
                seed = mix(batch.column("seeds")[i].values.to_numpy().view(np.uint64))
                left = sparse(place, seed)
                place, seed = place[left], seed[left]
                low, high = np.searchsorted(place, place + NEAR), np.searchsorted(place, place + FAR, "right")
                count = high - low
                u = np.repeat(np.arange(len(place)), count)
                v = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
                yield row, mix(seed[u] * GOLDEN + seed[v]), place[u] * 64 + place[v] - place[u]

    return lambda batches: _grouped(found(batches), parts, bits)


def _matcher(buckets: int):
    """Cells come sorted by part. All holders of a key that has several, each with the first; a first with itself."""

    def closed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Some keys at a time, as cells have theirs in order."""
        n = sum(len(c[0]) for c in held)
        low, high = min(int(c[0][0]) for c in held), max(int(c[0][-1]) for c in held)
        steps = max(1, n >> 18)
        bounds = np.array([low + (high + 1 - low) * k // steps for k in range(1, steps)], np.uint64)
        cuts = [[0, *np.searchsorted(c[0], bounds).tolist(), len(c[0])] for c in held]
        found, n = [], 0
        for k in range(steps):
            part = [(key[i[k] : i[k + 1]], rows[docs[i[k] : i[k + 1]]], place[i[k] : i[k + 1]]) for (key, rows, docs, place), i in zip(held, cuts)]
            found.append(shared(*(np.concatenate(c) for c in zip(*part))))
            n += len(found[-1][0])
            if n >= 1 << 20 or k + 1 == steps:
                yield _matched(buckets, *(np.concatenate(c) for c in zip(*found)))
                found, n = [], 0
        held.clear()

    def shared(key: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple:
        """All holders of a key that has several, each with the first."""
        order = key.argsort()
        key = key[order]
        same = np.concatenate(([False], key[1:] == key[:-1], [False]))
        several = (same[1:] | same[:-1])[: len(key)]
        order, key = order[several], key[several]
        row, place = row[order], place[order]
        order = np.lexsort((place, row, key))
        key, row, place = key[order], row[order], place[order]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        first = np.repeat(head, np.diff(np.append(head, len(key))))
        return key, row, row[first], place.astype(np.int64), place[first].astype(np.int64)

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for cell in batch.to_pylist():
                if held and cell["part"] != now:
                    yield from closed(held)
                now, rows = cell["part"], np.frombuffer(cell["rows"], np.int64)
                keys = _unpack(cell["keys"])
                if cell["local"]:
                    docs, places, anchors, firsts = (_unpack_steps(cell[c]) for c in ("docs", "places", "anchors", "firsts"))
                    yield _matched(buckets, keys, rows[docs], rows[anchors], places, firsts)
                else:
                    docs, places = _unpack(cell["docs"]).astype(np.int32), _unpack(cell["places"])
                    held.append((np.cumsum(keys, dtype=np.uint64), rows, docs, places if places.max() >> np.uint64(31) else places.astype(np.int32)))
        if held:
            yield from closed(held)

    return match


_MATCHED = pa.schema([("bucket", pa.int64())] + [(c, pa.binary()) for c in ("rows", "keys", "docs", "anchors", "places", "firsts")])
_MATCHED_KIND = "bucket long, rows binary, keys binary, docs binary, anchors binary, places binary, firsts binary"


def _matched(buckets: int, key, row, anchor, place, first) -> pa.RecordBatch:
    """Matches packed by the bucket of their row, which is the leading bits of the row's hash."""
    order = np.lexsort((place, anchor, row.view(np.uint64)))  # stretches give steps of one
    key, row, anchor, place, first = (c[order] for c in (key, row, anchor, place, first))
    bucket = (row.view(np.uint64) >> np.uint64(65 - buckets.bit_length())).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(bucket)]
    out = []
    for i, j in zip(cuts[:-1], cuts[1:]):
        used, both = np.unique(np.concatenate((row[i:j], anchor[i:j])), return_inverse=True)
        steps = (_pack_steps(c) for c in (both[: j - i], both[j - i :], place[i:j], first[i:j]))
        out.append((int(bucket[i]), used.tobytes(), _pack(key[i:j]), *steps))
    columns = zip(*out) if out else [[]] * len(_MATCHED)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _MATCHED)], schema=_MATCHED)


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(seed, row, anchor, x, a) of all matches of a bucket, sorted by (row, anchor, x, a); records come sorted by bucket."""
    held, now = [], None

    def closed():
        seed, row, anchor, x, a = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.lexsort((a, x, anchor, row))
        return seed[order], row[order], anchor[order], x[order], a[order]

    for batch in batches:
        for packed in batch.to_pylist():
            if held and packed["bucket"] != now:
                yield closed()
            now, rows = packed["bucket"], np.frombuffer(packed["rows"], np.int64)
            docs, anchors, places, firsts = (_unpack_steps(packed[c]) for c in ("docs", "anchors", "places", "firsts"))
            held.append((_unpack(packed["keys"]).astype(np.int64), rows[docs], rows[anchors], places, firsts))
    if held:
        yield closed()


def chains(x: list[int], a: list[int], max_gap: int = MAX_GAP) -> list[list[int]]:
    """Index lists of chains of two matches or more, both places rising, best chains first.

    ``x`` is ascending. A match is worth 1; a gap costs (dx + da) / (2 * max_gap), so gaps
    of ``max_gap`` words on either side are worth one match.
    """
    cost = 1 / (2 * max_gap)
    ranks = {v: i + 1 for i, v in enumerate(sorted(set(a)))}
    tree = [(-1e18, -1)] * (len(ranks) + 1)
    score, back = [], []
    waiting: list[int] = []  # matches at the present x are entered once x moves on
    for i, (xi, ai) in enumerate(zip(x, a)):
        if waiting and x[waiting[0]] != xi:
            for j in waiting:
                entry, r = (score[j] + cost * (x[j] + a[j]), j), ranks[a[j]]
                while r < len(tree):
                    if entry > tree[r]:
                        tree[r] = entry
                    r += r & -r
            waiting = []
        best, r = (-1e18, -1), ranks[ai] - 1
        while r:
            if tree[r] > best:
                best = tree[r]
            r -= r & -r
        gain = best[0] - cost * (xi + ai)
        score.append(1 + max(gain, 0.0))
        back.append(best[1] if gain > 0 else -1)
        waiting.append(i)
    used, out = [False] * len(x), []
    for i in sorted(range(len(x)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if len(chain) > 1:
            out.append(chain[::-1])
    return out


def thinned(group: np.ndarray, x: np.ndarray, a: np.ndarray, every: int = RUN) -> np.ndarray:
    """Which matches to keep: without most of the inner ones of a diagonal, all words between those left are equal.

    Groups of up to ``every`` matches keep all. ``group`` is ascending.
    """
    order = np.lexsort((x, a - x, group))
    g, x, a = group[order], x[order], a[order]
    joined = np.concatenate(([False], (g[1:] == g[:-1]) & (np.diff(x) == 1) & (np.diff(a) == 1), [False]))[: len(x) + 1]
    keep = np.zeros(len(x), bool)
    keep[order] = ~(joined[:-1] & joined[1:]) | (x % every == 0) | (np.bincount(g)[g] <= every)
    return keep


def plain(group: np.ndarray, x: np.ndarray, a: np.ndarray, max_gap: int = MAX_GAP) -> np.ndarray:
    """Per group, are its matches one chain? Both places rise, and no gap costs what a match is worth."""
    dx, da = np.diff(x), np.diff(a)
    bad = (group[1:] == group[:-1]) & ((dx <= 0) | (da <= 0) | (dx + da >= 2 * max_gap))
    return np.bincount(group[1:], bad, int(group[-1]) + 1 if len(group) else 0) == 0


def pieces(x: list[int], a: list[int], min_words: int, similarity: float) -> Iterator[tuple[int, int, bool]]:
    """(first, last, proved) of a chain parted at gaps over ``MAX_GAP``: do its matches alone prove it long and alike?"""
    first, equal = 0, RUN
    for i in range(1, len(x) + 1):
        dx, da = (x[i] - x[i - 1], a[i] - a[i - 1]) if i < len(x) else (MAX_GAP + 1, 0)
        if max(dx, da) > MAX_GAP:
            own, other = x[i - 1] + RUN - x[first], a[i - 1] + RUN - a[first]
            yield first, i - 1, own >= min_words and equal >= similarity * max(own, other)
            first, equal = i, RUN
        else:
            equal += dx if dx == da <= RUN else min(dx, da, RUN)


def _chainer(pairs: bool, min_words: int, similarity: float):
    """Chains of each row with each anchor; of single seeds also the shared ones that no proved stretch covers.

    A stretch that its matches prove is handed on by its start and end, without places of the anchor;
    only its two ends are aligned, as chains of one match.

    Matches come packed by bucket, each bucket with all matches of its rows. There are
    no more of them than seeds or pairs in the rows' texts.
    """

    def of_bucket(seed, row, anchor, x, a) -> Iterator[tuple]:
        # Groups are a row's matches with one anchor; matches of a place with itself chain nothing.
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])))
        again = np.concatenate(([False], ~new[1:] & (x[1:] == x[:-1]) & (a[1:] == a[:-1])))  # rows given twice
        other = np.flatnonzero(((anchor != row) | (x != a)) & ~again)
        group = (np.cumsum(new) - 1)[other]
        names, x1, a1 = (row[new], anchor[new]), x[other], a[other]
        if pairs:
            x1, a1 = np.concatenate((x1 >> 6, (x1 >> 6) + (x1 & 63))), np.concatenate((a1 >> 6, (a1 >> 6) + (a1 & 63)))
            group = np.concatenate((group, group))
            order = np.lexsort((a1, x1, group))
            group, x1, a1 = group[order], x1[order], a1[order]
            fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (x1[1:] != x1[:-1]) | (a1[1:] != a1[:-1])))[: len(group)]
            group, x1, a1 = group[fresh], x1[fresh], a1[fresh]
        keep = thinned(group, x1, a1)
        group, x1, a1 = group[keep], x1[keep], a1[keep]
        whole = plain(group, x1, a1)
        edges = np.flatnonzero(np.diff(group, prepend=-1)).tolist() + [len(group)]
        sure = []
        group, x1, a1 = group.tolist(), x1.tolist(), a1.tolist()
        rows, anchors = (c.tolist() for c in names)
        for i, j in zip(edges[:-1], edges[1:]):
            if j - i < 2:
                continue
            g, xs, ys = group[i], x1[i:j], a1[i:j]
            for found in [None] if whole[g] else chains(xs, ys):
                cx, ca = (xs, ys) if found is None else ([xs[k] for k in found], [ys[k] for k in found])
                for f, e, proved in pieces(cx, ca, min_words, similarity):
                    if not proved:
                        yield rows[g], anchors[g], ca[f], ca[e], cx[f : e + 1], ca[f : e + 1], None
                        continue
                    sure.append((rows[g], cx[f], cx[e] + RUN))
                    yield rows[g], anchors[g], 0, 0, [cx[f], cx[e] + RUN], [], None
                    for k in (f, e):
                        yield rows[g], anchors[g], ca[k], ca[k], [cx[k]], [ca[k]], None
        if not pairs:
            yield from loose(seed, row, x, sure)

    def loose(seed, row, x, sure: list[tuple]) -> Iterator[tuple]:
        """Rows with the shared seeds that no proved stretch covers, if some are as far apart as a pair."""
        names, at = np.unique(row, return_inverse=True)
        key = (at << 32) + x
        order = key.argsort(kind="stable")
        order = order[np.concatenate(([True], np.diff(key[order]) > 0))]
        key = key[order]
        inside = np.zeros(len(key) + 1, np.int64)
        if sure:
            of, start, end = np.array(sure, np.int64).T
            of = np.searchsorted(names, of) << 32
            np.add.at(inside, np.searchsorted(key, of + start), 1)
            np.add.at(inside, np.searchsorted(key, of + end - RUN, "right"), -1)
        free = np.cumsum(inside[:-1]) <= 0
        key, seed = key[free], seed[order[free]]
        paired = np.searchsorted(key, key + FAR, "right") > np.searchsorted(key, key + NEAR)
        x, at = key & 0xFFFFFFFF, key >> 32
        cuts = np.searchsorted(at, np.arange(len(names) + 1)).tolist()
        wanted = np.bincount(at, paired, len(names)) > 0
        for k in np.flatnonzero(wanted).tolist():
            yield int(names[k]), None, None, None, x[cuts[k] : cuts[k + 1]], None, seed[cuts[k] : cuts[k + 1]]

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _by_bucket(batches):
            yield _chain_rows(list(of_bucket(*bucket)))

    return chain


_CHAIN = "row long, anchor long, low int, high int, xs array<int>, ys array<int>, seeds array<long>"


def _chain_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    columns = zip(*out) if out else [[]] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["row", "anchor", "low", "high", "xs", "ys", "seeds"]
    )


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchor's words around each of its chains, from ``from`` on."""
    for batch in slices(batches, "text"):
        words, chains = Words(batch.column("text")), batch.column("chains")
        of = pa.compute.list_parent_indices(chains).to_numpy()
        row, low, high, xs, ys = chains.flatten().flatten()
        begin, end = words.ends[of], words.ends[of + 1]
        sure = pa.compute.list_value_length(ys).to_numpy() == 0  # proved, needs no words
        start = np.where(sure, 0, np.maximum(0, low.to_numpy() - FLANK))
        stop = np.where(sure, begin, np.minimum(end, begin + high.to_numpy() + RUN + FLANK))
        data, passages = words.data.tobytes(), []
        for i, j in zip((begin + start).tolist(), stop.tolist()):
            passages.append(data[words.first[i] : words.last[j - 1]] if i < j else b"")
        yield pa.RecordBatch.from_arrays(
            [row, xs, ys, batch.column("other_id").take(pa.array(of)), pa.array(passages, pa.binary()).cast(pa.string()), pa.array(start, pa.int32())],
            ["row", "xs", "ys", "other_id", "passage", "from"],
        )


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short runs."""
    same = 0
    for _ in "ab":  # what both begin or end with is in it
        n = min(len(a), len(b))
        run = int(np.append(a[:n] != b[:n], True).argmax())
        a, b, same = a[run:][::-1], b[run:][::-1], same + run
    if not len(a) or not len(b):
        return same
    before = np.zeros(len(b) + 1, np.int64)
    for v in a:
        now = before.copy()
        now[1:] = np.maximum(before[1:], before[:-1] + (b == v))
        before = np.maximum.accumulate(now)
    return same + int(before[-1])


def _flanks(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Short runs as columns of a table, and their lengths."""
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    out = np.zeros((int(sizes.max(initial=0)), len(runs)), np.uint64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[within, np.repeat(np.arange(len(runs)), sizes)] = np.concatenate(runs)
    return out, sizes


def _reaches(xs: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    return _reached(*_flanks(xs), *_flanks(others))


def _reached(x: np.ndarray, nx: np.ndarray, a: np.ndarray, na: np.ndarray) -> np.ndarray:
    """(words of x, words of a, equal words) of the best start of each pair of runs: 1 an equal word, -2 an edit.

    All pairs go through the table row by row together; a pair is left out once no row below can be better.
    """
    n = np.minimum(nx, na)
    most = int(n.max(initial=0))
    differ = np.concatenate((x[:most] != a[:most], np.ones((1, len(n)), bool)))
    run = np.minimum(differ.argmax(axis=0), n)
    out = np.repeat(run[:, None], 3, axis=1)
    left = np.flatnonzero(run < n)
    nx, na = (nx - run)[left], (na - run)[left]
    rows, columns = int(nx.max(initial=0)), int(na.max(initial=0))
    x = x[np.minimum(run[left] + np.arange(rows)[:, None], len(x) - 1), left]
    a = a[np.minimum(run[left] + np.arange(columns)[:, None], len(a) - 1), left]
    is_word = np.arange(columns)[:, None] < na
    unit = 1 << 10  # score in units, equal words below
    gap = (2 * unit * np.arange(columns + 1, dtype=np.int32))[:, None]
    row = np.repeat(-gap, len(left), axis=1)
    best = np.zeros(len(left), np.int32)
    for i in range(rows):
        now = row - 2 * unit
        equal = (a == x[i]) & is_word & (i < nx)
        np.maximum(now[1:], row[:-1] + np.where(equal, np.int32(unit + 1), np.int32(-2 * unit)), out=now[1:])
        row = np.maximum.accumulate(now + gap, axis=0) - gap
        top = row.max(axis=0)
        at = np.flatnonzero(top > best)
        best[at] = top[at]
        begun = run[left[at]]
        out[left[at]] = np.stack((begun + i + 1, begun + row[:, at].argmax(axis=0), begun + best[at] % unit), axis=1)
        if i % 4 == 3:
            keep = np.flatnonzero(top + (nx - i - 1) * (unit + 1) > best)
            left, best, nx, na = left[keep], best[keep], nx[keep], na[keep]
            x, a, row, is_word = x[:, keep], a[:, keep], row[:, keep], is_word[:, keep]
        if not len(left):
            break
    return out


def _beside(h: np.ndarray, at: np.ndarray, bound: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The words from ``at`` on to ``bound``, ``FLANK`` at most, as columns of a table, and their number; ``step`` -1 goes back."""
    size = np.minimum(FLANK, (bound - at) * step)
    k = np.arange(int(size.max(initial=0)))[:, None]
    place = at - (step < 0) + step * k
    return np.where(k < size, h[np.clip(place, 0, len(h) - 1)], np.uint64(0)), size


def align(x: np.ndarray, a: np.ndarray, chain: np.ndarray, xs: np.ndarray, ys: np.ndarray, mine: np.ndarray, other: np.ndarray):
    """(chain, start and end in x, span in a, equal words) of the aligned parts of chains, as arrays.

    ``xs`` and ``ys`` are places in ``x`` and ``a``, the words of many texts, and ``chain`` the number of each one's
    chain; ``mine`` and ``other`` are each chain's bounds in x and a. A gap over ``MAX_GAP`` words parts a chain.
    """
    dx, dy = np.diff(xs), np.diff(ys)
    inner = (chain[1:] == chain[:-1]) & (np.maximum(dx, dy) <= MAX_GAP)
    step = np.flatnonzero(inner)
    even = step[dx[step] == dy[step]]
    k = np.arange(dx[even].sum()) - np.repeat(np.cumsum(dx[even]) - dx[even], dx[even])
    alike = x[np.repeat(xs[even], dx[even]) + k] == a[np.repeat(ys[even], dx[even]) + k]
    equal = np.zeros(len(xs), np.int64)
    equal[even + 1] = np.bincount(np.repeat(np.arange(len(even)), dx[even]), alike, len(even)).astype(np.int64)
    whole = np.zeros(len(xs), bool)
    whole[even + 1] = equal[even + 1] == dx[even]
    for i in (step + 1)[~whole[step + 1]].tolist():
        equal[i] = _common(x[xs[i - 1] : xs[i]], a[ys[i - 1] : ys[i]])
    head = np.flatnonzero(np.concatenate(([True], ~inner)))
    tail = np.append(head[1:], len(xs)) - 1
    equal = RUN + np.add.reduceat(equal, head)
    n, x0, x1, y0, y1 = chain[head], xs[head], xs[tail] + RUN, ys[head], ys[tail] + RUN
    left = _reached(*_beside(x, x0, mine[n, 0], -1), *_beside(a, y0, other[n, 0], -1))
    right = _reached(*_beside(x, x1, mine[n, 1], 1), *_beside(a, y1, other[n, 1], 1))
    return n, x0 - left[:, 0], x1 + right[:, 0], y1 - y0 + left[:, 1] + right[:, 1], equal + left[:, 2] + right[:, 2]


def covered(n: int, parts: Iterable[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """Runs of covered words of ``min_words`` or more; parts may overlap and touch."""
    mark = np.zeros(n + 1, np.int64)
    for start, end in parts:
        mark[start] += 1
        mark[end] -= 1
    inside = np.concatenate(([0], (np.cumsum(mark[:n]) > 0).astype(np.int8), [0]))
    edge = np.flatnonzero(np.diff(inside))
    return [(s, e) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()) if e - s >= min_words]


def _aligner(similarity: float):
    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Accepted parts of each row's chains, in one row."""
        for batch in slices(batches, "text"):
            x, hits = Words(batch.column("text")), batch.column("hits")
            of = pa.compute.list_parent_indices(hits).to_numpy()
            xs, ys, ids, passages, start = hits.flatten().flatten()
            sure = np.flatnonzero(pa.compute.list_value_length(ys).to_numpy() == 0)
            left = np.flatnonzero(pa.compute.list_value_length(ys).to_numpy() > 0)
            found = [np.column_stack((sure, xs.take(pa.array(sure)).flatten().to_numpy().reshape(-1, 2)))]
            for i in range(0, len(left), TOGETHER):
                now = left[i : i + TOGETHER]
                took = pa.array(now)
                a, doc = Words(passages.take(took)), of[now]
                chain = pa.compute.list_parent_indices(ys.take(took)).to_numpy()
                mine = np.stack((x.ends[doc], x.ends[doc + 1]), axis=1)
                other = np.stack((a.ends[:-1], a.ends[1:]), axis=1)
                px = xs.take(took).flatten().to_numpy() + mine[chain, 0]
                py = ys.take(took).flatten().to_numpy() + (other[:, 0] - start.take(took).to_numpy())[chain]
                n, begin, end, span, equal = align(x.hashes, a.hashes, chain, px, py, mine, other)
                good = (end - begin >= LEAST) & (equal >= similarity * np.maximum(end - begin, span))
                n, begin, end = n[good], begin[good], end[good]
                found.append(np.column_stack((now[n], begin - mine[n, 0], end - mine[n, 0])))
            hit, begin, end = np.concatenate(found).astype(np.int64).T
            order = of[hit].argsort(kind="stable")
            hit, begin, end = hit[order], begin[order], end[order]
            rows, first = np.unique(of[hit], return_index=True)
            columns = [pa.array(begin, pa.int32()), pa.array(end, pa.int32()), ids.take(pa.array(hit))]
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(hit)), pa.int32()), pa.StructArray.from_arrays(columns, ["start", "end", "other_id"]))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(rows)), lists], ["row", "parts"])

    return parts


def _cleaner(min_words: int):
    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, parts = batch.column("text"), batch.column("parts")
            held = pa.compute.fill_null(pa.compute.list_value_length(parts), 0).to_numpy() > 0
            words, parts = Words(texts.filter(pa.array(held))), parts.filter(pa.array(held))
            start, end, other = parts.flatten().flatten()
            start, end, other = start.to_pylist(), end.to_pylist(), other.to_pylist()
            cuts = np.concatenate(([0], np.cumsum(pa.compute.list_value_length(parts).to_numpy()))).tolist()
            found: list[list] = [[]] * len(texts)
            changed, kept = np.zeros(len(texts), bool), []
            for k, n in enumerate(np.flatnonzero(held).tolist()):
                i, j = cuts[k], cuts[k + 1]
                spans, keep = _cut(words, k, start[i:j], end[i:j], other[i:j], min_words)
                if spans:
                    found[n], changed[n] = spans, True
                    kept.append(keep)
            if kept:
                texts = pa.compute.replace_with_mask(texts, pa.array(changed), pa.array(kept, pa.binary()).cast(texts.type))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), texts, pa.array(found, _FOUND)], ["rest", "clean", "passages"])

    return clean


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("same_as", pa.list_(pa.int64()))]))


def _cut(words: Words, k: int, starts: list[int], ends: list[int], others: list, min_words: int) -> tuple[list[dict], bytes]:
    """What goes from text ``k``, and what stays."""
    first, last = words.first[words.ends[k] : words.ends[k + 1]], words.last[words.ends[k] : words.ends[k + 1]]
    text, stop = int(words.at[k]), int(words.at[k + 1])
    data, spans, keep, now = words.data, [], [], text
    for s, e in covered(len(first), zip(starts, ends), min_words):
        same = {o for x, y, o in zip(starts, ends, others) if x < e and y > s and o is not None}
        begin, end = (int(b) - text - int(np.count_nonzero((data[text:b] & 0xC0) == 0x80)) for b in (first[s], last[e - 1]))
        spans.append({"start": begin, "end": end, "same_as": sorted(same)})
        keep.append(data[now : first[s]].tobytes())
        now = int(first[e]) if e < len(first) else stop
    return spans, b"".join([*keep, data[now:stop].tobytes()])


def _matches(cells: DataFrame, parts: int) -> DataFrame:
    """Matches of each shared key's holders, packed by bucket."""
    found = cells.repartition("part").sortWithinPartitions("part")
    return found.mapInArrow(_matcher(max(BUCKETS, parts)), _MATCHED_KIND)


def _chains(matches: DataFrame, pairs: bool, min_words: int, similarity: float) -> DataFrame:
    dealt = matches.repartition("bucket").sortWithinPartitions("bucket")
    return write_and_reread(dealt.mapInArrow(_chainer(pairs, min_words, similarity), _CHAIN), "chains")


def _layout(n: int) -> tuple[int, int]:
    """(parts, leading bits of a key to keep) for ``n`` keys: one key in 64 meets a stranger."""
    parts = 1 << max(4, math.ceil(math.log2(max(n, 1) / PART)))
    return parts, min(64, max(32, math.ceil(math.log2(max(n, 1))) + 6))


def _parts(chained: DataFrame, named: DataFrame, similarity: float) -> DataFrame:
    """Accepted parts (start, end, other_id) of chains, a list for each row that has some."""
    chained = chained.select("row", "anchor", "low", "high", "xs", "ys")
    wanted = chained.select("row").union(chained.select("anchor")).distinct()
    held = named.join(broadcast_if_small(wanted), "row", "left_semi").dropDuplicates(["row"])
    holders = held.select(F.col("row").alias("anchor"), F.col("id").alias("other_id"), "text")
    # An anchor's text is handed on once for so many chains, not with each, and no group grows with the table.
    place = F.row_number().over(Window.partitionBy("anchor").orderBy("row"))
    chunks = chained.withColumn("chunk", F.floor(place / CHUNK)).groupBy("anchor", "chunk")
    chunks = chunks.agg(F.collect_list(F.struct("row", "low", "high", "xs", "ys")).alias("chains"))
    fetched = chunks.join(holders, "anchor").mapInArrow(
        _fetch, "row long, xs array<int>, ys array<int>, other_id long, passage string, from int"
    )
    hits = fetched.groupBy("row").agg(F.collect_list(F.struct("xs", "ys", "other_id", "passage", "from")).alias("hits"))
    # With the id, which is not read there, both joins take the texts from one exchange.
    return held.select("row", "id", "text").join(hits, "row").mapInArrow(
        _aligner(similarity), "row long, parts array<struct<start:int,end:int,other_id:bigint>>"
    )


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """All rows and columns, the text without repeated passages, and ``passages``.

    ``passages`` lists what was cut: start and end in characters of the given text and, in
    ``same_as``, the ids of documents that hold it earlier. Passages repeated inside one
    document count too. A null text stays null with no passages, as do texts of under
    ``min_words`` words; a text may become empty, its row stays. Rows equal in id and text
    are treated alike, as one document. A null id works but is not listed in ``same_as``. A
    column ``n_chars`` is brought up to date if there is one; others pass through, but a
    column ``passages`` is replaced. No rows give no rows.
    """
    bound_batches(docs.sparkSession)
    own = [c for c in docs.columns if c != "passages"]
    text = F.col(f"`{text_col}`").cast("string")
    row = F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("row")
    named = docs.where(text.isNotNull()).select(row, F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    parts, bits = _layout(chars // 5)
    cells = named.select("row", "text").mapInArrow(_seeder(window, parts, bits), _CELL_KIND)
    chained = _chains(_matches(cells, parts), False, min_words, similarity)
    loose = chained.where("anchor is null").select("row", "xs", "seeds")
    parts, bits = _layout(chars)
    cells = loose.mapInArrow(_pairer(parts, bits), _CELL_KIND)
    paired = _chains(_matches(cells, parts), True, min_words, similarity)
    parts = _parts(chained.where("anchor is not null").union(paired), named, similarity)
    rest = [F.col(f"`{c}`") for c in own if c != text_col] or [F.lit(None).cast("int").alias("none")]
    packed = docs.select(row, F.struct(*rest).alias("rest"), text.alias("text"))
    whole = packed.join(parts, "row", "left").select("rest", "text", "parts")
    kind = whole.schema["rest"].dataType.simpleString()
    cleaned = whole.mapInArrow(
        _cleaner(min_words),
        f"rest {kind}, clean string, passages array<struct<start:int,end:int,same_as:array<bigint>>>",
    )
    fresh = {text_col: F.col("clean")}
    if "n_chars" in own:
        length = F.coalesce(F.length("clean"), F.col("rest.n_chars"))
        fresh["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*(fresh.get(c, F.col(f"rest.`{c}`")).alias(c) for c in own), "passages")
