"""Alignment of tokenizers against a plain walk over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dayledger.llm import crosstok, queries

A, B = queries.BYTE_BPE, queries.PIECE_BPE
MARKS = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "​", " ", "a", "aaaa", "'s", "12", "é",
    "é", "中文", "\U0001f600", "_", "##", " the", "ing", " internationalisation", "ther", "<s>", "</s>", "<0x41>",
    "<|endoftext|>", "\x00", ";\r", "{", ">",
]


class Plain:
    """The libraries on whole texts, and a walk over bytes."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.bytes_of = crosstok.Sides(A, B).bytes_of

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spelt = [b"".join(of[i] for i in ids) for of, ids in zip(self.bytes_of, (a, b))]
        return (a, b) if spelt[0] == spelt[1] == (" " + text).encode() else ([], [])

    def spans(self, side, ids):
        out, at = [], 0
        for i in ids:
            out.append((at, at := at + len(self.bytes_of[side][i])))
        return out

    def aligned(self, text):
        """(a, b, groups as text, links as (place in a, place in b))."""
        a, b = self.tokens(text)
        x, y = self.spans(0, a), self.spans(1, b)
        cuts = sorted({e for _, e in x} & {e for _, e in y})
        groups, low = [], 0
        for cut in cuts:
            inside = [",".join(str(i) for i, (s, e) in zip(ids, at) if low <= s and e <= cut) for ids, at in ((a, x), (b, y))]
            groups.append("|".join(inside))
            low = cut
        links = [(i, j) for i, (s, e) in enumerate(x) for j, (t, f) in enumerate(y) if s < f and t < e]
        return a, b, ";".join(groups), links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, sha."""
    found = [plain.aligned(t) for t in texts]
    count = Counter((a[i], b[j]) for a, b, _, links in found for i, j in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for a, b, groups, links in found:
        pairs = [(a[i], b[j]) for i, j in links]
        sha = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        out.append((len(a), len(b), groups.count(";") + 1 if a else 0, len(links), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs), sha))
    return out


def texts(seed, n, most=25):
    rng = random.Random(seed)
    return ["".join(rng.choices(MARKS, k=rng.randrange(most))) for _ in range(n)]


def test_end_arrays():
    rng = random.Random(4)
    for _ in range(2000):
        n = rng.randrange(1, 150)
        cuts = [sorted({*rng.sample(range(1, n), int(p * (n - 1))), n}) for p in (rng.random(), rng.random())]
        common = set(cuts[0]) & set(cuts[1])
        inner = crosstok.irregular(*cuts)
        assert [[i for i, e in enumerate(c) if e not in common] for c in cuts] == list(map(list, inner))
    long = list(range(1, 100_000))
    assert crosstok.irregular(long, long) == ([], []) and crosstok.irregular([], []) == ([], [])
    assert crosstok.irregular([*long[:500], *long[501:]], long) == ([], [500])


def test_random_texts(plain):
    some = [None, "", "▁", "a▁b", "\x00", *texts(1, 600), " ".join(texts(2, 300))]
    x = crosstok.Aligned(crosstok.Sides(A, B, size=50), some)
    for column in ("a_ids", "b_ids", "link_a", "link_b", "a_sizes", "b_sizes"):
        assert len(crosstok._column(column, x)) == len(some)
    got = [crosstok._column(c, x).to_pylist() for c in ("a_ids", "b_ids", "groups", "link_a", "link_b", "a_sizes", "b_sizes")]
    for text, a, b, groups, la, lb, sa, sb in zip(some, *got):
        assert (a, b, groups, list(zip(la, lb))) == tuple(plain.aligned(text)), repr(text)
        assert sum(sa) == len(a) and sum(sb) == len(b) and len(sa) == len(sb) == (groups.count(";") + 1 if a else 0)


def test_a_forgetful_worker_gives_the_same(plain):
    sides, some = crosstok.Sides(A, B, size=2), texts(9, 60)
    for _ in range(2):
        (a, n_a), (b, n_b) = sides.encode(some)
        assert [x.tolist() for x in np.split(a, np.cumsum(n_a))[:-1]] == [plain.tokens(t)[0] for t in some]
        assert [x.tolist() for x in np.split(b, np.cumsum(n_b))[:-1]] == [plain.tokens(t)[1] for t in some]


@pytest.mark.parametrize("block", [1, 40, crosstok.BLOCK])
def test_counts_over_blocks(spark, plain, block):
    some = [*texts(21, 60, 12), None, "", "the the the", "the the the", "x▁y", "the cat " * 50]
    rows = spark.createDataFrame(list(enumerate(some)), "doc_id int, text string").repartition(3)
    got = crosstok.link_weights(crosstok.align(rows, A, B, ["n_a", "n_b", "n_groups", "n_links", "groups"], brief=True, block=block))
    got = {r["doc_id"]: r for r in got.collect()}
    for i, want in enumerate(expected(plain, some)):
        r = got[i]
        sha = hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else ""
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], sha) == want
    assert len(got) == len(some)


def test_rows_of_every_kind(spark, odd, plain):
    rows = odd.withColumnRenamed("kept", "n_best").withColumnRenamed("row", "block").withColumnRenamed("lang", "pairs")
    got = crosstok.align(rows, A, B)
    assert got.count() == rows.count() and set(got.columns) == set(rows.columns) - {"text"} | set(crosstok.COLUMNS)
    weighted = crosstok.link_weights(crosstok.align(rows, A, B, ["n_links"], brief=True, block=100))
    assert weighted.count() == rows.count() and weighted.columns.count("n_best") == 1
    empty = crosstok.link_weights(crosstok.align(rows.limit(0), A, B, ["groups"], brief=True))
    assert empty.count() == 0


def test_query_against_the_walk(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r["text"] or "") < 3000]
    sub = spark.createDataFrame(short, "doc_id long, text string")
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    got = crosstok.link_weights(crosstok.align(sub, A, B, [*counts, "groups"], brief=True))
    got = {r["doc_id"]: r for r in got.collect()}
    for r, want in zip(short, expected(plain, [r["text"] for r in short])):
        x = got[r["doc_id"]]
        assert tuple(x[c] for c in [*counts, "n_best", "count_sum"]) == want[:-1]
    whole = queries.QUERIES["op13_cross_tokenizer"](spark, sf_dir)
    assert whole.count() == len(docs)
    assert {(r["doc_id"], r["groups_sha256"]) for r in whole.collect()} >= {(r["doc_id"], hashlib.sha256(got[r["doc_id"]]["groups"].encode()).hexdigest()) for r in short if r["text"]}
