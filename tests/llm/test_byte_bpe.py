"""Byte-level BPE against the library that the ranks are made for."""

import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken

from dayledger.llm import bytebpe, queries, units

PATH, PATTERN = queries.BYTE_RANKS, public_tokenizers.PATTERN
MARKS = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "​", " ", "﻿", "a", "aaaa", "'s",
    "'ll", "'", "12", "3", "٤", "é", "é", "中文", "\U0001f600", "_", "##", "▁", " the", "ing", "ther",
    "<|endoftext|>", "\x00", "not a piece",
]


@pytest.fixture(scope="module")
def library():
    ranks = bytebpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_as_the_library(library):
    bpe, rng = bytebpe.ByteBpe(PATH, PATTERN), random.Random(11)
    texts = ["".join(rng.choices(MARKS, k=rng.randrange(30))) for _ in range(8000)]
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert bpe.decode(ids)[0].tobytes() == text.encode()


def test_every_token_and_every_character_of_two_bytes(library):
    bpe = bytebpe.ByteBpe(PATH, PATTERN)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts += [t.decode() for t in library.token_byte_values() if b"\xef\xbf\xbd" not in t and t.decode("utf-8", "ignore").encode() == t]
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)


def test_a_forgetful_worker_and_small_slices_change_nothing(library, monkeypatch):
    bpe, rng = bytebpe.ByteBpe(PATH, PATTERN, size=3), random.Random(3)
    text = "".join(rng.choices(MARKS, k=4000))
    monkeypatch.setattr(units.slices, "__defaults__", (50,))
    assert len(list(units.slices(text))) > 20 and "".join(units.slices(text)) == text
    assert bpe.encode([text] * 3)[2].tolist() == library.encode_ordinary(text)


def test_a_vocabulary_whose_tokens_merges_do_not_reach(tmp_path):
    """'abc' is a token of its own, but merging 'bc' first leads to other ids: as a whole match it is still 'abc'."""
    import base64

    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 301, b"abc": 310, b"bcd": 302, b"abcd": 303}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = bytebpe.ByteBpe(str(path), PATTERN)
    texts = ["abc", "abcd", "xabc", "abc abcd bcd", "ab", "cab", "aabbccdd", "abcabcd"]
    assert [i.tolist() for i in bpe.encode(texts)] == [own.encode_ordinary(t) for t in texts]
    with pytest.raises(ValueError):
        bpe.decode(np.array([299]))
    with pytest.raises(ValueError):
        bytebpe.serialised_model({b"a": 0})


def test_rows_of_every_kind(spark, odd, library):
    rows = odd.withColumnRenamed("kept", "ids")  # a clashing name
    got = bytebpe.decode(bytebpe.encode(rows, PATH, PATTERN), PATH, PATTERN)
    assert set(got.columns) == set(rows.columns) | {"bytes"}
    for r in got.collect():
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["bytes"]) == (r["text"] or "").encode()
    assert got.count() == rows.count()
    assert bytebpe.encode(rows.limit(0), PATH, PATTERN).count() == 0
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["bytes"] for r in bytebpe.decode(empty, PATH, PATTERN).orderBy("doc_id").collect()] == [None, b""]


def test_query_against_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        sha = lambda data: hashlib.sha256(data).hexdigest()
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    got = [tuple(r) for r in queries.QUERIES["op11_byte_bpe"](spark, sf_dir).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
