"""Document operators against brute force, and on odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from oracle import difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from dayledger.llm import licenses, linededup, maxplus, minhash, packing, passages, quality, toxicity, words
from dayledger.llm.queries import ORACLES, PIECE_BPE, QUERIES, WORD_BPE

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(spark, SMALL, QUERIES[name], ORACLES[name]) == ""


def prose(seed, n, pool=4000):
    rng = random.Random(seed)
    return [f"v{rng.randrange(pool)}" for _ in range(n)]


def test_signatures_estimate_weighted_overlap_without_bias():
    rng = np.random.default_rng(3)
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    element = np.arange(60, dtype=np.uint64) * np.uint64(7919)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    slots = 4000
    s = minhash.bag_signatures(
        np.concatenate([element, element]), np.concatenate([a, b]), np.repeat([0, 1], 60), 2, slots
    )
    assert abs((s[0] == s[1]).mean() - true) < 4 * (true * (1 - true) / slots) ** 0.5


def test_near_duplicates_on_odd_rows(odd):
    rows = [tuple(r) for r in minhash.near_duplicates(odd).collect()]
    assert len(rows) == 9
    assert (1, 1, True) in rows and (2, 2, True) in rows and (None, None, True) in rows
    assert rows.count((5, 5, True)) == 3
    assert minhash.near_duplicates(odd.limit(0)).count() == 0
    kept = minhash.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == 9


def test_near_dedup_stage_keeps_one_row_of_a_document(spark, table):
    texts = [" ".join(prose(70 + k, 60)) for k in range(3)]
    rows = [(7, texts[0], "en", f"s{k}") for k in range(20)] + [(None, texts[1])] * 5 + [(8, texts[0]), (9, texts[2]), (1, None)]
    kept = corpus_pipeline.near_dedup(spark, table(rows), SMALL)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(7, texts[0]), (None, texts[1]), (9, texts[2]), (1, None)]
    )


def test_chain_of_copies_is_one_class(table):
    base = prose(1, 200)
    texts = [" ".join(base[k * 3 : k * 3 + 120]) for k in range(12)]
    rows = minhash.near_duplicates(table([(i, t) for i, t in enumerate(texts)] + [(50, " ".join(prose(9, 90)))])).collect()
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    assert {classes[i] for i in range(12)} == {0} and classes[50] == 50
    assert sorted(r["doc_id"] for r in rows if r["stays"]) == [0, 50]


def test_lines_against_exact_counts(spark, table):
    lines = [" ".join(prose(k, 5)) for k in range(30)]
    rng = random.Random(5)
    rows = [(d, "\n".join(rng.sample(lines, 6) + [f"own line of {d} here"]), "en", f"s{rng.randrange(14)}") for d in range(120)]
    sites, first = {}, {}
    for d, text, _, s in rows:
        for line in text.split("\n"):
            sites.setdefault(line, set()).add(s)
            first.setdefault(line, d)
    want = {
        d: "\n".join(x for x in text.split("\n") if len(sites[x]) < 10 or first[x] == d) for d, text, *_ in rows
    }
    got = linededup.remove_boilerplate(table(rows))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert got.where("n_chars <> length(text)").count() == 0


def test_short_and_blank_free_lines_are_boilerplate(table):
    common = ["Menu", "Read more", "\u7248\u6743\u6240\u6709\u4e0d\u5f97\u8f6c\u8f7d"]
    rows = [(d, "\n".join([*common, "", f"own{d}", "few" if d < 9 else "x y"]), "en", f"s{d}") for d in range(12)]
    got = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in linededup.remove_boilerplate(table(rows)).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[d] == (f"\nown{d}\n" + ("few" if d < 9 else "x y"), 3) for d in range(1, 12))


def test_lines_on_odd_rows(odd):
    got = linededup.remove_boilerplate(odd)
    assert got.columns == [*odd.columns, "lines_removed"] and got.count() == 9
    assert got.agg(F.sum("lines_removed")).first()[0] == 0
    assert linededup.remove_boilerplate(odd.limit(0)).count() == 0


def test_passages_are_cut_but_once(table):
    passage = prose(7, 60)
    fuzzy = passage[:25] + ["changed"] + passage[26:]
    rows = [(d, " ".join(prose(20 + d, 80) + (fuzzy if d == 4 else passage) + prose(40 + d, 30))) for d in range(6)]
    got = {r["doc_id"]: r for r in passages.repeated_passages(table([*rows, (9, " ".join(prose(90, 200)))])).collect()}
    cut = [d for d in range(6) if got[d]["passages"]]
    assert len(cut) == 5 and not got[9]["passages"]
    for d in cut:
        text, (found,) = rows[d][1], got[d]["passages"]
        own = text.split(" ")
        assert text[found["start"] : found["end"]].split(" ") == own[80:140]
        assert got[d]["text"].split() == own[:80] + own[140:]
        assert found["same_as"]


def test_passage_of_common_sentences_is_cut(table):
    rng = random.Random(11)
    sentences = [prose(200 + k, 10) for k in range(24)]
    rows = [(d, " ".join(prose(300 + d, 30) + sentences[d % 24] + prose(900 + d, 30))) for d in range(480)]
    want = []
    for k in range(10):
        passage = sum(rng.sample(sentences, 6), [])
        want.append((1000 + 2 * k, 1001 + 2 * k))
        rows += [(d, " ".join(prose(2000 + d, 40) + passage + prose(3000 + d, 40))) for d in want[-1]]
    got = {r["doc_id"]: r for r in passages.repeated_passages(table(rows)).collect()}
    assert [sorted(len(got[d]["text"].split()) for d in pair) for pair in want] == [[80, 140]] * 10
    assert not any(got[d]["passages"] for d in range(480))


def edited(words, share, rng):
    """``words`` with a share of substitutions, insertions and deletions."""
    out = list(words)
    for i in sorted(rng.sample(range(len(out)), round(share * len(out))), reverse=True):
        kind = rng.randrange(3)
        out[i : i + (kind != 1)] = [] if kind == 2 else [f"edit{rng.randrange(10**9)}"]
    return out


@pytest.mark.parametrize("n, share, least", [(60, 0.1, 38), (80, 0.1, 39), (60, 0.15, 34), (80, 0.15, 38)])
def test_recall_of_edited_passages(table, n, share, least):
    rng, rows = random.Random(n), []
    for k in range(40):
        passage = prose(5000 + k, n)
        for d, text in ((2 * k, passage), (2 * k + 1, edited(passage, share, rng))):
            rows.append((d, " ".join(prose(6000 + d, 60) + text + prose(7000 + d, 60))))
    got = {r["doc_id"]: len(r["text"].split()) for r in passages.repeated_passages(table(rows)).collect()}
    size = {d: len(t.split()) for d, t in rows}
    assert sum(any(size[d] - got[d] >= 0.8 * n for d in (2 * k, 2 * k + 1)) for k in range(40)) >= least


def test_passages_on_odd_rows(odd):
    got = passages.repeated_passages(odd)
    assert got.columns == [*odd.columns, "passages"] and got.count() == 9
    assert got.where("size(passages) > 0").count() == 0
    assert passages.repeated_passages(odd.limit(0)).count() == 0


def test_best_chain_against_all_chains():
    rng = random.Random(2)
    for _ in range(30):
        pairs = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(9)})
        x, a = [p[0] for p in pairs], [p[1] for p in pairs]
        cost = 1 / (2 * passages.MAX_GAP)
        best = [1.0] * len(x)
        for i in range(len(x)):
            for j in range(i):
                if x[j] < x[i] and a[j] < a[i]:
                    best[i] = max(best[i], 1 + best[j] - cost * (x[i] - x[j] + a[i] - a[j]))
        found = passages.chains(x, a)
        if max(best) > 1:
            top = found[0]
            score = len(top) - cost * (x[top[-1]] - x[top[0]] + a[top[-1]] - a[top[0]])
            assert abs(score - max(best)) < 1e-9


def test_toxicity_on_held_out_rows_and_odd_rows(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels)
    english = got.join(docs.where("lang = 'en'").select("doc_id"), "doc_id").join(labels, "doc_id").where("held_out")
    assert english.where("toxic = predicted").count() >= 0.9 * english.count()
    none = labels.limit(0)
    rows = toxicity.toxicity(odd, none).collect()
    assert len(rows) == 9 and all(0 < r["score"] < 0.5 and r["predicted"] == 0 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


@pytest.mark.parametrize(
    "text, n",
    [("You IDIOT!", 1), ("1d10t and \u0456diot", 2), ("idiotic-ish", 1), ("class clown", 0), ("clowns", 0), ("m\u00f6ron", 1), ("cl\u200bown", 1)],
)
def test_folded_matches(text, n):
    assert sum(toxicity.matches(text).values()) == n


def test_licences(table):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0.\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
        (2, "Words. This work is licensed under the GNU General Public License, version 3. More words"),
        (3, "Released under the MIT License."),
        (4, "no such thing"),
        (5, None),
        (6, ""),
    ]
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(table(rows)).collect()}
    assert got == {1: ["Apache-2.0"], 2: ["GPL-3.0-only"], 3: ["MIT"], 4: [], 5: [], 6: []}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
BSD = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above
   copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version."""


def test_wrapped_licences(table):
    def comment(mark, text):
        return "\n".join(f"{mark} {x}".rstrip() for x in text.split("\n"))

    texts = {
        "MIT": [MIT, "/*\n" + comment(" *", MIT) + "\n */", comment("#", MIT), MIT.replace("\n", "\r\n")],
        "BSD-2-Clause": [BSD.split("\n\n", 1)[1], comment("//", BSD.split("\n\n", 1)[1])],
        "proprietary BSD-2-Clause": [BSD, comment("#", BSD)],
        "GPL-3.0-or-later": [GPL.format(":", ",", 3), comment("//", GPL.format(";", ";", 3))],
        "GPL-2.0-or-later": [GPL.format(";", ";", 2), GPL.format(";", ",", 2)],
        "GPL-2.0-only": [GPL.split(" either")[0].format(";", ";") + " version 2\nof the License."],
        "AGPL-3.0-or-later": [GPL.format(";", ",", 3).replace("GNU General", "GNU Affero General")],
        "SPDX": ["SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: GPL-2.0+\n// Copyright 2020 Some Body\nint x;"],
        "Apache-2.0": ["Copyright 2020 Some Body\nLicensed under the Apache\nLicense, Version 2.0"],
        "": ["Redistributions must hold the\ncopyright notice"],
        "MIT CC-BY-4.0": ["Code released under the MIT License\nText licensed under CC BY 4.0"],
    }
    cases = [(want, text) for want, group in texts.items() for text in group]
    rows = table([(i, text) for i, (_, text) in enumerate(cases)])
    got = {r["doc_id"]: " ".join(r["licences"]) for r in licenses.scan(rows).collect()}
    assert [(got[i], text) for i, (_, text) in enumerate(cases)] == cases


def test_encoding_does_not_depend_on_chunks(spark, odd):
    want = {tuple(r) for r in maxplus.encode(odd, PIECE_BPE).select("doc_id", F.hash("ids")).collect()}
    nospace = odd.limit(1).select("doc_id", F.lit("abc\u4e2d" * 70).alias("text"))
    rows = odd.select("doc_id", "text").union(nospace)
    for chunk, block in ((40, 3), (64, 64)):
        few = rows.where("doc_id is null or doc_id <> 4").union(rows.where("doc_id = 4").select("doc_id", F.substring("text", 1, 900)))
        a = maxplus.encode(few, PIECE_BPE, chunk=chunk, block=block)
        b = maxplus.encode(few, PIECE_BPE)
        assert Counter(map(str, a.collect())) == Counter(map(str, b.collect()))
    assert len(want) == 8
    back = maxplus.decode(maxplus.encode(rows, PIECE_BPE), PIECE_BPE).select("doc_id", "text")
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, rows.collect()))
    assert maxplus.encode(odd.limit(0), PIECE_BPE).count() == 0


def test_encoding_is_the_best_path():
    v = maxplus.vocabulary(PIECE_BPE)
    for text in (" hello world", " \u4e2d internationalisation\n  x", " aaaaaaa"):
        best = {0: 0}
        for i in range(len(text)):
            for to, score, _ in v.edges(text, i, len(text)):
                best[to] = max(best.get(to, -(10**18)), best[i] + score)
        assert sum(u[0] for u in v.units(text)) == best[len(text)]


def test_starts_found_together_are_the_best_ones():
    draw = random.Random(5)
    pairs = [([draw.randrange(9) for _ in range(draw.randrange(65))], draw.random()) for _ in range(60)]
    xs = [np.array(x, np.uint64) for x, _ in pairs]
    others = [np.array([w for w in x for _ in range(1 + (draw.random() < r / 4)) if draw.random() > r / 4][:64], np.uint64) for x, r in pairs]
    for x, a, found in zip(xs, others, passages._reaches(xs, others).tolist()):
        score = {(0, 0): (0, 0)}
        for i in range(len(x) + 1):
            for j in range(len(a) + 1):
                if i or j:
                    same = i and j and x[i - 1] == a[j - 1]
                    before = [(i - 1, j, 0), (i, j - 1, 0), (i - 1, j - 1, bool(same))]
                    score[i, j] = max((score[p, q][0] + (1 if s else -2), score[p, q][1] + s) for p, q, s in before if p >= 0 and q >= 0)
        best = max(s for s, _ in score.values())
        assert score[found[0], found[1]] == (best, found[2])


def test_words_are_hashed_as_they_are_parted():
    texts = ["", None, " a  b\tc\n", "x\x1cy  z a", "\U0001f600 caf\u00e9 \u4e2d", *(" ".join("ab" * n for n in range(k, k + 3)) for k in (2, 200))]
    got = words.Words(pa.array(["not these", *texts]).slice(1))
    seen = {}
    for i, text in enumerate(texts):
        own, h = words.words_of(text), got.of(i).tolist()
        at = range(got.ends[i], got.ends[i + 1])
        assert [got.data[got.first[k] : got.last[k]].tobytes().decode() for k in at] == own and len(h) == len(own)
        assert all(seen.setdefault(w, v) == v for w, v in zip(own, h))
    assert len(set(seen.values())) == len(seen)


def test_parts_of_a_document_come_in_one_row():
    passage = prose(1, 120)
    text = " ".join(prose(2, 30) + passage[:50] + prose(3, 100) + passage[60:] + prose(4, 30))
    xs, ys = ([30, 40, 75], [180, 200, 235]), ([0, 10, 45], [60, 80, 115])
    hits = [{"xs": x, "ys": y, "other_id": 7, "passage": " ".join(passage), "from": 0} for x, y in zip(xs, ys)]
    hits.append({"xs": [1, 9], "ys": [], "other_id": None, "passage": "", "from": 0})
    kind = pa.struct([("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32())), ("other_id", pa.int64()), ("passage", pa.string()), ("from", pa.int32())])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5, 6], pa.int64()), pa.array([text, "short"]), pa.array([hits, []], pa.list_(kind))], ["row", "text", "hits"]
    )
    (got,) = (r for b in passages._aligner(0.8)([batch]) for r in b.to_pylist())
    assert got["row"] == 5
    assert sorted((p["start"], p["end"], p["other_id"] or 0) for p in got["parts"]) == [(1, 9, 0), (30, 80, 7), (180, 240, 7)]


def test_each_cut_document_gives_one_row_of_parts(spark, table, monkeypatch):
    passage, seen = prose(8, 60), []
    rows = table([(d, " ".join(prose(400 + d, 30) + passage + prose(500 + d, 30))) for d in range(30)])
    joined = passages._parts

    def watched(chained, named, similarity):
        seen.append((chained.count(), joined(chained, named, similarity)))
        return seen[-1][1]

    monkeypatch.setattr(passages, "_parts", watched)
    assert passages.repeated_passages(rows).where("size(passages) > 0").count() == 29
    ((n_chains, parts),) = seen
    assert n_chains >= 29 and parts.count() == 29


def test_batches_for_workers_are_bounded(spark, odd):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    corpus_pipeline.quality_rules(spark, odd, SMALL)
    assert spark.conf.get(key) == "4m"
    spark.conf.set(key, "16m")
    passages.repeated_passages(odd.limit(0))
    assert spark.conf.get(key) == "16m"
    spark.conf.unset(key)


def test_matches_travel_packed_and_sorted():
    draw = np.random.default_rng(1)
    key, place, first = (draw.integers(0, 1 << 40, 500).astype(np.uint64), *(draw.integers(0, 900, 500) for _ in "ab"))
    row, anchor = (draw.choice(draw.integers(-(1 << 63), 1 << 63, 20), 500) for _ in "ab")
    got = [list(zip(*c)) for c in passages._by_bucket([passages._matched(512, key, row, anchor, place, first)])]
    want = Counter(zip(key.tolist(), row.tolist(), anchor.tolist(), place.tolist(), first.tolist()))
    assert Counter(tuple(map(int, m)) for g in got for m in g) == want
    assert all(g == sorted(g, key=lambda m: m[1:]) for g in got) and len(got) <= 20


def test_quality_sends_a_text_once_and_remembers_little(spark, odd):
    judged = quality.quality(odd, PIECE_BPE)
    sent = judged._jdf.queryExecution().analyzed().children().head().schema().fieldNames()
    assert list(sent) == ["row", "lang"]
    assert quality._pieces(PIECE_BPE).size <= 150_000 and words._HASHES.size <= 100_000
    other = quality.quality(odd.withColumn("text", F.col("text").cast("binary")), PIECE_BPE)
    both = [Counter(str(r[1:]) for r in df.collect()) for df in (judged, other)]
    assert both[0] == both[1]


def test_units_learnt_together_are_encoded_as_alone():
    v = maxplus.Vocabulary(PIECE_BPE)
    words = [f" {a}{b}" for a in ("inter", "donau", "\u00e9t\u00e9", "x\x00", "\x00", "\u4e2d\U0001f600", "\U0001f600") for b in ("national", "", "q\x00", "\u4e2d", "zzzz1999")]
    words += ["\n", "   ", "a", "\x00", " " + "long" * 30] + [f" {n}th" for n in range(200)]
    alone = {u: v._unit(u) for u in words}
    calls, one = [], v._unit
    v._unit = lambda u: calls.append(u) or one(u)
    text = " start" + "".join(words)
    assert v.encode_all([text, "", text]) == [v.encode(text), b"", v.encode(text)]
    assert all(v.known[u] == alone[u] for u in words if u in v.known) and len(v.known) > 200
    assert {len(u) > maxplus.WIDE for u in calls} == {True}
    assert np.frombuffer(v.encode_all([" \x00"])[0], "<i4").tolist() == v.trace(v.best(" \x00", 0, 2, 2), 2)


def test_packing_holds_its_contract(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = packing.pack(docs, WORD_BPE).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for i in range(0, len(ids), 4096):
            part = ids[i : i + 4096]
            want[r["doc_id"], i // 4096, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(places) <= -(-sum(r["length"] for r in rows) // 4096) + 1
    assert packing.pack(odd.limit(0), WORD_BPE).count() == 0


def test_plan_is_best_fit():
    rng = random.Random(4)
    for _ in range(20):
        capacity = 50
        items = Counter(rng.randint(1, capacity) for _ in range(200))
        rooms = []
        for length in sorted(items.elements(), reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(capacity - length)
        planned = packing.plan(dict(items), capacity)
        used = {int(first + (r - low) // per) for _, low, end, first, per, _ in planned for r in range(low, end)}
        assert len(used) == len(rooms)


def test_quality_base_measures(odd):
    rows = quality.quality(odd, PIECE_BPE).collect()
    assert len(rows) == 9
    for r in rows:
        text = r["row"]["text"] or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        assert r["kept"] is False or not r["base_failed"]
    good = quality.keep_good(odd, PIECE_BPE)
    assert good.columns == odd.columns
    assert quality.quality(odd.limit(0), PIECE_BPE).count() == 0


def test_repeats():
    for text in ("a b c a b c d", "a a a a", "x y", "a b a b a b c"):
        words = text.split()
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        assert quality.repeated_words(np.array([hash(w) % 1000 for w in words])) == len(covered)
    assert quality.repeated_lines("a\n\nb\na\n \na") == 2


def test_other_languages_are_judged_by_script():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE_BPE
    assert quality._script("\u4e2d\u6587") == "other" and quality._script("word") == "Latin"


def test_scripts_have_bands_that_reject(table):
    russian = "\u0412\u0447\u0435\u0440\u0430 \u0432\u0435\u0447\u0435\u0440\u043e\u043c \u043c\u044b \u0434\u043e\u043b\u0433\u043e \u0433\u0443\u043b\u044f\u043b\u0438 \u043f\u043e \u0441\u0442\u0430\u0440\u043e\u043c\u0443 \u0433\u043e\u0440\u043e\u0434\u0443"
    symbols = [chr(0x13000 + k % 400) + chr(0x2590 + k % 7) for k in range(120)]
    broken = [chr(0x400 + 7 * k % 80) + chr(0x48a + 11 * k % 150) for k in range(120)]
    rng = random.Random(1)
    good = [a + b for a in russian.split() for b in russian.split()]
    rng.shuffle(good)
    names = {"\u4e2d\u6587": "Han", "\u304b\u306a \u4e2d": "Kana", "\u03b1\u03b2": "Greek", "\u0431": "Cyrillic", "ab": "Latin", "?": "other"}
    assert {t: quality._band(t) for t in names} == names
    rows = [(k, " ".join(words), "xx") for k, words in enumerate((good, symbols, broken))]
    got = {r["row"]["doc_id"]: r for r in quality.quality(table(rows), PIECE_BPE).collect()}
    assert not any(got[k]["base_failed"] for k in range(3))
    assert [(got[k]["band"], got[k]["kept"]) for k in range(3)] == [("Cyrillic", True), ("other", False), ("Cyrillic", False)]


def test_bands_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    odd_ids = docs.where("doc_id % 2 = 1").join(labels.select("doc_id", "quality"), "doc_id").where("quality is not null")
    judged = quality.quality(odd_ids, PIECE_BPE).where("not base_failed").groupBy("row.quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r["quality"]: r["kept"] for r in judged.collect()}
    assert kept[1] >= 0.95 and kept[0] <= 0.25


def test_pipeline_stages_keep_columns(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        assert stage(spark, odd, SMALL).columns == odd.columns
    rows = corpus_pipeline.run(spark, SMALL).collect()
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert rows and {r["doc_id"] for r in rows} <= ids
