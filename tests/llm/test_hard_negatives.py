"""Hard negatives against brute force, and that the index prunes."""

import random

import numpy as np
import pandas as pd
import pytest

from dayledger.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string"


def brute(rows, every, positives, negatives):
    whole = [(i, lab, [int(256 * x // 1) for x in v]) for i, v, lab, *_ in rows]
    out = []
    for n, (anchor, label, q) in enumerate(whole):
        if anchor % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i, lab == label) for m, (i, lab, v) in enumerate(whole) if m != n)
        for p, positive, _ in [s for s in scores if s[2]][:positives]:
            fits = [s for s in scores if not s[2] and -50 * p <= -100 * s[0] <= -95 * p][:negatives]
            out += [(anchor, positive, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(fits)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "s") for r in rows], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("seed, block", [(1, 40), (2, 7), (3, 4096)])
def test_brute_force_with_ties_lengths_and_rounds(spark, seed, block):
    rng = random.Random(seed)
    rows = [
        (i, [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5]) * rng.choice([1, 1, 4]) for _ in range(5)], rng.randrange(3))
        for i in range(240)
    ]
    got = hardneg.hard_negatives(table(spark, rows), every=7, block=block, anchors_block=9)
    assert found(got) == brute(rows, 7, 5, 3)


def test_a_hot_label_and_copies_of_one_vector(spark):
    rng = random.Random(5)
    rows = [(i, [0.5, 0.25, 0.125], 1) for i in range(120)] + [(200 + i, [0.45, 0.25 + i / 512, 0.0], 2) for i in range(40)]
    rows += [(300 + i, [rng.uniform(-1, 1) for _ in range(3)], rng.randrange(4)) for i in range(60)]
    rng.shuffle(rows)
    assert found(hardneg.hard_negatives(table(spark, rows), every=10, block=16)) == brute(rows, 10, 5, 3)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (50, [1.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 2), (4, [float("-inf")], 2),
        (5, [1.0, 1.0], None), (6, [1.0, 1.25], 2), (6, [1.0, 1.25], 2), (7, [], 2), (8, [0.0, 0.0], 1), (0, [1.0, 2.0], 1),
    ]
    got = found(hardneg.hard_negatives(table(spark, [*rows, (None, [1.0, 1.0], 2)])))
    # rows 0 and 0: each the other's first positive (5 * 256^2), then 50 (256^2), then 8 (0)
    best, half = 5 * 65536, 65536
    assert got.count((0, 0, 1, 6, best, int(3.5 * 65536))) == 2 and got.count((0, 0, 2, 6, best, int(3.5 * 65536))) == 2
    assert (0, 8, 1, 7, 0, 0) in got and not any(r[0] == 0 and r[1] == 50 and r[5] > 0.95 * half for r in got)
    assert hardneg.hard_negatives(table(spark, [])).count() == 0
    large = [(0, [1e14, 1.0], 1), (1, [9e13, 3.0], 1), (2, [7e13, -1.0], 2), (3, [-1e30, 0.0], 2)]
    exact = [int(256 * float(np.float32(x))) for x in (1e14, 9e13, 7e13)]
    held = min(exact[0] * exact[1] + 256 * 768, 2**63 - 1)
    assert found(hardneg.hard_negatives(table(spark, large)))[:1] in ([], [(0, 1, 1, 2, held, exact[0] * exact[2] - 65536)])


def test_only_few_vectors_reach_the_exact_comparison():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    v = np.floor(256 * (centres[rng.integers(0, 20, 3000)] + 0.02 * rng.normal(size=(3000, 16)))).astype(int)
    rows = pd.DataFrame({"row": range(3000), "id": range(3000), "label": 0, "vector": list(v), "size": np.sqrt((v**2).sum(1) * 1.0)})
    block = hardneg.Block(next(hardneg._pack((0,), rows).itertuples(index=False)))
    kept = 0
    for q in v[:100]:
        scores = v @ q
        floor = np.sort(scores)[-5]
        at = block.candidates(q, float(floor), hardneg.FOCUS)
        assert set(np.flatnonzero(scores >= floor)) <= set(at)
        kept += len(at)
    assert kept < 0.25 * 100 * 3000
    assert len(block.candidates(v[0], 1.01 * block.most * np.sqrt((v[0] ** 2).sum()), 4)) == 0
