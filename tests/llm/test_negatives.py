from __future__ import annotations

import math
import random

import numpy as np
import pytest

from cadastra.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, Anchor string"


def plain(rows):
    """Every anchor against every row."""
    usable = []
    for id_, v, label in rows:
        if id_ is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((id_, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if id_ % 7 == 0 else label))
    out = []
    for a, v, label in usable:
        if a % 100:
            continue
        others = sorted((-sum(x * y for x, y in zip(v, w)), b, k) for b, w, k in usable if b != a and len(w) == len(v))
        for score, p in [(-s, b) for s, b, k in others if k == label][:5]:
            window = [(-s, b) for s, b, k in others if k != label and 80 * score <= -100 * s <= 100 * score]
            out += [(a, p, i + 1, b, score, s) for i, (s, b) in enumerate(window[:5])]
    return sorted(out)


def found(frame):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in frame.collect())


def vectors(rng, n, width=9, labels=3):
    centres = [[rng.gauss(0, 0.4) for _ in range(width)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.randrange(labels)) for i in rng.sample(range(-2000, 4000), n)]


@pytest.mark.parametrize("block_rows", [37, 400, 100_000])
def test_against_all_rows(spark, block_rows):
    rows = vectors(random.Random(block_rows), 1500)
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    wanted = plain(rows)
    assert len(wanted) > 200
    assert found(negatives.hard_negatives(frame, block_rows=block_rows)) == wanted


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(4)
    rows = vectors(rng, 300, width=4)
    same = [0.5, 0.25, -0.5, 0.125]
    rows += [(5000 + i, same, i % 3) for i in range(400)]
    rows += [(10_000, same, None), (10_100, None, 1), (10_200, [0.1, None, 0.2, 0.3], 1), (10_300, [float("nan"), 0.0, 0.0, 0.0], 1), (10_400, [float("inf"), 0.0, 0.0, 0.0], 1), (None, same, 1)]
    rows += [(20_000, [1.0, 2.0], 1), (20_001, [1.0, 2.0], 1), (20_002, [1.0, 1.5], 2), (20_100, [], 0), (20_101, [], 0), (20_102, [], 2), (30_000, [0.0] * 4, 0), (30_001, [1000.0, 0.0, 0.0, -3.0], 2)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert found(negatives.hard_negatives(frame, block_rows=64)) == plain(rows)


def test_repeated_ids_and_none(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (101, [0.9, 0.1], 1), (102, [0.8, 0.0], 2), (102, [0.8, 0.0], 2)]
    got = found(negatives.hard_negatives(spark.createDataFrame([(*r, "") for r in rows], SCHEMA)))
    assert got == [(100, 101, 1, 102, 230 * 256, 204 * 256), (100, 101, 2, 102, 230 * 256, 204 * 256)]
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_too_large_a_component(spark):
    frame = spark.createDataFrame([(100, [1e30], 1, ""), (101, [1.0], 1, "")], SCHEMA)
    with pytest.raises(Exception, match="overflow"):
        negatives.hard_negatives(frame).collect()


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 100, (12, 32))
    rows = np.floor(centres[rng.integers(0, 12, 4000)] + rng.normal(0, 12, (4000, 32))).astype(np.int64)
    block = negatives.Block(np.arange(4000), np.zeros(4000, np.int64), rows)
    anchors = rows[:40]
    lower, spread = block.bounds(anchors)
    exact = anchors @ rows.T
    assert (lower <= exact).all() and (exact <= lower + spread[:, None]).all()
    kept = [(lower[k] + spread[k] >= np.sort(lower[k])[-5]).mean() for k in range(40)]
    assert np.mean(kept) < 0.3  # most rows are never scored
